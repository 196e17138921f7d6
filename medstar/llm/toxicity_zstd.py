"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of ordinary text and
one on windows of toxic text.  A window of a text is compressed once with the
ordinary dictionary alone and once with the toxic one in front of it; the
bytes that the toxic dictionary saves are the window's distance.  An ordinary
window saves nothing, one with toxic expressions several bytes.

Toxic documents are ordinary for the most part, so the text to train the toxic
dictionary on is chosen in rounds: first the occurrences, in toxic documents,
of words that far more toxic than ordinary documents hold (a likelihood-ratio
test), then the windows of toxic documents that save more than ``QUANTILE`` of
the ordinary windows do in the round before.  The round whose
savings explain the labels best gives the dictionary.  A logistic regression
over the largest savings and the shares of windows above 1 to 4 bytes turns
the windows of a whole text into a calibrated score.

The classifier is fitted on a bounded sample of labelled rows, at most about
``max_rows`` rows and ``max_bytes`` bytes of text of each label, chosen by
hashes of id and text; the rows of a label are weighted by their sampling rate.
Scoring covers every window of every text: no shuffle, one Arrow pass.

Defined results: null and empty texts have no window with text and score like
one window that saves nothing; the id and every column but the text are no
input of the score; without a toxic or an ordinary labelled row every score
is 0; an empty table gives an empty result; a repeated label row counts once,
differing labels of one id count as toxic.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from medstar.llm import textvec as T
from medstar.llm.common import held_out, packed, unpacked

WINDOW, OVERLAP, TOP = 64, 16, 6
ORDINARY_BYTES, WORD_BYTES = 64 << 10, (2 << 10, 8 << 10)
ROUND_BYTES = tuple(n << 10 for n in (4, 2, 1, 3, 2))
QUANTILE, RATIO_TEST = 0.99, 14.0
THRESHOLD = 0.7
FEATURES = TOP + 5
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_SAMPLES = 100_000                    # windows given to one dictionary training
_AT_ONCE = 50_000                     # windows compressed in one call


def windows(encoded: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts joined, (offset, length) of their windows and each window's text."""
    n = np.array([len(b) for b in encoded], np.int64)
    count = np.maximum(1, -(-n // (WINDOW - OVERLAP)))
    owner = np.repeat(np.arange(len(n)), count)
    first = np.r_[0, np.cumsum(count)[:-1]]
    at = (np.arange(len(owner)) - first[owner]) * (WINDOW - OVERLAP)
    size = np.minimum(WINDOW, n[owner] - at)
    start = np.r_[0, np.cumsum(n)[:-1]]
    return b"".join(encoded), np.stack([at + start[owner], size], 1).astype(np.uint64), owner


def _compressor(dictionary: bytes) -> zs.ZstdCompressor:
    raw = zs.ZstdCompressionDict(dictionary, dict_type=zs.DICT_TYPE_RAWCONTENT)
    how = zs.ZstdCompressionParameters(
        window_log=18, hash_log=17, chain_log=17, search_log=2, min_match=4, target_length=16,
        strategy=zs.STRATEGY_LAZY, write_content_size=False, write_checksum=False,
        write_dict_id=False)
    raw.precompute_compress(compression_params=how)
    return zs.ZstdCompressor(compression_params=how, dict_data=raw)


def _lengths(data: bytes, segments: np.ndarray, by: zs.ZstdCompressor) -> np.ndarray:
    out = np.zeros(len(segments), np.float64)
    full = np.flatnonzero(segments[:, 1] > 0)                # an empty window has length 0
    for at in range(0, len(full), _AT_ONCE):
        part = full[at:at + _AT_ONCE]
        done = by.multi_compress_to_buffer(
            zs.BufferWithSegments(data, segments[part].tobytes()), threads=1)
        out[part] = [len(x) for x in done]
    return out


def features(saved: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The largest savings of each text's windows, the numbers of windows above
    1 to 4 bytes over the root of their number, and its logarithm."""
    count = np.bincount(owner, minlength=n)
    order = np.lexsort((-saved, owner))
    first = np.r_[0, np.cumsum(count)[:-1]]
    out = np.zeros((n, FEATURES))
    for j in range(TOP):
        has = count > j
        out[has, j] = saved[order[first[has] + j]]
    for j in range(4):
        out[:, TOP + j] = np.bincount(owner, saved >= j + 1, n) / np.sqrt(count)
    out[:, -1] = np.log(count)
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w)),
                               x.T @ (weight * (y - p)) - w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}

    def _pair(self):
        if "_by" not in self.__dict__:
            self._by = _compressor(self.ordinary), _compressor(self.toxic + self.ordinary)
        return self._by

    def features(self, encoded: list[bytes]) -> np.ndarray:
        plain, toxic = self._pair()
        data, segments, owner = windows(encoded)
        return features(_lengths(data, segments, plain) - _lengths(data, segments, toxic),
                        owner, len(encoded))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(texts))
        x = self.features([normal(t) for t in texts])
        z = np.c_[np.ones(len(x)), x] @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


    def scores_in_groups(self, texts: list[str | None]) -> np.ndarray:
        """A few MB of text at a time."""
        done = [self.scores(texts[lo:hi])
                for lo, hi in T.groups_of([len(t or "") for t in texts])]
        return np.concatenate([*done, np.zeros(0)])


def normal(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _train(size: int, samples: list[bytes], rng: np.random.Generator) -> bytes:
    if len(samples) > _SAMPLES:
        samples = [samples[i] for i in rng.choice(len(samples), _SAMPLES, replace=False)]
    try:
        return zs.train_dictionary(size, samples, k=12, d=6).as_bytes()
    except zs.ZstdError:              # too little text to train on: the text itself
        return b"".join(samples)[-size:]


def marking_words(encoded: list[bytes], toxic: np.ndarray) -> set[bytes]:
    """Words in far more toxic than ordinary texts (equal texts count once):
    likelihood ratio above ``RATIO_TEST``."""
    held: tuple[Counter, Counter] = Counter(), Counter()
    n = [0, 0]
    for text, t in {b: t for b, t in zip(encoded, toxic.tolist())}.items():
        held[t].update({w for w in text.translate(_WORDS).split() if 3 < len(w) <= 24})
        n[t] += 1
    out = set()
    for word, a in held[1].items():
        b = held[0][word]
        if a < 3 or a * n[0] <= b * n[1]:
            continue
        share = (a + b) / (n[0] + n[1])
        ratio = sum(o * math.log(o / (m * q)) for o, m, q in (
            (a, n[1], share), (b, n[0], share), (n[1] - a, n[1], 1 - share),
            (n[0] - b, n[0], 1 - share)) if o)
        if 2 * ratio > RATIO_TEST:
            out.add(word)
    return out


def fit(texts: list[str], toxic: np.ndarray, weight: np.ndarray) -> ToxicityModel:
    """Trains both dictionaries and the calibration."""
    if not len(toxic) or toxic.all() or not toxic.any():
        return ToxicityModel()
    rng = np.random.default_rng(5)
    encoded = [normal(t) for t in texts]
    data, segments, owner = windows(encoded)
    mark = toxic[owner]

    def samples(which: np.ndarray) -> list[bytes]:
        return [data[a:a + n] for a, n in segments[np.flatnonzero(which)].astype(np.int64) if n]

    model = ToxicityModel(_train(ORDINARY_BYTES, samples(~mark), rng))
    plain = _lengths(data, segments, _compressor(model.ordinary))
    words = marking_words(encoded, toxic)
    said = [b" " + w + b" " for t in np.flatnonzero(toxic)
            for w in encoded[t].translate(_WORDS).split() if w in words]
    lines = [b"".join(said[i:i + 12]) for i in range(0, len(said), 12)] or samples(mark)
    best, saved = -np.inf, plain
    for k, size in enumerate((*WORD_BYTES, *ROUND_BYTES)):
        if k >= len(WORD_BYTES):
            # the outstanding windows of the round before are the text to train on
            limit = max(np.quantile(saved[~mark], QUANTILE), 0)
            lines = samples(mark & (saved > limit))
            if len(lines) < 20:
                break
        dictionary = _train(size, lines, rng)
        saved = plain - _lengths(data, segments, _compressor(dictionary + model.ordinary))
        x = features(saved, owner, len(texts))
        w = logistic(x, toxic.astype(float), weight)
        z = np.c_[np.ones(len(x)), x] @ w
        fits = -(weight * np.logaddexp(0, np.where(toxic, -z, z))).sum()
        if fits > best:
            model.toxic, model.weights, best = dictionary, w.tolist(), fits
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 5000,
                 max_bytes: int = 10 << 20) -> ToxicityModel:
    """Fits on labelled rows whose id is not held out, see the module."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                           & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg((F.max("toxic") > 0).alias("toxic")))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return ToxicityModel()
    rate = {k: min(1.0, max_rows / x) for k, x in n.items()}

    def chosen(of, rates: dict):
        return F.pmod(F.xxhash64(of), F.lit(1_000_000)) / 1e6 < F.when(
            F.col("toxic"), rates[True]).otherwise(rates[False])

    # about max_rows ids of each label: a table of that size meets the texts
    ids = known.filter(chosen("id", rate))
    # one text alone may be longer than the bound
    rows = (docs.select(F.col("doc_id").cast("long").alias("id"), "text")
            .filter(F.octet_length("text") <= max_bytes)
            .join(F.broadcast(ids), "id").select("toxic", "text"))
    size = {r["toxic"]: r["bytes"] for r in rows.groupBy("toxic").agg(
        F.sum(F.octet_length("text")).alias("bytes")).collect()}
    if len(size) < 2:
        return ToxicityModel()
    part = {k: min(1.0, max_bytes / max(1, x)) for k, x in size.items()}
    got = rows.filter(chosen("text", part)).toPandas().sort_values(
        ["toxic", "text"], ignore_index=True)
    toxic = got["toxic"].to_numpy(bool)
    weight = np.where(toxic, 1 / (rate[True] * part[True]), 1 / (rate[False] * part[False]))
    return fit(list(got["text"]), toxic, weight)


def _score_column(model: ToxicityModel):
    @pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(model.scores_in_groups(list(part)), dtype="float64")

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.scores_in_groups(batch.column(2).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), score],
                                             names=["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    score = _score_column(model)
    rows = packed(docs, __score=score(docs["text"]))
    return rows.filter(F.col("__score") < THRESHOLD).select(*unpacked(rows, docs.columns))
