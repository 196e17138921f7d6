"""Language identification by the nearest centroid.

A text is its letters in lower case, words apart by one blank; its vector
holds the numbers of its 1-, 2- and 3-grams of code points, hashed to
``DIMENSIONS`` places, as ``(1 + log tf) * idf`` of length one.  For each
language the training vectors are clustered (spherical k-means) into up to
``clusters`` centroids; a text gets the language of the centroid with the
largest cosine, which is also its score.  A text farther from its nearest
centroid than nearly all training texts of that centroid is ``rejected``:
probably of none of the learned languages.

The classifier is fitted on a bounded sample of about ``max_rows`` different
texts of each language (their number is estimated within a few per cent, then
they are chosen by a hash of the text, copies once), each of at most
``MAX_CHARS`` characters; clustering runs as one Spark task per language over
its part of the sample.  Prediction is one Arrow pass over whole texts, no
shuffle; what is shipped to a task is a table of ``languages * clusters``
vectors.

Defined results: a null text, or one without a letter, is ``und`` with score
0; without training rows every text is ``und``; language, source and id are no
input of a prediction; repeated rows are rows; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medstar.llm import textvec as T
from medstar.llm.common import cut, held_out, text_key

DIMENSIONS, CLUSTERS, MAX_ROWS, MAX_CHARS, QUANTILE = 4096, 4, 1500, 200_000, 0.999
_BLANK = 32
_letters: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)]))
    return _letters[0][codes]


def counts(texts: list[str | None]) -> np.ndarray:
    """Numbers of the hashed n-grams of each text; a row of zeros: no letter."""
    joined = [" " + (t or "").lower() + " " for t in texts]
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in joined])
    codes = np.where(_is_letter(codes), codes, _BLANK).astype(np.uint32)
    # one blank between words; the first of each text stays
    keep = (codes != _BLANK) | np.r_[True, (codes[:-1] != _BLANK) | (owner[1:] != owner[:-1])]
    codes, owner = codes[keep], owner[keep]
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    out = np.zeros(len(texts) * DIMENSIONS)
    gram = np.zeros(len(codes), np.uint32)
    for n in (1, 2, 3):
        with np.errstate(over="ignore"):
            gram = gram[:len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:]
            place = (gram * np.uint32(0x9E3779B1) + np.uint32(n)) >> shift
        first, last = owner[:len(gram)], owner[n - 1:]
        inside = first == last
        if n == 1:
            inside = codes != _BLANK
        out += np.bincount(first[inside] * DIMENSIONS + place[inside],
                           minlength=len(texts) * DIMENSIONS)
    out = out.reshape(len(texts), DIMENSIONS)
    out[~(np.bincount(owner, codes != _BLANK, len(texts)) > 0)] = 0
    return out


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    tf = np.where(count > 0, 1 + np.log(np.maximum(count, 1)), 0) * idf
    return (tf / np.maximum(np.linalg.norm(tf, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def cluster(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` centroids of length one, and each row's centroid."""
    rng = np.random.default_rng(3)
    centres = rows[rng.integers(len(rows))][None]
    while len(centres) < min(k, len(rows)):
        far = np.maximum(1 - (rows @ centres.T).max(axis=1), 0) ** 2      # k-means++
        if far.sum() <= 1e-9:
            break
        centres = np.r_[centres, rows[rng.choice(len(rows), p=far / far.sum())][None]]
    for _ in range(12):
        own = (rows @ centres.T).argmax(axis=1)
        new = np.stack([rows[own == j].sum(axis=0) if (own == j).any() else centres[j]
                        for j in range(len(centres))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.abs(new - centres).max() < 1e-4:
            break
        centres = new
    return centres, (rows @ centres.T).argmax(axis=1)


@dataclass
class LanguageModel:
    languages: list[str] = field(default_factory=list)     # of each centroid
    centres: np.ndarray | None = None
    limits: np.ndarray | None = None
    idf: np.ndarray | None = None

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float, bool]]:
        """(language, score, distance, rejected) of each text."""
        out = []
        for lo, hi in T.groups_of([len(t or "") + 2000 for t in texts], 2 << 20):
            count = counts(texts[lo:hi])
            if self.centres is None:
                out += [("und", 0.0, 1.0, True)] * (hi - lo)
                continue
            near = vectors(count, self.idf) @ self.centres.T
            best = near.argmax(axis=1)
            some = count.any(axis=1)
            for i, j in enumerate(best.tolist()):
                score = min(1.0, max(0.0, float(near[i, j])))
                out.append((self.languages[j], score, 1 - score, bool(1 - score > self.limits[j]))
                           if some[i] else ("und", 0.0, 1.0, True))
        return out


def fit_languages(docs: DataFrame, max_rows: int = MAX_ROWS,
                  clusters: int = CLUSTERS) -> LanguageModel:
    """Fits on rows that are not held out and have a text and a language."""
    known = (docs.filter(~held_out(docs["doc_id"])).select(F.col("lang").cast("string"), "text")
             .filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                     & (F.length("text") <= MAX_CHARS)))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(
        F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")).collect()}
    if not sizes:
        return LanguageModel()
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / (1 << 40)
    rates = docs.sparkSession.createDataFrame(
        [(k, max_rows / n if n > max_rows else 1.0) for k, n in sizes.items()],
        "of string, rate double")
    # a text of any number of rows is one of the sample
    sample = cut(known.join(F.broadcast(rates), known["lang"] == F.col("of"))
                 .filter(place < F.col("rate")).groupBy("lang", text_key(F.col("text")).alias("key"))
                 .agg(F.first("text").alias("text")).select("lang", "text"), "language-sample")

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in T.groups_of([len(t) + 2000 for t in texts], 2 << 20):
                total += (counts(texts[lo:hi]) > 0).sum(axis=0)
            rows += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([total.tolist()],
                                         pa.list_(pa.int64()))], names=["n", "df"])

    parts = sample.select("text").mapInArrow(held, "n long, df array<long>").collect()
    n, df = sum(r["n"] for r in parts), sum(np.array(r["df"]) for r in parts)
    idf = np.log((1 + n) / (1 + df)) + 1

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(pdf["text"])
        rows = np.concatenate([vectors(counts(texts[lo:hi]), idf) for lo, hi in
                               T.groups_of([len(t) + 2000 for t in texts], 2 << 20)])
        rows = rows[rows.any(axis=1)]
        if not len(rows):
            return pd.DataFrame({"lang": [], "centre": [], "limit": []}, dtype=object)
        centres, own = cluster(rows, clusters)
        far = 1 - (rows * centres[own]).sum(axis=1)
        limits = [float(np.quantile(far[own == j], QUANTILE)) * 1.1 if (own == j).any() else 1.0
                  for j in range(len(centres))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centre": list(centres.astype(float)),
                             "limit": limits})

    found = (sample.groupBy("lang").applyInPandas(
        centroids, "lang string, centre array<double>, limit double").collect())
    found.sort(key=lambda r: (r["lang"], r["centre"]))
    if not found:
        return LanguageModel()
    return LanguageModel([r["lang"] for r in found],
                         np.array([r["centre"] for r in found], np.float32),
                         np.array([r["limit"] for r in found]), idf)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, distance, rejected)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*model.predict(batch.column(2).to_pylist()))) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 *[pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.float64(),
                                                        pa.bool_()))]],
                names=["doc_id", "held_out", "lang_pred", "score", "distance", "rejected"])

    return docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
             "distance double, rejected boolean")
