"""Token ids as ORC files.

Every whole text is encoded with a public tokenizer, an end id is appended,
and the ids are written as ORC in ascending id order: range-partitioned and
sorted by document id, so each file covers a range of ids.  ORC stores the
ids in stripes with integer run-length encoding; row indexes with a minimum
and maximum for each ``stride`` rows and Bloom filters on the document id let
a lookup by id skip files, stripes and row groups, and stripes are read in
parallel.

Encoding.  BPE works on single words of the lower-cased text, and no word
crosses a blank; so the ids of a string between blanks are kept in the Python
worker and reused, and the library's BPE model encodes each new word.  That holds for texts in Latin letters and common punctuation, where
its normalisation and word pattern are plain; any other text, and any text
that may hold a special token, goes to the tokenizer whole.  The cache
is bounded and is only a matter of speed.

``start`` of a document counts all ids before it.  Totals of small ranges of
rows give each range its start, and only rows within a range are summed in
order, so no task sees all rows.

Defined results: a null text is an empty one (the end id only); equal or null
ids are ordered by the text's hash (null ids first), repeated rows follow each
other; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medstar.llm.common import byte_size, cut
from medstar.session import scratch_path

END_ID, STRIPE_BYTES, STRIDE, FILE_BYTES = 1, 16 << 20, 1000, 64 << 20
CACHE_WORDS, CACHE_CHARS, _SEEN = 600_000, 40, (1 << 22) - 1
#: Characters for which lower case, NFC and the word pattern are the plain ones.
_NOT_PLAIN = re.compile("[^\\x00-\\u012f\\u0131-\\u017f\\u2010-\\u2027\\u2030-\\u203e\\u20ac]")
_L, _N, _S = "a-zªµº\\u00df-\\u00f6\\u00f8-\\u017f", "0-9²³¹¼-¾", "\\t-\\r \\x85\\xa0"


def _pattern(letter: str, digit: str, blank: str) -> re.Pattern:
    # the endings come before other punctuation, as in the tokenizer's pattern
    return re.compile(f"[{letter}]+|'s|'t|'re|'ve|'m|'ll|'d|[{digit}]|[^{blank}{letter}{digit}]+")


_WORDS, _ASCII_WORDS = _pattern(_L, _N, _S), _pattern("a-z", "0-9", "\\t-\\r ")
_RUNS, _SEPARATORS = re.compile(f"[^{_S}]+"), re.compile("[\\x1c-\\x1f]")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable bytes
    stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.seen = bytearray(_SEEN + 1)
        self.missed = 0

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        elif not word.isprintable():
            word = word.translate(_BYTE_LETTERS)
        return np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()

    def _kept(self, words: str, ids: bytes) -> bytes:
        """Keeps what is met a second time.  Frequent strings come early, so a
        full cache takes no more; if many are missed then, the texts have
        changed and it begins anew."""
        if len(words) <= CACHE_CHARS:
            place = hash(words) & _SEEN
            if not self.seen[place]:
                self.seen[place] = 1
            elif len(self.known) < CACHE_WORDS:
                self.known[words] = ids
            else:
                self.missed += 1
                if self.missed > 8 * CACHE_WORDS:
                    self.known.clear()
                    self.seen = bytearray(_SEEN + 1)
                    self.missed = 0
        return ids

    def _run(self, run: str) -> bytes:
        """Ids of a string without blanks."""
        words = (_ASCII_WORDS if run.isascii() else _WORDS).findall(run)
        if len(words) == 1:
            return self._kept(run, self._word(run))
        return self._kept(run, b"".join([self.known.get(w) or self._kept(w, self._word(w))
                                         for w in words]))

    def encode(self, text: str | None, separators: bool = True) -> bytes:
        """Ids as little-endian 32-bit numbers; ``separators``: whether the text
        may hold those that str.split() takes for blanks."""
        text = text or ""
        if "<|" in text or not text.isascii() and _NOT_PLAIN.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids,
                            "<u4").tobytes()
        # no word crosses a blank; what str.split() takes for one beyond the
        # pattern's blanks is part of a word
        low = text.lower()
        runs = _RUNS.findall(low) if separators and _SEPARATORS.search(low) else low.split()
        known = [*map(self.known.get, runs)]
        try:
            return b"".join(known)
        except TypeError:                                    # some are not known yet
            return b"".join([self._run(r) if k is None else k for r, k in zip(runs, known)])


def _encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, key, tokens) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            # few documents at a time: ids take more room than text
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(2)
                odd = bool(pc.any(pc.match_substring_regex(texts, "[\\x1c-\\x1f]")).as_py())
                ids = [encoder.encode(t, odd) + last for t in texts.to_pylist()]
                ends = np.cumsum([0] + [len(x) // 4 for x in ids])
                tokens = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()),
                    pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), tokens],
                                                 names=["doc_id", "key", "tokens"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, key long, tokens array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                 file_bytes: int = FILE_BYTES) -> None:
    """Writes the files; ``file_bytes``: text bytes a file has about."""
    total = docs.select(F.sum(byte_size(docs["text"]))).first()[0] or 0
    # texts are dealt by id first and encoded in their place
    ordered = (docs.select("doc_id", "text", F.xxhash64("text").alias("order"))
               .repartitionByRange(max(1, math.ceil(total / file_bytes)), "doc_id", "order")
               .sortWithinPartitions("doc_id", "order"))
    (encode(ordered, tokenizer_path, end_id).write
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("orc.row.index.stride", str(STRIDE))
     .option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").option("orc.compress", "ZSTD").orc(path))


def read_tokens(spark, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, key, tokens); for given ids the filter reaches the files."""
    rows = spark.read.orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def digests(tokens: DataFrame, rows_per_range: int = 20_000) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) in the order of the files."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            raw = memoryview(lists.flatten().to_numpy().astype("<i4", copy=False)).cast("B")
            n = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(np.r_[0, n]) * 4
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "key", "n_tokens", "ids_crc32"])

    rows = cut(tokens.select("doc_id", "key", "tokens").mapInArrow(
        run, f"doc_id {kind}, key long, n_tokens long, ids_crc32 long"), "token-rows")
    ranges = max(1, math.ceil(rows.count() / rows_per_range))
    # ranges of ids and, for the rare equal ids, of text keys
    placed = cut(rows.repartitionByRange(ranges, "doc_id", "key")
                 .withColumn("range", F.spark_partition_id()), "token-ranges")
    before = Window.orderBy("range")               # one row per range of 20,000 documents
    sums = placed.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    starts = sums.select("range", (F.sum("n").over(before) - F.col("n")).alias("from"))
    own = Window.partitionBy("range").orderBy("doc_id", "key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (placed.join(starts, "range")
            .withColumn("start", F.col("from") + F.sum("n_tokens").over(own) - F.col("n_tokens"))
            .select("doc_id", "start", "n_tokens", "ids_crc32"))


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID,
                path: str | None = None) -> DataFrame:
    """Writes the files (by default to the shared folder), reads them back."""
    path = path or scratch_path(docs.sparkSession, "llm-tokens-orc")
    write_tokens(docs, path, tokenizer_path, end_id)
    return digests(read_tokens(docs.sparkSession, path))
