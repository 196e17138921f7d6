"""Benchmark decontamination by pigeonhole edit matching.

Documents and benchmark items are compared in a normal form: lower case, runs
of ASCII characters other than letters and digits as one blank.  An item of
``n`` characters may occur with up to ``errors = floor(rate * n)`` edits.  It
is split into ``errors + 1`` pieces: an occurrence within the budget leaves at
least one piece untouched.  An Aho-Corasick automaton finds exact hits of all
pieces in one pass over a whole text; each hit fixes the item's place up to
the budget, and Myers' bit-parallel distance verifies that stretch of text.

Scale: one Arrow pass over the documents per block of items and no shuffle.
The benchmark is a stated query set.  It is dealt into blocks of at most
``block_chars`` characters (the proven bound of what is shipped to a task);
every block is matched against all documents, so there is no limit on items.

Defined results: a null text matches nothing; items of fewer than
``min_chars`` normal characters (null ones too) are no evidence and match
nothing; equal items match each on their own, an item listed twice with one
id counts once; an empty table on either side gives no match; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from medstar.llm.common import packed, unpacked

RATE, MIN_CHARS, BLOCK_CHARS = 0.05, 24, 2_000_000
_BLANK = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def normal(text: str | None) -> str:
    raw = (text or "").lower().encode("utf-8", "replace").translate(_BLANK)
    return b" ".join(raw.split()).decode("utf-8")


def budget(n: int, rate: float = RATE) -> int:
    return int(n * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of near equal length with their places."""
    at = np.linspace(0, len(item), errors + 2).astype(int).tolist()
    return [(a, item[a:b]) for a, b in zip(at, at[1:])]


def masks(pattern: str) -> dict[str, int]:
    """For each character the set of its places, as bits."""
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance between a pattern of ``m`` characters and any part
    of ``text``, and the first end of such a part (Myers 1999)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full                 # a match may begin anywhere
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, i
    return best, end


class Matcher:
    """Finds the items of one block in texts; the automaton is built once in
    each Python worker."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.rate = items, rate

    def __getstate__(self):
        return {"items": self.items, "rate": self.rate}

    def _ready(self):
        if "_automaton" not in self.__dict__:
            import ahocorasick

            words: dict[str, list[tuple[int, int]]] = {}
            self._budget = [budget(len(t), self.rate) for _, t in self.items]
            self._masks = [masks(t) for _, t in self.items]
            for i, (_, text) in enumerate(self.items):
                for at, piece in pieces(text, self._budget[i]):
                    words.setdefault(piece, []).append((i, at + len(piece)))
            automaton = ahocorasick.Automaton()
            for word, places in words.items():
                automaton.add_word(word, places)
            automaton.make_automaton()
            self._automaton = automaton
        return self._automaton

    def find(self, text: str | None, first: bool = False) -> list[tuple[int, int, int, int]]:
        """(item id, distance, errors allowed, end in the normal text) of every
        item that occurs; ``first``: one is enough."""
        automaton = self._ready()
        body = normal(text)
        near: dict[int, list[int]] = {}
        for end, places in automaton.iter(body):
            for i, to in places:
                near.setdefault(i, []).append(end + 1 - to)   # where the item would begin
        out = []
        for i, begins in near.items():
            item_id, item = self.items[i]
            m, errors = len(item), self._budget[i]
            begins.sort()
            best = None
            lo = hi = None
            for at in [*begins, None]:
                if lo is not None and (at is None or at - errors > hi):
                    distance, end = myers(self._masks[i], m, body[lo:hi])
                    if distance <= errors and (best is None or distance < best[0]):
                        best = distance, lo + end
                    lo = None
                if at is not None:
                    lo = max(0, at - errors) if lo is None else lo
                    hi = at + m + errors
            if best is not None:
                out.append((item_id, best[0], errors, best[1]))
                if first:
                    break
        return out


def matchers(benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS,
             block_chars: int = BLOCK_CHARS) -> Iterator[Matcher]:
    """The items in blocks of at most ``block_chars`` characters (a longer item
    is a block of its own), read one after another."""
    rows = (benchmark.filter("text is not null and item_id is not null")
            .select(F.col("item_id").cast("long"), "text").distinct().toLocalIterator())
    block, size, seen = [], 0, set()
    for item_id, text in rows:
        item = normal(text)
        if len(item) < min_chars or (item_id, item) in seen:
            continue
        if block and size + len(item) > block_chars:
            yield Matcher(block, rate)
            block, size, seen = [], 0, set()
        block.append((item_id, item))
        seen.add((item_id, item))
        size += len(item)
    if block:
        yield Matcher(block, rate)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, distance, errors, end): the best occurrence of each
    item in each document that contains it within the budget."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, distance int, errors int, end long"
    rows = docs.select("doc_id", "text")
    out = None
    for matcher in matchers(benchmark, **options):

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, found = [], []
                for k, text in enumerate(batch.column(1)):
                    for hit in matcher.find(text.as_py()):
                        at.append(k)
                        found.append(hit)
                cols = list(zip(*found)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())),
                     *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(),
                                                            pa.int64()))]],
                    names=["doc_id", "item_id", "distance", "errors", "end"])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _leaks(matcher: Matcher):
    @pandas_udf("boolean")
    def leaks(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([bool(matcher.find(t, True)) for t in part], dtype=bool)

    return leaks


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no item occurs, with all their columns."""
    columns, out = docs.columns, docs
    for matcher in matchers(benchmark, **options):
        rows = packed(out, __leaks=_leaks(matcher)(out["text"]))
        out = rows.filter(~F.col("__leaks")).select(*unpacked(rows, columns))
    return out
