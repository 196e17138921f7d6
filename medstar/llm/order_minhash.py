"""Near-duplicates by Order MinHash.

A text is the sequence of its five-word shingles; for the sketches each is
labelled with its occurrence number.  For each of ``sketches`` hash functions the ``ell``
labelled shingles with the smallest hashes are taken and kept *in text
order*; texts that agree in one such tuple are candidates.  A tuple agrees
only if the shared shingles stand in the same order, so the sketch follows
edit similarity (Marcais et al., "Locality-sensitive hashing for the edit
distance", 2019), unlike a plain MinHash of the shingle set.

Candidates are verified by a banded alignment of the two sequences without
labels, their longest common subsequence in the band: with ``m`` shingles aligned in order, similarity is ``m / (na + nb - m)``.
A pair at or above ``threshold`` is a link; classes are the connected
components of the links, and equal texts are always of one class.

Two texts of similarity s agree in one sketch with probability about s**ell;
with the defaults a pair at 0.8 is missed with probability 3.7e-5 (0.36**10),
about 1e-4 for texts of five shingles.

Scale.  Equal texts are one row from the first aggregation on.  Buckets of a
single text fall away, buckets with the same members are verified once.
Members of a larger bucket are dealt over blocks of ``block`` texts and every
pair of blocks is verified in a task of its own, so no task gets an unbounded
group and no candidate is dropped; a task returns at most one link fewer than
it has texts (a spanning forest), never all pairs.

Defined results: a null text counts as empty; texts without a word are linked
to equal texts only; repeated rows and equal ids are one text; the kept
document of a class is the one with the smallest id (null ids last); an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medstar.llm import textvec as T
from medstar.llm.common import cut, packed, text_key, unpacked
from medstar.llm.components import components

WORDS, THRESHOLD, SKETCHES, ELL, BLOCK = 5, 0.8, 10, 2, 512


def order_sketches(marked: np.ndarray, begin: np.ndarray, sketches: int, ell: int) -> np.ndarray:
    """One row per text with shingles, one column per hash function."""
    start, n = begin[:-1], np.diff(begin)
    at = np.arange(len(marked)) - np.repeat(start, n)
    low = np.uint64((1 << 28) - 1)                           # place of a shingle in its text
    out = np.zeros((len(n), sketches), np.uint64)
    seeds = np.random.default_rng(11).integers(1, 1 << 63, sketches, dtype=np.uint64)
    for j, seed in enumerate(seeds):
        x = (T.mix(marked ^ seed) & ~low) | at.astype(np.uint64)
        places = []
        for _ in range(ell):
            place = (np.minimum.reduceat(x, start) & low).astype(np.int64)
            # a text with fewer than ell shingles repeats its last one
            places.append(np.where(n > len(places), place, places[-1] if places else place))
            x[start + places[-1]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        order = np.sort(np.stack(places), axis=0)
        value = np.full(len(n), j + 1, np.uint64)
        for place in order:
            value = T.mix(value ^ marked[start + place]) + np.uint64(j)
        out[:, j] = value
    return out


def marked_shingles(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, begin = T.shingles(*T.word_hashes(texts), k)
    return T.labelled(hashes, begin), begin


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Shingles of the two sequences that can be aligned in order, none moved
    by more than ``band`` places: the longest common subsequence in the band.
    Any place of a shingle may meet any place of an equal one."""
    least = min(len(a), len(b))
    differ = np.flatnonzero(a[:least] != b[:least])
    head = int(differ[0]) if len(differ) else least
    a, b, tail = a[head:], b[head:], 0
    if abs(len(a) - len(b)) <= band and (least := min(len(a), len(b))):
        differ = np.flatnonzero(a[len(a) - least:] != b[len(b) - least:])
        tail = least - 1 - int(differ[-1]) if len(differ) else least
        a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    order = np.argsort(b, kind="stable")
    values = b[order]
    lo, hi = np.searchsorted(values, a), np.searchsorted(values, a, side="right")
    counts = hi - lo
    total = int(counts.sum())
    if total > len(a) * (8 + len(b) // 256):
        return head + tail + _aligned_bits(a, b, band)
    # the longest increasing run over all matched places, those of one shingle
    # of ``a`` from the last to the first so that only one of them counts
    ia = np.repeat(np.arange(len(a)), counts)
    back = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    ib = order[np.repeat(hi, counts) - 1 - back]
    ib = ib[np.abs(ia - ib) <= band]
    if not len(ib) or (np.diff(ib) > 0).all():
        return head + tail + len(ib)
    tails: list[int] = []
    for x in ib.tolist():
        i = bisect_left(tails, x)
        if i == len(tails):
            tails.append(x)
        else:
            tails[i] = x
    return head + tail + len(tails)


def _aligned_bits(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The same by bits of whole numbers (Hyyro, 2004), for shingles that
    repeat so often that the matched places are too many to list."""
    places: dict[int, int] = {}
    values, code = np.unique(b, return_inverse=True)
    for v in np.intersect1d(values, a).tolist():
        bits = np.packbits(code == np.searchsorted(values, np.uint64(v)), bitorder="little")
        places[v] = int.from_bytes(bits.tobytes(), "little")
    full = (1 << len(b)) - 1
    window = (1 << (2 * band + 1)) - 1
    row = full
    for i, x in enumerate(a.tolist()):
        if not (match := places.get(x, 0)):
            continue
        match &= window << (i - band) if i >= band else window >> (band - i)
        same = row & match
        row = ((row + same) | (row - same)) & full
    return len(b) - row.bit_count()


def _shared(parts: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles that each two sequences share."""
    n = len(parts)
    owner = np.repeat(np.arange(n), [len(p) for p in parts])
    values, code, count = np.unique(np.concatenate(parts), return_inverse=True,
                                    return_counts=True)
    common = count > 1                                       # others can't be shared
    column = np.cumsum(common) - 1
    keep = common[code]
    owner, code = owner[keep], column[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    out = np.zeros((n, n), np.float32)
    width = 4096
    for at in range(0, int(common.sum()), width):
        lo, hi = np.searchsorted(code, [at, at + width])
        grid = np.zeros((n, width), np.float32)
        grid[owner[lo:hi], code[lo:hi] - at] = 1
        out += grid @ grid.T
    return out


def links_of(keys: list[bytes], parts: list[np.ndarray], sides: np.ndarray | None,
             threshold: float) -> list[tuple[bytes, bytes, float]]:
    """A spanning forest of the verified links among some texts, in the order
    of their keys so that other buckets choose the same links.  ``parts``: their
    shingles without labels.  ``sides``: only the links between different sides
    that join what links within the sides leave apart."""
    size = np.array([len(p) for p in parts])
    begin = np.r_[0, np.cumsum(size)]
    marked = T.labelled(np.concatenate(parts), begin)
    # a shingle is shared as often as both have it: no alignment has more
    shared = _shared([marked[x:y] for x, y in zip(begin, begin[1:])])
    together = size[:, None] + size[None, :] - shared
    possible = np.triu(shared >= threshold * together - 1e-6, 1)
    at = np.argwhere(possible)
    across = np.ones(len(at), bool)
    if sides is not None:
        across = sides[at[:, 0]] != sides[at[:, 1]]
        order = np.argsort(across, kind="stable")            # within the sides first
        at, across = at[order], across[order]
    root = list(range(len(keys)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for (i, j), new in zip(at.tolist(), across.tolist()):
        x, y = find(i), find(j)
        if x == y:
            continue
        both = int(size[i] + size[j])
        least = threshold * both / (1 + threshold)           # aligned shingles that suffice
        m = aligned(parts[i], parts[j], int(both - 2 * least) + 1)
        if m >= threshold * (both - m) - 1e-9:
            root[y] = x
            if new:
                out.append((keys[i], keys[j], m / (both - m)))
    return out


def _no_null(doc_id: Column) -> Column:
    """An id to join on: null ids are equal to each other."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))


def sketch_table(docs: DataFrame, id_col: str, text_col: str, sketches: int, ell: int) -> DataFrame:
    """(id, key, sketch): ``sketch`` is null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            out: list = []
            for lo, hi in T.groups_of([len(t) for t in texts]):
                marked, begin = marked_shingles(texts[lo:hi], WORDS)
                has = np.diff(begin) > 0
                rows = order_sketches(marked, np.r_[begin[:-1][has], begin[-1]],
                                      sketches, ell).view(np.int64).tolist() if has.any() else []
                left = iter(rows)
                out += [next(left) if h else None for h in has]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))],
                names=["id", "key", "sketch"])

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_key(text).alias("key"), text.alias("text")).mapInArrow(
        run, "id long, key binary, sketch array<long>")


def text_links(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str,
               threshold: float, block: int) -> DataFrame:
    """Verified links (a, b, similarity) between keys of different texts.
    ``classes``: (key, id, sketch), one row per text."""
    entries = classes.filter("sketch is not null").select(
        "key", F.posexplode("sketch").alias("band", "value"))
    buckets = (entries.groupBy("band", "value")
               .agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("who"),
                    F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("who2"))
               .filter("n > 1")
               # the same members (128 bits) in several bands: verified once
               .groupBy("n", "who", "who2").agg(F.min(F.struct("band", "value")).alias("at"))
               .select("at.band", "at.value", "n"))
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("key", "band"), F.col("blocks")).cast("int")
    members = (entries.join(buckets, ["band", "value"]).withColumn("blocks", blocks)
               .withColumn("own", own)
               .select("key", "band", "value", "own",
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
               .select("key", "band", "value", "own", F.least("own", "other").alias("lo"),
                       F.greatest("own", "other").alias("hi")))
    members = cut(members, "members")
    # the text of one document per member; ids spread the copies of a text
    wanted = members.select("key").distinct().join(classes.select("key", "id"), "key")
    whole = docs.select(_no_null(F.col(f"`{id_col}`")).alias("id"),
                        text_key(F.col(f"`{text_col}`")).alias("key"),
                        F.col(f"`{text_col}`").alias("text"))
    found = whole.join(wanted.select("key", _no_null(F.col("id")).alias("id")),
                       ["key", "id"]).select("key", "text")

    def sequence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in T.groups_of([len(t) for t in texts]):
                plain, begin = T.shingles(*T.word_hashes(texts[lo:hi]), WORDS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     pa.array([plain[x:y].tobytes() for x, y in zip(begin, begin[1:])],
                              pa.binary())], names=["key", "plain"])

    sequences = found.mapInArrow(sequence, "key binary, plain binary")
    # repeated rows give the same sequence again: one is enough
    sequences = sequences.groupBy("key").agg(F.first("plain").alias("plain"))

    def verify(pdf):
        import pandas as pd

        pdf = pdf.sort_values("key")
        lo, hi = pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        found = links_of(list(pdf["key"]), [np.frombuffer(x, np.uint64) for x in pdf["plain"]],
                         None if lo == hi else pdf["own"].to_numpy(), threshold)
        return pd.DataFrame(found, columns=["a", "b", "similarity"])

    return (members.join(sequences, "key").groupBy("band", "value", "lo", "hi")
            .applyInPandas(verify, "a binary, b binary, similarity double"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, sketches: int = SKETCHES, ell: int = ELL,
                    block: int = BLOCK) -> DataFrame:
    """One row per document: ``id``, ``key`` (of the text), ``class_id`` (the
    smallest id in its class), ``class_key`` (the key of that document's
    text) and ``copies`` (rows with an equal text)."""
    rows = cut(sketch_table(docs, id_col, text_col, sketches, ell), "sketches")
    classes = cut(rows.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"),
                                          F.first("sketch").alias("sketch")), "texts")
    links = text_links(docs, classes, id_col, text_col, threshold, block)
    labels = components(links)
    of = classes.join(labels, classes.key == labels.node, "left").select(
        "key", "id", "copies", F.coalesce("label", "key").alias("label"))
    # the smallest id of a class, null ids last
    heads = of.groupBy("label").agg(F.min(F.struct(
        F.col("id").isNull().alias("none"), F.col("id"), F.col("key"))).alias("head"))
    texts = cut(of.join(heads, "label").select(
        "key", "copies", F.col("head.id").alias("class_id"),
        F.col("head.key").alias("class_key")), "classes")
    return rows.select("id", "key").join(texts, "key").select(
        "id", "key", "class_id", "class_key", "copies")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without near-duplicates: one row per class stays."""
    columns = docs.columns
    found = near_duplicates(docs, **options)
    heads = (found.filter("key = class_key").groupBy(F.col("key").alias("__key"))
             .agg(F.min("id").alias("head"))
             .select("__key", _no_null(F.col("head")).alias("__id")))
    rows = packed(docs, __key=text_key(docs["text"]), __id=_no_null(docs["doc_id"]))
    # partitioned and sorted by the join already: a repeated row stays once
    once = Window.partitionBy("__key", "__id").orderBy("__key", "__id")
    kept = rows.join(heads, ["__key", "__id"]).withColumn("__n", F.row_number().over(once))
    return kept.filter("__n = 1").select(*unpacked(kept, columns))
