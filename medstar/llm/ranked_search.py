"""Ranked lexical search with bag deduplication.

Every document is scored for every item by a length-normalised sum over the
item's terms (whole numbers only, so equal on every engine).  A document's
score depends on nothing but its counts of the items' terms and on its length
class ``m``.  So documents are first restricted to the items' vocabulary, then
grouped into bags: rows with identical term and count vectors and an identical
``m``.  Bags meet by a 64-bit hash and are verified by the vectors themselves.
Each bag is scored once, however many documents hold it, and the best bags are
expanded into their documents by ascending id.

Scale.  Texts are read once and never shuffled; what leaves the scan is one
short vector per document.  Grouping is combinable, so a bag that holds a third
of all rows costs one row per task.  A scoring task keeps the ``top`` best bags
of each item as it goes (a bag beyond them can't hold a document of the result,
as each better bag has an earlier document), so a task returns ``top`` rows per
item whatever it has read.  Of a bag's members the ``top`` smallest ids are
kept, cut within each task before they are exchanged.

The items' vocabulary goes to every task.  Its size is checked: items are taken
in blocks of ``block_bytes`` bytes of text, each block being one more pass over
the documents.

Defined results: a null text has no term, documents and items without a term
have no score; documents with equal ids are documents of their own; null ids
come last among equal scores; each row of ``items`` is an item, so a repeated
item is answered twice; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medstar.llm.common import byte_size, cut

TOP, BLOCK_BYTES = 10, 8 << 20
#: Weight of the document's length in ``m`` and of ``m`` in the score.
LENGTH_PERCENT, SATURATION = 75, 8
#: Bytes that belong to terms stay (A to Z as small letters), others are blanks.
#: UTF-8 letters beyond ASCII consist of bytes from 0x80 on, which all stay.
_TERM_BYTES = bytes(
    b if 0x30 <= b < 0x3A or 0x61 <= b < 0x7B or b >= 0x80 else b + 32 if 0x41 <= b < 0x5B else 32
    for b in range(256))
_CHUNK = 2_000_000


def _split(text: bytes) -> list[bytes]:
    # every byte that is not part of a term is a blank now
    return text.translate(_TERM_BYTES).split()


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): all terms counted in ``n``, the vocabulary's
    ones with their counts, by ascending term number."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            n, terms, tfs, ends = [], [], [], [0]
            for text in batch.column(1):
                words = _split(text.as_py() or b"")
                counts = Counter(map(number, words))
                counts.pop(None, None)
                own = sorted(counts)
                n.append(len(words))
                terms += own
                tfs += map(counts.__getitem__, own)
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>"))


def _kept(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best: highest score first, then smallest id."""
    if len(scores) > 8 * top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        near = np.flatnonzero(scores >= max(least, 1))
    else:
        near = np.flatnonzero(scores > 0)
    return near[np.lexsort((ids[near], -scores[near]))[:top]]


def _scored(bags: DataFrame, weights: np.ndarray, queries: list[Counter], top: int) -> DataFrame:
    """(item, bag, score): the best bags of each item in every task.  ``bags``:
    (bag, first, m, terms, tfs) with the smallest id of a bag in ``first``."""
    # items of each term, one after another: item numbers and how often they hold it
    of_term: list[list[tuple[int, int]]] = [[] for _ in weights]
    for item, query in enumerate(queries):
        for term, times in query.items():
            of_term[term].append((item, times))
    begin = np.cumsum([0] + [len(x) for x in of_term])
    item_of = np.array([i for x in of_term for i, _ in x], np.int64)
    times_of = np.array([t for x in of_term for _, t in x], np.int64)
    shared = bags.sparkSession.sparkContext.broadcast((weights, begin, item_of, times_of))
    n_items = len(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, begin, item_of, times_of = shared.value
        best = [(np.zeros(0, np.int64),) * 3 for _ in range(n_items)]   # score, first, bag
        least = np.ones(n_items, np.int64)                  # what a bag must score to be kept
        width = np.diff(begin)

        def take(bag, first, m, owner, terms, tfs):
            part = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + SATURATION * m[owner]))
            total = np.zeros(len(bag) * n_items, np.int64)
            steps = np.cumsum(width[terms])
            at = 0
            while at < len(terms):
                # as many terms at a time as make a bounded number of products
                end = max(at + 1, int(np.searchsorted(
                    steps, (steps[at - 1] if at else 0) + _CHUNK, "right")))
                wide = width[terms[at:end]]
                row = np.repeat(np.arange(at, end), wide)
                place = np.arange(len(row)) - np.repeat(np.cumsum(wide) - wide, wide) \
                    + begin[terms[row]]
                np.add.at(total, owner[row] * n_items + item_of[place], part[row] * times_of[place])
                at = end
            total = total.reshape(len(bag), n_items)
            for item in np.flatnonzero(total.max(axis=0) >= least).tolist():
                scores = total[:, item]
                near = _kept(scores, first, top)
                if len(near):
                    old = best[item]
                    new = [np.r_[old[0], scores[near]], np.r_[old[1], first[near]],
                           np.r_[old[2], bag[near]]]
                    keep = _kept(new[0], new[1], top)
                    best[item] = tuple(x[keep] for x in new)
                    if len(keep) == top:
                        least[item] = new[0][keep[-1]]

        for batch in batches:
            # a bounded table of scores at a time
            for lo in range(0, batch.num_rows, max(1, 4_000_000 // max(1, n_items))):
                part = batch.slice(lo, max(1, 4_000_000 // max(1, n_items)))
                lists = part.column(3)
                sizes = np.diff(lists.offsets.to_numpy())
                take(part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2).to_numpy(),
                     np.repeat(np.arange(part.num_rows), sizes),
                     lists.flatten().to_numpy(), part.column(4).flatten().to_numpy())
        for item, (score, _, bag) in enumerate(best):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), item, np.int32)), pa.array(bag), pa.array(score)],
                    names=["item", "bag", "score"])

    return bags.select("bag", "first", "m", "terms", "tfs").mapInArrow(
        run, "item int, bag long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score, bag_size): the ``top`` best documents of
    each row of ``items`` (item_id, text); ``bag_size`` documents share the bag
    that scored."""
    total = items.select(F.sum(byte_size(items["text"]))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    out = None
    for block in range(blocks):
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        found = _block(docs, items.select("item_id", "text").filter(own), top)
        out = found if out is None else out.unionByName(found)
    return out


def _block(docs: DataFrame, items: DataFrame, top: int) -> DataFrame:
    spark = docs.sparkSession
    # at most block_bytes of text, or a single item
    rows = sorted(((r["item_id"], bytes(r["text"] or b"")) for r in items.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
        .collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    words = [_split(text) for _, text in rows]
    vocabulary = {t: i for i, t in enumerate(sorted({t for own in words for t in own}))}
    queries = [Counter(vocabulary[t] for t in own) for own in words]

    vectors = cut(_vectors(docs, vocabulary), "search-vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.lit(100 - LENGTH_PERCENT).cast("long") + F.expr(
        f"({LENGTH_PERCENT} * n * {n_docs}L) div {max(n_terms, 1)}L")
    with_m = vectors.filter("size(terms) > 0").select(
        "doc_id", m.alias("m"), "terms", "tfs").withColumn("hash", F.xxhash64("m", "terms", "tfs"))
    # met by their hash, told apart by the vectors themselves; null ids last
    last = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    bags = cut(with_m.groupBy("hash", "m", "terms", "tfs")
               .agg(F.count("*").alias("bag_size"), F.min(last).alias("first"))
               .withColumn("bag", F.monotonically_increasing_id()), "search-bags")
    df = {r["term"]: r["df"] for r in bags.select(F.explode("terms").alias("term"), "bag_size")
          .groupBy("term").agg(F.sum("bag_size").alias("df"))
          .withColumn("df", F.floor(1000 * F.ln((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))))
          .collect()}                       # one number per term of the vocabulary
    weights = np.array([df.get(i, 0) for i in range(len(vocabulary))], np.int64)

    best = Window.partitionBy("item").orderBy(F.desc("score"), "first")
    scored = cut(_scored(bags, weights, queries, top), "search-scores")
    winners = cut(scored.join(bags, "bag").withColumn("place", F.row_number().over(best))
                  .filter(F.col("place") <= top)
                  .select("item", "score", "bag", "bag_size", "hash", "m", "terms", "tfs"),
                  "search-winners")
    # members of the winning bags, the smallest ids of each
    wanted = winners.select("bag", "hash", "m", "terms", "tfs").distinct()
    first = Window.partitionBy("bag").orderBy("last")
    members = (with_m.select(last.alias("last"), "doc_id", "hash", "m", "terms", "tfs")
               .join(wanted, ["hash", "m", "terms", "tfs"]).select("bag", "last", "doc_id")
               .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= top)
               .select("bag", "last", "doc_id"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "last")
    names = spark.createDataFrame(
        pa.table({"item": pa.array(range(len(rows)), pa.int32()),
                  "item_id": pa.array([i for i, _ in rows], pa.int64())}))
    return (winners.select("item", "score", "bag", "bag_size").join(members, "bag")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .join(names, "item")
            .select("item_id", "rank", "doc_id", "score", "bag_size"))


#: The same by plain SQL, every document scored.
SEARCH_SQL = r"""
WITH letters AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS big, 'abcdefghijklmnopqrstuvwxyz' AS small),
d AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), big, small), '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
  FROM documents, letters),
totals AS (
  SELECT CAST(count(*) FILTER (WHERE len(terms) > 0) AS BIGINT) AS n_docs,
         CAST(greatest(sum(len(terms)), 1) AS BIGINT) AS n_terms FROM d),
q AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), big, small), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
        FROM benchmark, letters)
  GROUP BY ALL),
tf AS (
  SELECT row_id, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_id, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term),
scores AS (
  SELECT item, item_id, row_id, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) //
           (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), totals
  GROUP BY item, item_id, row_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (
        PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 10
"""
