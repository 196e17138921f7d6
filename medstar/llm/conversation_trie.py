"""Prefix trie of conversations by whole-sequence collapse.

Conversations are rebuilt first: conversation ``c`` begins with the first
``h`` turns of ``c - c % family`` (all if it has fewer, none if there is no
such conversation) and goes on with its own turns after its first ``h``, where
``h = crc32(decimal c) % (most + 1)``.

A trie node is a distinct sequence of first ``d`` turns (role, text), from the
textless root (``d = 0``).  Instead of inserting conversations one by one:

1. identical rebuilt conversations are grouped into weighted sequences, each
   with the list of conversations that end there;
2. sequences that are proper prefixes of others are dropped by an anti-join;
   what is left are the leaves;
3. the prefixes of the distinct sequences are aggregated by node, with the
   weights: members, leaves, smallest member, one leaf that stands for each
   node;
4. sums over subtrees: a node is counted at the leaf that stands for it.  The
   nodes of one leaf are the lower end of its path, so a running sum along the
   path and one sum per leaf for the nodes above give every subtree's sum
   without walking the tree level by level.

A turn is known by the MD5 of its role and text, a prefix by its depth and 128
bits: the exclusive or of two hashes of each turn and its place, which a
running aggregate can form.

Scale.  Only digests travel, texts stay where they are read.  Turns are put in
order by a range partitioning, so a conversation of any length is spread over
tasks; running aggregates along conversations work on segments of ``segment``
turns.  Copies are one row from the first aggregation on; every aggregate by
node (the root and common first turns hold most rows) is combinable.  Lists of
ends are joined in chunks of ``CHUNK`` ids, so the hash over a list, which has
to run from its first id to its last, streams over one row per chunk.

Defined results: a null role or text is empty; turns are ordered by turn (null
first), equal turns by the MD5 of role and text, repeated rows are turns of
their own; rows without a conv_id belong to no conversation and are left out;
other columns are not looked at; an empty table has no conversation and an
empty result.  ``%`` is SQL's: the remainder has the sign of conv_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medstar.llm.common import cut

FAMILY, MOST, SEGMENT, CHUNK = 5, 8, 4096, 4096
_NODE = ["depth", "p1", "p2"]


def turn_key(role: Column, text: Column) -> Column:
    """MD5 of a turn (hex): its role's length, its role and its text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def numbered(turns: DataFrame, **payload: Column) -> DataFrame:
    """(conv_id, pos, key) and the payload of every turn; ``pos`` counts from 0.

    Turns are dealt over ranges of (conversation, turn): a long conversation
    lies in several, whose rows are numbered apart and moved by the rows of the
    conversation in the ranges before.
    """
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        turn_key(F.col("role"), F.col("text")).alias("key"),
        *[c.alias(n) for n, c in payload.items()])
    rows = cut(rows.repartitionByRange("conv_id", "turn", "key")
               .withColumn("part", F.spark_partition_id()), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    # at most one conversation of a range began in an earlier one
    moved = (rows.groupBy("conv_id", "part").count()
             .withColumn("moved", F.sum("count").over(before)).filter("moved > 0")
             .select("conv_id", "part", "moved"))
    own = Window.partitionBy("conv_id", "part").orderBy("turn", "key")
    return (rows.withColumn("n", F.row_number().over(own))
            .join(moved, ["conv_id", "part"], "left")
            .select("conv_id", (F.col("n") - 1 + F.coalesce("moved", F.lit(0))).alias("pos"), "key",
                    *payload))


def rebuilt(turns: DataFrame, family: int = FAMILY, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, pos, ...) of numbered ones, and all conversations
    (conv_id, n) with their numbers of rebuilt turns."""
    c = F.col("conv_id")
    convs = cut(turns.groupBy("conv_id").agg(F.max("pos").alias("last"))
                .select("conv_id", (c - c % family).alias("base"),
                        (F.crc32(c.cast("string").cast("binary")) % (most + 1)).alias("h"),
                        (F.col("last") + 1).alias("own")), "conversations")
    bases = convs.filter("conv_id = base").select("base", F.col("own").alias("there"))
    plan = cut(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"),
        F.greatest(F.col("own") - F.col("h"), F.lit(0)).alias("rest")), "rebuild-plan")
    payload = [x for x in turns.columns if x not in ("conv_id", "pos")]
    heads = (turns.filter((F.col("conv_id") % family == 0) & (F.col("pos") < most))
             .withColumnRenamed("conv_id", "base")
             .join(plan.select("conv_id", "base", "taken").filter("taken > 0"), "base")
             .filter("pos < taken").select("conv_id", "pos", *payload))
    tails = (turns.join(plan.select("conv_id", "h", "taken"), "conv_id")
             .filter("pos >= h")
             .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), *payload))
    return heads.unionByName(tails), plan.select("conv_id", (F.col("taken") + F.col("rest")).alias("n"))


def _running(rows: DataFrame, owner: str, pos: str, fold, values: dict[str, str],
             zero: Column, plus, segment: int) -> DataFrame:
    """``rows`` with running aggregates (this row included) of the columns in
    ``values`` (new name: column) along ``owner`` by ``pos``, whatever an
    owner's number of rows: within segments, then over segments."""
    placed = rows.withColumn("__seg", F.floor(F.col(pos) / segment))
    totals = placed.groupBy(owner, "__seg").agg(*[fold(c).alias(f"__{n}") for n, c in values.items()])
    before = Window.partitionBy(owner).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (totals.withColumns({f"__{n}": fold(f"__{n}").over(before) for n in values})
             .filter("__seg > 0"))
    own = Window.partitionBy(owner, "__seg").orderBy(pos).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (placed.withColumns({n: fold(c).over(own) for n, c in values.items()})
            .join(ahead, [owner, "__seg"], "left")
            .withColumns({n: plus(F.col(n), F.coalesce(f"__{n}", zero)) for n in values})
            .drop("__seg", *[f"__{n}" for n in values]))


def _ends(members: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256): SHA-256 of the decimal ids of the
    conversations that end at a node, ascending, joined by commas."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by node and id; a node's ids leave in pieces of at most CHUNK
        node, ids = None, []
        for batch in batches:
            out = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for key, conv in zip(keys, batch.column(3).to_pylist()):
                if key != node or len(ids) == CHUNK:
                    if ids:
                        out.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = key, []
                ids.append(conv)
            yield _batch(out, chunk_types)
        if ids:
            yield _batch([(*node, ids[0], ",".join(map(str, ids)))], chunk_types)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for key, text in zip(keys, batch.column(4).to_pylist()):
                if key != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield _batch(out, hash_types)
        if node is not None:
            yield _batch([(*node, state.hexdigest())], hash_types)

    chunk_types = [("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
                   ("first", pa.int64()), ("ids", pa.string())]
    hash_types = [*chunk_types[:3], ("ends_sha256", pa.string())]
    order = [*_NODE, "conv_id"]
    pieces = (members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(chunks, "depth long, p1 long, p2 long, first long, ids string"))
    return (pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
            .mapInArrow(hashes, "depth long, p1 long, p2 long, ends_sha256 string"))


def _batch(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types)],
                                      names=[n for n, _ in types])


def trie(conversations: DataFrame, family: int = FAMILY, most: int = MOST,
         segment: int = SEGMENT) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the node's
    own ``bytes`` (of its last text) and ``n_ends``."""
    none = F.lit(0).cast("long")
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    turns = cut(numbered(conversations, bytes=size), "turns-numbered")
    rows, convs = rebuilt(turns, family, most)
    rows = cut(rows.select("conv_id", "pos", F.xxhash64(F.lit(1), "pos", "key").alias("r1"),
                           F.xxhash64(F.lit(2), "pos", "key").alias("r2"), "bytes"), "turns-rebuilt")
    # 1. whole sequences; a conversation may have no turn
    whole = rows.groupBy("conv_id").agg(F.bit_xor("r1").alias("p1"), F.bit_xor("r2").alias("p2"))
    members = cut(convs.join(whole, "conv_id", "left").select(
        "conv_id", F.col("n").cast("long").alias("depth"), F.coalesce("p1", none).alias("p1"),
        F.coalesce("p2", none).alias("p2")), "members")
    sequences = cut(members.groupBy(*_NODE).agg(
        F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")

    # the prefixes of one conversation of each sequence
    paths = rows.join(sequences.select("conv_id", "weight", F.col("depth").alias("n")), "conv_id")
    paths = _running(paths, "conv_id", "pos", F.bit_xor, {"p1": "r1", "p2": "r2"}, none,
                     lambda a, b: a.bitwiseXOR(b), segment)
    roots = sequences.select("conv_id", none.alias("depth"), none.alias("p1"), none.alias("p2"),
                             none.alias("q1"), none.alias("q2"), none.alias("bytes"), "weight",
                             F.col("depth").alias("n"))
    paths = cut(paths.select("conv_id", (F.col("pos") + 1).cast("long").alias("depth"), "p1", "p2",
                             F.col("p1").bitwiseXOR(F.col("r1")).alias("q1"),
                             F.col("p2").bitwiseXOR(F.col("r2")).alias("q2"),
                             "bytes", "weight", "n").unionByName(roots), "paths")

    # 2. leaves: sequences that no longer one begins with
    inner = paths.filter("depth < n").select(*_NODE).distinct()
    leaves = cut(sequences.join(inner, _NODE, "left_anti")
                 .select("conv_id", F.col("conv_id").alias("leaf")), "leaves")
    paths = cut(paths.join(leaves, "conv_id", "left"), "leaf-paths")

    # 3. nodes
    nodes = cut(paths.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"), F.min("leaf").alias("leaf"),
        F.max("bytes").alias("bytes"), F.max("q1").alias("q1"), F.max("q2").alias("q2"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "nodes")

    # 4. sums over subtrees
    of_leaf = cut(nodes.groupBy("leaf").agg(F.sum("saved").alias("total"),
                                            F.min("depth").alias("top")), "leaf-sums")
    along = _running(nodes.select("leaf", *_NODE, "saved", F.col("saved").alias("own")), "leaf",
                     "depth", F.sum, {"above": "saved"}, none, lambda a, b: a + b, segment)
    lower = along.join(of_leaf, "leaf").select(
        *_NODE, (F.col("total") - F.col("above") + F.col("own")).alias("amount"))
    upper = (paths.filter("leaf is not null").select("leaf", *_NODE).join(of_leaf, "leaf")
             .filter("depth < top and total > 0").select(*_NODE, F.col("total").alias("amount")))
    saved = lower.unionByName(upper).groupBy(*_NODE).agg(F.sum("amount").alias("saved_tokens"))
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"),
                           F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    ends = sequences.select(*_NODE, F.col("weight").alias("n_ends")).join(_ends(members), _NODE)
    nodes = nodes.join(parents, ["depth", "q1", "q2"], "left")
    return (nodes.join(saved, _NODE).join(children, _NODE, "left").join(ends, _NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs",
                    F.coalesce("n_children", none).alias("n_children"), "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
                    .alias("ends_sha256"), "bytes", F.coalesce("n_ends", none).alias("n_ends")))


def node_turns(nodes: DataFrame, conversations: DataFrame, family: int = FAMILY,
               most: int = MOST) -> DataFrame:
    """``nodes`` with the role and text of their last turn (root: null)."""
    text = lambda c: F.coalesce(c, F.lit(""))
    turns = cut(numbered(conversations, role=text("role"), text=text("text")), "turns-texts")
    rows = rebuilt(turns, family, most)[0].select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "role", "text")
    return nodes.join(rows, ["conv_id", "depth"], "left")


#: The same in SQL: prefixes as strings of digests, subtrees by their strings.
TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, octet_length(encode(coalesce(text, ''))) AS bytes, key,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS pos
  FROM (SELECT *, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
               AS key FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, count(*) AS own, conv_id - conv_id % 5 AS base,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                                           lambda x: ascii(x)::BIGINT)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                 lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 9 AS h
  FROM t GROUP BY conv_id),
plan AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.own, 0)) AS taken
  FROM c LEFT JOIN c AS b ON b.conv_id = c.base),
rebuilt AS (
  SELECT plan.conv_id, t.pos, t.key, t.bytes
  FROM plan JOIN t ON t.conv_id = plan.base AND t.pos < plan.taken
  UNION ALL
  SELECT plan.conv_id, t.pos - plan.h + plan.taken, t.key, t.bytes
  FROM plan JOIN t ON t.conv_id = plan.conv_id AND t.pos >= plan.h),
paths AS (
  SELECT conv_id, pos + 1 AS depth, bytes,
         string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY pos) AS path
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
last AS (
  SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id),
ends AS (
  SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM last GROUP BY path),
nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(bytes) AS bytes
  FROM paths GROUP BY path),
children AS (
  SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL),
sums AS (
  SELECT left(n.path, 32 * up.depth) AS path, sum((n_convs - 1) * bytes) AS saved_tokens,
         count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
  FROM nodes AS n LEFT JOIN children USING (path),
       LATERAL (SELECT unnest(range(n.depth + 1)) AS depth) AS up
  GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes AS n JOIN sums USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes AS p ON n.depth > 0 AND p.path = left(n.path, 32 * (n.depth - 1))
"""
