"""Sharding by k-d tree partitioning.

Rows lie in a space of metadata dimensions (text length, language, source); a
text dimension counts by the rank of its value among the table's values.
The tree splits a node across its widest dimension at the weighted median of
bytes, so that both sides hold bytes in proportion to their leaves, until a
leaf holds the target bytes; leaves are the shards.  Coordinates end in bits
of a hash of the text, so any dimension can be split anywhere.

Equal texts are one point of the space and share a shard.  Only a group of
copies larger than a whole shard is dealt over several points by numbers given
to its rows where they are read, so rows without an id, or with equal ids, are
dealt as well.
Heavy points, above ``1 / HEAVY`` of a shard (so at most ``HEAVY`` per shard),
would make a median miss its goal; they are handed to the side with more room
first, and the light points are split at the weighted median that evens this
out.  Shards are then equal up to ``1 / HEAVY`` of their size or one text.

Medians are distributed: a histogram of weights per node over ``BINS`` bins,
refined within the bin that holds the median until that bin is negligible.
Only numbers per node (at most the number of shards, the bound of what is
broadcast and of what reaches the driver) are handled outside Spark; a row
carries its id, size and key through the tree, never its text.

Defined results: a null text is an empty one; null metadata is smallest;
repeated rows are rows (of one group); missing dimensions are left out; an
empty table gives an empty result; ids may be null or equal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medstar.llm.common import byte_size, cut, packed, text_key, unpacked

BINS, HEAVY, CODE_BITS, HASH_BITS, SLOT_ROWS = 4096, 16, 22, 40, 20_000


def _ranks(values: DataFrame) -> DataFrame:
    """(value, rank) of the distinct values of a one-column table, null apart:
    ranges of values are numbered on their own and moved by the ranges before."""
    placed = cut(values.toDF("value").filter("value is not null").distinct()
                 .repartitionByRange("value").withColumn("part", F.spark_partition_id()), "kd-values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    moved = placed.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("moved"))
    own = Window.partitionBy("part").orderBy("value")
    return placed.withColumn("n", F.row_number().over(own)).join(F.broadcast(moved), "part").select(
        "value", (F.col("n") + F.col("moved")).cast("double").alias("rank"))


def _is_number(docs: DataFrame, name: str) -> bool:
    return docs.schema[name].dataType.typeName() in (
        "byte", "short", "integer", "long", "float", "double", "decimal")


def _rows(docs: DataFrame, id_col: str, text_col: str, dims: list[str]) -> DataFrame:
    """(id, row, size, crc, key, x0, ...): ``row`` is a number of the row."""
    text = docs[text_col]
    own = {c: docs[c].cast("double" if _is_number(docs, c) else "string") for c in dims}
    rows = cut(docs.select(
        docs[id_col].alias("id"), F.monotonically_increasing_id().alias("row"),
        (byte_size(text) + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        text_key(text).alias("key"), F.log2(byte_size(text) + 1).alias("x0"),
        *[c.alias(f"x{i}") for i, c in enumerate(own.values(), 1)]), "kd-rows")
    for i, c in enumerate(dims, 1):
        if not _is_number(docs, c):
            ranks = cut(_ranks(rows.select(f"x{i}")), "kd-ranks").withColumnRenamed("value", "of")
            # null is smallest
            rows = rows.join(ranks, rows[f"x{i}"] == ranks["of"], "left").withColumn(
                f"x{i}", F.coalesce("rank", F.lit(0.0))).drop("of", "rank")
    return rows


def _large(rows: DataFrame, share: float) -> DataFrame:
    """(of, parts): groups of copies larger than a shard (so fewer than there
    are shards), and how many parts of about ``1 / HEAVY`` of a shard they make."""
    return (rows.groupBy(F.col("key").alias("of")).agg(F.sum("size").alias("w"))
            .filter(F.col("w") > share)
            .select("of", F.ceil(F.col("w") * HEAVY / share).cast("int").alias("parts")))


def _part(row: str, parts: str) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(row), F.col(parts)).cast("int"), F.lit(0))


def _parted(rows: DataFrame, share: float) -> DataFrame:
    """``rows`` with ``part``: 0, or for a large group the part of the row's
    number."""
    return rows.join(F.broadcast(_large(rows, share)), rows["key"] == F.col("of"), "left").withColumn(
        "part", _part("row", "parts")).drop("of", "parts")


def _points(rows: DataFrame, width: int) -> DataFrame:
    """One row per text (or part of a large group): key, part, w, coordinates."""
    texts = rows.groupBy("key", "part").agg(F.sum("size").alias("w"), *[
        F.min(f"x{i}").alias(f"x{i}") for i in range(width)])
    ends = rows.agg(*[f(f"x{i}").alias(f"{n}{i}") for i in range(width)
                      for n, f in (("lo", F.min), ("hi", F.max))]).first()
    tail = F.shiftrightunsigned(F.xxhash64("key", "part"), 64 - HASH_BITS)
    keys = []
    for i in range(width):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        scale = (2 ** CODE_BITS - 1) / (hi - lo) if lo is not None and hi > lo else 0.0
        code = F.coalesce((F.col(f"x{i}") - F.lit(lo or 0.0)) * scale, F.lit(0.0))
        keys.append((F.floor(code).cast("long") * (1 << HASH_BITS) + tail).alias(f"k{i}"))
    return texts.select("key", "part", "w", *keys)


def _median(points: DataFrame, goal: dict, tolerance: float) -> dict:
    """For each node the key below which its goal (a weight) lies."""
    spark = points.sparkSession
    lo_hi = {n: (lo, hi, g, 0.0) for n, (_, lo, hi, g) in goal.items()}
    out: dict = {}
    while lo_hi:
        table = spark.createDataFrame(
            [(n, goal[n][0], lo, hi, -(-(hi - lo + 1) // BINS), g, below)
             for n, (lo, hi, g, below) in lo_hi.items()],
            "node long, dim int, lo long, hi long, step long, goal double, below double")
        width = sum(c.startswith("k") and c != "key" for c in points.columns)
        value = F.element_at(F.array(*[F.col(f"k{i}") for i in range(width)]), F.col("dim") + 1)
        bins = (points.join(F.broadcast(table), "node").withColumn("v", value)
                .filter("v >= lo and v <= hi")
                .groupBy("node", "lo", "step", "goal", "below",
                         F.floor((F.col("v") - F.col("lo")) / F.col("step")).alias("bin"))
                .agg(F.sum("w").alias("w"), F.min("v").alias("least"), F.max("v").alias("most")))
        run = Window.partitionBy("node").orderBy("bin")
        cross = (bins.withColumn("sum", F.sum("w").over(run) + F.col("below"))
                 .filter("sum >= goal")
                 .groupBy("node").agg(F.min(F.struct("bin", "w", "sum", "least", "most")).alias("c"))
                 .select("node", "c.*").collect())
        seen = set()
        for r in cross:
            n = r["node"]
            seen.add(n)
            goal_, below = lo_hi[n][2], r["sum"] - r["w"]
            if r["w"] <= tolerance or r["least"] == r["most"]:
                # the bin goes to the side that brings the cut nearer the goal
                out[n] = r["most"] + 1 if r["sum"] - goal_ <= goal_ - below else r["least"]
                del lo_hi[n]
            else:
                lo_hi[n] = (r["least"], r["most"], goal_, below)
        for n in set(lo_hi) - seen:                 # rounding of sums: everything is below
            out[n] = lo_hi.pop(n)[1] + 1
    return out


def _room(heavy: dict, room: dict) -> dict:
    """Heavy points of a node, each to the side with more room left."""
    out = {}
    for k, w in sorted(heavy.items(), key=lambda x: (-x[1], x[0])):
        side = max(room, key=lambda s: (room[s], -s))
        room[side] -= w
        out[k] = side
    return out


def tree(points: DataFrame, shards: int, share: float) -> DataFrame:
    """(key, part, shard)."""
    spark = points.sparkSession
    width = sum(c.startswith("k") and c != "key" for c in points.columns)
    points = cut(points, "kd-points")
    heavy = {(bytes(r["key"]), r["part"]): r["w"] for r in
             points.filter(F.col("w") > share / HEAVY).select("key", "part", "w").collect()}
    at = dict.fromkeys(heavy, 0)                               # node of each heavy point
    light = points.filter(F.col("w") <= share / HEAVY).withColumn("node", F.lit(0).cast("long"))
    leaves = {0: (0, shards)}                                  # node: first shard, shards
    while any(n > 1 for _, n in leaves.values()):
        stats = {r["node"]: r for r in light.groupBy("node").agg(F.sum("w").alias("w"), *[
            f(f"k{i}").alias(f"{s}{i}") for i in range(width)
            for s, f in (("lo", F.min), ("hi", F.max))]).collect()}
        members: dict = {}
        for k, node in at.items():
            members.setdefault(node, {})[k] = heavy[k]
        goal, new = {}, {}
        for node, (first, n) in leaves.items():
            if n == 1:
                new[node] = first, 1
                continue
            r, own = stats.get(node), members.get(node, {})
            left, right, half = 2 * node + 1, 2 * node + 2, n // 2
            new[left], new[right] = (first, half), (first + half, n - half)
            total = sum(own.values()) + (r["w"] if r else 0)
            room = {left: total * half / n, right: total * (n - half) / n}
            at.update(_room(own, room))
            if r:
                wide = max(range(width), key=lambda i: (
                    (r[f"hi{i}"] >> HASH_BITS) - (r[f"lo{i}"] >> HASH_BITS), -i))
                goal[node] = (wide, r[f"lo{wide}"], r[f"hi{wide}"],
                              float(min(max(room[left], 0), r["w"])))
        cuts = _median(light, goal, share / 1000)
        move = spark.createDataFrame([(k, goal[k][0], cuts[k]) for k in cuts],
                                     "node long, dim int, cut long")
        value = F.element_at(F.array(*[F.col(f"k{i}") for i in range(width)]), F.col("dim") + 1)
        light = cut(light.join(F.broadcast(move), "node", "left").withColumn(
            "node", F.when(F.col("cut").isNull(), F.col("node"))
            .when(value < F.col("cut"), F.col("node") * 2 + 1).otherwise(F.col("node") * 2 + 2))
            .drop("dim", "cut"), "kd-points")
        leaves = new
    names = spark.createDataFrame([(k, f) for k, (f, _) in leaves.items()], "node long, shard int")
    placed = spark.createDataFrame([(bytearray(k), p, leaves[n][0]) for (k, p), n in at.items()],
                                   "key binary, part int, shard int")
    return (light.join(F.broadcast(names), "node").select("key", "part", "shard")
            .unionByName(placed))


def _where(rows: DataFrame, width: int, shards: int | None,
           target_bytes: int | None) -> tuple[DataFrame, float]:
    total = rows.agg(F.sum("size")).first()[0] or 0
    shards = shards or max(1, math.ceil(total / (target_bytes or 256 << 20)))
    share = max(1.0, total / shards)
    points = _points(_parted(rows, share), width)
    return cut(tree(points, shards, share), "kd-shards"), share


def shard_table(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
                dims: tuple[str, ...] = ("lang", "source"), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): size is the
    text's UTF-8 bytes plus one; ``slot`` numbers the rows of a shard from 0."""
    dims_ = [c for c in dims if c in docs.columns]
    rows = cut(_rows(docs, id_col, text_col, dims_), "kd-ranked")
    where, share = _where(rows, len(dims_) + 1, shards, target_bytes)
    placed = cut(_parted(rows.select("id", "row", "size", "crc", "key"), share)
                 .join(where, ["key", "part"]), "kd-placed")
    n = placed.count()
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("row"),
                                                F.lit(max(1, math.ceil(n / SLOT_ROWS)))))
    # slots: small buckets are numbered, the buckets before give the start
    counts = placed.groupBy("shard", "bucket").count()
    run = Window.partitionBy("shard").orderBy("bucket")
    starts = counts.select("shard", "bucket", (F.sum("count").over(run) - F.col("count")).alias("from"))
    own = Window.partitionBy("shard", "bucket").orderBy("row")
    return (placed.join(starts, ["shard", "bucket"])
            .withColumn("slot", F.col("from") + F.row_number().over(own) - 1)
            .select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"),
                    F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def sharded_documents(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
                      dims: tuple[str, ...] = ("lang", "source"), shard_col: str = "shard") -> DataFrame:
    """The documents with their shard (a column of that name is replaced)."""
    dims_ = [c for c in dims if c in docs.columns]
    rows = cut(_rows(docs, "doc_id", "text", dims_), "kd-ranked")
    where, share = _where(rows, len(dims_) + 1, shards, target_bytes)
    # texts are joined by key, with the parts of their group (at most HEAVY for
    # each shard); a part that is not there because the rows are numbered
    # otherwise than before is another one
    shards_of = (where.groupBy(F.col("key").alias("__of")).agg(F.sort_array(F.collect_list(
        F.struct("part", "shard"))).alias("__shards"))
        .join(F.broadcast(_large(rows, share)), F.col("__of") == F.col("of"), "left")
        .select("__of", "__shards", F.col("parts").alias("__parts")))
    whole = packed(docs, __key=text_key(docs["text"]), __n=F.monotonically_increasing_id())
    out = whole.join(shards_of, F.col("__key") == F.col("__of"))
    part = F.try_element_at(F.map_from_entries("__shards"), _part("__n", "__parts"))
    other = F.get("__shards", F.pmod(F.col("__n"), F.size("__shards")).cast("int"))["shard"]
    keep = [c for c in docs.columns if c != shard_col]
    return out.select(*unpacked(out, keep), F.coalesce(part, other).alias(shard_col))
