"""Mixing sources to target weights by Pfair scheduling.

Time is a sequence of slots; a slot holds one block of ``block_bytes`` bytes
of one source.  The ``j``-th block of a source of weight ``w`` is released at
slot ``floor(j / w)`` and due by slot ``ceil((j + 1) / w)``; each slot goes to
the released block with the earliest deadline.  With weights that sum to one
every block meets its window, so after any number ``t`` of slots each source
has had ``w * t`` blocks, less or more than one block apart (Baruah et al.,
"Proportionate progress", 1996).

Weights are whole multiples of ``1 / PERIOD``, a rounding of 2**-52 that stays
far below one block over any mix, and the schedule runs over the whole mix: no
part of it is repeated, so no error adds up.  It is worked out on the driver,
one source number per slot, and meets the documents as a table of one row per
slot.  A block is ``BLOCK_BYTES`` or, if the mix would take more than ``SLOTS``
blocks of that size, the ``SLOTS``-th part of the mix: the driver's work is
bounded whatever the data's size, and the deviation stays below a millionth of
the mix.  Documents get their block from their source's running total of bytes:
documents are dealt over small buckets by a hash of their id and text, totals
of buckets give each bucket its start, and only a bucket is ever sorted in one
task, however large a source is.

``until="all"``: the mix is as long as it takes for every source to be used
whole; sources that end earlier begin again (``epoch``), none of their rows is
lost.  ``until="first"``: the mix ends where the first source ends.

Weights: a dict (other sources are left out), or by default the sources' bytes
to the power ``temperature``.

Defined results: a null source is a source of its own; a null text has 0 bytes
and counts, like every row, as one byte more; repeated rows are rows, one after
another in the mix; rows with equal or null ids stand by their texts; a
document longer than a block takes several slots and is placed in its first;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medstar.llm.common import byte_size, cut, packed, unpacked

PERIOD, BLOCK_BYTES, TEMPERATURE, BUCKET_ROWS = 1 << 52, 64 << 10, 0.8, 20_000
SLOTS, BROADCAST_SLOTS = 1_000_000, 2_000_000


def shares(weights: dict, period: int) -> dict:
    """Weights as whole numbers of slots of a period, at least one each, by
    the largest remainder."""
    period = max(period, 4 * len(weights))
    total = sum(weights.values())
    exact = {k: w / total * period for k, w in weights.items()}
    out = {k: max(1, int(x)) for k, x in exact.items()}
    order = sorted(exact, key=lambda k: (int(exact[k]) - exact[k], str(k)))
    while (left := period - sum(out.values())) > 0:
        for k in order[:left]:
            out[k] += 1
    while (over := sum(out.values()) - period) > 0:
        for k in sorted((k for k in out if out[k] > 1), key=lambda k: (exact[k] - out[k], str(k)))[:over]:
            out[k] -= 1
    return out


def dealt(share: dict) -> Iterator[int]:
    """The source of each slot without end, earliest deadline first, as its
    place in ``names_of(share)``."""
    period, counts = sum(share.values()), [share[k] for k in names_of(share)]
    released: list[tuple[int, int, int]] = []
    waiting = [(0, i, 0) for i in range(len(counts))]         # release, source, block
    heapq.heapify(waiting)
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(released, (-(-(j + 1) * period // counts[i]), i, j))
        due, i, j = heapq.heappop(released)
        assert t < due, "weights of more than one"
        yield i
        heapq.heappush(waiting, ((j + 1) * period // counts[i], i, j + 1))
        t += 1


def names_of(share: dict) -> list:
    return sorted(share, key=lambda k: (k is None, str(k)))


def schedule(share: dict) -> list:
    """The source of each slot of one period."""
    names = names_of(share)
    return [names[i] for i in islice(dealt(share), sum(share.values()))]


def _starts(rows: DataFrame) -> tuple[DataFrame, list]:
    """``rows`` (with __id, __key, __source, __size) with __start, the bytes of
    their source before them, and the sources' sizes."""
    rows = rows.withColumn("__hash", F.xxhash64("__id", "__key"))
    buckets = max(1, math.ceil(rows.count() / BUCKET_ROWS))
    rows = rows.withColumn("__bucket", F.pmod(F.col("__hash"), F.lit(buckets)))
    sums = rows.groupBy("__source", "__bucket").agg(F.sum("__size").alias("bytes"))
    before = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    starts = cut(sums.withColumn("from", F.sum("bytes").over(before) - F.col("bytes")),
                 "mix-starts")
    sizes = starts.groupBy("__source").agg(F.sum("bytes").alias("bytes")).collect()
    # row by row: equal rows follow each other
    own = Window.partitionBy("__source", "__bucket").orderBy(
        "__hash", "__id", "__key", "__size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = (rows.alias("r").join(
        starts.select(F.col("__source").alias("s"), F.col("__bucket").alias("b"), "from"),
        F.col("__source").eqNullSafe(F.col("s")) & (F.col("__bucket") == F.col("b")))
        .withColumn("__start", F.sum("__size").over(own) - F.col("__size") + F.col("from")))
    return at.drop("s", "b", "from", "__hash", "__bucket", "__key"), sizes


def mix(docs: DataFrame, weights: dict | None = None, source_col: str = "source",
        temperature: float = TEMPERATURE, block_bytes: int | None = None, period: int = PERIOD,
        until: str = "all") -> DataFrame:
    """(id, source, size, epoch, block, slot, start): every row of ``docs`` once
    in each epoch in which it is mixed; ``start``: bytes of its source before
    it.  Slots ascend through the mix, ``(slot, start)`` orders the rows."""
    rows = docs.select(
        F.col("doc_id").alias("__id"), F.col(source_col).cast("string").alias("__source"),
        (byte_size(docs["text"]) + 1).alias("__size"), F.xxhash64(docs["text"]).alias("__key"))
    at, sizes = _starts(cut(rows, "mix-rows"))
    plan = _plan(sizes, weights, temperature, block_bytes, period, until)
    return _slots(docs.sparkSession, at, plan).select(
        F.col("__id").alias("doc_id"), F.col("__source").alias("source"),
        F.col("__size").alias("size"), F.col("__epoch").alias("epoch"),
        F.col("__block").alias("block"), F.col("__slot").alias("slot"),
        F.col("__start").alias("start"))


def _plan(sizes: list, weights: dict | None, temperature: float, block_bytes: int | None,
          period: int, until: str) -> dict | None:
    size = {r["__source"]: r["bytes"] for r in sizes}
    if weights is None:
        weights = {k: n ** temperature for k, n in size.items()}
    weights = {k: w for k, w in weights.items() if w > 0 and size.get(k)}
    if not weights:
        return None
    share = shares(weights, period)
    if block_bytes is None:
        whole = max if until == "all" else min                  # bytes of the mix
        mixed = whole(size[k] * sum(share.values()) // n for k, n in share.items())
        block_bytes = max(BLOCK_BYTES, -(-mixed // SLOTS))
    names = names_of(share)
    blocks = [-(-size[k] // block_bytes) for k in names]
    left, open_sources, order = list(blocks), len(blocks), array("i")
    for i in dealt(share):
        order.append(i)
        left[i] -= 1
        if left[i] == 0:
            open_sources -= 1
            if until != "all" or not open_sources:
                break
    return {"names": names, "blocks": blocks, "block_bytes": block_bytes, "order": np.frombuffer(order, np.int32)}


def _slots(spark, at: DataFrame, plan: dict | None) -> DataFrame:
    if plan is None:
        return at.limit(0).withColumns(
            {c: F.lit(0).cast("long") for c in ("__epoch", "__slot", "__block")})
    at = at.withColumn("__block", F.expr(f"__start div {plan['block_bytes']}L"))
    source = plan["order"]
    # the block of its source that a slot holds, counted through the epochs
    slot = np.argsort(source, kind="stable")
    counts = np.bincount(source, minlength=len(plan["names"]))
    j = np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts, counts)
    blocks = np.repeat(np.array(plan["blocks"], np.int64), counts)
    table = spark.createDataFrame(pa.table({
        "s": pa.array(plan["names"], pa.string()).take(pa.array(source[slot])),
        "b": j % blocks, "__epoch": j // blocks, "__slot": slot}))
    if len(source) <= BROADCAST_SLOTS:
        table = F.broadcast(table)
    return at.join(table, F.col("__source").eqNullSafe(F.col("s"))
                   & (F.col("__block") == F.col("b"))).drop("s", "b")


def mixed_documents(docs: DataFrame, weights: dict | None = None, source_col: str = "source",
                    temperature: float = TEMPERATURE, block_bytes: int | None = None,
                    period: int = PERIOD, until: str = "all") -> DataFrame:
    """The documents themselves in the order of the mix: range-partitioned and
    sorted by slot, a document as often as it has epochs."""
    size = byte_size(docs["text"]) + 1
    source = docs[source_col].cast("string")
    rows = packed(docs, __id=docs["doc_id"], __source=source, __size=size,
                  __key=F.xxhash64(docs["text"]))
    # the numbers first: texts travel once, with their slot
    at, sizes = _starts(rows)
    plan = _plan(sizes, weights, temperature, block_bytes, period, until)
    mixed = _slots(docs.sparkSession, at, plan)
    return (mixed.repartitionByRange("__slot", "__start").sortWithinPartitions("__slot", "__start")
            .select(*unpacked(mixed, docs.columns)))
