"""Cuboids by roll-up from parent cuboids (A3).

``cube()`` and ``groupingSets`` copy every raw row once per grouping before
they aggregate.  Here the raw rows are aggregated once, by the finest grouping;
every other cuboid is derived from the smallest cuboid already computed that
holds its columns, with the measures' merge functions.  Cuboids of as many
columns are one level and one job: a level reads the rows of its parents (an
order of magnitude fewer than the raw rows as a rule), copies each for the
children that were assigned to it, and aggregates.

The driver holds one line per cuboid: its parent and its number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gid_of(dimensions: Sequence[str], grouped: Sequence[str]) -> int:
    """``grouping_id()`` of a grouping: bit set for every dimension not grouped,
    first dimension = highest bit."""
    n = len(dimensions)
    return sum(1 << (n - 1 - i) for i, d in enumerate(dimensions) if d not in grouped)


def every_set(dimensions: Sequence[str]) -> list[list[str]]:
    """All 2^d groupings."""
    n = len(dimensions)
    return [[d for i, d in enumerate(dimensions) if mask >> (n - 1 - i) & 1]
            for mask in range(2 ** n)]


def smallest_parent(child: frozenset, sizes: dict[frozenset, int]) -> frozenset:
    """Of the computed groupings that hold the child's columns the one with the
    fewest rows."""
    return min((s for s in sizes if child < s), key=lambda s: (sizes[s], len(s), sorted(s)))


def derived(parents: DataFrame, children: dict[int, list[int]], dims: Sequence[str],
            keys: Sequence[str], merge: Sequence[Column]) -> DataFrame:
    """(keys, gid, dims, measures) of the cuboids ``children`` (parent's gid:
    its children's) from the rows of their parents."""
    n = len(dims)
    gids = [(F.lit(gid).cast("bigint"), F.array(*[F.lit(c).cast("bigint") for c in own]))
            for gid, own in children.items()]
    of = F.create_map(*[x for pair in gids for x in pair])
    rows = parents.filter(F.col("gid").isin(*children)).withColumn(
        "gid", F.explode(of[F.col("gid")]))
    rows = rows.withColumns({d: F.when(F.col("gid").bitwiseAND(F.lit(1 << (n - 1 - i))) == 0, F.col(d))
                             for i, d in enumerate(dims)})
    return rows.groupBy(*keys, "gid", *dims).agg(*merge)


def roll_up(finest: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]],
            merge: Sequence[Column], store: Callable[[DataFrame], DataFrame],
            keys: Sequence[str] = ()) -> None:
    """Computes the cuboids ``sets``, level by level.

    ``finest``: rows (keys, dims, measures) of the finest grouping, all columns
    of ``sets`` (others are null).  ``store`` writes the cuboids of a level,
    rows (keys, gid, dims, measures), and returns all that it has written.
    """
    wanted = {frozenset(s) for s in sets}
    top = frozenset().union(*wanted)
    written = store(finest.withColumn("gid", F.lit(gid_of(dims, top)).cast("bigint")))

    def rows_of(groupings: list[frozenset]) -> dict[frozenset, int]:
        by = {gid_of(dims, g): g for g in groupings}
        found = {r["gid"]: r["count"] for r in written.filter(F.col("gid").isin(*by))
                 .groupBy("gid").count().collect()}              # one row per cuboid
        return {g: found.get(gid, 0) for gid, g in by.items()}

    sizes = rows_of([top])
    for width in range(len(top) - 1, -1, -1):
        level = [s for s in wanted if len(s) == width]
        if not level:
            continue
        children: dict[int, list[int]] = {}
        for s in sorted(level, key=sorted):
            parent = gid_of(dims, smallest_parent(s, sizes))
            children.setdefault(parent, []).append(gid_of(dims, s))
        written = store(derived(written, children, dims, keys, merge))
        if width:                                                # nothing is below the total
            sizes |= rows_of(level)
