"""Star join of the patient fact with its dimensions.

A dimension whose size is bounded by definition (a code list, months of a
calendar) is broadcast.  Any other is left to the planner, which broadcasts it
only below ``spark.sql.autoBroadcastJoinThreshold`` bytes (by file statistics,
or at run time by AQE) and joins by sorting otherwise; no job runs while the
plan is built.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Dimension:
    """``df`` keyed by ``key``, joined on ``fact_key``.

    ``fixed=True`` declares a size bound by construction.
    """
    df: DataFrame
    key: str
    fact_key: str
    fixed: bool = False


# Prefix of stand-ins for keys that match nothing; no dimension key starts with it.
_NO_MATCH = "\u0000none:"


def spread_key(key: str, columns: list[str]) -> Column:
    """The key as text; where it is null or empty, which no dimension has, a
    stand-in that depends on the row.  It never matches either, but rows
    without a key spread over all partitions (retries see the same value)."""
    text = F.col(key).cast("string")
    own = F.concat(F.lit(_NO_MATCH), F.xxhash64(*[F.col(c) for c in columns]).cast("string"))
    return F.when(text.isNull() | (text == ""), own).otherwise(text)


def heavy_keys(fact: DataFrame, dims: list[Dimension], share: float = 0.005) -> dict[str, dict[str, int]]:
    """Fact keys of the dimensions that aren't fixed which more than ``share``
    of the facts have, and into how many parts of about that share each is to
    be dealt: ``{fact_key: {key: parts}}``.  Fewer than ``1 / share`` keys of a
    dimension can be in it, so it is small whatever the fact's size.  Counting
    reads the fact once, the key columns only; give it a stored one."""
    columns = [d.fact_key for d in dims if not d.fixed]
    if not columns:
        return {}
    pairs = fact.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("fact_key"), F.col(c).cast("string").alias("key")) for c in columns])).alias("x"))
    counts = pairs.groupBy("x.fact_key", "x.key").count()
    total = counts.groupBy("fact_key").agg(F.sum("count").alias("total"))
    found = (counts.join(F.broadcast(total), "fact_key")       # one row per dimension
             .filter(F.col("count") > share * F.col("total")).filter("key <> ''").collect())
    out: dict[str, dict[str, int]] = {}
    for r in found:
        parts = math.ceil(r["count"] / (share * r["total"]))
        out.setdefault(r["fact_key"], {})[r["key"]] = parts
    return out


def _parts(key: Column, heavy: dict[str, int]) -> Column:
    of = F.create_map(*[F.lit(x) for pair in sorted(heavy.items()) for x in pair])
    return F.coalesce(F.try_element_at(of, key), F.lit(1))


def dealt_key(key: Column, heavy: dict[str, int], columns: list[str]) -> Column:
    """The key of a fact with the number of its part, by a hash of the row."""
    part = F.pmod(F.xxhash64(F.lit("part"), *[F.col(c) for c in columns]), _parts(key, heavy))
    return F.concat(key, F.lit("\u0000"), part.cast("string"))


def star_join(fact: DataFrame, dims: list[Dimension], how: str = "left",
              heavy: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """Fact rows with the attributes of every dimension (key columns dropped).

    ``how='left'`` keeps fact rows whose key has no dimension row (the
    attributes are null); ``how='inner'`` drops them.  Keys of dimensions are
    neither null nor empty.  ``heavy``: hot keys to deal over parts, from
    ``heavy_keys``; others are left to AQE's skew-join handling.
    """
    out, columns = fact, fact.columns
    for d in dims:
        if d.fixed:
            side = F.broadcast(d.df)
            out = out.join(side, out[d.fact_key] == side[d.key], how).drop(side[d.key])
            continue
        tmp, hot = f"__join_{d.fact_key}", (heavy or {}).get(d.fact_key)
        key, side = spread_key(d.fact_key, columns), d.df.filter(F.col(d.key) != "")
        if hot:
            key, own = dealt_key(key, hot, columns), F.col(d.key).cast("string")
            side = side.withColumn(f"{tmp}_dim", F.explode(F.transform(
                F.sequence(F.lit(0), _parts(own, hot) - 1),
                lambda i: F.concat(own, F.lit("\u0000"), i.cast("string")))))
        left, of = out.withColumn(tmp, key), f"{tmp}_dim" if hot else d.key
        out = left.join(side, left[tmp] == side[of], how).drop(side[d.key]).drop(tmp, f"{tmp}_dim")
    return out
