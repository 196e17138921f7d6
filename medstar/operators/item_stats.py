"""Item statistics per paper and item (A2) for the item-index table.

Per ``(paper_code, create_time, item_id)``: max, min, mean, population
variance (fc), population standard deviation (bzc), difficulty (nandu =
mean / full mark) and discrimination (qufendu = (mean in the top group -
mean in the bottom group) / full mark).  Groups follow the usual 27 % rule on
the students' paper totals: ``percent_rank`` of the total within the paper
<= 0.27 is the bottom group, >= 0.73 the top group.

One pass over the raw scores, without a join: sums per student and item, the
student's total beside them (a window over one student's items), then sums per
total and item.  Ranks come from that small table (one row per distinct total
and item), never from a window over all students of a paper.

A student's answers are dealt to one task before they are summed: nothing is
gained by summing them where they are read, as a student answers an item once,
and the number of tasks follows the size of the files read, so that what one
task holds does not grow with them.

Sums of squares are decimals, so no number of answers overflows.  A statistic
that ``decimal(4,3)`` can't hold is null in the statistics and a row of
``item_rejects``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import fs

#: Bytes of input files behind one task's answers.
TASK_BYTES = 8 << 20
GROUP_SHARE = 0.27
STAT_TYPE = "decimal(4,3)"
PAPER = ["paper_code", "create_time"]
STATS = ["avg_score", "fc_score", "bzc_score", "nandu", "qufendu"]


def _round3(c):
    """Round half up to three decimals: ``floor(x * 1000 + 0.5) / 1000``."""
    return F.floor(c * 1000 + 0.5) / 1000


def _statistics(scores: DataFrame, full_mark: float) -> DataFrame:
    """``scores``: ``paper_code, create_time, student, item_id, score``; the
    statistics as rounded doubles."""
    sc = F.col("score").cast("bigint")
    wide = sc.cast("decimal(19,0)")
    spark = scores.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                -(-fs.total_size(spark, scores.inputFiles()) // TASK_BYTES))
    per_item = scores.repartition(parts, "student").groupBy(*PAPER, "student", "item_id").agg(
        F.count(sc).alias("n"), F.sum(sc).alias("s1"),
        F.sum((wide * wide).cast("decimal(28,0)")).alias("s2"),
        F.max(sc).alias("mx"), F.min(sc).alias("mn"))
    student = Window.partitionBy(*PAPER, "student")
    totals = per_item.select(
        "*", F.sum("s1").over(student).alias("total"),
        F.row_number().over(student.orderBy("item_id")).alias("nth"))
    # one row per distinct total and item; ``students`` is counted once each
    table = totals.groupBy(*PAPER, "total", "item_id").agg(
        F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"),
        F.max("mx").alias("mx"), F.min("mn").alias("mn"),
        F.count_if(F.col("nth") == 1).alias("students"))
    paper = Window.partitionBy(*PAPER)
    below = paper.orderBy("total").rangeBetween(Window.unboundedPreceding, -1)
    known = F.when(F.col("total").isNotNull(), F.col("students"))
    ranked = table.select(
        "*", F.coalesce(F.sum(known).over(below), F.lit(0)).alias("below"),
        F.sum("students").over(paper).alias("all"))
    pr = F.when(F.col("all") > 1, F.col("below") / (F.col("all") - 1)).otherwise(0.0)
    grp = F.when(F.col("total").isNull(), None).when(pr <= GROUP_SHARE, "low").when(
        pr >= 1 - GROUP_SHARE, "high")
    s = ranked.withColumn("grp", grp)

    def group_mean(name: str):
        g = F.col("grp") == name
        return F.sum(F.when(g, F.col("s1"))) / F.sum(F.when(g, F.col("n")))

    # whole-number sums: exact, so mean and variance are one correctly rounded
    # division each, whatever the order the partial sums arrive in
    stats = s.groupBy(*PAPER, "item_id").agg(
        F.max("mx").cast("int").alias("max_score"),
        F.min("mn").cast("int").alias("min_score"),
        F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"),
        ((group_mean("high") - group_mean("low")) / F.lit(full_mark)).alias("disc"))
    n, s1, s2 = (F.col(c).cast("decimal(18,0)") for c in ("n", "s1", "s2"))
    s2 = F.col("s2").cast("decimal(20,0)")
    avg = F.col("s1") / F.col("n")
    var = (n * s2 - s1 * s1).cast("double") / (n * n).cast("double")
    return stats.select(
        F.col("item_id").cast("int").alias("item_id"), "max_score", "min_score",
        _round3(avg).alias("avg_score"), _round3(var).alias("fc_score"),
        _round3(F.sqrt(var)).alias("bzc_score"), _round3(avg / F.lit(full_mark)).alias("nandu"),
        _round3(F.col("disc")).alias("qufendu"), *PAPER)


def item_statistics(scores: DataFrame, full_mark: float) -> DataFrame:
    """The item-index rows; a statistic out of ``decimal(4,3)`` is null here
    and listed by ``item_rejects``."""
    stats = _statistics(scores, full_mark)
    return stats.select(*[F.col(c).try_cast(STAT_TYPE).alias(c) if c in STATS else F.col(c)
                          for c in stats.columns])


def item_rejects(scores: DataFrame, full_mark: float) -> DataFrame:
    """(paper_code, create_time, item_id, field, value): statistics that the
    item-index table can't hold."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value"))
                               for c in STATS]))
    return (_statistics(scores, full_mark).select(*PAPER, "item_id", each.alias("x"))
            .select(*PAPER, "item_id", "x.field", "x.value")
            .filter(F.col("value").isNotNull() & F.col("value").try_cast(STAT_TYPE).isNull()))
