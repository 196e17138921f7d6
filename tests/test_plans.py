"""Scale properties of the contract plans (physical plans at sf0.001)."""

import contextlib
import io
import re

import __spark_entry__ as E
from tests.conftest import SF_SMALL, above_broadcasts


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_extract_parses_each_document_once(spark):
    plan = _plan(E.queries()["fact_extract"](spark, SF_SMALL))
    assert plan.count("ArrowEvalPython") == 1


def test_star_join_broadcasts_bounded_dimensions(spark):
    plan = _plan(E.queries()["star_join"](spark, SF_SMALL))
    assert plan.count("ArrowEvalPython") == 1
    # six dimensions, all proven small at this scale
    assert plan.count("BroadcastHashJoin") >= 6


def test_range_scan_pushes_bounds_and_does_not_shuffle(spark):
    df = E.queries()["range_scan"](spark, SF_SMALL)
    plan = _plan(df)
    assert "GreaterThanOrEqual(row_key,RN32_001)" in plan
    assert "LessThan(row_key,RN33_001)" in plan
    df.collect()
    # as it ran, keys with one row apart from the bitmap of the others
    assert not [x for x in above_broadcasts(df) if "Shuffle" in x or "Aggregate" in x]
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "content" not in read                       # only the asked cells are read


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_cube_query_reads_one_cuboid(spark):
    df = E.queries()["cube_query"](spark, SF_SMALL)
    text = _formatted(df)
    # group by (gender, age) with a filter on class needs all three
    # dimensions: cuboid 0, and only its folder is read; the class filter
    # reaches the Parquet scan
    assert "PartitionFilters: [isnotnull(gid" in text and "= 0)]" in text
    assert "PushedFilters: [In(inClassId, [KS01,KS02,KS03])]" in text


def test_ingest_parses_and_writes_once(spark, monkeypatch):
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "persist", None)
    monkeypatch.setattr(DataFrame, "cache", None)
    got = {r["row_key"]: r["outcome"] for r in E.queries()["directory_ingest"](spark, SF_SMALL).collect()}
    assert set(got.values()) == {"good", "rejected"}


def test_a_filter_on_the_key_goes_below_the_parse(spark):
    from medstar.plans import jobs

    df = jobs.fact_job(E._ingested(spark, SF_SMALL)).filter("row_key = 'RN32_005'")
    plan = _formatted(df)
    # rows of one key and of several are parsed apart, each of them once
    assert "EqualTo(row_key,RN32_005)" in plan and _plan(df).count("ArrowEvalPython") == 2


def test_item_statistics_scan_the_scores_once(spark):
    plan = _plan(E.queries()["item_stats"](spark, SF_SMALL))
    assert plan.count("lineitem.parquet") == 1 and "l_quantity" in plan


def test_rejected_statistics_of_huge_counts(spark):
    from pyspark.sql import functions as F
    from medstar.operators.item_stats import item_rejects, item_statistics

    many = spark.range(2).select(
        F.lit("P").alias("paper_code"), F.lit("y").alias("create_time"), F.col("id").alias("student"),
        F.lit(1).alias("item_id"), (F.col("id") * 2_000_000_000).alias("score"))
    row = item_statistics(many, 2.5e9).first()
    assert row["avg_score"] is None and float(row["nandu"]) == 0.4
    assert {r["field"] for r in item_rejects(many, 2.5e9).collect()} == {
        "avg_score", "fc_score", "bzc_score"}


def test_item_statistics_deal_students_over_tasks_that_follow_the_input(spark, monkeypatch):
    """One task's answers are bounded by the size of the files read."""
    import os

    from medstar.operators import item_stats
    from medstar.sources import fs

    files = [f"{SF_SMALL}/{t}.parquet" for t in ("lineitem", "orders")]
    size = sum(os.path.getsize(f) for f in files)
    assert fs.total_size(spark, E._scores(spark, SF_SMALL).inputFiles()) == size
    monkeypatch.setattr(item_stats, "TASK_BYTES", size // 20)
    plan = _formatted(E.queries()["item_stats"](spark, SF_SMALL))
    found = [int(n) for n in re.findall(r"hashpartitioning\(student[^)]*?, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert found and found[0] >= 20
    # answers aren't summed before they are dealt
    assert plan.count("student") > 0 and "partial_count" in plan


def test_documents_are_dealt_by_order_however_customers_are_joined(spark):
    from medstar.sources.seed import order_documents
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        docs = order_documents(spark, SF_SMALL)
        assert docs.rdd.getNumPartitions() == 7             # not fewer, with more documents each
        largest = max(docs.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
        assert largest < docs.count() / 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_ingest_does_not_sort_documents_by_outcome(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def recorded(self, path, *args, **kwargs):
        seen.append(spark.conf.get(key))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    before = spark.conf.get(key)
    E._ingested(spark, SF_SMALL)
    assert seen == ["2"] and spark.conf.get(key) == before


def test_documents_not_read_in_the_jvm_are_not_looked_at_there(spark):
    from medstar.operators import extract
    docs = spark.createDataFrame([("a", "<!-- no --><a/>")], "path string, content string")
    parsed = extract.parse_fact(docs, keep=("path",), engine="jvm")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"explode\(array\(CASE WHEN isnotnull\(_s#\d+\) THEN struct\(regular", plan)
