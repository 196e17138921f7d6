import uuid

import pytest
from pyspark.sql import functions as F

from medstar.operators.wide_table import WideTable, table_exists
from tests.conftest import above_broadcasts


def _t(spark):
    return WideTable.create(spark, f"wt_{uuid.uuid4().hex[:8]}")


def _rows(spark, data):
    return spark.createDataFrame(data, "k string, title string, content string")


def test_latest_cell_wins_and_rerun_is_idempotent(spark):
    t = _t(spark)
    assert table_exists(spark, t.name)
    b1 = t.cells(_rows(spark, [("RN32_001", "a", "x"), ("RN32_002", "b", "y")]), "k",
                 {"specific:title": "title", "specific:content": "content"})
    t.put(b1, 1)
    t.put(b1, 1)                                  # rerun of the same batch
    assert t.log().count() == 2
    b2 = t.cells(_rows(spark, [("RN32_001", "a2", None)]), "k",
                 {"specific:title": "title", "specific:content": "content"})
    t.put(b2, 2)
    got = {r["row_key"]: (r["specific"]["title"], r["specific"]["content"])
           for r in t.latest(["specific:title", "specific:content"]).collect()}
    # the newer batch left content unwritten: the older cell stays
    assert got == {"RN32_001": ("a2", "x"), "RN32_002": ("b", "y")}


def test_single_cell_puts(spark):
    t = _t(spark)
    t.put(t.cells(_rows(spark, [("r1", "a", "x")]), "k", {"specific:title": "title"}), 1)
    cells = spark.createDataFrame([("r1", "basic", "typeCode", "C1"), ("r2", "specific", "title", "t")],
                                  "row_key string, family string, qualifier string, value string")
    t.put_cells(cells, 2)
    got = {r["row_key"]: (r["basic_typeCode"], r["specific_title"])
           for r in t.scan(["basic:typeCode", "specific:title"]).collect()}
    assert got == {"r1": ("C1", "a"), "r2": (None, "t")}


def test_rows_of_one_key_pass_without_an_exchange(spark):
    """Whatever the number of repeated keys, and without automatic broadcasts."""
    t = _t(spark)
    one = [(f"k{i}", f"a{i}", "c") for i in range(2000)]
    two = [(f"k{i}", f"b{i}", "c") for i in range(0, 2000, 2)]          # half of the keys again
    t.put(t.cells(_rows(spark, one), "k", {"specific:title": "title"}), 1)
    t.put(t.cells(_rows(spark, two), "k", {"specific:title": "title"}), 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        single, several = t._split(t._flat(["specific:title"], None)[0], None)
        # 2^28 slots: a slot shared by chance is out of question here
        assert single.count() == 1000 and several.count() == 2000
        assert {r["row_key"] for r in single.collect()} == {f"k{i}" for i in range(1, 2000, 2)}
        assert "ShuffleExchangeExec" not in above_broadcasts(single)
        got = {r["row_key"]: r["specific_title"] for r in t.scan(["specific:title"]).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {f"k{i}": f"{'ab'[i % 2 == 0]}{i}" for i in range(2000)}


def test_slots_shared_by_chance_change_nothing(spark, monkeypatch):
    from medstar.operators import wide_table

    monkeypatch.setattr(wide_table, "SLOTS", 5)
    t = _t(spark)
    t.put(t.cells(_rows(spark, [(f"k{i}", "a", "c") for i in range(40)]), "k", {"specific:title": "title"}), 1)
    t.put(t.cells(_rows(spark, [("k3", "b", "c")]), "k", {"specific:title": "title"}), 2)
    got = {r["row_key"]: r["specific_title"] for r in t.scan(["specific:title"]).collect()}
    assert got == {f"k{i}": "b" if i == 3 else "a" for i in range(40)}


def test_range_scan_pushdown_and_byte_order(spark):
    t = _t(spark)
    keys = ["RN32_000", "RN32_001", "RN32_1000", "RN33_000", "RN33_001", "RN31_999"]
    t.put(t.cells(_rows(spark, [(k, k, "c") for k in keys]), "k", {"specific:title": "title"}), 1)
    df = t.scan(["specific:title"], key_range=("RN32_001", "RN33_001"))
    assert sorted(r["row_key"] for r in df.collect()) == ["RN32_001", "RN32_1000", "RN33_000"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,RN32_001)" in plan and "LessThan(row_key,RN33_001)" in plan
    final = plan.split("Initial Plan")[0]        # as it ran: no key has two rows
    assert final.count("specific:struct<title:string>") == 1       # cells are read once
    assert not [x for x in above_broadcasts(df) if "Shuffle" in x or "Aggregate" in x]
    assert "content" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_not_null_filter_and_sample(spark):
    t = _t(spark)
    t.put(t.cells(_rows(spark, [("a", None, "x"), ("b", "t", "y")]), "k",
                  {"specific:title": "title", "specific:content": "content"}), 1)
    assert [r["row_key"] for r in t.scan(["specific:title"], require=["specific:title"]).collect()] == ["b"]
    assert t.sample(1.0, seed=1).count() == 2


def test_compaction(spark):
    t = _t(spark)
    for v in (1, 2, 3):
        t.put(t.cells(_rows(spark, [("a", f"t{v}", "c" if v == 1 else None), (f"k{v}", "x", None)]),
                      "k", {"specific:title": "title", "specific:content": "content",
                            "basic:more": F.lit(f"m{v}")}), v)
    before = sorted(map(str, t.latest().collect()))
    cells = sorted(map(tuple, t.cell_rows().collect()))
    name = t.compact()
    assert t.batches() == [name] and t.folded() == {"put.1", "put.2", "put.3"}
    assert sorted(map(str, t.latest().collect())) == before
    assert sorted(map(tuple, t.cell_rows().collect())) == cells
    # cells keep their order: an older number loses, a newer one wins
    t.put(t.cells(_rows(spark, [("a", "old", "old")]), "k",
                  {"specific:title": "title", "specific:content": "content"}), 0)
    assert t.scan(["specific:title"], key_range=("a", "b")).collect()[0][1] == "t3"
    t.put(t.cells(_rows(spark, [("a", None, "new")]), "k", {"specific:content": "content"}), 2,
          writer="other")
    row = t.scan(["specific:title", "specific:content"], key_range=("a", "b")).collect()[0]
    assert tuple(row)[1:] == ("t3", "new")


def test_a_folded_batch_is_closed(spark):
    t = _t(spark)
    rows = t.cells(_rows(spark, [("a", "t", None)]), "k", {"specific:title": "title"})
    t.put(rows, 1)
    t.compact()
    with pytest.raises(ValueError, match="can't be rewritten"):
        t.put(rows, 1)
    assert not t.put(rows, 1, folded="skip")
    assert t.put(rows, 1, writer="other") and t.put(rows, 2)
    with pytest.raises(ValueError):
        t.put(rows, 1, writer="compacted")
    assert t.log().count() == 3 and t.latest().count() == 1


def test_open_cells_and_unknown_families(spark):
    t = _t(spark)
    cells = spark.createDataFrame(
        [("r1", "basic", "typeCode", "C1"), ("r1", "basic", "ward", "W1"), ("r1", "basic", "ward", "W2"),
         ("r2", "specific", "note:1", "n"), ("r3", "basic", "id", None)],
        "row_key string, family string, qualifier string, value string")
    t.put_cells(cells, 1)
    got = {tuple(r) for r in t.cell_rows().collect()}
    assert got == {("r1", "basic", "typeCode", "C1"), ("r1", "basic", "ward", "W2"),
                   ("r2", "specific", "note:1", "n")}             # r3 holds nothing: no key
    assert {r["row_key"]: r["basic_ward"] for r in t.scan(["basic:ward"]).collect()} == {"r1": "W2"}
    assert t.scan(["basic:typeCode", "specific:title"]).count() == 1  # r2 has none of the two
    with pytest.raises(Exception, match="unknown family: other"):
        t.put_cells(spark.createDataFrame([("r1", "other", "q", "v")],
                                          "row_key string, family string, qualifier string, value string"), 2)
    with pytest.raises(ValueError, match="unknown family"):
        t.cells(cells, "row_key", {"nope:x": "value"})


def test_writing_shuffles_and_sorts_nothing(spark):
    t = _t(spark)
    rows = t.cells(_rows(spark, [("a", "t", "x")]), "k", {"specific:content": "content"})
    plan = rows.filter(t._has_cell())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    t.put(rows, 1)
    t.put(t.cells(_rows(spark, [("a", "t", "y")] + [(f"k{i}", "t", "x") for i in range(30)]), "k",
                  {"specific:content": "content"}), 2)
    # keys with one row pass by the aggregate
    plan = t.latest(["specific:content"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "LeftOuter, BuildRight" in plan


def test_batches_survive_static_overwrite_mode(spark):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        t = _t(spark)
        rows = t.cells(_rows(spark, [("a", "t", None)]), "k", {"specific:title": "title"})
        t.put(rows, 1)
        t.put(rows, 2)
        t.put(rows, 2)
        assert t.versions() == [1, 2] and t.log().count() == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_ingest_fact_job_and_store(spark):
    from medstar.plans import jobs
    from medstar.session import scratch_path
    from medstar.sources.documents import literal_documents
    from tests.docs import inpatient
    docs = literal_documents(spark, [
        ("a.xml", inpatient(ids=('<id root="2.1" extension="RN32_001"/>',))),
        ("b.xml", inpatient(ids=('<id root="2.1" extension="RN32_002"/>',), age="x")),
        ("c.xml", inpatient(ids=('<id root="2.1" extension="RN31_001"/>',))),
        ("d.xml", "<broken")])
    rej = f"rej_{uuid.uuid4().hex[:8]}"
    name = f"emr_{uuid.uuid4().hex[:8]}"
    wt = jobs.ingest_documents(spark, docs, name, 1, rejects_table=rej)
    wt = jobs.ingest_documents(spark, docs, name, 1, rejects_table=rej)      # rerun: idempotent
    assert sorted(r["field"] for r in spark.table(rej).collect()) == ["content"]
    assert wt.log().count() == 3
    fact = jobs.fact_job(wt)
    assert [r["row_key"] for r in fact.collect()] == ["RN32_001"]          # range + good
    assert [r["field"] for r in jobs.fact_rejects(wt).collect()] == ["ageId"]
    table = f"fact_{uuid.uuid4().hex[:8]}"
    jobs.store_fact(spark, fact, table, location=scratch_path(spark, "fact"))
    assert spark.table(table).count() == 1


def test_hot_key(spark):
    t = _t(spark)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("title"))
    t.put(t.cells(df, "k", {"specific:title": "title"}), 1)
    hot = t.latest(["specific:title"]).filter("row_key = 'HOT'").collect()[0]
    assert hot["specific"]["title"] == "999"                        # largest value wins


def test_same_row_key_in_two_files_is_deterministic(spark):
    from medstar.plans import jobs
    from medstar.sources.documents import literal_documents
    from tests.docs import inpatient
    same = '<id root="2.1" extension="RN32_777"/>'
    docs = literal_documents(spark, [
        ("dir/b.xml", inpatient(ids=(same,), titles=("<title>from b</title>",))),
        ("dir/a.xml", inpatient(ids=(same,), titles=("<title>from a</title>",)))])
    wt = jobs.ingest_documents(spark, docs, f"emr_{uuid.uuid4().hex[:8]}", 1)
    row = wt.latest(["specific:title"]).collect()
    assert len(row) == 1 and row[0]["specific"]["title"] == "from b"   # larger path wins


def test_maintain_bounds_the_number_of_batches(spark):
    t = _t(spark)
    for v in (1, 2, 3):
        t.put(t.cells(_rows(spark, [("a", f"t{v}", None), (f"k{v}", "x", None)]), "k",
                      {"specific:title": "title"}), v)
    before = sorted(tuple(r) for r in t.scan(["specific:title"]).collect())
    assert not t.maintain(3)
    assert t.maintain(2) and len(t.batches()) == 1
    assert sorted(tuple(r) for r in t.scan(["specific:title"]).collect()) == before
    # the next number is free: a compaction takes none
    t.put(t.cells(_rows(spark, [("z", "t", None)]), "k", {"specific:title": "title"}), 4)
    assert t.scan(["specific:title"]).count() == len(before) + 1


def test_bad_documents_are_kept_without_asking(spark):
    from medstar.plans import jobs
    from medstar.sources.documents import literal_documents
    from tests.docs import inpatient
    name = f"emr_{uuid.uuid4().hex[:8]}"
    docs = literal_documents(spark, [("a", inpatient()), ("b", "<broken"), ("c", "")])
    jobs.ingest_documents(spark, docs, name, 1)
    assert sorted(r["path"] for r in spark.table(f"{name}_rejects").collect()) == ["b", "c"]
    with pytest.raises(Exception):
        jobs.ingest_documents(spark, docs, name, 2, on_error="fail")
