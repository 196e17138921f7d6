import uuid

import pytest
from pyspark.sql import functions as F

from medstar.operators.cube import CubeDef, CubeStore, gid_of, month_of, time_bounds
from medstar.operators.item_stats import item_statistics
from medstar.plans import catalog, warehouse
from medstar.session import scratch_path
from tests.conftest import SF_SMALL

DIMS = ["genderId", "inClassId"]
JAN95, JAN96, JAN97 = 788918400000, 820454400000, 852076800000


@pytest.fixture(scope="module")
def fact(spark):
    rows = [(f"p{i % 7}", str(1 + i % 2), f"KS{i % 3}", f"{1995 + i % 2}{1 + i % 12:02d}")
            for i in range(200)]
    return spark.createDataFrame(rows, "idCard string, genderId string, inClassId string, "
                                       "inTimeId string")


def _store(spark, name="c"):
    s = CubeStore(spark, scratch_path(spark, "cubes-test"))
    s.define(CubeDef(name, DIMS, project="emr"))
    return s


def _rows(df):
    return sorted(tuple(r) for r in df.select("gid", *DIMS, "n_visits", "first_month",
                                              "last_month").collect())


def test_month_and_gid():
    assert month_of(JAN95) == "199501"
    assert gid_of(DIMS, DIMS) == 0 and gid_of(DIMS, []) == 3 and gid_of(DIMS, ["inClassId"]) == 2


def test_merge_equals_one_build(spark, fact):
    a = _store(spark)
    a.build("c", fact, JAN95, JAN96)
    a.build("c", fact, JAN96, JAN97)
    a.build("c", fact, JAN95, JAN97, build_type="MERGE")
    b = _store(spark)
    b.build("c", fact, JAN95, JAN97)
    assert _rows(a.cuboids("c")) == _rows(b.cuboids("c"))
    assert [s["name"] for s in a.get("c").segments] == ["199501_199701"]


def test_query_equals_direct_group_by(spark, fact):
    s = _store(spark)
    s.build("c", fact, JAN95, JAN97)
    got = sorted(tuple(r) for r in s.query("c", ["genderId"], where={"inClassId": "KS1"})
                 .select("genderId", "n_visits").collect())
    want = sorted(tuple(r) for r in fact.filter("inClassId = 'KS1'").groupBy("genderId")
                  .agg(F.count(F.lit(1)).alias("n")).collect())
    assert got == want
    est = s.query("c", [], estimate_patients=True).collect()[0]["patients_est"]
    assert round(est) == 7


def test_status_refresh_overlap_purge(spark, fact):
    s = _store(spark)
    with pytest.raises(ValueError):
        s.build("c", fact, JAN95, JAN96, build_type="REFRESH")
    s.build("c", fact.filter("genderId = '1'"), JAN95, JAN96)
    s.build("c", fact, JAN95, JAN96, build_type="REFRESH")
    assert s.query("c", []).collect()[0]["n_visits"] == fact.filter("inTimeId < '199601'").count()
    with pytest.raises(ValueError):
        s.build("c", fact, JAN95, JAN97)                 # overlaps
    s.disable("c")
    with pytest.raises(PermissionError):
        s.query("c", ["genderId"])
    s.enable("c")
    s.purge("c")
    assert s.cuboids("c").count() == 0 and s.get("c").status == "DISABLED"


def test_listing_pages(spark):
    s = CubeStore(spark, scratch_path(spark, "cubes-list"))
    for n, p in [("visits_a", "emr"), ("visits_b", "emr"), ("visits_c", "x"), ("other", "emr")]:
        s.define(CubeDef(n, ["genderId"], project=p))
    names = [r["name"] for r in s.list_cubes(offset=1, limit=5, name_contains="visits",
                                             project="emr").collect()]
    assert names == ["visits_b"]
    assert s.describe("visits_a").count() == 0
    m = s.model("visits_a").collect()[0]
    assert (m["model"], m["dimensions"], m["time_column"]) == ("visits_a", "genderId", "inTimeId")


def test_item_statistics_small(spark):
    # one paper, three students, two items
    rows = [("P", "2024", s, i, sc) for s, i, sc in
            [(1, 1, 1), (1, 2, 1), (2, 1, 3), (2, 2, 2), (3, 1, 5), (3, 2, 4)]]
    df = spark.createDataFrame(rows, "paper_code string, create_time string, student long, "
                                     "item_id int, score int")
    out = {r["item_id"]: r for r in item_statistics(df, 5.0).collect()}
    assert float(out[1]["avg_score"]) == 3.0 and out[1]["max_score"] == 5
    assert float(out[1]["fc_score"]) == 2.667 and float(out[1]["bzc_score"]) == 1.633
    assert float(out[1]["nandu"]) == 0.6
    assert float(out[1]["qufendu"]) == 0.8                 # (5 - 1) / 5
    assert float(out[2]["qufendu"]) == 0.6                 # (4 - 1) / 5


def test_warehouse_and_catalog(spark):
    db = f"db_{uuid.uuid4().hex[:8]}"
    warehouse.create_database(spark, db)
    warehouse.create_item_index(spark, f"{db}.t_item_index",
                                location=scratch_path(spark, "idx"))
    warehouse.create_fact_table(spark, f"{db}.t_fact_patient",
                                location=scratch_path(spark, "fact"))
    names = {r["tableName"] for r in warehouse.show_tables(spark, db).collect()}
    assert names == {"t_item_index", "t_fact_patient"}
    spark.sql("USE default")
    project = f"p_{uuid.uuid4().hex[:8]}"
    assert catalog.load_tables(spark, "nation, region", project, SF_SMALL) == ["nation", "region"]
    cols = catalog.queryable_columns(spark, project).collect()
    assert {(r["table_name"], r["column_name"]) for r in cols} >= {("nation", "n_name")}
    stats = {r["table_name"]: r["n_rows"] for r in catalog.table_stats(spark, project).collect()}
    assert stats == {"nation": 25, "region": 5}
    catalog.wipe_cache(spark, "METADATA", f"{project}.nation")
    with pytest.raises(ValueError):
        catalog.wipe_cache(spark, "OTHER", "x")


def test_grouping_sets_and_cuboid_pruning(spark, fact):
    s = CubeStore(spark, scratch_path(spark, "cubes-gs"))
    s.define(CubeDef("g", DIMS, grouping_sets=[["genderId", "inClassId"], ["genderId"]]))
    s.build("g", fact, JAN95, JAN97)
    gids = sorted(r["gid"] for r in s.cuboids("g").select("gid").distinct().collect())
    assert gids == [0, 1]                       # no grand total, no class-only cuboid
    got = sorted(tuple(r) for r in s.query("g", ["genderId"]).select("genderId", "n_visits")
                 .collect())
    want = sorted(tuple(r) for r in fact.groupBy("genderId").agg(F.count(F.lit(1))).collect())
    assert got == want
    # a class-only question is answered from the (gender, class) cuboid
    by_class = {r["inClassId"]: r["n_visits"] for r in s.query("g", ["inClassId"]).collect()}
    assert sum(by_class.values()) == fact.count()
    with pytest.raises(ValueError):
        s.query("g", [], where={"ageId": "1"})            # not a dimension
    plan = s.cuboids("g").filter("gid = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(gid" in plan


def test_sql_over_registered_cube_views(spark, fact):
    s = _store(spark)
    s.build("c", fact, JAN95, JAN97)
    assert s.register_views(prefix=f"v{uuid.uuid4().hex[:6]}_") != []
    view = [v for v in s.register_views(prefix="cube_t_")][0]
    n = spark.sql(f"SELECT sum(n_visits) AS n FROM {view} WHERE gid = 3").collect()[0]["n"]
    assert n == fact.count()


def test_build_segments_equals_one_build_per_segment(spark, fact):
    a = _store(spark)
    assert a.build_segments("c", fact, [JAN95, JAN96, JAN97]) == ["199501_199601", "199601_199701"]
    b = _store(spark)
    b.build("c", fact, JAN95, JAN96)
    b.build("c", fact, JAN96, JAN97)
    assert _rows(a.cuboids("c")) == _rows(b.cuboids("c"))
    with pytest.raises(ValueError):
        a.build_segments("c", fact, [JAN96, JAN97])         # overlaps
    c = _store(spark)
    c.build_segments("c", fact, [JAN97, JAN97 + 31_536_000_000])   # a year without rows
    assert c.cuboids("c").count() == 0


def test_query_time_window_reads_its_segments(spark, fact):
    s = _store(spark)
    s.build_segments("c", fact, [JAN95, JAN96, JAN97])
    n95 = s.query("c", [], between=(JAN95, JAN96)).collect()[0]["n_visits"]
    assert n95 == fact.filter("inTimeId < '199601'").count()
    assert s.query("c", [], between=(JAN95, JAN97)).collect()[0]["n_visits"] == fact.count()
    with pytest.raises(ValueError):
        s.query("c", [], between=(JAN95 + 2_678_400_000, JAN97))   # starts inside 1995


FEB95, JAN98 = 791596800000, 883612800000


def test_bounds_are_starts_of_months(spark, fact):
    s = _store(spark)
    for a, b in [(JAN95 + 86_400_000, JAN96), (JAN95, JAN96 + 1), (JAN96, JAN95), (JAN95, JAN95)]:
        with pytest.raises(ValueError):
            s.build("c", fact, a, b)
    assert s.get("c").segments == []
    assert time_bounds(fact) == (JAN95, JAN97)
    assert time_bounds(fact.filter("false")) is None


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_refresh_to_nothing(spark, fact, mode):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        s = _store(spark)
        s.build_segments("c", fact, [JAN95, JAN96, JAN97])
        s.build("c", fact.filter("inTimeId >= '199601'"), JAN95, JAN96, build_type="REFRESH")
        assert s.query("c", []).first()["n_visits"] == fact.filter("inTimeId >= '199601'").count()
        s.build("c", fact.filter("false"), JAN96, JAN97, build_type="REFRESH")
        assert s.cuboids("c").count() == 0 and s.query("c", []).count() == 0
        assert s.query("c", ["genderId"]).count() == 0
        s.purge("c")
        s.build("c", fact, JAN95, JAN97)
        assert s.query("c", []).first()["n_visits"] == fact.count()
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_merge_refuses_a_gap(spark, fact):
    s = _store(spark)
    s.build("c", fact, JAN95, FEB95)
    s.build("c", fact, JAN96, JAN97)
    with pytest.raises(ValueError, match="gap"):
        s.build("c", fact, JAN95, JAN98, build_type="MERGE")
    s.build("c", fact, FEB95, JAN96)
    assert s.build("c", fact, JAN95, JAN98, build_type="MERGE") == "199501_199701"
    assert s.query("c", []).first()["n_visits"] == fact.count()


def test_concurrent_builds_lose_nothing(spark, fact):
    a = _store(spark)
    b = CubeStore(spark, a.root)
    a.get("c"), b.get("c")
    inner = a._roll_up

    def meanwhile(*args):                       # b builds while a's rows are written
        a._roll_up = inner
        b.build("c", fact, JAN96, JAN97)
        return inner(*args)

    a._roll_up = meanwhile
    a.build("c", fact, JAN95, JAN96)
    assert [s["name"] for s in CubeStore(spark, a.root).get("c").segments] == [
        "199501_199601", "199601_199701"]
    # the same range twice: the later one is refused and leaves no folder
    a._roll_up = lambda *args: (setattr(a, "_roll_up", inner), b.build("c", fact, JAN97, JAN98),
                                inner(*args))[2]
    with pytest.raises(ValueError, match="overlaps"):
        a.build("c", fact, JAN97, JAN98)
    assert len(b.get("c").segments) == 3
    assert b.query("c", []).first()["n_visits"] == fact.count()


def test_many_dimensions_with_named_groupings(spark):
    dims = [f"d{i}" for i in range(12)]
    with pytest.raises(ValueError):
        CubeDef("wide", dims)
    assert CubeDef("wide", dims, grouping_sets=[dims, ["d3"]]).dimensions == dims


def test_wipe_cache_touches_one_cube_only(spark, fact):
    s = _store(spark, "k1")
    s.define(CubeDef("k2", DIMS))
    s.build("k1", fact, JAN95, JAN97)
    s.build("k2", fact, JAN95, JAN97)
    s.register_views("w_")
    for v in ("w_k1", "w_k2"):
        spark.catalog.cacheTable(v)
        spark.table(v).count()
    catalog.wipe_cache(spark, "CUBE", "k1", store=s, prefix="w_")
    assert not spark.catalog.isCached("w_k1") and spark.catalog.isCached("w_k2")
    catalog.wipe_cache(spark, "CUBE", "k2", action="drop", prefix="w_")
    assert not spark.catalog.tableExists("w_k2") and spark.catalog.tableExists("w_k1")


def test_time_bounds_look_at_each_time_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from medstar.operators import cube
    looked, told = spark.sparkContext.accumulator(0), cube.is_month

    @F.udf("string")
    def seen(x):
        looked.add(1)
        return x

    monkeypatch.setattr(cube, "is_month", lambda time: told(seen(time)))
    rows = [("200001",), ("200112",), ("20000x",), ("000001",), (None,), ("",)] * 200
    fact = spark.createDataFrame(rows, "inTimeId string").repartition(3)
    assert cube.time_bounds(fact) == (cube.ms_of("200001"), cube.ms_of("200201"))
    assert looked.value <= 30                      # 1,200 rows of six times
    assert cube.time_bounds(fact.filter("inTimeId = '20000x' or inTimeId is null")) is None
