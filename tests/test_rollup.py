"""Cuboids by roll-up, exact patients over merged segments, times without a month."""

import random

import pytest
from pyspark.sql import functions as F

from medstar.operators.cube import (CubeDef, CubeStore, is_month, ms_of, time_bounds,
                                    time_rejects)
from medstar.operators.rollup import derived, every_set, gid_of, smallest_parent
from medstar.session import scratch_path
from medstar.sources import fs

DIMS = ["a", "b", "c"]
SCHEMA = "idCard string, a string, b string, c string, inTimeId string"


@pytest.fixture(scope="module")
def fact(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *(f"p{i}" for i in range(40))]), rng.choice("xyz"), rng.choice(["1", "2", None]),
             f"k{rng.randint(0, 30)}", f"199{rng.randint(5, 6)}{rng.randint(1, 12):02d}")
            for _ in range(600)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def store(spark, **options):
    s = CubeStore(spark, scratch_path(spark, "cubes-rollup"))
    s.define(CubeDef("c", DIMS, **options))
    return s


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


MEASURES = ["n_visits", "first_month", "last_month", "est"]


def test_roll_up_equals_grouping_sets(spark, fact):
    aggs = [F.count("*").alias("n_visits"), F.min("inTimeId").alias("first_month"),
            F.max("inTimeId").alias("last_month"),
            F.hll_sketch_estimate(F.hll_sketch_agg("idCard")).alias("est")]
    for sets in (None, [["a", "b", "c"], ["a"], []], [["a"], ["b", "c"], ["c"]], [["b"]]):
        s = store(spark, grouping_sets=sets)
        s.build("c", fact, ms_of("199501"), ms_of("199701"))
        got = s.cuboids("c").withColumn("est", F.hll_sketch_estimate("patients_hll"))
        want = fact.groupingSets(sets or every_set(DIMS), *DIMS).agg(
            F.grouping_id().cast("bigint").alias("gid"), *aggs)
        assert rows(got, "gid", *DIMS, *MEASURES) == rows(want, "gid", *DIMS, *MEASURES)


def test_raw_rows_are_aggregated_once(spark, fact):
    s = store(spark)
    cube = s.get("c")
    finest = s._finest(cube, fact.withColumn("segment", F.lit("s")))
    plan = finest._jdf.queryExecution().toString()
    assert "Expand" not in plan and "Generate" not in plan
    level = derived(finest.withColumn("gid", F.lit(0).cast("bigint")), {0: [1, 4]}, DIMS,
                    ["segment"], s._merged())
    assert level._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1


def test_smallest_parent():
    sizes = {frozenset("abc"): 100, frozenset("ab"): 10, frozenset("bc"): 7, frozenset("ac"): 7}
    assert smallest_parent(frozenset("b"), sizes) == frozenset("bc")
    assert smallest_parent(frozenset("a"), sizes) == frozenset("ac")
    assert smallest_parent(frozenset(), sizes) == frozenset("ac")
    assert gid_of(DIMS, ["c"]) == 6 and every_set(["a"]) == [[], ["a"]]


def test_one_file_per_segment_and_cuboid(spark, fact):
    s = store(spark)
    s.build_segments("c", fact, [ms_of(m) for m in ("199501", "199507", "199601", "199701")])
    folder = s.get("c").segments[0]["folder"]
    base = f"{s._cube_path('c')}/{folder}"
    segments = fs.list_names(spark, base)
    assert len(segments) == 3
    for seg in segments:
        gids = fs.list_names(spark, f"{base}/{seg}")
        assert len(gids) == 8
        for gid in gids:
            assert len(fs.list_names(spark, f"{base}/{seg}/{gid}")) == 1


def test_exact_patients_over_segments(spark, fact):
    s = store(spark, exact_patients=True)
    cuts = [ms_of(m) for m in ("199501", "199506", "199601")]
    s.build_segments("c", fact, cuts)
    s.build("c", fact, ms_of("199601"), ms_of("199701"))
    s.build("c", fact.filter("a = 'x'"), cuts[0], cuts[1], build_type="REFRESH")
    s.build("c", fact, cuts[0], cuts[1], build_type="REFRESH")

    def same():
        for group in ([], ["a"], ["b"], ["a", "c"], DIMS):
            want = fact.groupBy(*group).agg(F.count_distinct("idCard").alias("n_patients"))
            # a group whose visits have no patient has no row
            want = want.filter("n_patients > 0")
            assert rows(s.exact_patients("c", group), *group, "n_patients") == rows(
                want, *group, "n_patients")
        some = fact.filter("c in ('k1', 'k2')").groupBy("a").agg(F.count_distinct("idCard").alias("n_patients"))
        assert rows(s.exact_patients("c", ["a"], where={"c": ["k1", "k2"]}), "a", "n_patients") == rows(
            some, "a", "n_patients")

    same()
    s.build("c", fact, ms_of("199501"), ms_of("199701"), build_type="MERGE")
    same()
    inside = s.exact_patients("c", [], between=(ms_of("199501"), ms_of("199701"))).collect()
    assert [r["n_patients"] for r in inside] == [40]
    with pytest.raises(ValueError):
        plain = store(spark)
        plain.build("c", fact, ms_of("199501"), ms_of("199701"))
        plain.exact_patients("c", [])
    s.purge("c")
    assert s.get("c").segments == []


def test_patients_are_numbered_once(spark, fact):
    s = store(spark, exact_patients=True)
    cube = s.get("c")
    first = s._patient_ids(cube, fact.filter("a = 'x'"))
    before = {r["patient"]: r["id"] for r in first.collect()}
    after = {r["patient"]: r["id"] for r in s._patient_ids(cube, fact).collect()}
    assert before.items() <= after.items() and sorted(after.values()) == list(range(1, 41))


def test_times_without_a_month(spark, fact):
    months = ["199x01", "199513", "199500", "000001", "", None, "95", "1995", "199501x"]
    got = spark.createDataFrame([(m,) for m in months], "t string").select(
        "t", is_month(F.col("t")).alias("m"))
    assert {r["t"] for r in got.collect() if r["m"]} == {"199501x"}
    bad = spark.createDataFrame([("p", "x", "1", "k", t) for t in ("19951x", "199699", None, "")], SCHEMA)
    both = fact.unionByName(bad)
    assert time_bounds(both) == time_bounds(fact) and time_bounds(bad) is None
    assert rows(time_rejects(both), "inTimeId", "reason") == rows(spark.createDataFrame(
        [("19951x", "inTimeId: no month: 19951x"), ("199699", "inTimeId: no month: 199699"),
         (None, "inTimeId: null"), ("", "inTimeId: no month: ")], "t string, r string"), "t", "r")
    s = store(spark)
    s.build("c", both, ms_of("199501"), ms_of("199701"))
    assert s.query("c", []).first()["n_visits"] == fact.count()


def test_nothing_to_build(spark, fact):
    s = store(spark, exact_patients=True)
    s.build("c", fact, ms_of("200001"), ms_of("200101"))
    assert s.cuboids("c").count() == 0 and s.query("c", []).count() == 0
    assert s.exact_patients("c", []).count() == 0
