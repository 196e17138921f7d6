"""The JVM-side Column scalars agree with the exact Python helpers."""

from hypothesis import given, settings
from pyspark.sql import functions as F
from hypothesis import strategies as st

from medstar.functions import text as T
from medstar.functions.xml_paths import Reject, jchar_at, jdiv, jdrop, jparse_int, jprefix

ALPHA = st.text(alphabet="0123456789+-ab JBé中 ", max_size=12)


def _py(fn, *a):
    try:
        return fn(*a)
    except Reject:
        return None


@settings(max_examples=15, deadline=None)
@given(st.lists(ALPHA, min_size=1, max_size=40))
def test_string_scalars_match(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select("s", T.drop_leading("s", 2).alias("d"), T.prefix("s", 6).alias("p"),
                     T.char_at("s", 2).alias("c"), T.to_int("s").alias("i"),
                     T.month_key("s").alias("m")).collect()
    for r in rows:
        v = r["s"]
        assert r["d"] == jdrop(v, 2)
        assert r["p"] == _py(jprefix, v, 6, "p")
        assert r["c"] == _py(jchar_at, v, 2, "c")
        assert r["m"] == _py(jprefix, v, 6, "m")
        want = _py(jparse_int, v, "i")
        assert r["i"] == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=-10**6, max_value=10**6), min_size=1, max_size=40))
def test_int_div_truncates(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    for r in df.select("x", T.int_div("x", 10).alias("q")).collect():
        assert r["q"] == jdiv(r["x"], 10)


def test_concat_space_and_utf8(spark):
    r = spark.createDataFrame([("a", "b", "中")], "a string, b string, c string").select(
        T.concat_space("a", "b").alias("ab"),
        T.utf8_decode(T.utf8_encode("c")).alias("rt"),
        T.split_all("a").alias("parts"), T.to_text(F.lit(42)).alias("t"),
        T.is_equal("a", F.lit("a")).alias("eq"),
        T.is_equal(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("nn")).collect()[0]
    assert r["ab"] == "a b" and r["rt"] == "中" and r["parts"] == ["a"]
    assert r["t"] == "42" and r["eq"] is True and r["nn"] is True


def test_compact_time_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        r = spark.sql("SELECT TIMESTAMP_NTZ '1999-10-03 00:00:00' AS t, DATE '1999-10-04' AS d") \
            .select(T.compact_time("t").alias("a"), T.compact_time("d").alias("b"),
                    T.compact_time("t", 6).alias("m")).collect()[0]
        assert (r["a"], r["b"], r["m"]) == ("19991003000000", "19991004000000", "199910")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_node_filters_on_arrays(spark):
    df = spark.createDataFrame(
        [(["DR2555", "DR1777"], ["JB1", None, "ZD2"]),
         (["ID2001", "DR2555"], ["JB1", "JB2"]),
         (["D2"], ["J"]),
         ([], [])],
        "ids array<string>, names array<string>")
    rows = df.select(T.filter_char_at("ids", 2, "2").alias("att"),
                     T.only_one(T.filter_char_at("ids", 2, "2")).alias("one"),
                     T.filter_prefix("names", "JB").alias("jb")).collect()
    assert rows[0]["att"] == ["DR2555"] and rows[0]["one"] == "DR2555" and rows[0]["jb"] == ["JB1"]
    assert rows[1]["one"] is None and rows[1]["jb"] == ["JB1", "JB2"]      # two: no single
    assert rows[2]["att"] is None and rows[2]["jb"] is None                # too short: reject
    assert rows[3]["att"] == [] and rows[3]["one"] is None
