import os
import tempfile

import pytest
from pyspark.sql import functions as F

from medstar.operators.delimited import parse_delimited
from medstar.operators.star import Dimension, dealt_key, heavy_keys, spread_key, star_join
from medstar.sources import documents
from medstar.sources.documents import first_document, literal_lines, read_documents
from tests.docs import inpatient


def test_directory_scan_whole_files_and_bom(spark):
    d = tempfile.mkdtemp(prefix="medstar-docs-")
    for name, text in [("b.xml", inpatient()), ("a.xml", "﻿" + inpatient()), ("skip.txt", "x")]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    assert read_documents(spark, d).count() == 3       # every file, whatever its name
    docs = read_documents(spark, d, glob="*.xml")
    rows = sorted(docs.collect(), key=lambda r: r["path"])
    assert [os.path.basename(r["path"]) for r in rows] == ["a.xml", "b.xml"]
    assert rows[0]["content"] == inpatient()           # BOM removed, file whole
    assert os.path.basename(first_document(docs).collect()[0]["path"]) == "a.xml"


def test_delimited_trailing_empties(spark):
    lines = literal_lines(spark, ["row1,41,anna,f,2500", "row2,33,bert,m,",
                                  "row3,1,a,b,c,extra", "", "row4,,n,g,s"])
    out = {r["row_key"]: r for r in parse_delimited(lines).collect()}
    assert out["row1"]["salary"] == "2500" and out["row1"]["err"] is None
    assert out["row3"]["salary"] == "c"
    assert out["row4"]["age"] == "" and out["row4"]["err"] is None
    bad = [r for r in parse_delimited(lines).collect() if r["err"] is not None]
    assert len(bad) == 2


def test_star_join_left_keeps_unmatched(spark):
    fact = spark.createDataFrame([("1", "KS01"), ("3", "KS99")], "genderId string, inClassId string")
    g = spark.createDataFrame([("1", "male")], "gender_id string, gender_name string")
    c = spark.createDataFrame([("KS01", "cardio")], "class_id string, class_name string")
    out = star_join(fact, [Dimension(g, "gender_id", "genderId", fixed=True),
                           Dimension(c, "class_id", "inClassId")])
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("1", "KS01", "male", "cardio"), ("3", "KS99", None, None)]
    assert star_join(fact, [Dimension(g, "gender_id", "genderId")], how="inner").count() == 1


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def test_keys_that_match_nothing_are_spread(spark, no_broadcast):
    fact = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "").when(F.col("id") % 4 == 1, None).otherwise("7").alias("doc"),
        F.col("id"))
    dim = spark.createDataFrame([("1", "Dr One"), ("", "nobody")], "doc_id string, name string")
    out = star_join(fact, [Dimension(dim, "doc_id", "doc")])
    assert out.count() == 4000 and out.filter("name is not null").count() == 0
    keys = fact.select(spread_key("doc", fact.columns).alias("k"), "doc").repartition(16, "k")
    used = keys.filter("coalesce(doc, '') = ''").select(F.spark_partition_id().alias("p")).distinct()
    assert used.count() == 16


def test_star_join_big_dimension_with_null_keys(spark, no_broadcast):
    fact = spark.createDataFrame([("1", "a"), (None, "b"), (None, "c"), ("7", "d")],
                                 "doc string, tag string")
    dim = spark.createDataFrame([("1", "Dr One"), ("2", "Dr Two")], "doc_id string, name string")
    out = star_join(fact, [Dimension(dim, "doc_id", "doc")])
    got = sorted((r["tag"], r["doc"], r["name"]) for r in out.collect())
    assert got == [("a", "1", "Dr One"), ("b", None, None), ("c", None, None), ("d", "7", None)]
    assert out.columns == ["doc", "tag", "name"]
    inner = star_join(fact, [Dimension(dim, "doc_id", "doc")], how="inner")
    assert [r["tag"] for r in inner.collect()] == ["a"]


def test_star_join_same_result_with_and_without_broadcast(spark, request):
    from medstar.operators.extract import patient_fact
    from medstar.plans.dimensions import derived_dimensions
    from medstar.sources.seed import order_documents
    from tests.conftest import SF_SMALL
    fact = patient_fact(order_documents(spark, SF_SMALL), keep=("path",))
    small = derived_dimensions(spark, SF_SMALL)
    big = derived_dimensions(spark, SF_SMALL)
    a = sorted(tuple(r) for r in star_join(fact, small).collect())
    request.getfixturevalue("no_broadcast")
    b = sorted(tuple(r) for r in star_join(fact, big).collect())
    assert a == b and len(a) > 0


def test_a_hot_doctor_is_dealt_over_parts(spark, no_broadcast):
    fact = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "").otherwise(
            F.concat(F.lit("d"), F.col("id") % 997)).alias("doc"), F.col("id"))
    dim = spark.createDataFrame([("hot", "Dr Hot"), ("", "nobody"), *[(f"d{i}", f"Dr {i}") for i in range(500)]],
                                "doc_id string, name string")
    dims = [Dimension(dim, "doc_id", "doc")]
    heavy = heavy_keys(fact, dims)
    assert set(heavy) == {"doc"} and set(heavy["doc"]) == {"hot"} and 60 <= heavy["doc"]["hot"] <= 70
    for how in ("left", "inner"):
        plain = star_join(fact, dims, how=how)
        dealt = star_join(fact, dims, how=how, heavy=heavy)
        assert dealt.columns == plain.columns
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))

    def tasks(key):
        rows = fact.select(key.alias("k")).repartition(16, "k").groupBy(F.spark_partition_id()).count()
        return sorted(r["count"] for r in rows.collect())

    sizes = tasks(dealt_key(spread_key("doc", fact.columns), heavy["doc"], fact.columns))
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
    assert tasks(F.col("doc"))[-1] > 5 * tasks(F.col("doc"))[8]
    assert heavy_keys(fact.limit(0), dims) == {} and heavy_keys(fact, []) == {}


def test_jdbc_options_without_a_database():
    import pytest
    from medstar.plans.dimensions import jdbc_options
    o = jdbc_options("jdbc:x://h/db", "t_dimension_age", user="u", password="p",
                     partition_column="age_id", lower_bound=0, upper_bound=15, num_partitions=4)
    assert o["partitionColumn"] == "age_id" and o["numPartitions"] == "4"
    assert o["dbtable"] == "t_dimension_age" and o["user"] == "u"
    assert "partitionColumn" not in jdbc_options("jdbc:x://h/db", "t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", "t", partition_column="k")


def test_documents_are_written_by_all_tasks_one_file_a_name(spark, tmp_path):
    rows = [(f"text {i}", f"S{i % 40}") for i in range(60)]
    folder = str(tmp_path / "documents")
    documents.write_documents(spark.createDataFrame(rows, "value string, name string").coalesce(1), folder)
    files = [f.name for f in (tmp_path / "documents").glob("name=*/part-*")]
    assert len(files) == 40
    assert len({f.split("-")[1] for f in files}) > 1           # part numbers are tasks
    assert sorted(r["content"] for r in documents.read_documents(spark, folder).collect()) == sorted(
        "".join(f"text {j}\n" for j in range(i, 60, 40)) for i in range(40))


def test_padded_numbers_equal_the_format(spark):
    from pyspark.sql import functions as F

    from medstar.sources.seed import padded
    rows = [(v,) for v in (None, 0, 7, 99, 100, 999, 1000, 2**40, -1, -5, -12345)]
    df = spark.createDataFrame(rows, "v long")
    got = df.select(padded(F.col("v"), 3).alias("a"), F.format_string("%03d", "v").alias("b")).collect()
    assert len(got) == len(rows) and all(r["a"] == r["b"] for r in got)
