import pytest

from medstar.operators import extract as X
from medstar.sources.documents import literal_documents
from tests.docs import inpatient


def _docs(spark):
    rows = [("good.xml", inpatient()),
            ("two_ids.xml", inpatient(ids=('<id extension="A"/>', '<id extension="B"/>'))),
            ("bad.xml", "<ClinicalDocument"),
            ("null.xml", None),
            ("no_jb.xml", inpatient(diagnoses=('<name displayName="ZD1"/>',)))]
    return literal_documents(spark, rows)


@pytest.mark.parametrize("engine", ["exact", "jvm"])
def test_header_engines(spark, engine):
    out = {r["path"]: r for r in X.extract_header(_docs(spark), engine=engine).collect()}
    assert out["good.xml"]["row_key"] == "RN32_101" and out["good.xml"]["err"] is None
    assert out["two_ids.xml"]["err"].startswith("row_key")
    assert out["bad.xml"]["err"].startswith("content")
    assert out["null.xml"]["err"] == "content: null"
    assert out["two_ids.xml"]["row_key"] is None      # never a half-filled row


def test_fact_good_and_rejects(spark):
    parsed = X.parse_fact(_docs(spark), keep=("path",))
    good = {r["path"]: r for r in X.good(parsed).collect()}
    assert list(good) == ["good.xml", "two_ids.xml"] or set(good) == {"good.xml", "two_ids.xml"}
    assert good["good.xml"]["addr"] == "C1 K1"
    rej = {r["path"]: r["field"] for r in X.rejects(parsed, key="path").collect()}
    assert rej == {"bad.xml": "content", "null.xml": "content", "no_jb.xml": "outSickId"}


def test_fail_mode_raises(spark):
    with pytest.raises(Exception):
        X.parse_fact(_docs(spark), keep=("path",), on_error="fail").collect()


def test_udf_runs_once_per_document(spark):
    plan = X.good(X.parse_fact(_docs(spark), keep=("path",)))._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    jvm = X.good(X.extract_header(_docs(spark), engine="jvm"))._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert jvm.count("from_xml") == 1


def test_engine_differences_are_the_documented_ones(spark):
    mixed = inpatient(titles=("<title>a<b>x</b>c</title>",))
    trailing = inpatient(tail="text after the root")
    docs = literal_documents(spark, [("mixed.xml", mixed), ("trailing.xml", trailing)])
    exact = {r["path"]: r for r in X.extract_header(docs, engine="exact").collect()}
    jvm = {r["path"]: r for r in X.extract_header(docs, engine="jvm").collect()}
    assert exact["mixed.xml"]["title"] == "axc"
    assert jvm["mixed.xml"]["title"] == "a<b>x</b>c"
    assert exact["trailing.xml"]["err"].startswith("content")
    assert jvm["trailing.xml"]["err"] is None


def test_preview_prints_on_driver(spark):
    from medstar.plans.warehouse import preview
    text = preview(spark.createDataFrame([("a", None)], "x string, y string"))
    assert text.splitlines() == ["x | y", "a | null"]
