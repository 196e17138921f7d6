"""The JVM engine of the patient fact gives the exact engine's rows and reasons."""

import random

import pytest
from pyspark.sql import functions as F

from medstar.operators import extract as X
from medstar.sources.documents import literal_documents
from tests.docs import inpatient

GOOD = inpatient()
SECTION = "<component><section><entry><observation><code><qualifier><name displayName=\"JBx\"/>" \
          "</qualifier></code></observation></entry></section></component>"
CASES = {
    "good": GOOD, "null": None, "empty": "", "blank": " \n", "cut": GOOD[:-5], "text": "no xml",
    "trailing": inpatient(tail="text"), "two roots": GOOD + GOOD, "space": "\n " + GOOD + " \n",
    "declared": '<?xml version="1.0" encoding="GBK"?>\n' + GOOD, "bom": "﻿" + GOOD,
    "comment": GOOD.replace("<patient>", "<!-- <authenticator> --><patient>"),
    "cdata": inpatient(addrs=("<addr><city><![CDATA[C<1]]></city><county>K</county></addr>",)),
    "instruction": GOOD.replace("<patient>", "<?x y?><patient>"),
    "entities": inpatient(addrs=("<addr><city>A &amp; B</city><county>&lt;K&gt;</county></addr>",)),
    "reference": inpatient(patient_id="ID&#65;1"), "unknown entity": inpatient(patient_id="ID&foo;1"),
    "prefixed": GOOD.replace("<addr>", '<h:addr xmlns:h="urn:x">').replace("</addr>", "</h:addr>"),
    "root prefix": GOOD.replace("<ClinicalDocument xmlns=", "<h:ClinicalDocument xmlns:h=").replace(
        "</ClinicalDocument>", "</h:ClinicalDocument>"),
    "unbound": GOOD.replace("<addr>", "<q:addr>").replace("</addr>", "</q:addr>"),
    "other attribute": GOOD.replace('<patient><id extension=', '<patient><id xml:extension="z" extension='),
    "xsi": GOOD.replace("<ClinicalDocument ", '<ClinicalDocument xmlns:xsi="urn:y" ').replace(
        "<observation>", '<observation xsi:type="CD">'),
    "two addresses": inpatient(addrs=("<addr><city>C1</city><county>K1</county></addr>",) * 2),
    "no address": inpatient(addrs=()), "empty city": inpatient(addrs=("<addr><city/><county>K</county></addr>",)),
    "marked city": inpatient(addrs=("<addr><city>a<b>x</b>c</city><county> K </county></addr>",)),
    "attributes": inpatient(addrs=('<addr><city code="1">C</city><county x="2">K</county></addr>',)),
    "short id": inpatient(patient_id="I"), "no id": inpatient(patient_id=""),
    "age": inpatient(age="-37"), "age sign": inpatient(age="+9"), "age text": inpatient(age="3x"),
    "age big": inpatient(age="99999999999"), "age far": inpatient(age="2147483648"), "age digits": inpatient(age="٣٧"),
    "no age": GOOD.replace('<age value="37"/>', ""), "empty age": inpatient(age=""),
    "no time": inpatient(low=""), "short time": inpatient(low='<low value="2024"/>'),
    "two times": inpatient(low='<low value="20240312"/><low value="20250312"/>'),
    "one doctor": inpatient(doctors=("DR2555",)), "two attending": inpatient(doctors=("DR2555", "DR2556")),
    "none attending": inpatient(doctors=("DR1",) * 3), "short doctor": inpatient(doctors=("DR2555", "DR")),
    "no doctor": inpatient(doctors=()), "doctor without": GOOD.replace('<id extension="DR1777"/>', "<id/>"),
    "nested doctor": GOOD.replace("<patient>", "<x><authenticator><assignedEntity><id extension=\"DR2999\"/>"
                                               "</assignedEntity></authenticator></x><patient>"),
    "doctor in doctor": GOOD.replace("<authenticator><assignedEntity><id extension=\"DR2555\"/>",
                                     "<authenticator><authenticator><assignedEntity><id extension=\"DR2000\"/>"
                                     "</assignedEntity></authenticator><assignedEntity><id extension=\"DR2555\"/>"),
    "no disease": inpatient(diagnoses=()), "other disease": inpatient(diagnoses=('<name displayName="ZD1"/>',)),
    "two diseases": inpatient(diagnoses=('<name displayName="JB1"/>', '<name displayName="JB1"/>')),
    "short disease": inpatient(diagnoses=('<name displayName="J"/>',)),
    "unnamed disease": inpatient(diagnoses=("<name/>", '<name displayName="JB7"/>')),
    "two names": inpatient(diagnoses=('<name displayName="JB1"/><name displayName="Z12"/>',)),
    "nested section": inpatient(diagnoses=()).replace("<section>", "<section>" + SECTION),
    "deep entry": inpatient(diagnoses=()).replace("<section>", "<section><x><entry><observation><code><qualifier>"
                                                  "<name displayName=\"JB5\"/></qualifier></code></observation></entry></x>"),
    "section in section": inpatient(diagnoses=()).replace("<section>", "<section><section><entry><observation><code>"
                                                          "<qualifier><name displayName=\"JB5\"/></qualifier></code>"
                                                          "</observation></entry></section>"),
    "entry in entry": GOOD.replace("<entry><observation>", "<entry><entry><observation><code><qualifier><name "
                                   "displayName=\"JB8\"/></qualifier></code></observation></entry><observation>", 1),
    "two bodies": GOOD.replace("<structuredBody>", "<structuredBody/><structuredBody>"),
    "astral": inpatient(patient_id="\U0001F600\U0001F601x"), "accents": inpatient(patient_id="éé日本"),
    "quotes": GOOD.replace('extension="ID4401"', "extension='ID4401'"),
    "spaces in tags": GOOD.replace('<age value="37"/>', '<age  value = "37" ></age >'),
    "line breaks": GOOD.replace('extension="ID4401"', 'extension="ID\n44\t01"'),
    "no department": GOOD.replace('<id extension="KS07"/>', ""),
    "capital": GOOD.replace("authenticator", "Authenticator"),
    "duplicate attribute": GOOD.replace('value="37"', 'value="37" value="38"'),
    "null word": inpatient(patient_id="null", age="37"), "nan": inpatient(patient_id="NaN"),
    "spaces": inpatient(patient_id="  ID  "), "number": inpatient(patient_id="0012300"),
}


def both(spark, documents):
    docs = literal_documents(spark, documents).repartition(2)
    exact, jvm = ({r["path"]: r.asDict() for r in X.parse_fact(docs, keep=("path",), engine=e).collect()}
                  for e in ("exact", "jvm"))
    return exact, jvm


def test_every_shape_of_document(spark):
    exact, jvm = both(spark, list(CASES.items()))
    for name in CASES:
        assert jvm[name] == exact[name], name
    assert sum(r["err"] is None for r in jvm.values()) > 25


def test_mutated_documents(spark):
    rng = random.Random(8)
    bits = ["<", ">", "/", '"', "&amp;", " ", "<entry>", "</entry>", "JB", "2", "<component>", "x:", "<!---->",
            "<authenticator/>", "</section>", "é"]
    documents = []
    for i in range(300):
        text = rng.choice([GOOD, CASES["nested section"], CASES["xsi"]])
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice([rng.choice(bits), ""]) + text[at + rng.choice([0, 0, 1, 7]):]
        documents.append((str(i), text))
    exact, jvm = both(spark, documents)
    for k, text in documents:
        assert jvm[k] == exact[k], text


def test_regular_documents_stay_in_the_jvm(spark):
    docs = literal_documents(spark, [("a", GOOD), ("b", CASES["other disease"]), ("c", CASES["comment"])])
    parsed = X.parse_fact(docs, keep=("path",), engine="jvm")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1 and plan.count("ArrowEvalPython") == 1
    with pytest.raises(Exception, match="outSickId"):
        X.parse_fact(docs, keep=("path",), on_error="fail", engine="jvm").collect()
    assert X.parse_fact(docs.filter(F.col("path") != "b"), keep=("path",), on_error="fail",
                        engine="jvm").count() == 2
