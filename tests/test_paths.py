"""Node-set rules and the failure table of the header and fact fields
(pure Python: the evaluator that runs inside the Arrow UDF)."""

import re

import pytest

from medstar.functions import hl7, xml_paths
from medstar.functions.hl7 import FACT_FIELDS, HEADER_FIELDS
from medstar.functions.xml_paths import (Reject, evaluate_fields, jdiv, jdrop, jparse_int,
                                         jprefix, parse_path)
from tests.docs import inpatient


def fact(doc):
    return evaluate_fields(doc, FACT_FIELDS)


def header(doc):
    return evaluate_fields(doc, HEADER_FIELDS)


def rejected(fn, doc):
    with pytest.raises(Reject) as e:
        fn(doc)
    return str(e.value)


def test_good_document():
    f = fact(inpatient())
    assert f["idCard"] == "4401" and f["genderId"] == "2" and f["ageId"] == "3"
    assert (f["_city"], f["_county"]) == ("C1", "K1")
    assert f["inTimeId"] == "202403" and f["inClassId"] == "KS07"
    assert f["mainDocId"] == "DR2555" and f["outSickId"] == "JB042"
    h = header(inpatient())
    assert h == {"row_key": "RN32_101", "id": "2.1", "typeCode": "C0032",
                 "effectiveTime": "20240315101010", "title": "Inpatient",
                 "realmCode": "CN", "languageCode": "zh-CN"}


def test_second_top_level_id_fails_header():
    doc = inpatient(ids=('<id extension="A"/>', '<id extension="B"/>'))
    assert rejected(header, doc).startswith("row_key")


def test_titles_absent_or_repeated():
    assert header(inpatient(titles=()))["title"] == ""
    assert header(inpatient(titles=("<title>a</title>", "<title>b<i>c</i></title>")))["title"] == "abc"


def test_attending_doctor_cardinality():
    assert fact(inpatient(doctors=("DR1777",)))["mainDocId"] == ""        # none
    assert fact(inpatient(doctors=("DR2555", "DR2666")))["mainDocId"] == ""  # two
    assert rejected(fact, inpatient(doctors=("D2",))).startswith("mainDocId")  # too short
    # the patient's own signature counts when its third character is 2
    assert fact(inpatient(doctors=("ID2001", "DR2555")))["mainDocId"] == ""
    assert fact(inpatient(doctors=("ID3001", "DR2555")))["mainDocId"] == "DR2555"


def test_legal_authenticator_does_not_match():
    assert fact(inpatient(doctors=()))["mainDocId"] == ""


def test_age_rules():
    assert fact(inpatient(age="-5"))["ageId"] == "0"
    assert fact(inpatient(age="+42"))["ageId"] == "4"
    assert rejected(fact, inpatient(age="4x")).startswith("ageId")
    assert rejected(fact, inpatient(age="99999999999")).startswith("ageId")


def test_address_takes_first_and_needs_county():
    two = ("<addr><city>C1</city><county>K1</county></addr>",
           "<addr><city>C2</city><county>K2</county></addr>")
    f = fact(inpatient(addrs=two))
    assert (f["_city"], f["_county"]) == ("C1", "K1")
    assert rejected(fact, inpatient(addrs=("<addr><city>C</city></addr>",))).startswith("_county")


def test_admission_time():
    assert rejected(fact, inpatient(low='<low value="20240"/>')).startswith("inTimeId")
    assert rejected(fact, inpatient(low="")).startswith("inTimeId")
    two = '<low value="20240312"/><low value="20250101"/>'
    assert rejected(fact, inpatient(low=two)).startswith("inTimeId")


def test_diagnosis_rules():
    assert rejected(fact, inpatient(diagnoses=('<name displayName="ZD1"/>',))).startswith("outSickId")
    two = ('<name displayName="JB1"/>', '<name displayName="JB2"/>')
    assert rejected(fact, inpatient(diagnoses=two)).startswith("outSickId")
    assert rejected(fact, inpatient(diagnoses=('<name displayName="J"/>',))).startswith("outSickId")
    # a name without the attribute is skipped, not an error
    assert fact(inpatient(diagnoses=("<name/>", '<name displayName="JB7"/>')))["outSickId"] == "JB7"


def test_prefixed_names_match_by_local_name():
    doc = inpatient(root_open='<h:ClinicalDocument xmlns:h="urn:hl7-org:v3">').replace(
        "</ClinicalDocument>", "</h:ClinicalDocument>")
    assert header(doc)["row_key"] == "RN32_101"


def test_malformed_inputs():
    for bad in ["", "<ClinicalDocument", inpatient(tail="junk"),
                inpatient(tail="<second/>")]:
        assert rejected(fact, bad).startswith("content")
    assert rejected(fact, None) == "content: null"


def test_bom_entity_and_non_ascii():
    doc = "﻿" + inpatient(titles=("<title>&#x4e2d;&amp;</title>",))
    assert header(doc)["title"] == "中&"
    dt = ('<!DOCTYPE ClinicalDocument [<!ENTITY t "Ward">]>'
          + inpatient(titles=("<title>&t;</title>",)))
    assert header(dt)["title"] == "Ward"


def test_jvm_string_helpers():
    assert jdrop("I", 2) == "" and jdrop("ID12", 2) == "12"
    assert jprefix("\U0001F600abc", 2, "x") == "\U0001F600"
    with pytest.raises(Reject):
        jprefix("\U0001F600", 3, "x")
    assert jdiv(-5, 10) == 0 and jdiv(-15, 10) == -1 and jdiv(15, 10) == 1
    assert jparse_int("007", "x") == 7


def test_parse_path():
    steps = parse_path("a//b/@c")
    assert [(s.axis, s.name) for s in steps] == [("child", "a"), ("desc", "b"), ("attr", "c")]
    with pytest.raises(ValueError):
        parse_path("a/@b/c")


def test_declared_encoding_is_ignored_for_decoded_text():
    doc = '<?xml version="1.0" encoding="GB2312"?>' + inpatient(titles=("<title>住院病案</title>",))
    assert header(doc)["title"] == "住院病案"


def _both_ways(content, plan):
    """Result of a document as the operators read it, and by the XML parser."""
    out = []
    for read in (lambda: xml_paths.evaluate_fields(content, plan),
                 lambda: plan.evaluate(xml_paths.parse_document(content))):
        try:
            out.append(read())
        except xml_paths.Reject as e:
            out.append(str(e))
    return out


def _sample_document():
    return ('<?xml version="1.0" encoding="UTF-8"?>\n<ClinicalDocument xmlns="urn:hl7-org:v3" '
            'xmlns:x="urn:x"><!-- a - b -->\n<id root="1" extension="RN1"/><code code="C&amp;1"/>'
            '<title>A &amp; <b>bold</b> &lt;title&gt;</title><effectiveTime value="19950101"/>'
            '<realmCode code="CN"/><languageCode code="zh"/>\n<x:recordTarget><patientRole><addr>'
            '<city>北京</city><county>c</county></addr><patient><id extension="ID7"/>'
            '<administrativeGenderCode code="1"/><age value="42" unit="a"/></patient></patientRole>'
            '</x:recordTarget><authenticator><assignedEntity><id extension="DR21"/></assignedEntity>'
            '</authenticator><componentOf><encompassingEncounter><effectiveTime><low value="199501"/>'
            '</effectiveTime><location><healthCareFacility><serviceProviderOrganization>'
            '<asOrganizationPartOf><wholeOrganization><asOrganizationPartOf><wholeOrganization>'
            '<id x:extension="n" extension="KS1"/></wholeOrganization></asOrganizationPartOf>'
            '</wholeOrganization></asOrganizationPartOf></serviceProviderOrganization>'
            '</healthCareFacility></location></encompassingEncounter></componentOf>\n<component>'
            '<structuredBody><component><section><entry><observation><code><qualifier>'
            '<name displayName="JB1"/></qualifier></code></observation></entry></section></component>'
            '</structuredBody></component></ClinicalDocument>\n')


def test_plain_scan_equals_the_parser_on_damaged_documents():
    import random
    rng, doc = random.Random(3), _sample_document()
    odd = ['"', "'", "<", ">", "&", "&lt;", "&amp", "&#65;", "\r\n", "\r", "\t", "\n", "\x01", "﻿",
           "￾", "\x85", "\U0001f600", "]]>", "<!-- -->", "<!---->", "<!-- -- -->", "<![CDATA[x]]>",
           "<?pi x?>", ' extension="ID8"', ' x:a="1" x:b="2"', ' y:a="1"', ' xmlns:y="urn:x"', ' xmlns=""',
           ' xml:lang="en"', "<component>", "</component>", "<section><entry/></section>",
           "<authenticator><authenticator/></authenticator>", "<x:id/>", "<y:id/>", "<id/>", " ", ":", "="]
    plans = [xml_paths.FieldPlan(hl7.FACT_FIELDS), xml_paths.FieldPlan(hl7.HEADER_FIELDS)]
    pieces = re.findall(r"<[^>]*>|[^<]+", doc)
    plain = 0
    for i in range(12_000):
        text = doc
        if i % 3 == 0:                                   # markup moved, doubled or left out
            parts = list(pieces)
            for _ in range(rng.randint(1, 2)):
                a, b = rng.randrange(len(parts)), rng.randrange(len(parts))
                parts[a:a + rng.randint(0, 3)] = parts[b:b + rng.randint(0, 6)]
            text = "".join(parts)
        else:
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(text) + 1)
                text = text[:at] + rng.choice(odd) + text[at + rng.choice((0, 0, 1, 9)):]
        for plan in plans:
            got, expected = _both_ways(text, plan)
            assert got == expected, text
            plain += plan.scan.node_sets(text) is not None
    assert plain > 3_000


def test_plain_scan_reads_nested_sections_and_texts():
    section = ("<section><entry><observation><code><qualifier><name displayName='{}'/></qualifier>"
               "</code></observation></entry>{}</section>").replace("'", '"')
    inner = f"<component>{section.format('JB2', '')}</component>"
    plan = xml_paths.FieldPlan(hl7.FACT_FIELDS)
    for old, new in [("<section><entry>", f"<section>{inner}<entry>"),
                     ("<county>c</county>", "<county>c<i>d<i>e</i></i>f</county>"),
                     ("<county>c</county>", "<county>he said \"c\"</county>"),
                     ("<ClinicalDocument", ' "x"<ClinicalDocument'),
                     ("<authenticator>", "<authenticator><authenticator><assignedEntity>"
                                         "<id extension=\"DR22\"/></assignedEntity></authenticator>")]:
        text = _sample_document().replace(old, new, 1)
        got, expected = _both_ways(text, plan)
        assert got == expected, text


def test_plain_scan_reads_the_documents_of_the_queries_and_stays_small():
    scan = xml_paths.FieldPlan(hl7.FACT_FIELDS).scan
    assert scan.node_sets(_sample_document()) is not None     # no tree is built for it
    scan.ROOM = 10_000
    for i in range(200):                                      # every text is another
        doc = _sample_document().replace("bold", f"text {i} " + "z" * (i % 50))
        assert scan.node_sets(doc) is not None
        assert scan.kept <= scan.ROOM + 10_000


def test_documents_of_one_skeleton_are_read_by_numbers():
    plan = xml_paths.FieldPlan(hl7.FACT_FIELDS)
    docs = [_sample_document().replace("<county>c", f"<county>c &amp; {i}").replace('"DR21"', f'"DR2{i}&lt;"')
            for i in range(5)]
    for doc in docs[:2]:
        xml_paths.evaluate_fields(doc, plan)
    kept = plan.scan.kept
    for i, doc in enumerate(docs):
        got, expected = _both_ways(doc, plan)
        assert got == expected
        out = xml_paths.evaluate_fields(doc, plan)
        assert (out["_county"], out["mainDocId"]) == (f"c & {i}", f"DR2{i}<")
    assert plan.scan.kept == kept                 # own texts leave nothing behind


def test_numbered_reading_equals_the_parser_on_damaged_values_and_texts():
    import random
    rng, doc = random.Random(11), _sample_document()
    odd = ["'", ">", "&", "&lt;", "&amp", "&#65;", "\r\n", "\r", "\t", "\n", "\x01", "﻿", "\x85", "\U0001f600",
           "]]>", "-->", "--", "<!-- a -->", "<!-- > -->", "<![CDATA[x]]>", "<?pi x?>", "/", "7", "\n> 7", " ", "é",
           '"', '"x"', "<i/>", "x > 1", "\x00", ">\x00<"]
    pieces = re.findall(r"<[^>]*>|[^<]+", doc)
    numbered = 0
    for i in range(1_500):
        parts = list(pieces)
        if i % 3:                                   # another skeleton
            a, b = rng.randrange(len(parts)), rng.randrange(len(parts))
            parts[a:a + rng.randint(0, 2)] = parts[b:b + rng.randint(0, 4)]
        for _ in range(i % 4):                      # texts and comments between tags
            parts.insert(rng.randrange(len(parts)), rng.choice(odd + ["text", "\n text", "<!-- c -->", "<!-- a > b"]))
        text = "".join(parts)
        plans = [xml_paths.FieldPlan(hl7.FACT_FIELDS), xml_paths.FieldPlan(hl7.HEADER_FIELDS)]
        for plan in plans:
            for _ in range(2):                      # now the skeleton is known
                got, expected = _both_ways(text, plan)
                assert got == expected, text
        for _ in range(4):                          # other values and texts in it
            spots = [m.end() for m in re.finditer(r'="|>', text)]
            other = text
            for at in sorted(rng.sample(spots, min(len(spots), rng.randint(1, 2))), reverse=True):
                other = other[:at] + rng.choice(odd) + other[at + rng.choice((0, 0, 1)):]
            for plan in plans:
                got, expected = _both_ways(other, plan)
                assert got == expected, (text, other)
                cut = plan.scan.cut(other)
                numbered += cut is not None and plan.scan.fits(cut)
    assert numbered > 500


def test_frequent_skeletons_are_matched_at_once_and_equal_the_parser():
    import random
    rng, doc = random.Random(17), _sample_document()
    odd = ["'", ">", "&", "&lt;", "&amp", "&#65;", "\r\n", "\r", "\t", "\n", "\x01", "\x7f", "\x85", "﻿", "￾",
           "\U0001f600", "]]>", "]", "-->", "<!-- a -->", "<![CDATA[x]]>", "<?pi x?>", "/", "é", "北", '"', "<i/>",
           "x > 1", "\x00", "}", ""]
    shapes = [doc, doc.replace("<county>c</county>", "<county>c<i>d</i> e</county>"),
              doc.replace("</entry>", "</entry>" + doc[doc.index("<entry>"):doc.index("</section>")], 1),
              doc.replace('<?xml version="1.0" encoding="UTF-8"?>\n', "").replace("<city>北京</city>", "")]
    plans = [xml_paths.FieldPlan(hl7.FACT_FIELDS), xml_paths.FieldPlan(hl7.HEADER_FIELDS)]
    matched = 0
    for shape in shapes:
        for plan in plans:
            for i in range(60):
                text = shape.replace('"ID7"', f'"ID{i}"')
                assert _both_ways(text, plan)[0] == _both_ways(text, plan)[1]
            assert plan.last is not None and plan.last.pattern.fullmatch(shape)
        for _ in range(1_000):                      # other values, texts, now and then other markup
            spots = [m.end() for m in re.finditer(r'="|>', shape)]
            other = rng.choice(["", "", "", "﻿"]) + shape
            for at in sorted(rng.sample(spots, rng.randint(0, 2)), reverse=True):
                end = at + rng.choice((0, 0, 1, len(re.match('[^"<]*', shape[at:])[0])))
                other = other[:at] + rng.choice(odd) + other[end:]
            for plan in plans:
                got, expected = _both_ways(other, plan)
                assert got == expected, other
                matched += plan.last.pattern.fullmatch(other) is not None
    assert matched > 1_500


def test_a_pattern_refuses_namespaces_that_the_parser_refuses():
    plan, doc = xml_paths.FieldPlan(hl7.FACT_FIELDS), _sample_document()
    for _ in range(60):
        xml_paths.evaluate_fields(doc, plan)
    for uri in ("", "a}b", "http://www.w3.org/2000/xmlns/", "urn:y"):
        got, expected = _both_ways(doc.replace('"urn:x"', f'"{uri}"'), plan)
        assert got == expected, uri
