"""Clinical documents assembled from the driver's TPC-H-like tables.

One HL7 v3 document per order, built as one ``concat`` of template pieces so the whole
assembly is one Catalyst plan.  The values are plain columns of the source
tables, so an oracle can compute every extracted field straight from the
tables without ever parsing XML.

Sources per document:

* order            -> row key, document type, times, title
* customer         -> patient id, gender, age, department
* nation, region   -> address city / county
* lineitem         -> attending doctor and diagnosis (first line), resident
                      and secondary finding (last line), via an aggregate
                      per order that combines map-side (no collected groups).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import compact_time
from .tables import read_table

DOC_TEMPLATE = (
    '<?xml version="1.0" encoding="UTF-8"?>\n'
    '<ClinicalDocument xmlns="urn:hl7-org:v3" '
    'xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">\n'
    '<realmCode code="CN"/>\n'
    '<!-- document serial -->\n'
    '<id root="2.999.%1$s.1" extension="%2$s"/>\n'
    '<code code="C00%1$s"/>\n'
    '<title>%3$s</title>\n'
    '<effectiveTime value="%4$s"/>\n'
    '<languageCode code="%5$s"/>\n'
    '<recordTarget typeCode="RCT"><patientRole>\n'
    '<id root="2.999.9.1" extension="%6$s"/>\n'
    '<addr><city>%7$s</city><county>%8$s</county></addr>\n'
    '<patient><id root="2.999.9.2" extension="ID%9$s"/>'
    '<administrativeGenderCode code="%10$s"/><age unit="a" value="%11$s"/></patient>\n'
    '</patientRole></recordTarget>\n'
    '<legalAuthenticator><assignedEntity><id extension="DR2%12$s"/></assignedEntity>'
    '</legalAuthenticator>\n'
    '<authenticator><assignedEntity><id extension="ID%9$s"/></assignedEntity></authenticator>\n'
    '%13$s'
    '<componentOf><encompassingEncounter>'
    '<effectiveTime><low value="%4$s"/></effectiveTime>\n'
    '<location><healthCareFacility><serviceProviderOrganization>'
    '<asOrganizationPartOf><wholeOrganization><id extension="WD%6$s"/>'
    '<asOrganizationPartOf><wholeOrganization><id extension="%14$s"/><name>%7$s</name>'
    '</wholeOrganization></asOrganizationPartOf>'
    '</wholeOrganization></asOrganizationPartOf>'
    '</serviceProviderOrganization></healthCareFacility></location>\n'
    '</encompassingEncounter></componentOf>\n'
    '<component><structuredBody>\n'
    '<component><section><code displayName="Diagnosis"/>\n'
    '%15$s'
    '<entry><observation><code><qualifier><name/></qualifier></code></observation></entry>\n'
    '</section></component>\n'
    '</structuredBody></component>\n'
    '</ClinicalDocument>\n'
)
DOCTORS_TEMPLATE = (
    '<authenticator><assignedEntity><id extension="DR2%s"/></assignedEntity></authenticator>\n'
    '<authenticator><assignedEntity><id extension="DR1%s"/></assignedEntity></authenticator>\n'
)
DIAGNOSIS_TEMPLATE = (
    '<entry><observation><code code="DX-MAIN"><qualifier>'
    '<name displayName="JB%s"/></qualifier></code></observation></entry>\n'
    '<entry><observation><code code="DX-OTHER"><qualifier>'
    '<name displayName="ZD%s"/></qualifier></code></observation></entry>\n'
)


def fill_template(template: str, *args) -> F.Column:
    """``template`` with ``%N$s`` / ``%s`` placeholders filled by ``args``,
    as one ``concat`` of literals and columns (code-generated, unlike
    ``format_string``, which parses the format on every row)."""
    pieces = re.split(r"(%\d+\$s|%s)", template)
    cols, auto = [], 0
    for piece in pieces:
        if not piece:
            continue
        m = re.fullmatch(r"%(\d+)\$s", piece)
        if m or piece == "%s":
            if m:
                arg = args[int(m.group(1)) - 1]
            else:
                arg, auto = args[auto], auto + 1
            cols.append(F.col(arg) if isinstance(arg, str) else arg)
        else:
            cols.append(F.lit(piece))
    return F.concat(*cols)


def padded(number: F.Column, width: int) -> F.Column:
    """``%0<width>d`` of a number; only odd ones (negative, null) go through the
    format, which is parsed on every row."""
    text = number.cast("string")
    return F.when(number >= 0, F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
                  ).otherwise(F.format_string(f"%0{width}d", number))


def order_document_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-order values that go into a document (no XML yet)."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    lines = (read_table(spark, sf_dir, "lineitem")
             .select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
             .groupBy("l_orderkey")
             # (order, line) is not unique: order whole lines, so ties on the
             # line number resolve the same way on every run.
             .agg(F.min(F.struct("l_linenumber", "l_suppkey", "l_partkey")).alias("first"),
                  F.max(F.struct("l_linenumber", "l_suppkey", "l_partkey")).alias("last"))
             .select("l_orderkey",
                     F.col("first.l_suppkey").alias("first_supp"),
                     F.col("first.l_partkey").alias("first_part"),
                     F.col("last.l_suppkey").alias("last_supp"),
                     F.col("last.l_partkey").alias("last_part")))
    # nation (25 rows) and region (5 rows) are fixed-size reference tables.
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    # Orders meet their customers first, and are then hash-partitioned by key: the
    # exchange the join with the per-order line aggregate needs anyway.  It spreads
    # the CPU-bound document work over all tasks, however small the table's files,
    # large the customer table or frequent a customer is.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .repartition(parts, "o_orderkey")
            # an order without lines keeps its document, minus doctors and
            # diagnoses (the fact job then rejects it)
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, content)`` — the shape of a whole-document directory scan."""
    v = order_document_columns(spark, sf_dir)
    doc_type = F.coalesce((F.substring("o_orderpriority", 1, 1).cast("int") + 30).cast("string"),
                          F.lit("null"))
    row_key = F.concat(F.lit("RN"), doc_type, F.lit("_"), padded(F.col("o_orderkey"), 3))
    stamp = compact_time("o_orderdate")
    content = fill_template(
        DOC_TEMPLATE,
        doc_type,                                                    # 1
        row_key,                                                     # 2
        F.concat(F.lit("Inpatient record &amp; "), F.col("o_orderpriority")),  # 3
        stamp,                                                       # 4
        F.when(F.col("o_orderstatus") == "F", "zh-CN").otherwise("en-US"),  # 5
        F.col("o_orderkey").cast("string"),                          # 6
        F.col("n_name"),                                             # 7
        F.col("r_name"),                                             # 8
        F.col("o_custkey").cast("string"),                           # 9
        F.when(F.col("o_custkey") % 2 == 1, "1").otherwise("2"),     # 10
        (F.col("o_custkey") % 100).cast("string"),                   # 11
        F.coalesce(F.col("first_supp").cast("string"), F.lit("")),   # 12
        F.when(F.col("first_supp").isNotNull(),
               fill_template(DOCTORS_TEMPLATE, F.col("first_supp").cast("string"),
                             F.col("last_supp").cast("string")))
         .otherwise(""),                                              # 13
        F.concat(F.lit("KS"), padded(F.col("c_nationkey"), 2)),      # 14
        F.when(F.col("first_part").isNotNull(),
               fill_template(DIAGNOSIS_TEMPLATE, F.col("first_part").cast("string"),
                             F.col("last_part").cast("string")))
         .otherwise(""),                                              # 15
    )
    path = F.concat(F.lit("emr/"), doc_type, F.lit("/"), row_key, F.lit(".xml"))
    return v.select(path.alias("path"), content.alias("content"))
