"""

``entry(spark)`` runs the flagship job (documents -> wide table -> inpatient
range scan -> patient fact) on sf0.001.  ``queries()`` holds one callable per
the same result straight from the tables, never parsing XML.

Documents are assembled inside each query from the driver tables
(``medstar.sources.seed``), so every query's work grows with the tables.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medstar.functions.hl7 import INPATIENT_RANGE
from medstar.functions.text import compact_time, utf8_decode, utf8_encode
from medstar.operators import extract as X
from medstar.operators.cube import (CubeDef, CubeStore, month_of, ms_of, time_bounds,
                                    time_rejects)
from medstar.operators.delimited import PLAYER_CELLS, PLAYER_FAMILIES, parse_delimited
from medstar.operators.item_stats import item_rejects, item_statistics
from medstar.operators.star import heavy_keys, star_join
from medstar.operators.wide_table import DOCUMENT_FAMILIES, WideTable
from medstar.plans import catalog, jobs, warehouse
from medstar.plans.dimensions import derived_dimensions, dimension_frames, load_dimensions
from medstar.session import scratch_path
from medstar.sources.documents import read_documents, write_documents
from medstar.sources.seed import fill_template, order_documents
from medstar.sources.tables import TABLES, read_table

SMOKE_DIR = "/root/testdata/sf0.001"


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _ingested(spark: SparkSession, sf_dir: str) -> WideTable:
    docs = order_documents(spark, sf_dir)
    return jobs.ingest_documents(spark, docs, _name("emr"), version=1,
                                 location=scratch_path(spark, "emr"))


def _wide(spark: SparkSession, name: str, families=DOCUMENT_FAMILIES) -> WideTable:
    return WideTable.create(spark, _name(name), families, scratch_path(spark, name))


# ------------------------------------------------------------- queries ----

def q_header_extract(spark, sf_dir):
    docs = order_documents(spark, sf_dir)
    return X.good(X.extract_header(docs, keep=("path",), engine="exact"))


def q_header_extract_jvm(spark, sf_dir):
    docs = order_documents(spark, sf_dir)
    return X.good(X.extract_header(docs, keep=("path",), engine="jvm"))


def q_fact_extract(spark, sf_dir):
    docs = order_documents(spark, sf_dir)
    return X.patient_fact(docs, keep=("path",))


def q_fact_extract_jvm(spark, sf_dir):
    """Documents of the regular shape stay in the JVM."""
    return X.patient_fact(order_documents(spark, sf_dir), keep=("path",), engine="jvm")


def q_fact_rejects_jvm(spark, sf_dir):
    parsed = X.parse_fact(order_documents(spark, sf_dir), keep=("path",), engine="jvm")
    return X.rejects(parsed, key="path")


def q_fact_rejects(spark, sf_dir):
    docs = order_documents(spark, sf_dir)
    return X.rejects(X.parse_fact(docs, keep=("path",)), key="path")


def q_range_scan(spark, sf_dir):
    wt = _ingested(spark, sf_dir)
    return wt.scan(["basic:typeCode", "specific:title"], key_range=INPATIENT_RANGE)


def q_inpatient_fact(spark, sf_dir):
    return jobs.fact_job(_ingested(spark, sf_dir))


def q_column_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    wt = _wide(spark, "docs")
    wt.put(wt.cells(docs, F.format_string("DOC%08d", "doc_id"), {
        "specific:content": "text",
        "specific:title": F.when(F.col("lang") == "en", F.col("lang")),
    }), version=1)
    return wt.scan(["specific:title", "specific:content"], require=["specific:title"])


def q_cell_upsert_latest(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    doc_type = (F.substring("o_orderpriority", 1, 1).cast("int") + 30).cast("string")
    key = F.format_string("RN%s_%03d", doc_type, F.col("o_orderkey"))
    wt = _wide(spark, "upsert")
    # batch 1: every order, header cells
    wt.put(wt.cells(o, key, {
        "basic:id": F.col("o_orderkey"),
        "basic:typeCode": F.concat(F.lit("C00"), doc_type),
        "basic:effectiveTime": compact_time("o_orderdate"),
        "specific:title": F.concat(F.lit("Order "), F.col("o_orderpriority")),
    }, source=F.lit("batch-1")), version=1)
    # batch 2: finished orders get an amended title and time (written twice:
    # a rerun replaces the batch, it does not duplicate it)
    done = o.filter(F.col("o_orderstatus") == "F")
    amended = wt.cells(done, key, {
        "specific:title": F.concat(F.lit("Amended "), F.col("o_orderpriority")),
        "basic:effectiveTime": compact_time(F.date_add("o_orderdate", 1)),
    }, source=F.lit("batch-2"))
    wt.put(amended, version=2)
    wt.put(amended, version=2)
    # batch 3: single-cell writes for urgent orders
    urgent = o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        key.alias("row_key"), F.lit("basic").alias("family"),
        F.lit("typeCode").alias("qualifier"), F.lit("C0099").alias("value"))
    wt.put_cells(urgent, version=3)
    return wt.scan(["basic:id", "basic:typeCode", "basic:effectiveTime", "specific:title"])


def _delimited(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    salary = F.when(F.col("p_size") > 45, F.lit("")).otherwise(
        F.format_string("%.2f", "p_retailprice"))
    lines = p.select(F.concat_ws(",", F.concat(F.lit("row"), F.col("p_partkey")),
                                 F.col("p_size"), F.col("p_name"), F.col("p_brand"),
                                 salary).alias("line"))
    return parse_delimited(lines, keep=("line",))


def q_delimited_rejects(spark, sf_dir):
    return _delimited(spark, sf_dir).filter("err is not null").select("line", "err")


def q_delimited_parse(spark, sf_dir):
    parsed = X.good(_delimited(spark, sf_dir)).drop("line")
    wt = _wide(spark, "player", PLAYER_FAMILIES)
    wt.put(wt.cells(parsed, "row_key", PLAYER_CELLS), version=1)
    return wt.scan(["cf1:name", "cf1:age", "cf2:gender", "cf2:salary"])


def q_first_document(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select(
        F.format_string("docs/%08d.txt", "doc_id").alias("path"),
        F.col("text").alias("content"))
    wt = jobs.upload_first_document(spark, d, _name("upload"), version=1,
                                    location=scratch_path(spark, "upload"))
    return wt.scan(["specific:content"])


def q_upsert_compacted(spark, sf_dir):
    """Batches before and after a compaction, the last one older than those
    that the compaction has folded."""
    o = read_table(spark, sf_dir, "orders")
    wt = _wide(spark, "compacted")

    def cells(rows, title, time):
        return wt.cells(rows, F.format_string("RN%03d", "o_orderkey"),
                        {"specific:title": title, "basic:effectiveTime": time})

    wt.put(cells(o, F.concat(F.lit("first "), F.col("o_orderpriority")), F.lit("1")), version=2)
    done = o.filter("o_orderstatus = 'F'")
    wt.put(cells(done, F.lit("second"), F.lit(None)), version=3)
    wt.compact()
    wt.put(cells(o.filter("o_orderkey % 2 = 0"), F.lit("third"), F.lit(None)), version=4)
    wt.put(cells(o, F.lit("older"), F.lit("0")), version=1)
    wt.maintain(2)
    return wt.scan(["specific:title", "basic:effectiveTime"])


def q_open_cells(spark, sf_dir):
    """Single cells, most of them with qualifiers that no family declares."""
    p = read_table(spark, sf_dir, "part").select(
        F.format_string("P%05d", "p_partkey").alias("row_key"), F.lit("basic").alias("family"),
        F.explode(F.array(
            F.struct(F.lit("id").alias("qualifier"), F.col("p_name").alias("value")),
            F.struct(F.col("p_brand").alias("qualifier"), F.col("p_size").cast("string").alias("value")),
            F.struct(F.lit("size").alias("qualifier"), F.col("p_size").cast("string").alias("value"))
        )).alias("c")).select("row_key", "family", "c.*")
    wt = _wide(spark, "open")
    wt.put_cells(p, version=1)
    return wt.cell_rows()


# Header of one supplier's document; every tenth is cut short.
_SUPPLIER_DOC = (
    '<ClinicalDocument xmlns="urn:hl7-org:v3"><realmCode code="CN"/>'
    '<id root="2.999.1" extension="S%1$s"/><code code="C0031"/><title>%2$s</title>'
    '<effectiveTime value="19950101000000"/><languageCode code="en"/>%3$s')


def q_directory_ingest(spark, sf_dir):
    """Documents written as files, read back as a folder, ingested; good
    documents and rejects by file."""
    s = read_table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    end = F.when(F.col("s_suppkey") % 10 == 0, "").otherwise("</ClinicalDocument>")
    folder = scratch_path(spark, "documents")
    write_documents(s.select(fill_template(_SUPPLIER_DOC, key, F.col("s_name"), end).alias("value"),
                             F.concat(F.lit("S"), key).alias("name")), folder)
    table, location = _name("folder"), scratch_path(spark, "folder")
    wt = jobs.ingest_documents(spark, read_documents(spark, folder), table, 1, location=location)
    bad = spark.table(f"{table}_rejects").select(
        F.regexp_extract("path", "name=([^/]+)/", 1).alias("row_key"),
        F.lit("rejected").alias("outcome"), F.lit(None).cast("string").alias("title"))
    return wt.scan(["specific:title"]).select(
        "row_key", F.lit("good").alias("outcome"), F.col("specific_title").alias("title")
    ).unionByName(bad)


def q_fact_store(spark, sf_dir):
    """E2 with its sink: the fact appended to the warehouse fact table."""
    fact = jobs.fact_job(_ingested(spark, sf_dir))
    db = _name("emr_dw")
    table = f"{db}.t_fact_patient"
    current = spark.catalog.currentDatabase()
    try:
        warehouse.create_database(spark, db)
        jobs.store_fact(spark, fact, table, location=scratch_path(spark, "fact-table"))
    finally:
        spark.catalog.setCurrentDatabase(current)
    shown = warehouse.show_tables(spark, db).filter("not isTemporary").select("tableName")
    return spark.table(table).withColumn("tableName", F.lit("t_fact_patient")).join(
        F.broadcast(shown), "tableName")


def q_fact_preview(spark, sf_dir):
    """The first facts by row key as text lines."""
    fact = jobs.fact_job(_ingested(spark, sf_dir)).orderBy("row_key")
    lines = warehouse.preview(fact, 20).split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")


def q_text_bytes(spark, sf_dir):
    """Texts as UTF-8 bytes and back."""
    d = read_table(spark, sf_dir, "documents").withColumn("bytes", utf8_encode("text"))
    return d.select("doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"),
                    F.md5("bytes").alias("digest"),
                    utf8_decode("bytes").eqNullSafe(F.col("text")).alias("same"))


def q_row_count(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n_rows"))


def q_row_sample(spark, sf_dir):
    wt = _ingested(spark, sf_dir)
    return wt.sample(0.5, seed=7, cells=["basic:typeCode"]).select(
        "row_key", F.col("basic.typeCode").alias("basic_typeCode"))


def _fact_table(spark, sf_dir):
    """The patient fact of every order document, written once and read back
    (builds reuse it instead of parsing again)."""
    fact = X.patient_fact(order_documents(spark, sf_dir), keep=("path",))
    path = scratch_path(spark, "fact")
    fact.write.parquet(path)
    return spark.read.parquet(path)


def q_star_join(spark, sf_dir):
    fact = X.patient_fact(order_documents(spark, sf_dir), keep=("path",))
    return star_join(fact, derived_dimensions(spark, sf_dir))


def q_star_join_hot(spark, sf_dir):
    """A doctor has a third of all facts: dealt over parts, same rows."""
    fact = _fact_table(spark, sf_dir).withColumn("mainDocId", F.when(
        F.col("idCard").cast("long") % 3 == 0, "DR21").otherwise(F.col("mainDocId")))
    dims = derived_dimensions(spark, sf_dir)
    return star_join(fact, dims, heavy=heavy_keys(fact, dims))


# ---- fixed values: cube of the contract queries ---------------------------
CUBE_DIMS = ["genderId", "ageId", "inClassId"]
# ---------------------------------------------------------------------------


def _years(fact):
    """Starts of the years that hold the fact's months (epoch ms)."""
    lo, hi = (month_of(b) for b in time_bounds(fact))
    last = int(hi[:4]) + (hi[4:] != "01")
    return [ms_of(f"{y}01") for y in range(int(lo[:4]), last + 1)]


def _store(spark):
    return CubeStore(spark, scratch_path(spark, "cubes"))


def _cuboid_rows(store, name):
    return store.cuboids(name).select("gid", *CUBE_DIMS, "n_visits", "first_month",
                                      "last_month")


def _visits(spark, sf_dir):
    """The fact, its bounds from the data, and a store with the cube defined."""
    fact = _fact_table(spark, sf_dir)
    store = _store(spark)
    store.define(CubeDef("visits", CUBE_DIMS, project="emr"))
    return fact, time_bounds(fact), store


def q_cube_build(spark, sf_dir):
    fact, bounds, store = _visits(spark, sf_dir)
    store.build("visits", fact, *bounds, build_type="BUILD")
    return _cuboid_rows(store, "visits")


def q_cube_refresh(spark, sf_dir):
    fact, _, store = _visits(spark, sf_dir)
    years = _years(fact)
    store.build_segments("visits", fact.filter(F.col("genderId") == "1"), years)
    for lo, hi in zip(years, years[1:]):
        store.build("visits", fact, lo, hi, build_type="REFRESH")
    return _cuboid_rows(store, "visits")


def q_cube_refresh_empty(spark, sf_dir):
    """The first year is refreshed from a fact that has lost its rows."""
    fact, _, store = _visits(spark, sf_dir)
    years = _years(fact)
    store.build_segments("visits", fact, years)
    store.build("visits", fact.filter(F.col("inTimeId") >= month_of(years[1])), years[0], years[1],
                build_type="REFRESH")
    return _cuboid_rows(store, "visits")


def q_cube_merge(spark, sf_dir):
    fact, _, store = _visits(spark, sf_dir)
    years = _years(fact)
    store.build_segments("visits", fact, years)
    store.build("visits", fact, years[0], years[-1], build_type="MERGE")
    return _cuboid_rows(store, "visits")


def q_cube_purge(spark, sf_dir):
    """Purged after a build by years, then built anew as one segment."""
    fact, bounds, store = _visits(spark, sf_dir)
    store.build_segments("visits", fact, _years(fact))
    store.purge("visits")
    store.build("visits", fact, *bounds)
    return _cuboid_rows(store, "visits")


def q_cube_query(spark, sf_dir):
    fact, bounds, store = _visits(spark, sf_dir)
    store.build("visits", fact, *bounds)
    store.disable("visits")
    store.enable("visits")
    return store.query("visits", ["genderId", "ageId"],
                       where={"inClassId": ["KS01", "KS02", "KS03"]})


def q_cube_patients(spark, sf_dir):
    """Exact numbers of patients, merged over the segments and both ways up."""
    fact = _fact_table(spark, sf_dir)
    store = _store(spark)
    store.define(CubeDef("patients", CUBE_DIMS, exact_patients=True))
    years = _years(fact)
    store.build_segments("patients", fact, years[:-1])
    store.build("patients", fact, years[-2], years[-1])      # new patients are numbered on
    store.build("patients", fact, years[0], years[2], build_type="MERGE")
    out = None
    for i, group in enumerate([CUBE_DIMS, ["genderId", "ageId"], ["inClassId"], []]):
        part = store.exact_patients("patients", group).select(
            F.lit(i).alias("grouping"), *[(F.col(d) if d in group else F.lit(None).cast("string"))
                                          .alias(d) for d in CUBE_DIMS], "n_patients")
        out = part if out is None else out.unionByName(part)
    return out


def q_cube_malformed_months(spark, sf_dir):
    """Facts of a class have no month: the cube holds the others, the rest is
    listed."""
    fact = _fact_table(spark, sf_dir).withColumn("inTimeId", F.when(
        F.col("inClassId") == "KS03", F.concat(F.substring("inTimeId", 1, 5), F.lit("x")))
        .otherwise(F.col("inTimeId")))
    store = _store(spark)
    store.define(CubeDef("visits", ["genderId", "inClassId"]))
    store.build("visits", fact, *time_bounds(fact))
    bad = time_rejects(fact).groupBy("inTimeId", "reason").agg(F.count("*").alias("n_visits"))
    good = store.query("visits", ["inClassId"])
    return good.select("inClassId", "first_month", "last_month", F.lit("").alias("reason"),
                       "n_visits").unionByName(
        bad.select(F.lit("KS03").alias("inClassId"), F.col("inTimeId").alias("first_month"),
                   F.col("inTimeId").alias("last_month"), "reason", "n_visits"))


def q_cube_wipe(spark, sf_dir):
    """Q11: two cached cube views; the cubes change, and only the one that is
    wiped by name shows its new rows."""
    fact, bounds, store = _visits(spark, sf_dir)
    store.define(CubeDef("other", CUBE_DIMS))
    some = fact.filter(F.col("genderId") == "1")
    prefix = _name("wipe") + "_"
    for name in ("visits", "other"):
        store.build(name, some, *bounds)
    store.register_views(prefix)
    for name in ("visits", "other"):
        spark.catalog.cacheTable(f"{prefix}{name}")
        spark.table(f"{prefix}{name}").count()
    store.build("visits", fact, *bounds, build_type="REFRESH")
    catalog.wipe_cache(spark, "CUBE", "visits", store=store, prefix=prefix)
    out = None
    for name in ("visits", "other"):
        part = spark.table(f"{prefix}{name}").select(
            F.lit(name).alias("cube"), "gid", *CUBE_DIMS, "n_visits")
        out = part if out is None else out.unionByName(part)
    rows = scratch_path(spark, "cube-wipe")
    out.write.parquet(rows)
    catalog.wipe_cache(spark, "CUBE", "other", action="drop", prefix=prefix)
    catalog.wipe_cache(spark, "CUBE", "visits", action="drop", prefix=prefix)
    return spark.read.parquet(rows)


def q_cube_describe(spark, sf_dir):
    """Segments of a cube and the model it is built from."""
    fact, _, store = _visits(spark, sf_dir)
    store.build_segments("visits", fact, _years(fact))
    return store.describe("visits").join(
        store.model("visits").select("cube", "model", "dimensions", "time_column", "measures"),
        "cube")


def q_cube_listing(spark, sf_dir):
    fact = _fact_table(spark, sf_dir)
    bounds = time_bounds(fact)
    store = _store(spark)
    store.define(CubeDef("visits_by_class", ["genderId", "inClassId"], project="emr"))
    store.define(CubeDef("visits_by_age", ["ageId"], project="emr"))
    store.define(CubeDef("sickness", ["outSickId"], project="research"))
    store.build("visits_by_class", fact, *bounds)
    store.build("visits_by_age", fact, *bounds)
    listing = store.list_cubes(offset=0, limit=10, name_contains="visits", project="emr")
    counts = None
    for name in ("visits_by_class", "visits_by_age"):
        c = store.cuboids(name).agg(F.count(F.lit(1)).alias("n_rows")) \
            .withColumn("name", F.lit(name))
        counts = c if counts is None else counts.unionByName(c)
    return listing.join(counts, "name", "left")


def q_dimension_load(spark, sf_dir):
    """E3 into warehouse tables, read back as (dimension, key, label)."""
    frames = dimension_frames(spark, sf_dir)
    tables = load_dimensions(spark, frames, _name("emr_dw"), scratch_path(spark, "dims"))
    out = None
    for table in tables:
        t = spark.table(table)
        key, label = t.columns[0], t.columns[1]
        part = t.select(F.lit(table.rsplit("t_dimension_", 1)[1]).alias("dimension"),
                        F.col(key).alias("dim_key"), F.col(label).alias("label"))
        out = part if out is None else out.unionByName(part)
    return out


_PROJECT_TABLES = ",".join(TABLES)


def q_table_listing(spark, sf_dir):
    project = _name("project")
    catalog.load_tables(spark, _PROJECT_TABLES, project, sf_dir, analyze=False)
    return catalog.queryable_columns(spark, project)


def q_table_stats(spark, sf_dir):
    project = _name("project")
    catalog.load_tables(spark, _PROJECT_TABLES, project, sf_dir, analyze=True)
    return catalog.table_stats(spark, project).select("table_name", "n_rows")


def q_column_stats(spark, sf_dir):
    project = _name("project")
    catalog.load_tables(spark, _PROJECT_TABLES, project, sf_dir, analyze=True)
    return catalog.column_stats(spark, project)


def _scores(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.substring("o_orderpriority", 1, 1).alias("paper_code"),
        compact_time("o_orderdate", 4).alias("create_time"),
        F.col("o_orderkey").alias("student"), F.col("l_linenumber").alias("item_id"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("score"))


FULL_MARK = 5.0


_DECIMAL_STATS = ["avg_score", "fc_score", "bzc_score", "nandu", "qufendu"]


def _as_double(df):
    """The decimal(4,3) statistics as doubles, for a type-neutral compare."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in _DECIMAL_STATS else F.col(c)
                       for c in df.columns])


def q_item_stats(spark, sf_dir):
    return _as_double(item_statistics(_scores(spark, sf_dir), FULL_MARK))


def q_item_rejects(spark, sf_dir):
    """Raw quantities as marks: means and variances that decimal(4,3) can't hold."""
    li = read_table(spark, sf_dir, "lineitem")
    scores = li.select(
        F.col("l_returnflag").alias("paper_code"), F.lit("all").alias("create_time"),
        F.col("l_orderkey").alias("student"), F.col("l_linenumber").alias("item_id"),
        F.col("l_quantity").cast("int").alias("score"))
    return item_rejects(scores, 50.0)


def q_partitioned_table(spark, sf_dir):
    db = _name("test_emr")
    current = spark.catalog.currentDatabase()
    try:
        warehouse.create_database(spark, db)
        table = f"{db}.t_item_index"
        warehouse.create_item_index(spark, table, location=scratch_path(spark, "item_index"))
        warehouse.insert_by_position(item_statistics(_scores(spark, sf_dir), FULL_MARK), table)
    finally:
        spark.catalog.setCurrentDatabase(current)
    return _as_double(spark.table(table).filter(F.col("paper_code") == "1"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "header_extract": q_header_extract,
    "header_extract_jvm": q_header_extract_jvm,
    "fact_extract": q_fact_extract,
    "fact_rejects": q_fact_rejects,
    "fact_extract_jvm": q_fact_extract_jvm,
    "fact_rejects_jvm": q_fact_rejects_jvm,
    "range_scan": q_range_scan,
    "inpatient_fact": q_inpatient_fact,
    "column_scan": q_column_scan,
    "cell_upsert_latest": q_cell_upsert_latest,
    "delimited_parse": q_delimited_parse,
    "first_document": q_first_document,
    "row_count": q_row_count,
    "row_sample": q_row_sample,
    "star_join": q_star_join,
    "star_join_hot": q_star_join_hot,
    "cube_build": q_cube_build,
    "cube_refresh": q_cube_refresh,
    "cube_merge": q_cube_merge,
    "cube_refresh_empty": q_cube_refresh_empty,
    "cube_purge": q_cube_purge,
    "cube_describe": q_cube_describe,
    "cube_patients": q_cube_patients,
    "cube_wipe": q_cube_wipe,
    "fact_preview": q_fact_preview,
    "text_bytes": q_text_bytes,
    "cube_malformed_months": q_cube_malformed_months,
    "upsert_compacted": q_upsert_compacted,
    "open_cells": q_open_cells,
    "directory_ingest": q_directory_ingest,
    "fact_store": q_fact_store,
    "delimited_rejects": q_delimited_rejects,
    "column_stats": q_column_stats,
    "item_rejects": q_item_rejects,
    "cube_query": q_cube_query,
    "cube_listing": q_cube_listing,
    "dimension_load": q_dimension_load,
    "table_listing": q_table_listing,
    "table_stats": q_table_stats,
    "item_stats": q_item_stats,
    "partitioned_table": q_partitioned_table,
}

# -------------------------------------------------------------- oracle ----
# The per-order document values, computed directly.
_DOC_VALUES = """
WITH lines AS (
  SELECT l_orderkey,
         min({'n': l_linenumber, 's': l_suppkey, 'p': l_partkey}) AS f,
         max({'n': l_linenumber, 's': l_suppkey, 'p': l_partkey}) AS la
  FROM lineitem GROUP BY l_orderkey),
v AS (
  SELECT o.*, c.c_nationkey, n.n_name, r.r_name,
         lines.f.s AS first_supp, lines.f.p AS first_part,
         lines.la.s AS last_supp, lines.la.p AS last_part,
         CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 30 AS VARCHAR) AS doc_type
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN lines ON o.o_orderkey = lines.l_orderkey),
d AS (
  SELECT v.*, printf('RN%s_%03d', doc_type, o_orderkey) AS row_key,
         printf('emr/%s/RN%s_%03d.xml', doc_type, doc_type, o_orderkey) AS path
  FROM v)
"""

_FACT_SELECT = """
  CAST(o_custkey AS VARCHAR) AS idCard,
  CASE WHEN o_custkey % 2 = 1 THEN '1' ELSE '2' END AS genderId,
  CAST((o_custkey % 100) // 10 AS VARCHAR) AS ageId,
  n_name || ' ' || r_name AS addr,
  strftime(o_orderdate, '%Y%m') AS inTimeId,
  printf('KS%02d', c_nationkey) AS inClassId,
  CASE WHEN substr('ID' || CAST(o_custkey AS VARCHAR), 3, 1) = '2' THEN ''
       ELSE 'DR2' || CAST(first_supp AS VARCHAR) END AS mainDocId,
  'JB' || CAST(first_part AS VARCHAR) AS outSickId
"""

_HEADER_SQL = _DOC_VALUES + """
SELECT path, row_key,
       '2.999.' || doc_type || '.1' AS id,
       'C00' || doc_type AS typeCode,
       strftime(o_orderdate, '%Y%m%d%H%M%S') AS effectiveTime,
       'Inpatient record & ' || o_orderpriority AS title,
       'CN' AS realmCode,
       CASE WHEN o_orderstatus = 'F' THEN 'zh-CN' ELSE 'en-US' END AS languageCode
FROM d
"""

_RANGE = f"row_key >= '{INPATIENT_RANGE[0]}' AND row_key < '{INPATIENT_RANGE[1]}'"

_FACT = _DOC_VALUES + f""", fact AS (
  SELECT path, {_FACT_SELECT} FROM d WHERE first_supp IS NOT NULL)
"""

_CUBE = """
SELECT CAST(GROUPING(genderId, ageId, inClassId) AS BIGINT) AS gid, genderId, ageId,
       inClassId, count(*) AS n_visits, min(inTimeId) AS first_month,
       max(inTimeId) AS last_month
FROM fact WHERE {where}
GROUP BY {more} CUBE (genderId, ageId, inClassId)
"""

_SCORES = """
WITH s AS (
  SELECT substr(o_orderpriority, 1, 1) AS paper_code,
         strftime(o_orderdate, '%Y') AS create_time, o_orderkey AS student,
         l_linenumber AS item_id, CAST(ceil(l_quantity / 10) AS INTEGER) AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
t AS (SELECT paper_code, create_time, student, sum(score) AS total
      FROM s GROUP BY paper_code, create_time, student),
g AS (SELECT paper_code, create_time, student,
             percent_rank() OVER (PARTITION BY paper_code, create_time ORDER BY total) AS pr
      FROM t),
sg AS (SELECT paper_code, create_time, student,
              CASE WHEN pr <= 0.27 THEN 'low' WHEN pr >= 0.73 THEN 'high' END AS grp FROM g)
SELECT CAST(item_id AS INTEGER) AS item_id, CAST(max(score) AS INTEGER) AS max_score,
       CAST(min(score) AS INTEGER) AS min_score,
       CAST(TRY_CAST(floor(sum(score) / count(score) * 1000 + 0.5) / 1000
                     AS DECIMAL(4,3)) AS DOUBLE) AS avg_score,
       CAST(TRY_CAST(floor((count(score) * sum(score * score) - sum(score) * sum(score))
                           / (count(score) * count(score)) * 1000 + 0.5) / 1000
                     AS DECIMAL(4,3)) AS DOUBLE) AS fc_score,
       CAST(TRY_CAST(floor(sqrt((count(score) * sum(score * score) - sum(score) * sum(score))
                                / (count(score) * count(score))) * 1000 + 0.5) / 1000
                     AS DECIMAL(4,3)) AS DOUBLE) AS bzc_score,
       CAST(TRY_CAST(floor(sum(score) / count(score) / 5.0 * 1000 + 0.5) / 1000
                     AS DECIMAL(4,3)) AS DOUBLE) AS nandu,
       CAST(TRY_CAST(floor((avg(score) FILTER (WHERE grp = 'high')
                            - avg(score) FILTER (WHERE grp = 'low')) / 5.0 * 1000 + 0.5) / 1000
                     AS DECIMAL(4,3)) AS DOUBLE) AS qufendu,
       paper_code, create_time
FROM s LEFT JOIN sg USING (paper_code, create_time, student)
GROUP BY paper_code, create_time, item_id
"""

_TYPE_NAMES = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT[]' THEN 'array<float>'
  WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END"""

_TABLE_LIST = ", ".join(f"'{t}'" for t in TABLES)

ORACLE: dict[str, str] = {
    "header_extract": _HEADER_SQL,
    "header_extract_jvm": _HEADER_SQL,
    "fact_extract": _DOC_VALUES + f"SELECT path, {_FACT_SELECT} FROM d WHERE first_supp IS NOT NULL",
    "fact_rejects": _DOC_VALUES + """
        SELECT path, 'outSickId' AS field,
               'outSickId: no single match for component/structuredBody//component/'
               || 'section//entry/observation/code/qualifier/name/@displayName' AS reason
        FROM d WHERE first_supp IS NULL""",
    "range_scan": _DOC_VALUES + f"""
        SELECT row_key, 'C00' || doc_type AS basic_typeCode,
               'Inpatient record & ' || o_orderpriority AS specific_title
        FROM d WHERE {_RANGE}""",
    "inpatient_fact": _DOC_VALUES + f"""
        SELECT row_key, {_FACT_SELECT} FROM d
        WHERE {_RANGE} AND first_supp IS NOT NULL""",
    "column_scan": """
        SELECT printf('DOC%08d', doc_id) AS row_key, lang AS specific_title,
               text AS specific_content
        FROM documents WHERE lang = 'en'""",
    "cell_upsert_latest": """
        WITH k AS (
          SELECT *, CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 30 AS VARCHAR) AS t
          FROM orders)
        SELECT printf('RN%s_%03d', t, o_orderkey) AS row_key,
               CAST(o_orderkey AS VARCHAR) AS basic_id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'C0099' ELSE 'C00' || t END
                 AS basic_typeCode,
               CASE WHEN o_orderstatus = 'F'
                    THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d%H%M%S')
                    ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END AS basic_effectiveTime,
               CASE WHEN o_orderstatus = 'F' THEN 'Amended ' ELSE 'Order ' END
                 || o_orderpriority AS specific_title
        FROM k""",
    "delimited_parse": """
        SELECT 'row' || CAST(p_partkey AS VARCHAR) AS row_key, p_name AS cf1_name,
               CAST(p_size AS VARCHAR) AS cf1_age, p_brand AS cf2_gender,
               printf('%.2f', p_retailprice) AS cf2_salary
        FROM part WHERE p_size <= 45""",
    "first_document": """
        SELECT 'row4' AS row_key, text AS specific_content
        FROM documents ORDER BY printf('docs/%08d.txt', doc_id) LIMIT 1""",
    "row_count": "SELECT count(*) AS n_rows FROM documents",
    "star_join": _FACT + """
        , months AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS time_id FROM orders)
        SELECT f.*, g.gender_name, a.age_band, t.year, t.quarter, s.s_name AS doctor_name,
               n.n_name AS class_name, p.p_name AS sick_name, p.p_type AS sick_type
        FROM fact f
        LEFT JOIN (VALUES ('0', 'unknown'), ('1', 'male'), ('2', 'female'),
                          ('9', 'unspecified')) g(gender_id, gender_name)
               ON f.genderId = g.gender_id
        LEFT JOIN (SELECT CAST(i AS VARCHAR) AS age_id,
                          printf('%d-%d', i * 10, i * 10 + 9) AS age_band
                   FROM range(100) r(i)) a ON f.ageId = a.age_id
        LEFT JOIN (SELECT time_id, substr(time_id, 1, 4) AS year,
                          substr(time_id, 1, 4) || 'Q'
                          || CAST((CAST(substr(time_id, 5, 2) AS INTEGER) + 2) // 3 AS VARCHAR)
                          AS quarter FROM months) t ON f.inTimeId = t.time_id
        LEFT JOIN supplier s ON f.mainDocId = 'DR2' || CAST(s.s_suppkey AS VARCHAR)
        LEFT JOIN nation n ON f.inClassId = printf('KS%02d', n.n_nationkey)
        LEFT JOIN part p ON f.outSickId = 'JB' || CAST(p.p_partkey AS VARCHAR)""",
    "cube_build": _FACT + _CUBE.format(where="true", more=""),
    "cube_refresh": _FACT + _CUBE.format(where="true", more="substr(inTimeId, 1, 4),"),
    "cube_refresh_empty": _FACT + _CUBE.format(
        where="substr(inTimeId, 1, 4) > (SELECT min(substr(inTimeId, 1, 4)) FROM fact)",
        more="substr(inTimeId, 1, 4),"),
    "cube_merge": _FACT + _CUBE.format(where="true", more=""),
    "cube_purge": _FACT + _CUBE.format(where="true", more=""),
    "cube_describe": _FACT + """
        SELECT 'visits' AS cube, y || '01_' || (y + 1) || '01' AS segment, y || '01' AS start_month,
               (y + 1) || '01' AS end_month, 'visits' AS model,
               'genderId,ageId,inClassId' AS dimensions, 'inTimeId' AS time_column,
               'n_visits,first_month,last_month,patients_hll' AS measures
        FROM (SELECT unnest(range(min(CAST(substr(inTimeId, 1, 4) AS INTEGER)),
                                  max(CAST(substr(inTimeId, 1, 4) AS INTEGER)) + 1)) AS y
              FROM fact)""",
    "upsert_compacted": """
        WITH w AS (
          SELECT o_orderkey AS k, 2 AS v, 'first ' || o_orderpriority AS title, '1' AS t FROM orders
          UNION ALL SELECT o_orderkey, 3, 'second', NULL FROM orders WHERE o_orderstatus = 'F'
          UNION ALL SELECT o_orderkey, 4, 'third', NULL FROM orders WHERE o_orderkey % 2 = 0
          UNION ALL SELECT o_orderkey, 1, 'older', '0' FROM orders)
        SELECT printf('RN%03d', k) AS row_key, arg_max(title, v) AS specific_title,
               arg_max(t, v) FILTER (WHERE t IS NOT NULL) AS basic_effectiveTime
        FROM w GROUP BY k""",
    "open_cells": """
        SELECT printf('P%05d', p_partkey) AS row_key, 'basic' AS family, q AS qualifier, value
        FROM (SELECT p_partkey, 'id' AS q, p_name AS value FROM part
              UNION ALL SELECT p_partkey, p_brand, CAST(p_size AS VARCHAR) FROM part
              UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part)""",
    "directory_ingest": """
        SELECT 'S' || s_suppkey AS row_key,
               CASE WHEN s_suppkey % 10 = 0 THEN 'rejected' ELSE 'good' END AS outcome,
               CASE WHEN s_suppkey % 10 <> 0 THEN s_name END AS title
        FROM supplier""",
    "fact_store": _DOC_VALUES + f"""
        SELECT {_FACT_SELECT}, 't_fact_patient' AS tableName FROM d
        WHERE {_RANGE} AND first_supp IS NOT NULL""",
    "row_sample": _DOC_VALUES + """
        SELECT row_key, 'C00' || doc_type AS basic_typeCode FROM d
        WHERE CAST('0x' || substr(md5(row_key || ':7'), 1, 8) AS BIGINT) / 4294967296.0 < 0.5""",
    "delimited_rejects": """
        SELECT 'row' || p_partkey || ',' || p_size || ',' || p_name || ',' || p_brand || ',' AS line,
               'record: 4 of 5 fields' AS err
        FROM part WHERE p_size > 45""",
    "column_stats": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, column_name, "
        f"CAST(round(count * null_percentage / 100) AS BIGINT) AS n_nulls "
        f"FROM (SUMMARIZE {t}) WHERE column_type NOT LIKE '%[]'" for t in TABLES),
    "item_rejects": """
        WITH s AS (SELECT l_returnflag AS paper_code, l_linenumber AS item_id,
                          CAST(l_quantity AS INTEGER) AS x FROM lineitem),
        a AS (SELECT paper_code, item_id, avg(x) AS m,
                     (count(x) * sum(x * x) - sum(x) * sum(x)) / (count(x) * count(x)) AS v
              FROM s GROUP BY ALL),
        r AS (SELECT paper_code, item_id, 'avg_score' AS field, m AS value FROM a
              UNION ALL SELECT paper_code, item_id, 'fc_score', v FROM a
              UNION ALL SELECT paper_code, item_id, 'bzc_score', sqrt(v) FROM a)
        SELECT paper_code, 'all' AS create_time, CAST(item_id AS INTEGER) AS item_id, field,
               floor(value * 1000 + 0.5) / 1000 AS value
        FROM r WHERE floor(value * 1000 + 0.5) / 1000 > 9.999""",
    "cube_query": _FACT + """
        SELECT genderId, ageId, count(*) AS n_visits, min(inTimeId) AS first_month,
               max(inTimeId) AS last_month
        FROM fact WHERE inClassId IN ('KS01', 'KS02', 'KS03')
        GROUP BY genderId, ageId""",
    "text_bytes": """
        SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, md5(text) AS digest,
               true AS same FROM documents""",
    "fact_preview": _DOC_VALUES + f""", f AS (
          SELECT row_key, {_FACT_SELECT} FROM d WHERE {_RANGE} AND first_supp IS NOT NULL)
        SELECT 0 AS line_no, 'row_key | idCard | genderId | ageId | addr | inTimeId | inClassId'
               || ' | mainDocId | outSickId' AS line
        UNION ALL
        SELECT * FROM (
          SELECT row_number() OVER (ORDER BY row_key) AS line_no,
                 row_key || ' | ' || idCard || ' | ' || genderId || ' | ' || ageId || ' | ' || addr
                 || ' | ' || inTimeId || ' | ' || inClassId || ' | ' || mainDocId || ' | ' || outSickId
          FROM f) WHERE line_no <= 20""",
    "cube_wipe": _FACT + """
        SELECT 'visits' AS cube, CAST(grouping(genderId, ageId, inClassId) AS BIGINT) AS gid, genderId, ageId,
               inClassId, count(*) AS n_visits
        FROM fact GROUP BY CUBE (genderId, ageId, inClassId)
        UNION ALL
        SELECT 'other', grouping(genderId, ageId, inClassId), genderId, ageId, inClassId, count(*)
        FROM fact WHERE genderId = '1' GROUP BY CUBE (genderId, ageId, inClassId)""",
    "cube_patients": _FACT + """
        SELECT CASE grouping(genderId, ageId, inClassId) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 6 THEN 2
               ELSE 3 END AS grouping, genderId, ageId, inClassId,
               count(DISTINCT idCard) AS n_patients
        FROM fact GROUP BY GROUPING SETS ((genderId, ageId, inClassId), (genderId, ageId),
                                          (inClassId), ())""",
    "cube_malformed_months": _FACT + """
        SELECT inClassId, min(inTimeId) AS first_month, max(inTimeId) AS last_month, '' AS reason,
               count(*) AS n_visits
        FROM fact WHERE inClassId <> 'KS03' GROUP BY inClassId
        UNION ALL
        SELECT 'KS03', t, t, 'inTimeId: no month: ' || t, count(*)
        FROM (SELECT substr(inTimeId, 1, 5) || 'x' AS t FROM fact WHERE inClassId = 'KS03')
        GROUP BY t""",
    "cube_listing": _FACT + """
        , c AS (SELECT count(*) AS n FROM (SELECT 1 FROM fact
                  GROUP BY CUBE (genderId, inClassId))),
        a AS (SELECT count(*) AS n FROM (SELECT 1 FROM fact
                  GROUP BY CUBE (ageId)))
        SELECT 'visits_by_age' AS name, 'emr' AS project, 'visits_by_age' AS model,
               'READY' AS status, 1 AS n_segments, 'ageId' AS dimensions, a.n AS n_rows
        FROM a
        UNION ALL
        SELECT 'visits_by_class', 'emr', 'visits_by_class', 'READY', 1,
               'genderId,inClassId', c.n FROM c""",
    "dimension_load": """
        SELECT 'age' AS dimension, CAST(i AS VARCHAR) AS dim_key,
               printf('%d-%d', i * 10, i * 10 + 9) AS label FROM range(100) r(i)
        UNION ALL
        SELECT 'gender', k, l FROM (VALUES ('0', 'unknown'), ('1', 'male'), ('2', 'female'),
                                           ('9', 'unspecified')) g(k, l)
        UNION ALL
        SELECT DISTINCT 'time', strftime(o_orderdate, '%Y%m'), strftime(o_orderdate, '%Y')
        FROM orders
        UNION ALL
        SELECT 'doctor', 'DR2' || CAST(s_suppkey AS VARCHAR), s_name FROM supplier
        UNION ALL
        SELECT 'class', printf('KS%02d', n_nationkey), n_name FROM nation
        UNION ALL
        SELECT 'sick', 'JB' || CAST(p_partkey AS VARCHAR), p_name FROM part""",
    "table_listing": f"""
        SELECT table_name, column_name, {_TYPE_NAMES} AS data_type,
               CAST(ordinal_position - 1 AS INTEGER) AS ordinal
        FROM information_schema.columns WHERE table_name IN ({_TABLE_LIST})""",
    "table_stats": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for t in TABLES),
    "item_stats": _SCORES,
    "partitioned_table": "SELECT * FROM (" + _SCORES + ") WHERE paper_code = '1'",
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: documents -> wide table -> inpatient range -> patient fact."""
    return q_inpatient_fact(spark, SMOKE_DIR)


ORACLE["star_join_hot"] = ORACLE["star_join"].replace(_FACT, _DOC_VALUES + f""", fact AS (
  SELECT * REPLACE (CASE WHEN CAST(idCard AS BIGINT) % 3 = 0 THEN 'DR21' ELSE mainDocId END
                    AS mainDocId)
  FROM (SELECT path, {_FACT_SELECT} FROM d WHERE first_supp IS NOT NULL))
""")
ORACLE["fact_extract_jvm"] = ORACLE["fact_extract"]
ORACLE["fact_rejects_jvm"] = ORACLE["fact_rejects"]


# The training-data operators are a subpackage of their own: without it, or
# without the pipeline module, the other queries work all the same.
try:
    import corpus_pipeline
    from medstar.llm import queries as llm_queries
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "medstar.llm", "medstar.llm.queries"):
        raise
else:
    QUERIES.update(llm_queries.QUERIES, pipeline=corpus_pipeline.run)
    ORACLE.update(llm_queries.ORACLE)
    if corpus_pipeline.ORACLE_SQL:
        ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
