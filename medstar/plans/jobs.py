"""The end-to-end jobs: ingest (E1) and patient fact.

Each is one Catalyst plan per write; no RDD step.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hl7 import FACT_COLUMNS, INPATIENT_RANGE
from ..operators.extract import extract_header, good, parse_fact, rejects
from ..operators.wide_table import DOCUMENT_FAMILIES, WRITER, WideTable
from ..session import shared_dir
from ..sources import fs

HEADER_CELLS = {
    "basic:id": "id", "basic:typeCode": "typeCode",
    "basic:effectiveTime": "effectiveTime", "basic:realmCode": "realmCode",
    "specific:title": "title", "specific:languageCode": "languageCode",
    "specific:content": "content",
}


def ingest_documents(spark: SparkSession, docs: DataFrame, table: str, version: int,
                     rejects_table: str | None = None, engine: str = "exact",
                     on_error: str = "reject", writer: str = WRITER,
                     folded: str = "refuse", location: str | None = None) -> WideTable:
    """Documents ``(path, content)`` -> header cells + whole content as
    batch ``version`` of ``writer`` in the wide document table.

    A document that can't be read never vanishes: it is written to
    ``rejects_table`` (``<table>_rejects`` unless named), or with
    ``on_error="fail"`` fails the job.  Documents are parsed and written once,
    in files apart by outcome: those of the good ones become the batch as they
    are, the few columns of the others go to the rejects.
    """
    wt = WideTable.create(spark, table, DOCUMENT_FAMILIES, location)
    parsed = extract_header(docs, keep=("path", "content"), engine=engine, on_error=on_error)
    if on_error == "fail":
        wt.put(wt.cells(good(parsed), "row_key", HEADER_CELLS, source="path"), version, writer,
               folded)
        return wt
    if not wt.writable(version, writer, folded):
        return wt
    is_good = F.col("err").isNull()
    cells = wt.cells(parsed.withColumn("content", F.when(is_good, F.col("content"))), "row_key",
                     HEADER_CELLS, source="path", keep=("path", "err"))
    staged = f"{wt.location()}/_ingest/{writer}.{int(version)}-{uuid.uuid4().hex}"
    with _unsorted_writes(spark, 2):
        (cells.select("*", F.lit(int(version)).cast("bigint").alias("_version"),
                      F.when(is_good, "good").otherwise("bad").alias("outcome"))
         .write.partitionBy("outcome").parquet(staged))
    for outcome in ("good", "bad"):                       # a folder without rows isn't there
        fs.make_folder(spark, f"{staged}/outcome={outcome}")
    bad = spark.read.schema("path string, err string").parquet(f"{staged}/outcome=bad")
    _write_rejects(spark, rejects(bad, key="path"), rejects_table or f"{table}_rejects", version,
                   writer, location and f"{location}-rejects")
    fs.delete(spark, f"{staged}/outcome=bad")
    wt.adopt(f"{staged}/outcome=good", version, writer)
    return wt


@contextmanager
def _unsorted_writes(spark: SparkSession, folders: int):
    """A task that writes to so many folders keeps their files open, instead of
    sorting its rows (whole documents) by folder first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(folders))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _write_rejects(spark: SparkSession, bad: DataFrame, table: str, version: int,
                   writer: str, location: str | None = None) -> None:
    """Rejects of one batch, partitioned like the batch: a rerun replaces
    them instead of adding them again."""
    location = location or f"{shared_dir(spark)}/tables/{table.replace('.', '/')}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (path string, field string, reason string) "
              f"USING parquet PARTITIONED BY (_batch string) LOCATION '{location}'")
    view = f"_medstar_rejects_{uuid.uuid4().hex[:12]}"
    bad.select("path", "field", "reason").createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (_batch = '{writer}.{int(version)}') "
                  f"SELECT path, field, reason FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def inpatient_content(wt: WideTable, key_range=INPATIENT_RANGE) -> DataFrame:
    """E2 scan: content cells of the inpatient row-key range (S3 + S4)."""
    return wt.scan(["specific:content"], key_range=key_range)


def fact_job(wt: WideTable, key_range=INPATIENT_RANGE, on_error: str = "reject",
             with_key: bool = True) -> DataFrame:
    """Range scan -> one parse per document -> patient fact.

    A null content cell is a reject ("content: null"), not a crash.
    """
    content = inpatient_content(wt, key_range)
    parsed = parse_fact(content, content="specific_content", keep=("row_key",),
                        on_error=on_error)
    fact = good(parsed)
    return fact if with_key else fact.select(*FACT_COLUMNS)


def fact_rejects(wt: WideTable, key_range=INPATIENT_RANGE) -> DataFrame:
    content = inpatient_content(wt, key_range)
    return rejects(parse_fact(content, content="specific_content", keep=("row_key",)))


def store_fact(spark: SparkSession, fact: DataFrame, table: str,
               location: str | None = None) -> None:
    """E2 sink: append the fact to the warehouse fact table (K12 + K9, by
    name).  A rerun appends again, as the original JDBC append did; use a
    batch column and overwrite it when that is not wanted."""
    from .warehouse import append_by_name, create_fact_table
    create_fact_table(spark, table, location)
    append_by_name(fact.select(*FACT_COLUMNS), table)


def upload_first_document(spark: SparkSession, docs: DataFrame, table: str, version: int,
                          row_key: str = "row4", location: str | None = None) -> WideTable:
    """K3: the first document (by path) as the ``specific:content`` cell of
    one fixed row.  The original took whichever document came first; here
    the order is the path, so the result is the same on every run."""
    from ..sources.documents import first_document
    wt = WideTable.create(spark, table, DOCUMENT_FAMILIES, location)
    first = first_document(docs)
    wt.put(wt.cells(first, F.lit(row_key), {"specific:content": "content"}, source="path"),
           version)
    return wt
