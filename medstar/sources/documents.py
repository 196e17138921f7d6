"""Whole-document sources (S1), the literal source (S7) and first record (L1).

A document is one row ``(path string, content string)``.  The directory
scan reads each file whole (``wholetext``), so a file is never split; the
path comes from the hidden ``_metadata`` column.  A leading byte-order mark
is removed here, once, so no later step has to care.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("content", T.StringType()),
])

_BOM = "﻿"


def strip_bom(content) -> F.Column:
    c = F.col(content) if isinstance(content, str) else content
    return F.when(c.startswith(_BOM), F.substring(c, 2, 1 << 30)).otherwise(c)


def read_documents(spark: SparkSession, directory: str,
                   glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Every file under ``directory`` becomes one ``(path, content)`` row;
    ``glob``: only files of such names."""
    reader = (spark.read.format("text").option("wholetext", "true")
              .option("recursiveFileLookup", str(recursive).lower()))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(directory)
    return df.select(F.col("_metadata.file_path").alias("path"),
                     strip_bom("value").alias("content"))


def write_documents(docs: DataFrame, folder: str, name: str = "name") -> None:
    """``(value, name)`` rows as text files, each name in a folder
    ``name=...`` of its own; rows of one name share a file.

    A file costs much more than its bytes, so the names are dealt over all tasks,
    and each task moves its own files into place (the folder is new, a failed
    write leaves it to nobody).
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (docs.repartition(parts, name).write.partitionBy(name)
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder))


def literal_documents(spark: SparkSession, rows: Iterable[tuple[str, str]]) -> DataFrame:
    """In-memory rows as documents (S7); for small fixed inputs only."""
    return spark.createDataFrame(list(rows), DOCUMENT_SCHEMA)


def literal_lines(spark: SparkSession, lines: Iterable[str]) -> DataFrame:
    """In-memory text lines (S7), column ``line``."""
    return spark.createDataFrame([(x,) for x in lines], "line string")


def first_document(docs: DataFrame, order_by: str = "path") -> DataFrame:
    """The first document by ``order_by`` (L1).

    Sort-plus-limit plans as a per-partition top-1 and a single merge of one
    row per partition, not a full sort.
    """
    return docs.orderBy(order_by).limit(1)
