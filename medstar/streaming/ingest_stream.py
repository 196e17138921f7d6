"""Incremental ingest of a document folder (E1 on Structured Streaming).

New files in the folder are read whole; every micro-batch becomes one batch
of the wide document table and one of its rejects table.  The stream writes
under a name of its own, derived from its checkpoint, so several streams (and
callers) share a table without meeting.  A batch replayed after a failure
rewrites the same batch, and is left alone if a compaction has folded it
meanwhile: with the checkpoint the table receives every file exactly once.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import ingest_documents
from ..session import shared_dir
from ..sources.documents import strip_bom


def document_stream(spark: SparkSession, directory: str, glob: str | None = None,
                    max_files_per_trigger: int | None = None, recursive: bool = True):
    """Every file under ``directory`` (``glob``: only files of such names), as
    ``read_documents`` reads them."""
    reader = (spark.readStream.format("text").option("wholetext", "true")
              .option("recursiveFileLookup", str(recursive).lower()))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(directory).select(F.col("_metadata.file_path").alias("path"),
                                         strip_bom("value").alias("content"))


def start_ingest(spark: SparkSession, directory: str, table: str,
                 checkpoint: str | None = None, version_base: int = 1_000_000,
                 engine: str = "exact", available_now: bool = True,
                 processing_time: str | None = None, glob: str | None = None,
                 max_files_per_trigger: int | None = None, rejects_table: str | None = None,
                 on_error: str = "reject") -> StreamingQuery:
    """``version_base + batch_id`` orders the stream's batches against the
    versions of other writers; documents that can't be read go to
    ``rejects_table`` (``<table>_rejects`` unless named)."""
    checkpoint = checkpoint or f"{shared_dir(spark)}/streams/{table}"
    writer = f"stream-{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}"

    def write_batch(batch_df, batch_id: int) -> None:
        ingest_documents(batch_df.sparkSession, batch_df, table, version=version_base + batch_id,
                         rejects_table=rejects_table, engine=engine, on_error=on_error,
                         writer=writer, folded="skip")

    w = (document_stream(spark, directory, glob, max_files_per_trigger).writeStream
         .foreachBatch(write_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=processing_time or "1 minute")
    return w.start()
