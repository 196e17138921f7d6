"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medstar.session import scratch_path

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes ``df`` to a fresh folder of the shared storage and
    reads it back, so a lost executor costs no recomputation from the start.
    The folder goes when the driver exits."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """128-bit key of a whole text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: 0)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's decimal text leaves 1 modulo 3 (null: '')."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def packed(docs: DataFrame, **own: Column) -> DataFrame:
    """The row of ``docs`` as one struct ``__row`` next to columns of our own,
    so that no column name of the input can clash with ours."""
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__row")
    return docs.select(row, *[c.alias(n) for n, c in own.items()])


def unpacked(df: DataFrame, columns: list[str]) -> list[Column]:
    return [df["__row"].getField(c).alias(c) for c in columns]
