"""Warehouse DDL and appends.

Tables are plain Spark data-source tables; no Hive is required.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

# ---- fixed values: the item-index table of the original DDL --------------
ITEM_INDEX_COLUMNS = (
    "item_id int, max_score int, min_score int, avg_score decimal(4,3), "
    "fc_score decimal(4,3), bzc_score decimal(4,3), nandu decimal(4,3), "
    "qufendu decimal(4,3), paper_code string, create_time string")
ITEM_INDEX_PARTITIONS = ("paper_code", "create_time")
FACT_TABLE_COLUMNS = (
    "idCard string, genderId string, ageId string, addr string, inTimeId string, "
    "inClassId string, mainDocId string, outSickId string")
# ---------------------------------------------------------------------------


def create_database(spark: SparkSession, name: str, drop_first: bool = False) -> None:
    """(drop), create if absent, use.  A plain DROP of a missing or
    non-empty database raises; ``drop_first`` drops only when it exists and
    then with its tables."""
    if drop_first:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} "
              f"LOCATION '{shared_dir(spark)}/warehouse/{name}.db'")
    spark.sql(f"USE {name}")


def create_item_index(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Eight columns, two partition keys, comma-delimited text files."""
    location = location or f"{shared_dir(spark)}/warehouse/{table.replace('.', '/')}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ITEM_INDEX_COLUMNS}) USING csv "
        f"OPTIONS (sep ',') PARTITIONED BY ({', '.join(ITEM_INDEX_PARTITIONS)}) "
        f"LOCATION '{location}'")


def create_fact_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """The eight-string patient fact, as parquet."""
    location = location or f"{shared_dir(spark)}/warehouse/{table.replace('.', '/')}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({FACT_TABLE_COLUMNS}) USING parquet "
              f"LOCATION '{location}'")


def insert_by_position(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """K9: append (or overwrite) matched **by position**, as insertInto does."""
    df.write.insertInto(table, overwrite=overwrite)


def append_by_name(df: DataFrame, table: str) -> None:
    """K9, safer form: columns matched by name."""
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table)


def show_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """K13."""
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def preview(df: DataFrame, n: int = 20) -> str:
    """The first ``n`` rows as text, on the driver; nothing is printed
    inside executors (the original printed from every task)."""
    rows = df.take(n)
    lines = [" | ".join(df.columns)]
    lines += [" | ".join("null" if v is None else str(v) for v in r) for r in rows]
    return "\n".join(lines)
