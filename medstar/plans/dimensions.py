"""The six dimensions of the patient star (age, gender, time, doctor,
department class, disease) and their loads (S6, E3).

The original dimension tables live in an operational database and their
columns are not given; ours have the key the fact refers to plus labels.
``derived_dimensions`` builds them from the driver tables; ``jdbc_dimension``
reads one over JDBC with a partitioned scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import compact_time
from ..operators.star import Dimension
from ..sources.tables import read_table

# ---- fixed values: administrative gender codes (GB/T 2261.1) -------------
GENDER_CODES = [("0", "unknown"), ("1", "male"), ("2", "female"), ("9", "unspecified")]
# ---------------------------------------------------------------------------
AGE_BANDS = 100     # age band ids 0..99 cover ages 0..999


def gender_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GENDER_CODES, "gender_id string, gender_name string")


def age_dim(spark: SparkSession) -> DataFrame:
    band = F.col("id")
    return spark.range(AGE_BANDS).select(
        band.cast("string").alias("age_id"),
        F.format_string("%d-%d", band * 10, band * 10 + 9).alias("age_band"))


def time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that occur in the orders (a distinct that combines map-side)."""
    m = read_table(spark, sf_dir, "orders").select(
        compact_time("o_orderdate", 6).alias("time_id")).distinct()
    return m.select("time_id",
                    F.substring("time_id", 1, 4).alias("year"),
                    F.concat(F.substring("time_id", 1, 4), F.lit("Q"),
                             ((F.substring("time_id", 5, 2).cast("int") + 2) / 3)
                             .cast("int").cast("string")).alias("quarter"))


def doctor_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.concat(F.lit("DR2"), F.col("s_suppkey").cast("string")).alias("doctor_id"),
                    F.col("s_name").alias("doctor_name"))


def class_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(F.format_string("KS%02d", "n_nationkey").alias("class_id"),
                    F.col("n_name").alias("class_name"))


def sick_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.concat(F.lit("JB"), F.col("p_partkey").cast("string")).alias("sick_id"),
                    F.col("p_name").alias("sick_name"), F.col("p_type").alias("sick_type"))


def derived_dimensions(spark: SparkSession, sf_dir: str) -> list[Dimension]:
    return [
        Dimension(gender_dim(spark), "gender_id", "genderId", fixed=True),
        Dimension(age_dim(spark), "age_id", "ageId", fixed=True),
        # one row per calendar month: bounded by the time span, not the data
        Dimension(time_dim(spark, sf_dir), "time_id", "inTimeId", fixed=True),
        Dimension(doctor_dim(spark, sf_dir), "doctor_id", "mainDocId"),
        Dimension(class_dim(spark, sf_dir), "class_id", "inClassId"),
        Dimension(sick_dim(spark, sf_dir), "sick_id", "outSickId"),
    ]


# ------------------------------------------------------------------ JDBC ----

def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000) -> dict:
    """Reader options for one table.  The login comes from the caller (or the
    environment of the job), never from code."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned scan needs lower_bound, upper_bound, num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def jdbc_dimension(spark: SparkSession, **options) -> DataFrame:
    """One dimension table over JDBC; filters and columns push down."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def append_jdbc(df: DataFrame, url: str, table: str, column_types: str | None = None,
                batch_size: int = 10_000, **login) -> None:
    """K8: append rows to a database table (a rerun appends again)."""
    w = (df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in login.items():
        w = w.option(k, v)
    w.save()


def dimension_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six dimensions by their original table suffix."""
    return {"age": age_dim(spark), "gender": gender_dim(spark),
            "time": time_dim(spark, sf_dir), "doctor": doctor_dim(spark, sf_dir),
            "class": class_dim(spark, sf_dir), "sick": sick_dim(spark, sf_dir)}


def load_dimensions(spark: SparkSession, frames: dict[str, DataFrame], database: str,
                    root: str) -> list[str]:
    """Every dimension into ``database.t_dimension_<name>``, created when
    absent and appended **by position** (K9, K10, U1).  Returns the tables."""
    from .warehouse import insert_by_position
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} "
              f"LOCATION '{root.rstrip('/')}/{database}.db'")
    tables = []
    for name, df in frames.items():
        table = f"{database}.t_dimension_{name}"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
                  f"LOCATION '{root.rstrip('/')}/t_dimension_{name}'")
        insert_by_position(df, table)
        tables.append(table)
    return tables
