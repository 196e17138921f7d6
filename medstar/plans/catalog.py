"""Catalog operations of a project (Q8–Q11, L2): load tables, list them with
their columns, describe them, refresh cached metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cube import CubeStore
from ..session import shared_dir


def load_tables(spark: SparkSession, names: str, project: str, source_dir: str,
                analyze: bool = True) -> list[str]:
    """Q10: ``"a,b"`` -> external tables ``project.a``, ``project.b`` over the
    source files (nothing is copied), with statistics when ``analyze``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {project} "
              f"LOCATION '{shared_dir(spark)}/warehouse/{project}.db'")
    loaded = []
    for name in [n.strip() for n in names.split(",") if n.strip()]:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {project}.{name} USING parquet "
                  f"LOCATION '{source_dir.rstrip('/')}/{name}.parquet'")
        if analyze:
            # size, rows and statistics of every column (atomic types have them)
            spark.sql(f"ANALYZE TABLE {project}.{name} COMPUTE STATISTICS")
            columns = [f.name for f in spark.table(f"{project}.{name}").schema
                       if f.dataType.typeName() not in ("array", "map", "struct", "variant")]
            if columns:
                names = ", ".join(f"`{c}`" for c in columns)
                spark.sql(f"ANALYZE TABLE {project}.{name} COMPUTE STATISTICS FOR COLUMNS {names}")
        loaded.append(name)
    return loaded


def queryable_columns(spark: SparkSession, project: str) -> DataFrame:
    """Q8: ``(table_name, column_name, data_type, ordinal)`` of a project."""
    rows = []
    for t in spark.catalog.listTables(project):
        for i, c in enumerate(spark.catalog.listColumns(f"{project}.{t.name}")):
            rows.append((t.name, c.name, c.dataType, i))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, ordinal int")


def table_info(spark: SparkSession, table: str, extended: bool = True) -> DataFrame:
    """Q9: ``DESCRIBE TABLE [EXTENDED]`` as rows."""
    return spark.sql(f"DESCRIBE TABLE {'EXTENDED ' if extended else ''}{table}")


def table_stats(spark: SparkSession, project: str) -> DataFrame:
    """Q9 with ``ext``: row count and size of every analysed table."""
    out = None
    for t in spark.catalog.listTables(project):
        d = table_info(spark, f"{project}.{t.name}").filter(F.col("col_name") == "Statistics")
        d = d.select(F.lit(t.name).alias("table_name"),
                     F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint")
                     .alias("n_rows"),
                     F.regexp_extract("data_type", r"(\d+) bytes", 1).cast("bigint")
                     .alias("size_bytes"))
        out = d if out is None else out.unionByName(d)
    return out


def column_stats(spark: SparkSession, project: str) -> DataFrame:
    """Q10: nulls of every analysed column, ``(table_name, column_name,
    n_nulls)``, from the catalog (no data read)."""
    rows = []
    for t in spark.catalog.listTables(project):
        for f in spark.table(f"{project}.{t.name}").schema:
            info = {r[0]: r[1] for r in
                    spark.sql(f"DESCRIBE EXTENDED {project}.{t.name} `{f.name}`").collect()}
            if info.get("num_nulls") not in (None, "NULL"):
                rows.append((t.name, f.name, int(info["num_nulls"])))
    return spark.createDataFrame(rows, "table_name string, column_name string, n_nulls bigint")


def wipe_cache(spark: SparkSession, kind: str, name: str, action: str = "update",
               store: CubeStore | None = None, prefix: str = "cube_") -> None:
    """Q11: ``kind`` METADATA (a table) or CUBE; ``action`` create, update
    or drop.  Drops cached data and stale file listings of that table, or of
    that cube's view (``register_views`` made it under ``prefix``) and what
    ``store`` remembers of its metadata; nothing else is touched."""
    if kind not in ("METADATA", "CUBE") or action not in ("create", "update", "drop"):
        raise ValueError("kind METADATA|CUBE, action create|update|drop")
    if kind == "METADATA":
        if spark.catalog.tableExists(name):
            if spark.catalog.isCached(name):
                spark.catalog.uncacheTable(name)
            if action != "drop":
                spark.catalog.refreshTable(name)
        return
    view = f"{prefix}{name}"
    if spark.catalog.tableExists(view):
        if spark.catalog.isCached(view):
            spark.catalog.uncacheTable(view)
        if action == "drop":
            spark.catalog.dropTempView(view)
    if store is not None:
        store.forget()
        if action != "drop":
            store.register_views(prefix, only=name)
