"""A wide column-family table on plain Spark tables.

Layout: one row per written record, one struct column per family with its
declared qualifiers (nullable strings; null = "cell not written"), a map
``_open`` for cells with undeclared qualifiers of a declared family
(``family:qualifier`` -> value), ``_source``, the order number ``_version``, and
the partition ``_batch``.

Batches.  A batch is named by its writer and its number; every writer has
numbers of its own, so two streams, a caller and a compaction never meet in
one partition.  Rewriting a batch replaces its own partition only, so a rerun
of a failed or repeated batch is idempotent.  A batch that a compaction has
folded is closed: writing it again is refused (or skipped).

Writing appends map-side: no shuffle and no sort, whatever the content's size.

Latest view: for every cell the value of the largest ``(_version, _source,
value)``.  Keys with several rows are found from the key column alone and kept
as a bitmap over ``SLOTS`` hash values.  The bitmap goes to every task (32 MB at
most, whatever the table's size): a row whose slot isn't set is surely the only
one of its key and passes where it is read; the other rows, those of repeated
keys and the few that share a slot with one, are aggregated.  All of it is one
lazy plan, no job runs while it is built.  After a compaction, which lays the
rows out in key order, a key range reads only the files that hold it.
"""

from __future__ import annotations

import uuid
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import fs

# ---- fixed values: the document table of the original jobs --------------
DOCUMENT_FAMILIES = {
    "basic": ["id", "typeCode", "effectiveTime", "realmCode"],
    "specific": ["title", "languageCode", "content"],
}
# ---------------------------------------------------------------------------

WRITER = "put"               # writer of batches that callers number themselves
COMPACTED = "compacted"
_OWN = ("row_key", "_open", "_source", "_version", "_batch")
#: Hash values of the bitmap of repeated keys: 8,192 pieces of 4 KB.
SLOTS = 1 << 28


def table_exists(spark: SparkSession, name: str) -> bool:
    """K6."""
    return spark.catalog.tableExists(name)


def _cell_name(cell: str) -> tuple[str, str]:
    fam, _, qual = cell.partition(":")
    if not qual:
        raise ValueError(f"cell must be 'family:qualifier', got {cell!r}")
    return fam, qual


class WideTable:
    """A named wide table; see the module docstring for the layout."""

    def __init__(self, spark: SparkSession, name: str, families: Mapping[str, Sequence[str]]):
        self.spark = spark
        self.name = name
        self.families = {f: list(q) for f, q in families.items()}

    # ---------------------------------------------------------------- DDL --
    @classmethod
    def create(cls, spark: SparkSession, name: str,
               families: Mapping[str, Sequence[str]] = DOCUMENT_FAMILIES,
               location: str | None = None) -> "WideTable":
        """Ensure the table (K7): create it when absent, once, on the driver."""
        t = cls(spark, name, families)
        if not table_exists(spark, name):
            location = location or f"{shared_dir(spark)}/tables/{name}"
            fams = ", ".join(
                f"`{f}` struct<{', '.join(f'`{q}`: string' for q in quals)}>"
                for f, quals in t.families.items())
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} (row_key string, {fams}, "
                f"_open map<string, string>, _source string, _version bigint, _batch string) "
                f"USING parquet PARTITIONED BY (_batch) LOCATION '{location}'")
        return t

    @classmethod
    def open(cls, spark: SparkSession, name: str) -> "WideTable":
        """An existing table, its families read from the table schema."""
        fams = {f.name: [q.name for q in f.dataType.fields]
                for f in spark.table(name).schema.fields if f.name not in _OWN}
        return cls(spark, name, fams)

    # -------------------------------------------------------------- writes --
    def cells(self, df: DataFrame, key: Column | str,
              mapping: Mapping[str, Column | str], source: Column | str | None = None,
              keep: Sequence[str] = ()) -> DataFrame:
        """Map fields to cells (K5): ``{'family:qualifier': column}``.  A
        qualifier that the family doesn't declare becomes an open cell.
        Columns named in ``keep`` stay beside the cells."""
        def value(v) -> Column:
            return (F.col(v) if isinstance(v, str) else v).cast("string")

        k = F.col(key) if isinstance(key, str) else key
        cols, more = [k.cast("string").alias("row_key")], []
        for cell in mapping:
            fam, qual = _cell_name(cell)
            if fam not in self.families:
                raise ValueError(f"unknown family in {cell!r}")
            if qual not in self.families[fam]:
                more.append(cell)
        for fam, quals in self.families.items():
            cols.append(F.struct(*[
                value(mapping.get(f"{fam}:{q}", F.lit(None))).alias(q)
                for q in quals]).alias(fam))
        if more:
            every = F.map_from_entries(F.array(*[
                F.struct(F.lit(c).alias("key"), value(mapping[c]).alias("value")) for c in more]))
            cols.append(F.map_filter(every, lambda _, v: v.isNotNull()).alias("_open"))
        else:
            cols.append(F.lit(None).cast("map<string,string>").alias("_open"))
        cols.append(value(F.lit(None) if source is None else source).alias("_source"))
        return df.select(*cols, *keep)

    def _has_cell(self) -> Column:
        found = F.coalesce(F.size("_open") > 0, F.lit(False))
        for fam, quals in self.families.items():
            for q in quals:
                found = found | F.col(f"{fam}.{q}").isNotNull()
        return found

    def put(self, rows: DataFrame, version: int, writer: str = WRITER,
            folded: str = "refuse") -> bool:
        """Write one batch (K1, K2).  ``rows`` has the layout of ``cells``.

        Rewriting the same ``version`` of the same ``writer`` replaces that
        batch only.  If a compaction has folded the batch already, it is
        refused, or left as it is with ``folded="skip"``; returns whether it
        was written.  Rows without any cell are left out, so no key appears
        that nothing was written to.
        """
        batch = self._batch(version, writer)
        if not self.writable(version, writer, folded):
            return False
        cols = ["row_key", *self.families, "_open", "_source"]
        # a static partition spec replaces exactly this batch, whatever the
        # session's partitionOverwriteMode
        view = f"_medstar_put_{uuid.uuid4().hex[:12]}"
        rows.filter(self._has_cell()).select(*cols).createOrReplaceTempView(view)
        try:
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self.name} PARTITION (_batch = '{batch}') "
                f"SELECT {', '.join(f'`{c}`' for c in cols)}, CAST({int(version)} AS BIGINT) "
                f"FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
        return True

    def writable(self, version: int, writer: str = WRITER, folded: str = "refuse") -> bool:
        """Whether a batch can be written; if a compaction has folded it, that
        is refused, or False with ``folded="skip"``."""
        batch = self._batch(version, writer)
        if batch not in self.folded():
            return True
        if folded != "skip":
            raise ValueError(f"batch {batch} is part of a compaction and can't be rewritten")
        return False

    def adopt(self, path: str, version: int, writer: str = WRITER) -> None:
        """Files written elsewhere (rows of ``cells`` and ``_version``; other
        columns are not looked at) become the batch, in place of its files of
        before, without being copied."""
        batch = self._batch(version, writer)
        part = f"PARTITION (_batch = '{batch}')"
        if batch in self.batches():
            before = self._path_of(batch)
            self.spark.sql(f"ALTER TABLE {self.name} {part} SET LOCATION '{path}'")
            if before != path:
                fs.delete(self.spark, before)
        else:
            self.spark.sql(f"ALTER TABLE {self.name} ADD {part} LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.name)

    def _path_of(self, batch: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} PARTITION (_batch = '{batch}')")
        return rows.filter("col_name = 'Location'").collect()[0]["data_type"]

    def put_cells(self, cells: DataFrame, version: int, writer: str = WRITER,
                  folded: str = "refuse") -> bool:
        """Single-cell writes (K4): rows ``(row_key, family, qualifier, value)``.

        A qualifier that the family doesn't declare is kept as an open cell;
        a family that the table doesn't have fails the write.  Several writes
        to one cell in a batch leave the largest value.
        """
        fam, qual, value = F.col("family"), F.col("qualifier"), F.col("value").cast("string")
        cols, declared = [], F.lit(False)
        for f, quals in self.families.items():
            cols.append(F.struct(*[F.when((fam == f) & (qual == q), value).alias(q)
                                   for q in quals]).alias(f))
            declared = declared | ((fam == f) & qual.isin(*quals))
        unknown = F.raise_error(F.concat(F.lit("unknown family: "),
                                         F.coalesce(fam, F.lit("null"))))
        more = F.when(F.coalesce(~fam.isin(*self.families), F.lit(True)),
                      unknown.cast("map<string,string>")).when(
            ~declared & value.isNotNull(), F.create_map(F.concat(fam, F.lit(":"), qual), value))
        rows = cells.select(F.col("row_key").cast("string").alias("row_key"), *cols,
                            more.alias("_open"), F.lit(None).cast("string").alias("_source"))
        return self.put(rows, version, writer, folded)

    # ------------------------------------------------------------- batches --
    @staticmethod
    def _batch(version: int, writer: str) -> str:
        if not writer or not all(c.isalnum() or c in "-_" for c in writer):
            raise ValueError(f"writer {writer!r} must be letters, digits, '-' or '_'")
        if writer == COMPACTED:
            raise ValueError(f"{COMPACTED!r} is the compaction's own name")
        return f"{writer}.{int(version)}"

    def location(self) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}") \
            .filter("col_name = 'Location'").collect()
        return rows[0]["data_type"]

    def batches(self) -> list[str]:
        """Names of the batches present, ``writer.number`` (no data read)."""
        return sorted(r[0].split("=", 1)[1] for r in
                      self.spark.sql(f"SHOW PARTITIONS {self.name}").collect())

    def versions(self, writer: str = WRITER) -> list[int]:
        """Numbers of a writer's batches."""
        return sorted(int(b.split(".")[1]) for b in self.batches() if b.split(".")[0] == writer)

    def _folded_path(self) -> str:
        return f"{self.location()}/_folded"

    def folded(self) -> set[str]:
        """Batches that compactions have taken in."""
        return set(fs.list_names(self.spark, self._folded_path()))

    # --------------------------------------------------------------- reads --
    def log(self) -> DataFrame:
        return self.spark.table(self.name)

    def _wanted(self, cells: Iterable[str] | None) -> list[tuple[str, str, bool]]:
        """(family, qualifier, declared) of each asked cell."""
        out = []
        for cell in (cells or [f"{f}:{q}" for f, qs in self.families.items() for q in qs]):
            fam, qual = _cell_name(cell)
            if fam not in self.families:
                raise ValueError(f"unknown family in {cell!r}")
            out.append((fam, qual, qual in self.families[fam]))
        return out

    def _flat(self, cells: Iterable[str] | None, key_range) -> tuple[DataFrame, dict[str, str]]:
        """The log with one column per asked cell; ``{'family:qualifier': column}``."""
        names, cols = {}, [F.col("row_key"), F.col("_version"), F.col("_source")]
        for i, (fam, qual, declared) in enumerate(self._wanted(cells)):
            names[f"{fam}:{qual}"] = f"c{i}"
            cols.append((F.col(f"{fam}.{qual}") if declared else
                         F.element_at("_open", f"{fam}:{qual}")).alias(f"c{i}"))
        return self._in_range(key_range).select(*cols), names

    def _in_range(self, key_range) -> DataFrame:
        log = self.log()
        lo, hi = key_range or (None, None)
        if lo is not None:
            log = log.filter(F.col("row_key") >= F.lit(lo))
        if hi is not None:
            log = log.filter(F.col("row_key") < F.lit(hi))
        return log

    def _repeated(self, key_range) -> DataFrame:
        """(_bucket, _bits): pieces of the bitmap over the slots of the keys
        with more than one row.  Only the key column is read."""
        return (self._in_range(key_range).groupBy("row_key").count().filter("count > 1")
                .select(_slot().alias("slot"))
                .groupBy(F.bitmap_bucket_number("slot").alias("_bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits")))

    def _split(self, rows: DataFrame, key_range) -> tuple[DataFrame, DataFrame]:
        """``rows`` of keys that surely have one row, and the others."""
        bits = F.broadcast(self._repeated(key_range))         # 32 MB at most
        at = F.bitmap_bit_position(_slot())
        byte = F.conv(F.hex(F.substr("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10)
        is_set = F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1
        near = F.bitmap_bucket_number(_slot()) == F.col("_bucket")
        single = rows.join(bits, near, "left").filter(F.col("_bits").isNull() | ~is_set)
        return (single.select(*rows.columns),
                rows.join(bits, near).filter(is_set).select(*rows.columns))

    def latest(self, cells: Iterable[str] | None = None,
               key_range: tuple[str | None, str | None] | None = None) -> DataFrame:
        """Latest value of every selected cell (S2; S3 with ``cells``; S4 with
        ``key_range = (start, stop)``, start included, stop excluded, compared
        as bytes), for the keys that have one of them."""
        flat, names = self._flat(cells, key_range)
        cols = list(names.values())
        single, several = self._split(flat, key_range)
        newest = several.groupBy("row_key").agg(*[F.max(F.when(F.col(c).isNotNull(), F.struct(
            "_version", "_source", F.col(c).alias("v"))))["v"].alias(c) for c in cols])
        out = single.select("row_key", *cols).unionByName(newest)
        out = out.filter(F.coalesce(*cols).isNotNull())
        groups: dict[str, list[tuple[str, str]]] = {}
        for cell, c in names.items():
            fam, qual = _cell_name(cell)
            groups.setdefault(fam, []).append((qual, c))
        return out.select("row_key", *[
            F.struct(*[F.col(c).alias(q) for q, c in qs]).alias(f) for f, qs in groups.items()])

    def scan(self, cells: Iterable[str], key_range=None, require: Iterable[str] = ()) -> DataFrame:
        """Rows with the selected cells, flattened to ``family_qualifier``
        columns; keys holding none of them don't appear, ``require`` drops
        rows where those cells are absent (P3)."""
        cells = list(cells)
        view = self.latest(cells, key_range)
        cols, names = [F.col("row_key")], {}
        for cell in cells:
            fam, qual = _cell_name(cell)
            names[cell] = f"{fam}_{qual}"
            cols.append(F.col(fam)[qual].alias(names[cell]))
        need = ["row_key"] + ["{}_{}".format(*_cell_name(c)) for c in require]
        return view.select(*cols).na.drop(how="any", subset=need)

    def cell_rows(self) -> DataFrame:
        """Latest cells one by one, open ones too:
        ``(row_key, family, qualifier, value)``."""
        every = [F.struct(F.lit(f"{f}:{q}").alias("cell"), F.col(f"{f}.{q}").alias("value"))
                 for f, qs in self.families.items() for q in qs]
        more = F.transform(F.map_entries(F.coalesce("_open", F.create_map().cast(
            "map<string,string>"))), lambda e: F.struct(e["key"].alias("cell"), e["value"].alias("value")))
        rows = self.log().select("row_key", "_version", "_source",
                                 F.explode(F.concat(F.array(*every), more)).alias("c"))
        best = F.max(F.struct("_version", "_source", F.col("c.value").alias("v")))["v"]
        return (rows.filter("c.value is not null").groupBy("row_key", F.col("c.cell").alias("cell"))
                .agg(best.alias("value"))
                .select("row_key", F.split_part("cell", F.lit(":"), F.lit(1)).alias("family"),
                        F.expr("substring(cell, locate(':', cell) + 1)").alias("qualifier"), "value"))

    def sample(self, fraction: float, seed: int = 0, cells=None) -> DataFrame:
        """Rows drawn by a hash of their key, each with probability
        ``fraction`` (S5): the same keys on every run, engine and layout."""
        return self.latest(cells).filter(key_share(F.col("row_key"), seed) < fraction)

    # --------------------------------------------------------- maintenance --
    def compact(self) -> str | None:
        """Fold all batches present into one, and retire them.

        A cell that a later write replaces is left out; every other cell keeps
        its version and source, so later batches are ordered against it as
        before.  Keys with one row pass as they are; rows are laid out in key
        order.  Batches that arrive meanwhile are untouched, and an
        interrupted compaction leaves only repeated rows, which the latest
        view reads as one.
        """
        present = self.batches()
        if not present:
            return None
        cols = [f"{f}.{q}" for f, qs in self.families.items() for q in qs]
        log = self.log().filter(F.col("_batch").isin(*present)).drop("_batch")
        owner = F.struct("_version", "_source")
        names = {c: f"c{i}" for i, c in enumerate(cols)}
        # per cell the version and source that own it, then one row per owner
        aggs = [F.max(F.when(F.col(c).isNotNull(), F.struct(owner.alias("o"), F.col(c).alias("v"))))
                .alias(names[c]) for c in cols]
        single, again = self._split(log, None)
        best = again.groupBy("row_key").agg(*aggs)
        owners = F.array_distinct(F.array_compact(F.array(*[
            F.col(f"{n}.o") for n in names.values()])))
        each = best.select("*", F.explode(owners).alias("o"))
        fams = [F.struct(*[F.when(F.col(f"{names[f'{f}.{q}']}.o") == F.col("o"),
                                  F.col(f"{names[f'{f}.{q}']}.v")).alias(q)
                           for q in qs]).alias(f) for f, qs in self.families.items()]
        declared = each.select("row_key", *fams,
                               F.lit(None).cast("map<string,string>").alias("_open"),
                               F.col("o._source").alias("_source"),
                               F.col("o._version").alias("_version"))
        # open cells: the newest of each name, one row per owner
        opened = (again.select("row_key", owner.alias("o"), F.explode("_open").alias("k", "v"))
                  .groupBy("row_key", "k").agg(F.max(F.struct("o", "v")).alias("b"))
                  .groupBy("row_key", "b.o").agg(F.map_from_entries(F.collect_list(
                      F.struct("k", "b.v"))).alias("_open")))
        empty = [F.lit(None).cast(log.schema[f].dataType).alias(f) for f in self.families]
        rows = (single.unionByName(declared.select(*log.columns))
                .unionByName(opened.select("row_key", *empty, "_open", F.col("o._source").alias(
                    "_source"), F.col("o._version").alias("_version")).select(*log.columns)))
        name = f"{COMPACTED}.{uuid.uuid4().hex}"
        path = f"{self.location()}/_batch={name}"
        rows.repartitionByRange("row_key").sortWithinPartitions("row_key").write.parquet(path)
        self.spark.sql(f"ALTER TABLE {self.name} ADD PARTITION (_batch = '{name}') LOCATION '{path}'")
        for b in present:
            if not b.startswith(f"{COMPACTED}."):
                fs.write_text(self.spark, f"{self._folded_path()}/{b}", "")
        self._retire(present)
        return name

    def maintain(self, max_batches: int) -> bool:
        """Keep the log short: when more than ``max_batches`` batches exist,
        fold them.  Returns whether it compacted."""
        if len(self.batches()) <= max_batches:
            return False
        self.compact()
        return True

    def _retire(self, batches: list[str]) -> None:
        """Catalog entries and files of folded batches (the table is external,
        so dropping a partition alone would leave the files)."""
        for b in batches:
            path = self._path_of(b)
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (_batch = '{b}')")
            fs.delete(self.spark, path)
        self.spark.catalog.refreshTable(self.name)


def _slot() -> Column:
    """The slot of a row's key, from 1."""
    return F.pmod(F.xxhash64("row_key"), F.lit(SLOTS)) + 1


def key_share(key: Column, seed: int = 0) -> Column:
    """A number from 0 to 1 that depends on the key and the seed only."""
    digest = F.md5(F.concat(key, F.lit(f":{int(seed)}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)
