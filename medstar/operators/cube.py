"""Pre-aggregated cubes over the patient fact, kept in time segments (Q1–Q7).

A cube has dimensions (fact columns) and a fixed set of mergeable measures:

* ``n_visits``     – ``count(*)``, merged by sum;
* ``first_month``  – ``min(time)``, merged by min;
* ``last_month``   – ``max(time)``, merged by max;
* ``patients_hll`` – HLL sketch of the patient id, merged by
  ``hll_union_agg``; read with ``hll_sketch_estimate``.

A cube with ``exact_patients`` also keeps the patients of every cuboid row as
bitmaps over dense patient numbers, one row per bucket of 32,768 numbers:
merged by ``bitmap_or_agg``, counted by ``bitmap_count``, so the number of
different patients is exact over any segments and groups.  Numbers are given
once per cube and patient and kept in the cube's folder.

Cuboids come by roll-up: the fact is aggregated once, by all dimensions, and
every other cuboid is derived from its smallest stored parent (``rollup``).
Segments are of whole months, so a fact row whose time is no month belongs to
none; ``time_rejects`` lists those rows.

Storage: every build writes a folder of its own,
``<root>/<cube>/attempt=<id>/segment=<yyyyMM_yyyyMM>/gid=<n>`` (parquet, one row
per grouping, ``gid`` = ``grouping_id()``, and dimension values).  A segment
becomes visible when its folder is named in the metadata, so a reader sees
the old rows or the new ones, and a refresh to nothing is nothing.

Metadata: a numbered small file under ``<root>/_meta`` (one line per cube).  A
change is made against the newest number and written as the next one, which
only one writer can create; the others apply their change again to what
that one wrote, so concurrent changes of one cube are never lost.

Build, refresh and merge are Spark aggregations; the only driver work is the
metadata row and the list of segment folders.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path
from ..sources import fs
from .rollup import every_set, gid_of, roll_up

MAX_GROUPINGS = 1024         # stored when no grouping sets are named
BUILD_TYPES = ("BUILD", "REFRESH", "MERGE")
_END = "#end"                # last line of a whole metadata file
KEPT_VERSIONS = 20           # older metadata files are deleted
MEASURES = ["n_visits", "first_month", "last_month", "patients_hll"]


@dataclass
class CubeDef:
    name: str
    dimensions: list[str]
    project: str = "default"
    model: str | None = None
    time_column: str = "inTimeId"
    patient_column: str = "idCard"
    grouping_sets: list[list[str]] | None = None
    exact_patients: bool = False
    status: str = "DISABLED"         # READY once built; DISABLED refuses queries
    segments: list[dict] = field(default_factory=list)

    def __post_init__(self):
        if self.grouping_sets is None and 2 ** len(self.dimensions) > MAX_GROUPINGS:
            raise ValueError(f"more than {MAX_GROUPINGS} groupings: name the grouping sets")
        self.model = self.model or self.name

    def to_row(self) -> dict:
        return {"name": self.name, "body": json.dumps(self.__dict__, sort_keys=True)}

    @classmethod
    def from_row(cls, body: str) -> "CubeDef":
        return cls(**json.loads(body))


def month_of(epoch_ms: int) -> str:
    """Start of a month in epoch milliseconds (UTC) -> ``yyyyMM``; any other
    time is refused, since segments hold whole months."""
    at = datetime.fromtimestamp(epoch_ms / 1000, tz=timezone.utc)
    if (at.day, at.hour, at.minute, at.second, epoch_ms % 1000) != (1, 0, 0, 0, 0):
        raise ValueError(f"{at.isoformat()} is not the start of a month")
    return at.strftime("%Y%m")


def ms_of(month: str) -> int:
    """``yyyyMM`` -> epoch milliseconds of its start (UTC)."""
    at = datetime(int(month[:4]), int(month[4:6]), 1, tzinfo=timezone.utc)
    return int(at.timestamp()) * 1000


def _next_month(month: str) -> str:
    y, m = int(month[:4]), int(month[4:6])
    return f"{y + m // 12:04d}{m % 12 + 1:02d}"


def is_month(time: Column) -> Column:
    """Whether a time begins with a month, ``yyyyMM``."""
    return F.coalesce(time.rlike("^(?!0000)[0-9]{4}(0[1-9]|1[0-2])"), F.lit(False))


def time_bounds(fact: DataFrame, time_column: str = "inTimeId") -> tuple[int, int] | None:
    """The smallest whole-month range (epoch ms) that holds every row whose
    time is a month; None without any."""
    # each time is looked at once, not each row (a bare distinct below min and max
    # would be optimised away, a filter pushed below it)
    t = F.col("time")
    month = F.when((F.col("rows") > 0) & is_month(t), t)
    r = fact.groupBy(F.col(time_column).alias("time")).agg(F.count(F.lit(1)).alias("rows")).agg(
        F.min(month).alias("lo"), F.max(month).alias("hi")).first()
    return None if r["lo"] is None else (ms_of(r["lo"][:6]), ms_of(_next_month(r["hi"][:6])))


def time_rejects(fact: DataFrame, time_column: str = "inTimeId") -> DataFrame:
    """The fact rows that no segment can hold, with ``field`` and ``reason``."""
    t = F.col(time_column)
    return fact.filter(~is_month(t)).withColumns({
        "field": F.lit(time_column),
        "reason": F.when(t.isNull(), f"{time_column}: null").otherwise(
            F.concat(F.lit(f"{time_column}: no month: "), t))})


def _range(start_ms: int, end_ms: int) -> tuple[str, str]:
    lo, hi = month_of(start_ms), month_of(end_ms)
    if lo >= hi:
        raise ValueError(f"empty range {lo}_{hi}")
    return lo, hi


def _fits(lo: str, hi: str):
    """Refuses a range that overlaps a segment."""
    def check(cube: CubeDef) -> None:
        for s in cube.segments:
            if s["lo"] < hi and lo < s["hi"]:
                raise ValueError(f"segment {lo}_{hi} overlaps {s['name']}")

    return check


def _refreshes(seg: str):
    """Refuses a refresh of a segment that isn't there."""
    def check(cube: CubeDef) -> None:
        if all(s["name"] != seg for s in cube.segments):
            raise ValueError(f"no segment {seg} to refresh")

    return check


class CubeStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cached: tuple[str, list[dict]] | None = None   # (version, rows)

    # ----------------------------------------------------------- metadata --
    def _meta_path(self) -> str:
        return f"{self.root}/_meta"

    def _versions(self) -> list[str]:
        return [v for v in fs.list_names(self.spark, self._meta_path()) if v.endswith(".json")]

    def _newest(self) -> tuple[int, dict[str, CubeDef]]:
        """The newest whole metadata file: its number and the cubes.  A file
        whose writer died half-way has no end line and doesn't count."""
        names = sorted(self._versions(), reverse=True)
        number = int(names[0][1:-5]) if names else 0
        for name in names:
            if self._cached is None or self._cached[0] != name:
                lines = fs.read_text(self.spark, f"{self._meta_path()}/{name}").split("\n")
                if lines[-1] != _END:
                    continue
                self._cached = (name, [json.loads(line) for line in lines[:-1]])
            return number, {r["name"]: CubeDef.from_row(r["body"]) for r in self._cached[1]}
        return number, {}

    def _load(self) -> dict[str, CubeDef]:
        return self._newest()[1]

    def _change(self, change) -> None:
        """Applies ``change(cubes)`` (which may refuse) to the newest metadata
        and writes the next version; again if another writer was first."""
        while True:
            number, cubes = self._newest()
            change(cubes)
            rows = [c.to_row() for c in cubes.values()]
            name = f"v{number + 1:020d}.json"
            text = "".join(json.dumps(r) + "\n" for r in rows) + _END
            if fs.create_text(self.spark, f"{self._meta_path()}/{name}", text):
                break
        self._cached = (name, rows)
        for old in self._versions():
            if int(old[1:-5]) <= number - KEPT_VERSIONS:
                fs.delete(self.spark, f"{self._meta_path()}/{old}")

    def define(self, cube: CubeDef) -> CubeDef:
        def add(cubes: dict[str, CubeDef]) -> None:
            if cube.name in cubes:
                raise ValueError(f"cube {cube.name} exists")
            cubes[cube.name] = cube

        self._change(add)
        return cube

    def get(self, name: str) -> CubeDef:
        cubes = self._load()
        if name not in cubes:
            raise KeyError(f"no cube {name}")
        return cubes[name]

    def _update(self, name: str, change) -> None:
        """``change(cube)`` on the newest definition of one cube."""
        def one(cubes: dict[str, CubeDef]) -> None:
            if name not in cubes:
                raise KeyError(f"no cube {name}")
            change(cubes[name])

        self._change(one)

    def enable(self, name: str) -> None:
        """Q5."""
        def ready(c: CubeDef) -> None:
            if not c.segments:
                raise ValueError(f"cube {name} has no segment to serve")
            c.status = "READY"

        self._update(name, ready)

    def disable(self, name: str) -> None:
        """Q5."""
        self._update(name, lambda c: setattr(c, "status", "DISABLED"))

    # -------------------------------------------------------------- build --
    def _cube_path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _finest(self, cube: CubeDef, rows: DataFrame) -> DataFrame:
        """Rows of a fact with its ``segment`` by all dimensions: one
        aggregation, its partial sums map-side."""
        dims = self._top(cube)
        found = rows.groupBy("segment", *dims).agg(
            F.count(F.lit(1)).alias("n_visits"), F.min(cube.time_column).alias("first_month"),
            F.max(cube.time_column).alias("last_month"),
            F.hll_sketch_agg(cube.patient_column).alias("patients_hll"))
        return self._all_dims(cube, found)

    @staticmethod
    def _top(cube: CubeDef) -> list[str]:
        sets = cube.grouping_sets
        return [d for d in cube.dimensions if sets is None or any(d in s for s in sets)]

    def _all_dims(self, cube: CubeDef, rows: DataFrame) -> DataFrame:
        top = self._top(cube)
        return rows.withColumns({d: F.lit(None).cast("string") for d in cube.dimensions
                                 if d not in top})

    @staticmethod
    def _merged() -> list[Column]:
        return [F.sum("n_visits").cast("bigint").alias("n_visits"),
                F.min("first_month").alias("first_month"),
                F.max("last_month").alias("last_month"),
                F.hll_union_agg("patients_hll").alias("patients_hll")]

    def _roll_up(self, cube: CubeDef, fact: DataFrame, seg_col: Column) -> str:
        """Every cuboid of the fact's segments into a folder of its own."""
        sets = cube.grouping_sets or every_set(cube.dimensions)
        path = f"{self._cube_path(cube.name)}/{(attempt := f'attempt={uuid.uuid4().hex}')}"
        rows = fact.withColumn("segment", seg_col).filter("segment is not null")
        self._cuboids(cube, self._finest(cube, rows), sets, path, self._merged(), self._schema(cube))
        if cube.exact_patients:
            ids = self._patient_ids(cube, rows)
            p = F.col(cube.patient_column)
            dims = self._top(cube)
            bits = (rows.select("segment", *dims, p.alias("_patient"))
                    .join(ids, F.col("_patient") == F.col("patient"))
                    .groupBy("segment", *dims, F.bitmap_bucket_number("id").alias("bucket"))
                    .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")))
            self._cuboids(cube, self._all_dims(cube, bits), sets, self._bits_path(cube.name, attempt),
                          [F.bitmap_or_agg("bits").alias("bits")], self._bits_schema(cube), ("bucket",))
        return attempt

    def _cuboids(self, cube: CubeDef, finest: DataFrame, sets: list, path: str, merge: list[Column],
                 schema: str, keys: tuple[str, ...] = ()) -> None:
        """Rolls up into the folder ``path``, one sub-folder per cuboid, so a
        query reads the files of its cuboid only."""
        columns = StructType.fromDDL(schema).names
        # a finest grouping that is not asked for is no part of the store
        stored = frozenset(self._top(cube)) in map(frozenset, sets)
        written: list[str] = []

        def store(rows: DataFrame) -> DataFrame:
            target = path if stored or written else scratch_path(self.spark, "cube-finest")
            # one task per segment and cuboid; only a large cuboid is split
            (rows.select(*columns).hint("rebalance", "segment", "gid")
             .write.mode("append").partitionBy("segment", "gid").parquet(target))
            if target not in written:
                written.append(target)
            parts = [self.spark.read.schema(schema).parquet(p) for p in written]
            return reduce(DataFrame.unionByName, parts)

        roll_up(finest, cube.dimensions, sets, merge, store, keys=("segment", *keys))

    # ----------------------------------------------------- patient numbers --
    def _bits_path(self, name: str, attempt: str) -> str:
        return f"{self._cube_path(name)}/_patients/{attempt}"

    def _patient_ids(self, cube: CubeDef, rows: DataFrame) -> DataFrame:
        """(patient, id) with the patients of ``rows``; new ones are numbered
        after the known ones, range by range, and stored."""
        path, schema = f"{self._cube_path(cube.name)}/_patient_ids", "patient string, id long"

        def known() -> DataFrame:
            parts = [self.spark.read.schema(schema).parquet(f"{path}/{n}")
                     for n in fs.list_names(self.spark, path)]
            return reduce(DataFrame.unionByName, parts, self.spark.createDataFrame([], schema))

        before, last = known(), known().agg(F.max("id")).first()[0] or 0
        scratch = scratch_path(self.spark, "cube-patients")
        (rows.select(F.col(cube.patient_column).alias("patient")).filter("patient is not null")
         .distinct().join(before, "patient", "left_anti").repartitionByRange("patient")
         .withColumn("part", F.spark_partition_id()).write.parquet(scratch))
        new = self.spark.read.schema("patient string, part int").parquet(scratch)
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        moved = new.groupBy("part").count().select(             # one row per range
            "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("moved"))
        own = Window.partitionBy("part").orderBy("patient")
        (new.join(F.broadcast(moved), "part")
         .select("patient", (F.row_number().over(own) + F.col("moved") + last).alias("id"))
         .write.parquet(f"{path}/{uuid.uuid4().hex}"))
        return known()

    def _bits_schema(self, cube: CubeDef) -> str:
        return ", ".join([f"`{d}` string" for d in cube.dimensions]
                         + ["bucket bigint", "bits binary", "segment string", "gid bigint"])

    def build(self, name: str, fact: DataFrame, start_ms: int, end_ms: int,
              build_type: str = "BUILD") -> str:
        """Q1 / Q2 / Q3.  Returns the segment name.

        BUILD and REFRESH compute the segment ``[start, end)`` from the fact;
        both bounds are starts of months.  REFRESH requires the segment to
        exist, BUILD that it does not overlap another.  MERGE folds the
        segments inside the range into one.
        """
        if build_type not in BUILD_TYPES:
            raise ValueError(f"build type must be one of {BUILD_TYPES}")
        lo, hi = _range(start_ms, end_ms)
        if build_type == "MERGE":
            return self.merge(name, lo, hi)
        cube, seg = self.get(name), f"{lo}_{hi}"
        check = _refreshes(seg) if build_type == "REFRESH" else _fits(lo, hi)
        check(cube)
        self._publish(name, self._roll_up(cube, fact, self._segment(cube, [(lo, hi)])), [(lo, hi)],
                      check)
        return seg

    @staticmethod
    def _segment(cube: CubeDef, segs: list[tuple[str, str]]) -> Column:
        """The segment of a fact row, null for a row of none."""
        t = F.col(cube.time_column)
        out = F.lit(None).cast("string")
        for lo, hi in reversed(segs):
            out = F.when((t >= lo) & (t < hi), F.lit(f"{lo}_{hi}")).otherwise(out)
        return F.when(is_month(t), out)

    def build_segments(self, name: str, fact: DataFrame, bounds_ms: list[int]) -> list[str]:
        """Q1 for several adjacent segments at once: ``bounds_ms`` = b0 < b1 <
        ... gives segments [b0, b1), [b1, b2), ...  One scan of the fact and one
        roll-up, in which the segment is a key, instead of one per segment."""
        cube = self.get(name)
        months = [month_of(b) for b in bounds_ms]
        if len(months) < 2 or months != sorted(set(months)):
            raise ValueError("bounds must be increasing months")
        segs = list(zip(months, months[1:]))
        check = _fits(months[0], months[-1])
        check(cube)
        self._publish(name, self._roll_up(cube, fact, self._segment(cube, segs)), segs, check)
        return [f"{lo}_{hi}" for lo, hi in segs]

    def _publish(self, name: str, attempt: str, segs: list[tuple[str, str]], check,
                 replaced: tuple[str, ...] = ()) -> None:
        """Names the written segments in the metadata, after ``check`` against
        its newest state, and retires the folders nothing refers to any more."""
        names = {f"{lo}_{hi}" for lo, hi in segs} | set(replaced)

        def swap(cube: CubeDef) -> None:
            check(cube)
            cube.segments = sorted(
                [s for s in cube.segments if s["name"] not in names]
                + [{"name": f"{lo}_{hi}", "lo": lo, "hi": hi, "folder": attempt} for lo, hi in segs],
                key=lambda s: s["lo"])
            cube.status = "READY"

        before = {s["name"]: s["folder"] for s in self.get(name).segments}
        try:
            self._update(name, swap)
        except Exception:
            fs.delete(self.spark, f"{self._cube_path(name)}/{attempt}")
            fs.delete(self.spark, self._bits_path(name, attempt))
            raise
        for old in names & set(before):
            self._drop(name, before[old], old)

    def _drop(self, name: str, folder: str, segment: str) -> None:
        fs.delete(self.spark, f"{self._cube_path(name)}/{folder}/segment={segment}")
        fs.delete(self.spark, f"{self._bits_path(name, folder)}/segment={segment}")

    def merge(self, name: str, lo: str, hi: str) -> str:
        """Q3: one segment from all segments inside ``[lo, hi)``, which must
        follow each other without a gap."""
        cube = self.get(name)
        parts = [s for s in cube.segments if s["lo"] >= lo and s["hi"] <= hi]
        if len(parts) < 2:
            raise ValueError("a merge needs at least two segments in the range")
        for a, b in zip(parts, parts[1:]):
            if a["hi"] != b["lo"]:
                raise ValueError(f"no segment holds {a['hi']}_{b['lo']}: a merge would hide the gap")
        new_lo, new_hi = parts[0]["lo"], parts[-1]["hi"]
        seg = f"{new_lo}_{new_hi}"

        def same(c: CubeDef) -> None:
            if not all(p in c.segments for p in parts):
                raise ValueError("a segment of the merge has changed meanwhile")

        # the new segment is written beside the old ones, which are retired when
        # it is visible: a failed merge leaves them as they are
        attempt = f"attempt={uuid.uuid4().hex}"
        kept = [(self._read_segments(cube, parts), self._merged(), (),
                 f"{self._cube_path(name)}/{attempt}")]
        if cube.exact_patients:
            kept.append((self._read_bits(cube, parts), [F.bitmap_or_agg("bits").alias("bits")],
                         ("bucket",), self._bits_path(name, attempt)))
        for rows, merge, keys, path in kept:
            (rows.groupBy("gid", *cube.dimensions, *keys).agg(*merge)
             .withColumn("segment", F.lit(seg)).hint("rebalance", "gid")
             .write.partitionBy("segment", "gid").parquet(path))
        self._publish(name, attempt, [(new_lo, new_hi)], same, tuple(p["name"] for p in parts))
        return seg

    def purge(self, name: str) -> None:
        """Q4: drop every segment; the definition stays."""
        gone: list[dict] = []

        def empty(c: CubeDef) -> None:
            gone[:] = c.segments
            c.segments, c.status = [], "DISABLED"

        self._update(name, empty)
        for s in gone:
            self._drop(name, s["folder"], s["name"])

    # -------------------------------------------------------------- reads --
    def _schema(self, cube: CubeDef) -> str:
        return ", ".join([f"`{d}` string" for d in cube.dimensions]
                         + ["n_visits bigint", "first_month string", "last_month string",
                            "patients_hll binary", "segment string", "gid bigint"])

    def _read_segments(self, cube: CubeDef, segments: list[dict]) -> DataFrame:
        return self._read(self._cube_path(cube.name), segments, self._schema(cube))

    def _read_bits(self, cube: CubeDef, segments: list[dict]) -> DataFrame:
        return self._read(f"{self._cube_path(cube.name)}/_patients", segments, self._bits_schema(cube))

    def _read(self, base: str, segments: list[dict], schema: str) -> DataFrame:
        # a segment without rows in its range has no folder at all
        paths = [f"{base}/{s['folder']}/segment={s['name']}" for s in segments]
        paths = [p for p in paths if fs.exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema + ", attempt string").option("basePath", base)
                .parquet(*paths).drop("attempt"))

    def cuboids(self, name: str) -> DataFrame:
        """Every stored row of every segment."""
        cube = self.get(name)
        return self._read_segments(cube, cube.segments)

    def query(self, name: str, group_by: list[str], where: dict | None = None,
              estimate_patients: bool = False,
              between: tuple[int, int] | None = None) -> DataFrame:
        """Q6: answer ``group_by`` (+ equality / IN filters on dimensions) from
        the smallest stored cuboid that holds all the columns it needs.

        ``between=(start_ms, end_ms)`` answers for that time window from the
        segments inside it only (only their folders are read); a window that
        cuts a segment is refused, since a segment's totals cannot be split.

        Without a visit in the window or under the filters there is no row,
        with or without ``group_by``."""
        cube, rows = self._serving(name, group_by, where or {}, between, self._read_segments)
        out = rows.groupBy(*group_by).agg(*self._merged())
        if not group_by:
            out = out.filter(F.col("n_visits").isNotNull())     # nothing was added up
        if estimate_patients:
            out = out.withColumn("patients_est", F.hll_sketch_estimate("patients_hll"))
        return out.drop("patients_hll")

    def exact_patients(self, name: str, group_by: list[str], where: dict | None = None,
                       between: tuple[int, int] | None = None) -> DataFrame:
        """(group_by, n_patients): numbers of different patients, exact over
        the segments and groups that are merged; as ``query`` otherwise."""
        cube, rows = self._serving(name, group_by, where or {}, between, self._read_bits)
        if not cube.exact_patients:
            raise ValueError(f"cube {name} keeps no exact patients")
        out = (rows.groupBy(*group_by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
               .groupBy(*group_by).agg(F.sum(F.bitmap_count("bits")).alias("n_patients")))
        return out if group_by else out.filter(F.col("n_patients").isNotNull())

    def _serving(self, name: str, group_by: list[str], where: dict,
                 between: tuple[int, int] | None, read) -> tuple[CubeDef, DataFrame]:
        """The rows of the smallest fitting cuboid in the window's segments,
        under the filters."""
        cube = self.get(name)
        segments = cube.segments
        if between is not None:
            lo, hi = _range(*between)
            cut = [s["name"] for s in segments
                   if s["lo"] < hi and lo < s["hi"] and not (lo <= s["lo"] and s["hi"] <= hi)]
            if cut:
                raise ValueError(f"window {lo}_{hi} cuts segments {cut}")
            segments = [s for s in segments if lo <= s["lo"] and s["hi"] <= hi]
        if cube.status != "READY":
            raise PermissionError(f"cube {name} is {cube.status}")
        needed = list(dict.fromkeys([*group_by, *where]))
        unknown = [c for c in needed if c not in cube.dimensions]
        if unknown:
            raise ValueError(f"not dimensions of {name}: {unknown}")
        sets = cube.grouping_sets or None
        if sets is None:
            target = gid_of(cube.dimensions, needed)
        else:
            fits = [s for s in sets if set(needed) <= set(s)]
            if not fits:
                raise ValueError("no stored grouping holds these columns")
            target = gid_of(cube.dimensions, min(fits, key=len))
        rows = read(cube, segments).filter(F.col("gid") == target)
        for col, val in where.items():
            rows = rows.filter(F.col(col).isin(*val) if isinstance(val, (list, tuple, set))
                               else F.col(col) == val)
        return cube, rows

    def forget(self) -> None:
        """Read the metadata anew next time."""
        self._cached = None

    def register_views(self, prefix: str = "cube_", only: str | None = None) -> list[str]:
        """Q6 (a): one temp view per READY cube (its cuboid rows, HLL sketches
        read as estimates), so plain ``spark.sql`` text can query them."""
        names = []
        for c in self._load().values():
            if c.status != "READY" or only not in (None, c.name):
                continue
            view = f"{prefix}{c.name}"
            (self.cuboids(c.name)
             .withColumn("patients_est", F.hll_sketch_estimate("patients_hll"))
             .drop("patients_hll").createOrReplaceTempView(view))
            names.append(view)
        return names

    # ------------------------------------------------------------ listing --
    def list_cubes(self, offset: int = 0, limit: int = 100, name_contains: str | None = None,
                   project: str | None = None) -> DataFrame:
        """Q7 / L2: cubes whose name contains the keyword, in one project,
        ordered by name, one page."""
        rows = []
        for c in self._load().values():
            if name_contains and name_contains not in c.name:
                continue
            if project and c.project != project:
                continue
            rows.append((c.name, c.project, c.model, c.status, len(c.segments),
                         ",".join(c.dimensions)))
        df = self.spark.createDataFrame(
            rows, "name string, project string, model string, status string, "
                  "n_segments int, dimensions string")
        return df.orderBy("name").offset(offset).limit(limit)

    def model(self, name: str) -> DataFrame:
        """Q7 (data model): what a cube is built from."""
        c = self.get(name)
        return self.spark.createDataFrame(
            [(c.model, c.name, c.project, ",".join(c.dimensions), c.time_column,
              c.patient_column, ",".join(MEASURES))],
            "model string, cube string, project string, dimensions string, "
            "time_column string, patient_column string, measures string")

    def describe(self, name: str) -> DataFrame:
        """Q7: one cube's definition and segments."""
        c = self.get(name)
        seg_rows = [(c.name, s["name"], s["lo"], s["hi"]) for s in c.segments]
        return self.spark.createDataFrame(
            seg_rows, "cube string, segment string, start_month string, end_month string")
