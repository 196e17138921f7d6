"""Delimited records -> named columns.

``line.split(",")`` on the JVM drops trailing empty fields, so a record whose
last fields are empty has fewer fields and the original job failed on it.
Here Spark's ``split(..., -1)`` keeps every field; a record is rejected when
fewer than ``len(names)`` fields remain after trailing empties are dropped.
Extra fields are ignored, as before.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: the player record of the original scratch jobs --------
PLAYER_FIELDS = ["row_key", "age", "name", "gender", "salary"]
PLAYER_CELLS = {"cf1:name": "name", "cf1:age": "age",
                "cf2:gender": "gender", "cf2:salary": "salary"}
PLAYER_FAMILIES = {"cf1": ["name", "age"], "cf2": ["gender", "salary"]}
# ---------------------------------------------------------------------------


def split_fields(line, sep: str = ","):
    """All fields of a line, trailing empties included."""
    return F.split(line, sep, -1)


def parse_delimited(df: DataFrame, names: Sequence[str] = PLAYER_FIELDS,
                    line: str = "line", sep: str = ",", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and ``names`` columns plus ``err`` (null for a good record)."""
    parts = split_fields(F.col(line), sep)
    # number of fields once trailing empty ones are dropped
    trimmed = F.size(F.split(F.regexp_replace(F.col(line), f"(\\Q{sep}\\E)+$", ""), sep, -1))
    kept = F.when(F.col(line) == "", F.lit(0)).otherwise(trimmed)
    bad = F.col(line).isNull() | (kept < len(names))
    err = F.when(bad, F.format_string("record: %d of %d fields", F.coalesce(kept, F.lit(0)),
                                      F.lit(len(names))))
    cols = [F.when(~bad, F.get(parts, i)).alias(n) for i, n in enumerate(names)]
    return df.select(*keep, *cols, err.alias("err"))
