"""String, number and encoding scalars of the original jobs as Spark Column
functions (C1–C11), for plans that stay in the JVM.

A "reject" is a null here; pair it with a reason column where the caller
needs one.  Lengths count characters (code points); the Python helpers in
``xml_paths`` count UTF-16 units as the original did, which differs only
for characters outside the Basic Multilingual Plane.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def drop_leading(s, n: int) -> Column:
    """``s.drop(n)``; safe on short input (gives '')."""
    return F.substr(_c(s), F.lit(n + 1))


def prefix(s, n: int) -> Column:
    """``s.substring(0, n)``; null (reject) when ``s`` is shorter."""
    s = _c(s)
    return F.when(F.length(s) >= n, F.substring(s, 1, n))


def char_at(s, i: int) -> Column:
    """``s.charAt(i)``; null (reject) when ``s`` is too short."""
    s = _c(s)
    return F.when(F.length(s) > i, F.substring(s, i + 1, 1))


def concat_space(a, b) -> Column:
    """C4: ``a + " " + b``; null if either is null (``concat_ws`` would hide it)."""
    return F.concat(_c(a), F.lit(" "), _c(b))


def to_int(s) -> Column:
    """``s.toInt``: optional sign and ASCII digits, 32-bit range; null
    (reject) otherwise.  A plain cast would also accept spaces and fractions."""
    s = _c(s)
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))


def int_div(x, d: int) -> Column:
    """Integer division truncating toward zero (``-5 / 10 = 0``)."""
    x = _c(x).cast("bigint")
    q = F.floor(F.abs(x) / F.lit(abs(d))).cast("bigint")
    return F.when((x >= 0) == F.lit(d > 0), q).otherwise(-q)


def to_text(x) -> Column:
    """C7."""
    return _c(x).cast("string")


def is_equal(a, b) -> Column:
    """Equality, null-safe (``a == b`` in the original)."""
    return _c(a).eqNullSafe(_c(b))


def split_all(s, sep: str = ",") -> Column:
    """Every field, trailing empty ones included."""
    return F.split(_c(s), sep, -1)


def utf8_encode(s) -> Column:
    """C10."""
    return F.encode(_c(s), "UTF-8")


def utf8_decode(b) -> Column:
    """C10."""
    return F.decode(_c(b), "UTF-8")


def month_key(t) -> Column:
    """C11: ``yyyyMM`` of a compact time string; no date parsing."""
    return prefix(t, 6)


def compact_time(t, digits: int = 14) -> Column:
    """``yyyyMMddHHmmss`` (first ``digits`` digits) of a wall-clock timestamp
    or date, read from its text form: no time-zone conversion happens, so a
    timestamp without time zone keeps its digits in any session zone."""
    text = F.substring(_c(t).cast("string"), 1, 19)
    digits_only = F.regexp_replace(text, "[^0-9]", "")
    return F.substring(F.rpad(digits_only, 14, "0"), 1, digits)


def filter_char_at(values, pos: int, char: str) -> Column:
    """The elements whose character ``pos`` (0-based) is ``char``, with a
    higher-order ``filter``.  Null (reject) when any element is shorter than
    ``pos + 1``, as ``charAt`` failed on such an element."""
    arr = _c(values)
    too_short = F.exists(arr, lambda e: e.isNull() | (F.length(e) <= pos))
    kept = F.filter(arr, lambda e: F.substring(e, pos + 1, 1) == F.lit(char))
    return F.when(~too_short, kept)


def filter_prefix(values, prefix: str) -> Column:
    """The elements that start with ``prefix``; null elements are skipped
    (an absent attribute), and null (reject) when a present element is
    shorter than the prefix, as ``substring(0, n)`` failed on it."""
    arr = _c(values)
    n = len(prefix)
    too_short = F.exists(arr, lambda e: e.isNotNull() & (F.length(e) < n))
    kept = F.filter(arr, lambda e: e.isNotNull() & e.startswith(prefix))
    return F.when(~too_short, kept)


def only_one(values) -> Column:
    """X6 with the single-node rule: the element when there is exactly one,
    else null."""
    arr = _c(values)
    return F.when(F.size(arr) == 1, F.get(arr, 0))
