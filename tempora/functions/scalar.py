"""Scalar column functions (C1-C10); all built-in expressions, no UDF."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Mean Earth radius used for station distances (metres).
EARTH_RADIUS_M = 6371000.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- C1 ---------------------------------------------------------------------
def cube_root_abs(x) -> Column:
    """``abs(x) ** (1/3)`` (marker size of the flow map)."""
    return F.pow(F.abs(_c(x)), F.lit(1.0 / 3.0))


# --- C2 ---------------------------------------------------------------------
def minmax_scale(df: DataFrame, col: str, out: str, divisor: float = 10.0) -> DataFrame:
    """``(x - min) / ((max - min) * divisor)`` with the extent over the whole
    frame (scalar subqueries); a constant column gives NULL."""
    lo = df.select(F.min(col)).scalar()
    hi = df.select(F.max(col)).scalar()
    return df.withColumn(out, F.try_divide(F.col(col) - lo, (hi - lo) * F.lit(divisor)))


# --- C3 / C4 / C5 -----------------------------------------------------------
def date_label(x) -> Column:
    return F.date_format(_c(x), "yyyy-MM-dd")


def to_day(x) -> Column:
    return F.to_date(_c(x))


def minus_days(x, n: int) -> Column:
    return _c(x) - F.make_interval(days=F.lit(n))


def minus_months(x, n: int) -> Column:
    return F.add_months(_c(x), -n)


# --- C6 ---------------------------------------------------------------------
def capitalize(x) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    c = _c(x)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def split_part(x, sep: str, index: int) -> Column:
    """1-based part of ``x`` split on a literal separator ('' when absent)."""
    return F.split_part(_c(x), F.lit(sep), F.lit(index))


# --- C7 ---------------------------------------------------------------------
def map_lookup(x, mapping: Mapping) -> Column:
    """Constant dictionary lookup; a missing key gives NULL."""
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.try_element_at(m, _c(x))


# --- C8 ---------------------------------------------------------------------
def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    # rounding can take opposite points a little over 1
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


# --- C9 ---------------------------------------------------------------------
def row_key(*cols) -> Column:
    """Deterministic key from natural-key columns (re-runs give the same id)."""
    return F.sha2(F.concat_ws("\u0001", *[_c(c).cast("string") for c in cols]), 256)


def random_key() -> Column:
    """Non-deterministic unique id (the reference's time-based UUID)."""
    return F.expr("uuid()")


# --- C10 --------------------------------------------------------------------
def rounded(x, digits: int) -> Column:
    return F.round(_c(x), digits)
