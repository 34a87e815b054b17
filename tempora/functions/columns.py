"""Projections, renames, casts and predicates (B1-B13).

All of these are narrow transformations: no shuffle, filters and column
choices reach the Parquet scan.  Values are passed with ``lit`` and never
formatted into SQL strings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the reference: regions east of the Great Belt.
DK2_REGIONS = ("Zealand", "Capital")


# --- B1 ---------------------------------------------------------------------
def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in cols])


# --- B2 ---------------------------------------------------------------------
def normalise_names(df: DataFrame, rename: Mapping[str, str] | None = None,
                    drop: Sequence[str] = (), lower: bool = True) -> DataFrame:
    """Drop, rename, then lower-case column names.

    Spark resolves names case-insensitively, so two columns that differ only
    in case would silently shadow each other; that raises here.
    """
    rename = dict(rename or {})
    cols = [c for c in df.columns if c not in set(drop)]
    new = [rename.get(c, c) for c in cols]
    if lower:
        new = [c.lower() for c in new]
    seen = {}
    for old, n in zip(cols, new):
        if n.lower() in seen:
            raise ValueError(f"column name collision: {seen[n.lower()]!r} and {old!r} -> {n!r}")
        seen[n.lower()] = old
    return df.select(*[F.col(f"`{o}`").alias(n) for o, n in zip(cols, new)])


def index_to_column(df: DataFrame, name: str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """pandas ``reset_index`` stand-in: an explicit 0-based position column
    in ``order`` (a total order), over the frame or per ``by`` group.

    Numbered per coarse bucket of the first order column plus a running
    offset, so no single task holds the frame (see ``operators.series``).
    """
    from tempora.operators.series import with_position
    return with_position(df, list(by), order, name)


# --- B3 ---------------------------------------------------------------------
_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
}


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType],
                 safe: bool = False, timestamp_format: str | None = None) -> DataFrame:
    """Cast the named columns.  ``safe=True`` uses ``try_cast`` (dirty
    input becomes NULL; Spark 4 runs in ANSI mode and raises otherwise).
    Timestamps with a format go through ``to_timestamp``."""
    out = []
    for c in df.columns:
        if c not in types:
            out.append(F.col(f"`{c}`"))
            continue
        t = types[c]
        dt = _TYPES[t] if isinstance(t, str) else t
        col = F.col(f"`{c}`")
        if timestamp_format and isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            conv = (F.try_to_timestamp(col, F.lit(timestamp_format)) if safe
                    else F.to_timestamp(col, timestamp_format))
            if isinstance(dt, T.TimestampNTZType):
                conv = conv.cast(dt)
        elif timestamp_format and isinstance(dt, T.DateType):
            conv = F.to_date(col, timestamp_format)
        else:
            conv = col.try_cast(dt) if safe else col.cast(dt)
        out.append(conv.alias(c))
    return df.select(*out)


# --- B4 / B5 / B6 -----------------------------------------------------------
def where_equal(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """Conjunctive equality filter; values are bound as literals."""
    cond = F.lit(True)
    for c, v in conditions.items():
        cond = cond & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
    return df.filter(cond)


def where_in(df: DataFrame, col: str, values, negate: bool = False) -> DataFrame:
    """IN / NOT IN.  ``values`` is a literal list (kept in the plan and
    pushed to the scan) or a one-column DataFrame (semi / anti join, for
    lists that grow with the data)."""
    if isinstance(values, DataFrame):
        other = values.select(F.col(values.columns[0]).alias("_in_key")).distinct()
        cond = F.col(col) == F.col("_in_key")
        how = "left_anti" if negate else "left_semi"
        if negate:
            # NOT IN over a key column: NULL keys never qualify
            return df.filter(F.col(col).isNotNull()).join(other, cond, how)
        return df.join(other, cond, how)
    values = list(values)
    cond = F.col(col).isin(values)
    return df.filter(~cond if negate else cond)


def is_absent(df: DataFrame, predicate: Column, name: str = "absent") -> DataFrame:
    """One-row frame: True when no row satisfies ``predicate``.  Spark
    stops the scan early when used with ``isEmpty``; as a frame it is a
    ``count_if`` that combines map-side."""
    return df.agg((F.count_if(predicate) == 0).alias(name))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


# --- B7 / B8 ----------------------------------------------------------------
def clip_to_span(df: DataFrame, ts: str, other: DataFrame, other_ts: str) -> DataFrame:
    """Keep rows of ``df`` whose ``ts`` lies within [min, max] of
    ``other.other_ts`` (both ends inclusive).  The bounds are scalar
    subqueries, evaluated once."""
    span = other.select(F.struct(F.min(other_ts).alias("lo"), F.max(other_ts).alias("hi"))).scalar()
    return (df.withColumn("_span", span)
            .filter(F.col(ts).between(F.col("_span.lo"), F.col("_span.hi"))).drop("_span"))


def split_at(df: DataFrame, ts: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """Half-open split: ``ts < cutoff`` and ``ts >= cutoff`` (the cutoff row
    lands only in the second part)."""
    c = F.lit(cutoff)
    return df.filter(F.col(ts) < c), df.filter(F.col(ts) >= c)


def window_before(df: DataFrame, ts: str, cutoff, months: int = 2) -> DataFrame:
    """Rows from ``cutoff - months`` (inclusive) up to ``cutoff`` (exclusive)."""
    c = F.lit(cutoff).cast("timestamp_ntz")
    start = F.add_months(c, -months).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= start) & (F.col(ts) < c))


# --- B9 / B10 ---------------------------------------------------------------
def price_area(region: Column | str, dk2: Sequence[str] = DK2_REGIONS) -> Column:
    """'DK2' for the listed regions, else 'DK1' (a NULL region is DK1)."""
    r = F.col(region) if isinstance(region, str) else region
    return F.when(r.isin(list(dk2)), F.lit("DK2")).otherwise(F.lit("DK1"))


def update_where(df: DataFrame, cond: Column, col: str, value) -> DataFrame:
    """Masked update: ``col = value`` where ``cond`` holds."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(cond, v).otherwise(F.col(col)))


# --- B11 --------------------------------------------------------------------
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def measure_columns(df: DataFrame, ids: Sequence[str] = (), ignore: Sequence[str] = ()) -> list[str]:
    """Numeric columns in schema order, minus ids and ignored codes."""
    skip = set(ids) | set(ignore)
    return [f.name for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, _NUMERIC)]


def measures_long(df: DataFrame, ids: Sequence[str], ignore: Sequence[str] = (),
                  var_name: str = "measure", value_name: str = "value") -> DataFrame:
    """All measure columns as (ids..., measure, value) rows."""
    cols = measure_columns(df, ids, ignore)
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(list(ids), cols, var_name, value_name)


# --- B12 / B13 --------------------------------------------------------------
def lookup(df: DataFrame, key_cols: Mapping[str, object], order: Sequence[str]) -> DataFrame:
    """First row matching exact key values (deterministic by ``order``)."""
    return where_equal(df, key_cols).orderBy(*order).limit(1)


def lookup_many(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Lookup for a frame of keys: a semi join (Spark broadcasts ``keys``
    when its runtime size is small)."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def attach_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})
