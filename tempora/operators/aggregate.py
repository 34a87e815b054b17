"""Aggregation and reshaping (E1-E18).

All aggregates are plain ``groupBy().agg`` plans, so Spark combines map-side
before the shuffle and a hot key costs one row per map task.  Whole-frame
statistics are attached to rows as scalar subqueries (``DataFrame.scalar``),
which Spark evaluates once; no frame is joined against all rows.
Exact order statistics (median, trimmed mean, median absolute deviation)
count each value once and rank the counted values through a range-partitioned
sort, so neither a large group nor a value that many rows share is held by
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.session import cut_lineage

# Fixed values of the reference: the aggregates offered by the summary page
# and the scale factor of the median absolute deviation under normality.
AGGS = {
    "mean": F.avg,
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "median": F.median,
    "count": F.count,
    "std": F.stddev_samp,
}
MAD_NORMAL_SCALE = 1.4826


def _cols(by) -> list[str]:
    if by is None:
        return []
    if isinstance(by, str):
        return [by]
    return list(by)


def _not_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


# --- E1 ---------------------------------------------------------------------
def group_sum(df: DataFrame, by, col: str, alias: str | None = None) -> DataFrame:
    """Sum ``col`` per group with pandas semantics: an all-missing group sums
    to 0 and rows with a missing key are dropped."""
    keys = _cols(by)
    return (_not_null_keys(df, keys).groupBy(*keys)
            .agg(F.coalesce(F.sum(col), F.lit(0.0)).alias(alias or col)))


# --- E2 ---------------------------------------------------------------------
def group_agg(df: DataFrame, group_col: str, agg: str, response: str,
              allowed: Sequence[str] | None = None) -> DataFrame:
    """One aggregate of ``response`` per ``group_col`` value, named
    ``{agg}_{response}`` and sorted by it descending."""
    if allowed is not None and group_col not in allowed:
        raise KeyError(group_col)
    if agg not in AGGS:
        raise KeyError(agg)
    name = f"{agg}_{response}"
    data = _not_null_keys(df, [group_col])
    if agg == "median":
        # exact and skew-safe: weighted ranks of the distinct values, no value map per group
        out = _median(counted(data, [group_col], response), [group_col], response, name)
        groups = data.select(group_col).distinct()
        out = groups.join(out, [group_col], "left")
    else:
        out = data.groupBy(group_col).agg(AGGS[agg](response).alias(name))
    return out.orderBy(F.col(name).desc_nulls_last(), F.col(group_col))


# --- E3 ---------------------------------------------------------------------
def grouped_sum(df: DataFrame, main: str, response: str,
                opposite: dict[str, str] | None = None, sub: str | None = None) -> DataFrame:
    """Two-level sum (main x sub).  ``opposite`` maps a main group to its
    automatic sub group (municipality <-> industry in the reference)."""
    if sub is None:
        if not opposite or main not in opposite:
            raise KeyError(main)
        sub = opposite[main]
    return (_not_null_keys(df, [main, sub]).groupBy(main, sub)
            .agg(F.coalesce(F.sum(response), F.lit(0.0)).alias(f"sum_{response}")))


# --- E4 ---------------------------------------------------------------------
def mean_std(df: DataFrame, col: str, by=None) -> DataFrame:
    """Mean and sample standard deviation (ddof=1)."""
    keys = _cols(by)
    return df.groupBy(*keys).agg(F.avg(col).alias("mean"),
                                 F.stddev_samp(col).alias("std"))


# --- exact ranks without one-task windows -------------------------------------
def counted(df: DataFrame, by, col: str, weight: str | None = None) -> DataFrame:
    """(group..., value, _w): each value of ``col`` once per group, with the number of its rows (nulls removed)."""
    keys = _cols(by)
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(n.alias("_w"))


def weighted_ranks(values: DataFrame, by, col: str, num_partitions: int | None = None) -> DataFrame:
    """Add to a :func:`counted` table the ranks of each value's rows in its group, ``_before`` + 1 to ``_upto``,
    and the group's number of rows ``_n``.

    Equal values are one row, however many rows they stand for, so a value that a third of all rows share
    fills no task.  The values are range-partitioned on (group, value): a group larger than one partition is
    cut into slices held by different tasks.  Each slice adds up its counts; its offset comes from a running
    sum over the (slice, group) totals, at most partitions x groups rows.
    """
    keys = _cols(by)
    n = num_partitions or int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds come from sampling and differ between evaluations, so the slice assignment is checkpointed
    # once; both branches below (and any recomputation after a lost executor) then read the same slices.
    ranged = cut_lineage(values.repartitionByRange(n, *[F.col(k) for k in keys], F.col(col))
                         .withColumn("_slice", F.spark_partition_id()))
    totals = ranged.groupBy(*keys, "_slice").agg(F.sum("_w").alias("_sum"))
    group = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys, "_slice", F.sum("_sum").over(group).alias("_n"),
        F.coalesce(F.sum("_sum").over(group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    inside = F.sum("_w").over(Window.partitionBy(*keys, "_slice").orderBy(F.col(col))
                              .rowsBetween(Window.unboundedPreceding, 0))
    return (ranged.withColumn("_in", inside).join(offsets, [*keys, "_slice"])
            .withColumn("_upto", F.col("_off") + F.col("_in"))
            .withColumn("_before", F.col("_upto") - F.col("_w"))
            .drop("_slice", "_off", "_in"))


def _median(values: DataFrame, keys, col: str, alias: str = "median") -> DataFrame:
    """Median (mean of the two middle rows for even sizes) per group of a :func:`counted` table."""
    ranked = weighted_ranks(values, keys, col)
    holds = lambda r: ((F.col("_before") < r) & (r <= F.col("_upto"))).cast("int")
    middle = holds(F.floor((F.col("_n") + 1) / 2)) + holds(F.floor(F.col("_n") / 2) + 1)
    return (ranked.withColumn("_m", middle).filter("_m > 0").groupBy(*keys)
            .agg((F.sum(F.col(col) * F.col("_m")) / 2).alias(alias)))


# --- E5 ---------------------------------------------------------------------
def trimmed_mean(df: DataFrame, col: str, p: float, by=None) -> DataFrame:
    """Mean after cutting ``floor(p*n)`` values from each end (scipy
    ``trim_mean``), exact, per group or over the frame."""
    keys = _cols(by)
    ranked = weighted_ranks(counted(df, keys, col), keys, col)
    g = F.floor(F.col("_n") * F.lit(p))
    # rows of this value that neither end takes away
    kept = F.greatest(F.lit(0), F.least("_upto", F.col("_n") - g) - F.greatest("_before", g))
    return (ranked.withColumn("_k", kept).filter("_k > 0").groupBy(*keys)
            .agg((F.sum(F.col(col) * F.col("_k")) / F.sum("_k")).alias("trimmed_mean")))


# --- E6 ---------------------------------------------------------------------
def mad(df: DataFrame, col: str, by=None, scale: float = MAD_NORMAL_SCALE,
        approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Median absolute deviation, raw (``mad``) and scaled (``mad_scaled``).

    Exact by default (two passes over weighted ranks; the second one starts
    from the counted values of the first); ``approx=True`` uses
    ``percentile_approx`` for both medians instead.
    """
    keys = _cols(by)
    values = df.select(*keys, col).filter(F.col(col).isNotNull())
    if approx:
        med = values.groupBy(*keys).agg(F.percentile_approx(col, 0.5, accuracy).alias("_med"))
    else:
        values = cut_lineage(counted(values, keys, col))
        med = _median(values, keys, col, "_med")
    dev = (values.join(med, keys) if keys else
           values.withColumn("_med", med.select("_med").scalar()))
    dev = dev.withColumn("_dev", F.abs(F.col(col) - F.col("_med")))
    if approx:
        out = dev.groupBy(*keys).agg(F.percentile_approx("_dev", 0.5, accuracy).alias("mad"))
    else:
        out = _median(counted(dev, keys, "_dev", "_w"), keys, "_dev", "mad")
    return out.withColumn("mad_scaled", F.col("mad") * F.lit(scale))


# --- E7 ---------------------------------------------------------------------
def spc_limits(df: DataFrame, col: str, k: float = 3.0, robust: bool = False,
               p: float = 0.05, by=None) -> DataFrame:
    """Centre, spread and the +-1, +-2, +-k bands of ``col``.

    ``robust=True`` takes the trimmed mean (E5) as centre and the scaled
    MAD (E6) as spread.
    """
    keys = _cols(by)
    if robust:
        centre = trimmed_mean(df, col, p, keys).withColumnRenamed("trimmed_mean", "centre")
        spread = mad(df, col, keys).select(*keys, F.col("mad_scaled").alias("spread"))
        stats = centre.join(spread, keys) if keys else centre.select(
            "centre", F.lit(spread.select("spread").scalar()).alias("spread"))
    else:
        stats = mean_std(df, col, keys).withColumnRenamed("mean", "centre") \
            .withColumnRenamed("std", "spread")
    out = stats
    for m in (1, 2):
        out = (out.withColumn(f"lower_{m}", F.col("centre") - m * F.col("spread"))
               .withColumn(f"upper_{m}", F.col("centre") + m * F.col("spread")))
    return (out.withColumn("lower", F.col("centre") - F.lit(k) * F.col("spread"))
            .withColumn("upper", F.col("centre") + F.lit(k) * F.col("spread")))


def flag_outliers(df: DataFrame, col: str, k: float = 3.0, robust: bool = False,
                  p: float = 0.05, by=None, flag: str = "is_outlier") -> DataFrame:
    """Flag rows outside ``centre +- k*spread`` (limits from :func:`spc_limits`)."""
    keys = _cols(by)
    limits = spc_limits(df, col, k, robust, p, keys).select(*keys, "lower", "upper")
    if keys:
        joined = df.join(limits, keys, "left")
    else:
        joined = (df.withColumn("_lim", limits.select(F.struct("lower", "upper")).scalar())
                  .withColumn("lower", F.col("_lim.lower")).withColumn("upper", F.col("_lim.upper"))
                  .drop("_lim"))
    x = F.col(col)
    return (joined.withColumn(flag, (x < F.col("lower")) | (x > F.col("upper")))
            .drop("lower", "upper"))


# --- E8 / E9 / E10 ----------------------------------------------------------
def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: number and share of missing values; only columns with any.

    One pass: a single aggregate computes every count, then ``unpivot``.
    The share is a fraction of the row count.
    """
    cols = list(cols or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot("_rows", cols, "column", "n_missing")
    return (long.filter(F.col("n_missing") > 0)
            .select("column", "n_missing",
                    (F.col("n_missing") / F.col("_rows")).alias("share_missing")))


def null_profile_by(df: DataFrame, key, cols: Sequence[str] | None = None,
                    keep_zero: bool = False) -> DataFrame:
    """Missing counts per group and column (wide), plus the group's rows.

    Groups without any missing value are dropped unless ``keep_zero``.
    """
    keys = _cols(key)
    cols = [c for c in (cols or df.columns) if c not in keys]
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"),
                                *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    if not keep_zero and cols:
        out = out.filter(F.greatest(*[F.col(c) for c in cols]) > 0) if len(cols) > 1 \
            else out.filter(F.col(cols[0]) > 0)
    return out


def fully_missing(df: DataFrame, key, cols: Sequence[str],
                  expected_len: int | None = None) -> DataFrame:
    """Per column, the number of groups where it is missing on every row.

    The reference compares with a fixed 8760 hours; here the group's own row
    count is used unless ``expected_len`` is given.
    """
    prof = null_profile_by(df, key, cols, keep_zero=True)
    full = F.col("n_rows") if expected_len is None else F.lit(expected_len)
    agg = prof.agg(*[F.count_if(F.col(c) == full).alias(c) for c in cols])
    return agg.unpivot([], list(cols), "column", "n_groups")


# --- E11 - E15 --------------------------------------------------------------
def distinct_keys(df: DataFrame, keys) -> DataFrame:
    return df.select(*_cols(keys)).distinct()


def pick_random(df: DataFrame, key: str, seed: int, n: int = 1) -> DataFrame:
    """Repeatable random choice of ``n`` distinct key values: the keys are
    ordered by the MD5 of seed and key, so the choice does not depend on
    partitioning and any SQL engine can repeat it."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return (keys.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
            .orderBy("_h", key).limit(n).drop("_h"))


def extremes(df: DataFrame, col: str, by=None) -> DataFrame:
    keys = _cols(by)
    return df.groupBy(*keys).agg(F.min(col).alias("min"), F.max(col).alias("max"),
                                 F.max(F.abs(col)).alias("max_abs"))


def shape(df: DataFrame) -> DataFrame:
    """Row and column count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")) \
        .withColumn("n_cols", F.lit(len(df.columns)))


def mean_point(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Mean coordinate (map centre)."""
    return df.agg(F.avg(lat).alias("lat"), F.avg(lon).alias("lon"))


# --- E16 / E17 --------------------------------------------------------------
DUP_AGGS = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min}


MAX_PIVOT_COLUMNS = 1000


def pivot_keys(df: DataFrame, key: str, max_columns: int = MAX_PIVOT_COLUMNS) -> tuple[list, bool]:
    """The key values a pivot makes columns of, sorted, and whether that is all of them: with more than
    ``max_columns`` it is those with most rows (ties to the smaller)."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count().orderBy(F.desc("count"), F.asc(key))
    found = [r[0] for r in counts.limit(max_columns + 1).collect()]
    return sorted(found[:max_columns]), len(found) <= max_columns


def pivot_wide(df: DataFrame, ts: str, key: str, value: str, values: Sequence | None = None,
               dup_agg: str = "mean", drop_empty: bool = False, max_columns: int = MAX_PIVOT_COLUMNS,
               rest: str = "other") -> DataFrame:
    """Long to wide: one column per key value, duplicates combined with
    ``dup_agg``.  Pivot columns are named after the values as strings.

    With ``values`` given, Spark runs no job for them and the schema is fixed.  Without, a first pass over
    the keys finds them: at most ``max_columns`` become columns, those with most rows.  Where there are
    more, the remaining ones are in a last column ``rest``, a map from key (as string) to value, so that
    nothing is dropped and the table's width is bounded.
    """
    agg = DUP_AGGS[dup_agg]
    data = df.filter(F.col(key).isNotNull())
    whole = True
    if values is None:
        values, whole = pivot_keys(df, key, max_columns)
    values = list(values)
    if whole:
        out = data.groupBy(ts).pivot(key, values).agg(agg(value)) if values else data.select(ts).distinct()
    else:
        cells = data.groupBy(ts, key).agg(agg(value).alias("_v"))
        cols = [F.max(F.when(F.col(key) == F.lit(v), F.col("_v"))).alias(str(v)) for v in values]
        entry = F.when(~F.col(key).isin(values), F.struct(F.col(key).cast("string"), F.col("_v")))
        out = cells.groupBy(ts).agg(*cols, F.map_from_entries(F.collect_list(entry)).alias(rest))
    if drop_empty:
        # pandas drops columns without any value; that needs one count job
        counts = out.agg(*[F.count(F.col(f"`{v}`")).alias(str(v)) for v in values]).first()
        out = out.drop(*[str(v) for v in values if counts[str(v)] == 0])
    return out


def melt(df: DataFrame, ids, values: Sequence[str] | None = None,
         var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide to long, NULL cells kept (as pandas ``melt``)."""
    ids = _cols(ids)
    values = list(values or [c for c in df.columns if c not in ids])
    return df.unpivot(ids, values, var_name, value_name)


# --- E18 --------------------------------------------------------------------
DAILY_AGGS = {"sum", "mean", "min", "max", "count"}


def _daily_value(agg: str, v: Column) -> Column:
    if agg == "sum":
        return F.sum(v)
    if agg == "mean":
        return F.avg(v)
    if agg == "count":
        return F.count(v)
    return F.min(v) if agg == "min" else F.max(v)


def resample_ranges(df: DataFrame, ts: str, value: str, by=None, agg: str = "sum",
                    dup_agg: str | None = None, spine: str = "frame",
                    value_col: str | None = None) -> DataFrame:
    """Daily resample with every gap as one row: (key..., first_day, last_day, value).

    A day with rows is a range of its own; the days between two of them, and with ``spine="frame"`` those
    before the first and after the last, are one range whose value is that of a gap day.  So a sparse key
    costs rows in proportion to its days with data, not to the span.  Parameters as in
    :func:`resample_daily`; :func:`expand_ranges` gives its rows.

    The raw rows are reduced to (key, day) first (map-side partial aggregation); neighbours are found with a
    window over a key's days.
    """
    if agg not in DAILY_AGGS:
        raise KeyError(agg)
    if spine not in ("frame", "key"):
        raise ValueError(spine)
    keys = _cols(by)
    out_col = value_col or value
    base = _not_null_keys(df.select(*keys, F.col(ts).alias("_ts"), F.col(value).alias("_v")), keys)
    if dup_agg:
        base = base.groupBy(*keys, "_ts").agg(DUP_AGGS[dup_agg]("_v").alias("_v"))
    daily = (base.groupBy(*keys, F.to_date("_ts").alias("_day"))
             .agg(_daily_value(agg, F.col("_v")).alias("_d"), F.count("_v").alias("_nv"))
             .filter(F.col("_day").isNotNull()))
    own = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    if spine == "frame":
        span = daily.filter(F.col("_nv") > 0).select(F.struct(F.min("_day").alias("lo"), F.max("_day").alias("hi")))
        daily = (daily.withColumn("_span", span.scalar()).filter(F.col("_day").between(F.col("_span.lo"), F.col("_span.hi")))
                 .withColumn("_any", F.max("_nv").over(own)).filter(F.col("_any") > 0))
        lo, hi = F.col("_span.lo"), F.col("_span.hi")
    else:
        lo = hi = F.lit(None).cast("date")
    v = F.col("_d")
    if agg in ("sum", "count"):
        v = F.coalesce(v, F.lit(0.0) if agg == "sum" else F.lit(0))
    gap = F.lit(None) if agg not in ("sum", "count") else (F.lit(0.0) if agg == "sum" else F.lit(0))
    of = lambda a, b, x: F.struct(a.alias("first_day"), b.alias("last_day"),
                                  x.cast(value_type).alias("value"))
    value_type = daily.select(v).schema[0].dataType
    day, order = F.col("_day"), own.orderBy("_day")
    nearby = daily.withColumn("_prev", F.lag("_day").over(order)).withColumn("_next", F.lead("_day").over(order))
    upto = F.coalesce(F.col("_next"), F.date_add(hi, 1))
    ranges = F.array(F.when(F.col("_prev").isNull() & (day > lo), of(lo, F.date_sub(day, 1), gap)),
                     of(day, day, v),
                     F.when(upto > F.date_add(day, 1), of(F.date_add(day, 1), F.date_sub(upto, 1), gap)))
    return (nearby.select(*keys, F.explode(F.filter(ranges, lambda r: r.isNotNull())).alias("_r"))
            .select(*keys, "_r.first_day", "_r.last_day", F.col("_r.value").alias(out_col)))


def expand_ranges(ranges: DataFrame, day_col: str = "day") -> DataFrame:
    """One row per day of each range of :func:`resample_ranges`."""
    rest = [c for c in ranges.columns if c not in ("first_day", "last_day")]
    return ranges.select(*rest[:-1], F.explode(F.sequence("first_day", "last_day")).alias(day_col), rest[-1])


def resample_daily(df: DataFrame, ts: str, value: str, by=None, agg: str = "sum",
                   dup_agg: str | None = None, spine: str = "frame",
                   day_col: str = "day", value_col: str | None = None) -> DataFrame:
    """Daily resample with the gap days made explicit.

    * ``agg``: ``sum`` (a gap day is 0), ``mean`` / ``min`` / ``max`` (a gap
      day is NULL) or ``count`` (0).
    * ``dup_agg``: combine rows sharing (key, timestamp) first, as a pandas
      pivot table does (``mean`` by default there).
    * ``spine="frame"``: every key gets every day between the first and last
      day holding a value anywhere in the frame; keys without any value are
      dropped (pivot form).  ``spine="key"``: each key gets the days between
      its own first and last row (grouped form).

    Plan: the raw rows are reduced to (key, day) first (map-side partial
    aggregation), the spine is generated per key with ``sequence`` and
    ``explode`` from the bounds, and the daily rows are joined onto it.
    Where few days have data, :func:`resample_ranges` spares the spine; it
    gives the same rows when expanded.
    """
    if agg not in DAILY_AGGS:
        raise KeyError(agg)
    keys = _cols(by)
    out_col = value_col or value
    base = _not_null_keys(df.select(*keys, F.col(ts).alias("_ts"), F.col(value).alias("_v")), keys)
    if dup_agg:
        base = base.groupBy(*keys, "_ts").agg(DUP_AGGS[dup_agg]("_v").alias("_v"))
    daily = (base.groupBy(*keys, F.to_date("_ts").alias(day_col))
             .agg(_daily_value(agg, F.col("_v")).alias("_d"),
                  F.count("_v").alias("_nv")))
    if spine == "frame":
        valued = daily.filter(F.col("_nv") > 0)
        if keys:
            span = valued.select(F.struct(F.min(day_col).alias("lo"), F.max(day_col).alias("hi"))).scalar()
            bounds = (valued.select(*keys).distinct().withColumn("_span", span)
                      .select(*keys, F.col("_span.lo").alias("_lo"), F.col("_span.hi").alias("_hi")))
        else:
            bounds = valued.agg(F.min(day_col).alias("_lo"), F.max(day_col).alias("_hi"))
    elif spine == "key":
        bounds = daily.groupBy(*keys).agg(F.min(day_col).alias("_lo"), F.max(day_col).alias("_hi"))
    else:
        raise ValueError(spine)
    days = bounds.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(day_col))
    filled = days.join(daily, [*keys, day_col], "left")
    v = F.col("_d")
    if agg in ("sum", "count"):
        v = F.coalesce(v, F.lit(0.0) if agg == "sum" else F.lit(0))
    return filled.select(*keys, day_col, v.alias(out_col))
