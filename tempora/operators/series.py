"""Skew-safe building blocks for per-series windows.

A window ``partitionBy(series)`` sends a whole series to one task; with one
series holding a third of the data that task is the job.  The operators in
``timeseries`` therefore work on chunks of a series:

* :func:`with_position` numbers the rows of every series 0..n-1.  Rows are
  ranked inside (series, time bucket) and each bucket's offset comes from a
  running sum over the small (series, bucket) count table.  Buckets that
  hold very many rows are split by finer digits of the time.
* :func:`halo` cuts a series into chunks of ``chunk_rows`` positions and
  copies the few rows a bounded frame needs from the neighbouring chunks,
  so ``rowsBetween(-before, after)`` over (series, chunk) equals the frame
  over the whole series.
* :func:`carry` finds, for every row, the last (or next) non-NULL value of
  a column: inside the chunk with a window, across chunks from a running
  ``last``/``first`` over the per-chunk summary table.

Per-chunk windows run in parallel; the only series-wide windows run over
summary tables with one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.session import cut_lineage

DEFAULT_CHUNK_ROWS = 1 << 16
UNB_PREC = Window.unboundedPreceding
UNB_FOLL = Window.unboundedFollowing


def keys_of(by) -> list[str]:
    if by is None:
        return []
    if isinstance(by, str):
        return [by]
    return list(by)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL keys as equal (series keys may be NULL)."""
    if not keys:
        raise ValueError("no join keys")
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


NUMERIC_BUCKET = 1 << 16
# rows of one series in one bucket beyond which buckets are split, and the size of an input (as Spark estimates
# it) that no bucket needs splitting for: one task can take it all
DENSE_ROWS = 1 << 20
SMALL_BYTES = 128 << 20


def default_bucket(df: DataFrame, col: str) -> Column:
    """A coarse bucket of an order column: the day of a time (the month of a
    date), a block of ``NUMERIC_BUCKET`` values of a number, one bucket
    otherwise."""
    t = df.schema[col].dataType.typeName()
    if t in ("timestamp", "timestamp_ntz"):
        return F.date_trunc("day", F.col(col))
    if t == "date":
        return F.date_trunc("month", F.col(col))
    if t in ("long", "integer", "short", "byte", "double", "float", "decimal"):
        return F.floor(F.col(col) / NUMERIC_BUCKET)
    return F.lit(0)


def finer_buckets(df: DataFrame, col: str) -> list[Column]:
    """Order-compatible parts of a bucket of :func:`default_bucket`, each with a bounded number of values: the
    second of the day and its microsecond for a time, the day of the month for a date, 2**22 parts of a block
    of numbers; none for other types."""
    t = df.schema[col].dataType.typeName()
    c = F.col(col)
    if t in ("timestamp", "timestamp_ntz"):
        micros = F.expr(f"cast(extract(second from `{col}`) * 1000000 as long)")
        return [F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(micros / 1000000), micros % 1000000]
    if t == "date":
        return [F.dayofmonth(c)]
    if t in ("long", "integer", "short", "byte", "double", "float", "decimal"):
        return [F.floor((c - F.floor(c / NUMERIC_BUCKET) * NUMERIC_BUCKET) * 64)]
    return []


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def with_position(df: DataFrame, by, order: Sequence[str], pos: str = "_pos",
                  bucket: Column | None = None, balanced: bool = False,
                  dense_rows: int | None = None) -> DataFrame:
    """Add the 0-based row position of each row within its series.

    ``order`` must be a total order within a series (add a tie-break).  Rows are ranked inside (series,
    bucket); the bucket is a coarse, order-compatible expression (default: see :func:`default_bucket`).
    Where a series has more than ``dense_rows`` rows in a bucket, which a count per (series, bucket) tells,
    buckets are split by finer digits of the order column (:func:`finer_buckets`) and counted again.  The
    offsets are running sums level by level, each over the bounded number of parts of one bucket, so a
    series-day with a third of all rows is as many groups as it has seconds.  The count is spared for inputs
    that are small as a whole.

    A ``bucket`` of one's own is used as it is.  ``balanced`` cuts by row counts instead, for order columns
    without digits (strings): rows are range-partitioned on (series, order), which costs a sort of the keys
    and a checkpoint, as range bounds are sampled and have to be the same for both uses below.
    """
    keys = keys_of(by)
    order = list(order)
    if balanced:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        d, levels = cut_lineage(df.repartitionByRange(n, *keys, *order).withColumn("_b0", F.spark_partition_id())), ["_b0"]
    elif bucket is not None:
        d, levels = df.withColumn("_b0", bucket), ["_b0"]
    else:
        d, levels = df.withColumn("_b0", default_bucket(df, order[0])), ["_b0"]
        if _estimated_bytes(df) > SMALL_BYTES:
            most = DENSE_ROWS if dense_rows is None else dense_rows
            for part in finer_buckets(df, order[0]):
                if d.groupBy(*keys, *levels).count().where(F.col("count") > most).isEmpty():
                    break
                levels.append(f"_b{len(levels)}")
                d = d.withColumn(levels[-1], part)
    d = d.withColumn("_rin", F.row_number().over(Window.partitionBy(*keys, *levels).orderBy(*order)) - 1)
    counts = d.groupBy(*keys, *levels).agg(F.count(F.lit(1)).alias("_bc"))
    offs = None
    while levels:
        outer = [*keys, *levels[:-1]]
        before = F.coalesce(F.sum("_bc").over(Window.partitionBy(*outer).orderBy(levels[-1]).rowsBetween(UNB_PREC, -1)),
                            F.lit(0))
        here = counts.select(*outer, levels[-1], before.alias("_boff"))
        if offs is None:
            offs, all_levels = here, list(levels)
        else:
            offs = join_on(offs, here.withColumnRenamed("_boff", "_more"), [*outer, levels[-1]]) \
                .withColumn("_boff", F.col("_boff") + F.col("_more")).drop("_more")
        levels = levels[:-1]
        if levels:
            counts = counts.groupBy(*keys, *levels).agg(F.sum("_bc").alias("_bc"))
    return (join_on(d, offs, [*keys, *all_levels])
            .withColumn(pos, F.col("_boff") + F.col("_rin"))
            .drop("_rin", "_boff", *all_levels))


def epoch_seconds(df: DataFrame, col: str) -> Column:
    """Seconds since 1970-01-01 without passing through the session time
    zone for dates and zone-less timestamps (a DST shift would otherwise
    make a day 23 or 25 hours long)."""
    t = df.schema[col].dataType.typeName()
    c = F.col(col)
    if t == "date":
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long") * 86400
    if t == "timestamp_ntz":
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_timestamp(c)


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch, zone-free like :func:`epoch_seconds`."""
    t = df.schema[col].dataType.typeName()
    c = F.col(col)
    if t == "date":
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long") * 86400000000
    if t == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_micros(c)


def grid_position(df: DataFrame, by, ts: str, step_seconds: int = 86400,
                  pos: str = "_pos") -> DataFrame:
    """Position on a regular time grid: ``(ts - first ts of the series) /
    step``.  For dense series (e.g. after ``resample_daily``) this equals
    the row position and needs only a per-series ``min``."""
    keys = keys_of(by)
    secs = epoch_seconds(df, ts)
    if keys:
        first = df.groupBy(*keys).agg(F.min(secs).alias("_t0"))
        d = join_on(df, first, keys)
    else:
        d = df.withColumn("_t0", df.select(F.min(secs)).scalar())
    return d.withColumn(pos, ((secs - F.col("_t0")) / F.lit(step_seconds)).cast("long")).drop("_t0")


def halo(df: DataFrame, by, pos: str, before: int, after: int,
         chunk_rows: int = DEFAULT_CHUNK_ROWS):
    """Expand ``df`` into overlapping chunks.

    Returns ``(frame, window)``: ``frame`` has ``_chunk`` and ``_home`` (True
    for the row's own chunk) and ``window`` is ``partitionBy(series,
    _chunk).orderBy(pos)``.  Evaluate window functions with a frame inside
    ``rowsBetween(-before, after)``, then keep ``_home`` rows.
    """
    keys = keys_of(by)
    L = int(chunk_rows)
    if before > L or after > L:
        raise ValueError("window wider than a chunk")
    p = F.col(pos)
    c = F.floor(p / L)
    r = p - c * L
    copies = F.array(
        F.struct(c.alias("c"), F.lit(True).alias("h")),
        F.when(F.lit(before > 0) & (r >= L - before), F.struct((c + 1).alias("c"), F.lit(False).alias("h"))),
        F.when(F.lit(after > 0) & (r < after), F.struct((c - 1).alias("c"), F.lit(False).alias("h"))),
    )
    out = (df.withColumn("_cp", F.explode(F.filter(copies, lambda x: x.isNotNull())))
           .withColumn("_chunk", F.col("_cp.c")).withColumn("_home", F.col("_cp.h")).drop("_cp"))
    return out, Window.partitionBy(*keys, "_chunk").orderBy(pos)


def carry(df: DataFrame, by, pos: str, items: dict[str, Column], forward: bool = True,
          chunk: Column | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS,
          backward_items: dict[str, Column] | None = None) -> DataFrame:
    """For each name -> struct expression in ``items`` add column ``name``:
    the nearest non-NULL struct at or before the row (``forward``) or at or
    after it, within the series ordered by ``pos``.  ``backward_items`` adds
    after-the-row look-ups in the same pass (shared partitioning and
    summary) when ``forward`` is True.

    Structs should start with the position so that max/min pick the
    nearest one.
    """
    keys = keys_of(by)
    fwd = dict(items) if forward else {}
    bwd = dict(backward_items or {}) if forward else dict(items)
    allitems = {**fwd, **bwd}
    ch = chunk if chunk is not None else F.floor(F.col(pos) / int(chunk_rows))
    d = df.withColumn("_ch", ch)
    d = d.withColumns({f"_s_{n}": s for n, s in allitems.items()})
    w = Window.partitionBy(*keys, "_ch").orderBy(pos)
    inner = {n: F.last(f"_s_{n}", ignorenulls=True).over(w.rowsBetween(UNB_PREC, 0)) for n in fwd}
    inner.update({n: F.first(f"_s_{n}", ignorenulls=True).over(w.rowsBetween(0, UNB_FOLL)) for n in bwd})
    summ = d.groupBy(*keys, "_ch").agg(*[F.max(f"_s_{n}").alias(f"_e_{n}") for n in fwd],
                                       *[F.min(f"_s_{n}").alias(f"_e_{n}") for n in bwd])
    ws = Window.partitionBy(*keys).orderBy("_ch")
    summ = summ.select(*keys, "_ch",
                       *[F.last(f"_e_{n}", ignorenulls=True).over(ws.rowsBetween(UNB_PREC, -1)).alias(f"_x_{n}")
                         for n in fwd],
                       *[F.first(f"_e_{n}", ignorenulls=True).over(ws.rowsBetween(1, UNB_FOLL)).alias(f"_x_{n}")
                         for n in bwd])
    d = d.withColumns({f"_i_{n}": e for n, e in inner.items()})
    d = join_on(d, summ, [*keys, "_ch"], "left")
    d = d.withColumns({n: F.coalesce(F.col(f"_i_{n}"), F.col(f"_x_{n}")) for n in allitems})
    drop = ["_ch"] + [f"_{p}_{n}" for n in allitems for p in ("s", "i", "x")]
    return d.drop(*drop)
