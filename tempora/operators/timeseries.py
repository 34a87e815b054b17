"""Window and time-series operators (F1-F15).

Series are identified by ``by`` (zero or more key columns) and ordered by
``order`` (a total order, e.g. ``[ts, id]``).  Every operator returns the
input rows with added or replaced columns.  Windows never span a whole
series: bounded frames run per chunk with a halo, unbounded look-ups
(back-fill, interpolation) carry values across chunks through a per-chunk
summary (see :mod:`tempora.operators.series`).  Positions are row based,
as in pandas; ``pos`` may name an existing 0..n-1 position column (e.g.
from :func:`grid_position` on a dense daily series) to skip numbering.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.operators.series import (DEFAULT_CHUNK_ROWS, carry, epoch_micros, halo, join_on,
                                      keys_of, with_position)
from tempora.session import cut_lineage

_POS = "_pos"


def _positioned(df: DataFrame, by, order, pos: str | None):
    if pos:
        return df, pos, False
    return with_position(df, by, order, _POS), _POS, True


def _finish(df: DataFrame, pos: str, added: bool) -> DataFrame:
    return df.drop(pos) if added else df


# --- F1 / F2 ----------------------------------------------------------------
def rolling_mean(df: DataFrame, by, order: Sequence[str], col: str, window: int = 3,
                 min_periods: int = 1, out: str | None = None, pos: str | None = None,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Trailing mean over the last ``window`` rows (missing values skipped);
    NULL when fewer than ``min_periods`` values are present."""
    out = out or f"{col}_rolling"
    d, p, added = _positioned(df, by, order, pos)
    x, w = halo(d, by, p, window - 1, 0, chunk_rows)
    frame = w.rowsBetween(-(window - 1), 0)
    x = x.withColumn(out, F.when(F.count(col).over(frame) >= min_periods, F.avg(col).over(frame)))
    x = x.filter("_home").drop("_chunk", "_home")
    return _finish(x, p, added)


def impute_rolling(df: DataFrame, by, order: Sequence[str], col: str, window: int = 3,
                   min_periods: int = 1, pos: str | None = None,
                   chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Fill missing values with the trailing rolling mean of the original
    column (not recursive: a gap longer than the window stays)."""
    r = rolling_mean(df, by, order, col, window, min_periods, "_roll", pos, chunk_rows)
    return r.withColumn(col, F.coalesce(F.col(col), F.col("_roll"))).drop("_roll")


# --- F3 / F4 / F6 -----------------------------------------------------------
def interpolate(df: DataFrame, by, order: Sequence[str], cols: Sequence[str],
                method: str = "linear", ts: str | None = None, pos: str | None = None,
                chunk_rows: int = DEFAULT_CHUNK_ROWS, lead: Mapping[str, int | None] | None = None) -> DataFrame:
    """Fill inner gaps linearly (pandas ``interpolate``, forward direction).

    ``method="linear"`` weights by row position, ``"time"`` by the time
    column ``ts`` (default: the first order column).  A leading gap stays
    NULL; a trailing gap takes the last known value.  ``lead`` {column:
    rows} back-fills leading gaps of at most so many rows (None: any) in the
    same pass: all that :func:`bfill` finds missing after interpolation is
    the leading gap, and it ends at the next value's position.
    """
    cols, lead = list(cols), dict(lead or {})
    d, p, added = _positioned(df, by, order, pos)
    if method == "time":
        t = epoch_micros(d, ts or order[0]).cast("double")
    elif method == "linear":
        t = F.col(p).cast("double")
    else:
        raise ValueError(method)
    d = d.withColumn("_t", t)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(p).alias("p"), F.col("_t").alias("t"),
                                                        F.col(c).alias("v"))) for c in cols}
    d = carry(d, by, p, {f"_prev_{c}": s for c, s in known.items()}, forward=True, chunk_rows=chunk_rows,
              backward_items={f"_next_{c}": s for c, s in known.items()})
    for c in cols:
        prev, nxt = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        first = F.lit(None)
        if c in lead:
            first = nxt["v"] if lead[c] is None else F.when(nxt["p"] <= lead[c], nxt["v"])
        filled = (F.when(prev.isNull(), first)
                  .when(nxt.isNull(), prev["v"])
                  .otherwise(prev["v"] + (nxt["v"] - prev["v"]) *
                             (F.col("_t") - prev["t"]) / (nxt["t"] - prev["t"])))
        d = d.withColumn(c, F.coalesce(F.col(c), filled))
    d = d.drop("_t", *[f"_{k}_{c}" for c in cols for k in ("prev", "next")])
    return _finish(d, p, added)


def impute_groups(df: DataFrame, key, order: Sequence[str], cols: Sequence[str],
                  exclude: Sequence[str] = ("coco",), method: str = "linear",
                  chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Interpolate every selected column of every group in one plan.

    The reference interpolates a column of a group only when the group has
    some but not all values missing (F5).  Interpolation leaves a column
    without gaps unchanged and an all-missing column missing, so the gate
    holds without a separate profile pass.
    """
    todo = [c for c in cols if c not in set(exclude)]
    return interpolate(df, key, order, todo, method=method, chunk_rows=chunk_rows)


# --- F5 ---------------------------------------------------------------------
def imputable(df: DataFrame, key, cols: Sequence[str], exclude: Sequence[str] = ("coco",)) -> DataFrame:
    """(key, column) pairs where the group has some but not all values
    missing."""
    keys = keys_of(key)
    cols = [c for c in cols if c not in set(exclude)]
    prof = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"),
                                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = prof.unpivot([*keys, "_rows"], cols, "column", "n_missing")
    return (long.filter((F.col("n_missing") > 0) & (F.col("n_missing") < F.col("_rows")))
            .drop("_rows"))


# --- F7 / F8 / F9 / F10 -----------------------------------------------------
def bfill(df: DataFrame, by, order: Sequence[str], col: str, max_nulls: int | None = None,
          pos: str | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Next observation carried backward.  With ``max_nulls`` only series
    with at most that many missing values are filled (the reference fills
    series with exactly one)."""
    keys = keys_of(by)
    d, p, added = _positioned(df, by, order, pos)
    d = carry(d, by, p, {"_nx": F.when(F.col(col).isNotNull(), F.struct(F.col(p).alias("p"),
                                                                         F.col(col).alias("v")))},
              forward=False, chunk_rows=chunk_rows)
    fill = F.col("_nx.v")
    if max_nulls is not None:
        if keys:
            cnt = d.groupBy(*keys).agg(F.count_if(F.col(col).isNull()).alias("_nn"))
            d = join_on(d, cnt, keys)
        else:
            d = d.withColumn("_nn", d.select(F.count_if(F.col(col).isNull())).scalar())
        fill = F.when(F.col("_nn") <= max_nulls, fill)
    d = d.withColumn(col, F.coalesce(F.col(col), fill)).drop("_nx", "_nn")
    return _finish(d, p, added)


def ffill(df: DataFrame, by, order: Sequence[str], col: str, pos: str | None = None,
          chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Last observation carried forward."""
    d, p, added = _positioned(df, by, order, pos)
    d = carry(d, by, p, {"_pv": F.when(F.col(col).isNotNull(), F.struct(F.col(p).alias("p"),
                                                                         F.col(col).alias("v")))},
              forward=True, chunk_rows=chunk_rows)
    d = d.withColumn(col, F.coalesce(F.col(col), F.col("_pv.v"))).drop("_pv")
    return _finish(d, p, added)


_NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def fill_constant(df: DataFrame, value: float = 0.0, cols: Sequence[str] | None = None,
                  where: Column | None = None) -> DataFrame:
    """Fill missing numeric values with a constant, on all rows or only
    where ``where`` holds (one key in the reference).  String columns are
    left alone, as Spark's ``fillna`` does."""
    cols = list(cols or [c for c, t in df.dtypes if t in _NUMERIC or t.startswith("decimal")])
    if where is None:
        return df.fillna(value, subset=cols)
    return df.withColumns({c: F.when(where, F.coalesce(F.col(c), F.lit(value))).otherwise(F.col(c))
                           for c in cols})


def zero_fill_absent(df: DataFrame, key, cols: Sequence[str]) -> DataFrame:
    """Set a column to 0 in the groups where it has no value at all."""
    keys = keys_of(key)
    cnt = df.groupBy(*keys).agg(*[F.count(c).alias(f"_n_{c}") for c in cols])
    d = join_on(df, cnt, keys)
    d = d.withColumns({c: F.when(F.col(f"_n_{c}") == 0, F.lit(0.0)).otherwise(F.col(c)) for c in cols})
    return d.drop(*[f"_n_{c}" for c in cols])


def presence(df: DataFrame, ts: str, col: str, by=None) -> DataFrame:
    """Presence timeline: whether ``col`` has a value at each time."""
    return df.select(*keys_of(by), ts, F.col(col).isNotNull().alias("present"))


# --- F11 --------------------------------------------------------------------
def lag_backfill(df: DataFrame, by, order: Sequence[str], col: str, lag: int,
                 out: str | None = None, pos: str | None = None,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``shift(lag).bfill()``: the value ``lag`` rows earlier, the head
    (and any gap) filled with the next known value.  ``lag=0`` is the
    identity and leaves gaps."""
    out = out or col
    if lag == 0:
        return df if out == col else df.withColumn(out, F.col(col))
    keys = keys_of(by)
    d, p, added = _positioned(df, by, order, pos)
    shifted = d.select(*keys, (F.col(p) + lag).alias(p), F.col(col).alias("_lagged"))
    d = join_on(d, shifted, [*keys, p], "left") if keys else d.join(shifted, [p], "left")
    d = d.withColumn(out, F.col("_lagged")).drop("_lagged")
    d = bfill(d, by, order, out, pos=p, chunk_rows=chunk_rows)
    return _finish(d, p, added)


# --- F12 / F13 --------------------------------------------------------------
def _with_length(df: DataFrame, by, col: str) -> DataFrame:
    keys = keys_of(by)
    if keys:
        n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_N"),
                                  F.count_if(F.col(col).isNull()).alias("_gaps"))
        return join_on(df, n, keys)
    stats = df.select(F.struct(F.count(F.lit(1)).alias("n"),
                               F.count_if(F.col(col).isNull()).alias("g"))).scalar()
    return (df.withColumn("_st", stats).withColumn("_N", F.col("_st.n"))
            .withColumn("_gaps", F.col("_st.g")).drop("_st"))


def _dct_coefficients(d: DataFrame, keys, p: str, col: str, kmax: int) -> DataFrame:
    """c_k = 2 * sum_n x_n cos(pi k (2n+1) / 2N), k = 0..min(kmax, N-1).

    Each row contributes to every k; the sum is a grouped aggregate, so
    map-side partial sums keep a long series from landing on one task.
    A series with any missing value has no spectrum (NULL)."""
    e = d.select(*keys, p, col, "_N", "_gaps", F.explode(F.sequence(F.lit(0), F.lit(int(kmax)))).alias("_k"))
    e = e.filter(F.col("_k") < F.col("_N"))
    term = F.lit(2.0) * F.col(col) * F.cos(F.lit(math.pi) * F.col("_k") * (2 * F.col(p) + 1) / (2 * F.col("_N")))
    return (e.groupBy(*keys, "_k")
            .agg(F.sum(term).alias("_c"), F.max("_gaps").alias("_gaps"), F.max("_N").alias("_N"))
            .select(*keys, "_k", F.when(F.col("_gaps") == 0, F.col("_c")).alias("coefficient"), "_N"))


def dct_spectrum(df: DataFrame, by, order: Sequence[str], col: str, kmax: int,
                 pos: str | None = None) -> DataFrame:
    """Unnormalised DCT-II coefficients (scipy's default) of each series,
    as rows (series..., k, coefficient)."""
    keys = keys_of(by)
    d, p, _ = _positioned(df, by, order, pos)
    d = _with_length(d, keys, col)
    return _dct_coefficients(d, keys, p, col, kmax).drop("_N").withColumnRenamed("_k", "k")


# a series up to this length is transformed in one group
SHORT_SERIES = 1 << 16


def _spectrum(v: np.ndarray, k: np.ndarray, n: int) -> np.ndarray:
    """DCT-II coefficients from the Fourier transform ``v`` at ``k`` of a series of n values, taken as
    x_0, x_2, x_4, ... and back ..., x_3, x_1."""
    return 2.0 * (np.exp(-0.5j * math.pi * k / n) * v).real


def _chirp(i: np.ndarray, n: int) -> np.ndarray:
    """exp(-i pi i**2 / n), with the square reduced before it loses digits."""
    return np.exp(-1j * math.pi * ((i * i) % (2 * n)) / n)


def _split(n: int) -> tuple[int, int]:
    """Two powers of two of about equal size, whose product holds a convolution of 2n - 1 places."""
    bits = (2 * n - 2).bit_length()
    return 1 << (bits + 1) // 2, 1 << bits // 2


def _series_of(table: pa.Table, keys: Sequence[str], n: int) -> list:
    return [pa.array([v.as_py()] * n, t.type) for v, t in ((table.column(c)[0], table.schema.field(c)) for c in keys)]


def dct_spectrum_full(df: DataFrame, by, order: Sequence[str], col: str, pos: str | None = None,
                      short: int = SHORT_SERIES) -> DataFrame:
    """Every DCT-II coefficient of each series, k = 0 .. N-1: (series..., k, coefficient).

    The same values as :func:`dct_spectrum` with ``kmax`` = N - 1, which adds up N x kmax terms.  Here a
    series of up to ``short`` values is one fast Fourier transform.  A longer one is a convolution with a
    chirp (which suits any N) of length M1 x M2, at most 4 N, done in three groupings of about sqrt(M) values
    each: by the residue of the place, by that of the frequency, and by that of the result.  Each group is a
    short transform and a multiplication by its twiddle factors; the chirp is made where it is needed.  So
    no group and no task holds a long series, and about 4 N rows are shuffled twice.

    A series with a missing value has no spectrum: its coefficients are NULL.
    """
    keys = keys_of(by)
    d, p, _ = _positioned(df, by, order, pos)
    at = F.col("_i")
    d = _with_length(d, keys, col).select(*keys, F.col(p).cast("long").alias("_i"), F.col("_N").cast("long").alias("_N"),
                                          "_gaps", F.col(col).cast("double").alias("_x"))
    # even places first, then the odd ones backwards
    d = d.withColumn("_place", F.when(at % 2 == 0, F.expr("_i div 2")).otherwise(F.expr("_N - (_i + 1) div 2")))
    d = cut_lineage(d.withColumn("_one", F.lit(0)))
    own = [*keys, "_one"]
    fields = [d.schema[k] for k in own]
    out = T.StructType([*fields, T.StructField("k", T.LongType()), T.StructField("coefficient", T.DoubleType())])
    part = lambda *names: T.StructType([*fields, T.StructField("_N", T.LongType()), *(
        T.StructField(n, T.LongType() if n.startswith("_") else T.DoubleType()) for n in names)])

    def whole(table: pa.Table) -> pa.Table:
        n = table.num_rows
        v = np.empty(n)
        v[table.column("_place").to_numpy()] = table.column("_x").to_numpy()
        k = np.arange(n)
        return pa.table([*_series_of(table, own, n), pa.array(k), pa.array(_spectrum(np.fft.fft(v), k, n))],
                        names=out.names)

    def by_place(table: pa.Table) -> pa.Table:
        """Places of one residue r modulo m2: transform over the multiples, twiddle."""
        n = table.column("_N")[0].as_py()
        m1, m2 = _split(n)
        place = table.column("_place").to_numpy()
        r = int(place[0] % m2)
        i = np.arange(m1) * m2 + r
        a = np.zeros(m1, complex)
        a[place // m2] = table.column("_x").to_numpy() * _chirp(place, n)
        # the chirp of the convolution, at i and from the other end
        back = m1 * m2 - i
        b = np.where(i < n, np.conj(_chirp(i, n)), np.where(back < n, np.conj(_chirp(back, n)), 0))
        k1 = np.arange(m1)
        twiddle = np.exp(-2j * math.pi * r * k1 / (m1 * m2))
        a, b = np.fft.fft(a) * twiddle, np.fft.fft(b) * twiddle
        return pa.table([*_series_of(table, own, m1), pa.array(np.full(m1, n)), pa.array(k1), pa.array(np.full(m1, r)),
                         *(pa.array(np.ascontiguousarray(x)) for x in (a.real, a.imag, b.real, b.imag))],
                        names=part("_k1", "_r", "ar", "ai", "br", "bi").names)

    def by_frequency(table: pa.Table) -> pa.Table:
        """Frequencies k1 + m1 k2 of one k1: finish both transforms, multiply, begin the inverse one."""
        n = table.column("_N")[0].as_py()
        m1, m2 = _split(n)
        r, k1 = table.column("_r").to_numpy(), table.column("_k1")[0].as_py()
        a, b = np.zeros(m2, complex), np.zeros(m2, complex)
        a[r] = table.column("ar").to_numpy() + 1j * table.column("ai").to_numpy()
        b[r] = table.column("br").to_numpy() + 1j * table.column("bi").to_numpy()
        m = np.arange(m2)
        c = np.fft.ifft(np.fft.fft(a) * np.fft.fft(b)) * np.exp(2j * math.pi * k1 * m / (m1 * m2))
        return pa.table([*_series_of(table, own, m2), pa.array(np.full(m2, n)), pa.array(m), pa.array(np.full(m2, k1)),
                         *(pa.array(np.ascontiguousarray(x)) for x in (c.real, c.imag))],
                        names=part("_m", "_k1", "cr", "ci").names)

    def by_result(table: pa.Table) -> pa.Table:
        """Results m + m2 j of one m: finish the inverse transform."""
        n = table.column("_N")[0].as_py()
        m1, m2 = _split(n)
        c = np.zeros(m1, complex)
        c[table.column("_k1").to_numpy()] = table.column("cr").to_numpy() + 1j * table.column("ci").to_numpy()
        k = table.column("_m")[0].as_py() + m2 * np.arange(m1)
        use = k < n
        k = k[use]
        v = np.fft.ifft(c)[use] * _chirp(k, n)
        return pa.table([*_series_of(table, own, len(k)), pa.array(k), pa.array(_spectrum(v, k, n))], names=out.names)

    full = d.where("_gaps = 0")
    near = full.where(F.col("_N") <= short).groupBy(*own).applyInArrow(whole, out)
    far = full.where(F.col("_N") > short)
    # m2 is 2 ** (bits div 2) of the places that 2 N - 1 need
    bits = F.length(F.conv(F.col("_N") * 2 - 2, 10, 2))
    residue = (F.col("_place") % F.pow(F.lit(2.0), F.floor(bits / 2))).cast("long")
    far = far.withColumn("_r", residue).groupBy(*own, "_N", "_r") \
        .applyInArrow(by_place, part("_k1", "_r", "ar", "ai", "br", "bi")) \
        .groupBy(*own, "_N", "_k1").applyInArrow(by_frequency, part("_m", "_k1", "cr", "ci")) \
        .groupBy(*own, "_N", "_m").applyInArrow(by_result, out)
    none = d.where("_gaps > 0").select(*own, F.col("_i").alias("k"), F.lit(None).cast("double").alias("coefficient"))
    return near.unionByName(far).unionByName(none).drop("_one")


def dct_lowpass(df: DataFrame, by, order: Sequence[str], col: str, cutoff: int,
                out: str | None = None, pos: str | None = None) -> DataFrame:
    """Low-pass smoothing: keep coefficients k = 0..cutoff (inclusive) and
    invert, ``x_n = (c_0/2 + sum_k c_k cos(pi k (2n+1) / 2N)) / N``.

    The kept coefficients (at most ``cutoff + 1`` per series, a bound set by
    the parameter) are gathered into one array per series and joined back
    to the rows; the inverse is a higher-order ``aggregate`` expression.
    """
    out = out or f"{col}_lowpass"
    keys = keys_of(by)
    d, p, added = _positioned(df, by, order, pos)
    d = _with_length(d, keys, col)
    coef = _dct_coefficients(d, keys, p, col, cutoff)
    arr = coef.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_k", "coefficient"))).alias("_coef"))
    d = join_on(d, arr, keys, "left") if keys else d.withColumn("_coef", arr.select("_coef").scalar())
    n = F.col(p).cast("double")
    N = F.col("_N").cast("double")
    inv = F.aggregate(
        "_coef", F.lit(0.0),
        lambda acc, e: acc + e["coefficient"] * F.when(e["_k"] == 0, F.lit(0.5)).otherwise(
            F.cos(F.lit(math.pi) * e["_k"] * (2 * n + 1) / (2 * N))))
    d = d.withColumn(out, inv / N).drop("_coef", "_N", "_gaps")
    return _finish(d, p, added)


# --- F14 / F15 --------------------------------------------------------------
def sliding_corr(df: DataFrame, by, order: Sequence[str], x: str, y: str, width: int = 7,
                 out: str = "corr", pos: str | None = None,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Centred rolling Pearson correlation (pandas ``rolling(width,
    center=True).corr``): the frame is ``rowsBetween(-(w-1-o), o)`` with
    ``o = (w-1)//2``; NULL unless all ``width`` pairs are present, and NULL
    (not an error) when either side is constant."""
    o = (width - 1) // 2
    before = width - 1 - o
    keys = keys_of(by)
    d, p, added = _positioned(df, by, order, pos)
    # Correlation is shift invariant; centring each series on its mean keeps
    # the window moments well conditioned when the level dwarfs the spread.
    if keys:
        means = d.groupBy(*keys).agg(F.avg(x).alias("_mx"), F.avg(y).alias("_my"))
        d = join_on(d, means, keys)
    else:
        m = d.select(F.struct(F.avg(x).alias("x"), F.avg(y).alias("y"))).scalar()
        d = d.withColumn("_m", m).withColumn("_mx", F.col("_m.x")).withColumn("_my", F.col("_m.y")).drop("_m")
    d = d.withColumn("_cx", F.col(x) - F.col("_mx")).withColumn("_cy", F.col(y) - F.col("_my"))
    h, w = halo(d, by, p, before, o, chunk_rows)
    fr = w.rowsBetween(-before, o)
    both = F.when(F.col("_cx").isNotNull() & F.col("_cy").isNotNull(), F.lit(1))
    den = F.stddev_pop("_cx").over(fr) * F.stddev_pop("_cy").over(fr)
    corr = F.when(F.count(both).over(fr) == width,
                  F.covar_pop("_cx", "_cy").over(fr) / F.when(den != 0, den))
    h = (h.withColumn(out, corr).filter("_home")
         .drop("_chunk", "_home", "_mx", "_my", "_cx", "_cy"))
    return _finish(h, p, added)


def dct_swc(prices: DataFrame, wind: DataFrame, day: str = "day", price: str = "price",
            wspd: str = "wspd", swc_width: int = 7, lag: int = 0, dct_cutoff: int = 0,
            dct_filter: bool = False, chunk_rows: int = DEFAULT_CHUNK_ROWS,
            materialize: bool = True) -> DataFrame:
    """Lag the second series (back-filling the head), optionally low-pass
    both, pair them by date and take the centred sliding correlation.

    Returns (day, price, wspd, corr) with the lagged / filtered values.
    Each skew-safe step reads its input twice (rows and a summary), so a
    chain of steps would re-derive the first input many times over; with
    ``materialize`` the numbered series, the lagged one and the pairs are
    checkpointed to the cluster's checkpoint folder.  A series is numbered
    once: lagging and smoothing keep its rows."""
    cut = cut_lineage if materialize else (lambda d: d)
    w = cut(with_position(wind.select(day, wspd), None, [day], _POS))
    w = cut(lag_backfill(w, None, [day], wspd, lag, pos=_POS, chunk_rows=chunk_rows)) if lag else w
    pr = prices.select(day, price)
    if dct_filter:
        pr = cut(with_position(pr, None, [day], _POS))
        pr, w = (dct_lowpass(d, None, [day], c, dct_cutoff, out="_f", pos=_POS)
                 .drop(c).withColumnRenamed("_f", c) for d, c in ((pr, price), (w, wspd)))
    both = cut(pr.drop(_POS).join(w.drop(_POS), [day], "inner"))
    return sliding_corr(both, None, [day], price, wspd, swc_width, "corr", chunk_rows=chunk_rows)
