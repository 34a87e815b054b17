"""Per-series forecasting (F16-F18).

The reference fits a SARIMAX(1,1,1)(1,0,1,24) with a constant and weather
regressors by state-space likelihood on one machine.  Here the model keeps
its terms, additive in the lags, on the first difference:

    dy_t = c + phi dy_{t-1} + Phi dy_{t-s} + sum_j theta_j e_{t-j} + sum_i beta_i x_{i,t} + e_t,

with the shocks e of lags 1 and s as its moving-average terms (``ma``;
none by default), and is fitted for every series at once by regression in
two stages: a long autoregression (``long_lags``) gives residuals, whose
lags are regressors of the second stage.

* features (F16): lags come from halo-chunked windows (see ``series``);
  exogenous columns are an equi-join on (series, time).
* fit (F17): in either stage the normal equations are one grouped aggregate
  (sums of products, combined map-side), so a long series never sits on one
  task; the small systems (p <= a handful) are solved as stacked arrays in
  ``mapInPandas``.
* forecast: one-step-ahead predictions are a column expression over every
  row after the cutoff.  The dynamic (recursive) forecast needs ``s + 2``
  known rows plus at most ``horizon`` steps per series (a size set by the
  parameters); these are packed into arrays per series, and the recursion
  runs over the steps for all series of an Arrow batch at once.
* interval (F18): +- z * sigma * sqrt(sum psi_j^2) with psi the impulse
  weights of the integrated model.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.operators.series import DEFAULT_CHUNK_ROWS, halo, join_on, keys_of, with_position
from tempora.session import cut_lineage

Z95 = 1.959963984540054


def _regressors(season: int, exog: Sequence[str], ma: Sequence[int] = ()) -> list[str]:
    return ["dy_lag1", f"dy_lag{season}", *(f"e_lag{j}" for j in ma), *exog]


# --- F16 --------------------------------------------------------------------
def forecast_features(df: DataFrame, by, order: Sequence[str], y: str, season: int = 24,
                      exog: DataFrame | None = None, exog_cols: Sequence[str] = (),
                      exog_on: Sequence[str] = (), pos: str = "pos",
                      chunk_rows: int = DEFAULT_CHUNK_ROWS, lags: Sequence[int] = ()) -> DataFrame:
    """Add ``pos``, ``dy`` (first difference), ``dy_lag1`` and ``dy_lag{season}``
    (and those of ``lags``), plus exogenous columns joined on ``exog_on``."""
    keys = keys_of(by)
    d = with_position(df, keys, order, pos)
    lags = sorted({1, season, *lags})
    h, w = halo(d, keys, pos, lags[-1] + 1, 0, chunk_rows)
    yc = F.col(y)
    lag = lambda k: F.lag(yc, k).over(w)
    h = (h.withColumns({"dy": yc - lag(1), **{f"dy_lag{k}": lag(k) - lag(k + 1) for k in lags}})
         .filter("_home").drop("_chunk", "_home"))
    if exog is not None and exog_cols:
        h = h.join(exog.select(*exog_on, *exog_cols), list(exog_on), "left")
    return h


# --- F17 --------------------------------------------------------------------
def _solve_batches(keys: list[str], p: int):
    def solve(batches):
        for b in batches:
            n = b["n"].to_numpy(np.int64)
            xtx = np.array(b["xtx"].tolist(), dtype=float).reshape(len(b), p, p)
            xty = np.array(b["xty"].tolist(), dtype=float).reshape(len(b), p)
            inverse = np.linalg.pinv(xtx, rcond=np.finfo(float).eps * p, hermitian=True)
            coef = np.einsum("sij,sj->si", inverse, xty)
            sse = b["syy"].to_numpy(float) - 2 * (coef * xty).sum(1) + np.einsum("si,sij,sj->s", coef, xtx, coef)
            few = n <= p
            coef[few] = np.nan
            sigma2 = np.where(few, np.nan, np.maximum(sse, 0.0) / np.where(few, 1, n - p))
            yield pd.DataFrame({**{k: b[k] for k in keys}, "coef": list(coef), "sigma2": sigma2, "n": n})
    return solve


def fit_ols(df: DataFrame, by, target: str, regressors: Sequence[str],
            intercept: bool = True) -> DataFrame:
    """Least squares of ``target`` on ``regressors`` per series, rows with
    any NULL skipped: (series..., coef array [c?, b...], sigma2, n).

    The normal equations X'X, X'y are one grouped aggregate; only the
    p x p systems (one row per series) reach Python, batched by Arrow."""
    keys = keys_of(by)
    regs = (["_one"] if intercept else []) + list(regressors)
    p = len(regs)
    tr = df.withColumn("_one", F.lit(1.0))
    complete = F.lit(True)
    for c in [*regs, target]:
        complete = complete & F.col(c).isNotNull()
    tr = tr.filter(complete)
    sums = [F.sum(F.col(a) * F.col(b)) for a in regs for b in regs]
    ne = tr.groupBy(*keys).agg(
        F.array(*sums).alias("xtx"),
        F.array(*[F.sum(F.col(a) * F.col(target)) for a in regs]).alias("xty"),
        F.sum(F.col(target) * F.col(target)).alias("syy"),
        F.count(F.lit(1)).alias("n"))
    key_fields = [df.schema[k] for k in keys]
    schema = T.StructType([*key_fields,
                           T.StructField("coef", T.ArrayType(T.DoubleType())),
                           T.StructField("sigma2", T.DoubleType()),
                           T.StructField("n", T.LongType())])
    return ne.mapInPandas(_solve_batches(keys, p), schema)


def fit_ar(features: DataFrame, by, cutoff, ts: str, season: int = 24,
           exog: Sequence[str] = ()) -> DataFrame:
    """Seasonal AR coefficients per series on rows with ``ts < cutoff``:
    (series..., coef array [c, phi, Phi, beta...], sigma2, n)."""
    tr = features.filter(F.col(ts) < F.lit(cutoff).cast(features.schema[ts].dataType))
    return fit_ols(tr, by, "dy", _regressors(season, exog))


def with_shocks(features: DataFrame, by, cutoff, ts: str, ma: Sequence[int], long_lags: Sequence[int],
                exog: Sequence[str] = (), pos: str = "pos", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """First stage of a fit with moving-average terms: add ``e``, the residual of a long autoregression of
    ``dy`` on the lags ``long_lags`` (and ``exog``) fitted on ``ts < cutoff``, and ``e_lag{j}`` for ``ma``.

    Rows that lack a regressor have no residual, and rows that lack a lag of it take no part in the second
    stage."""
    keys = keys_of(by)
    regs = [*(f"dy_lag{k}" for k in long_lags), *exog]
    train = features.filter(F.col(ts) < F.lit(cutoff).cast(features.schema[ts].dataType))
    first = fit_ols(train, keys, "dy", regs)
    d = join_on(features, first.select(*keys, F.col("coef").alias("_c1")), keys, "left") if keys else \
        features.withColumn("_c1", first.select("coef").scalar())
    fitted = F.col("_c1")[0]
    for i, c in enumerate(regs, start=1):
        fitted = fitted + F.col("_c1")[i] * F.col(c)
    # a series with too few rows for the first stage has NaN coefficients: no residual
    e = F.when(~F.isnan(F.col("_c1")[0]), F.col("dy") - fitted)
    h, w = halo(d.withColumn("e", e).drop("_c1"), keys, pos, max(ma), 0, chunk_rows)
    return h.withColumns({f"e_lag{j}": F.lag("e", j).over(w) for j in ma}).filter("_home").drop("_chunk", "_home")


def fit_arma(features: DataFrame, by, cutoff, ts: str, season: int = 24, ma: Sequence[int] = (1,),
             exog: Sequence[str] = ()) -> DataFrame:
    """Second stage: coefficients per series on ``ts < cutoff`` of features from :func:`with_shocks`:
    (series..., coef array [c, phi, Phi, theta..., beta...], sigma2, n)."""
    tr = features.filter(F.col(ts) < F.lit(cutoff).cast(features.schema[ts].dataType))
    return fit_ols(tr, by, "dy", _regressors(season, exog, ma))


def predict_one_step(features: DataFrame, coefs: DataFrame, by, y: str, season: int = 24,
                     exog: Sequence[str] = (), ma: Sequence[int] = ()) -> DataFrame:
    """One-step-ahead prediction of the level for every row:
    ``y_hat_t = y_{t-1} + c + phi*dy_{t-1} + Phi*dy_{t-s} + theta.e_lags + beta.x_t``."""
    keys = keys_of(by)
    regs = _regressors(season, exog, ma)
    d = join_on(features, coefs.select(*keys, "coef"), keys) if keys else \
        features.withColumn("coef", coefs.select("coef").scalar())
    pred = F.col("coef")[0]
    for i, c in enumerate(regs, start=1):
        pred = pred + F.col("coef")[i] * F.col(c)
    return d.withColumn("y_hat", (F.col(y) - F.col("dy")) + pred).drop("coef")


def _psi(phi: np.ndarray, Phi: np.ndarray, theta: np.ndarray, ma: Sequence[int], season: int, h: int) -> np.ndarray:
    """Impulse weights (series x h) of (1 - L)(1 - phi L - Phi L^s) y = (1 + sum theta_j L^j) e."""
    pi = np.zeros((len(phi), season + 2))
    pi[:, 1] += 1.0 + phi
    pi[:, 2] += -phi
    pi[:, season] += Phi
    pi[:, season + 1] += -Phi
    psi = np.zeros((len(phi), h))
    psi[:, 0] = 1.0
    for j in range(1, h):
        m = min(j, season + 1)
        psi[:, j] = (pi[:, 1:m + 1] * psi[:, j - m:j][:, ::-1]).sum(1)
        for i, lag in enumerate(ma):
            if lag == j:
                psi[:, j] += theta[:, i]
    return psi


def _dynamic_batches(keys, ts, season, n_exog, z, ma):
    """Recursive forecast of a batch of series, one row per series with the
    arrays ``ys``/``es``/``test``/``tss``/``xs`` ordered by position."""
    back = max([season + 1, *ma])

    def run(batches):
        for b in batches:
            use, last, dys, es, xs, steps = [], [], [], [], [], []
            for i, (ys, e, test, x, coef) in enumerate(zip(b["ys"], b["es"], b["test"], b["xs"], b["coef"])):
                test, ys = np.asarray(test, dtype=bool), np.asarray(ys, dtype=float)
                known = ys[~test]
                if not test.any() or len(known) < season + 2 or np.isnan(np.asarray(coef, dtype=float)).any() \
                        or np.isnan(known[-(season + 2):]).any():
                    continue
                use.append(i)
                last.append(known[-1])
                dys.append(np.diff(known[-(season + 2):]))
                shock = np.nan_to_num(np.asarray(e, dtype=float)[~test])[-back:]
                es.append(np.concatenate([np.zeros(back - len(shock)), shock]))
                xs.append(np.asarray(x, dtype=float).reshape(len(test), n_exog)[test])
                steps.append(int(test.sum()))
            if not use:
                continue
            rows, h = b.iloc[use], max(steps)
            coef = np.array([np.asarray(c, dtype=float) for c in rows["coef"]])
            theta, beta = coef[:, 3:3 + len(ma)], coef[:, 3 + len(ma):]
            x = np.zeros((len(use), h, n_exog))
            for i, own in enumerate(xs):
                x[i, :len(own)] = own
            d, e, level = np.array(dys), np.array(es), np.array(last)
            fc = np.zeros((len(use), h))
            for t in range(h):
                step = coef[:, 0] + coef[:, 1] * d[:, -1] + coef[:, 2] * d[:, -season] + (beta * x[:, t]).sum(1)
                for i, lag in enumerate(ma):
                    step = step + theta[:, i] * e[:, -lag]
                d = np.column_stack([d[:, 1:], step])
                e = np.column_stack([e[:, 1:], np.zeros(len(use))])
                level = level + step
                fc[:, t] = level
            psi = _psi(coef[:, 1], coef[:, 2], theta, ma, season, h)
            half = z * np.sqrt(rows["sigma2"].to_numpy(float)[:, None] * np.cumsum(psi ** 2, axis=1))
            inside = np.arange(h)[None, :] < np.array(steps)[:, None]
            out = {k: np.repeat(rows[k].to_numpy(), steps) for k in keys}
            out[ts] = [v for times, test in zip(rows["tss"], rows["test"])
                       for v, t in zip(times, test) if t]
            yield pd.DataFrame({**out, "forecast": fc[inside], "lower": (fc - half)[inside],
                                "upper": (fc + half)[inside]})
    return run


def fit_forecast(features: DataFrame, by, ts: str, y: str, cutoff, horizon: int,
                 season: int = 24, exog: Sequence[str] = (), z: float = Z95, ma: Sequence[int] = (),
                 long_lags: Sequence[int] = ()) -> DataFrame:
    """Fit per series on ``ts < cutoff`` and forecast the next ``horizon``
    rows recursively (exogenous values taken as known), with intervals.

    ``ma`` names the lags of the moving-average terms, (1, season) for the
    reference's order; ``features`` then need the lags ``long_lags`` of the
    first stage.  Shocks after the cutoff, and missing ones, are 0.

    Each series' last known rows (``season + 2``, or as many as ``ma`` goes
    back) and ``horizon`` test rows are packed into arrays by a grouped
    ``collect_list``; the recursion then runs over Arrow batches of series
    in ``mapInPandas``.  Output: (series..., ts, forecast, lower, upper)."""
    keys = keys_of(by)
    exog, ma = list(exog), list(ma)
    # read by the fit, the cutoff's position and the recursion
    features = cut_lineage(features)
    if ma:
        features = cut_lineage(with_shocks(features, keys, cutoff, ts, ma, long_lags, exog))
        coefs = fit_arma(features, keys, cutoff, ts, season, ma, exog)
    else:
        features = features.withColumn("e", F.lit(None).cast("double"))
        coefs = fit_ar(features, keys, cutoff, ts, season, exog)
    cut = F.lit(cutoff).cast(features.schema[ts].dataType)
    d = features
    if not keys:
        d = d.withColumn("_series", F.lit(0))
        coefs = coefs.withColumn("_series", F.lit(0))
        keys = ["_series"]
    first_test = d.filter(F.col(ts) >= cut).groupBy(*keys).agg(F.min("pos").alias("_p0"))
    d = join_on(d, first_test, keys)
    back = max([season + 2, *ma])
    d = d.filter((F.col("pos") >= F.col("_p0") - back) & (F.col("pos") < F.col("_p0") + horizon))
    row = F.struct(F.col("pos").alias("p"), F.col(y).cast("double").alias("y"), F.col("e"), (F.col("pos") >= F.col("_p0")).alias("t"),
                   F.col(ts).alias("ts"), F.array(*[F.col(c).cast("double") for c in exog]).alias("x"))
    packed = d.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("_r"))
    packed = packed.select(*keys, F.transform("_r", lambda e: e["y"]).alias("ys"),
                           F.transform("_r", lambda e: e["e"]).alias("es"),
                           F.transform("_r", lambda e: e["t"]).alias("test"),
                           F.transform("_r", lambda e: e["ts"]).alias("tss"),
                           F.flatten(F.transform("_r", lambda e: e["x"])).alias("xs"))
    packed = join_on(packed, coefs.select(*keys, "coef", "sigma2"), keys)
    key_fields = [d.schema[k] for k in keys]
    schema = T.StructType([*key_fields, features.schema[ts],
                           T.StructField("forecast", T.DoubleType()),
                           T.StructField("lower", T.DoubleType()),
                           T.StructField("upper", T.DoubleType())])
    out = packed.mapInPandas(_dynamic_batches(keys, ts, season, len(exog), z, ma), schema)
    return out.drop("_series") if keys == ["_series"] else out
