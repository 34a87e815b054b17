"""Composite data products (H1-H12): one DataFrame per dashboard page or
cleaning step, drawing excluded.

Each product is a composition of the library operators and stays one
Spark plan.  Where the reference worked on one municipality chosen in the
UI, the product takes the key as a parameter and ``None`` means every
series at once (the same plan, partitioned by the key).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions import columns as B
from tempora.functions import scalar as C
from tempora.operators import aggregate as E
from tempora.operators import joins as D
from tempora.operators import timeseries as TS
from tempora.operators.series import grid_position, keys_of
from tempora.session import cut_lineage

# Fixed values of the reference: alert thresholds of the exchange map and
# the default low-pass cut-off of the municipality line.
FLOW_YELLOW = 0.8
FLOW_RED = 0.95
LINE_CUTOFF = 5


# --- H1 ---------------------------------------------------------------------
def map_frame(facts: DataFrame, dim: DataFrame, ts: str, key: str, value: str,
              dim_key: str, agg: str = "sum") -> DataFrame:
    """Daily value per key with marker size and dimension attributes.

    Duplicates at (time, key) are averaged (pivot table), then days are
    summed (``agg="sum"``, gap day 0, size ``sqrt``) or averaged
    (``agg="mean"``, weather, size = min-max scaled / 10); keys without a
    dimension row are dropped (inner join)."""
    daily = E.resample_daily(facts, ts, value, by=key, agg=agg, dup_agg="mean", spine="frame")
    if agg == "mean":
        daily = C.minmax_scale(daily, value, "dot_size")
    else:
        daily = daily.withColumn("dot_size", F.when(F.col(value) >= 0, F.sqrt(value)))
    daily = daily.withColumn("date", C.date_label("day"))
    return D.dim_join(daily, dim, key, dim_key, "inner")


# --- H2 ---------------------------------------------------------------------
def line_frame(daily: DataFrame, key: str, value: str, code=None, cutoff: int = LINE_CUTOFF,
               day: str = "day") -> DataFrame:
    """Daily line of one key (or of every key when ``code`` is None) with
    its low-pass curve ``idct`` (DCT cut-off inclusive)."""
    d = daily if code is None else B.where_equal(daily, {key: code})
    d = grid_position(d, key, day, 86400, "_p")
    out = TS.dct_lowpass(d, key, [day], value, cutoff, out="idct", pos="_p")
    return out.drop("_p")


# --- H3 ---------------------------------------------------------------------
def exchange_frame(hourly: DataFrame, ts: str, link: str, value: str,
                   coords: Mapping[str, tuple[float, float]],
                   yellow: float = FLOW_YELLOW, red: float = FLOW_RED) -> DataFrame:
    """Daily net flow per link with share of the link's largest absolute
    daily flow, direction, alert colour, remaining capacity, coordinates and
    marker size.  Hourly duplicates (several price areas) are averaged
    first, then days are summed."""
    daily = E.resample_daily(hourly, ts, value, by=link, agg="sum", dup_agg="mean", spine="frame")
    peak = E.extremes(daily, value, by=link).select(link, F.col("max_abs").alias("_peak"))
    d = daily.join(peak, [link])
    v = F.col(value)
    share = F.try_divide(F.abs(v), F.col("_peak"))
    lat = {k: c[0] for k, c in coords.items()}
    lon = {k: c[1] for k, c in coords.items()}
    return (d.withColumn("share", share)
            .withColumn("direction", F.when(v >= 0, F.lit("Net import")).otherwise(F.lit("Net export")))
            .withColumn("alert", F.when(F.col("share") > red, F.lit("red"))
                        .when(F.col("share") > yellow, F.lit("yellow")).otherwise(F.lit("green")))
            .withColumn("remaining", F.col("_peak") - F.abs(v))
            .withColumn("latitude", C.map_lookup(link, lat))
            .withColumn("longitude", C.map_lookup(link, lon))
            .withColumn("size", C.cube_root_abs(v))
            .withColumn("date", C.date_label("day"))
            .drop("_peak"))


# --- H4 ---------------------------------------------------------------------
def exchange_stats(df: DataFrame, ts: str, value: str, k: float = 3.0, p: float = 0.05) -> DataFrame:
    """One row: mean, sd, trimmed mean, MAD (raw, scaled) and +-k sd limits
    of the hourly total (summed over price areas)."""
    hourly = E.group_sum(df, ts, value)
    basic = E.spc_limits(hourly, value, k=k).select(
        F.col("centre").alias("mean"), F.col("spread").alias("std"), "lower", "upper")
    tm = E.trimmed_mean(hourly, value, p)
    md = E.mad(hourly, value).select(F.struct("mad", "mad_scaled")).scalar()
    return (basic.select("*", tm.select("trimmed_mean").scalar().alias("trimmed_mean"), md.alias("_md"))
            .select("*", F.col("_md.mad").alias("mad"), F.col("_md.mad_scaled").alias("mad_scaled"))
            .drop("_md"))


# --- H5 / H6 ----------------------------------------------------------------
def sync_to_daily(weather: DataFrame, daily: DataFrame, ts: str, key: str, prop: str,
                  price: str, municipality=None, day: str = "day") -> DataFrame:
    """Daily mean of a weather property per municipality (own day range),
    paired with the daily price by date (inner)."""
    w = weather if municipality is None else B.where_equal(weather, {key: municipality})
    wd = E.resample_daily(w, ts, prop, by=key, agg="mean", spine="key", day_col=day)
    return D.align_series(wd, daily.select(day, price), day).select(key, day, prop, price)


def wind_daily(weather: DataFrame, ts: str, col: str, prices: DataFrame, price_day: str,
               day: str = "day") -> DataFrame:
    """Mean of ``col`` over all rows of each day, clipped to the price
    series' first and last day."""
    d = E.resample_daily(weather, ts, col, agg="mean", day_col=day)
    return B.clip_to_span(d, day, prices, price_day)


# --- H7 ---------------------------------------------------------------------
def correlation_frame(prices: DataFrame, weather: DataFrame, ts: str, col: str,
                      price: str = "price", day: str = "day", lag: int = 7, width: int = 7,
                      cutoff: int = 5, dct_filter: bool = True) -> DataFrame:
    """Sliding correlation of the daily price with the lagged (and
    optionally low-passed) daily mean of a weather column."""
    wind = cut_lineage(wind_daily(weather, ts, col, prices, day, day))
    return TS.dct_swc(prices.select(day, price), wind, day=day, price=price, wspd=col,
                      swc_width=width, lag=lag, dct_cutoff=cutoff, dct_filter=dct_filter)


# --- H8 ---------------------------------------------------------------------
def consumption_summary(facts: DataFrame, dim: DataFrame, key: str, dim_key: str,
                        dim_name: str, group_col: str, agg: str, response: str) -> DataFrame:
    """Left-join municipality names, then one aggregate per group."""
    named = D.dim_join(facts, dim.select(dim_key, dim_name), key, dim_key, "left",
                       rename={dim_name: "municipality"})
    return E.group_agg(named, group_col, agg, response,
                       allowed=["municipality", "branche", key])


def consumption_grouped(facts: DataFrame, dim: DataFrame, key: str, dim_key: str,
                        dim_name: str, main: str, response: str) -> DataFrame:
    named = D.dim_join(facts, dim.select(dim_key, dim_name), key, dim_key, "left",
                       rename={dim_name: "municipality"})
    return E.grouped_sum(named, main, response,
                         opposite={"municipality": "branche", "branche": "municipality"})


# --- H9 / H10 / H12 ---------------------------------------------------------
def _for_key(df: DataFrame, key: str, code, fn) -> DataFrame:
    """Apply ``fn`` to the rows of one key and keep the others as they are."""
    sel = F.col(key) == F.lit(code)
    return fn(df.filter(sel)).unionByName(df.filter(~sel | F.col(key).isNull()))


def clean_production(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                     zero_fill_key=None, rolling: Mapping | None = None,
                     interpolate: Mapping | None = None) -> DataFrame:
    """Production cleaning: zero-fill columns that a key lacks entirely, fill
    every column of ``zero_fill_key`` with 0, impute ``rolling`` {key: col}
    with a 3-row rolling mean and ``interpolate`` {key: col} linearly."""
    out = TS.zero_fill_absent(df, key, cols)
    if zero_fill_key is not None:
        out = TS.fill_constant(out, 0.0, cols, where=F.col(key) == F.lit(zero_fill_key))
    for code, col in (rolling or {}).items():
        out = _for_key(out, key, code, lambda d, c=col: TS.impute_rolling(d, key, order, c))
    for code, col in (interpolate or {}).items():
        out = _for_key(out, key, code, lambda d, c=col: TS.interpolate(d, key, order, [c]))
    return out


def clean_weather(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                  bfill_col: str | None = None, max_nulls: int = 1,
                  exclude: Sequence[str] = ("coco",)) -> DataFrame:
    """Weather cleaning: interpolate every imputable column of every group,
    then carry the next value backward in ``bfill_col`` for groups with at
    most ``max_nulls`` values still missing."""
    todo = [c for c in cols if c not in set(exclude)]
    if bfill_col in todo:
        return TS.interpolate(df, key, order, todo, lead={bfill_col: max_nulls})
    out = TS.interpolate(df, key, order, todo)
    return TS.bfill(out, key, order, bfill_col, max_nulls=max_nulls) if bfill_col else out


def clean_gas(df: DataFrame, order: Sequence[str], cols: Sequence[str], window: int = 3) -> DataFrame:
    """Gas price cleaning: fill each column's gaps with its trailing rolling
    mean (one series, no key)."""
    out = df
    for c in cols:
        out = TS.impute_rolling(out, None, order, c, window=window, min_periods=1)
    return out


# --- H11 --------------------------------------------------------------------
def forecast_frame(production: DataFrame, ts: str, key: str, y: str, cutoff, horizon: int,
                   season: int = 24, exog: DataFrame | None = None, exog_cols: Sequence[str] = (),
                   order_tiebreak: Sequence[str] = (), months_before: int = 2,
                   municipality=None) -> DataFrame:
    """Observed values from ``cutoff - months_before`` plus the dynamic
    forecast for ``horizon`` steps after the cutoff, with its interval.

    (series, ts, observed, forecast, lower, upper); ``municipality=None``
    forecasts every series in one job."""
    from tempora.operators import forecast as FC
    d = production if municipality is None else B.where_equal(production, {key: municipality})
    feats = FC.forecast_features(d, key, [ts, *order_tiebreak], y, season, exog, exog_cols, [key, ts])
    fc = FC.fit_forecast(feats, key, ts, y, cutoff, horizon, season, list(exog_cols))
    c = F.lit(cutoff).cast(d.schema[ts].dataType)
    start = F.add_months(c, -months_before).cast(d.schema[ts].dataType)
    obs = d.filter(F.col(ts) >= start).select(key, ts, F.col(y).alias("observed"))
    return obs.join(fc, [key, ts], "left")
