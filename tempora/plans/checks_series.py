"""Checks for the window and time-series operators (F1-F15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.operators import aggregate as agg
from tempora.operators import timeseries as TS
from tempora.plans import standins as S
from tempora.plans.checks_relational import GAS, READINGS, WEATHER, _with
from tempora.plans.registry import check, rounded

ORDER = ["hourutc", "id"]
KEY = "municipalityno"
W_KEY = "PARTITION BY municipalityno ORDER BY hourutc, id"


def _r(spark, d):
    return S.readings(spark, d)


def _readings2(spark, d):
    """Readings with a second measure holding its own gaps."""
    return _r(spark, d).withColumn(
        "value2", F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("value") * 2.0))


READINGS2 = READINGS + """,
readings2 AS (SELECT *, CASE WHEN id % 5 = 0 THEN NULL ELSE value * 2.0 END AS value2 FROM readings)"""


@check("f1_rolling_mean", _with(READINGS) + f"""SELECT id, round(CASE WHEN count(value) OVER w >= 1
  THEN avg(value) OVER w END, 6) AS value_rolling FROM readings
  WINDOW w AS ({W_KEY} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _f1(spark, d):
    out = TS.rolling_mean(_r(spark, d), KEY, ORDER, "value", window=3, min_periods=1)
    return rounded(out.select("id", "value_rolling"))


@check("f2_impute_rolling", _with(READINGS) + f"""SELECT id, round(coalesce(value,
  CASE WHEN count(value) OVER w >= 1 THEN avg(value) OVER w END), 6) AS value FROM readings
  WINDOW w AS ({W_KEY} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _f2(spark, d):
    return rounded(TS.impute_rolling(_r(spark, d), KEY, ORDER, "value").select("id", "value"))


def _interp_sql(src: str, cols, t_expr: str) -> str:
    carry = ", ".join(
        f"""last_value(CASE WHEN {c} IS NOT NULL THEN _t END IGNORE NULLS) OVER wf AS _pt_{c},
  last_value({c} IGNORE NULLS) OVER wf AS _pv_{c},
  first_value(CASE WHEN {c} IS NOT NULL THEN _t END IGNORE NULLS) OVER wb AS _nt_{c},
  first_value({c} IGNORE NULLS) OVER wb AS _nv_{c}""" for c in cols)
    outs = ", ".join(
        f"""round(coalesce({c}, CASE WHEN _pv_{c} IS NULL THEN NULL WHEN _nv_{c} IS NULL THEN _pv_{c}
  ELSE _pv_{c} + (_nv_{c} - _pv_{c}) * (_t - _pt_{c}) / (_nt_{c} - _pt_{c}) END), 6) AS {c}""" for c in cols)
    return f""", _b AS (SELECT *, {t_expr} AS _t FROM {src}),
  _c AS (SELECT *, {carry} FROM _b
    WINDOW wf AS ({W_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           wb AS ({W_KEY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  SELECT id, {outs} FROM _c"""


_POS_EXPR = f"CAST(row_number() OVER ({W_KEY}) - 1 AS DOUBLE)"


@check("f3_interpolate_linear", _with(READINGS) + _interp_sql("readings", ["value"], _POS_EXPR))
def _f3(spark, d):
    return rounded(TS.interpolate(_r(spark, d), KEY, ORDER, ["value"]).select("id", "value"))


@check("f4_interpolate_time", _with(READINGS) + _interp_sql("readings", ["value"], "CAST(epoch_us(hourutc) AS DOUBLE)"))
def _f4(spark, d):
    out = TS.interpolate(_r(spark, d), KEY, ORDER, ["value"], method="time")
    return rounded(out.select("id", "value"))


@check("f5_imputable", _with(READINGS2) + """SELECT municipalityno, "column", n_missing FROM (
  SELECT municipalityno, 'value' AS "column", count(*) FILTER (WHERE value IS NULL) AS n_missing, count(*) AS n FROM readings2 GROUP BY 1
  UNION ALL
  SELECT municipalityno, 'value2', count(*) FILTER (WHERE value2 IS NULL), count(*) FROM readings2 GROUP BY 1)
  WHERE n_missing > 0 AND n_missing < n""")
def _f5(spark, d):
    return TS.imputable(_readings2(spark, d), KEY, ["value", "value2"])


@check("f6_impute_groups", _with(READINGS2) + _interp_sql("readings2", ["value", "value2"], _POS_EXPR))
def _f6(spark, d):
    out = TS.impute_groups(_readings2(spark, d), KEY, ORDER, ["value", "value2"])
    return rounded(out.select("id", "value", "value2"))


@check("f7_bfill", _with(READINGS) + f""", c AS (SELECT *, count(*) FILTER (WHERE value IS NULL) OVER (PARTITION BY municipalityno) AS nn,
  first_value(value IGNORE NULLS) OVER ({W_KEY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nx FROM readings)
  SELECT id, round(coalesce(value, CASE WHEN nn <= 10 THEN nx END), 6) AS value FROM c""")
def _f7(spark, d):
    return rounded(TS.bfill(_r(spark, d), KEY, ORDER, "value", max_nulls=10).select("id", "value"))


@check("f8_fill_constant", _with(READINGS) + """SELECT coalesce(id, 0) AS id, hourutc, coalesce(municipalityno, 0) AS municipalityno,
  branche, coalesce(value, 0.0) AS value FROM readings""")
def _f8(spark, d):
    return TS.fill_constant(_r(spark, d), 0.0)


@check("f8_fill_constant_one_key", _with(READINGS) + """SELECT id, CASE WHEN branche = 'error'
  THEN coalesce(value, 0.0) ELSE value END AS value FROM readings""")
def _f8b(spark, d):
    return TS.fill_constant(_r(spark, d).select("id", "branche", "value"), 0.0, ["value"],
                            where=F.col("branche") == "error").select("id", "value")


@check("f9_zero_fill_absent", _with(READINGS) + """SELECT id, CASE WHEN count(value) OVER (PARTITION BY municipalityno) = 0
  THEN 0.0 ELSE value END AS value FROM readings""")
def _f9(spark, d):
    return TS.zero_fill_absent(_r(spark, d), KEY, ["value"]).select("id", "value")


@check("f10_presence", _with(READINGS) + "SELECT hourutc, value IS NOT NULL AS present FROM readings")
def _f10(spark, d):
    return TS.presence(_r(spark, d), "hourutc", "value")


@check("f11_lag_backfill", _with(READINGS) + f""", l AS (SELECT id, hourutc, municipalityno, lag(value, 2) OVER ({W_KEY}) AS lv FROM readings)
  SELECT id, round(coalesce(lv, first_value(lv IGNORE NULLS) OVER ({W_KEY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6)
  AS value_lag FROM l""")
def _f11(spark, d):
    out = TS.lag_backfill(_r(spark, d), KEY, ORDER, "value", 2, out="value_lag")
    return rounded(out.select("id", "value_lag"))


# --- DCT --------------------------------------------------------------------
def _coef_sql(src: str, keys: str, order: str, col: str, kmax: int) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    kk = f"{keys}, " if keys else ""
    return f"""_s AS (SELECT {kk}{col} AS x, row_number() OVER ({part} ORDER BY {order}) - 1 AS _n,
    count(*) OVER ({part}) AS _len, count(*) FILTER (WHERE {col} IS NULL) OVER ({part}) AS gaps FROM {src}),
  _k AS (SELECT {kk}k, CASE WHEN max(gaps) = 0 THEN 2.0 * sum(x * cos(pi() * k * (2 * _n + 1) / (2 * _len))) END AS coefficient,
    max(_len) AS _len FROM _s, range(0, {kmax + 1}) t(k) WHERE k < _len GROUP BY {kk}k)"""


def _lowpass_sql(src, keys, order, col, cutoff, out, extra=""):
    kk = f"{keys}, " if keys else ""
    join = f"USING ({keys})" if keys else "ON TRUE"
    return _coef_sql(src, keys, order, col, cutoff) + f""",
  _lp AS (SELECT {kk}_n, sum(CASE WHEN k = 0 THEN coefficient * 0.5
      ELSE coefficient * cos(pi() * k * (2 * _n + 1) / (2 * _s._len)) END) / max(_s._len) AS {out}
    FROM _s JOIN (SELECT {kk}k, coefficient FROM _k) c {join} GROUP BY {kk}_n),
  _lpo AS (SELECT _s2.*, _lp.{out} FROM (SELECT *, row_number() OVER ({'PARTITION BY ' + keys if keys else ''} ORDER BY {order}) - 1 AS _n
    FROM {src}) _s2 JOIN _lp ON _s2._n = _lp._n {('AND ' + ' AND '.join(f'_s2.{k} = _lp.{k}' for k in keys.split(', '))) if keys else ''})"""


@check("f12_dct_spectrum", _with(WEATHER, _coef_sql("weather", "", "day", "qty", 15)) +
       "SELECT k, round(coefficient, 4) AS coefficient FROM _k")
def _f12(spark, d):
    out = TS.dct_spectrum(S.weather_daily(spark, d), None, ["day"], "qty", kmax=15)
    return rounded(out, 4)


_USER_DAILY = READINGS + """,
  ud0 AS (SELECT municipalityno, CAST(hourutc AS DATE) AS day, sum(value) AS v, count(value) AS nv FROM readings GROUP BY 1, 2),
  ub AS (SELECT min(day) AS lo, max(day) AS hi FROM ud0 WHERE nv > 0),
  uk AS (SELECT DISTINCT municipalityno FROM ud0 WHERE nv > 0),
  us AS (SELECT municipalityno, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM uk, ub),
  ud AS (SELECT us.municipalityno, us.day, coalesce(ud0.v, 0.0) AS value, ud0.v / ud0.nv AS mean_value
    FROM us LEFT JOIN ud0 ON us.municipalityno = ud0.municipalityno AND us.day = ud0.day)"""


def _user_daily(spark, d):
    r = _r(spark, d)
    s = agg.resample_daily(r, "hourutc", "value", by=KEY, agg="sum", spine="frame")
    m = agg.resample_daily(r, "hourutc", "value", by=KEY, agg="mean", spine="frame", value_col="mean_value")
    return s.join(m, [KEY, "day"])


@check("f12_dct_spectrum_by", _with(_USER_DAILY, _coef_sql("ud", "municipalityno", "day", "value", 5)) +
       "SELECT municipalityno, k, round(coefficient, 4) AS coefficient FROM _k")
def _f12b(spark, d):
    out = TS.dct_spectrum(_user_daily(spark, d).select(KEY, "day", "value"), KEY, ["day"], "value", kmax=5)
    return rounded(out, 4)


# long enough for the transform in groups
@check("f12_dct_spectrum_full", _with(WEATHER, _coef_sql("weather", "", "day", "qty", 2600)) +
       "SELECT k, round(coefficient, 4) AS coefficient FROM _k")
def _f12_full(spark, d):
    return rounded(TS.dct_spectrum_full(S.weather_daily(spark, d), None, ["day"], "qty", short=1000), 4)


@check("f12_dct_spectrum_full_by", _with(_USER_DAILY, _coef_sql("ud", "municipalityno", "day", "value", 2600)) +
       "SELECT municipalityno, k, round(coefficient, 4) AS coefficient FROM _k")
def _f12_full_by(spark, d):
    return rounded(TS.dct_spectrum_full(_user_daily(spark, d).select(KEY, "day", "value"), KEY, ["day"], "value"), 4)


@check("f13_dct_lowpass", _with(WEATHER, _lowpass_sql("weather", "", "day", "qty", 5, "qty_lowpass")) +
       "SELECT day, round(qty_lowpass, 4) AS qty_lowpass FROM _lpo")
def _f13(spark, d):
    out = TS.dct_lowpass(S.weather_daily(spark, d), None, ["day"], "qty", cutoff=5)
    return rounded(out.select("day", "qty_lowpass"), 4)


@check("f13_dct_lowpass_by", _with(_USER_DAILY, _lowpass_sql("ud", "municipalityno", "day", "value", 3, "value_lowpass")) +
       "SELECT municipalityno, day, round(value_lowpass, 4) AS value_lowpass FROM _lpo")
def _f13b(spark, d):
    out = TS.dct_lowpass(_user_daily(spark, d).select(KEY, "day", "value"), KEY, ["day"], "value", cutoff=3)
    return rounded(out.select(KEY, "day", "value_lowpass"), 4)


def _corr_sql(src, keys, order, x, y, width, out="corr"):
    """CTEs ``_m`` (centred) and ``r`` (rows of ``src`` plus ``out``)."""
    o = (width - 1) // 2
    before = width - 1 - o
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""_m AS (SELECT *, {x} - avg({x}) OVER ({part}) AS _cx, {y} - avg({y}) OVER ({part}) AS _cy FROM {src}),
  r AS (SELECT *, round(CASE WHEN count(CASE WHEN _cx IS NOT NULL AND _cy IS NOT NULL THEN 1 END) OVER fr = {width}
    THEN covar_pop(_cx, _cy) OVER fr / nullif(stddev_pop(_cx) OVER fr * stddev_pop(_cy) OVER fr, 0) END, 4) AS {out}
  FROM _m WINDOW fr AS ({part} ORDER BY {order} ROWS BETWEEN {before} PRECEDING AND {o} FOLLOWING))"""


@check("f14_sliding_corr", _with(GAS, WEATHER, "j AS (SELECT day, price, qty FROM gas JOIN weather USING (day))",
                                 _corr_sql("j", "", "day", "price", "qty", 7)) + "SELECT day, corr FROM r")
def _f14(spark, d):
    j = S.gas_daily(spark, d).join(S.weather_daily(spark, d), ["day"])
    out = TS.sliding_corr(j, None, ["day"], "price", "qty", width=7)
    return rounded(out.select("day", "corr"), 4)


@check("f14_sliding_corr_by", _with(_USER_DAILY, _corr_sql("ud", "municipalityno", "day", "value", "mean_value", 4)) +
       "SELECT municipalityno, day, corr FROM r")
def _f14b(spark, d):
    out = TS.sliding_corr(_user_daily(spark, d), KEY, ["day"], "value", "mean_value", width=4)
    return rounded(out.select(KEY, "day", "corr"), 4)


def swc_sql(gas_src: str, wind_src: str, lag: int, cutoff: int, width: int, dct_filter: bool,
            digits: int = 4) -> str:
    """SQL of lag -> (low-pass) -> align -> sliding correlation."""
    lagged = f"""wl AS (SELECT day, lag(wspd, {lag}) OVER (ORDER BY day) AS l FROM {wind_src}),
  wlb AS (SELECT day, coalesce(l, first_value(l IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS wspd FROM wl)"""
    if lag == 0:
        lagged = f"wlb AS (SELECT day, wspd FROM {wind_src})"
    parts = [lagged]
    if dct_filter:
        pl = _lowpass_sql(gas_src, "", "day", "price", cutoff, "pf").replace("_s", "_ps").replace("_k", "_pk") \
            .replace("_lp", "_plp").replace("_plpo", "_plpo")
        wlp = _lowpass_sql("wlb", "", "day", "wspd", cutoff, "wf").replace("_s", "_ws").replace("_k", "_wk") \
            .replace("_lp", "_wlp")
        parts += [pl, wlp, "j AS (SELECT a.day, a.pf AS price, b.wf AS wspd FROM _plpo a JOIN _wlpo b ON a.day = b.day)"]
    else:
        parts += [f"j AS (SELECT a.day, a.price, b.wspd FROM {gas_src} a JOIN wlb b ON a.day = b.day)"]
    return ",\n".join(parts + [_corr_sql("j", "", "day", "price", "wspd", width)]) + \
        f"\nSELECT day, round(price, {digits}) AS price, round(wspd, {digits}) AS wspd, corr FROM r"


_WEATHER_AS_WIND = "wind AS (SELECT day, qty AS wspd FROM weather)"


@check("f15_dct_swc", _with(GAS, WEATHER, _WEATHER_AS_WIND, swc_sql("gas", "wind", 3, 10, 7, True)))
def _f15(spark, d):
    wind = S.weather_daily(spark, d).withColumnRenamed("qty", "wspd")
    out = TS.dct_swc(S.gas_daily(spark, d), wind, swc_width=7, lag=3, dct_cutoff=10, dct_filter=True)
    return rounded(out, 4)


@check("f15_dct_swc_unfiltered", _with(GAS, WEATHER, _WEATHER_AS_WIND, swc_sql("gas", "wind", 2, 0, 4, False, digits=6)))
def _f15b(spark, d):
    wind = S.weather_daily(spark, d).withColumnRenamed("qty", "wspd")
    out = TS.dct_swc(S.gas_daily(spark, d), wind, swc_width=4, lag=2, dct_filter=False)
    return out.select("day", F.round("price", 6).alias("price"), F.round("wspd", 6).alias("wspd"),
                      F.round("corr", 4).alias("corr"))


@check("f1_rolling_mean_w7_min3", _with(READINGS) + f"""SELECT id, round(CASE WHEN count(value) OVER w >= 3
  THEN avg(value) OVER w END, 6) AS value_rolling FROM readings
  WINDOW w AS ({W_KEY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _f1b(spark, d):
    out = TS.rolling_mean(_r(spark, d), KEY, ORDER, "value", window=7, min_periods=3)
    return rounded(out.select("id", "value_rolling"))


@check("f7_bfill_all", _with(READINGS) + f"""SELECT id, round(coalesce(value,
  first_value(value IGNORE NULLS) OVER ({W_KEY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS value
  FROM readings""")
def _f7b(spark, d):
    return rounded(TS.bfill(_r(spark, d), KEY, ORDER, "value").select("id", "value"))
