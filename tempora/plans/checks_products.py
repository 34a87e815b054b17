"""Checks for the composite data products (H1-H12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.operators import timeseries as TS
from tempora.plans import products as H
from tempora.plans import standins as S
from tempora.plans.checks_relational import EXCH, GAS, MUNI, READINGS, WEATHER, _with
from tempora.plans.checks_series import (READINGS2, _interp_sql, _lowpass_sql, _readings2,
                                         swc_sql)
from tempora.plans.registry import check, rounded

KEY = "municipalityno"
ORDER = ["hourutc", "id"]

# daily frame of the map page: duplicates averaged, days summed / averaged,
# every key on every day between the frame's first and last valued day
_DAILY = """,
  _p AS (SELECT municipalityno, hourutc, avg(value) AS v FROM readings GROUP BY 1, 2),
  _dd AS (SELECT municipalityno, CAST(hourutc AS DATE) AS day, {agg}(v) AS v, count(v) AS nv FROM _p GROUP BY 1, 2),
  _b AS (SELECT min(day) AS lo, max(day) AS hi FROM _dd WHERE nv > 0),
  _kk AS (SELECT DISTINCT municipalityno FROM _dd WHERE nv > 0),
  _sp AS (SELECT municipalityno, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM _kk, _b),
  daily AS (SELECT _sp.municipalityno, _sp.day, {fill} AS value
    FROM _sp LEFT JOIN _dd ON _sp.municipalityno = _dd.municipalityno AND _sp.day = _dd.day)"""
DAILY_SUM = _DAILY.format(agg="sum", fill="coalesce(_dd.v, 0.0)")
DAILY_MEAN = _DAILY.format(agg="avg", fill="_dd.v")


def _muni(spark, d):
    return S.municipalities(spark, d)


@check("h1_map_frame_sum", _with(READINGS, MUNI) + DAILY_SUM + """
  SELECT daily.municipalityno, day, round(value, 6) AS value,
    round(CASE WHEN value >= 0 THEN sqrt(value) END, 6) AS dot_size, strftime(day, '%Y-%m-%d') AS date,
    m.name, m.region, round(m.latitude, 6) AS latitude, round(m.longitude, 6) AS longitude
  FROM daily JOIN muni m ON daily.municipalityno = m.code""")
def _h1(spark, d):
    return rounded(H.map_frame(S.readings(spark, d), _muni(spark, d), "hourutc", KEY, "value", "code", "sum"))


@check("h1_map_frame_mean", _with(READINGS, MUNI) + DAILY_MEAN + """
  SELECT daily.municipalityno, day, round(value, 6) AS value,
    round((value - (SELECT min(value) FROM daily)) / (((SELECT max(value) FROM daily) - (SELECT min(value) FROM daily)) * 10), 6) AS dot_size,
    strftime(day, '%Y-%m-%d') AS date,
    m.name, m.region, round(m.latitude, 6) AS latitude, round(m.longitude, 6) AS longitude
  FROM daily JOIN muni m ON daily.municipalityno = m.code""")
def _h1b(spark, d):
    return rounded(H.map_frame(S.readings(spark, d), _muni(spark, d), "hourutc", KEY, "value", "code", "mean"))


@check("h2_line_frame", _with(READINGS, MUNI) + DAILY_SUM + ", " +
       _lowpass_sql("daily", "municipalityno", "day", "value", 5, "idct") +
       """ SELECT _lpo.municipalityno, day, round(value, 6) AS value, round(idct, 4) AS idct
  FROM _lpo JOIN muni m ON _lpo.municipalityno = m.code""")
def _h2(spark, d):
    mf = H.map_frame(S.readings(spark, d), _muni(spark, d), "hourutc", KEY, "value", "code", "sum")
    out = H.line_frame(mf, KEY, "value", code=None, cutoff=5)
    return out.select(KEY, "day", F.round("value", 6).alias("value"), F.round("idct", 4).alias("idct"))


_LAT = " ".join(f"WHEN '{k}' THEN {v[0]}" for k, v in S.LINK_COORDS.items())
_LON = " ".join(f"WHEN '{k}' THEN {v[1]}" for k, v in S.LINK_COORDS.items())


@check("h3_exchange_frame", _with(EXCH) + f""",
  _p AS (SELECT link, hourutc, avg(net_qty) AS v FROM exch GROUP BY 1, 2),
  _dd AS (SELECT link, CAST(hourutc AS DATE) AS day, sum(v) AS v, count(v) AS nv FROM _p GROUP BY 1, 2),
  _b AS (SELECT min(day) AS lo, max(day) AS hi FROM _dd WHERE nv > 0),
  _kk AS (SELECT DISTINCT link FROM _dd WHERE nv > 0),
  _sp AS (SELECT link, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM _kk, _b),
  daily AS (SELECT _sp.link, _sp.day, coalesce(_dd.v, 0.0) AS net_qty FROM _sp LEFT JOIN _dd ON _sp.link = _dd.link AND _sp.day = _dd.day),
  pk AS (SELECT link, max(abs(net_qty)) AS peak FROM daily GROUP BY 1),
  f AS (SELECT daily.*, peak, abs(net_qty) / nullif(peak, 0) AS share FROM daily JOIN pk USING (link))
  SELECT link, day, round(net_qty, 6) AS net_qty, round(share, 6) AS share,
    CASE WHEN net_qty >= 0 THEN 'Net import' ELSE 'Net export' END AS direction,
    CASE WHEN share > 0.95 THEN 'red' WHEN share > 0.8 THEN 'yellow' ELSE 'green' END AS alert,
    round(peak - abs(net_qty), 6) AS remaining,
    CAST(CASE link {_LAT} END AS DOUBLE) AS latitude, CAST(CASE link {_LON} END AS DOUBLE) AS longitude,
    round(pow(abs(net_qty), 1.0 / 3.0), 6) AS size, strftime(day, '%Y-%m-%d') AS date FROM f""")
def _h3(spark, d):
    return rounded(H.exchange_frame(S.exchange_hourly(spark, d), "hourutc", "link", "net_qty", S.LINK_COORDS))


@check("h4_exchange_stats", _with(EXCH) + """,
  h AS (SELECT hourutc, coalesce(sum(net_qty), 0.0) AS v FROM exch GROUP BY 1),
  st AS (SELECT avg(v) AS m, stddev_samp(v) AS s FROM h),
  r AS (SELECT v, row_number() OVER (ORDER BY v) AS rn, count(*) OVER () AS n FROM h),
  t AS (SELECT avg(v) AS tm FROM r WHERE rn > floor(n * 0.05) AND rn <= n - floor(n * 0.05)),
  md AS (SELECT median(v) AS med FROM h),
  ma AS (SELECT median(abs(v - med)) AS mad FROM h, md)
  SELECT round(m, 6) AS mean, round(s, 6) AS std, round(m - 3 * s, 6) AS lower, round(m + 3 * s, 6) AS upper,
    round(tm, 6) AS trimmed_mean, round(mad, 6) AS mad, round(mad * 1.4826, 6) AS mad_scaled FROM st, t, ma""")
def _h4(spark, d):
    return rounded(H.exchange_stats(S.exchange_hourly(spark, d), "hourutc", "net_qty"))


@check("h5_sync_to_daily", _with(READINGS, GAS) + """,
  dd AS (SELECT municipalityno, CAST(hourutc AS DATE) AS day, avg(value) AS v FROM readings GROUP BY 1, 2),
  b AS (SELECT municipalityno, min(day) AS lo, max(day) AS hi FROM dd GROUP BY 1),
  s AS (SELECT municipalityno, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
  w AS (SELECT s.municipalityno, s.day, dd.v AS value FROM s LEFT JOIN dd ON s.municipalityno = dd.municipalityno AND s.day = dd.day)
  SELECT w.municipalityno, w.day, round(w.value, 6) AS value, round(gas.price, 6) AS price FROM w JOIN gas ON w.day = CAST(gas.day + INTERVAL 25 YEAR AS DATE)""")
def _h5(spark, d):
    # readings cover 2024-01 and order days end in 2001: prices are taken 25 years on
    gas = S.gas_daily(spark, d).withColumn("day", F.add_months("day", 300))
    out = H.sync_to_daily(S.readings(spark, d), gas, "hourutc", KEY, "value", "price")
    return rounded(out)


@check("h5_sync_to_daily_lines", _with(GAS) + """,
  li AS (SELECT l_suppkey, l_shipdate, l_quantity FROM lineitem),
  dd AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, avg(l_quantity) AS v FROM li GROUP BY 1, 2),
  b AS (SELECT l_suppkey, min(day) AS lo, max(day) AS hi FROM dd GROUP BY 1),
  s AS (SELECT l_suppkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
  w AS (SELECT s.l_suppkey, s.day, dd.v AS l_quantity FROM s LEFT JOIN dd ON s.l_suppkey = dd.l_suppkey AND s.day = dd.day)
  SELECT w.l_suppkey, w.day, round(w.l_quantity, 6) AS l_quantity, round(gas.price, 6) AS price FROM w JOIN gas ON w.day = gas.day""")
def _h5b(spark, d):
    li = S.table(spark, d, "lineitem")
    out = H.sync_to_daily(li, S.gas_daily(spark, d), "l_shipdate", "l_suppkey", "l_quantity", "price")
    return rounded(out)


_WIND = """,
  _hwd AS (SELECT CAST(l_shipdate AS DATE) AS day, avg(l_quantity) AS v FROM lineitem GROUP BY 1),
  _hwb AS (SELECT min(day) AS lo, max(day) AS hi FROM _hwd),
  _hws AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM _hwb),
  wind AS (SELECT _hws.day, _hwd.v AS wspd FROM _hws LEFT JOIN _hwd ON _hws.day = _hwd.day
    WHERE _hws.day >= (SELECT min(day) FROM gas) AND _hws.day <= (SELECT max(day) FROM gas))"""


@check("h6_wind_daily", _with(GAS) + _WIND + " SELECT day, round(wspd, 6) AS l_quantity FROM wind")
def _h6(spark, d):
    li = S.table(spark, d, "lineitem")
    return rounded(H.wind_daily(li, "l_shipdate", "l_quantity", S.gas_daily(spark, d), "day"))


@check("h7_correlation_frame", _with(GAS) + _WIND + ",\n" + swc_sql("gas", "wind", 7, 5, 7, True))
def _h7(spark, d):
    li = S.table(spark, d, "lineitem")
    out = H.correlation_frame(S.gas_daily(spark, d), li, "l_shipdate", "l_quantity")
    return rounded(out.withColumnRenamed("l_quantity", "wspd"), 4)


@check("h8_consumption_summary", _with(READINGS, MUNI) + """SELECT m.name AS municipality, round(sum(r.value), 6) AS sum_value
  FROM readings r LEFT JOIN muni m ON r.municipalityno = m.code WHERE m.name IS NOT NULL GROUP BY 1""")
def _h8(spark, d):
    out = H.consumption_summary(S.readings(spark, d), _muni(spark, d), KEY, "code", "name",
                                "municipality", "sum", "value")
    return rounded(out)


@check("h8_consumption_grouped", _with(READINGS, MUNI) + """SELECT r.branche, m.name AS municipality,
  round(coalesce(sum(r.value), 0.0), 6) AS sum_value
  FROM readings r LEFT JOIN muni m ON r.municipalityno = m.code WHERE m.name IS NOT NULL GROUP BY 1, 2""")
def _h8b(spark, d):
    out = H.consumption_grouped(S.readings(spark, d), _muni(spark, d), KEY, "code", "name", "branche", "value")
    return rounded(out)


W_KEY = "PARTITION BY municipalityno ORDER BY hourutc, id"


@check("h9_clean_production", _with(READINGS) + f""",
  z AS (SELECT id, hourutc, municipalityno, branche,
    CASE WHEN count(value) OVER (PARTITION BY municipalityno) = 0 THEN 0.0 ELSE value END AS value FROM readings),
  z2 AS (SELECT id, hourutc, municipalityno, branche,
    CASE WHEN municipalityno = 7 THEN coalesce(value, 0.0) ELSE value END AS value FROM z),
  z3 AS (SELECT id, hourutc, municipalityno, branche, CASE WHEN municipalityno = 11 THEN coalesce(value,
    CASE WHEN count(value) OVER w >= 1 THEN avg(value) OVER w END) ELSE value END AS value FROM z2
    WINDOW w AS ({W_KEY} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
  z4 AS (SELECT * FROM z3 WHERE municipalityno = 12) """ +
       _interp_sql("z4", ["value"], f"CAST(row_number() OVER ({W_KEY}) - 1 AS DOUBLE)").replace(
           "SELECT id, round(coalesce(value,", "SELECT id, municipalityno, round(coalesce(value,") +
       " UNION ALL SELECT id, municipalityno, round(value, 6) AS value FROM z3 WHERE municipalityno <> 12")
def _h9(spark, d):
    out = H.clean_production(S.readings(spark, d), KEY, ORDER, ["value"], zero_fill_key=7,
                             rolling={11: "value"}, interpolate={12: "value"})
    return rounded(out.select("id", KEY, "value"))


@check("h10_clean_weather", _with(READINGS2) +
       _interp_sql("readings2", ["value", "value2"], f"CAST(row_number() OVER ({W_KEY}) - 1 AS DOUBLE)").replace(
           "SELECT id, round(coalesce(value,", "SELECT id, municipalityno, hourutc, round(coalesce(value,").replace(
           "  SELECT id, municipalityno", ", i AS (SELECT id, municipalityno", 1) + f"""),
  c AS (SELECT *, count(*) FILTER (WHERE value IS NULL) OVER (PARTITION BY municipalityno) AS nn,
    first_value(value IGNORE NULLS) OVER ({W_KEY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nx FROM i)
  SELECT id, round(coalesce(value, CASE WHEN nn <= 1 THEN nx END), 6) AS value, value2 FROM c""")
def _h10(spark, d):
    out = H.clean_weather(_readings2(spark, d), KEY, ORDER, ["value", "value2"], bfill_col="value", max_nulls=1)
    return rounded(out.select("id", "value", "value2"))


def _gas_with_gaps(spark, d):
    g = S.gas_daily(spark, d)
    return g.withColumn("price", F.when(F.dayofmonth("day") % 9 == 0, F.lit(None)).otherwise(F.col("price")))


@check("h12_clean_gas", _with(GAS) + """,
  g AS (SELECT day, CASE WHEN dayofmonth(day) % 9 = 0 THEN NULL ELSE price END AS price FROM gas)
  SELECT day, round(coalesce(price, CASE WHEN count(price) OVER w >= 1 THEN avg(price) OVER w END), 6) AS price
  FROM g WINDOW w AS (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _h12(spark, d):
    return rounded(H.clean_gas(_gas_with_gaps(spark, d), ["day"], ["price"]))
