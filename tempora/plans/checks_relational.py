"""Checks for sources, columns, joins, aggregation and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.operators import aggregate as agg
from tempora.plans import standins as S
from tempora.plans.registry import check, rounded


# --- flagship: daily net flow, mean / sd, +-3 sigma outlier days -------------
FLAGSHIP_SQL = """
WITH d AS (
  SELECT CAST(l_shipdate AS DATE) AS day,
         SUM(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END) AS v
  FROM lineitem GROUP BY 1),
b AS (SELECT min(day) AS lo, max(day) AS hi FROM d),
s AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
f AS (SELECT s.day, coalesce(d.v, 0.0) AS net_qty FROM s LEFT JOIN d ON s.day = d.day),
st AS (SELECT avg(net_qty) AS m, stddev_samp(net_qty) AS sd FROM f)
SELECT day, round(net_qty, 6) AS net_qty,
       (net_qty < m - 3 * sd OR net_qty > m + 3 * sd) AS is_outlier
FROM f, st
"""


def daily_net_flow(spark, sf_dir):
    lines = S.signed_lines(spark, sf_dir)
    daily = agg.resample_daily(lines, "l_shipdate", "net_qty", agg="sum")
    return rounded(agg.flag_outliers(daily, "net_qty", k=3.0))


check("daily_net_flow_outliers", FLAGSHIP_SQL)(daily_net_flow)


# ---------------------------------------------------------------------------
# SQL text of the stand-in frames (same expressions as tempora.plans.standins)
READINGS = """readings AS (
  SELECT event_id AS id, ts AS hourutc, user_id AS municipalityno, event_type AS branche,
         CASE WHEN event_id % 7 = 0 OR user_id % 10 = 3 THEN NULL ELSE value END AS value
  FROM events)"""
MUNI = """muni AS (
  SELECT c_custkey AS code, c_name AS name, r_name AS region,
         54.0 + CAST((c_custkey * 37) % 400 AS DOUBLE) / 100.0 AS latitude,
         8.0 + CAST((c_custkey * 53) % 700 AS DOUBLE) / 100.0 AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
STATIONS = """stations AS (
  SELECT s_suppkey AS station_id,
         54.0 + CAST((s_suppkey * 71) % 400 AS DOUBLE) / 100.0 AS latitude,
         8.0 + CAST((s_suppkey * 29) % 700 AS DOUBLE) / 100.0 AS longitude
  FROM supplier)"""
GAS = """gas AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS price
  FROM orders GROUP BY 1)"""
WEATHER = """weather AS (SELECT CAST(l_shipdate AS DATE) AS day, avg(l_quantity) AS qty
  FROM lineitem GROUP BY 1)"""
LINES = """lines AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate,
  CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS net_qty FROM lineitem)"""
EXCH = LINES + """,
exch AS (SELECT l_shipdate AS hourutc, r_name AS link, net_qty FROM lines
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def _with(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


def reg(name, sql=None):
    return check(name, sql)


# --- B: projections, casts, predicates --------------------------------------
from tempora.functions import columns as B  # noqa: E402
from tempora.functions import scalar as C  # noqa: E402
from tempora.operators import joins as D  # noqa: E402
from tempora.operators import setops as G  # noqa: E402


@reg("b1_select_columns", _with(READINGS) + "SELECT id, hourutc, value FROM readings")
def _b1(spark, d):
    return B.select_columns(S.readings(spark, d), ["id", "hourutc", "value"])


@reg("b2_normalise_names",
     "SELECT c_custkey AS code, c_name AS municipality, c_nationkey, c_acctbal AS total_area FROM customer")
def _b2(spark, d):
    return B.normalise_names(S.table(spark, d, "customer"),
                             rename={"c_custkey": "Code", "c_name": "Municipality",
                                     "c_acctbal": "Total_Area"},
                             drop=["c_mktsegment"])


@reg("b3_cast_columns", """SELECT event_id, CAST(ts AS DATE) AS ts,
  TRY_CAST(regexp_extract(props, '"k": (\\w+)', 1) AS INTEGER) AS k FROM events""")
def _b3(spark, d):
    ev = S.table(spark, d, "events").select(
        "event_id", "ts", F.regexp_extract("props", r'"k": (\w+)', 1).alias("k"))
    return B.cast_columns(ev, {"ts": "date", "k": "int"}, safe=True)


@reg("b4_where_equal", _with(READINGS) + "SELECT * FROM readings WHERE branche = 'purchase'")
def _b4(spark, d):
    return B.where_equal(S.readings(spark, d), {"branche": "purchase"})


@reg("b5_where_in", "SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'N')")
def _b5(spark, d):
    return B.where_in(S.table(spark, d, "lineitem"), "l_returnflag", ["A", "N"])


@reg("b5_where_not_in_frame", """SELECT * FROM orders WHERE o_custkey NOT IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _b5b(spark, d):
    c = S.table(spark, d, "customer")
    return B.where_in(S.table(spark, d, "orders"), "o_custkey",
                      c.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey"), negate=True)


@reg("b6_is_absent", _with(READINGS) + """SELECT
  count(*) FILTER (WHERE value IS NOT NULL AND municipalityno % 10 = 3) = 0 AS absent FROM readings""")
def _b6(spark, d):
    r = S.readings(spark, d)
    return B.is_absent(r, F.col("value").isNotNull() & (F.col("municipalityno") % 10 == 3))


@reg("b7_clip_to_span", _with(GAS, WEATHER) + """SELECT day, round(qty, 6) AS qty FROM weather
  WHERE day >= (SELECT min(day) FROM gas) AND day <= (SELECT max(day) FROM gas)""")
def _b7(spark, d):
    return rounded(B.clip_to_span(S.weather_daily(spark, d), "day", S.gas_daily(spark, d), "day"))


@reg("b8_split_at", _with(READINGS) + """SELECT id, hourutc,
  CASE WHEN hourutc < TIMESTAMP '2024-01-20 00:00:00' THEN 'train' ELSE 'test' END AS part FROM readings""")
def _b8(spark, d):
    r = S.readings(spark, d).select("id", "hourutc")
    train, test = B.split_at(r, "hourutc", "2024-01-20 00:00:00")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@reg("b8_window_before", """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1999-11-01' AND l_shipdate < TIMESTAMP '2000-01-01'""")
def _b8b(spark, d):
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return B.window_before(li, "l_shipdate", "2000-01-01 00:00:00", months=2)


@reg("b9_price_area", _with(MUNI) + """SELECT code, region,
  CASE WHEN region IN ('EUROPE', 'ASIA') THEN 'DK2' ELSE 'DK1' END AS price_area FROM muni""")
def _b9(spark, d):
    m = S.municipalities(spark, d)
    return m.select("code", "region", B.price_area("region", ("EUROPE", "ASIA")).alias("price_area"))


@reg("b10_update_where", _with(READINGS) + """SELECT id, branche,
  CASE WHEN branche = 'error' AND value IS NULL THEN 0.0 ELSE value END AS value FROM readings""")
def _b10(spark, d):
    r = S.readings(spark, d).select("id", "branche", "value")
    return B.update_where(r, (F.col("branche") == "error") & F.col("value").isNull(), "value", 0.0)


@reg("b11_measures_long", """SELECT l_orderkey, l_linenumber, measure, value FROM (
  UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
  ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME measure VALUE value)""")
def _b11(spark, d):
    li = S.table(spark, d, "lineitem")
    return B.measures_long(li, ["l_orderkey", "l_linenumber"], ignore=["l_partkey", "l_suppkey"])


@reg("b12_lookup_coordinates", _with(MUNI, STATIONS) + """SELECT code, name FROM muni
  WHERE EXISTS (SELECT 1 FROM stations s WHERE s.latitude = muni.latitude AND s.longitude = muni.longitude)""")
def _b12(spark, d):
    m = S.municipalities(spark, d)
    return B.lookup_many(m, S.stations(spark, d), ["latitude", "longitude"]).select("code", "name")


@reg("b13_attach_constants", _with(READINGS) + """SELECT id, value, 'events' AS source,
  0.0 AS distance_to_station FROM readings""")
def _b13(spark, d):
    r = S.readings(spark, d).select("id", "value")
    return B.attach_constants(r, {"source": "events", "distance_to_station": 0.0})


# --- C: scalar functions ----------------------------------------------------
@reg("c1_abs_sqrt_cbrt", _with(LINES) + """SELECT l_orderkey, l_linenumber,
  abs(net_qty) AS abs_qty, round(sqrt(abs(net_qty)), 6) AS sqrt_qty,
  round(pow(abs(net_qty), 1.0 / 3.0), 6) AS cbrt_qty FROM lines""")
def _c1(spark, d):
    li = S.signed_lines(spark, d)
    return rounded(li.select("l_orderkey", "l_linenumber", F.abs("net_qty").alias("abs_qty"),
                             F.sqrt(F.abs("net_qty")).alias("sqrt_qty"),
                             C.cube_root_abs("net_qty").alias("cbrt_qty")))


@reg("c2_minmax_scale", _with(WEATHER) + """SELECT day, round(qty, 6) AS qty,
  round((qty - (SELECT min(qty) FROM weather)) /
        (((SELECT max(qty) FROM weather) - (SELECT min(qty) FROM weather)) * 10), 6) AS dot_size
  FROM weather""")
def _c2(spark, d):
    return rounded(C.minmax_scale(S.weather_daily(spark, d), "qty", "dot_size"))


@reg("c3_date_label", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS label FROM orders")
def _c3(spark, d):
    o = S.table(spark, d, "orders")
    return o.select("o_orderkey", C.date_label("o_orderdate").alias("label"))


@reg("c4_to_day", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _c4(spark, d):
    return S.table(spark, d, "events").select("event_id", C.to_day("ts").alias("day"))


@reg("c5_date_arithmetic", """SELECT o_orderkey, o_orderdate - INTERVAL 1 DAY AS day_before,
  CAST(o_orderdate - INTERVAL 2 MONTH AS DATE) AS two_months_before FROM orders""")
def _c5(spark, d):
    o = S.table(spark, d, "orders")
    return o.select("o_orderkey", C.minus_days("o_orderdate", 1).alias("day_before"),
                    C.minus_months("o_orderdate", 2).alias("two_months_before"))


@reg("c6_strings", """SELECT p_partkey,
  upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS cap_name,
  lower(p_brand) AS brand, split_part(p_name, ' ', 2) AS noun,
  p_type || '/' || p_brand AS type_brand FROM part""")
def _c6(spark, d):
    p = S.table(spark, d, "part")
    return p.select("p_partkey", C.capitalize("p_name").alias("cap_name"),
                    F.lower("p_brand").alias("brand"), C.split_part("p_name", " ", 2).alias("noun"),
                    F.concat("p_type", F.lit("/"), "p_brand").alias("type_brand"))


_LINK_SQL = " ".join(f"WHEN '{k}' THEN {v[0]}" for k, v in S.LINK_COORDS.items())
_LINK_SQL_LON = " ".join(f"WHEN '{k}' THEN {v[1]}" for k, v in S.LINK_COORDS.items())


@reg("c7_map_lookup", _with(EXCH) + f"""SELECT DISTINCT link,
  CAST(CASE link {_LINK_SQL} END AS DOUBLE) AS latitude,
  CAST(CASE link {_LINK_SQL_LON} END AS DOUBLE) AS longitude FROM exch""")
def _c7(spark, d):
    e = S.exchange_hourly(spark, d).select("link").distinct()
    return e.select("link", C.map_lookup("link", {k: v[0] for k, v in S.LINK_COORDS.items()}).alias("latitude"),
                    C.map_lookup("link", {k: v[1] for k, v in S.LINK_COORDS.items()}).alias("longitude"))


_HAV = """2 * 6371000.0 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
  + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))"""


@reg("c8_haversine", _with(MUNI) + "SELECT code, round(" +
     _HAV.format(lat1="latitude", lon1="longitude", lat2="55.6761", lon2="12.5683") +
     ", 3) AS distance_m FROM muni")
def _c8(spark, d):
    m = S.municipalities(spark, d)
    lat, lon = S.CENTRAL_POINT
    return m.select("code", F.round(C.haversine_m("latitude", "longitude", F.lit(lat), F.lit(lon)), 3)
                    .alias("distance_m"))


@reg("c9_row_key", _with(READINGS) + """SELECT id,
  sha256(CAST(municipalityno AS VARCHAR) || chr(1) || CAST(id AS VARCHAR)) AS row_key FROM readings""")
def _c9(spark, d):
    r = S.readings(spark, d)
    return r.select("id", C.row_key("municipalityno", "id").alias("row_key"))


@reg("c10_round", _with(GAS) + """SELECT year(day) AS year, round(stddev_samp(price), 1) AS sd1,
  round(stddev_samp(price), 3) AS sd3 FROM gas GROUP BY 1""")
def _c10(spark, d):
    g = S.gas_daily(spark, d).groupBy(F.year("day").alias("year")).agg(F.stddev_samp("price").alias("sd"))
    return g.select("year", C.rounded("sd", 1).alias("sd1"), C.rounded("sd", 3).alias("sd3"))


# --- D: joins ---------------------------------------------------------------
@reg("d1_join_on_time", _with(GAS, WEATHER) + """SELECT day, round(price, 6) AS price, round(qty, 6) AS qty
  FROM gas JOIN weather USING (day)""")
def _d1(spark, d):
    return rounded(D.join_on_time(S.gas_daily(spark, d), S.weather_daily(spark, d), "day"))


@reg("d2_left_dim_join", _with(READINGS, MUNI) + """SELECT r.id, r.municipalityno, m.name AS municipality
  FROM readings r LEFT JOIN muni m ON r.municipalityno = m.code""")
def _d2(spark, d):
    r = S.readings(spark, d).select("id", "municipalityno")
    m = S.municipalities(spark, d).select("code", "name")
    return D.dim_join(r, m, "municipalityno", "code", "left", rename={"name": "municipality"})


@reg("d3_inner_dim_join", _with(READINGS, MUNI) + """SELECT r.id, r.municipalityno, m.name
  FROM readings r JOIN (SELECT * FROM muni WHERE region = 'EUROPE') m ON r.municipalityno = m.code""")
def _d3(spark, d):
    r = S.readings(spark, d).select("id", "municipalityno")
    m = S.municipalities(spark, d).filter(F.col("region") == "EUROPE").select("code", "name")
    return D.dim_join(r, m, "municipalityno", "code", "inner")


@reg("d4_anti_join", _with(READINGS) + """SELECT id, hourutc FROM readings
  WHERE hourutc >= TIMESTAMP '2024-01-15' AND id NOT IN
  (SELECT id FROM readings WHERE hourutc < TIMESTAMP '2024-01-20')""")
def _d4(spark, d):
    r = S.readings(spark, d).select("id", "hourutc")
    new = r.filter(F.col("hourutc") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    old = r.filter(F.col("hourutc") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return D.anti_join(new, old, ["id"])


@reg("d5_nearest_station", _with(MUNI, STATIONS) + """SELECT code, arg_min(station_id, (d, station_id)) AS station_id,
  round(min(d), 3) AS distance_m FROM (
  SELECT m.code, s.station_id, """ + _HAV.format(lat1="m.latitude", lon1="m.longitude",
                                               lat2="s.latitude", lon2="s.longitude") + """ AS d
  FROM muni m, stations s) GROUP BY code""")
def _d5(spark, d):
    out = D.nearest(S.municipalities(spark, d), S.stations(spark, d), "code", "station_id", cell_deg=0.5)
    return out.withColumn("distance_m", F.round("distance_m", 3))


@reg("d5_nearest_k3", _with(MUNI, STATIONS) + """SELECT code, station_id, rank, round(d, 3) AS distance_m FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY d, station_id) AS rank FROM (
  SELECT m.code, s.station_id, """ + _HAV.format(lat1="m.latitude", lon1="m.longitude",
                                               lat2="s.latitude", lon2="s.longitude") + """ AS d
  FROM muni m, stations s)) WHERE rank <= 3""")
def _d5_k3(spark, d):
    out = D.nearest(S.municipalities(spark, d), S.stations(spark, d), "code", "station_id", cell_deg=None, k=3)
    return out.withColumn("distance_m", F.round("distance_m", 3))


@reg("d6_enrich", """SELECT c_custkey, c_name, coalesce(a.acct, c_acctbal) AS c_acctbal, a.n_orders
  FROM customer LEFT JOIN (SELECT o_custkey, round(max(o_totalprice) / 1000.0, 6) AS acct, count(*) AS n_orders
  FROM orders GROUP BY 1) a ON c_custkey = a.o_custkey""")
def _d6(spark, d):
    c = S.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    a = (S.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
         .agg(F.round(F.max("o_totalprice") / 1000.0, 6).alias("c_acctbal"),
              F.count(F.lit(1)).alias("n_orders")))
    return D.enrich(c, a, "c_custkey")


@reg("d7_geocode_join", _with(MUNI) + """SELECT q.query, g.lat AS latitude, g.lon AS longitude FROM
  (SELECT '  ' || upper(c_name) || ' ' AS query FROM customer) q LEFT JOIN
  (SELECT lower(trim(name)) AS gname, min((latitude, longitude)) AS c FROM muni WHERE region <> 'AFRICA' GROUP BY 1) g0
  ON lower(trim(q.query)) = g0.gname
  LEFT JOIN LATERAL (SELECT g0.c[1] AS lat, g0.c[2] AS lon) g ON TRUE""")
def _d7(spark, d):
    q = S.table(spark, d, "customer").select(
        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("query"))
    gaz = S.municipalities(spark, d).filter(F.col("region") != "AFRICA")
    return D.geocode_join(q, "query", gaz, "name")


@reg("d8_align_series", _with(GAS, WEATHER) + """SELECT w.day, round(w.qty, 6) AS qty, round(g.price, 6) AS price
  FROM weather w JOIN gas g ON w.day = g.day""")
def _d8(spark, d):
    return rounded(D.align_series(S.weather_daily(spark, d), S.gas_daily(spark, d)))


# --- E: aggregation ---------------------------------------------------------
@reg("e1_group_sum", _with(READINGS) + """SELECT municipalityno, round(coalesce(sum(value), 0.0), 6) AS value
  FROM readings WHERE municipalityno IS NOT NULL GROUP BY 1""")
def _e1(spark, d):
    return rounded(agg.group_sum(S.readings(spark, d), "municipalityno", "value"))


_E2_SQL = {"mean": "avg", "sum": "sum", "max": "max", "min": "min", "median": "median",
           "count": "count", "std": "stddev_samp"}


def _e2_factory(a):
    def fn(spark, d):
        return rounded(agg.group_agg(S.readings(spark, d), "branche", a, "value",
                                     allowed=["branche", "municipalityno"]))
    return fn


for _a, _f in _E2_SQL.items():
    _expr = f"{_f}(value)" if _a == "count" else f"round({_f}(value), 6)"
    reg(f"e2_group_agg_{_a}", _with(READINGS) +
        f"SELECT branche, {_expr} AS {_a}_value FROM readings WHERE branche IS NOT NULL GROUP BY 1")(_e2_factory(_a))


@reg("e3_grouped_sum", _with(READINGS) + """SELECT municipalityno, branche,
  round(coalesce(sum(value), 0.0), 6) AS sum_value FROM readings GROUP BY 1, 2""")
def _e3(spark, d):
    return rounded(agg.grouped_sum(S.readings(spark, d), "municipalityno", "value",
                                   opposite={"municipalityno": "branche", "branche": "municipalityno"}))


@reg("e4_mean_std", _with(READINGS) + """SELECT branche, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS std FROM readings GROUP BY 1""")
def _e4(spark, d):
    return rounded(agg.mean_std(S.readings(spark, d), "value", "branche"))


_TRIM = """r AS (SELECT {keys} value, row_number() OVER (PARTITION BY {part} ORDER BY value) AS rn,
  count(*) OVER (PARTITION BY {part}) AS n FROM readings WHERE value IS NOT NULL)"""


@reg("e5_trimmed_mean", _with(READINGS, _TRIM.format(keys="", part="1")) +
     "SELECT round(avg(value), 6) AS trimmed_mean FROM r WHERE rn > floor(n * 0.05) AND rn <= n - floor(n * 0.05)")
def _e5(spark, d):
    return rounded(agg.trimmed_mean(S.readings(spark, d), "value", 0.05))


@reg("e5_trimmed_mean_by", _with(READINGS, _TRIM.format(keys="branche,", part="branche")) +
     """SELECT branche, round(avg(value), 6) AS trimmed_mean FROM r
  WHERE rn > floor(n * 0.05) AND rn <= n - floor(n * 0.05) GROUP BY 1""")
def _e5b(spark, d):
    return rounded(agg.trimmed_mean(S.readings(spark, d), "value", 0.05, by="branche"))


@reg("e6_mad", _with(READINGS) + """, m AS (SELECT median(value) AS med FROM readings)
  SELECT round(median(abs(value - med)), 6) AS mad, round(median(abs(value - med)) * 1.4826, 6) AS mad_scaled
  FROM readings, m WHERE value IS NOT NULL""")
def _e6(spark, d):
    return rounded(agg.mad(S.readings(spark, d), "value"))


@reg("e6_mad_by", _with(READINGS) + """, m AS (SELECT branche, median(value) AS med FROM readings GROUP BY 1)
  SELECT branche, round(median(abs(value - med)), 6) AS mad, round(median(abs(value - med)) * 1.4826, 6) AS mad_scaled
  FROM readings JOIN m USING (branche) WHERE value IS NOT NULL GROUP BY 1""")
def _e6b(spark, d):
    return rounded(agg.mad(S.readings(spark, d), "value", by="branche"))


_EXCH_DAILY = EXCH + """,
xd0 AS (SELECT link, CAST(hourutc AS DATE) AS day, sum(net_qty) AS net_qty FROM exch GROUP BY 1, 2),
xb AS (SELECT link, min(day) AS lo, max(day) AS hi FROM xd0 GROUP BY 1),
xs AS (SELECT link, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM xb),
xd AS (SELECT xs.link, xs.day, coalesce(xd0.net_qty, 0.0) AS net_qty FROM xs
       LEFT JOIN xd0 ON xs.link = xd0.link AND xs.day = xd0.day)"""

_SPC_COLS = """round(c, 6) AS centre, round(s, 6) AS spread,
  round(c - s, 6) AS lower_1, round(c + s, 6) AS upper_1, round(c - 2 * s, 6) AS lower_2,
  round(c + 2 * s, 6) AS upper_2, round(c - 3 * s, 6) AS lower, round(c + 3 * s, 6) AS upper"""


def _exch_daily(spark, d):
    return agg.resample_daily(S.exchange_hourly(spark, d), "hourutc", "net_qty", by="link",
                              agg="sum", spine="key")


@reg("e7_spc_limits", _with(_EXCH_DAILY) + "SELECT link, " + _SPC_COLS +
     " FROM (SELECT link, avg(net_qty) AS c, stddev_samp(net_qty) AS s FROM xd GROUP BY 1)")
def _e7(spark, d):
    return rounded(agg.spc_limits(_exch_daily(spark, d), "net_qty", k=3, by="link"))


@reg("e7_spc_limits_robust", _with(READINGS) + """,
  r AS (SELECT value, row_number() OVER (ORDER BY value) AS rn, count(*) OVER () AS n
        FROM readings WHERE value IS NOT NULL),
  t AS (SELECT avg(value) AS c FROM r WHERE rn > floor(n * 0.05) AND rn <= n - floor(n * 0.05)),
  md AS (SELECT median(value) AS med FROM readings),
  ma AS (SELECT median(abs(value - med)) * 1.4826 AS s FROM readings, md WHERE value IS NOT NULL)
  SELECT """ + _SPC_COLS + " FROM t, ma")
def _e7b(spark, d):
    return rounded(agg.spc_limits(S.readings(spark, d), "value", k=3, robust=True))


@reg("e8_null_profile", _with(READINGS) + """SELECT * FROM (
  SELECT 'id' AS "column", count(*) FILTER (WHERE id IS NULL) AS n_missing,
         round(count(*) FILTER (WHERE id IS NULL) / count(*), 6) AS share_missing FROM readings
  UNION ALL SELECT 'hourutc', count(*) FILTER (WHERE hourutc IS NULL),
         round(count(*) FILTER (WHERE hourutc IS NULL) / count(*), 6) FROM readings
  UNION ALL SELECT 'municipalityno', count(*) FILTER (WHERE municipalityno IS NULL),
         round(count(*) FILTER (WHERE municipalityno IS NULL) / count(*), 6) FROM readings
  UNION ALL SELECT 'branche', count(*) FILTER (WHERE branche IS NULL),
         round(count(*) FILTER (WHERE branche IS NULL) / count(*), 6) FROM readings
  UNION ALL SELECT 'value', count(*) FILTER (WHERE value IS NULL),
         round(count(*) FILTER (WHERE value IS NULL) / count(*), 6) FROM readings)
  WHERE n_missing > 0""")
def _e8(spark, d):
    return rounded(agg.null_profile(S.readings(spark, d)))


@reg("e9_null_profile_by", _with(READINGS) + """SELECT municipalityno, count(*) AS n_rows,
  count(*) FILTER (WHERE id IS NULL) AS id, count(*) FILTER (WHERE hourutc IS NULL) AS hourutc,
  count(*) FILTER (WHERE branche IS NULL) AS branche, count(*) FILTER (WHERE value IS NULL) AS value
  FROM readings GROUP BY 1 HAVING count(*) FILTER (WHERE value IS NULL) > 0""")
def _e9(spark, d):
    return agg.null_profile_by(S.readings(spark, d), "municipalityno")


@reg("e10_fully_missing", _with(READINGS) + """SELECT 'value' AS "column", count(*) AS n_groups FROM (
  SELECT municipalityno FROM readings GROUP BY 1 HAVING count(*) FILTER (WHERE value IS NULL) = count(*))""")
def _e10(spark, d):
    return agg.fully_missing(S.readings(spark, d), "municipalityno", ["value"])


@reg("e11_distinct_keys", _with(READINGS) + "SELECT DISTINCT municipalityno, branche FROM readings")
def _e11(spark, d):
    return agg.distinct_keys(S.readings(spark, d), ["municipalityno", "branche"])


@reg("e12_pick_random", _with(READINGS) + """SELECT municipalityno FROM readings WHERE municipalityno IS NOT NULL
  GROUP BY 1 ORDER BY md5('1234341:' || CAST(municipalityno AS VARCHAR)), municipalityno LIMIT 1""")
def _e12(spark, d):
    return agg.pick_random(S.readings(spark, d), "municipalityno", seed=1234341)


@reg("e13_extremes", _with(_EXCH_DAILY) + """SELECT link, round(min(net_qty), 6) AS min,
  round(max(net_qty), 6) AS max, round(max(abs(net_qty)), 6) AS max_abs FROM xd GROUP BY 1""")
def _e13(spark, d):
    return rounded(agg.extremes(_exch_daily(spark, d), "net_qty", by="link"))


@reg("e14_shape", _with(READINGS) + "SELECT count(*) AS n_rows, 5 AS n_cols FROM readings")
def _e14(spark, d):
    return agg.shape(S.readings(spark, d))


@reg("e15_mean_point", _with(MUNI) + "SELECT round(avg(latitude), 6) AS lat, round(avg(longitude), 6) AS lon FROM muni")
def _e15(spark, d):
    return rounded(agg.mean_point(S.municipalities(spark, d), "latitude", "longitude"))


BRANCHES = ["click", "error", "purchase", "signup", "view"]
_PIVOT_SQL = "SELECT date_trunc('hour', hourutc) AS hour, " + ", ".join(
    f"round(avg(value) FILTER (WHERE branche = '{b}'), 6) AS {b}" for b in BRANCHES) + \
    " FROM readings GROUP BY 1"


def _pivot(spark, d):
    r = S.readings(spark, d).withColumn("hour", F.date_trunc("hour", "hourutc"))
    return agg.pivot_wide(r, "hour", "branche", "value", BRANCHES)


@reg("e16_pivot_wide", _with(READINGS) + _PIVOT_SQL)
def _e16(spark, d):
    return rounded(_pivot(spark, d))


@reg("e16_pivot_found", _with(READINGS) + _PIVOT_SQL)
def _e16_found(spark, d):
    r = S.readings(spark, d).withColumn("hour", F.date_trunc("hour", F.col("hourutc")))
    return rounded(agg.pivot_wide(r, "hour", "branche", "value"))


@reg("e17_melt", _with(READINGS) + ", p AS (" + _PIVOT_SQL + """)
  SELECT hour, variable, value FROM p UNPIVOT INCLUDE NULLS (value FOR variable IN (""" +
     ", ".join(BRANCHES) + "))")
def _e17(spark, d):
    return rounded(agg.melt(_pivot(spark, d), ["hour"], BRANCHES))


@reg("e18_resample_daily_frame_sum", _with(READINGS) + """,
  p AS (SELECT municipalityno, hourutc, avg(value) AS v FROM readings GROUP BY 1, 2),
  dd AS (SELECT municipalityno, CAST(hourutc AS DATE) AS day, sum(v) AS v, count(v) AS nv FROM p GROUP BY 1, 2),
  b AS (SELECT min(day) AS lo, max(day) AS hi FROM dd WHERE nv > 0),
  k AS (SELECT DISTINCT municipalityno FROM dd WHERE nv > 0),
  s AS (SELECT municipalityno, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM k, b)
  SELECT s.municipalityno, s.day, round(coalesce(dd.v, 0.0), 6) AS value
  FROM s LEFT JOIN dd ON s.municipalityno = dd.municipalityno AND s.day = dd.day""")
def _e18a(spark, d):
    return rounded(agg.resample_daily(S.readings(spark, d), "hourutc", "value", by="municipalityno",
                                      agg="sum", dup_agg="mean", spine="frame"))


@reg("e18_resample_ranges", _with(READINGS) + """,
  dd AS (SELECT municipalityno, CAST(hourutc AS DATE) AS day, sum(value) AS v, count(value) AS nv FROM readings GROUP BY 1, 2),
  b AS (SELECT min(day) AS lo, max(day) AS hi FROM dd WHERE nv > 0),
  k AS (SELECT municipalityno FROM dd GROUP BY 1 HAVING max(nv) > 0),
  o AS (SELECT dd.*, lo, hi, lag(day) OVER w AS prev, lead(day) OVER w AS next FROM dd JOIN k USING (municipalityno), b
        WHERE day BETWEEN lo AND hi WINDOW w AS (PARTITION BY municipalityno ORDER BY day))
  SELECT municipalityno, day AS first_day, day AS last_day, round(coalesce(v, 0.0), 6) AS value FROM o
  UNION ALL SELECT municipalityno, lo, CAST(day - INTERVAL 1 DAY AS DATE), 0.0 FROM o WHERE prev IS NULL AND day > lo
  UNION ALL SELECT municipalityno, CAST(day + INTERVAL 1 DAY AS DATE),
    CAST(coalesce(next, CAST(hi + INTERVAL 1 DAY AS DATE)) - INTERVAL 1 DAY AS DATE), 0.0 FROM o
    WHERE coalesce(next, CAST(hi + INTERVAL 1 DAY AS DATE)) > day + INTERVAL 1 DAY""")
def _e18_ranges(spark, d):
    return rounded(agg.resample_ranges(S.readings(spark, d), "hourutc", "value", by="municipalityno"))


@reg("e18_resample_daily_key_mean", _with(READINGS) + """,
  dd AS (SELECT municipalityno, CAST(hourutc AS DATE) AS day, avg(value) AS v FROM readings GROUP BY 1, 2),
  b AS (SELECT municipalityno, min(day) AS lo, max(day) AS hi FROM dd GROUP BY 1),
  s AS (SELECT municipalityno, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
  SELECT s.municipalityno, s.day, round(dd.v, 6) AS value
  FROM s LEFT JOIN dd ON s.municipalityno = dd.municipalityno AND s.day = dd.day""")
def _e18b(spark, d):
    return rounded(agg.resample_daily(S.readings(spark, d), "hourutc", "value", by="municipalityno",
                                      agg="mean", spine="key"))


@reg("e18_resample_daily_orders", _with(GAS) + """,
  b AS (SELECT min(day) AS lo, max(day) AS hi FROM gas),
  s AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
  SELECT s.day, round(gas.price, 6) AS price FROM s LEFT JOIN gas ON s.day = gas.day""")
def _e18c(spark, d):
    o = S.table(spark, d, "orders").withColumn("price", F.col("o_totalprice"))
    return rounded(agg.resample_daily(o, "o_orderdate", "price", agg="mean"))


# --- G: sort, limit, set operations -----------------------------------------
@reg("g1_sort", _with(GAS) + "SELECT day, round(price, 6) AS price FROM gas ORDER BY price DESC")
def _g1(spark, d):
    return rounded(G.sort(S.gas_daily(spark, d), F.col("price").desc()))


@reg("g2_first_rows", _with(GAS) + "SELECT day, round(price, 6) AS price FROM gas ORDER BY price DESC, day LIMIT 10")
def _g2(spark, d):
    return rounded(G.first_rows(S.gas_daily(spark, d), 10, [F.col("price").desc(), F.col("day")]))


@reg("g3_union_frames", _with(GAS, WEATHER) + """SELECT day, round(price, 6) AS price, NULL::DOUBLE AS qty FROM gas
  UNION ALL SELECT day, NULL::DOUBLE, round(qty, 6) FROM weather""")
def _g3(spark, d):
    return rounded(G.union_frames([S.gas_daily(spark, d), S.weather_daily(spark, d)]))


@reg("g4_symmetric_difference", """(SELECT o_custkey AS k FROM orders EXCEPT
  SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
  UNION (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' EXCEPT SELECT o_custkey FROM orders)""")
def _g4(spark, d):
    a = S.table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    b = S.table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("k"))
    return G.symmetric_difference(a, b)


@reg("e18_resample_daily_key_max", _with(READINGS) + """,
  p AS (SELECT branche, hourutc, avg(value) AS v FROM readings GROUP BY 1, 2),
  dd AS (SELECT branche, CAST(hourutc AS DATE) AS day, max(v) AS v FROM p GROUP BY 1, 2),
  b AS (SELECT branche, min(day) AS lo, max(day) AS hi FROM dd GROUP BY 1),
  s AS (SELECT branche, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
  SELECT s.branche, s.day, round(dd.v, 6) AS value
  FROM s LEFT JOIN dd ON s.branche = dd.branche AND s.day = dd.day""")
def _e18d(spark, d):
    return rounded(agg.resample_daily(S.readings(spark, d), "hourutc", "value", by="branche",
                                      agg="max", dup_agg="mean", spine="key"))


@reg("e7_spc_limits_robust_by", _with(READINGS) + """,
  r AS (SELECT branche, value, row_number() OVER (PARTITION BY branche ORDER BY value) AS rn,
        count(*) OVER (PARTITION BY branche) AS n FROM readings WHERE value IS NOT NULL),
  t AS (SELECT branche, avg(value) AS c FROM r WHERE rn > floor(n * 0.05) AND rn <= n - floor(n * 0.05) GROUP BY 1),
  md AS (SELECT branche, median(value) AS med FROM readings GROUP BY 1),
  ma AS (SELECT branche, median(abs(value - med)) * 1.4826 AS s FROM readings JOIN md USING (branche)
         WHERE value IS NOT NULL GROUP BY 1)
  SELECT branche, """ + _SPC_COLS + " FROM t JOIN ma USING (branche)")
def _e7c(spark, d):
    return rounded(agg.spc_limits(S.readings(spark, d), "value", k=3, robust=True, by="branche"))
