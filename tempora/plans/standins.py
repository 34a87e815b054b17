"""The driver tables re-read as the reference's data sets.

The reference's energy tables are not shipped; the checks run the operators
on the generated TPC-H-like tables, read in the roles below.  Every derived
column is a plain expression, repeated word for word in the oracle SQL.

* production / consumption (hour x municipality [x industry]): ``events``
  with ``user_id`` as municipality, ``event_type`` as industry and
  ``value`` with missing values injected by rule (``MISSING_*``).
* municipalities: ``customer`` joined to ``nation`` and ``region``.
* gas (daily price): mean ``o_totalprice`` per ``o_orderdate`` day.
* weather (series to correlate): mean ``l_quantity`` per ``l_shipdate`` day.
* exchange links: ``lineitem`` joined to supplier / nation / region,
  quantity signed negative for returned lines, one link per region.
* coordinates: a formula on the key (``lat_of`` / ``lon_of``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed rules for injected missing values (mirrored in the oracle SQL).
MISSING_EVERY = 7        # value is NULL when event_id % 7 = 0
ABSENT_USER_MOD = 10     # value is NULL for every row of user_id % 10 = 3
ABSENT_USER_REST = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lat_of(k: Column) -> Column:
    return F.lit(54.0) + ((k * 37) % 400) / F.lit(100.0)


def lon_of(k: Column) -> Column:
    return F.lit(8.0) + ((k * 53) % 700) / F.lit(100.0)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly-style readings: (id, hourutc, municipalityno, branche, value)."""
    ev = table(spark, sf_dir, "events")
    v = F.when((F.col("event_id") % MISSING_EVERY == 0) |
               (F.col("user_id") % ABSENT_USER_MOD == ABSENT_USER_REST), F.lit(None)) \
        .otherwise(F.col("value"))
    return ev.select(F.col("event_id").alias("id"), F.col("ts").alias("hourutc"),
                     F.col("user_id").alias("municipalityno"),
                     F.col("event_type").alias("branche"), v.alias("value"))


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension: code, name, region name (customer x nation x region)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"),
                    F.col("r_name").alias("region"),
                    lat_of(F.col("c_custkey")).alias("latitude"),
                    lon_of(F.col("c_custkey")).alias("longitude")))


def gas_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily price series (gas): one row per order day, no spine."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("day"))
            .agg(F.avg("o_totalprice").alias("price")))


def signed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line quantities signed by direction: returned lines count negative."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
                     F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
                     .otherwise(F.col("l_quantity")).alias("net_qty"))


def exchange_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange per link (region) and ship time: (hourutc, link, net_qty)."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    lines = signed_lines(spark, sf_dir)
    dim = (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
           .select("s_suppkey", F.col("r_name").alias("link")))
    return (lines.join(dim, lines.l_suppkey == dim.s_suppkey)
            .select(F.col("l_shipdate").alias("hourutc"), "link", "net_qty"))


def station_lat_of(k: Column) -> Column:
    return F.lit(54.0) + ((k * 71) % 400) / F.lit(100.0)


def station_lon_of(k: Column) -> Column:
    return F.lit(8.0) + ((k * 29) % 700) / F.lit(100.0)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather stations: suppliers placed by a formula on their key."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("station_id"),
                    station_lat_of(F.col("s_suppkey")).alias("latitude"),
                    station_lon_of(F.col("s_suppkey")).alias("longitude"))


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series to correlate (weather): mean quantity per ship day."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.avg("l_quantity").alias("qty"))


# Fixed stand-in values: a coordinate per link (region), like the
# reference's capital per neighbouring country, and the hub point.
LINK_COORDS = {
    "AFRICA": (59.9139, 10.7522),
    "AMERICA": (59.3327, 18.0656),
    "ASIA": (52.5200, 13.4050),
    "EUROPE": (52.3676, 4.9041),
    "MIDDLE EAST": (54.0, 9.0),
}
CENTRAL_POINT = (55.6761, 12.5683)
