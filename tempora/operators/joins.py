"""Joins (D1-D8).

Dimension joins carry no broadcast hint unless the side has a proven bound:
adaptive execution measures the built side at run time and turns the join
into a broadcast when it is small, else keeps a shuffle join whose skewed
partitions it splits.  The nearest-station join (D5) avoids pairing every
point with every station: it is an equi-join on cells of space, coarsened
level by level only for points whose nearest stations are not yet proven.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.scalar import EARTH_RADIUS_M, haversine_m
from tempora.session import cut_lineage


# --- D1 / D8 ----------------------------------------------------------------
def join_on_time(a: DataFrame, b: DataFrame, ts: str, how: str = "inner") -> DataFrame:
    """Equi-join of two series on their time column."""
    return a.join(b, [ts], how)


def align_series(a: DataFrame, b: DataFrame, day: str = "day") -> DataFrame:
    """Pair two daily series by date (the reference paired by row label)."""
    return a.join(b, [day], "inner")


# --- D2 / D3 / D4 -----------------------------------------------------------
def dim_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
             how: str = "left", rename: dict | None = None,
             broadcast_dim: bool = False) -> DataFrame:
    """Fact-to-dimension join on differently named keys; the dimension key
    is dropped and dimension columns optionally renamed.  ``broadcast_dim``
    only for dimensions of a known, fixed size."""
    d = dim
    for old, new in (rename or {}).items():
        d = d.withColumnRenamed(old, new)
    d = d.withColumnRenamed(dim_key, "_dim_key")
    if broadcast_dim:
        d = F.broadcast(d)
    return fact.join(d, fact[fact_key] == d["_dim_key"], how).drop("_dim_key")


def anti_join(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (hash anti join)."""
    return new.join(existing.select(*keys).distinct(), list(keys), "left_anti")


# --- D5 ---------------------------------------------------------------------
_AXES = ("_cx", "_cy", "_cz")
_BLOCK = [(dx, dy, dz) for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1)]
# stations in the fullest cell when the first cell size is chosen from the data
AUTO_CELL_STATIONS = 32


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Add the unit vector (_x, _y, _z) of a position."""
    la, lo = F.radians(lat), F.radians(lon)
    return df.withColumn("_x", F.cos(la) * F.cos(lo)).withColumn("_y", F.cos(la) * F.sin(lo)) \
        .withColumn("_z", F.sin(la))


def _in_cells(df: DataFrame, size: float) -> DataFrame:
    return df.withColumns({c: F.floor(F.col(v) / size) for c, v in zip(_AXES, ("_x", "_y", "_z"))})


def _first_cell(stations: DataFrame) -> float:
    """The largest cell, of sizes 2**-1, 2**-2, ..., in which at most AUTO_CELL_STATIONS stations meet."""
    sizes = stations.withColumn("_l", F.explode(F.sequence(F.lit(1), F.lit(24)))) \
        .withColumn("_s", F.pow(F.lit(2.0), -F.col("_l")))
    full = (sizes.groupBy("_l", *(F.floor(F.col(v) / F.col("_s")).alias(c) for c, v in zip(_AXES, ("_x", "_y", "_z"))))
            .count().groupBy("_l").agg(F.max("count").alias("n")).where(F.col("n") <= AUTO_CELL_STATIONS))
    level = full.agg(F.min("_l")).first()[0]
    return 2.0 ** -(level or 24)


def nearest(points: DataFrame, stations: DataFrame, point_key: str, station_key: str,
            lat: str = "latitude", lon: str = "longitude",
            station_lat: str = "latitude", station_lon: str = "longitude",
            cell_deg: float | None = 0.5, dist_col: str = "distance_m", k: int = 1,
            rank_col: str = "rank") -> DataFrame:
    """The ``k`` nearest stations (and distances in metres) of every point, on the whole sphere; exact.

    Ties go to the lowest station key.  With ``k`` = 1 there is one row per point, else one per point and
    rank (fewer where there are fewer stations).  A point without coordinates, or no station at all: one
    row with a NULL station.

    Positions are unit vectors in space, so neither the date line nor a pole is an edge.  Space is cut in
    cubes of edge ``cell_deg`` (as a chord; None: from the density of the stations), doubled at each level.
    A station is entered in the 27 cubes around its own and a point looks only into its own, so the points,
    usually many more, are never multiplied.  A point is closed when its k-th distance is below the least
    that any station outside its block can have, one edge and the point's margin to the side of its cube,
    or when the block holds every station.  Later levels see only the points still open.

    Points at one place are one search, and of stations at one place only the ``k`` lowest keys can count,
    so crowds of either cost nothing.  The candidates of a point are cut to ``k`` before they are shuffled.
    Each level is checkpointed; the loop runs over levels, never over data.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    sid_type = stations.schema[station_key].dataType
    real = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    st = stations.select(F.col(station_key).alias("_sid"), F.col(station_lat).cast("double").alias("_slat"),
                         F.col(station_lon).cast("double").alias("_slon")) \
        .where(real("_slat") & real("_slon") & F.col("_sid").isNotNull()).distinct() \
        .withColumn("_n", F.row_number().over(Window.partitionBy("_slat", "_slon").orderBy("_sid"))) \
        .where(F.col("_n") <= k).drop("_n")
    st = cut_lineage(_on_sphere(st, "_slat", "_slon"))
    here = [F.col(lat).cast("double").alias("_plat"), F.col(lon).cast("double").alias("_plon")]
    pts = points.select(F.col(point_key).alias("_pid"), *here)
    best_type = f"array<struct<d:double,s:{sid_type.simpleString()}>>"
    open_pts = _on_sphere(pts.select("_plat", "_plon").where(real("_plat") & real("_plon")).distinct(), "_plat", "_plon")
    ext = st.agg(*(f(v).alias(f"{n}{v}") for n, f in (("lo", F.min), ("hi", F.max)) for v in ("_x", "_y", "_z"))).first()
    done = open_pts.select("_plat", "_plon", F.lit(None).cast(best_type).alias("_best")).limit(0)
    if ext["lo_x"] is not None:
        size = _first_cell(st) if cell_deg is None else 2 * math.sin(math.radians(min(float(cell_deg), 180.0)) / 2)
        around = F.array(*[F.struct(*(F.lit(v).alias(c) for c, v in zip(_AXES, o))) for o in _BLOCK])
        place = ["_plat", "_plon"]
        while True:
            cells = _in_cells(st, size).withColumn("_o", F.explode(around)) \
                .select("_sid", "_slat", "_slon", *((F.col(c) + F.col(f"_o.{c}")).alias(c) for c in _AXES))
            p = _in_cells(open_pts, size)
            hits = p.select(*place, *_AXES).join(cells, list(_AXES)).select(*place, F.struct(
                haversine_m("_plat", "_plon", "_slat", "_slon").alias("d"), F.col("_sid").alias("s")).alias("_h"))
            if k == 1:
                hits = hits.groupBy(*place).agg(F.array(F.min("_h")).alias("_best"))
            else:
                # Spark keeps the k first of a place in every task before it shuffles them
                first = Window.partitionBy(*place).orderBy("_h.d", "_h.s")
                hits = hits.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k) \
                    .groupBy(*place).agg(F.sort_array(F.collect_list("_h")).alias("_best"))
            covered, gap = F.lit(True), None
            for c, v in zip(_AXES, ("_x", "_y", "_z")):
                covered = covered & (F.col(c) - 1 <= math.floor(ext[f"lo{v}"] / size)) \
                    & (F.col(c) + 1 >= math.floor(ext[f"hi{v}"] / size))
                part = F.col(v) / size - F.col(c)
                edge = (1 + F.least(part, 1 - part)) * size
                gap = edge if gap is None else F.least(gap, edge)
            # a little less, for the rounding of the unit vectors
            bound = F.lit(2 * EARTH_RADIUS_M * (1 - 1e-9)) * F.asin(F.least(F.lit(1.0), gap / 2))
            closed = covered | ((F.size("_best") == k) & (F.col("_best")[k - 1]["d"] <= bound))
            level = cut_lineage(p.join(hits, place, "left").withColumn("_closed", F.coalesce(closed, F.lit(False)))
                                .drop(*_AXES))
            done = done.unionByName(level.where("_closed").select(*place, "_best"))
            open_pts = level.where("not _closed").drop("_closed", "_best")
            if open_pts.isEmpty():
                break
            size *= 2
    out = pts.join(done, ["_plat", "_plon"], "left")
    key = F.col("_pid").alias(point_key)
    if k == 1:
        return out.select(key, F.col("_best")[0]["s"].alias(station_key), F.col("_best")[0]["d"].alias(dist_col))
    return out.select(key, F.posexplode_outer("_best").alias("_at", "_b")).select(
        F.col(point_key), (F.col("_at") + 1).cast("long").alias(rank_col),
        F.col("_b.s").alias(station_key), F.col("_b.d").alias(dist_col))


# --- D6 / D7 ----------------------------------------------------------------
def enrich(dim: DataFrame, attrs: DataFrame, key: str) -> DataFrame:
    """Set attributes on dimension rows by key; a value is only replaced
    when the attribute frame has a non-NULL value for that key."""
    new_cols = [c for c in attrs.columns if c != key]
    a = attrs.select(key, *[F.col(c).alias(f"_new_{c}") for c in new_cols])
    out = dim.join(a, [key], "left")
    for c in new_cols:
        if c in dim.columns:
            out = out.withColumn(c, F.coalesce(F.col(f"_new_{c}"), F.col(c)))
        else:
            out = out.withColumn(c, F.col(f"_new_{c}"))
    return out.drop(*[f"_new_{c}" for c in new_cols])


def normalise_name(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.trim(c))


def geocode_join(names: DataFrame, name_col: str, gazetteer: DataFrame, gaz_name: str,
                 lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Name -> coordinates through a gazetteer table; unmatched names keep
    NULL coordinates.  A gazetteer with several rows per name gives the one
    with the smallest coordinates, so the result has one row per name."""
    gaz = (gazetteer.select(normalise_name(gaz_name).alias("_gname"),
                            F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")).alias("_c"))
           .groupBy("_gname").agg(F.min("_c").alias("_c")))
    out = names.join(gaz, normalise_name(name_col) == F.col("_gname"), "left")
    return out.withColumn(lat, F.col("_c.lat")).withColumn(lon, F.col("_c.lon")).drop("_gname", "_c")
