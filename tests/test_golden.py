"""Small golden frames with hand-computed results (FIXTURES.md section D)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tempora.functions import columns as B
from tempora.operators import aggregate as E
from tempora.operators import joins as D
from tempora.operators import timeseries as TS
from tempora.plans import products as H

N = None


def series(spark, values, key="a"):
    rows = [(key, i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, t long, x double")


def col(df, name="x", order="t"):
    return [r[name] for r in df.orderBy(order).collect()]


def approx(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        if x is None or y is None:
            assert x is None and y is None, (a, b)
        else:
            assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (a, b)


def test_resample_daily_gap_day(spark):
    d1, d3 = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 3, 7)
    df = spark.createDataFrame([("a", d1, 1.0), ("a", d3, 2.0), ("b", d1, 3.0), ("b", d3, 4.0)],
                               "k string, ts timestamp_ntz, v double")
    s = E.resample_daily(df, "ts", "v", by="k", agg="sum").filter(F.col("day") == dt.date(2024, 1, 2))
    assert sorted((r.k, r.v) for r in s.collect()) == [("a", 0.0), ("b", 0.0)]
    m = E.resample_daily(df, "ts", "v", by="k", agg="mean").filter(F.col("day") == dt.date(2024, 1, 2))
    assert sorted((r.k, r.v) for r in m.collect()) == [("a", None), ("b", None)]


@pytest.mark.parametrize("chunk", [2, 1 << 16])
def test_interpolate(spark, chunk):
    df = series(spark, [N, 1, N, 3, N, N])
    approx(col(TS.interpolate(df, "k", ["t"], ["x"], chunk_rows=chunk)), [N, 1, 2, 3, 3, 3])


@pytest.mark.parametrize("chunk", [2, 1 << 16])
def test_rolling_mean(spark, chunk):
    df = series(spark, [N, 1, N, 3, N, N])
    out = TS.rolling_mean(df, "k", ["t"], "x", 3, 1, out="r", chunk_rows=chunk)
    approx(col(out, "r"), [N, 1, 1, 2, 3, 3])


@pytest.mark.parametrize("chunk", [2, 1 << 16])
def test_bfill(spark, chunk):
    df = series(spark, [N, 1, N, 3, N])
    approx(col(TS.bfill(df, "k", ["t"], "x", chunk_rows=chunk)), [1, 1, 3, 3, N])


def test_zero_fill_absent(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, None), ("b", 0, 1.0), ("b", 1, None)],
                               "k string, t long, x double")
    out = {(r.k, r.t): r.x for r in TS.zero_fill_absent(df, "k", ["x"]).collect()}
    assert out == {("a", 0): 0.0, ("a", 1): 0.0, ("b", 0): 1.0, ("b", 1): None}


@pytest.mark.parametrize("chunk", [2, 1 << 16])
def test_lag_backfill(spark, chunk):
    df = series(spark, [1, 2, 3, 4])
    approx(col(TS.lag_backfill(df, "k", ["t"], "x", 2, chunk_rows=chunk)), [1, 1, 1, 2])
    approx(col(TS.lag_backfill(df, "k", ["t"], "x", 0)), [1, 2, 3, 4])


def test_lowpass_extremes(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = series(spark, vals)
    approx(col(TS.dct_lowpass(df, "k", ["t"], "x", 0, out="y"), "y"), [sum(vals) / len(vals)] * len(vals))
    approx(col(TS.dct_lowpass(df, "k", ["t"], "x", len(vals) - 1, out="y"), "y"), vals)


def test_sliding_corr_constant_is_null(spark):
    rows = [("a", i, 5.0, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, t long, x double, y double")
    out = TS.sliding_corr(df, "k", ["t"], "x", "y", width=3)
    assert all(r.corr is None for r in out.collect())


def test_sliding_corr_centred_window(spark):
    rows = [("a", i, float(i), float(i * i % 7)) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, t long, x double, y double")
    for width, chunk in [(7, 3), (4, 2), (7, 1 << 16)]:
        got = col(TS.sliding_corr(df, "k", ["t"], "x", "y", width=width, chunk_rows=chunk), "corr")
        o = (width - 1) // 2
        xs, ys = [r[2] for r in rows], [r[3] for r in rows]
        exp = []
        for i in range(12):
            lo, hi = i - (width - 1 - o), i + o
            if lo < 0 or hi >= 12:
                exp.append(None)
                continue
            a, b = xs[lo:hi + 1], ys[lo:hi + 1]
            ma, mb = sum(a) / width, sum(b) / width
            cov = sum((p - ma) * (q - mb) for p, q in zip(a, b))
            exp.append(cov / math.sqrt(sum((p - ma) ** 2 for p in a) * sum((q - mb) ** 2 for q in b)))
        approx(got, exp)


def test_trimmed_mean_ties(spark):
    vals20 = [1, 1, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 5, 5, 6, 7, 8, 9, 50, 100]
    df = spark.createDataFrame([(float(v),) for v in vals20], "x double")
    got = E.trimmed_mean(df, "x", 0.05).first()["trimmed_mean"]
    assert math.isclose(got, sum(sorted(vals20)[1:-1]) / 18)
    df19 = spark.createDataFrame([(float(v),) for v in vals20[:19]], "x double")
    got19 = E.trimmed_mean(df19, "x", 0.05).first()["trimmed_mean"]
    assert math.isclose(got19, sum(vals20[:19]) / 19)


def test_mad(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 2, 2, 4, 6, 9]], "x double")
    r = E.mad(df, "x").first()
    assert r["mad"] == 1.0 and math.isclose(r["mad_scaled"], 1.4826)
    ra = E.mad(df, "x", approx=True).first()
    assert ra["mad"] == 1.0


def test_group_sum_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 2.0)], "k int, x double")
    assert [(r.k, r.x) for r in E.group_sum(df, "k", "x").collect()] == [(1, 0.0)]


def test_nearest_tie_goes_to_lower_id(spark):
    # midway in exact floating point: longitudes -1 and +1 around 0
    stations = spark.createDataFrame([(7, 55.0, -1.0), (3, 55.0, 1.0), (9, 58.0, 0.0)],
                                     "station_id long, latitude double, longitude double")
    pts = spark.createDataFrame([(1, 55.0, 0.0), (2, 57.9, 0.0)], "code long, latitude double, longitude double")
    out = {r.code: r.station_id for r in D.nearest(pts, stations, "code", "station_id", cell_deg=0.25).collect()}
    assert out == {1: 3, 2: 9}


def test_nearest_far_point_needs_many_rings(spark):
    stations = spark.createDataFrame([(1, 10.0, 10.0), (2, 11.0, 10.0)],
                                     "station_id long, latitude double, longitude double")
    pts = spark.createDataFrame([(1, 14.0, 10.2)], "code long, latitude double, longitude double")
    r = D.nearest(pts, stations, "code", "station_id", cell_deg=0.5).first()
    assert r.station_id == 2


def test_left_dim_join_keeps_unmatched(spark):
    fact = spark.createDataFrame([(1, 101), (2, 411)], "id long, municipalityno long")
    dim = spark.createDataFrame([(101, "Copenhagen")], "code long, name string")
    out = {r.id: r.municipality for r in
           D.dim_join(fact, dim, "municipalityno", "code", "left", rename={"name": "municipality"}).collect()}
    assert out == {1: "Copenhagen", 2: None}


def test_split_at_midnight(spark):
    ts = [dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 0), dt.datetime(2024, 1, 2, 1)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    a, b = B.split_at(df, "ts", dt.datetime(2024, 1, 2))
    assert a.count() == 1 and b.count() == 2


def test_flow_alerts(spark):
    rows = [("L", dt.datetime(2024, 1, d), v) for d, v in [(1, 80.0), (2, 81.0), (3, 95.0), (4, 96.0), (5, -100.0)]]
    df = spark.createDataFrame(rows, "link string, ts timestamp_ntz, v double")
    out = H.exchange_frame(df, "ts", "link", "v", {"L": (1.0, 2.0)})
    got = [(r.alert, r.direction) for r in out.orderBy("day").collect()]
    assert got == [("green", "Net import"), ("yellow", "Net import"), ("yellow", "Net import"),
                   ("red", "Net import"), ("red", "Net export")]


def test_name_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    with pytest.raises(ValueError):
        B.normalise_names(df, rename={"b": "A"})


def test_melt_inverts_pivot(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "x", 3.0)], "t long, k string, v double")
    wide = E.pivot_wide(df, "t", "k", "v", ["x", "y"])
    long = E.melt(wide, ["t"], ["x", "y"], "k", "v").filter(F.col("v").isNotNull())
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, df.collect()))


def test_positions_and_time_weights_ignore_dst(spark):
    from tempora.operators.series import grid_position
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        days = [dt.date(2024, 3, 8) + dt.timedelta(days=i) for i in range(5)]
        df = spark.createDataFrame([("a", d) for d in days], "k string, day date")
        assert [r._p for r in grid_position(df, "k", "day", 86400, "_p").orderBy("day").collect()] == [0, 1, 2, 3, 4]
        ts = [dt.datetime(2024, 3, 9, 12), dt.datetime(2024, 3, 10, 12), dt.datetime(2024, 3, 11, 12)]
        df2 = spark.createDataFrame([("a", ts[0], 0.0), ("a", ts[1], None), ("a", ts[2], 2.0)],
                                    "k string, t timestamp_ntz, x double")
        out = TS.interpolate(df2, "k", ["t"], ["x"], method="time").orderBy("t").collect()
        assert [r.x for r in out] == [0.0, 1.0, 2.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("cell", [0.1, 0.7, 3.0])
def test_nearest_equals_brute_force(spark, cell):
    import numpy as np
    rng = np.random.default_rng(7)
    st = [(int(i), float(a), float(b)) for i, a, b in
          zip(range(60), rng.uniform(40, 70, 60), rng.uniform(-20, 30, 60))]
    pt = [(int(i), float(a), float(b)) for i, a, b in
          zip(range(300), rng.uniform(30, 80, 300), rng.uniform(-40, 50, 300))]
    sdf = spark.createDataFrame(st, "station_id long, latitude double, longitude double")
    pdf = spark.createDataFrame(pt, "code long, latitude double, longitude double")
    got = {r.code: r.station_id for r in D.nearest(pdf, sdf, "code", "station_id", cell_deg=cell).collect()}
    s = np.radians(np.array([[a, b] for _, a, b in st]))
    for code, a, b in pt:
        p1, l1 = math.radians(a), math.radians(b)
        h = np.sin((s[:, 0] - p1) / 2) ** 2 + math.cos(p1) * np.cos(s[:, 0]) * np.sin((s[:, 1] - l1) / 2) ** 2
        assert got[code] == int(np.argmin(h)), code


def _globe(n, seed):
    """Positions everywhere, many at the date line, the poles and at one place."""
    import numpy as np
    rng = np.random.default_rng(seed)
    rows = [(float(a), float(b)) for a, b in zip(np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n))]
    rows += [(float(a), float(s * b)) for a, b, s in
             zip(rng.uniform(-60, 60, n), rng.uniform(179, 180, n), rng.choice([-1, 1], n))]
    rows += [(float(s * a), float(b)) for a, b, s in
             zip(rng.uniform(88, 90, n), rng.uniform(-180, 180, n), rng.choice([-1, 1], n))]
    return rows + [(0.0, 180.0), (0.0, -180.0), (90.0, 0.0), (-90.0, 33.0), (0.0, 0.0)] + [(12.5, 44.25)] * 7


@pytest.mark.parametrize("k,cell", [(1, 0.5), (3, 0.5), (3, None), (1, 40.0), (5, 7.0)])
def test_nearest_on_the_whole_sphere(spark, k, cell):
    st = [(i, a, b) for i, (a, b) in enumerate(_globe(25, 1))]
    pt = [(i, a, b) for i, (a, b) in enumerate(_globe(60, 2))]
    sdf = spark.createDataFrame(st, "station_id long, latitude double, longitude double").repartition(3)
    pdf = spark.createDataFrame(pt + [(900, None, 1.0), (901, 2.0, float("nan")), (902, 0.0, 179.9), (902, 0.0, -10.0)],
                                "code long, latitude double, longitude double")
    out = D.nearest(pdf, sdf, "code", "station_id", cell_deg=cell, k=k)
    got = {}
    for r in out.where("code < 900").collect():
        got.setdefault(r.code, []).append((r["rank"] if k > 1 else 1, r.station_id, r.distance_m))

    def far(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 6371008.8 * math.asin(min(1.0, math.sqrt(h)))
    from tempora.functions.scalar import EARTH_RADIUS_M
    scale = EARTH_RADIUS_M / 6371008.8
    for code, a, b in pt:
        want = sorted((far(a, b, c, d) * scale, i) for i, c, d in st)
        mine = sorted(got[code])
        assert [r for r, _, _ in mine] == list(range(1, k + 1))
        for (_, sid, dist), (wd, _) in zip(mine, want):
            assert dist == pytest.approx(wd, abs=1e-3)
            assert far(a, b, *st[sid][1:]) * scale == pytest.approx(dist, abs=1e-3)
        # exact ties, stations at one place, are in order of their keys
        same = [s for _, s, x in mine if st[s][1:] == (12.5, 44.25)]
        assert same == sorted(same)
    assert {r.code: r.station_id for r in out.where("code in (900, 901)").collect()} == {900: None, 901: None}
    assert out.where("code = 902").count() == 2 * k


def test_nearest_over_the_date_line(spark):
    stations = spark.createDataFrame([(10, 0.0, -179.9), (11, 0.0, 179.0)], "station_id long, latitude double, longitude double")
    points = spark.createDataFrame([(1, 0.0, 179.9)], "code long, latitude double, longitude double")
    assert D.nearest(points, stations, "code", "station_id").first().station_id == 10
    many = D.nearest(points, stations, "code", "station_id", k=5).orderBy("rank").collect()
    assert [(r["rank"], r.station_id) for r in many] == [(1, 10), (2, 11)]
    none = D.nearest(points, stations.limit(0), "code", "station_id").first()
    assert none.station_id is None and none.distance_m is None


def _order_statistics(rows, p=0.1):
    import numpy as np
    out = {}
    for k in {k for k, _ in rows}:
        v = np.sort([x for kk, x in rows if kk == k and x is not None])
        g = math.floor(p * len(v))
        if len(v):
            med = float(np.median(v))
            out[k] = (float(v[g:len(v) - g].mean()), med, float(np.median(np.abs(v - med))))
    return out


@pytest.mark.parametrize("partitions", ["1", "3", "8"])
def test_order_statistics_with_a_hot_value(spark, partitions):
    import numpy as np
    rng = np.random.default_rng(4)
    rows = [("a", 0.0)] * 1500 + [("a", float(x)) for x in rng.normal(0, 1, 1501)]
    rows += [("b", float(x)) for x in rng.integers(-3, 4, 700)] + [("c", 5.0), ("c", None), ("d", None), ("e", 1.0), ("e", 2.0)]
    rows += [("a", None)] * 5
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    want = _order_statistics(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        tm = {r.k: r.trimmed_mean for r in E.trimmed_mean(df, "v", 0.1, "k").collect()}
        md = {r.k: r.mad for r in E.mad(df, "v", "k").collect()}
        med = {r.k: r.median_v for r in E.group_agg(df, "k", "median", "v").collect()}
        # every value is one row of the ranked table: no slice holds the rows of the hot one
        ranked = E.weighted_ranks(E.counted(df, "k", "v"), "k", "v").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for k, (t, m, d) in want.items():
        assert (tm[k], med[k], md[k]) == (pytest.approx(t), pytest.approx(m), pytest.approx(d)), k
    assert med["d"] is None and "d" not in tm and "d" not in md
    hot = [r for r in ranked if r.k == "a" and r.v == 0.0]
    assert len(hot) == 1 and hot[0]["_w"] == 1500 and hot[0]["_upto"] - hot[0]["_before"] == 1500
    assert len(ranked) == len({(k, v) for k, v in rows if v is not None})


def test_weighted_ranks_without_a_group(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (2.0,), (None,), (9.0,)], "v double")
    got = sorted((r.v, r["_before"], r["_upto"], r["_n"]) for r in E.weighted_ranks(E.counted(df, None, "v"), None, "v").collect())
    assert got == [(1.0, 0, 1, 4), (2.0, 1, 3, 4), (9.0, 3, 4, 4)]
    assert E.trimmed_mean(df, "v", 0.25).first()[0] == 2.0 and E.mad(df, "v").first().mad == 0.5


def test_pivot_finds_its_columns(spark):
    rows = [(t, f"k{(t * 7 + i) % 9}", float(t * 10 + i)) for t in range(12) for i in range(t % 5 + 1)]
    rows += [(3, None, 1.0), (4, "k1", None), (5, "k1", 2.0), (5, "k1", 4.0)] + [(1, "k0", 3.0)] * 40
    df = spark.createDataFrame(rows, "t long, k string, v double").repartition(3)
    given = E.pivot_wide(df, "t", "k", "v", [f"k{i}" for i in range(9)])
    found = E.pivot_wide(df, "t", "k", "v")
    assert found.columns == given.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, given.collect()), key=str)
    few = E.pivot_wide(df, "t", "k", "v", max_columns=2)
    assert few.columns[1] == "k0" and len(few.columns) == 4 and few.columns[-1] == "other"
    # columns and map together hold every cell
    cells = {(r.t, c): r[c] for r in few.collect() for c in few.columns[1:3] if r[c] is not None}
    cells.update({(r.t, c): v for r in few.collect() for c, v in r.other.items() if v is not None})
    assert cells == {(r.t, c): r[c] for r in given.collect() for c in given.columns[1:] if r[c] is not None}
    assert E.pivot_wide(df.where("k is null"), "t", "k", "v").columns == ["t"]


def test_sparse_keys_stay_ranges(spark):
    df = spark.range(10_000).selectExpr(
        "id k", "explode(array(date_add(date'2000-01-01', cast(id % 900 as int)), "
        "date_add(date'2019-12-31', -cast(id % 700 as int)))) d", "1.5D v") \
        .selectExpr("k", "cast(d as timestamp_ntz) t", "v")
    ranges = E.resample_ranges(df, "t", "v", "k").cache()
    # two days, the gap between them and the ones around: five rows a key at most, not 7,305
    assert ranges.count() <= 50_000
    one = ranges.groupBy("k").agg(F.sum(F.datediff("last_day", "first_day") + 1).alias("days"), F.sum("v").alias("v"))
    span = 7305
    assert one.where(f"days <> {span} or v <> 3.0").count() == 0
    few = df.where("k < 5")
    own = E.resample_ranges(few, "t", "v", "k", agg="mean", spine="key")
    daily = E.resample_daily(few, "t", "v", "k", agg="mean", spine="key")
    assert own.count() == 15 and E.expand_ranges(own).exceptAll(daily).isEmpty()
    assert daily.where("v is not null").count() == 10
    assert E.resample_daily(few.where("k < 0"), "t", "v", "k").count() == 0
    assert E.resample_ranges(few.where("k < 0"), "t", "v", "k").count() == 0


@pytest.mark.parametrize("agg", ["sum", "mean", "max", "count"])
@pytest.mark.parametrize("by,spine", [("k", "frame"), ("k", "key"), (None, "frame"), (None, "key")])
def test_expanded_ranges_are_the_daily_rows(spark, agg, by, spine):
    rows = [(k, dt.datetime(2024, 1, 1 + (d * 7 + len(k)) % 25, 3), None if (d + len(k)) % 4 == 0 else float(d), d)
            for k in ("a", "bb", "ccc") for d in range(6)]
    rows += [("void", dt.datetime(2024, 1, 9), None, 1), ("a", None, 5.0, 2), (None, dt.datetime(2024, 1, 3), 1.0, 3),
             ("bb", dt.datetime(2024, 3, 9), None, 1), ("bb", dt.datetime(2023, 3, 9), None, 1)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double, i int")
    daily = E.resample_daily(df, "t", "v", by, agg, spine=spine)
    got = E.expand_ranges(E.resample_ranges(df, "t", "v", by, agg, spine=spine))
    assert got.columns == daily.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, daily.collect()), key=str)
