"""Chunked series operators equal the whole-series result.

Tiny chunks force every halo and carry path on the driver tables."""

import math

import pytest
from pyspark.sql import functions as F

from tempora.operators import forecast as FC
from tempora.operators import timeseries as TS
from tempora.operators.series import with_position
from tempora.plans import standins as S

SF = "/root/testdata/sf0.001"
KEY, ORDER = "municipalityno", ["hourutc", "id"]


@pytest.fixture(scope="module")
def readings(spark):
    df = S.readings(spark, SF).cache()
    yield df
    df.unpersist(blocking=True)


def same(a, b, cols):
    a = a.select("id", *cols)
    b = b.select("id", *cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("chunk", [3, 7])
def test_rolling(readings, chunk):
    same(TS.rolling_mean(readings, KEY, ORDER, "value", chunk_rows=chunk),
         TS.rolling_mean(readings, KEY, ORDER, "value"), ["value_rolling"])


@pytest.mark.parametrize("chunk", [3, 7])
def test_interpolate(readings, chunk):
    same(TS.interpolate(readings, KEY, ORDER, ["value"], chunk_rows=chunk),
         TS.interpolate(readings, KEY, ORDER, ["value"]), ["value"])


@pytest.mark.parametrize("chunk", [2, 5])
def test_lag_bfill(readings, chunk):
    same(TS.lag_backfill(readings, KEY, ORDER, "value", 3, out="l", chunk_rows=chunk),
         TS.lag_backfill(readings, KEY, ORDER, "value", 3, out="l"), ["l"])


@pytest.mark.parametrize("chunk", [3, 7])
def test_corr(readings, chunk):
    r = readings.withColumn("y", F.col("id") % 13 * 1.0)
    a = TS.sliding_corr(r, KEY, ORDER, "value", "y", width=5, chunk_rows=chunk)
    b = TS.sliding_corr(r, KEY, ORDER, "value", "y", width=5)
    a = a.select("id", F.round("corr", 9).alias("corr"))
    b = b.select("id", F.round("corr", 9).alias("corr"))
    assert a.exceptAll(b).count() == 0


def test_positions_are_dense(readings):
    p = with_position(readings, KEY, ORDER, "pos", bucket=F.date_trunc("day", "hourutc"))
    chk = p.groupBy(KEY).agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                             F.count(F.lit(1)).alias("n"), F.countDistinct("pos").alias("d"))
    assert chk.filter((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("d") != F.col("n"))).count() == 0


def test_balanced_positions_are_the_same(readings):
    """Slices of equal counts number a dense series like calendar buckets do."""
    dense = readings.withColumn(KEY, F.when(F.col(KEY) % 3 == 0, F.lit(None)).otherwise(F.lit(1)))
    a = with_position(dense, KEY, ORDER).select("id", "_pos")
    b = with_position(dense, KEY, ORDER, balanced=True).select("id", "_pos")
    assert a.count() == dense.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_forecast_recovers_noise_free_ar(spark):
    # dy_t = 0.5 + 0.6 dy_{t-1} + 0.2 dy_{t-4} exactly: fit and forecast are exact
    rows, ys, dys = [], [0.0, 1.0, 2.5, 3.0, 4.2], [1.0, 1.5, 0.5, 1.2]
    for t in range(5, 80):
        d = 0.5 + 0.6 * dys[-1] + 0.2 * dys[-4]
        dys.append(d)
        ys.append(ys[-1] + d)
    for key in ("a", "b"):
        rows += [(key, t, y) for t, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "k string, t long, y double")
    feats = FC.forecast_features(df, "k", ["t"], "y", season=4)
    coef = FC.fit_ar(feats, "k", 60, "t", season=4).first()["coef"]
    assert all(abs(a - b) < 1e-6 for a, b in zip(coef, [0.5, 0.6, 0.2]))
    fc = FC.fit_forecast(feats, "k", "t", "y", 60, horizon=10, season=4).filter("k = 'a'").orderBy("t").collect()
    assert [r.t for r in fc] == list(range(60, 70))
    assert all(abs(r.forecast - ys[r.t]) < 1e-6 for r in fc)
    assert all(r.lower <= r.forecast <= r.upper for r in fc)


def test_hot_series_is_split_into_bounded_chunks(spark):
    """One series holds a third of all rows: every window group stays within
    a chunk plus its halo, and the results equal the whole-series ones."""
    from tempora.operators.aggregate import mad
    from tempora.operators.series import halo
    rows = [("hot", i, float(i % 17)) for i in range(600)] + \
        [(f"k{j}", i, float((i * j) % 11)) for j in range(40) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, t long, x double")
    p = with_position(df, "k", ["t"], "pos")
    h, _ = halo(p, "k", "pos", 4, 2, chunk_rows=50)
    biggest = h.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0]
    assert biggest <= 50 + 4 + 2
    a = TS.sliding_corr(df, "k", ["t"], "x", "t", width=7, chunk_rows=50)
    b = TS.sliding_corr(df, "k", ["t"], "x", "t", width=7)
    r = lambda d: d.select("k", "t", F.round("corr", 9).alias("c"))
    assert r(a).exceptAll(r(b)).count() == 0
    got = {x.k: x.mad for x in mad(df, "x", by="k").collect()}
    import statistics
    hot = [float(i % 17) for i in range(600)]
    med = statistics.median(hot)
    assert got["hot"] == statistics.median([abs(v - med) for v in hot])


def _simulated(n, phi, season_phi, theta, season_theta, season, seed):
    import numpy as np
    rng = np.random.default_rng(seed)
    e, d = rng.normal(0, 1, n), np.zeros(n)
    for t in range(season, n):
        d[t] = 0.1 + phi * d[t - 1] + season_phi * d[t - season] + e[t] + theta * e[t - 1] + season_theta * e[t - season]
    return np.cumsum(d), e


def test_moving_average_terms_are_recovered(spark):
    season, n = 6, 6000
    rows, true = [], {"a": (0.5, 0.2, 0.4, 0.3), "b": (-0.3, 0.3, 0.5, -0.4)}
    for i, (k, (phi, sp, th, sth)) in enumerate(true.items()):
        y, _ = _simulated(n, phi, sp, th, sth, season, i)
        rows += [(k, t, float(v)) for t, v in enumerate(y)]
    rows += [("few", t, float(t)) for t in range(10)]
    df = spark.createDataFrame(rows, "k string, t long, y double").repartition(5)
    lags = list(range(1, 25))
    # chunks far shorter than a series
    feats = FC.forecast_features(df, "k", ["t"], "y", season, lags=lags, chunk_rows=100)
    shocks = FC.with_shocks(feats, "k", n - 200, "t", [1, season], lags, chunk_rows=100).cache()
    fit = {r.k: r for r in FC.fit_arma(shocks, "k", n - 200, "t", season, [1, season]).collect()}
    for k, want in true.items():
        assert [float(c) for c in fit[k].coef[1:]] == pytest.approx(list(want), abs=0.12), k
        assert fit[k].sigma2 == pytest.approx(1.0, abs=0.1)
    # the shocks explain more than an autoregression of the same lags does
    plain = {r.k: r for r in FC.fit_ar(feats, "k", n - 200, "t", season).collect()}
    assert all(fit[k].sigma2 < plain[k].sigma2 for k in true)
    step = FC.predict_one_step(shocks.where(f"t >= {n - 200}"), FC.fit_arma(shocks, "k", n - 200, "t", season, [1, season]),
                               "k", "y", season, ma=[1, season])
    err = {r.k: r.m for r in step.groupBy("k").agg(F.avg(F.pow(F.col("y") - F.col("y_hat"), 2)).alias("m")).collect()}
    assert all(err[k] < 1.4 for k in true)
    fc = FC.fit_forecast(feats, "k", "t", "y", n - 200, 20, season, ma=[1, season], long_lags=lags)
    got = {(r.k, r.t): r for r in fc.collect()}
    assert len(got) == 40 and {k for k, _ in got} == {"a", "b"}
    # brute force of the recursion and the interval
    import numpy as np
    known = {(r.k, r.t): r for r in shocks.where(f"t >= {n - 220}").collect()}
    for k in true:
        c, phi, sp, th, sth = fit[k].coef
        level = {t: known[k, t].y for t in range(n - 220, n - 200)}
        e = {t: known[k, t].e if t < n - 200 else 0.0 for t in range(n - 220, n)}
        d = {t: known[k, t].dy for t in range(n - 220, n - 200)}
        psi = [1.0]
        for h in range(20):
            t = n - 200 + h
            d[t] = c + phi * d[t - 1] + sp * d[t - season] + th * e[t - 1] + sth * e[t - season]
            level[t] = level[t - 1] + d[t]
            assert got[k, t].forecast == pytest.approx(level[t])
            half = FC.Z95 * math.sqrt(fit[k].sigma2 * sum(x * x for x in psi[:h + 1]))
            assert got[k, t].upper - got[k, t].forecast == pytest.approx(half)
            j = h + 1
            at = lambda i: psi[j - i] if 0 <= j - i < len(psi) else 0.0
            psi.append((1 + phi) * at(1) - phi * at(2) + sp * at(season) - sp * at(season + 1)
                       + (th if j == 1 else 0) + (sth if j == season else 0))


def _dense_rows(kind):
    """Rows of three series; a third of all rows lie in one day (hour, block) of the first."""
    import datetime as dt
    import random
    rng = random.Random(3)
    t0 = dt.datetime(2024, 3, 10)
    rows = []
    for i in range(1800):
        k = "hot" if i % 3 == 0 else rng.choice(["hot", "b", None])
        if i % 3 == 0:
            at = t0 + dt.timedelta(seconds=rng.choice([0, 7, 5000, 86399]), microseconds=rng.choice([0, 1, 500000, 999999]))
        else:
            at = t0 + dt.timedelta(days=rng.randint(-40, 40), seconds=rng.randint(0, 86399))
        rows.append((k, None if i == 77 else at, i))
    number = lambda t: None if t is None else (t - t0).total_seconds() * 3.7
    return [(k, t if kind != "date" else t and t.date(), number(t), i) for k, t, i in rows]


@pytest.mark.parametrize("kind,col", [("timestamp_ntz", "t"), ("timestamp", "t"), ("date", "t"), ("timestamp_ntz", "x")])
def test_positions_split_dense_buckets(spark, monkeypatch, kind, col):
    from tempora.operators import series
    monkeypatch.setattr(series, "SMALL_BYTES", 0)
    rows = _dense_rows(kind)
    df = spark.createDataFrame(rows, f"k string, t {kind}, x double, i long").repartition(6)
    want = {}
    at = 1 if col == "t" else 2
    for key in ("hot", "b", None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[at] is not None, r[at] or 0, r[3]) if r[at] is not None
                     else (False, 0, r[3]))
        want.update({r[3]: n for n, r in enumerate(own)})
    for dense in (10 ** 9, 100, 1):
        out = with_position(df, "k", [col, "i"], dense_rows=dense)
        assert {r.i: r["_pos"] for r in out.collect()} == want
        assert out.columns == [*df.columns, "_pos"]


def test_a_dense_day_is_many_groups(spark, monkeypatch):
    from tempora.operators import series
    monkeypatch.setattr(series, "SMALL_BYTES", 0)
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 500 as string)) k", "id i",
                                        "timestamp_seconds(if(id % 3 = 0, 1700000000 + id, 1600000000 + id * 977)) t")
    plan = lambda **a: with_position(df, "k", ["t", "i"], **a)._jdf.queryExecution().optimizedPlan().toString()
    assert "_b1" in plan(dense_rows=1000) and "_b1" not in plan(dense_rows=20_000)
    groups = df.withColumn("_b0", series.default_bucket(df, "t")).withColumn("_b1", series.finer_buckets(df, "t")[0])
    assert groups.where("k = 'hot'").groupBy("_b0", "_b1").count().agg(F.max("count")).first()[0] < 20
    # an input that is small as a whole is not counted
    monkeypatch.setattr(series, "SMALL_BYTES", 1 << 40)
    assert "_b1" not in plan(dense_rows=1)


@pytest.mark.parametrize("short", [1, 20, 10_000])
def test_full_spectrum_equals_the_direct_sum(spark, short):
    import numpy as np
    rng = np.random.default_rng(8)
    series = {("a", n): rng.normal(0, 3, n) for n in (1, 2, 3, 7, 16, 97, 128, 500)}
    series[None, 33] = rng.normal(0, 1, 33)
    rows = [(k, n, i, float(x)) for (k, n), v in series.items() for i, x in enumerate(v)]
    rows += [("gap", 9, i, None if i == 4 else 1.0) for i in range(9)]
    df = spark.createDataFrame(rows, "s string, n int, t long, y double").repartition(5)
    got = {}
    for r in TS.dct_spectrum_full(df, ["s", "n"], ["t"], "y", short=short).collect():
        got.setdefault((r["s"], r["n"]), {})[r["k"]] = r.coefficient
    assert set(got.pop(("gap", 9)).values()) == {None}
    assert set(got) == set(series)
    for key, v in series.items():
        n = len(v)
        want = [2 * float(np.sum(v * np.cos(math.pi * k * (2 * np.arange(n) + 1) / (2 * n)))) for k in range(n)]
        assert [got[key][k] for k in range(n)] == pytest.approx(want, abs=1e-8)


def test_full_spectrum_makes_no_rows_per_coefficient(spark):
    df = spark.range(3000).selectExpr("id t", "sin(id) y")
    plan = TS.dct_spectrum_full(df, None, ["t"], "y", short=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    one = TS.dct_spectrum_full(df, None, ["t"], "y", short=100).agg(F.sum("coefficient").alias("c"), F.count("*").alias("n")).first()
    ref = TS.dct_spectrum(df, None, ["t"], "y", kmax=2999).agg(F.sum("coefficient").alias("c")).first()
    assert one.n == 3000 and one.c == pytest.approx(ref.c)


@pytest.mark.parametrize("most", [None, 0, 1, 3])
@pytest.mark.parametrize("chunk", [2, 1 << 16])
def test_leading_gaps_in_the_pass_of_interpolation(spark, most, chunk):
    values = {1: [None, 5.0, None, 7.0], 2: [None, None, None, 4.0, None], 3: [None] * 4, 4: [1.0, None, 3.0],
              5: [None] * 6 + [2.0], None: [None, 9.0], 6: [None]}
    rows = [(k, i, v, float(i)) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k int, t int, v double, w double")
    got = TS.interpolate(df, "k", ["t"], ["v", "w"], chunk_rows=chunk, lead={"v": most})
    want = TS.bfill(TS.interpolate(df, "k", ["t"], ["v", "w"], chunk_rows=chunk), "k", ["t"], "v", max_nulls=most,
                    chunk_rows=chunk)
    key = lambda r: (r["k"] is None, r["k"] or 0, r["t"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(*got.columns).collect()), key=str)
    assert [key(r) for r in sorted(got.collect(), key=key)] == sorted((k is None, k or 0, t) for k, t, _, _ in rows)
