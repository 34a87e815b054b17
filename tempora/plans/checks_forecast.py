"""Checks for forecasting (F16-F18, H11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.operators import aggregate as agg
from tempora.operators import forecast as FC
from tempora.plans import products as H
from tempora.plans import standins as S
from tempora.plans.checks_series import _USER_DAILY
from tempora.plans.checks_relational import WEATHER, _with
from tempora.plans.registry import check, rounded

KEY = "municipalityno"
SEASON = 7
CUTOFF = "2024-01-24"

_EXOG = """ex AS (SELECT user_id AS municipalityno, CAST(ts AS DATE) AS day,
    avg(CAST(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE)) AS temp FROM events GROUP BY 1, 2)"""


Z95 = 1.959963984540054


def _det(m: list[list[str]]) -> str:
    """A determinant as an SQL expression."""
    if len(m) == 1:
        return m[0][0]
    return "(" + " ".join(f"{'-' if j % 2 else '+'} {m[0][j]} * {_det([[*r[:j], *r[j + 1:]] for r in m[1:]])}"
                          for j in range(len(m))) + ")"


def _ols_sql(name: str, frm: str, by: str, y: str, xs: list[str]) -> str:
    """CTE ``name``: least squares per ``by`` from the moments, with Cramer's rule: b0, b1.., sigma2, n."""
    p = len(xs)
    s = lambda i, j: f"s{min(i, j)}_{max(i, j)}"
    full = [[s(i, j) for j in range(p)] for i in range(p)]
    moments = [f"covar_pop({xs[i]}, {xs[j]}) AS {s(i, j)}" for i in range(p) for j in range(i, p)]
    moments += [f"covar_pop({x}, {y}) AS sy{i}" for i, x in enumerate(xs)] + [f"avg({x}) AS m{i}" for i, x in enumerate(xs)]
    slopes = [f"{_det([[f'sy{r}' if c == i else full[r][c] for c in range(p)] for r in range(p)])} / {_det(full)} AS b{i + 1}"
              for i in range(p)]
    return f"""{name}_m AS (SELECT {by}, {', '.join(moments)}, avg({y}) AS my, var_pop({y}) AS vy, count(*) AS n
    FROM {frm} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [y, *xs])} GROUP BY {by} HAVING count(*) > {p + 1}),
  {name}_b AS (SELECT *, {', '.join(slopes)} FROM {name}_m),
  {name} AS (SELECT {by}, my - ({' + '.join(f'b{i + 1} * m{i}' for i in range(p))}) AS b0,
    {', '.join(f'b{i + 1}' for i in range(p))}, n,
    greatest(n * (vy - ({' + '.join(f'b{i + 1} * sy{i}' for i in range(p))})), 0.0) / (n - {p + 1}) AS sigma2 FROM {name}_b)"""


_FIT = """f0 AS (SELECT municipalityno, day, value, row_number() OVER w - 1 AS pos, value - lag(value, 1) OVER w AS dy,
    lag(value, 1) OVER w - lag(value, 2) OVER w AS dy1, lag(value, 7) OVER w - lag(value, 8) OVER w AS dy7
    FROM ud WINDOW w AS (PARTITION BY municipalityno ORDER BY day)),
  f AS (SELECT f0.*, ex.temp FROM f0 LEFT JOIN ex ON f0.municipalityno = ex.municipalityno AND f0.day = ex.day),
  train AS (SELECT * FROM f WHERE day < DATE '2024-01-24'),
  """ + _ols_sql("fit", "train", "municipalityno", "dy", ["dy1", "dy7", "temp"])

# the horizon is one season, so the seasonal lag is always known; psi_j is the sum of phi**0 .. phi**j
_FORECAST = """p0 AS (SELECT municipalityno, min(pos) AS p0 FROM f WHERE day >= DATE '2024-01-24' GROUP BY 1 HAVING min(pos) >= 9),
  steps AS (SELECT f.municipalityno, f.day, f.pos - p0 AS h, dy7, temp, b0, b1, b2, b3, sigma2 FROM f
    JOIN p0 USING (municipalityno) JOIN fit USING (municipalityno) WHERE pos >= p0 AND pos < p0 + 7),
  before AS (SELECT municipalityno, value, dy FROM f JOIN p0 USING (municipalityno) WHERE pos = p0 - 1),
  walk AS (SELECT s.municipalityno, s.day, h, b0 + b1 * dy + b2 * dy7 + b3 * temp AS d,
      value + b0 + b1 * dy + b2 * dy7 + b3 * temp AS forecast, 1.0::DOUBLE AS psi, 1.0::DOUBLE AS total, sigma2
    FROM steps s JOIN before USING (municipalityno) WHERE h = 0
    UNION ALL
    SELECT s.municipalityno, s.day, s.h, s.b0 + s.b1 * w.d + s.b2 * s.dy7 + s.b3 * s.temp,
      w.forecast + s.b0 + s.b1 * w.d + s.b2 * s.dy7 + s.b3 * s.temp, 1 + s.b1 * w.psi,
      w.total + (1 + s.b1 * w.psi) * (1 + s.b1 * w.psi), s.sigma2
    FROM walk w JOIN steps s ON s.municipalityno = w.municipalityno AND s.h = w.h + 1),
  fc AS (SELECT municipalityno, day, round(forecast, 4) AS forecast,
    round(forecast - %(z)s * sqrt(sigma2 * total), 4) AS lower,
    round(forecast + %(z)s * sqrt(sigma2 * total), 4) AS upper FROM walk)""" % {"z": Z95}


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _daily(spark, d):
    """Daily production per municipality (dense, frame spine)."""
    return agg.resample_daily(S.readings(spark, d), "hourutc", "value", by=KEY, agg="sum", spine="frame")


def _exog(spark, d):
    ev = S.table(spark, d, "events")
    return (ev.groupBy(F.col("user_id").alias(KEY), F.to_date("ts").alias("day"))
            .agg(F.avg(F.regexp_extract("props", r'"k": (\d+)', 1).cast("double")).alias("temp")))


def _features(spark, d):
    return FC.forecast_features(_daily(spark, d), KEY, ["day"], "value", SEASON,
                                _exog(spark, d), ["temp"], [KEY, "day"])


@check("f16_forecast_features", _with(_USER_DAILY, _EXOG) + """,
  f AS (SELECT municipalityno, day, value, row_number() OVER w - 1 AS pos,
    value - lag(value, 1) OVER w AS dy, lag(value, 1) OVER w - lag(value, 2) OVER w AS dy_lag1,
    lag(value, 7) OVER w - lag(value, 8) OVER w AS dy_lag7
    FROM ud WINDOW w AS (PARTITION BY municipalityno ORDER BY day))
  SELECT f.municipalityno, f.day, round(f.value, 6) AS value, f.pos, round(dy, 6) AS dy,
    round(dy_lag1, 6) AS dy_lag1, round(dy_lag7, 6) AS dy_lag7, round(ex.temp, 6) AS temp
  FROM f LEFT JOIN ex ON f.municipalityno = ex.municipalityno AND f.day = ex.day""")
def _f16(spark, d):
    return rounded(_features(spark, d))


@check("f17_ols_one", _with(_USER_DAILY) + """,
  f AS (SELECT municipalityno, day, value - lag(value, 1) OVER w AS dy,
    lag(value, 1) OVER w - lag(value, 2) OVER w AS dy_lag1
    FROM ud WINDOW w AS (PARTITION BY municipalityno ORDER BY day))
  SELECT municipalityno, round(regr_intercept(dy, dy_lag1), 6) AS intercept,
    round(regr_slope(dy, dy_lag1), 6) AS slope, regr_count(dy, dy_lag1) AS n
  FROM f WHERE day < DATE '2024-01-24' GROUP BY 1 HAVING regr_count(dy, dy_lag1) > 2""")
def _f17a(spark, d):
    feats = _features(spark, d).filter(F.col("day") < F.lit(CUTOFF).cast("date"))
    fit = FC.fit_ols(feats, KEY, "dy", ["dy_lag1"]).filter(F.col("n") > 2)
    return rounded(fit.select(KEY, F.col("coef")[0].alias("intercept"), F.col("coef")[1].alias("slope"), "n"))


@check("f17_fit_forecast", _recursive(_with(_USER_DAILY, _EXOG, _FIT, _FORECAST)) + "SELECT * FROM fc")
def _f17(spark, d):
    out = FC.fit_forecast(_features(spark, d), KEY, "day", "value", CUTOFF, horizon=7,
                          season=SEASON, exog=["temp"])
    return rounded(out, 4)


@check("f17_fit_ar", _with(_USER_DAILY, _EXOG, _FIT) + """SELECT municipalityno, round(b0, 4) AS c, round(b1, 4) AS phi,
  round(b2, 4) AS season_phi, round(b3, 4) AS beta, round(sigma2, 4) AS sigma2, n FROM fit""")
def _f17_fit(spark, d):
    fit = FC.fit_ar(_features(spark, d), KEY, CUTOFF, "day", SEASON, ["temp"]).filter(F.col("n") > 4)
    coef = [F.col("coef")[i].alias(c) for i, c in enumerate(("c", "phi", "season_phi", "beta"))]
    return rounded(fit.select(KEY, *coef, "sigma2", "n"), 4)


@check("f17_predict_one_step", _with(_USER_DAILY, _EXOG, _FIT) + """SELECT municipalityno, day, round(value, 4) AS value,
  round(value - dy + b0 + b1 * dy1 + b2 * dy7 + b3 * temp, 4) AS y_hat
  FROM f JOIN fit USING (municipalityno) WHERE day >= DATE '2024-01-24'""")
def _f17b(spark, d):
    feats = _features(spark, d)
    coefs = FC.fit_ar(feats, KEY, CUTOFF, "day", SEASON, ["temp"]).filter(F.col("n") > 4)
    out = FC.predict_one_step(feats.filter(F.col("day") >= F.lit(CUTOFF).cast("date")), coefs, KEY,
                              "value", SEASON, ["temp"])
    return rounded(out.select(KEY, "day", "value", "y_hat"), 4)


# both stages of the moving-average fit on the one series of daily quantities
_ARMA = """a AS (SELECT 0 AS one, day, qty, qty - lag(qty, 1) OVER w AS dy, lag(qty, 1) OVER w - lag(qty, 2) OVER w AS dy1,
    lag(qty, 2) OVER w - lag(qty, 3) OVER w AS dy2, lag(qty, 7) OVER w - lag(qty, 8) OVER w AS dy7
    FROM weather WINDOW w AS (ORDER BY day)),
  long_train AS (SELECT * FROM a WHERE day < DATE '2001-01-01'),
  """ + _ols_sql("first", "long_train", "one", "dy", ["dy1", "dy2"]) + """,
  shocks AS (SELECT a.*, dy - (b0 + b1 * dy1 + b2 * dy2) AS e FROM a, first),
  lagged AS (SELECT *, lag(e, 1) OVER (ORDER BY day) AS e1 FROM shocks),
  arma_train AS (SELECT * FROM lagged WHERE day < DATE '2001-01-01'),
  """ + _ols_sql("second", "arma_train", "one", "dy", ["dy1", "dy7", "e1"])


def _arma(spark, d):
    feats = FC.forecast_features(S.weather_daily(spark, d), None, ["day"], "qty", SEASON, lags=[2])
    feats = FC.with_shocks(feats, None, "2001-01-01", "day", [1], [1, 2])
    return feats, FC.fit_arma(feats, None, "2001-01-01", "day", SEASON, [1])


@check("f17_fit_arma", _with(WEATHER, _ARMA) + """SELECT round(b0, 4) AS c, round(b1, 4) AS phi, round(b2, 4) AS season_phi,
  round(b3, 4) AS theta, round(sigma2, 2) AS sigma2, n FROM second""")
def _f17_arma(spark, d):
    coef = [F.col("coef")[i].alias(c) for i, c in enumerate(("c", "phi", "season_phi", "theta"))]
    fit = rounded(_arma(spark, d)[1].select(*coef, "sigma2", "n"), 4)
    return fit.withColumn("sigma2", F.round("sigma2", 2))


@check("f17_arma_one_step", _with(WEATHER, _ARMA) + """SELECT day, round(qty, 4) AS qty,
  round(qty - dy + b0 + b1 * dy1 + b2 * dy7 + b3 * e1, 4) AS y_hat FROM lagged, second WHERE day >= DATE '2001-01-01'""")
def _f17_arma_step(spark, d):
    feats, coefs = _arma(spark, d)
    out = FC.predict_one_step(feats.filter(F.col("day") >= F.lit("2001-01-01").cast("date")), coefs, None, "qty",
                              SEASON, ma=[1])
    return rounded(out.select("day", "qty", "y_hat"), 4)


@check("h11_forecast_frame", _recursive(_with(_USER_DAILY, _EXOG, _FIT, _FORECAST)) + """SELECT ud.municipalityno, ud.day,
  round(ud.value, 4) AS observed, forecast, lower, upper FROM ud LEFT JOIN fc ON fc.municipalityno = ud.municipalityno
  AND fc.day = ud.day WHERE ud.day >= DATE '2023-11-24'""")
def _h11(spark, d):
    out = H.forecast_frame(_daily(spark, d), "day", KEY, "value", CUTOFF, horizon=7, season=SEASON,
                           exog=_exog(spark, d), exog_cols=["temp"], months_before=2)
    return rounded(out, 4)
