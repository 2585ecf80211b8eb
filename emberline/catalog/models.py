"""Polynomial fit and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.filters import FILLED, MODE, filled, filled_sql
from emberline.catalog.registry import query
from emberline.operators import model
from emberline.sources import series
from emberline.sources.files import table

_Z = "((CAST(watts AS DOUBLE) - 150) / 100)"
LEVEL = "(" + " + ".join(f"({c!r}e0)" + f"*{_Z}" * i for i, c in enumerate(model.FIRING_CURVE)) + ")"
HELD = f"CASE WHEN mode <> 'ON' THEN 0 ELSE least(greatest({LEVEL}, 40), 100) END"
SCORED = f"{FILLED}, md AS (SELECT *, {MODE} AS mode FROM fl), sc AS (SELECT *, {HELD} AS heatcall FROM md)"
SCORED_EACH = SCORED.replace(FILLED, filled_sql("key"))
HEAT_SQL = "CASE WHEN mode = 'ON' THEN heatcall / 100 * 60000 * (gap_us / 3.6e9) END"


@query("poly_fit_deg1", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
FROM lineitem""")
def poly_fit_deg1(spark, sf):
    f = model.line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return f.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


def orthogonal_fit_sql(degree: int) -> str:
    """Least squares by polynomials that are orthogonal under the counts of the distinct quantities."""
    ctes = ["""d AS (SELECT l_quantity, (CAST(l_quantity AS DOUBLE) - 25.5) / 24.5 AS z, count(*) AS n,
  sum(CAST(l_extendedprice AS DOUBLE)) AS y FROM lineitem GROUP BY 1, 2)""", "p0 AS (SELECT *, 1e0 AS v0 FROM d)"]
    for k in range(degree):
        below = f"- v{k - 1} * (SELECT sum(n * v{k} * v{k}) / sum(n * v{k - 1} * v{k - 1}) FROM p{k})" if k else ""
        ctes.append(f"p{k + 1} AS (SELECT *, v{k} * (z - (SELECT sum(n * z * v{k} * v{k}) / sum(n * v{k} * v{k}) FROM p{k})) {below} AS v{k + 1} FROM p{k})")
    terms = " + ".join(f"v{k} * (SELECT sum(y * v{k}) / sum(n * v{k} * v{k}) FROM p{degree})" for k in range(degree + 1))
    return f"WITH {', '.join(ctes)} SELECT l_quantity, n, round({terms}, 4) AS prediction FROM p{degree}"


@query("poly_fit", orthogonal_fit_sql(5))
def poly_fit(spark, sf):
    """Degree-5 fit over all line items, evaluated at every quantity."""
    items = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    fitted = model.fit(items, "l_quantity", "l_extendedprice")
    at = items.groupBy("l_quantity").agg(F.count("*").alias("n"))
    return model.predict(fitted, at, "l_quantity").select("l_quantity", "n", F.round("prediction", 4).alias("prediction"))


@query("poly_score", f"""
WITH {SCORED} SELECT tie AS event_id, mode AS status, round(heatcall, 6) AS heatcall, round({HEAT_SQL}, 6) AS btu FROM sc""")
def poly_score(spark, sf):
    return model.score(filled(spark, sf)).select(
        F.col("tie").alias("event_id"), "status", F.round("heatcall", 6).alias("heatcall"), F.round("btu", 6).alias("btu"))


@query("poly_grid", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem)
SELECT CAST(x AS INTEGER) AS x, round(i + s * x, 4) AS prediction FROM range(401) g(x), f""")
def poly_grid(spark, sf):
    f = model.line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    slope, intercept = f.select("slope").scalar(), f.select("intercept").scalar()
    return series.integers(spark, 0, 400, "x").select("x", F.round(intercept + slope * F.col("x"), 4).alias("prediction"))
