"""Firing level from power: polynomial fit, scoring, clamping and heat."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions.energy import FULL_FIRE_BTU_PER_HOUR, US_PER_HOUR
from emberline.operators.states import furnace_mode
from emberline.plans.forecast import polynomial

# The firing level (percent) fitted on the 36 usable training rows, as powers of
# (watts - 150) / 100, constant term first.
FIRING_CURVE = (81.8011126, 19.15511495, -13.29096145, 21.72912187, -15.79813058, 3.4583882)
CENTRE_W, SCALE_W = 150.0, 100.0


def drop_zero(df: DataFrame, cols) -> DataFrame:
    """Keeps rows whose columns are all known and not zero."""
    for c in cols:
        df = df.where(F.col(c) != 0)
    return df


def fit(df: DataFrame, x: str, y: str, degree: int = 5):
    """Least-squares polynomial; the input is standardised so that high powers stay exact."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=[x], outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_z", withMean=True, withStd=True),
        PolynomialExpansion(inputCol="_z", outputCol="_p", degree=degree),
        LinearRegression(featuresCol="_p", labelCol=y, predictionCol="prediction",
                         solver="normal", regParam=0.0, standardization=True),
    ]).fit(df.select(F.col(x).cast("double"), F.col(y).cast("double")).na.drop())


def predict(model, df: DataFrame, x: str) -> DataFrame:
    return model.transform(df.withColumn(x, F.col(x).cast("double"))).drop("_raw", "_z", "_p")


def line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of the straight-line fit."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def firing_level(watts: Column) -> Column:
    return polynomial((watts.cast("double") - CENTRE_W) / SCALE_W, FIRING_CURVE)


def clamp_mask(level: Column, status: Column, on: str = "ON") -> Column:
    """Level kept within 40 and 100, and 0 where the furnace is not on; unknown status keeps it."""
    held = F.least(F.greatest(level, F.lit(40.0)), F.lit(100.0))
    return F.when(status != on, F.lit(0.0)).otherwise(held)


def heat(level: Column, gap_us: Column, status: Column, on: str = "ON") -> Column:
    return F.when(
        status == on, level / 100 * FULL_FIRE_BTU_PER_HOUR * (gap_us.cast("double") / US_PER_HOUR))


def score(filled: DataFrame) -> DataFrame:
    """Status, firing level and BTU of each interval of (status, watts, gap_us)."""
    mode = furnace_mode(F.col("status"), F.col("watts"), F.col("gap_us") / 1e6)
    x = filled.withColumn("status", mode)
    x = x.withColumn("watts", F.coalesce("watts", F.lit(0)))
    x = x.withColumn("heatcall", clamp_mask(firing_level(F.col("watts")), F.col("status")))
    return x.withColumn("btu", heat(F.col("heatcall"), F.col("gap_us"), F.col("status")))
