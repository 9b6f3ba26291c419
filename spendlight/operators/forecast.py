"""Linear models of revenue."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ["spend_usd", "impressions", "clicks"]


def revenue_line(daily_totals: DataFrame) -> DataFrame:
    """Least-squares line of revenue on spend, one row per input table.

    Takes columns ``spend`` and ``revenue``, e.g. the daily trend.
    """
    y, x = F.col("revenue").cast("double"), F.col("spend").cast("double")
    return daily_totals.agg(
        F.round(F.regr_slope(y, x).cast("decimal(38,12)"), 6).cast("double").alias("slope"),
        F.round(F.regr_intercept(y, x).cast("decimal(38,12)"), 4).cast("double").alias("intercept"),
        F.count("*").alias("n"),
    )


def _with_features(df: DataFrame) -> DataFrame:
    numeric = df.withColumns({name: F.col(name).cast("double") for name in [*FEATURES, "revenue_usd"]})
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(numeric)


def fit_revenue_model(monthly: DataFrame) -> LinearRegressionModel:
    """Revenue on spend, impressions and clicks, by the normal equations
    (one pass that adds up a small matrix; no rows leave the executors)."""
    learner = LinearRegression(featuresCol="features", labelCol="revenue_usd", solver="normal", standardization=False)
    return learner.fit(_with_features(monthly))


def predict_revenue(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    """``df`` with the model's ``predicted_revenue_usd``."""
    return model.setPredictionCol("predicted_revenue_usd").transform(_with_features(df)).drop("features")
