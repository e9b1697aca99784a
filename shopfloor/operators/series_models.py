"""One linear model per series, fitted side by side.

The normal equations of every series are summed in one grouped aggregate, a row
of the matrix per group, and solved inside the query. Tasks combine before the
shuffle, so what moves is one matrix of lag by lag numbers per series and task,
whatever the number of days; nothing comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopfloor.functions.scaling import scale, unscale
from shopfloor.operators.forecast import LAGS, latest_with_lags
from shopfloor.sinks.versions import current, publish

# Weight of the squared coefficients against the mean squared error. It keeps a
# series with fewer training days than lags, or a constant one, solvable.
PENALTY = 1e-3


def normal_equations(windows: DataFrame, keys: Sequence[str], lags: int = LAGS) -> DataFrame:
    """Per series the matrix of sums over its training windows, one array per row.

    A window counts as the values 1, oldest lag, …, latest lag. Row i holds the sums
    of value i times each value and, last, times the label. A series without a full
    training window has no matrix.
    """
    training = windows.where(~F.col("is_holdout") & (F.size("lags") == lags) & F.col("scaled").isNotNull())
    values = training.select(
        *keys, F.col("scaled").alias("label"), F.concat(F.array(F.lit(1.0)), F.col("lags")).alias("x")
    )
    each = values.select(*keys, "label", "x", F.posexplode("x").alias("i", "value"))
    products = [F.sum(F.col("value") * F.col("x")[j]).alias(f"s{j}") for j in range(lags + 1)]
    rows = each.groupBy(*keys, "i").agg(*products, F.sum(F.col("value") * F.col("label")).alias("target"))
    row = F.struct("i", F.array(*[f"s{j}" for j in range(lags + 1)], "target").alias("row"))
    ordered = F.array_sort(F.collect_list(row))
    return rows.groupBy(*keys).agg(F.transform(ordered, lambda r: r["row"]).alias("matrix"))


def _penalised(matrix: Column, penalty: float) -> Column:
    """Add the penalty to the diagonal, except for the constant."""
    added = matrix[0][0] * F.lit(penalty)

    def row(values: Column, i: Column) -> Column:
        return F.transform(values, lambda v, j: F.when((i == j) & (i > 0), v + added).otherwise(v))

    return F.transform(matrix, row)


def solve(matrix: Column, size: int) -> Column:
    """Solution of a symmetric positive definite system whose right side is the last column.

    Such a system needs no exchange of rows: each step clears one column.
    """

    def clear(m: Column, k: Column) -> Column:
        pivot = m[k]

        def row(values: Column, i: Column) -> Column:
            own = F.transform(values, lambda v: v / pivot[k])
            other = F.zip_with(values, pivot, lambda v, p: v - p * (values[k] / pivot[k]))
            return F.when(i == k, own).otherwise(other)

        return F.transform(m, row)

    cleared = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), matrix, clear)
    return F.transform(cleared, lambda values: F.element_at(values, -1))


def fit_series_models(
    windows: DataFrame, keys: Sequence[str], penalty: float = PENALTY, lags: int = LAGS
) -> DataFrame:
    """Keys, bounds of the scaler, intercept and one weight per lag (oldest first) of each series.

    ``penalty`` must be above 0. Series with a null key, or without a full training
    window, get no model.
    """
    if penalty <= 0:
        raise ValueError("a series may have fewer days than lags; the penalty must be above 0")
    named = windows.dropna(subset=list(keys))
    bounds = named.where("low IS NOT NULL").groupBy(*keys).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    solved = normal_equations(named, keys, lags).withColumn(
        "solution", solve(_penalised(F.col("matrix"), penalty), lags + 1)
    )
    return solved.join(bounds, list(keys)).select(
        *keys, "low", "high",
        F.col("solution")[0].alias("intercept"),
        F.slice("solution", 2, lags).alias("weights"),
    )


def _dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)


def _scaled_prediction(lags: int) -> Column:
    """Prediction in scaled units; null without a model or with an incomplete window."""
    complete = (F.size("lags") == lags) & ~F.exists("lags", lambda x: x.isNull())
    return F.when(complete & F.col("weights").isNotNull(), F.col("intercept") + _dot(F.col("lags"), F.col("weights")))


def predict_holdout(windows: DataFrame, models: DataFrame, keys: Sequence[str], lags: int = LAGS) -> DataFrame:
    """Real and predicted value for each holdout day, by the model of its series."""
    held = windows.where("is_holdout").drop("low", "high").join(models, list(keys), "left")
    pred = unscale(_scaled_prediction(lags), F.col("low"), F.col("high"))
    return held.select(*keys, "trandate", F.col("sales").alias("real"), pred.alias("pred"))


def predict_latest(series: DataFrame, models: DataFrame, keys: Sequence[str], lags: int = LAGS) -> DataFrame:
    """Actual and predicted value of the latest day of each series, by saved models."""
    latest = latest_with_lags(series, keys, lags).join(models, list(keys), "left")
    scaled = F.transform("raw", lambda x: scale(x, F.col("low"), F.col("high")))
    pred = unscale(_scaled_prediction(lags), F.col("low"), F.col("high"))
    return latest.withColumn("lags", scaled).select(*keys, "trandate", "sales", pred.alias("prediction"))


def series_residuals(
    windows: DataFrame, models: DataFrame, keys: Sequence[str], penalty: float = PENALTY, lags: int = LAGS
) -> DataFrame:
    """Per series and lag what the fit leaves of its equation, as a mean over the training windows.

    The mean product of lag and error equals the penalty times the weight, so a
    right fit leaves 0 everywhere. Lag 0 is the constant, which has no penalty.
    """
    training = windows.where(~F.col("is_holdout") & (F.size("lags") == lags)).drop("low", "high")
    error = F.col("scaled") - _scaled_prediction(lags)
    # The constant's place in the weights is 0: it is not penalised.
    pairs = F.arrays_zip(
        F.concat(F.array(F.lit(1.0)), F.col("lags")).alias("value"),
        F.concat(F.array(F.lit(0.0)), F.col("weights")).alias("weight"),
    )
    return (
        training.join(models, list(keys))
        .select(*keys, error.alias("error"), F.posexplode(pairs).alias("lag", "pair"))
        .groupBy(*keys, "lag")
        .agg(F.avg(F.col("error") * F.col("pair.value") - F.lit(penalty) * F.col("pair.weight")).alias("residual"))
    )


def save_models(models: DataFrame, path: str) -> None:
    """Replace the saved models in one step."""
    publish(models.sparkSession, path, models.write.parquet)


def load_models(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no models were saved in {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(folder)
