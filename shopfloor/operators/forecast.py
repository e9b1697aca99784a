"""Daily series: holdout, scaling, lag windows, next-day model and report.

A series is a frame with one row per key and day: the key columns, ``trandate``
and ``sales``. A group of the windows below is one series and so never exceeds
the number of calendar days. A single series gets a constant key, see
``single_series``; many series run side by side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from shopfloor.functions.scaling import scale, unscale
from shopfloor.sinks.versions import current, publish

# Window length and holdout length in days.
LAGS = 30
HOLDOUT = 40


def single_series(daily: DataFrame, name: str = "all") -> DataFrame:
    return daily.withColumn("series", F.lit(name))


def _by_day(keys: Sequence[str]) -> WindowSpec:
    if not keys:
        raise ValueError("a series needs a key; see single_series")
    return Window.partitionBy(*keys).orderBy("trandate")


def _whole(keys: Sequence[str]) -> WindowSpec:
    """The full series, ordered all the same: every window then shares one sort."""
    return _by_day(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _from_end(keys: Sequence[str]) -> Column:
    """0 for the latest day, 1 for the one before, and so on."""
    return F.count(F.lit(1)).over(_whole(keys)) - F.row_number().over(_by_day(keys))


def holdout_split(series: DataFrame, keys: Sequence[str], holdout: int = HOLDOUT) -> DataFrame:
    """Mark the last ``holdout`` rows of each series."""
    return series.withColumn("is_holdout", _from_end(keys) < holdout)


def scaler_fit(split: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Smallest and largest value of the training part, per series."""
    return (
        split.where(~F.col("is_holdout"))
        .groupBy(*keys)
        .agg(F.min("sales").alias("low"), F.max("sales").alias("high"))
    )


def scaler_apply(series: DataFrame, params: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Scale with saved parameters; a series without any scales to null."""
    return series.join(params, list(keys), "left").withColumn(
        "scaled", scale(F.col("sales"), F.col("low"), F.col("high"))
    )


def fit_and_scale(split: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fit on the training part and scale everything within one window, without a join."""
    training = F.when(~F.col("is_holdout"), F.col("sales"))
    return split.withColumns(
        {"low": F.min(training).over(_whole(keys)), "high": F.max(training).over(_whole(keys))}
    ).withColumn("scaled", scale(F.col("sales"), F.col("low"), F.col("high")))


def lag_windows(
    series: DataFrame, keys: Sequence[str], value: str = "scaled", lags: int = LAGS
) -> DataFrame:
    """The ``lags`` values before each row, oldest first; early rows have fewer.

    Built on the whole series, so the first holdout rows look back into the
    training part.
    """
    before = _by_day(keys).rowsBetween(-lags, -1)
    return series.withColumn("lags", F.collect_list(value).over(before))


def lag_features(
    series: DataFrame, keys: Sequence[str], value: str = "scaled", lags: int = LAGS
) -> DataFrame:
    """The rows with a full window."""
    return lag_windows(series, keys, value, lags).where(F.size("lags") == lags)


def mean_of_lags(series: DataFrame, keys: Sequence[str], lags: int = LAGS) -> DataFrame:
    """Baseline: the mean of the days before, null without a full window."""
    before = _by_day(keys).rowsBetween(-lags, -1)
    return series.withColumn(
        "prediction", F.when(F.count("sales").over(before) == lags, F.avg("sales").over(before))
    )


def tail_window(series: DataFrame, keys: Sequence[str], lags: int = LAGS) -> DataFrame:
    """The ``lags`` rows before the latest one."""
    return (
        series.withColumn("from_end", _from_end(keys))
        .where(F.col("from_end").between(1, lags))
        .drop("from_end")
    )


def forecast_report(
    predicted: DataFrame, keys: Sequence[str], history: int | None = 6
) -> DataFrame:
    """Rows of the report by segment: history, bridge and latest.

    History is the ``history`` days before the latest (None: all of them),
    bridge the last two, latest the last one with its prediction. A day may be
    in two segments.
    """
    back = F.col("from_end")
    past = back >= 1 if history is None else back.between(1, history)
    segments = F.array_compact(
        F.array(
            F.when(past, F.lit("history")),
            F.when(back <= 1, F.lit("bridge")),
            F.when(back == 0, F.lit("latest")),
        )
    )
    return (
        predicted.withColumn("from_end", _from_end(keys))
        .where(past | (back <= 1))
        .withColumn("segment", F.explode(segments))
        .select(
            *keys, "trandate", "segment", "sales",
            F.when(F.col("segment") == "latest", F.col("prediction")).alias("prediction"),
        )
    )


def forecast_metrics(predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean squared and mean absolute error per series.

    Errors are summed as exact decimals with six digits, so that the result
    does not depend on the order in which tasks deliver them.
    """
    error = (F.col("sales") - F.col("prediction")).cast("decimal(28,6)")

    def mean(total: Column) -> Column:
        return F.sum(total).cast("double") / F.count(error)

    return predicted.groupBy(*keys).agg(
        F.when(F.count(error) > 0, mean(error * error)).alias("mse"),
        F.when(F.count(error) > 0, mean(F.abs(error))).alias("mae"),
    )


# --- model --------------------------------------------------------------------


def normal_residuals(windows: DataFrame, model: LinearRegressionModel, lags: int = LAGS) -> DataFrame:
    """Per lag the mean product of lag and error over the training windows.

    A least-squares fit without penalty leaves 0 for every lag, and for the
    constant, which is lag 0 here.
    """
    training = windows.where(~F.col("is_holdout") & (F.size("lags") == lags))
    fitted = model.copy({model.predictionCol: "fitted"}).transform(
        training.withColumn("features", array_to_vector("lags"))
    )
    error = F.col("scaled") - F.col("fitted")
    return (
        fitted.select(error.alias("error"), F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("lags"))).alias("lag", "value"))
        .groupBy("lag")
        .agg(F.avg(F.col("error") * F.col("value")).alias("residual"))
    )


@dataclass(frozen=True)
class Forecaster:
    """A fitted model with the scaler parameters it was trained on."""

    model: LinearRegressionModel
    scaler: DataFrame
    keys: tuple[str, ...]

    def save(self, path: str) -> None:
        """Replace the saved state; model and scaler change together or not at all."""

        def write(folder: str) -> None:
            self.model.write().save(f"{folder}/model")
            self.scaler.write.parquet(f"{folder}/scaler")

        publish(self.scaler.sparkSession, path, write)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forecaster:
        folder = current(spark, path)
        if folder is None:
            raise FileNotFoundError(f"no forecaster was saved in {path}")
        scaler = spark.read.parquet(f"{folder}/scaler")
        keys = tuple(c for c in scaler.columns if c not in ("low", "high"))
        return cls(LinearRegressionModel.load(f"{folder}/model"), scaler, keys)


def fit_model(windows: DataFrame, penalty: float = 1e-4, lags: int = LAGS) -> LinearRegressionModel:
    """One linear model over the full training windows of all series.

    The normal-equation solver passes over the data once and brings a matrix of
    lag by lag numbers to the driver, whatever the number of rows.
    """
    rows = windows.where(~F.col("is_holdout") & (F.size("lags") == lags)).select(
        array_to_vector("lags").alias("features"), F.col("scaled").alias("label")
    )
    if rows.isEmpty():
        raise ValueError(f"no training day has {lags} days before it")
    return LinearRegression(solver="normal", regParam=penalty).fit(rows)


def predict(windows: DataFrame, model: LinearRegressionModel, lags: int = LAGS) -> DataFrame:
    """Add the prediction in original units; null where a window is incomplete."""
    complete = (F.size("lags") == lags) & ~F.exists("lags", lambda x: x.isNull())
    zeros = F.array_repeat(F.lit(0.0), lags)
    usable = windows.withColumns(
        {"complete": complete, "features": array_to_vector(F.when(complete, F.col("lags")).otherwise(zeros))}
    )
    back = unscale(F.col("scaled_prediction"), F.col("low"), F.col("high"))
    return (
        model.copy({model.predictionCol: "scaled_prediction"})
        .transform(usable)
        .withColumn("prediction", F.when(F.col("complete"), back))
        .drop("complete", "features", "scaled_prediction")
    )


def forecast_holdout(windows: DataFrame, model: LinearRegressionModel, keys: Sequence[str]) -> DataFrame:
    """Real and predicted value for each holdout day."""
    return predict(windows.where("is_holdout"), model).select(
        *keys, "trandate", F.col("sales").alias("real"), F.col("prediction").alias("pred")
    )


def latest_with_lags(series: DataFrame, keys: Sequence[str], lags: int = LAGS) -> DataFrame:
    """The latest day of each series with the values before it, oldest first, as ``raw``."""
    before = _by_day(keys).rowsBetween(-lags, -1)
    return series.withColumns(
        {"raw": F.collect_list("sales").over(before), "from_end": _from_end(keys)}
    ).where("from_end = 0")


def forecast_latest(series: DataFrame, forecaster: Forecaster, lags: int = LAGS) -> DataFrame:
    """Actual and predicted value of the latest day of each series, by a saved model."""
    keys = forecaster.keys
    latest = latest_with_lags(series, keys, lags).join(forecaster.scaler, list(keys), "left")
    scaled = F.transform("raw", lambda x: scale(x, F.col("low"), F.col("high")))
    return predict(latest.withColumn("lags", scaled), forecaster.model, lags).select(
        *keys, "trandate", "sales", "prediction"
    )
