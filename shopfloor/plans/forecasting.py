"""Training and scoring jobs of the sales forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.operators import forecast, series_models
from shopfloor.session import materialize


def _stored_windows(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    split = forecast.holdout_split(series, keys)
    return materialize(
        forecast.lag_windows(forecast.fit_and_scale(split, keys), keys), "lag-windows"
    )


def train_forecaster(
    series: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, forecast.Forecaster]:
    """Split, scale, build windows and fit. Returns the windows and the fitted state.

    The windows feed the fit and the predictions, so they are written once.
    """
    windows = _stored_windows(series, keys)
    model = forecast.fit_model(windows)
    # The windows carry the bounds of their series; one without training days has none.
    scaler = windows.where("low IS NOT NULL").groupBy(*keys).agg(F.first("low").alias("low"), F.first("high").alias("high"))
    return windows, forecast.Forecaster(model, scaler, tuple(keys))


def train_and_save(series: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Fit on the series, save model and scaler, return the holdout predictions."""
    windows, trained = train_forecaster(series, keys)
    trained.save(path)
    return forecast.forecast_holdout(windows, trained.model, keys)


def score_latest(spark: SparkSession, series: DataFrame, path: str) -> DataFrame:
    """Predict the latest day of each series with the saved state."""
    return forecast.forecast_latest(series, forecast.Forecaster.load(spark, path))


def train_series_models(series: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Windows of all series and one model per series, each written once."""
    windows = _stored_windows(series, keys)
    return windows, materialize(series_models.fit_series_models(windows, keys), "series-models")


def save_series_models(series: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Fit one model per series and replace the saved ones; returns the holdout predictions."""
    windows, models = train_series_models(series, keys)
    series_models.save_models(models, path)
    return series_models.predict_holdout(windows, models, keys)


def score_latest_by_series(
    spark: SparkSession, series: DataFrame, keys: Sequence[str], path: str
) -> DataFrame:
    """Predict the latest day of each series with its saved model."""
    return series_models.predict_latest(series, series_models.load_models(spark, path), keys)
