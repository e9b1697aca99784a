from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of
from shopfloor.operators import forecast as ops
from shopfloor.plans.forecasting import score_latest, train_and_save, train_forecaster

KEYS = ["store"]
START = date(2021, 1, 1)


def series_frame(spark, **series):
    rows = [
        (name, START + timedelta(days=i), float(v))
        for name, values in series.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "store string, trandate date, sales double")


def wave(n, seed=1):
    rng = np.random.default_rng(seed)
    return list(np.round(100 + 20 * np.sin(np.arange(n) / 3) + rng.normal(0, 5, n), 2))


@pytest.fixture(scope="module")
def series(spark):
    return series_frame(spark, a=wave(120), b=wave(90, 2), short=wave(35, 3))


@pytest.mark.parametrize(("n", "expected"), [(29, 0), (30, 0), (31, 1), (71, 41)])
def test_number_of_windows(spark, n, expected):
    df = series_frame(spark, a=range(n))
    assert ops.lag_features(df, KEYS, "sales").count() == expected


def test_windows_are_oldest_first(spark):
    df = series_frame(spark, a=range(33))
    got = ops.lag_features(df, KEYS, "sales").orderBy("trandate").collect()
    assert [r["lags"] for r in got] == [[float(v) for v in range(i, i + 30)] for i in range(3)]
    assert [r["sales"] for r in got] == [30.0, 31.0, 32.0]


def test_holdout_and_scaler(spark, series):
    split = ops.holdout_split(series, KEYS)
    counts = {(r["store"], r["is_holdout"]): r["count"] for r in split.groupBy("store", "is_holdout").count().collect()}
    assert counts == {("a", False): 80, ("a", True): 40, ("b", False): 50, ("b", True): 40, ("short", True): 35}
    params = {r["store"]: (r["low"], r["high"]) for r in ops.scaler_fit(split, KEYS).collect()}
    assert params == {"a": (min(wave(120)[:80]), max(wave(120)[:80])), "b": (min(wave(90, 2)[:50]), max(wave(90, 2)[:50]))}
    joined = ops.scaler_apply(split, ops.scaler_fit(split, KEYS), KEYS)
    own = ops.fit_and_scale(split, KEYS)
    columns = ["store", "trandate", "scaled"]
    assert joined.select(columns).exceptAll(own.select(columns)).count() == 0


def test_scale_round_trip_and_constant(spark, series):
    scaled = ops.fit_and_scale(ops.holdout_split(series, KEYS), KEYS)
    back = scaled.select("sales", ops.unscale(F.col("scaled"), F.col("low"), F.col("high")).alias("back"))
    assert back.where("abs(sales - back) > 1e-9").count() == 0
    flat = ops.fit_and_scale(ops.holdout_split(series_frame(spark, a=[5] * 50), KEYS), KEYS)
    assert [r[0] for r in flat.select("scaled").distinct().collect()] == [0.0]


def test_one_sort_for_all_series_windows(series):
    split = ops.holdout_split(series, KEYS)
    plan = plan_of(ops.lag_windows(ops.fit_and_scale(split, KEYS), KEYS))
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1


def test_series_need_a_key(series):
    with pytest.raises(ValueError):
        ops.holdout_split(series, [])
    assert ops.holdout_split(ops.single_series(series.where("store = 'a'")), ["series"]).where("is_holdout").count() == 40


def test_tail_and_report(spark):
    df = series_frame(spark, a=range(40), b=range(4))
    tail = ops.tail_window(df, KEYS)
    assert sorted(r["sales"] for r in tail.where("store = 'a'").collect()) == list(range(9, 39))
    report = ops.forecast_report(ops.mean_of_lags(df, KEYS), KEYS)
    got = {
        (s, seg): [(r["sales"], r["prediction"]) for r in report.where(f"store='{s}' AND segment='{seg}'").orderBy("trandate").collect()]
        for s in "ab"
        for seg in ("history", "bridge", "latest")
    }
    assert got["a", "history"] == [(float(v), None) for v in range(33, 39)]
    assert got["a", "bridge"] == [(38.0, None), (39.0, None)]
    assert got["a", "latest"] == [(39.0, sum(range(9, 39)) / 30)]
    assert got["b", "history"] == [(0.0, None), (1.0, None), (2.0, None)]
    assert got["b", "latest"] == [(3.0, None)]
    whole = ops.forecast_report(ops.mean_of_lags(df, KEYS), KEYS, history=None)
    assert whole.where("store = 'a' AND segment = 'history'").count() == 39
    assert whole.where("store = 'a' AND segment <> 'history'").count() == 3


def test_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 5.0, 2.0), ("b", 1.0, None)], "store string, sales double, prediction double")
    got = {r["store"]: (r["mse"], r["mae"]) for r in ops.forecast_metrics(df, KEYS).collect()}
    assert got == {"a": (5.0, 2.0), "b": (None, None)}


def test_model_against_least_squares(spark):
    """The fitted model equals ordinary least squares done by hand on all windows."""
    values = {"a": wave(160), "b": wave(140, 2)}
    split = ops.holdout_split(series_frame(spark, **values), KEYS)
    windows = ops.lag_windows(ops.fit_and_scale(split, KEYS), KEYS).cache()
    model = ops.fit_model(windows, penalty=0.0)

    x, y, tests = [], [], {}
    for name, raw in values.items():
        training = np.array(raw[:-40])
        low, high = training.min(), training.max()
        scaled = (np.array(raw) - low) / (high - low)
        for i in range(30, len(raw)):
            if i < len(raw) - 40:
                x.append(scaled[i - 30:i])
                y.append(scaled[i])
            else:
                day = START + timedelta(days=i)
                tests[name, day] = (raw[i], scaled[i - 30:i], low, high)
    design = np.column_stack([np.array(x), np.ones(len(x))])
    beta = np.linalg.lstsq(design, np.array(y), rcond=None)[0]
    assert np.allclose(model.coefficients.toArray(), beta[:-1], atol=1e-6)

    got = ops.forecast_holdout(windows, model, KEYS).collect()
    assert len(got) == len(tests) == 80
    for r in got:
        real, window, low, high = tests[r["store"], r["trandate"]]
        assert r["real"] == real
        assert r["pred"] == pytest.approx((window @ beta[:-1] + beta[-1]) * (high - low) + low, abs=1e-4)
    windows.unpersist()


def test_saved_model_scores_the_latest_day(spark, series, tmp_path):
    state = str(tmp_path / "state")
    predicted = train_and_save(series, KEYS, state)
    holdout = {(r["store"], r["trandate"]): r["pred"] for r in predicted.collect()}
    assert ops.Forecaster.load(spark, state).keys == ("store",)
    latest = {r["store"]: r for r in score_latest(spark, series, state).collect()}
    for store in "ab":
        r = latest[store]
        assert r["prediction"] == pytest.approx(holdout[store, r["trandate"]], abs=1e-9)
    assert latest["short"]["sales"] == wave(35, 3)[-1]
    assert latest["short"]["prediction"] is None  # never trained, no scaler


def test_too_few_days_give_no_prediction(spark, series, tmp_path):
    _, trained = train_forecaster(series, KEYS)
    few = ops.forecast_latest(series_frame(spark, a=wave(30)), trained).collect()
    assert [(r["store"], r["prediction"]) for r in few] == [("a", None)]
    enough = ops.forecast_latest(series_frame(spark, a=wave(31)), trained).collect()
    assert enough[0]["prediction"] is not None


def test_large_errors_do_not_overflow(spark):
    rows = [("a", 1e13 * (i % 2), 0.0) for i in range(400)]
    df = spark.createDataFrame(rows, "store string, sales double, prediction double")
    (got,) = ops.forecast_metrics(df, KEYS).collect()
    assert got["mse"] == pytest.approx(5e25) and got["mae"] == pytest.approx(5e12)


def test_no_training_day_is_a_clear_error(spark):
    with pytest.raises(ValueError, match="no training day has 30 days before it"):
        train_forecaster(series_frame(spark, a=wave(40)), KEYS)


def test_a_plain_fit_leaves_no_residual(spark):
    split = ops.holdout_split(series_frame(spark, a=wave(160), b=wave(150, 2)), KEYS)
    windows = ops.lag_windows(ops.fit_and_scale(split, KEYS), KEYS).cache()
    plain, penalised = (ops.fit_model(windows, penalty=p) for p in (0.0, 0.5))
    found = {r["lag"]: r["residual"] for r in ops.normal_residuals(windows, plain).collect()}
    assert sorted(found) == list(range(31)) and max(map(abs, found.values())) < 1e-9
    assert max(abs(r["residual"]) for r in ops.normal_residuals(windows, penalised).collect()) > 1e-6
    windows.unpersist()
