from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of
from shopfloor.operators import forecast, series_models as ops
from shopfloor.plans.forecasting import save_series_models, score_latest_by_series, train_series_models

KEYS = ["store"]
START = date(2021, 1, 1)
PENALTY = ops.PENALTY


def wave(n, seed):
    rng = np.random.default_rng(seed)
    return list(np.round(100 + 20 * np.sin(np.arange(n) / 3) + rng.normal(0, 5, n), 2))


VALUES = {"a": wave(180, 1), "b": [v * 1000 for v in wave(150, 2)], "few": wave(75, 3), "flat": [5.0] * 120, "short": wave(60, 4), "tiny": wave(35, 5)}


@pytest.fixture(scope="module")
def series(spark):
    rows = [(name, START + timedelta(days=i), float(v)) for name, values in VALUES.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "store string, trandate date, sales double")


@pytest.fixture(scope="module")
def trained(series):
    return train_series_models(series, KEYS)


def by_hand(raw):
    """Bounds, intercept and weights of one series by a penalised least-squares fit."""
    training = np.array(raw[:-40])
    low, high = training.min(), training.max()
    scaled = (np.array(raw) - low) / ((high - low) or 1.0)
    x = np.array([np.append(1.0, scaled[i - 30:i]) for i in range(30, len(training))])
    y = scaled[30:len(training)]
    shrink = np.eye(31) * PENALTY * len(x)
    shrink[0, 0] = 0
    return low, high, scaled, np.linalg.solve(x.T @ x + shrink, x.T @ y)


def test_every_series_has_its_own_fit(trained):
    models = {r["store"]: r for r in trained[1].collect()}
    # "few" has five training windows for 31 numbers; "short" and "tiny" have none.
    assert sorted(models) == ["a", "b", "few", "flat"]
    for name, found in models.items():
        low, high, _, expected = by_hand(VALUES[name])
        assert (found["low"], found["high"]) == (low, high)
        assert np.allclose([found["intercept"], *found["weights"]], expected, atol=1e-8)
    assert not np.allclose(models["a"]["weights"], models["b"]["weights"], atol=1e-3)


def test_holdout_predictions(trained):
    got = {(r["store"], r["trandate"]): (r["real"], r["pred"]) for r in ops.predict_holdout(*trained, KEYS).collect()}
    assert len(got) == 5 * 40 + 35
    for name, raw in VALUES.items():
        for i in range(max(len(raw) - 40, 0), len(raw)):
            real, pred = got[name, START + timedelta(days=i)]
            assert real == raw[i]
            if name in ("short", "tiny"):
                assert pred is None
                continue
            low, high, scaled, b = by_hand(raw)
            expected = (b[0] + scaled[i - 30:i] @ b[1:]) * ((high - low) or 1.0) + low
            assert pred == pytest.approx(expected, rel=1e-8)


def test_residuals_vanish_only_for_the_right_fit(trained):
    windows, models = trained
    left = ops.series_residuals(windows, models, KEYS).collect()
    assert len(left) == 4 * 31 and max(abs(r["residual"]) for r in left) < 1e-10
    moved = models.withColumn("intercept", F.col("intercept") + 0.01)
    assert max(abs(r["residual"]) for r in ops.series_residuals(windows, moved, KEYS).collect()) > 1e-3


def test_saved_models_score_the_latest_day(spark, series, tmp_path):
    path = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        ops.load_models(spark, path)
    holdout = {(r["store"], r["trandate"]): r["pred"] for r in save_series_models(series, KEYS, path).collect()}
    latest = score_latest_by_series(spark, series, KEYS, path).collect()
    assert sorted(r["store"] for r in latest) == sorted(VALUES)
    for r in latest:
        expected = holdout[r["store"], r["trandate"]]
        assert r["prediction"] == (None if expected is None else pytest.approx(expected, rel=1e-9))
    # A location that opened after the training has rows but no model.
    new = spark.createDataFrame([("new", START, 1.0)], "store string, trandate date, sales double")
    assert [tuple(r) for r in score_latest_by_series(spark, new, KEYS, path).collect()] == [("new", START, 1.0, None)]


def test_a_failed_save_keeps_the_models(spark, trained, tmp_path):
    path, models = str(tmp_path / "models"), trained[1]
    ops.save_models(models, path)
    broken = models.withColumn("intercept", F.raise_error(F.lit("stopped")).cast("double"))
    with pytest.raises(Exception, match="stopped"):
        ops.save_models(broken, path)
    assert ops.load_models(spark, path).count() == models.count()


def test_null_keys_empty_tables_and_penalty(spark, series):
    unnamed = series.where("store = 'a'").withColumn("store", F.lit(None).cast("string"))
    windows, models = train_series_models(series.where("store = 'a'").unionByName(unnamed), KEYS)
    assert [r["store"] for r in models.collect()] == ["a"]
    held = ops.predict_holdout(windows, models, KEYS).collect()
    assert {(r["store"], r["pred"] is None) for r in held} == {("a", False), (None, True)}
    windows, models = train_series_models(series.where("false"), KEYS)
    assert models.count() == 0 and ops.predict_holdout(windows, models, KEYS).count() == 0
    with pytest.raises(ValueError, match="penalty"):
        ops.fit_series_models(windows, KEYS, penalty=0.0)


def test_repeated_runs_over_more_parts_agree(series, trained):
    spread = forecast.lag_windows(forecast.fit_and_scale(forecast.holdout_split(series.repartition(7), KEYS), KEYS), KEYS)
    again = {r["store"]: r["weights"] for r in ops.fit_series_models(spread, KEYS).collect()}
    for r in trained[1].collect():
        assert np.allclose(again[r["store"]], r["weights"], atol=1e-9)


def test_sums_are_combined_before_the_shuffle(trained):
    """No window moves: only partial matrix rows do, and no Python runs."""
    plan = plan_of(ops.normal_equations(trained[0], KEYS))
    assert "partial_sum" in plan and "Python" not in plan and "Join" not in plan
    below = plan[plan.index("Exchange"):]
    assert "partial_sum" in below.split("Exchange")[-1]
