import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contestry.plans import model
from contestry.plans.features import FEATURES


def games(spark, n=600, seed=3, neutral=True):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        h, a = rng.gauss(1500, 150), rng.gauss(1500, 150)
        win = rng.random() < 1 / (1 + 10 ** ((a - h) / 400))
        out.append((i, h, a, float(round(h - a)), int(neutral and rng.random() < 0.2), int(win)))
    return spark.createDataFrame(out, "MatchSequence int, HomeTeamElo double, AwayTeamElo double, EloDiff double, IsNeutral int, HomeWinFlag int")


def newton(x, y, penalty=1.0):
    """Penalised logistic regression on the summed loss; the intercept is free."""
    x = (x - x.mean(0)) / np.where(x.std(0) == 0, 1, x.std(0))
    x = np.hstack([np.ones((len(x), 1)), x])
    ridge = np.diag([0.0] + [1 / penalty] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - y) + ridge @ w)
    return 1 / (1 + np.exp(-x @ w))


@pytest.mark.parametrize("neutral", [True, False])
def test_probabilities_equal_newtons_method(spark, neutral):
    train = games(spark, neutral=neutral)
    data = train.orderBy("MatchSequence").toPandas()
    expected = newton(data[list(FEATURES)].to_numpy(float), data["HomeWinFlag"].to_numpy(float))
    out = model.fit_home_win(train).predict(train).orderBy("MatchSequence").toPandas()
    assert np.abs(out["HomeWinProb"].to_numpy() - expected).max() < 1e-4
    assert list(out.columns) == [*train.columns, "HomeWinProb", "prediction"]
    assert np.array_equal(out["EloDiff"], data["EloDiff"])  # features come back unscaled


def test_scaling_is_fitted_on_train_only(spark):
    train = games(spark, 50)
    scaling = model.fit_scaling(train)
    scaled = scaling.apply(train).select(F.avg("EloDiff"), F.stddev_pop("EloDiff")).first()
    assert scaled[0] == pytest.approx(0, abs=1e-12) and scaled[1] == pytest.approx(1)
    constant = scaling.apply(train).select("IsNeutral")
    assert constant.filter("IsNeutral IS NULL").count() == 0


def test_report(spark):
    cells = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 3 + [(0, 0)] * 4
    report = model.classification_report(spark.createDataFrame(cells, "HomeWinFlag int, prediction int"))
    by = {r["class"]: r for r in report.collect()}
    assert by["1"]["precision"] == pytest.approx(6 / 9) and by["1"]["recall"] == pytest.approx(6 / 8)
    assert by["0"]["precision"] == pytest.approx(4 / 6) and by["0"]["recall"] == pytest.approx(4 / 7)
    assert by["1"]["f1"] == pytest.approx(12 / 17) and by["0"]["f1"] == pytest.approx(8 / 13)
    assert by["accuracy"]["f1"] == pytest.approx(10 / 15)
    assert by["macro avg"]["recall"] == pytest.approx((6 / 8 + 4 / 7) / 2)
    assert by["weighted avg"]["precision"] == pytest.approx((6 / 9 * 8 + 4 / 6 * 7) / 15)
    assert {r["class"]: r["support"] for r in report.collect()} == {"0": 7, "1": 8, "accuracy": 15, "macro avg": 15, "weighted avg": 15}


def test_report_with_a_class_never_predicted(spark):
    report = model.classification_report(spark.createDataFrame([(1, 1), (0, 1)], "HomeWinFlag int, prediction int"))
    by = {r["class"]: r for r in report.collect()}
    assert by["0"]["precision"] == 0 and by["0"]["recall"] == 0 and by["0"]["f1"] == 0


def test_next_round_probabilities(spark):
    fitted = model.fit_home_win(games(spark))
    coming = spark.createDataFrame(
        [(1, 1400.0, 1600.0, -200.0, 0), (2, 1500.0, 1500.0, 0.0, 0), (3, 1600.0, 1400.0, 200.0, 0), (4, None, 1500.0, None, 0)],
        "HomeTeamId int, HomeTeamElo double, AwayTeamElo double, EloDiff double, IsNeutral int",
    )
    out = model.next_round_probabilities(fitted, coming, digits=None).orderBy("HomeTeamId").collect()
    chances = [r["HomeWinProb"] for r in out]
    assert len(out) == 3 and chances == sorted(chances) and 0 < chances[0] < chances[2] < 1
    assert all(r["HomeWinProb"] + r["AwayWinProb"] == pytest.approx(1) for r in out)
    rounded = model.next_round_probabilities(fitted, coming).first()
    assert round(rounded["HomeWinProb"], 2) == rounded["HomeWinProb"]
