"""Metrics, preparation, search, scoring."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from seatflow.operators import learning, metrics
from seatflow.operators.ordering import temporal_cut
from seatflow.runtime import stored
from seatflow.schemas import (
    ALL_FEATURES,
    BOOLEAN_FEATURES,
    CATEGORICAL_FEATURES,
    CLASS_NAMES,
    NUMERIC_FEATURES,
)

FEATURES = (
    "hour int, route_id string, direction_id int, temperature_2m double, precipitation double, windspeed_10m double, "
    "cloudcover int, prev_temperature_2m double, prev_precipitation double, prev_windspeed_10m double, prev_cloudcover int, "
    "month int, weekday string, is_weekend boolean, is_holiday_se boolean, is_workday_se boolean"
)
ROWS = [
    (8, "100", 0, None, 0.0, 3.0, 50, 4.0, 0.1, 2.0, 60, 1, "Monday", False, False, True),
    (12, None, 1, 15.0, 1.0, 5.0, 100, 14.0, 0.0, 4.0, 80, 6, "Wednesday", False, False, True),
    (18, "100", 0, 6.0, 0.5, 9.0, 0, 7.0, 0.3, 8.0, 20, 12, "Friday", False, None, True),
    (23, "300", 1, 2.0, 0.0, 1.0, 75, 3.0, 0.0, 2.0, 70, 3, "Sunday", True, False, False),
]


def labelled(spark, pairs):
    return spark.createDataFrame(pairs, "y int, p int")


def test_perfect_and_lopsided_classes(spark):
    perfect = metrics.class_metrics(labelled(spark, [(c, c) for c in range(6)]), "y", "p").first()
    assert (perfect.accuracy, perfect.weighted_recall, perfect.ordinal_cost) == (1.0, 1.0, 0.0)
    cost = lambda y, p: metrics.class_metrics(labelled(spark, [(y, p)]), "y", "p").first().ordinal_cost
    assert (cost(5, 0), cost(0, 5)) == (20.0, 5.0)
    absent = metrics.class_metrics(labelled(spark, [(0, 0), (0, 1), (5, 5)]), "y", "p").first()
    assert math.isclose(absent.weighted_recall, (0.5 * 1 + 1 * 10) / 28.5)


def test_class_tables(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] * 2 + [(1, 1)] + [(2, 1)] + [(5, 4)]
    df = labelled(spark, pairs)
    matrix = {r.actual: [r[f"p{c}"] for c in range(6)] for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert matrix[0] == [3, 2, 0, 0, 0, 0] and matrix[5] == [0, 0, 0, 0, 1, 0] and matrix[3] == [0] * 6 and len(matrix) == 6
    report = {r.name: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert set(report) == {*CLASS_NAMES, "macro avg", "weighted avg"}
    assert (report["EMPTY"].precision, report["EMPTY"].recall, report["EMPTY"].support) == (1.0, 0.6, 5)
    assert report["MANY_SEATS"].precision == 0.25 and report["CRUSHED"].support == 0 and report["CRUSHED"].f1 == 0.0
    assert math.isclose(report["macro avg"].recall, (0.6 + 1.0) / 6) and report["macro avg"].support == 8
    assert math.isclose(report["weighted avg"].recall, (0.6 * 5 + 1.0) / 8)
    shares = {r["class"]: (r.n, r.percent) for r in metrics.class_distribution(df, "y").collect()}
    assert shares[0] == (5, 62.5) and shares[3] == (0, 0.0) and len(shares) == 6


def test_regression_metrics(spark):
    y, p = [0.0, 1.0, 2.0, 5.0], [0.5, 1.0, 1.0, 4.0]
    r = metrics.regression_metrics(spark.createDataFrame(list(zip(y, p)), "y double, p double"), "y", "p").first()
    a, b = np.array(y), np.array(p)
    assert math.isclose(r.rmse, np.sqrt(((a - b) ** 2).mean())) and math.isclose(r.mae, np.abs(a - b).mean())
    assert math.isclose(r.r2, 1 - ((a - b) ** 2).sum() / ((a - a.mean()) ** 2).sum())
    assert (r.n, r.actual_min, r.actual_max, r.predicted_min, r.predicted_max, r.predicted_mean) == (4, 0, 5, 0.5, 4, 1.625)
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert metrics.regression_metrics(flat, "y", "p").first().r2 == 1.0


def test_feature_lists():
    assert len(ALL_FEATURES) == len(set(ALL_FEATURES)) == 16
    assert sorted(NUMERIC_FEATURES + CATEGORICAL_FEATURES + BOOLEAN_FEATURES) == sorted(ALL_FEATURES)


def vectors(df):
    return [r[0] for r in df.orderBy("hour").select(vector_to_array("features")).collect()]


def test_preprocessor(spark):
    train = spark.createDataFrame(ROWS, FEATURES)
    prepared = learning.preprocessor(train)
    out = vectors(prepared.transform(train))
    assert all(len(v) == 16 and not any(math.isnan(x) for x in v) for v in out)
    names = NUMERIC_FEATURES + CATEGORICAL_FEATURES + BOOLEAN_FEATURES
    first, second, third = (dict(zip(names, v)) for v in out[:3])
    assert first["temperature_2m"] == 6.0 and second["route_id"] == first["route_id"] == 0.0 and third["is_holiday_se"] == 0.0
    assert [v[names.index("weekday")] for v in out] == [1.0, 3.0, 0.0, 2.0]
    odd = [list(ROWS[0]), list(ROWS[3])]
    odd[0][1], odd[0][12], odd[0][3] = "UNSEEN", "UnknownDay", float("nan")
    unseen = dict(zip(names, vectors(prepared.transform(spark.createDataFrame([tuple(r) for r in odd], FEATURES)))[0]))
    assert unseen["route_id"] == -1.0 and unseen["weekday"] == -1.0 and unseen["temperature_2m"] == 6.0


def test_text_literals_are_quoted(spark):
    rows = [(*r[:1], "it's \\ odd", *r[2:]) for r in ROWS]
    df = spark.createDataFrame(rows + [(*ROWS[0][:1], None, *ROWS[0][2:])], FEATURES)
    assert len(vectors(learning.preprocessor(df).transform(df))) == 5


def test_draws_repeat_and_stay_in_the_grid():
    for grid in (learning.REGRESSOR_GRID, learning.CLASSIFIER_GRID, learning.FOREST_GRID):
        drawn = learning.draw_parameters(grid)
        assert len(drawn) == 30 and drawn == learning.draw_parameters(grid)
        assert all(setting[name] in values for setting in drawn for name, values in grid.items())
        assert all(0 < x <= 1 for name in ("row_share", "feature_share") for x in grid[name])
        for setting in drawn:  # nothing that is drawn is bent or left out
            options = learning.mllib_parameters(setting, steps="step" in grid)
            assert len(options) == len(setting) and options["maxDepth"] == setting["depth"]
    for refused in ({"depth": 31}, {"num_leaves": 31}, {"reg_alpha": 0.1}):
        with pytest.raises(ValueError):
            learning.mllib_parameters(refused, steps=True)
    with pytest.raises(ValueError):
        learning.mllib_parameters({"step": 0.1}, steps=False)


FOREST = {"rounds": 3, "depth": 3, "leaf_rows": 1}
SMALL = {**FOREST, "step": 0.3}


@pytest.fixture(scope="module")
def rows(spark):
    many = spark.range(600).select(
        (F.col("id") % 24).cast("int").alias("hour"), (F.col("id") % 5).cast("string").alias("route_id"),
        (F.col("id") % 2).cast("int").alias("direction_id"),
        *[(F.col("id") % n).cast("double").alias(c) for n, c in zip(range(3, 11), [c for c in ALL_FEATURES[3:11]])],
        F.lit(1).alias("month"), F.lit("Monday").alias("weekday"),
        F.lit(False).alias("is_weekend"), F.lit(False).alias("is_holiday_se"), F.lit(True).alias("is_workday_se"),
        (F.col("id") % 6).cast("int").alias("label"), F.col("id").alias("t"),
    )
    return stored(many, "rows")


def test_search_and_scoring(spark, rows, tmp_path):
    sample = temporal_cut(rows, ["t"], fraction=0.5)
    trials, best = learning.search(sample, "label", "regressor", [SMALL, {**SMALL, "depth": 1}])
    scores = {r.trial: r.score for r in trials.collect()}
    assert len(scores) == 2 and best["depth"] == (3 if scores[0] <= scores[1] else 1)
    _, chosen = learning.search(sample, "label", "classifier", [FOREST], at_once=1)
    assert chosen == FOREST
    trials, chosen = learning.search(sample.where("t < 60"), "label", "classifier", [{**SMALL, "rounds": 2}], boosted=True)
    assert chosen == {**SMALL, "rounds": 2} and 0 <= trials.first().score <= 1
    average = learning.fit_regressor(rows, "label", SMALL)
    classes = learning.fit_classifier(rows, "label", FOREST)
    boosted = learning.fit_classifier(rows, "label", {"rounds": 3, "depth": 4, "leaf_rows": 1, "step": 0.5}, boosted=True)
    inputs = rows.select(*ALL_FEATURES)
    scored = learning.predict(inputs, average, classes)
    assert scored.columns == [*ALL_FEATURES, "pred_avg", "pred_max"]
    assert scored.where("not (pred_avg between 0 and 5) or not (pred_max between 0 and 5)").count() == 0
    named = learning.predict(rows, None, boosted)
    assert named.where("pred_max is null or pred_avg is not null").count() == 0
    assert named.where("pred_max = label").count() > 500  # the label follows from the hour
    failing = learning.predict(inputs.drop("weekday"), average, None)
    assert failing.where("pred_avg is not null").count() == 0 and failing.count() == 600

    for name, model in (("m", average), ("c", boosted)):
        path, asked = str(tmp_path / name), (lambda m, name=name: learning.predict(inputs, *((m, None) if name == "m" else (None, m))))
        learning.save_model(model, path, trials, inputs.limit(1))
        both = [asked(m).groupBy("pred_avg", "pred_max").count() for m in (model, learning.load_model(spark, path))]
        assert both[0].exceptAll(both[1]).count() == both[1].exceptAll(both[0]).count() == 0
    assert learning.load_model(spark, str(tmp_path / "none")) is None


def test_shared_search_picks_what_separate_fits_pick(spark, rows):
    """Fits shared between numbers of rounds, halved or not, give the errors of fits of their own."""
    from pyspark.ml.regression import GBTRegressor

    sample = temporal_cut(rows, ["t"], fraction=1.0)
    settings = [{**SMALL, "rounds": n, "depth": d, "step": s} for n, d, s in ((2, 2, 0.3), (6, 2, 0.3), (6, 4, 0.3), (3, 4, 0.05), (5, 1, 0.1))]
    trials, best = learning.search(sample, "label", "regressor", settings, keep=1)
    found = {r.trial: r for r in trials.collect()}
    train, check = (sample.where(f"part = '{p}'") for p in ("train", "validation"))
    prepared = learning.preprocessor(train)
    fit_rows, check_rows = (learning.compact(learning.training_rows(prepared, df, "label"), "t") for df in (train, check))
    least = []
    for trial, setting in enumerate(settings):
        errors = []
        for n in range(1, setting["rounds"] + 1):  # a fit for every number of rounds
            options = learning.mllib_parameters({**setting, "rounds": n}, steps=True)
            model = GBTRegressor(labelCol="_label", predictionCol="p", seed=42, maxIter=options.pop("rounds"), stepSize=options.pop("step"), **options).fit(fit_rows)
            errors.append(metrics.regression_metrics(model.transform(check_rows), "_label", "p").first().rmse)
        least.append(min(errors))
        assert math.isclose(found[trial].score, min(errors), rel_tol=1e-9) and found[trial].rounds == errors.index(min(errors)) + 1
    assert best == settings[least.index(min(least))]
    assert learning.search(sample, "label", "regressor", settings)[1] == best


def test_halving_spends_rounds_on_the_better_half():
    from seatflow.operators.halving import halved

    asked = []

    def errors_of(setting, rounds):
        asked.append((setting["depth"], rounds))
        turn = setting.get("turn", 10**9)
        return [setting["depth"] + (1 / (1 + n) if n <= turn else 1) for n in range(1, rounds + 1)]

    settings = [{"rounds": r, "depth": d} for d in range(8) for r in (300, 1000)]
    out = halved(settings, errors_of, first=4, keep=4, at_once=2)
    assert sorted(asked)[:5] == [(0, 4), (0, 16), (0, 64), (0, 256), (0, 1000)] and (1, 16) in asked and (1, 64) not in asked and (2, 16) not in asked
    assert len(asked) == 8 + 2 + 1 + 1 + 1  # settings that differ in rounds are one fit
    assert (out[0].rounds, out[0].fitted, out[1].rounds, out[1].fitted) == (300, 300, 1000, 1000)
    assert min(range(16), key=lambda t: out[t].error) == 1
    asked.clear()
    out = halved([{"rounds": 1000, "depth": 0, "turn": 20}], errors_of, first=4, keep=4, at_once=1)
    assert [n for _, n in asked] == [4, 16, 64] and (out[0].rounds, out[0].fitted) == (20, 64)  # no longer improving
    asked.clear()
    assert halved([], errors_of) == [] and halved([{"rounds": 7, "depth": 1}], errors_of, keep=1)[0].rounds == 7 and asked == [(1, 7)]
    assert halved([{"rounds": 2, "depth": 1}], lambda s, n: [float("nan")] * n)[0].error == math.inf


def test_joint_boosting_lowers_the_softmax_loss(spark):
    """Two classes that one split tells apart, by hand: start at the log shares, steps of gradient over curvature."""
    from pyspark.ml.linalg import Vectors

    from seatflow.operators.boosting import boost_classes

    data = [(Vectors.dense([float(i % 10)]), float(2 if i % 10 < 4 else 5), 1.0 + (i % 10 < 4)) for i in range(100)]
    rows = stored(spark.createDataFrame(data, ["features", "_label", "_weight"]).coalesce(1), "joint")
    model, recalls = boost_classes(rows, {"rounds": 1, "step": 0.5, "maxDepth": 1}, rows)
    shares = {2: 80 / 140, 5: 60 / 140}
    assert all(math.isclose(model.start[c], math.log(p)) for c, p in shares.items()) and model.start[0] < -20
    tree = model.trees[0][2]
    below, above = tree.predict(Vectors.dense([0.0])), tree.predict(Vectors.dense([9.0]))
    curve = shares[2] * (1 - shares[2]) * 6 / 5
    assert math.isclose(below, min(4.0, (1 - shares[2]) / curve), rel_tol=1e-6) and math.isclose(above, max(-4.0, -shares[2] / curve), rel_tol=1e-6)
    assert math.isclose(recalls[0], (3 + 10) / 28.5)


def test_weights_reach_the_learner(spark, rows):
    prepared = learning.preprocessor(rows)
    got = {int(r[0]): r[1] for r in learning.training_rows(prepared, rows, "label").select("_label", "_weight").distinct().collect()}
    assert got == {0: 1.0, 1: 2.25, 2: 6.0, 3: 12.5, 4: 24.0, 5: 35.0}


def test_search_spaces_are_those_of_the_requirements():
    from seatflow.operators.learning import CLASSIFIER_GRID, FOREST_GRID, REGRESSOR_GRID

    assert REGRESSOR_GRID["rounds"] == CLASSIFIER_GRID["rounds"] == FOREST_GRID["rounds"] == [300, 500, 1000]
    assert REGRESSOR_GRID["step"] == [0.01, 0.05, 0.1, 0.2] and CLASSIFIER_GRID["step"] == [0.01, 0.05, 0.1]
    assert REGRESSOR_GRID["depth"] == [5, 10, 20, 30] and CLASSIFIER_GRID["depth"] == FOREST_GRID["depth"] == [5, 10, 15, 30]
    assert "step" not in FOREST_GRID


def test_rf_scores_where_the_forest_says_one_class(spark, tmp_path):
    """One class told for all rows has no correlation; whether it is the class of most weight is still told."""
    from datetime import datetime

    from checks.models import classes_fit, rf_scores

    events = [(i, datetime(2024, 1, 8 + i // 24, i % 24), 0, "error", 50.0 if i == 5 else 90.0) for i in range(96)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("SELECT 1L AS o_orderkey, 1L AS o_custkey, DATE '1996-01-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    got = rf_scores(spark, str(tmp_path)).first()
    assert got.n_rows == got.on_scale > 48 and got.better is True
    told = lambda pairs: labelled(spark, pairs).agg(classes_fit("p", "y").alias("fit")).first().fit
    assert told([(5, 5), (5, 5)]) and told([(4, 5), (5, 5), (5, 5)]) and told([(1, 2), (5, 3)])
    assert not told([(5, 4), (5, 4)]) and not told([(4, 4), (5, 4)]) and not told([(5, 2), (1, 3)])
    assert told([]) is None
