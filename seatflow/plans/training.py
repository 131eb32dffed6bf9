"""Training jobs for both models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from seatflow.operators.joins import temporal_split
from seatflow.operators.learning import (
    CLASSIFIER_GRID,
    FOREST_GRID,
    REGRESSOR_GRID,
    compact,
    draw_parameters,
    fit_classifier,
    fit_regressor,
    save_model,
    search,
)
from seatflow.operators.metrics import class_metrics, regression_metrics
from seatflow.operators.ordering import best_trial, example_row, temporal_cut
from seatflow.schemas import ALL_FEATURES, TEST_SPAN, TRAIN_SPAN, TUNE_TRIALS
from seatflow.runtime import stored
from seatflow.sinks.tables import save_split
from seatflow.sources.tables import split_frames

LABELS = {"regressor": "avg_occupancy", "classifier": "max_occupancy"}


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    trials: DataFrame
    best: dict
    #: How many of the best setting's rounds the model has.
    rounds: int
    metrics: DataFrame


def make_split(
    view: DataFrame,
    path: str,
    version: int,
    train: tuple[str, str] = TRAIN_SPAN,
    test: tuple[str, str] = TEST_SPAN,
) -> None:
    """Split a feature view by event time and store both parts."""
    save_split(*temporal_split(view, train, test), path, version)


def train(
    spark: SparkSession,
    split_path: str,
    version: int,
    kind: str,
    model_path: str | None = None,
    settings: Sequence[Mapping] | None = None,
    at_once: int = 8,
    boosted: bool = True,
    trials: int = TUNE_TRIALS,
) -> Trained:
    """Search on the first part of the training rows, fit on all of them, measure on the test rows.

    Without `settings`, `trials` of them are drawn from the learner's grid. `boosted` makes the classifier a
    boosted model, else it is a forest. The model has the rounds that served the best setting best.
    """
    label = LABELS[kind]
    rows, test = split_frames(spark, split_path, version)
    order = ["event_time", "route_id", "direction_id"]
    sample = stored(temporal_cut(rows, order), "sample")
    if settings is None:
        grid = REGRESSOR_GRID if kind == "regressor" else CLASSIFIER_GRID if boosted else FOREST_GRID
        settings = draw_parameters(grid, trials)
    tried, best = search(sample, label, kind, settings, at_once, boosted)
    rounds = best_trial(tried, "score", maximize=kind != "regressor").first().rounds
    final = {**best, "rounds": rounds}
    rows = compact(rows, "training")
    if kind == "regressor":
        model = fit_regressor(rows, label, final)
        metrics = regression_metrics(model.transform(test), label, "prediction")
    else:
        model = fit_classifier(rows, label, final, boosted=boosted)
        metrics = class_metrics(model.transform(test), label, "prediction")
    if model_path is not None:
        save_model(model, model_path, metrics, example_row(rows.select(*ALL_FEATURES), ["route_id", "hour"]))
    return Trained(model, tried, best, rounds, metrics)
