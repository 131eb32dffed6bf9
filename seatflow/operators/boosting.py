"""Boosted trees by rounds: validation errors after each round, and one boosted model for all classes (M5, M6).

The classifier grows a regression tree per class in every round, fitted to the gradient of the softmax loss with the second
derivative as weight, so the classes share one loss. Rows keep their margins in a table that every round writes anew: no
plan grows with the rounds, and a lost executor costs the round at hand.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.functions.scores import class_weight
from seatflow.runtime import stored
from seatflow.schemas import CLASSES, CLASS_WEIGHTS, SEED

#: The steepest step of a row, and the least second derivative, that keep leaves of few rows finite.
_STEEPEST, _FLATTEST = 4.0, 1e-6


def boosted_regressor(options: Mapping) -> GBTRegressor:
    """The learner for MLlib's names of a setting."""
    options = dict(options)
    return GBTRegressor(
        labelCol="_label", predictionCol="_raw", seed=SEED, maxIter=options.pop("rounds"), stepSize=options.pop("step"), **options)


def regressor_errors(rows: DataFrame, check: DataFrame, options: Mapping) -> list[float]:
    """RMSE on `check` after each round of one fit."""
    model = boosted_regressor(options).fit(rows)
    return [math.sqrt(e) for e in model.evaluateEachIteration(check, "squared")]


@dataclass(frozen=True)
class ClassTrees:
    """The start of every class's margin, and its trees, a list per round."""

    start: list[float]
    trees: list[list[DecisionTreeRegressionModel]]
    step: float

    def stages(self) -> list[Transformer]:
        """A sum of trees per class, and the class of the largest; stock stages that a pipeline can save."""
        gateway, out = SparkContext._gateway, []
        kinds = gateway.jvm.org.apache.spark.ml.regression
        for c in range(len(self.start)):
            trees = gateway.new_array(kinds.DecisionTreeRegressionModel, len(self.trees))
            weights = gateway.new_array(gateway.jvm.double, len(self.trees))
            for i, own in enumerate(self.trees):
                trees[i], weights[i] = own[c]._java_obj, self.step
            model = GBTRegressionModel(kinds.GBTRegressionModel(f"class_margin_{c}", trees, weights))
            out.append(model.setFeaturesCol("features").setPredictionCol(f"_margin_{c}"))
        margins = ", ".join(f"_margin_{c} + {start!r}D" for c, start in enumerate(self.start))
        return [*out, SQLTransformer(statement=f"select *, {largest(f'array({margins})')} as prediction from __THIS__")]


def largest(margins: str) -> str:
    """The place of the largest entry, the first one on a tie."""
    return f"double(array_position({margins}, array_max({margins})) - 1)"


def _gradients(state: DataFrame) -> DataFrame:
    """Per class the step to fit and its weight."""
    raised = F.transform("_margins", lambda m: F.exp(m - F.array_max("_margins")))
    share = lambda p: p / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b)
    state = state.withColumn("_shares", F.transform(raised, share))
    factor = len(CLASSES) / (len(CLASSES) - 1)
    for c in CLASSES:
        p = F.col("_shares")[c]
        curve = F.greatest(p * (1 - p) * factor, F.lit(_FLATTEST))
        slope = ((F.col("_label") == c).cast("double") - p) / curve
        state = state.withColumn(f"_target_{c}", F.greatest(F.least(slope, F.lit(_STEEPEST)), F.lit(-_STEEPEST)))
        state = state.withColumn(f"_curve_{c}", curve * F.col("_weight"))
    return state


def _start(rows: DataFrame) -> list[float]:
    """Log shares of the classes by weight; a class without rows starts far below."""
    found = {int(r["_label"]): r["w"] for r in rows.groupBy("_label").agg(F.sum("_weight").alias("w")).collect()}
    total = sum(found.values()) or 1.0
    return [math.log(max(found.get(c, 0.0) / total, 1e-9)) for c in CLASSES]


def boost_classes(rows: DataFrame, options: Mapping, check: DataFrame | None = None) -> tuple[ClassTrees, list[float]]:
    """The model of a setting in MLlib's names, and the weighted recall on `check` after each round.

    Rows have `features`, `_label` and `_weight`.
    """
    options = dict(options)
    rounds, step = options.pop("rounds"), options.pop("step")
    columns = ["features", "_label", "_weight", "_fit", "_margins"]
    start = _start(rows)
    state = rows.select("features", "_label", "_weight", F.lit(True).alias("_fit"))
    if check is not None:
        state = state.unionByName(check.select("features", "_label", "_weight", F.lit(False).alias("_fit")))
    state = state.withColumn("_margins", F.array(*map(F.lit, start))).withColumn("_history", F.array().cast("array<int>"))
    state = stored(_gradients(state), "boosting")
    grown = []

    def grow(number: int, c: int) -> DecisionTreeRegressionModel:
        learner = RandomForestRegressor(
            labelCol=f"_target_{c}", weightCol=f"_curve_{c}", numTrees=1, bootstrap=False,
            seed=SEED + number * len(CLASSES) + c, **options)
        return learner.fit(state.where("_fit")).trees[0]

    with ThreadPoolExecutor(len(CLASSES)) as pool:
        for number in range(rounds):
            trees = list(pool.map(lambda c, number=number: grow(number, c), CLASSES))
            grown.append(trees)
            if check is None and number == rounds - 1:
                break
            moved = state.select(*columns, "_history")
            for c, tree in enumerate(trees):
                moved = tree.setFeaturesCol("features").setPredictionCol(f"_step_{c}").transform(moved)
            margins = F.array(*[F.col("_margins")[c] + step * F.col(f"_step_{c}") for c in CLASSES])
            moved = moved.withColumn("_margins", margins)
            if check is not None:
                seen = F.when(F.col("_fit"), F.col("_history")).otherwise(F.concat("_history", F.array(F.expr(largest("_margins")).cast("int"))))
                moved = moved.withColumn("_history", seen)
            state = stored(_gradients(moved.select(*columns, "_history")), "boosting")
    recalls = [] if check is None else _recalls(state.where("NOT _fit"), len(grown))
    return ClassTrees(start, grown, step), recalls


def _recalls(rows: DataFrame, rounds: int) -> list[float]:
    """Weighted recall after each round, from counts per round and class."""
    each = rows.select(F.col("_label").cast("int").alias("actual"), F.posexplode("_history").alias("round", "predicted"))
    hits = each.groupBy("round", "actual").agg(F.count_if(F.col("actual") == F.col("predicted")).alias("hits"), F.count("*").alias("n"))
    weight: Column = class_weight(F.col("actual"))
    total = sum(CLASS_WEIGHTS.values())
    found = hits.groupBy("round").agg((F.sum(weight * F.col("hits") / F.col("n")) / total).alias("recall")).collect()
    by_round = {r["round"]: r["recall"] for r in found}
    return [by_round.get(i, 0.0) for i in range(rounds)]
