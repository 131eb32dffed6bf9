"""Feature preparation, models, search and scoring with MLlib (M1-M9)."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.functions.scores import class_prediction, class_weight, mean_prediction, sample_weight
from seatflow.operators.boosting import boost_classes, boosted_regressor, regressor_errors
from seatflow.operators.halving import halved
from seatflow.operators.metrics import class_metrics
from seatflow.operators.ordering import best_trial, medians, most_frequent
from seatflow.runtime import stored, use_checkpoints
from seatflow.schemas import (
    BOOLEAN_FEATURES,
    CATEGORICAL_FEATURES,
    CLASSES,
    NUMERIC_FEATURES,
    SEED,
    TUNE_TRIALS,
)

log = logging.getLogger(__name__)

MLLIB_DEPTH = 30
# The search spaces: rounds, steps, depths, leaf sizes and sampling shares of the requirements, as far as MLlib's
# trees have them. Unlimited depth is MLlib's largest.
REGRESSOR_GRID = {
    "rounds": [300, 500, 1000],
    "step": [0.01, 0.05, 0.1, 0.2],
    "depth": [5, 10, 20, MLLIB_DEPTH],
    "leaf_rows": [10, 20, 50, 100],
    "row_share": [0.7, 0.8, 0.9, 1.0],
    "feature_share": [0.7, 0.8, 0.9, 1.0],
}
CLASSIFIER_GRID = {
    "rounds": [300, 500, 1000],
    "step": [0.01, 0.05, 0.1],
    "depth": [5, 10, 15, MLLIB_DEPTH],
    "leaf_rows": [20, 50, 100],
    "row_share": [0.7, 0.8, 0.9],
    "feature_share": [0.7, 0.8, 0.9],
}
FOREST_GRID = {name: values for name, values in CLASSIFIER_GRID.items() if name != "step"}
_MLLIB_NAMES = {
    "depth": "maxDepth", "leaf_rows": "minInstancesPerNode", "row_share": "subsamplingRate", "feature_share": "featureSubsetStrategy",
}


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fill_values(train: DataFrame) -> tuple[dict[str, float], dict[str, str]]:
    """Medians of the numeric and commonest values of the other features: one row each (M1-M3)."""
    numeric = {r.feature: r.median for r in medians(train, NUMERIC_FEATURES).collect()}
    flags = train.withColumns({c: F.col(c).cast("int") for c in BOOLEAN_FEATURES})
    common = most_frequent(flags, CATEGORICAL_FEATURES + BOOLEAN_FEATURES)
    return numeric, {r.feature: r.value for r in common.collect()}


def preprocessor(train: DataFrame) -> PipelineModel:
    """Impute, encode and assemble the 16 features, fitted on the training rows only (M1-M4).

    Made of stock stages, so a fitted pipeline can be saved. A feature without any training value
    is filled with 0.
    """
    numeric, common = fill_values(train)
    filled = [
        f"coalesce(nanvl(double({c}), null), {numeric.get(c, 0.0)!r}D) as num_{c}" for c in NUMERIC_FEATURES
    ]
    filled += [f"coalesce(string({c}), {sql_text(common.get(c, ''))}) as cat_{c}" for c in CATEGORICAL_FEATURES]
    filled += [f"double(coalesce(int({c}), {common.get(c, 0)})) as bool_{c}" for c in BOOLEAN_FEATURES]
    fill = SQLTransformer(statement=f"select *, {', '.join(filled)} from __THIS__")

    indexer = StringIndexer(
        inputCols=[f"cat_{c}" for c in CATEGORICAL_FEATURES],
        outputCols=[f"code_{c}" for c in CATEGORICAL_FEATURES],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    ).fit(fill.transform(train))
    codes = [
        f"if(code_{c} = {len(labels)}, -1D, code_{c}) as ord_{c}"
        for c, labels in zip(CATEGORICAL_FEATURES, indexer.labelsArray)
    ]
    encode = SQLTransformer(statement=f"select *, {', '.join(codes)} from __THIS__")
    columns = [f"num_{c}" for c in NUMERIC_FEATURES] + [f"ord_{c}" for c in CATEGORICAL_FEATURES]
    assemble = VectorAssembler(inputCols=columns + [f"bool_{c}" for c in BOOLEAN_FEATURES], outputCol="features")
    return PipelineModel([fill, indexer, encode, assemble])


def mllib_parameters(chosen: Mapping, steps: bool) -> dict:
    """A setting under MLlib's names; one that MLlib's trees cannot honour is refused.

    `steps` says whether the learner boosts, and so has a learning rate.
    """
    known = {"rounds", *_MLLIB_NAMES} | ({"step"} if steps else set())
    if unknown := set(chosen) - known:
        raise ValueError(f"no such parameters here: {sorted(unknown)}")
    if not 0 <= int(chosen.get("depth", 5)) <= MLLIB_DEPTH:
        raise ValueError(f"depth must lie in 0..{MLLIB_DEPTH}")
    named = {_MLLIB_NAMES[k]: v for k, v in chosen.items() if k in _MLLIB_NAMES}
    if "featureSubsetStrategy" in named:
        named["featureSubsetStrategy"] = str(float(named["featureSubsetStrategy"]))
    return {"rounds": int(chosen.get("rounds", 20)), **({"step": float(chosen.get("step", 0.1))} if steps else {}), **named}


def training_rows(prepared: PipelineModel, rows: DataFrame, label: str) -> DataFrame:
    """Feature vector, label and weight: class weight times sample weight of the label."""
    y = F.col(label).cast("int")
    return prepared.transform(rows).select(
        "features",
        F.col(label).cast("double").alias("_label"),
        (sample_weight(y) * F.coalesce(class_weight(y), F.lit(1.0))).alias("_weight"),
    )


def regressor_stages(rows: DataFrame, chosen: Mapping) -> list[Transformer]:
    """Boosted trees fitted on training rows, and the clip of their predictions to 0-5 (M5)."""
    use_checkpoints(rows.sparkSession)
    clip = SQLTransformer(statement="select *, least(greatest(_raw, 0D), 5D) as prediction from __THIS__")
    return [boosted_regressor(mllib_parameters(chosen, steps=True)).fit(rows), clip]


def classifier_stages(rows: DataFrame, chosen: Mapping, boosted: bool = False) -> list[Transformer]:
    """Six-class trees fitted on weighted training rows: one boosted model of all classes, or a forest (M6)."""
    use_checkpoints(rows.sparkSession)
    options = mllib_parameters(chosen, steps=boosted)
    if boosted:
        return boost_classes(rows, options)[0].stages()
    columns = {"labelCol": "_label", "predictionCol": "prediction", "weightCol": "_weight"}
    return [RandomForestClassifier(numTrees=options.pop("rounds"), seed=SEED, **columns, **options).fit(rows)]


def one_vs_rest_stages(rows: DataFrame, chosen: Mapping) -> list[Transformer]:
    """MLlib's own way to boost several classes, to compare with: a two-class model per class."""
    use_checkpoints(rows.sparkSession)
    options = mllib_parameters(chosen, steps=True)
    one = GBTClassifier(maxIter=options.pop("rounds"), stepSize=options.pop("step"), seed=SEED, **options)
    return [OneVsRest(classifier=one, labelCol="_label", predictionCol="prediction", weightCol="_weight").fit(rows)]


def fit_regressor(train: DataFrame, label: str, chosen: Mapping, prepared: PipelineModel | None = None) -> PipelineModel:
    """Preparation and boosted regressor as one pipeline (M4, M5)."""
    prepared = prepared or preprocessor(train)
    return PipelineModel([*prepared.stages, *regressor_stages(training_rows(prepared, train, label), chosen)])


def fit_classifier(
    train: DataFrame, label: str, chosen: Mapping, prepared: PipelineModel | None = None, boosted: bool = False
) -> PipelineModel:
    """Preparation and weighted classifier as one pipeline (M4, M6)."""
    prepared = prepared or preprocessor(train)
    stages = classifier_stages(training_rows(prepared, train, label), chosen, boosted)
    return PipelineModel([*prepared.stages, *stages])


def draw_parameters(grid: Mapping[str, Sequence], trials: int = TUNE_TRIALS, seed: int = SEED) -> list[dict]:
    """Random settings, each parameter drawn in the grid's order from one seeded generator (M7)."""
    rng = np.random.RandomState(seed)
    return [{name: rng.choice(values).item() for name, values in grid.items()} for _ in range(trials)]


def compact(rows: DataFrame, name: str) -> DataFrame:
    """`rows` stored in as few files as their bytes need: every round of a fit runs a task per partition."""
    return stored(rows.hint("rebalance"), name)


def search(
    sample: DataFrame,
    label: str,
    kind: str,
    settings: Sequence[Mapping],
    at_once: int = 8,
    boosted: bool = False,
    first: int = 2,
    keep: int = 4,
) -> tuple[DataFrame, dict]:
    """Fit every setting on `part` = train, score it on `part` = validation.

    `boosted` makes the classifiers boosted ones, six trees a round. Boosted fits are shared between numbers of rounds and halved (`first`, `keep`), and a
    setting's rounds are the most that it may have: those after the least validation error do not count. A forest is fitted whole.

    Returns the trials (settings, score, the rounds that count, rounds fitted) and the best setting: lowest RMSE, or highest weighted recall.
    Preparation is the same for all trials, so it is done once and stored.
    """
    spark = sample.sparkSession
    use_checkpoints(spark)
    train, validation = (sample.where(F.col("part") == p) for p in ("train", "validation"))
    prepared = preprocessor(train)
    fit_rows, check_rows = (compact(training_rows(prepared, df, label), "tuning") for df in (train, validation))

    def errors_of(chosen: Mapping, rounds: int) -> list[float]:
        options = mllib_parameters({**chosen, "rounds": rounds}, steps=True)
        if kind == "regressor":
            return regressor_errors(fit_rows, check_rows, options)
        return [1 - recall for recall in boost_classes(fit_rows, options, check_rows)[1]]

    def forest(chosen: Mapping) -> float:
        return _weighted_recall(PipelineModel(classifier_stages(fit_rows, chosen)).transform(check_rows))

    if kind == "regressor" or boosted:
        trees = 1 if kind == "regressor" else len(CLASSES)
        found = halved(settings, errors_of, first, keep, max(1, 2 * at_once // (1 + trees)))
        scores = [(o.error if kind == "regressor" else 1 - o.error, o.rounds, o.fitted) for o in found]
    else:
        with ThreadPoolExecutor(at_once) as pool:
            scores = [(recall, int(s["rounds"]), int(s["rounds"])) for s, recall in zip(settings, pool.map(forest, settings), strict=True)]
    rows = [(trial, json.dumps(dict(s), sort_keys=True), *score) for trial, (s, score) in enumerate(zip(settings, scores, strict=True))]
    trials = spark.createDataFrame(rows, "trial int, settings string, score double, rounds int, fitted int")
    best = best_trial(trials, "score", maximize=kind != "regressor").first()
    return trials, json.loads(best.settings)


def _weighted_recall(scored: DataFrame) -> float:
    return class_metrics(scored, "_label", "prediction").first().weighted_recall


def predict(rows: DataFrame, avg_model: Transformer | None, max_model: Transformer | None) -> DataFrame:
    """Add `pred_avg` and `pred_max`; a missing model or one that cannot be applied gives NULL."""
    rows = _predicted(rows, avg_model, "pred_avg", mean_prediction, "double")
    return _predicted(rows, max_model, "pred_max", class_prediction, "int")


def _predicted(rows: DataFrame, model: Transformer | None, name: str, finish: Callable, kind: str) -> DataFrame:
    if model is not None:
        try:
            scored = model.transform(rows)
            return scored.select(*rows.columns, finish(F.col("prediction")).cast(kind).alias(name))
        except (AnalysisException, IllegalArgumentException) as error:  # columns that the model needs and the rows lack
            log.warning("%s left empty: %s", name, error)
    return rows.withColumn(name, F.lit(None).cast(kind))


def save_model(model: PipelineModel, path: str, metrics: DataFrame, example: DataFrame) -> None:
    """Store a fitted pipeline with its metrics and an input row (M9)."""
    model.write().overwrite().save(f"{path}/pipeline")
    metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    example.write.mode("overwrite").parquet(f"{path}/example")


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """A stored pipeline; None with a warning when it cannot be read (M9)."""
    try:
        return PipelineModel.load(f"{path}/pipeline")
    except Exception as error:
        log.warning("no model at %s: %s", path, error)
        return None
