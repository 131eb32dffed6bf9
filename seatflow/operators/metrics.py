"""Model quality (A15-A23). Classes are 0-5; every class metric comes from one 36-cell count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatflow.functions.scores import class_weight, ordinal_cost_term
from seatflow.schemas import CLASS_NAMES, CLASS_WEIGHTS, CLASSES


def _classes(df: DataFrame) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(c).alias("class"), F.lit(CLASS_NAMES[c]).alias("name")) for c in CLASSES])
    return df.sparkSession.range(1).select(F.inline(rows))


def class_distribution(rows: DataFrame, label: str) -> DataFrame:
    """Count and percent of each class, classes without rows included."""
    counts = rows.groupBy(F.col(label).cast("int").alias("class")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(_everything())
    counts = counts.withColumn("percent", F.col("n") * 100.0 / total)
    full = _classes(rows).join(counts, "class", "left")
    return full.fillna({"n": 0, "percent": 0.0})


def _everything():
    # only used over one row per class
    return Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def regression_metrics(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """RMSE, MAE, R2 and the range and mean of both columns, in one aggregation."""
    y, p = F.col(label).cast("double"), F.col(predicted).cast("double")
    stats = rows.agg(
        F.count("*").alias("n"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("spread"),
        *[f(c).alias(f"{name}_{kind}") for name, c in (("actual", y), ("predicted", p))
          for kind, f in (("min", F.min), ("max", F.max), ("mean", F.avg))],
    )
    # a constant label leaves nothing to explain: 1 for a perfect fit, else 0
    flat = F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    return stats.withColumns({
        "rmse": F.sqrt("mse"),
        "r2": F.when(F.col("spread") == 0, flat).otherwise(1 - F.col("mse") / F.nullif(F.col("spread"), F.lit(0.0))),
    }).drop("mse", "spread")


def cells(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """Counts per (actual, predicted): all that class metrics need."""
    return rows.groupBy(
        F.col(label).cast("int").alias("actual"), F.col(predicted).cast("int").alias("predicted")
    ).agg(F.count("*").alias("n"))


def confusion_matrix(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """Row per actual class, column `p0`..`p5` per predicted class, zeros included."""
    counted = cells(rows, label, predicted)
    wide = counted.groupBy(F.col("actual").alias("class")).agg(*[
        F.sum(F.when(F.col("predicted") == c, F.col("n")).otherwise(0)).alias(f"p{c}") for c in CLASSES
    ])
    return _classes(rows).join(wide, "class", "left").fillna(0).drop("name").withColumnRenamed("class", "actual")


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def per_class(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    counted = cells(rows, label, predicted)
    sides = counted.select(
        F.inline(F.array(
            F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).alias("called"),
                     F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits")),
            F.struct(F.col("predicted").alias("class"), F.lit(0).alias("support"), F.col("n").alias("called"),
                     F.lit(0).alias("hits")),
        ))
    )
    totals = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "called", "hits")])
    full = _classes(rows).join(totals, "class", "left").fillna(0)
    precision, recall = _ratio(F.col("hits"), F.col("called")), _ratio(F.col("hits"), F.col("support"))
    return full.select(
        "class", "name", precision.alias("precision"), recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1"), "support",
    )


def classification_report(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """`per_class` with macro and support-weighted means as further rows."""
    scores = ["precision", "recall", "f1"]
    support = F.sum("support").alias("support")
    weighted = [_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in scores]
    # six rows folded into one, so that the data is read once for all three parts
    folded = per_class(rows, label, predicted).agg(
        F.collect_list(F.struct("name", *scores, "support")).alias("classes"),
        F.struct(F.lit("macro avg").alias("name"), *[F.avg(c).alias(c) for c in scores], support).alias("macro"),
        F.struct(F.lit("weighted avg").alias("name"), *weighted, support).alias("weighted"),
    )
    return folded.select(F.inline(F.concat("classes", F.array("macro", "weighted"))))


def class_metrics(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy, weighted recall and ordinal cost.

    Weighted recall divides by the weights of all classes, those without rows too.
    """
    counted = cells(rows, label, predicted)
    n, y, p = F.col("n"), F.col("actual"), F.col("predicted")
    by_class = counted.groupBy("actual").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(y == p, n).otherwise(0)).alias("hits"),
        F.sum(ordinal_cost_term(y, p) * n).alias("cost"),
    )
    recall = F.col("hits") / F.col("n") * F.coalesce(class_weight(F.col("actual")), F.lit(0.0))
    return by_class.agg(
        (F.sum("hits") / F.sum("n")).alias("accuracy"),
        (F.sum(recall) / F.lit(sum(CLASS_WEIGHTS.values()))).alias("weighted_recall"),
        (F.sum("cost") / F.sum("n")).alias("ordinal_cost"),
    )
