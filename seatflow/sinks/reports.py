"""Reports and published texts (K3, K4, K5, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.runtime import observed, stored
from seatflow.schemas import PAST_COLUMNS

FAILURES = "date string, stage string, error string"


def save_dates(dates: DataFrame, path: str) -> None:
    """Distinct days in order, one text line each: one file, as a day is one short line (K3)."""
    days = dates.select(F.col("date").cast("string").alias("value")).distinct()
    days.repartition(1).sortWithinPartitions("value").write.text(path)


def save_past(joined: DataFrame, path: str, even: bool = False) -> int:
    """The joined past table, written by all executors (K4).

    Returns its number of rows, counted by the write itself (A24). `even` says that the rows lie
    in parts of good size already and need not move.
    """
    rows = joined.select(*PAST_COLUMNS)
    rows = rows if even else rows.hint("rebalance")
    return observed(rows, [F.count("*").alias("n")], lambda seen: seen.write.mode("overwrite").parquet(path)).n


def append_failures(failures: DataFrame, path: str) -> None:
    """Days that a run could not process, with the stage and the reason (K7)."""
    failures.select("date", "stage", "error").write.mode("append").parquet(path)


def no_failures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FAILURES)


def save_dashboard(documents: DataFrame, path: str, generated_at: str) -> None:
    """Route documents as one JSON text, split over ordered part files (K5).

    `documents` has `route_id` and the struct `document`. The sorted write gives each executor a
    range of routes; the parts, put together in name order, are one valid document with a route a
    line. Missing predictions stay in it as null.
    """
    spark = documents.sparkSession
    documents = stored(documents, "documents")
    first = documents.agg(F.min("route_id")).scalar()
    entry = F.to_json(F.create_map("route_id", "document"), {"ignoreNullFields": "false"})
    entry = F.substring(entry, F.lit(2), F.length(entry) - 2)
    lines = documents.select(
        F.lit(1).alias("part"),
        "route_id",
        F.when(F.col("route_id") == first, entry).otherwise(F.concat(F.lit(","), entry)).alias("value"),
    )
    stamp = F.to_json(F.struct(F.lit(generated_at).alias("generated_at")))
    ends = spark.range(2).select(
        (F.col("id") * 2).cast("int").alias("part"),
        F.lit("").alias("route_id"),
        F.when(F.col("id") == 0, F.concat(F.rtrim(stamp, F.lit("}")), F.lit(',"routes":{')))
        .otherwise("}}").alias("value"),
    )
    lines.unionByName(ends).orderBy("part", "route_id").select("value").write.text(path)
