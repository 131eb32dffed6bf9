"""Timetable texts: dated trips, stop times, trips, routes."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatflow.functions.clock import compact_date, int_or_zero
from seatflow.operators.ordering import keep_last
from seatflow.schemas import DATED_TRIPS_CSV, ROUTES_CSV, STOP_TIMES_CSV, TRIPS_CSV

_ORDER = ["_file", "_block", "_row"]


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by their first line, of which no other line is read: a row per file, held by the driver as any file listing is."""
    names = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(8) as pool:
        first = list(pool.map(lambda name: spark.read.text(unquote(name)).head(1), names))
    files: dict[str, list[str]] = {}
    for name, line in zip(names, first, strict=True):
        if line:
            files.setdefault(line[0].value.strip("\ufeff\r"), []).append(unquote(name))
    return files


def read_text_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV columns picked by header name, since their order is free; blank or absent is ''.

    Each file is read by its own header, files with the same one together. `_file`, `_block` and
    `_row` keep the order of the lines for last-one-wins rules.
    """
    parts = [_read_alike(spark, files, schema) for files in _headers(spark, path).values()]
    if not parts:
        return spark.createDataFrame([], ", ".join([f"{f.name} string" for f in schema.fields] + ["_file string", "_block long", "_row long"]))
    return reduce(DataFrame.unionByName, parts)


def _read_alike(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    lines = spark.read.option("header", True).option("escape", '"').csv(files)
    columns = [
        (F.coalesce(F.col(f.name), F.lit("")) if f.name in lines.columns else F.lit("")).alias(f.name)
        for f in schema.fields
    ]
    return lines.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )




def dated_trips(raw: DataFrame, days: Iterable[str | date]) -> DataFrame:
    """Distinct (trip_id, operating_day) on the wanted operating days."""
    wanted = [str(d).replace("-", "") for d in days]
    return (
        raw.where(F.col("operating_day_date").isin(wanted) & (F.col("trip_id") != ""))
        .select("trip_id", compact_date("operating_day_date").alias("operating_day"))
        .distinct()
    )


def only_trips(rows: DataFrame, trips: DataFrame | None) -> DataFrame:
    """Rows whose trip is among the given ones; all rows when none are given."""
    return rows if trips is None else rows.join(trips.select("trip_id").distinct(), "trip_id", "left_semi")


def stop_times(raw: DataFrame, trips: DataFrame | None = None) -> DataFrame:
    """(trip_id, arrival_time, stop_sequence, stop_row) of the wanted trips.

    The sequence is NULL where it is blank or no number; `stop_row` is the order of the lines.
    """
    sequence = F.col("stop_sequence").try_cast("int").alias("stop_sequence")
    rows = raw.select("trip_id", "arrival_time", sequence, F.col("_row").alias("stop_row"))
    return only_trips(rows, trips)


def trip_routes(raw: DataFrame, trips: DataFrame | None = None, month: str | None = None) -> DataFrame:
    """(trip_id, route_id, direction_id), the last line of a trip winning."""
    usable = only_trips(raw.where((F.col("trip_id") != "") & (F.col("route_id") != "")), trips)
    rows = keep_last(usable, ["trip_id"], _ORDER).select(
        "trip_id", "route_id", int_or_zero("direction_id").alias("direction_id")
    )
    return rows if month is None else rows.withColumn("month", F.lit(month))


def route_names(raw: DataFrame) -> DataFrame:
    """(route_id, route_short_name, route_long_name), the last line of a route winning."""
    return keep_last(raw.where(F.col("route_id") != ""), ["route_id"], _ORDER).select(
        "route_id", "route_short_name", "route_long_name"
    )


def read_dated_trips(spark: SparkSession, path: str, days: Iterable[str | date]) -> DataFrame:
    return dated_trips(read_text_table(spark, path, DATED_TRIPS_CSV), days)


def read_stop_times(spark: SparkSession, path: str, trips: DataFrame | None = None) -> DataFrame:
    return stop_times(read_text_table(spark, path, STOP_TIMES_CSV), trips)


def read_trip_routes(
    spark: SparkSession, path: str, trips: DataFrame | None = None, month: str | None = None
) -> DataFrame:
    return trip_routes(read_text_table(spark, path, TRIPS_CSV), trips, month)


def read_route_names(spark: SparkSession, path: str) -> DataFrame:
    return route_names(read_text_table(spark, path, ROUTES_CSV))
