"""Scoring and publishing jobs."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.functions.casts import schedule_types
from seatflow.operators.calendar import calendar_features
from seatflow.operators.joins import add_absent_features, fill_weather, schedule_rows
from seatflow.operators.learning import predict
from seatflow.operators.publish import (
    future_cells,
    merge_cells,
    names_from_schedule,
    past_cells,
    publish_stats,
    route_documents,
)
from seatflow.operators.schedule import active_route_hours
from seatflow.operators.weather import future_weather
from seatflow.runtime import stored
from seatflow.schemas import FUTURE_DAYS, PAST_DAYS
from seatflow.sinks.reports import save_dashboard
from seatflow.sources.timetable import read_dated_trips, read_route_names, read_stop_times, read_trip_routes


def window_days(as_of: date, past: int = PAST_DAYS, future: int = FUTURE_DAYS) -> tuple[list[date], list[date]]:
    """The past days before `as_of`, and the days from it on."""
    before = [as_of - timedelta(days=n) for n in range(past, 0, -1)]
    return before, [as_of + timedelta(days=n) for n in range(future + 1)]


def timetable_route_hours(spark: SparkSession, folder: str, days: Iterable[date]) -> DataFrame:
    """Active route-hours of the wanted days from the timetable texts in a folder."""
    days = list(days)
    dated = read_dated_trips(spark, f"{folder}/trips_dated_vehicle_journey.txt", days)
    return active_route_hours(
        dated,
        read_stop_times(spark, f"{folder}/stop_times.txt", dated),
        read_trip_routes(spark, f"{folder}/trips.txt", dated),
        read_route_names(spark, f"{folder}/routes.txt"),
        days,
    )


def score_past(past: DataFrame, avg_model: Transformer | None, max_model: Transformer | None) -> DataFrame:
    """Cells of exported past rows with both predictions."""
    return past_cells(predict(fill_weather(past), avg_model, max_model))


def score_future(
    route_hours: DataFrame,
    days: Iterable[date],
    history: DataFrame | None,
    forecast: DataFrame | None,
    avg_model: Transformer | None,
    max_model: Transformer | None,
) -> DataFrame:
    """Cells of scheduled hours with both predictions."""
    spark = route_hours.sparkSession
    days = sorted(days)
    wanted = spark.createDataFrame([(d,) for d in days], "date date")
    calendar = calendar_features(wanted)
    weather = future_weather(history, forecast, wanted)
    if weather is not None:
        weather = weather.withColumn("date", F.col("date").cast("string"))
    rows = schedule_rows(schedule_types(route_hours), calendar, weather)
    rows = add_absent_features(fill_weather(rows))
    return future_cells(predict(rows, avg_model, max_model))


def publish(
    past: DataFrame, future: DataFrame, route_hours: DataFrame, path: str, generated_at: str
) -> tuple[DataFrame, DataFrame]:
    """Merge both, write the document and return the merged cells and their statistics."""
    cells = stored(merge_cells(past, future), "cells")
    documents = route_documents(cells, names_from_schedule(None, route_hours))
    save_dashboard(documents, path, generated_at)
    return cells, publish_stats(cells)
