"""Weather documents: parallel hourly arrays, archive and forecast alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.schemas import WEATHER_JSON, WEATHER_MEASURES


def read_weather(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per hour of every document below `path`; no rows when the arrays are empty."""
    return explode_hours(spark.read.schema(WEATHER_JSON).option("multiLine", multi_line).json(path))


def explode_hours(documents: DataFrame) -> DataFrame:
    """Zip the arrays, one row each, and derive `date` and `hour` from the local time text."""
    names = ["time", *WEATHER_MEASURES]
    zipped = F.arrays_zip(*[F.col(f"hourly.{name}").alias(name) for name in names])
    hours = documents.select(F.inline(zipped)).toDF(*names)
    clock = F.to_timestamp_ntz("time")
    return hours.select(
        clock.alias("time"), *WEATHER_MEASURES, F.to_date(clock).alias("date"), F.hour(clock).alias("hour")
    )
