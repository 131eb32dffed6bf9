"""Weather with the same hour of the previous calendar day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatflow.schemas import WEATHER_MEASURES

_DAYS_PER_CHUNK = 64


def with_previous_day(weather: DataFrame) -> DataFrame:
    """Add `prev_` columns: the same hour one calendar day earlier, NULL when there is none.

    Each hour is sent to its own day and, shifted, to the next one; one regrouping on (date, hour)
    pairs them. That is a single shuffle of the table, where a self-join needs two. All rows of an
    hour stay; of several on the previous day, the greatest in the order of the measures stands for them.
    """
    measures = F.struct(*WEATHER_MEASURES)
    copies = weather.select(
        "hour", measures.alias("_row"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("_ahead"),
        F.to_date("date").alias("_day"),
    ).withColumn("date", F.date_add("_day", F.col("_ahead")))
    paired = copies.groupBy("date", "hour").agg(
        F.expr("collect_list(_row) filter (where _ahead = 0) as _own"),
        F.expr("max(_row) filter (where _ahead = 1) as _prev"),
    )
    rows = paired.select("date", "hour", F.explode("_own").alias("_own"), "_prev")
    return rows.select(
        "date", "hour", *[F.col(f"_own.{c}") for c in WEATHER_MEASURES],
        *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in WEATHER_MEASURES],
    )


def with_previous_day_framed(weather: DataFrame) -> DataFrame:
    """The same result as a window over days.

    An hour's whole history would be one window group, so days go in chunks; the last day of a
    chunk is also given to the next one, as history only.
    """
    number = F.unix_date(F.to_date("date"))
    rows = weather.select(F.to_date("date").alias("date"), "hour", *WEATHER_MEASURES, number.alias("_day"))
    chunk = F.floor(F.col("_day") / _DAYS_PER_CHUNK)
    carried = F.col("_day") % _DAYS_PER_CHUNK == _DAYS_PER_CHUNK - 1
    places = F.when(carried, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    rows = rows.select("*", F.posexplode(places).alias("_copy", "_chunk"))
    frame = Window.partitionBy("hour", "_chunk").orderBy("_day").rangeBetween(-1, -1)
    rows = rows.withColumn("_prev", F.max(F.struct(*WEATHER_MEASURES)).over(frame)).where("_copy = 0")
    previous = {f"prev_{c}": F.col(f"_prev.{c}") for c in WEATHER_MEASURES}
    return rows.withColumns(previous).drop("_day", "_copy", "_chunk", "_prev")


def from_day(weather: DataFrame, first: str | date) -> DataFrame:
    """Drop the warm-up day, once the previous-day columns are there."""
    return weather.where(F.to_date("date") >= F.lit(str(first)).cast("date"))


def joined_sources(history: DataFrame | None, forecast: DataFrame | None) -> DataFrame | None:
    """History and forecast together; without a forecast there is nothing to score with."""
    if forecast is None:
        return None
    return forecast if history is None else history.unionByName(forecast)


def future_weather(history: DataFrame | None, forecast: DataFrame | None, days: DataFrame) -> DataFrame | None:
    """Previous-day columns over both sources, then only the wanted days."""
    both = joined_sources(history, forecast)
    if both is None:
        return None
    return with_previous_day(both).join(days.select("date").distinct(), "date", "left_semi")
