"""Joins of feature tables.

Equi-joins leave the strategy to Spark, which broadcasts a side only while its known or measured
size is under the session's limit and otherwise shuffles both, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatflow.functions.clock import date_spine
from seatflow.operators.ordering import sliced
from seatflow.schemas import (
    ALL_FEATURES,
    CALENDAR_FEATURES,
    PAST_COLUMNS,
    TEST_SPAN,
    TRAFFIC_FEATURES,
    TRAIN_SPAN,
    WEATHER_FEATURES,
)


def feature_view(
    traffic: DataFrame, calendar: DataFrame, weather: DataFrame, label: str, how: str = "left"
) -> DataFrame:
    """Traffic keys, label and event time with calendar and weather features."""
    left = traffic.select("date", *TRAFFIC_FEATURES, label, "event_time")
    joined = left.join(calendar.select("date", *CALENDAR_FEATURES), "date", how)
    joined = joined.join(weather.select("date", "hour", *WEATHER_FEATURES), ["date", "hour"], how)
    return joined.select(*ALL_FEATURES, label, "event_time")


def past_rows(traffic: DataFrame, calendar: DataFrame, weather: DataFrame) -> DataFrame:
    """Observed hours with their features, in the export's columns."""
    names = {"traffic": traffic, "calendar": calendar, "weather": weather}
    traffic, calendar, weather = (
        df.withColumnRenamed("event_time", f"{name}_event_time") for name, df in names.items()
    )
    joined = traffic.join(calendar, "date", "left").join(weather, ["date", "hour"], "left")
    return joined.select(*PAST_COLUMNS)


def _with_days(left: DataFrame, calendar: DataFrame, weather: DataFrame) -> DataFrame:
    """`left` with calendar and weather features, joined on the day alone.

    A day's weather is folded into one row, a map by hour, so tables in equal buckets of days need no shuffle for either join.
    The sides with one row a day are hashed per bucket, so `left` is not sorted either. Weather has one row per day and hour.
    """
    hourly = weather.where("date is not null and hour is not null")
    entry = F.struct(F.col("hour").cast("int").alias("hour"), F.struct(*WEATHER_FEATURES).alias("measures"))
    days = hourly.groupBy("date").agg(F.map_from_entries(F.collect_list(entry)).alias("_hours"))
    joined = left.join(calendar.select("date", *CALENDAR_FEATURES).hint("shuffle_hash"), "date", "left")
    joined = joined.join(days.hint("shuffle_hash"), "date", "left")
    here = F.try_element_at("_hours", F.col("hour").cast("int"))
    return joined.withColumns({c: here.getField(c) for c in WEATHER_FEATURES}).drop("_hours")


def feature_view_by_day(traffic: DataFrame, calendar: DataFrame, weather: DataFrame, label: str) -> DataFrame:
    """`feature_view` over tables in equal buckets of days: traffic rows stay where they are."""
    left = traffic.select("date", *TRAFFIC_FEATURES, label, "event_time")
    return _with_days(left, calendar, weather).select(*ALL_FEATURES, label, "event_time")


def past_rows_by_day(traffic: DataFrame, calendar: DataFrame, weather: DataFrame) -> DataFrame:
    """`past_rows` over tables in equal buckets of days: traffic rows stay where they are."""
    return _with_days(traffic, calendar, weather).select(*PAST_COLUMNS)


def schedule_rows(route_hours: DataFrame, calendar: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    """Scheduled hours with calendar and, when there is any, weather features."""
    joined = route_hours.join(calendar.select("date", *CALENDAR_FEATURES), "date", "left")
    if weather is None:
        return joined
    return joined.join(weather.select("date", "hour", *WEATHER_FEATURES), ["date", "hour"], "left")


def fill_weather(rows: DataFrame) -> DataFrame:
    """Missing weather becomes 0; calendar gaps stay."""
    return rows.fillna(0, subset=[c for c in WEATHER_FEATURES if c in rows.columns])


def add_absent_features(rows: DataFrame, columns: Sequence[str] = ALL_FEATURES) -> DataFrame:
    """Feature columns the frame does not have, as 0."""
    absent = {c: F.lit(0) for c in columns if c not in rows.columns}
    return rows.withColumns(absent) if absent else rows


def missing_dates(
    spark: SparkSession, existing: DataFrame, first: str | date, last: str | date, need_existing: bool = False
) -> DataFrame:
    """Days first..last that `existing` has no row for.

    `need_existing` makes an empty table an error rather than a full reload.
    """
    if need_existing and existing.isEmpty():
        raise RuntimeError("the table has no dates to compare with")
    have = existing.select(F.to_date("date").alias("date")).distinct()
    return date_spine(spark, first, last).join(have, "date", "left_anti")


def requested_dates(spine: DataFrame, listed: DataFrame) -> DataFrame:
    """A range of days and a list of days as one set in order."""
    days = spine.select(F.to_date("date").alias("date")).union(listed.select(F.to_date("date")))
    return days.distinct().orderBy("date")


def first_wins(known: DataFrame, fresh: DataFrame, key: Sequence[str]) -> DataFrame:
    """Known rows, and fresh ones whose key is not known yet."""
    return known.unionByName(fresh.join(known.select(*key).distinct(), list(key), "left_anti"))


def in_span(rows: DataFrame, first: str, last: str, inclusive: str = "day", column: str = "event_time") -> DataFrame:
    """Rows with event time in first..last.

    `inclusive`: "day" keeps the whole last day, "instant" the last instant itself, "none" neither.
    Bounds may have a time of day. A `date` column is bounded by their days as well, for partition pruning.
    """
    start = F.lit(first).cast("timestamp_ntz")
    end = F.lit(last).cast("timestamp_ntz")
    if inclusive == "day":
        end = F.date_trunc("day", end).cast("timestamp_ntz") + F.expr("interval 1 day")
    time = F.col(column)
    rows = rows.where((time >= start) & (time <= end if inclusive == "instant" else time < end))
    return rows.where(F.col("date").between(first[:10], last[:10])) if "date" in rows.columns else rows


def temporal_split(
    rows: DataFrame, train: tuple[str, str] = TRAIN_SPAN, test: tuple[str, str] = TEST_SPAN, inclusive: str = "day"
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by event time."""
    return in_span(rows, *train, inclusive), in_span(rows, *test, inclusive)


def as_of(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
) -> DataFrame:
    """For each left row the values of the key's latest right row at or before it.

    `tie` orders right rows of one instant, the last one winning. No range join: both sides are
    stacked, range-partitioned on key and time and read in order. A slice holds a bounded number of
    rows, so a busy key spans many; what it last had before a slice is worked out on one row per
    key and slice and carried in. Rows with a NULL in the key or the time match nothing.
    """
    key = list(key)
    complete = lambda time: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*key, time]])
    unmatched = left.where(~complete(left_time))
    left, right = left.where(complete(left_time)), right.where(complete(right_time))
    value = F.struct(F.col(right_time).alias("_at"), *[F.col(c).alias(f"_tie_{c}") for c in tie], *values)
    packed = F.struct(*[F.col(c) for c in left.columns])
    rows = left.select(
        *key, F.col(left_time).alias("_time"), F.lit(1).alias("_side"), packed.alias("_left")
    ).unionByName(
        right.select(*key, F.col(right_time).alias("_time"), F.lit(0).alias("_side"), value.alias("_value")),
        allowMissingColumns=True,
    )
    cut = sliced(rows, [*key, "_time", "_side", "_value"])
    within = Window.partitionBy(*key, "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = cut.withColumn("_here", F.last("_value", ignorenulls=True).over(within)).where("_side = 1")

    earlier = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = cut.groupBy(*key, "_slice").agg(F.expr("max_by(_value, _at) filter (where _side = 0)").alias("_latest"))
    carried = slices.withColumn("_carried", F.last("_latest", ignorenulls=True).over(earlier)).drop("_latest")
    found = here.join(carried, [*key, "_slice"], "left").withColumn("_found", F.coalesce("_here", "_carried"))
    found = found.select("_left.*", *[F.col(f"_found.{c}").alias(c) for c in values])
    return found.unionByName(unmatched, allowMissingColumns=True)
