"""Dates, hours and zones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.schemas import FUTURE_DAYS, LOCAL_ZONE, PAST_DAYS

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _name(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def utc_clock(epoch: str | Column) -> Column:
    """Epoch seconds as a zone-less UTC timestamp, whatever the session zone is."""
    return F.timestamp_add("SECOND", _name(epoch), F.expr(_EPOCH))


def epoch_seconds(utc: str | Column) -> Column:
    """Whole seconds since 1970 of a zone-less UTC timestamp, from its fields, so without a zone."""
    utc = _name(utc)
    days = F.unix_date(F.to_date(utc)).cast("bigint")
    return ((days * 24 + F.hour(utc)) * 60 + F.minute(utc)) * 60 + F.second(utc)


def local_clock(utc: str | Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time in `zone` of a zone-less UTC timestamp, daylight saving included."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _name(utc))


def iso_date(value: str | Column) -> Column:
    """Any date form as `yyyy-MM-dd` text."""
    return F.to_date(_name(value)).cast("string")


def compact_date(text: str | Column) -> Column:
    """`YYYYMMDD` as a date, NULL when it is not one."""
    return F.try_to_date(_name(text), "yyyyMMdd")


def event_time(day: str | Column, hour: str | Column | None = None) -> Column:
    """Zone-less timestamp of the day, plus the hour when one is given (P10)."""
    start = F.to_date(_name(day)).cast("timestamp_ntz")
    if hour is None:
        return start
    return start + F.make_dt_interval(F.lit(0), _name(hour).cast("int"))


def leading_hour(text: str | Column) -> Column:
    """Hour of an `HH:MM:SS` text, which may pass 24; 0 when blank or malformed."""
    return F.coalesce(F.substring_index(_name(text), ":", 1).try_cast("int"), F.lit(0))


def int_or_zero(text: str | Column) -> Column:
    """Direction texts: 0 when blank or malformed."""
    return F.coalesce(_name(text).try_cast("int"), F.lit(0))


def calendar_day(hour: Column, day: Column) -> Column:
    """Date part of X2: hour 24 and later belongs to the next day, never later than that."""
    return F.date_add(day, (hour >= 24).cast("int"))


def calendar_hour(hour: Column) -> Column:
    """Hour part of X2, held within 0 to 23."""
    return F.least(F.lit(23), F.greatest(F.lit(0), hour - F.when(hour >= 24, 24).otherwise(0)))


def hours_of_trip(first: Column, last: Column, day: Column) -> Column:
    """Array of (date, hour) for every hour first..last; empty when last precedes first."""
    hours = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        hours, lambda h: F.struct(calendar_day(h, day).alias("date"), calendar_hour(h).alias("hour"))
    )


def month_tag(day: str | Column) -> Column:
    return F.date_format(_name(day), "yyyy-MM")


def month_start(day: str | Column) -> Column:
    return F.trunc(_name(day), "MM")


def day_label(day: Column, today: str | date | Column) -> Column:
    """past / today / future against a given day."""
    today = today if isinstance(today, Column) else F.lit(str(today)).cast("date")
    day = F.to_date(day)
    return F.when(day < today, "past").when(day == today, "today").otherwise("future")


def date_spine(spark: SparkSession, first: str | date, last: str | date) -> DataFrame:
    """One row per day from first to last inclusive; none when last precedes first."""
    first, last = (date.fromisoformat(str(d)) for d in (first, last))
    return spark.range(max(0, (last - first).days + 1)).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")
    )


def spine_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """As `date_spine`, for bounds held in a one-row frame."""
    return bounds.where(F.col(first) <= F.col(last)).select(
        F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))).alias("date")
    )


def capped_end(last: Column, as_of: Column) -> Column:
    """The last day of a range, no later than the day before `as_of` (F8)."""
    return F.least(last, F.date_sub(as_of, 1))


def scoring_window(
    spark: SparkSession, as_of: str | date, past: int = PAST_DAYS, future: int = FUTURE_DAYS
) -> DataFrame:
    """Days around `as_of` with their kind: `past` days before, then today and `future` days."""
    as_of = F.lit(str(as_of)).cast("date")
    return spark.range(past + future + 1).select(
        F.date_add(as_of, (F.col("id") - past).cast("int")).alias("date"),
        F.when(F.col("id") < past, "past").otherwise("future").alias("type"),
    )
