"""Feature jobs (B1-B5). Days, paths and policies are arguments; nothing reads the clock."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.functions.casts import calendar_types, traffic_types, weather_types, with_event_time
from seatflow.functions.clock import month_tag
from seatflow.operators.calendar import calendar_between
from seatflow.operators.joins import missing_dates, past_rows, past_rows_by_day
from seatflow.operators.occupancy import (
    count_agreement,
    counts_by_trip,
    date_range,
    day_bounds,
    distinct_dates,
    resolve_counts,
    usable_sightings,
)
from seatflow.operators.ordering import evenly_spaced
from seatflow.operators.quality import SUITES, failing_rows, report_of, require, require_counts, tallies
from seatflow.operators.sketches import day_sketches, sketch_table
from seatflow.operators.weather import from_day, with_previous_day
from seatflow.runtime import stored, stored_with
from seatflow.schemas import CALENDAR, FEATURE_TABLES, LOOKBACK_DAYS, SNAPSHOTS_PER_HOUR, TRAFFIC, WEATHER, FeatureTable
from seatflow.sinks.reports import append_failures, save_dates, save_past
from seatflow.sinks.tables import save_buckets, save_hourly, upsert
from seatflow.sources.snapshots import decode_snapshots, path_date, read_chosen
from seatflow.sources.tables import bounded, feature_table, has_rows, table_exists, traffic_parquets

Reader = Callable[[DataFrame], DataFrame]

#: Per day of traffic: the distribution of mean occupancy, and the routes and their directions.
TRAFFIC_SKETCHES = sketch_table("traffic_sketches", ["avg_occupancy"], ["route_id", "line"])


@dataclass(frozen=True)
class Warehouse:
    """Where the feature tables are."""

    root: str

    def path(self, table: FeatureTable) -> str:
        return f"{self.root.rstrip('/')}/{table.name}"

    def quarantine(self, table: FeatureTable) -> str:
        return f"{self.root.rstrip('/')}/quarantine/{table.name}"

    def read(self, spark: SparkSession, table: FeatureTable, **bounds) -> DataFrame:
        return feature_table(spark, table, self.path(table), **bounds)


@dataclass(frozen=True)
class Buckets:
    """Copies of the feature tables in buckets of days, `<prefix>_<table>` in the session's catalog."""

    prefix: str

    def name(self, table: FeatureTable) -> str:
        return f"{self.prefix}_{table.name}"

    def read(self, spark: SparkSession, table: FeatureTable, **bounds) -> DataFrame:
        return bounded(spark.table(self.name(table)), table, **bounds)


def bucket_tables(spark: SparkSession, warehouse: Warehouse, prefix: str, root: str, buckets: int) -> Buckets:
    """Copy the feature tables into buckets of days below `root`, for jobs that join them more than once.

    Each copy moves its rows once; exports and feature views over the copies then move none.
    """
    made = Buckets(prefix)
    for table in FEATURE_TABLES.values():
        save_buckets(warehouse.read(spark, table), table, made.name(table), f"{root.rstrip('/')}/{table.name}", buckets)
    return made


def file_reader(spark: SparkSession) -> Reader:
    """Decode sampled snapshot files from where the listing found them."""
    return lambda chosen: read_chosen(spark, chosen)


def archive_reader(archive: DataFrame) -> Reader:
    """Decode sampled snapshots kept as (path, content) rows of a table, by day if it has a `date`."""
    key = ["path", "date"] if "date" in archive.columns else ["path"]

    def read(chosen: DataFrame) -> DataFrame:
        return decode_snapshots(archive.join(chosen.select(*key), key, "left_semi"))

    return read


def hours_of_dates(
    listing: DataFrame, read: Reader, trips: DataFrame, dates: DataFrame, k: int = SNAPSHOTS_PER_HOUR
) -> tuple[DataFrame, DataFrame]:
    """Hourly rows of all given days at once, and the days that failed with the reason (B2 core).

    A day fails alone: no trip map for its month, no snapshots, or a damaged snapshot.
    """
    dates = stored(dates.select(F.to_date("date").alias("date")).distinct(), "dates")
    months = trips.select("month").distinct()
    tagged = dates.withColumn("month", month_tag("date"))
    mapped = tagged.join(months, "month", "left_semi").select("date")
    unmapped = tagged.join(months, "month", "left_anti").select(
        "date", F.lit("trip map").alias("stage"), F.lit("no map for the month").alias("error")
    )

    chosen = evenly_spaced(listing.join(mapped, "date", "left_semi"), k)
    vehicles = read(chosen).withColumn("archive_date", path_date("path"))
    # files are decoded once, and only their counts are kept
    counts = stored(counts_by_trip(usable_sightings(vehicles, keep_errors=True)), "counts")

    empty = mapped.join(listing.select("date").distinct(), "date", "left_anti").select(
        "date", F.lit("snapshots").alias("stage"), F.lit("no snapshots").alias("error")
    )
    damaged = counts.where("error is not null").groupBy(F.col("archive_date").alias("date")).agg(
        F.lit("decode").alias("stage"), F.min("error").alias("error")
    )
    reasons = unmapped.unionByName(empty).unionByName(damaged)
    failures = reasons.groupBy("date").agg(F.min(F.struct("stage", "error")).alias("why"))
    failures = stored(
        failures.select(F.col("date").cast("string").alias("date"), "why.stage", "why.error"), "failures"
    )
    failed = failures.select(F.to_date("date").alias("archive_date"))
    good = counts.join(failed, "archive_date", "left_anti")
    return stored(resolve_counts(good, trips), "hours"), failures


def decode_history(
    listing: DataFrame,
    read: Reader,
    trips: DataFrame,
    dates: DataFrame,
    out_path: str,
    failures_path: str,
    k: int = SNAPSHOTS_PER_HOUR,
) -> DataFrame:
    """Decode any set of days to an hourly parquet file and a failure report (B2)."""
    hours, failures = hours_of_dates(listing, read, trips, dates, k)
    save_hourly(hours, out_path)
    append_failures(failures, failures_path)
    return hours


def existing_dates(spark: SparkSession, warehouse: Warehouse, since: str | date, path: str | None = None) -> DataFrame:
    """Days of the traffic table from `since` on, also as a text file when a path is given."""
    if not table_exists(spark, warehouse.path(TRAFFIC), TRAFFIC.schema):
        days = spark.createDataFrame([], "date string")
    else:
        # the partition column alone: no column of any file is read
        days = distinct_dates(warehouse.read(spark, TRAFFIC, columns=["date"]).where(F.col("date") >= str(since)[:10]))
    if path is not None:
        save_dates(days, path)
    return days


def prepare_traffic(hours: DataFrame) -> DataFrame:
    return with_event_time(traffic_types(hours))


def prepare_weather(source: DataFrame, first: date, last: date) -> DataFrame:
    """Weather rows of first..last; the day before is read too, for its values, and dropped last."""
    near = source.where(F.to_date("date").between(F.lit(first - timedelta(days=1)), F.lit(last)))
    return with_event_time(weather_types(from_day(with_previous_day(near), first)))


def prepare_calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    return with_event_time(calendar_types(calendar_between(spark, first, last)), hour=None)


def insert(rows: DataFrame, table: FeatureTable, warehouse: Warehouse, mode: str = "warn") -> DataFrame:
    """Check the table's rules, then upsert every row (Q8, K2).

    The rows are worked out once and the rules are counted while they are stored, so the check costs no pass of its own.
    With "warn" the rows that break a rule are also copied to the warehouse's quarantine; "fail"
    stops before anything is written.
    """
    rows, seen = stored_with(rows, table.name, tallies(SUITES[table.name]))
    failing = failing_rows(rows, seen, table.name, mode)
    if failing is not None:
        failing.write.mode("append").parquet(warehouse.quarantine(table))
    upsert(rows, table, warehouse.path(table))
    return report_of(rows.sparkSession, seen, table.name)


def with_line(traffic: DataFrame) -> DataFrame:
    """Adds the route and direction as one text, to count pairs of both."""
    return traffic.withColumn("line", F.concat_ws("/", "route_id", "direction_id"))


def refresh_sketches(spark: SparkSession, warehouse: Warehouse, days: DataFrame | None = None) -> None:
    """Sum up the stored traffic of `days` (column `date`; None: of all days) and replace their sketches.

    A day is read again as a whole, since its rows may have been replaced and a sketch forgets nothing. The days become a
    bound on the partitions to read, and then a join.
    """
    rows = warehouse.read(spark, TRAFFIC)
    if days is not None:
        days = stored(days.select("date").where("date is not null").distinct(), "days")
        low, high = days.agg(F.min("date"), F.max("date")).first()
        if low is None:
            return
        rows = rows.where(F.col("date").between(low, high)).join(days, "date", "left_semi")
    sketches = day_sketches(with_line(rows), ["avg_occupancy"], ["route_id", "line"])
    upsert(sketches, TRAFFIC_SKETCHES, warehouse.path(TRAFFIC_SKETCHES))


def _insert_context(
    spark: SparkSession, warehouse: Warehouse, weather: DataFrame, first: date, last: date, mode: str
) -> list[DataFrame]:
    if first > last:
        return []
    return [
        insert(prepare_calendar(spark, first, last), CALENDAR, warehouse, mode),
        insert(prepare_weather(weather, first, last), WEATHER, warehouse, mode),
    ]


def daily_features(
    spark: SparkSession,
    warehouse: Warehouse,
    as_of: date,
    listing: DataFrame,
    read: Reader,
    trips: DataFrame,
    weather: DataFrame,
    failures_path: str,
    lookback: int = LOOKBACK_DAYS,
    need_existing: bool = False,
    mode: str = "warn",
    k: int = SNAPSHOTS_PER_HOUR,
    sketches: bool = False,
) -> DataFrame:
    """Add the days missing from the look-back window, with their calendar and weather (B1).

    Returns the days that got rows. Context is written for their span only, up to yesterday. `sketches` also
    keeps the summaries of the days up to date.
    """
    first, yesterday = as_of - timedelta(days=lookback), as_of - timedelta(days=1)
    have = existing_dates(spark, warehouse, first)
    missing = stored(missing_dates(spark, have, first, yesterday, need_existing), "missing")
    hours, failures = hours_of_dates(listing, read, trips, missing, k)
    append_failures(failures, failures_path)
    done = distinct_dates(hours)
    if not has_rows(hours):
        return done
    require_counts(hours, mode)
    insert(prepare_traffic(hours), TRAFFIC, warehouse, mode)
    if sketches:
        refresh_sketches(spark, warehouse, done)
    span = date_range(hours).first()
    _insert_context(spark, warehouse, weather, span.first_date, min(span.last_date, yesterday), mode)
    return done


def backfill(
    spark: SparkSession,
    warehouse: Warehouse,
    paths: Sequence[str],
    weather: DataFrame,
    counts: str = "fail",
    mode: str = "warn",
) -> list[DataFrame]:
    """Load hourly files with their weather and calendar; wrong counts stop it."""
    rows = traffic_parquets(spark, paths)
    hours, seen = stored_with(rows, "hours", [*count_agreement(rows), *day_bounds()])
    require(seen.valid, counts)
    reports = [insert(prepare_traffic(hours), TRAFFIC, warehouse, mode)]
    if seen.first_date is not None:
        reports += _insert_context(spark, warehouse, weather, seen.first_date, seen.last_date, mode)
    return reports


def export_past(
    spark: SparkSession, warehouse: Warehouse | Buckets, since: str | date, path: str, until: str | date | None = None
) -> int:
    """Join the three tables from `since` on and store the result; returns its rows.

    Without traffic rows nothing is written. Tables in buckets are joined and written where they lie.
    """
    traffic, calendar, weather = (
        warehouse.read(spark, table, since=since, until=until) for table in (TRAFFIC, CALENDAR, WEATHER)
    )
    if not has_rows(traffic):
        return 0
    if isinstance(warehouse, Buckets):
        return save_past(past_rows_by_day(traffic, calendar, weather), path, even=True)
    return save_past(past_rows(traffic, calendar, weather), path)
