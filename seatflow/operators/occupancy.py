"""From vehicle sightings to hourly occupancy."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.functions.clock import local_clock, month_tag, utc_clock
from seatflow.functions.scores import exact_mean, score_of, status_name
from seatflow.schemas import (
    COUNT_COLUMNS,
    IGNORED_STATUSES,
    LOCAL_ZONE,
    SCORED_STATUSES,
    TRAFFIC_COLUMNS,
)

HOURLY_KEY = ["date", "hour", "route_id", "direction_id"]


def usable_sightings(vehicles: DataFrame, ignored: Iterable[str] = (), keep_errors: bool = False) -> DataFrame:
    """Sightings with a vehicle, a known status that is not ignored, and a time.

    The vehicle's own time counts even when it is 0; the feed header's stands in unless it is 0.
    `keep_errors` also lets through the rows that stand for files which could not be read.
    """
    ignored = list(ignored) or IGNORED_STATUSES
    status = status_name(F.col("occupancy_status"))
    time = F.coalesce("vehicle_ts", F.nullif(F.col("header_ts"), F.lit(0)))
    usable = F.col("has_vehicle") & status.isNotNull() & ~status.isin(ignored) & time.isNotNull()
    if keep_errors:
        usable = usable | F.col("error").isNotNull()
    rest = [c for c in vehicles.columns if c not in ("has_vehicle", "occupancy_status", "vehicle_ts", "header_ts")]
    return vehicles.where(usable).select(time.alias("ts"), status.alias("occupancy"), *rest)


def _blank(value: str) -> Column:
    return F.nullif(F.col(value), F.lit(""))


def resolve_routes(sightings: DataFrame, trips: DataFrame) -> DataFrame:
    """Give each sighting its route and direction from its month's trip map; drop it without a route.

    The feed's own route wins over the map's; the direction is the map's, 0 for an unknown trip.
    `trips` holds each (month, trip_id) once. Sightings without a trip get a key that no trip has, one of
    many, so that they do not meet in one task; a trip that holds much of the rows is a skewed partition, which
    Spark splits at run time.
    """
    none = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*sightings.columns), F.lit(100_000)))
    spread = sightings.withColumn("_trip", F.coalesce(_blank("trip_id"), none))
    known = trips.select(
        "month", F.col("trip_id").alias("_trip"),
        F.col("route_id").alias("_map_route"), F.col("direction_id").alias("_map_direction"),
    )
    return _resolved(spread.join(known, ["month", "_trip"], "left")).drop("_trip")


def _resolved(joined: DataFrame) -> DataFrame:
    return (
        joined.withColumns({
            "route_id": F.coalesce(_blank("route_id"), "_map_route"),
            "direction_id": F.coalesce("_map_direction", F.lit(0)),
        })
        .where(F.coalesce(_blank("route_id"), F.lit("")) != "")
        .drop("_map_route", "_map_direction")
    )


def local_hours(sightings: DataFrame, zone: str = LOCAL_ZONE, archive_date: str | None = None) -> DataFrame:
    """Add local `date` and `hour`; with `archive_date`, keep the sightings of that local day."""
    clock = local_clock(utc_clock("ts"), zone)
    rows = sightings.withColumns({"date": F.to_date(clock), "hour": F.hour(clock)})
    return rows if archive_date is None else rows.where(F.col("date") == F.col(archive_date))


def status_counts() -> list[Column]:
    """One count per scored status (A2). Six whole numbers are all the state an hour needs."""
    return [
        F.expr(f"count_if(occupancy = '{status}') as {column}")
        for column, status in zip(COUNT_COLUMNS, SCORED_STATUSES)
    ]


def count_statuses(sightings: DataFrame, key: Iterable[str] = HOURLY_KEY) -> DataFrame:
    """Counts per status and key, statuses off the scale left out (F2, A2)."""
    scored = sightings.where(F.col("occupancy").isin(SCORED_STATUSES))
    return scored.groupBy(*key).agg(*status_counts())


def merge_counts(counts: DataFrame, key: Iterable[str] = HOURLY_KEY) -> DataFrame:
    """Add up counts that share a key."""
    return counts.groupBy(*key).agg(*[F.sum(c).alias(c) for c in COUNT_COLUMNS])


def summarise(counts: DataFrame) -> DataFrame:
    """Observations, mean, maximum and mode of each hour, all from its six counts."""
    numbered = list(enumerate(COUNT_COLUMNS))
    score_sum = " + ".join(f"{score} * {column}" for score, column in numbered[1:])
    highest = " ".join(f"when {column} > 0 then {score}" for score, column in reversed(numbered))
    most = f"greatest({', '.join(COUNT_COLUMNS)})"
    commonest = " ".join(f"when {column} = {most} then {score}L" for score, column in numbered)
    return counts.selectExpr("*", f"{' + '.join(COUNT_COLUMNS)} as n_obs", f"{score_sum} as _sum").select(
        *counts.columns, "n_obs",
        exact_mean("_sum", "n_obs").alias("avg_occupancy"),
        F.expr(f"case {highest} end as max_occupancy"),
        F.expr(f"case {commonest} end as mode_occupancy"),
    )


def hourly_occupancy(
    sightings: DataFrame, zone: str = LOCAL_ZONE, archive_date: str | None = None
) -> DataFrame:
    """Hourly occupancy per route and direction of resolved sightings (A1).

    One shuffle, of partial counts: a busy route sends one row per map task, not its sightings.
    """
    hours = count_statuses(local_hours(sightings, zone, archive_date))
    return summarise(hours).select(*TRAFFIC_COLUMNS)


def counts_by_trip(sightings: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Status counts per local hour, month, trip and feed route of each archive day, before any join.

    Local hours are numbered from the epoch and statuses from 0, so that a row is grouped and counted
    by whole numbers; hour and month are worked out on the counts. Rows that stand for unreadable files
    pass through with their `error` and no counts.
    """
    clock = local_clock(utc_clock("ts"), zone)
    number = F.unix_date(F.to_date("_clock")) * 24 + F.hour("_clock")
    rows = sightings.withColumn("_clock", clock).withColumns({"_hour": number, "_score": score_of(F.col("occupancy"))})
    failed = F.col("error").isNotNull()
    own_day = F.floor(F.col("_hour") / 24) == F.unix_date("archive_date")
    rows = rows.where(failed | (own_day & F.col("_score").isNotNull()))
    key = [
        "archive_date", F.when(~failed, F.col("_hour")).alias("_hour"),
        F.coalesce("trip_id", F.lit("")).alias("trip_id"), F.coalesce("route_id", F.lit("")).alias("route_id"), "error",
    ]
    counts = rows.groupBy(*key).agg(*[F.count_if(F.col("_score") == n).alias(c) for n, c in enumerate(COUNT_COLUMNS)])
    return counts.select(
        "archive_date", (F.col("_hour") % 24).cast("int").alias("hour"), month_tag("archive_date").alias("month"),
        "trip_id", "route_id", "error", *COUNT_COLUMNS,
    )


def resolve_counts(counts: DataFrame, trips: DataFrame) -> DataFrame:
    """Routes and directions for counts by trip, then one row per route-hour."""
    known = trips.select(
        "month", "trip_id", F.col("route_id").alias("_map_route"), F.col("direction_id").alias("_map_direction")
    )
    rows = counts.where(F.col("error").isNull()).withColumnRenamed("archive_date", "date")
    resolved = _resolved(rows.join(known, ["month", "trip_id"], "left"))
    return summarise(merge_counts(resolved)).select(*TRAFFIC_COLUMNS)


def hourly_from_trips(sightings: DataFrame, trips: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """As resolving routes first and then aggregating, but with the join after a first count.

    Counting per hour, trip and feed route shrinks the sightings before any join. No trip, and not
    the missing trip either, keeps more rows than its hours times its feed routes, so the join
    needs no salt. `sightings` has `archive_date`.
    """
    return resolve_counts(counts_by_trip(sightings, zone), trips)


def _agrees() -> Column:
    total = sum((F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in COUNT_COLUMNS), F.lit(0))
    return F.coalesce(total == F.col("n_obs"), F.lit(False))


def wrong_counts(rows: DataFrame) -> DataFrame:
    """Rows whose six counts, missing ones as 0, do not add up to `n_obs`."""
    return rows.where(~_agrees())


def counts_agree(rows: DataFrame) -> DataFrame:
    """One row: `valid`, do the counts add up everywhere, and `n_wrong`.

    False when a column is missing, true when there are no rows.
    """
    return rows.agg(*count_agreement(rows))


def count_agreement(rows: DataFrame) -> list[Column]:
    """What `counts_agree` selects, to be observed while the rows are written."""
    if not {"n_obs", *COUNT_COLUMNS} <= set(rows.columns):
        return [F.lit(False).alias("valid"), F.count("*").alias("n_wrong")]
    return [F.coalesce(F.every(_agrees()), F.lit(True)).alias("valid"), F.count_if(~_agrees()).alias("n_wrong")]


def coverage(rows: DataFrame) -> DataFrame:
    """Distinct routes and distinct (route, direction) pairs.

    Pairs first, then routes over the pairs: the rows themselves are shuffled once, reduced.
    """
    pairs = rows.select("route_id", "direction_id").distinct()
    routes = pairs.groupBy("route_id").agg(F.count("*").alias("pairs"))
    return routes.agg(F.count("*").alias("n_routes"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("n_pairs"))


def date_range(rows: DataFrame, column: str = "date") -> DataFrame:
    """First and last day."""
    return rows.agg(*day_bounds(column))


def day_bounds(column: str = "date") -> list[Column]:
    return [F.min(F.to_date(column)).alias("first_date"), F.max(F.to_date(column)).alias("last_date")]


def distinct_dates(rows: DataFrame, column: str = "date") -> DataFrame:
    """Days that have rows."""
    return rows.select(F.col(column).cast("string").alias("date")).distinct()


