"""The test tables seen as the domain's inputs, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.functions.casts import calendar_types, traffic_types, weather_types, with_event_time
from seatflow.functions.clock import date_spine, epoch_seconds, spine_between
from seatflow.operators.calendar import calendar_features
from seatflow.operators.occupancy import hourly_occupancy
from seatflow.operators.weather import with_previous_day
from seatflow.runtime import stored
from seatflow.sources.snapshots import feed_message

MARCH = [f"1996-03-{day:02d}" for day in range(1, 32)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sightings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as resolved vehicle sightings."""
    return as_sightings(table(spark, folder, "events"))


def as_sightings(events: DataFrame, *more) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    status = (
        F.when(kind == "view", "EMPTY")
        .when(kind == "click", "MANY_SEATS_AVAILABLE")
        .when(kind == "signup", "FEW_SEATS_AVAILABLE")
        .when(kind == "purchase", "STANDING_ROOM_ONLY")
        .when(value < 10, "NO_DATA_AVAILABLE")
        .when(value < 60, "CRUSHED_STANDING_ROOM_ONLY")
        .otherwise("FULL")
    )
    return events.select(
        "event_id",
        epoch_seconds("ts").alias("ts"),
        F.col("user_id").cast("string").alias("trip_id"),
        (F.col("user_id") % 20).cast("string").alias("route_id"),
        (F.floor(F.col("user_id") / 20) % 2).cast("int").alias("direction_id"),
        status.alias("occupancy"),
        *more,
    )


SQL_OBS = """
obs AS (
  SELECT event_id, epoch_us(ts) // 1000000 AS ts, ts AS utc,
    timezone('Europe/Stockholm', timezone('UTC', ts)) AS local_ts,
    CAST(user_id AS VARCHAR) AS trip_id, CAST(user_id % 20 AS VARCHAR) AS route_id,
    (user_id // 20) % 2 AS direction_id,
    CASE event_type WHEN 'view' THEN 'EMPTY' WHEN 'click' THEN 'MANY_SEATS_AVAILABLE'
      WHEN 'signup' THEN 'FEW_SEATS_AVAILABLE' WHEN 'purchase' THEN 'STANDING_ROOM_ONLY'
      ELSE CASE WHEN value < 10 THEN 'NO_DATA_AVAILABLE'
        WHEN value < 60 THEN 'CRUSHED_STANDING_ROOM_ONLY' ELSE 'FULL' END END AS occupancy
  FROM events)"""


def sql_hourly(source: str = "obs", name: str = "hourly", where: str = "true") -> str:
    """CTEs from sightings to hourly rows, by scores rather than by counts."""
    return f"""
{name}_scored AS (
  SELECT CAST(CAST(local_ts AS DATE) AS VARCHAR) AS date, CAST(hour(local_ts) AS INTEGER) AS hour,
    route_id, CAST(direction_id AS INTEGER) AS direction_id,
    CASE occupancy WHEN 'EMPTY' THEN 0 WHEN 'MANY_SEATS_AVAILABLE' THEN 1 WHEN 'FEW_SEATS_AVAILABLE' THEN 2
      WHEN 'STANDING_ROOM_ONLY' THEN 3 WHEN 'CRUSHED_STANDING_ROOM_ONLY' THEN 4 WHEN 'FULL' THEN 5 END AS score
  FROM {source} WHERE {where}),
{name}_mode AS (
  SELECT date, hour, route_id, direction_id, score, row_number() OVER (
    PARTITION BY date, hour, route_id, direction_id ORDER BY count(*) DESC, score) AS place
  FROM {name}_scored WHERE score IS NOT NULL GROUP BY date, hour, route_id, direction_id, score),
{name} AS (
  SELECT s.date, s.hour, s.route_id, s.direction_id, count(*) AS n_obs,
    count(*) FILTER (s.score = 0) AS n_empty, count(*) FILTER (s.score = 1) AS n_many_seats,
    count(*) FILTER (s.score = 2) AS n_few_seats, count(*) FILTER (s.score = 3) AS n_standing,
    count(*) FILTER (s.score = 4) AS n_crushed, count(*) FILTER (s.score = 5) AS n_full,
    round_even(sum(s.score) / count(*), 4) AS avg_occupancy, max(s.score) AS max_occupancy,
    CAST(any_value(m.score) AS BIGINT) AS mode_occupancy
  FROM {name}_scored s JOIN {name}_mode m ON m.place = 1 AND s.date = m.date AND s.hour = m.hour
    AND s.route_id = m.route_id AND s.direction_id = m.direction_id
  WHERE s.score IS NOT NULL GROUP BY s.date, s.hour, s.route_id, s.direction_id)"""


SQL_HOURLY = SQL_OBS + "," + sql_hourly()
HOURLY_NAMES = (
    "date, hour, route_id, direction_id, n_obs, n_empty, n_many_seats, n_few_seats, n_standing, "
    "n_crushed, n_full, avg_occupancy, max_occupancy, mode_occupancy"
)


def sql_typed(alias: str = "") -> str:
    """Select list that casts hourly columns to their stored types."""
    p = f"{alias}." if alias else ""
    small = ", ".join(
        f"CAST({p}{c} AS SMALLINT) AS {c}"
        for c in "n_obs n_empty n_many_seats n_few_seats n_standing n_crushed n_full".split()
    )
    return (
        f"{p}date AS date, CAST({p}hour AS TINYINT) AS hour, {p}route_id AS route_id, "
        f"CAST({p}direction_id AS TINYINT) AS direction_id, {small}, "
        f"CAST({p}avg_occupancy AS FLOAT) AS avg_occupancy, CAST({p}max_occupancy AS TINYINT) AS max_occupancy, "
        f"{p}mode_occupancy AS mode_occupancy, "
        f"strftime(CAST({p}date AS TIMESTAMP) + to_hours({p}hour), '%Y-%m-%d %H:%M:%S') AS event_time"
    )


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    return with_text_date(hourly_occupancy(sightings(spark, folder)))


def with_text_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.col("date").cast("string"))


def with_text_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", F.col("event_time").cast("string"))


def typed_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return with_event_time(traffic_types(hourly(spark, folder)))


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly weather made from event values, with whole days missing."""
    events = table(spark, folder, "events")
    hours = events.groupBy(F.to_date("ts").alias("date"), F.hour("ts").alias("hour")).agg(
        F.max("value").alias("temperature_2m"),
        F.min("value").alias("precipitation"),
        F.count("*").cast("double").alias("windspeed_10m"),
        (F.count("*") * 7 % 101).cast("int").alias("cloudcover"),
    )
    return hours.where(F.dayofyear("date") % 7 != 3)


SQL_WEATHER = """
weather AS (
  SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, max(value) AS temperature_2m, min(value) AS precipitation,
    CAST(count(*) AS DOUBLE) AS windspeed_10m, CAST(count(*) * 7 % 101 AS INTEGER) AS cloudcover
  FROM events GROUP BY CAST(ts AS DATE), hour(ts) HAVING dayofyear(CAST(ts AS DATE)) % 7 <> 3),
prev_weather AS (
  SELECT CAST(w.day AS VARCHAR) AS date, w.hour,
    CAST(w.temperature_2m AS FLOAT) AS temperature_2m, CAST(w.precipitation AS FLOAT) AS precipitation,
    CAST(w.windspeed_10m AS FLOAT) AS windspeed_10m, CAST(w.cloudcover AS TINYINT) AS cloudcover,
    CAST(p.temperature_2m AS FLOAT) AS prev_temperature_2m, CAST(p.precipitation AS FLOAT) AS prev_precipitation,
    CAST(p.windspeed_10m AS FLOAT) AS prev_windspeed_10m, CAST(p.cloudcover AS TINYINT) AS prev_cloudcover
  FROM weather w LEFT JOIN weather p ON p.day = w.day - 1 AND p.hour = w.hour)"""


def typed_weather(spark: SparkSession, folder: str) -> DataFrame:
    return with_event_time(weather_types(with_previous_day(raw_weather(spark, folder))))


def calendar_days(spark: SparkSession, folder: str) -> DataFrame:
    """Every day of the orders' span, and January and February 2024."""
    span = table(spark, folder, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    )
    return spine_between(span, "first", "last").union(date_spine(spark, "2024-01-01", "2024-02-29"))


def typed_calendar(spark: SparkSession, folder: str) -> DataFrame:
    rows = calendar_features(calendar_days(spark, folder))
    return with_event_time(calendar_types(rows), hour=None)


SQL_CALENDAR = """
days AS (
  SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders
  UNION ALL
  SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-29', INTERVAL 1 DAY)) AS DATE)),
easters(e) AS (VALUES (DATE '1995-04-16'), (DATE '1996-04-07'), (DATE '1997-03-30'), (DATE '1998-04-12'),
  (DATE '1999-04-04'), (DATE '2000-04-23'), (DATE '2001-04-15'), (DATE '2024-03-31')),
free AS (
  SELECT e + n AS day FROM easters, (VALUES (-2), (0), (1), (39), (49)) AS offs(n)
  UNION SELECT e + 50 FROM easters WHERE year(e) < 2005
  UNION SELECT day FROM days WHERE strftime(day, '%m-%d') IN ('01-01', '01-06', '05-01', '12-25', '12-26')
  UNION SELECT day FROM days WHERE strftime(day, '%m-%d') = '06-06' AND year(day) >= 2005
  UNION SELECT day FROM days WHERE isodow(day) = 6 AND strftime(day, '%m-%d') BETWEEN '06-20' AND '06-26'
  UNION SELECT day FROM days WHERE isodow(day) = 6
    AND (strftime(day, '%m-%d') = '10-31' OR strftime(day, '%m-%d') BETWEEN '11-01' AND '11-06')),
calendar AS (
  SELECT CAST(d.day AS VARCHAR) AS date, CAST(month(d.day) AS SMALLINT) AS month, dayname(d.day) AS weekday,
    isodow(d.day) >= 6 AS is_weekend, f.day IS NOT NULL AS is_holiday_se,
    isodow(d.day) < 6 AND f.day IS NULL AS is_workday_se
  FROM days d LEFT JOIN free f ON d.day = f.day)"""


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as trips with an operating day."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.to_date("o_orderdate").alias("operating_day"),
        (F.col("o_custkey") % 25).cast("string").alias("route_id"),
        (F.col("o_orderkey") % 2).cast("int").alias("direction_id"),
    )


def moved_trips(spark: SparkSession, folder: str) -> DataFrame:
    """The same trips on 35 days from 2024-01-01 on, so that they meet the weather."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("trip_id").cast("bigint") % 35).cast("int"))
    return trips(spark, folder).withColumn("operating_day", day)


MOVED_DAYS = [f"2024-01-{day:02d}" for day in range(1, 32)] + [f"2024-02-0{day}" for day in range(1, 5)]


def stops(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as stops; hours pass 24."""
    hour = 4 + F.col("l_orderkey") % 3 + 4 * F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00")).alias("arrival_time"),
        F.col("l_linenumber").alias("stop_sequence"),
    )


def routes(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as routes, two of those in use left out."""
    return table(spark, folder, "nation").where("n_nationkey < 23").select(
        F.col("n_nationkey").cast("string").alias("route_id"),
        F.col("n_nationkey").cast("string").alias("route_short_name"),
        F.col("n_name").alias("route_long_name"),
    )


SQL_BOUNDS = """
bounds AS (
  SELECT l_orderkey, arg_min(4 + l_orderkey % 3 + 4 * l_linenumber, l_linenumber) AS first_hour,
    arg_max(4 + l_orderkey % 3 + 4 * l_linenumber, l_linenumber) AS last_hour
  FROM lineitem GROUP BY l_orderkey)"""


def sql_route_hours(day: str, first: str, last: str, name: str = "route_hours") -> str:
    """CTEs from orders and line items to active route-hours on the days first..last."""
    return f"""{SQL_BOUNDS},
{name}_each AS (
  SELECT {day} AS day, CAST(o_custkey % 25 AS VARCHAR) AS route_id, CAST(o_orderkey % 2 AS INTEGER) AS direction_id,
    unnest(generate_series(first_hour, last_hour)) AS h
  FROM orders JOIN bounds ON l_orderkey = o_orderkey
  WHERE {day} BETWEEN DATE '{first}' AND DATE '{last}'),
{name} AS (
  SELECT DISTINCT CAST(CASE WHEN h >= 24 THEN day + 1 ELSE day END AS VARCHAR) AS date,
    CAST(least(23, CASE WHEN h >= 24 THEN h - 24 ELSE h END) AS INTEGER) AS hour, e.route_id, direction_id,
    coalesce(CAST(n_nationkey AS VARCHAR), '') AS route_short_name, coalesce(n_name, '') AS route_long_name
  FROM {name}_each e LEFT JOIN nation ON n_nationkey < 23 AND CAST(n_nationkey AS VARCHAR) = e.route_id
  WHERE CASE WHEN h >= 24 THEN day + 1 ELSE day END BETWEEN DATE '{first}' AND DATE '{last}')"""


SQL_MARCH_HOURS = sql_route_hours("CAST(o_orderdate AS DATE)", "1996-03-01", "1996-03-31")
SQL_MOVED_HOURS = sql_route_hours(
    "(DATE '2024-01-01' + CAST(o_orderkey % 35 AS INTEGER))", "2024-01-01", "2024-02-04"
)


def snapshot_path(event_id: str = "event_id", time: str = "ts"):
    return F.concat(
        F.lit("feed/"), F.date_format(time, "yyyy/MM/dd/HH/"), F.lpad(F.col(event_id).cast("string"), 12, "0"),
        F.lit(".pb"),
    )


def snapshot_paths(spark: SparkSession, folder: str) -> DataFrame:
    """One snapshot file name per event."""
    return table(spark, folder, "events").select("event_id", snapshot_path().alias("path"))


def vehicles(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw feed entities, some without vehicle, status, time or route."""
    events = table(spark, folder, "events")
    code = F.array_position(
        F.array(*[F.lit(s) for s in (
            "EMPTY", "MANY_SEATS_AVAILABLE", "FEW_SEATS_AVAILABLE", "STANDING_ROOM_ONLY",
            "CRUSHED_STANDING_ROOM_ONLY", "FULL", "NOT_ACCEPTING_PASSENGERS", "NO_DATA_AVAILABLE",
        )]), F.col("occupancy")
    ).cast("int") - 1
    hour_start = epoch_seconds(F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    rows = as_sightings(events, snapshot_path().alias("path"), hour_start.alias("_hour_start"))
    event = F.col("event_id")
    return rows.select(
        "path",
        F.when(event % 13 == 0, 0).otherwise(F.col("_hour_start")).cast("bigint").alias("header_ts"),
        (event % 17 != 0).alias("has_vehicle"),
        F.when(event % 7 != 0, F.col("ts")).alias("vehicle_ts"),
        "trip_id",
        F.when(event % 3 == 0, "").otherwise(F.col("route_id")).alias("route_id"),
        F.when(event % 11 != 0, code).alias("occupancy_status"),
        F.lit(None).cast("string").alias("error"),
    )


def sql_usable(source: str = "obs") -> str:
    """CTE of the entities that pass the sighting filters."""
    return f"""
usable AS (
  SELECT 'feed/' || strftime(utc, '%Y/%m/%d/%H/') || lpad(CAST(event_id AS VARCHAR), 12, '0') || '.pb' AS path,
    event_id, utc, CASE WHEN event_id % 7 <> 0 THEN ts
      WHEN event_id % 13 = 0 THEN NULL ELSE epoch_us(date_trunc('hour', utc)) // 1000000 END AS ts,
    occupancy, trip_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE route_id END AS route_id
  FROM {source}
  WHERE event_id % 17 <> 0 AND event_id % 11 <> 0 AND occupancy <> 'NO_DATA_AVAILABLE'
    AND NOT (event_id % 7 = 0 AND event_id % 13 = 0))"""


SQL_VEHICLES = SQL_OBS + "," + sql_usable()


def encoded_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The same entities as (path, content) snapshot files of one entity each."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        feed_type = feed_message()
        for batch in batches:
            contents = []
            for row in batch.itertuples():
                feed = feed_type()
                feed.header.timestamp = int(row.header_ts)
                entity = feed.entity.add(id="1")
                if row.has_vehicle:
                    vehicle = entity.vehicle
                    vehicle.trip.trip_id = row.trip_id
                    vehicle.trip.route_id = row.route_id
                    if not pd.isna(row.vehicle_ts):
                        vehicle.timestamp = int(row.vehicle_ts)
                    if not pd.isna(row.occupancy_status):
                        vehicle.occupancy_status = int(row.occupancy_status)
                contents.append(feed.SerializeToString())
            yield pd.DataFrame({"path": batch["path"], "content": contents})

    return stored(vehicles(spark, folder).mapInPandas(encode, "path string, content binary"), "snapshots")


def trip_map(spark: SparkSession, folder: str, month: str = "2024-01") -> DataFrame:
    """Orders as the trip map of a month, every fifth trip unknown."""
    known = trips(spark, folder).where(F.col("trip_id").cast("bigint") % 5 != 0)
    return known.select(F.lit(month).alias("month"), "trip_id", "route_id", "direction_id")


SQL_RESOLVED = """
resolved AS (
  SELECT u.event_id, u.path, u.utc, u.ts, timezone('Europe/Stockholm', timezone('UTC', make_timestamp(u.ts * 1000000))) AS local_ts,
    u.occupancy, CASE WHEN u.route_id <> '' THEN u.route_id ELSE CAST(o_custkey % 25 AS VARCHAR) END AS route_id,
    coalesce(o_orderkey % 2, 0) AS direction_id
  FROM usable u LEFT JOIN orders ON CAST(o_orderkey AS VARCHAR) = u.trip_id AND o_orderkey % 5 <> 0
  WHERE u.route_id <> '' OR o_orderkey IS NOT NULL)"""


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as labelled and predicted classes."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_linenumber") % 6).alias("y"), (F.col("l_quantity").cast("int") % 6).alias("p")
    )


SQL_LABELS = "labels_yp AS (SELECT l_linenumber % 6 AS y, CAST(l_quantity AS INTEGER) % 6 AS p FROM lineitem)"
