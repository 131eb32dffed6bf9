"""Timetable texts and active route-hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.registry import case, memo
from seatflow.functions.casts import schedule_types
from seatflow.functions.clock import leading_hour
from seatflow.operators.joins import add_absent_features, fill_weather, schedule_rows
from seatflow.operators.publish import names_from_schedule
from seatflow.operators.ordering import route_listing
from seatflow.operators.schedule import active_route_hours, schedule_summary, trip_bounds, trip_hours
from seatflow.plans.scoring import timetable_route_hours
from seatflow.runtime import fresh_path
from seatflow.schemas import ALL_FEATURES, WEATHER_FEATURES
from seatflow.sources.timetable import (
    read_dated_trips,
    read_route_names,
    read_stop_times,
    read_trip_routes,
)


@case("trip_bounds", f"""WITH {b.SQL_BOUNDS}
SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, lpad(CAST(first_hour AS VARCHAR), 2, '0') || ':00:00' AS first_arrival,
  lpad(CAST(last_hour AS VARCHAR), 2, '0') || ':00:00' AS last_arrival FROM bounds""")
def bounds(spark, folder):
    return trip_bounds(b.stops(spark, folder))


@case("trip_hours", f"""WITH {b.SQL_BOUNDS}
SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(first_hour AS INTEGER) AS first_hour,
  CAST(last_hour AS INTEGER) AS last_hour FROM bounds""")
def hours(spark, folder):
    return trip_hours(b.stops(spark, folder))


def route_hours(spark, folder, trips, days):
    dated = trips.where(F.col("operating_day").cast("string").isin(days)).select("trip_id", "operating_day").distinct()
    known = trips.select("trip_id", "route_id", "direction_id")
    return active_route_hours(dated, b.stops(spark, folder), known, b.routes(spark, folder), days)


@case("active_route_hours", f"WITH {b.SQL_MARCH_HOURS} SELECT * FROM route_hours")
def active_hours(spark, folder):
    return route_hours(spark, folder, b.trips(spark, folder), b.MARCH)


@case("schedule_summary", f"WITH {b.SQL_MARCH_HOURS} SELECT * FROM route_hours")
def summary(spark, folder):
    routes = schedule_summary(active_hours(spark, folder))
    dates = routes.select(
        "route_id", F.col("short_name").alias("route_short_name"), F.col("long_name").alias("route_long_name"),
        F.explode("directions").alias("direction_id", "dates"),
    )
    each = dates.select("*", F.explode("dates").alias("date", "hours")).drop("dates")
    return each.select("*", F.explode("hours").alias("hour")).drop("hours")


SQL_SCHEDULE = f"""{b.SQL_MOVED_HOURS}, {b.SQL_WEATHER}, {b.SQL_CALENDAR},
schedule AS (SELECT s.*, c.month, c.weekday, c.is_weekend, c.is_holiday_se, c.is_workday_se,
  {', '.join(f'coalesce(w.{c}, 0) AS {c}' for c in WEATHER_FEATURES)}
  FROM route_hours s LEFT JOIN calendar c ON c.date = s.date
  LEFT JOIN prev_weather w ON w.date = s.date AND w.hour = s.hour)"""


@case("schedule_features", f"WITH {SQL_SCHEDULE} SELECT {', '.join(ALL_FEATURES)}, date FROM schedule")
def schedule_features(spark, folder):
    moved = route_hours(spark, folder, b.moved_trips(spark, folder), b.MOVED_DAYS)
    rows = schedule_rows(schedule_types(moved), b.typed_calendar(spark, folder), b.typed_weather(spark, folder))
    return add_absent_features(fill_weather(rows)).select(*ALL_FEATURES, "date")


SQL_LISTING = """
WITH fresh AS (SELECT CAST(o_custkey % 25 AS VARCHAR) AS route_id, min('L' || CAST(o_custkey % 25 AS VARCHAR)) AS short_name,
  'Line' AS long_name FROM orders GROUP BY 1),
known AS (SELECT CAST(n_nationkey AS VARCHAR) AS route_id, CAST(n_nationkey AS VARCHAR) || 'x' AS short_name,
  n_name AS long_name FROM nation WHERE n_nationkey < 10),
named AS (SELECT * FROM known UNION ALL SELECT * FROM fresh WHERE route_id NOT IN (SELECT route_id FROM known))
SELECT *, coalesce(TRY_CAST(regexp_extract(short_name, '^\\s*([+-]?\\d+)', 1) AS BIGINT), 0) AS number FROM named"""


@case("route_listing", SQL_LISTING)
def listing(spark, folder):
    known = b.routes(spark, folder).where(F.col("route_id").cast("int") < 10).select(
        "route_id", F.concat("route_short_name", F.lit("x")).alias("short_name"), F.col("route_long_name").alias("long_name")
    )
    fresh = b.trips(spark, folder).select(
        "route_id", F.concat(F.lit("L"), "route_id").alias("route_short_name"), F.lit("Line").alias("route_long_name")
    )
    return route_listing(names_from_schedule(known, fresh))


_FOLDERS: dict[tuple, str] = memo()


def timetable_folder(spark, folder, trips, messy: bool):
    """Timetable texts on disk; `messy` adds blank and invalid directions, repeated and empty keys."""
    key = (spark.sparkContext.applicationId, folder, messy)
    if key in _FOLDERS:
        return _FOLDERS[key]
    root = fresh_path(spark, "timetable")

    def save(df, name):
        df.write.option("header", True).csv(f"{root}/{name}.txt")

    number = F.col("trip_id").try_cast("bigint")
    dated = trips.select("trip_id", F.date_format("operating_day", "yyyyMMdd").alias("operating_day_date"))
    lines = trips.select("route_id", "trip_id", F.col("direction_id").cast("string").alias("direction_id"))
    routes = b.routes(spark, folder)
    if messy:
        direction = F.when(number % 4 == 1, "1").when(number % 4 == 2, "x").when(number % 4 == 3, "0").otherwise("")
        lines = lines.withColumn("direction_id", direction)
        first = lines.where(number % 10 == 0).withColumns({"route_id": F.lit("old"), "direction_id": F.lit("1")})
        lines = first.unionByName(lines).unionByName(lines.limit(5).withColumn("trip_id", F.lit("")))
        dated = dated.unionByName(dated.where(number % 3 == 0)).unionByName(dated.limit(5).withColumn("trip_id", F.lit("")))
        routes = routes.withColumn("route_long_name", F.lit("old")).unionByName(routes)
    stops = b.stops(spark, folder)
    if messy:
        # every third trip has no usable numbers, and the lines of the trips come in files with two orders of columns
        blank = number % 3 == 0
        stops = stops.withColumn("stop_sequence", F.when(~blank, F.col("stop_sequence").cast("string")).otherwise(F.when(F.rand(1) < 0.5, "").otherwise("?")))
        turned = lines.where(number % 2 == 0).select("direction_id", "trip_id", "route_id")
        lines = lines.where(number.isNull() | (number % 2 != 0))
    save(dated, "trips_dated_vehicle_journey")
    save(stops, "stop_times")
    save(lines, "trips")
    if messy:
        turned.write.mode("append").option("header", True).csv(f"{root}/trips.txt")
    save(routes, "routes")
    _FOLDERS[key] = root
    return root


@case("timetable_scan", """
WITH active AS (SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-03-31')
SELECT 'dated' AS kind, CAST(o_orderkey AS VARCHAR) AS key, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS a, '' AS b FROM active
UNION ALL SELECT 'trip', CAST(o_orderkey AS VARCHAR), CAST(o_custkey % 25 AS VARCHAR),
  CASE WHEN o_orderkey % 4 = 1 THEN '1' ELSE '0' END FROM active
UNION ALL SELECT 'route', CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS VARCHAR), n_name FROM nation WHERE n_nationkey < 23
UNION ALL SELECT 'stop', CAST(l_orderkey AS VARCHAR), lpad(CAST(4 + l_orderkey % 3 + 4 * l_linenumber AS VARCHAR), 2, '0') || ':00:00',
  CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE CAST(l_linenumber AS VARCHAR) END || '/' || CAST(4 + l_orderkey % 3 + 4 * l_linenumber AS VARCHAR)
  FROM lineitem JOIN active ON o_orderkey = l_orderkey""")
def scan(spark, folder):
    root = timetable_folder(spark, folder, b.trips(spark, folder), messy=True)
    dated = read_dated_trips(spark, f"{root}/trips_dated_vehicle_journey.txt", b.MARCH)
    text = lambda c: F.col(c).cast("string")
    parts = [
        dated.select(F.lit("dated"), "trip_id", text("operating_day"), F.lit("")),
        read_trip_routes(spark, f"{root}/trips.txt", dated).select(F.lit("trip"), "trip_id", "route_id", text("direction_id")),
        read_route_names(spark, f"{root}/routes.txt").select(F.lit("route"), "route_id", "route_short_name", "route_long_name"),
        read_stop_times(spark, f"{root}/stop_times.txt", dated).select(
            F.lit("stop"), "trip_id", "arrival_time",
            F.concat(F.coalesce(text("stop_sequence"), F.lit("-")), F.lit("/"), leading_hour("arrival_time").cast("string")),
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.toDF("kind", "key", "a", "b")


@case("job_active_hours", f"WITH {b.SQL_MARCH_HOURS} SELECT * FROM route_hours")
def job_active_hours(spark, folder):
    root = timetable_folder(spark, folder, b.trips(spark, folder), messy=False)
    return timetable_route_hours(spark, root, b.MARCH)
