"""From a timetable to active route-hours."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.functions.clock import leading_hour

ROUTE_HOUR_COLUMNS = ["date", "hour", "route_id", "direction_id", "route_short_name", "route_long_name"]


def _with_rows(stops: DataFrame) -> DataFrame:
    return stops if "stop_row" in stops.columns else stops.withColumn("stop_row", F.lit(None).cast("bigint"))


def trip_bounds(stops: DataFrame) -> DataFrame:
    """First and last arrival of each trip by stop sequence; a trip with a blank one is dropped.

    A trip with a stop that has no number is read in the order of its lines (`stop_row`) instead.
    """
    both = {"number": F.struct("stop_sequence", "arrival_time"), "line": F.struct("stop_row", "arrival_time")}
    ends = _with_rows(stops).groupBy("trip_id").agg(
        (F.count("stop_sequence") == F.count("*")).alias("numbered"),
        *[f(row).alias(f"{name}_{by}") for by, row in both.items() for name, f in (("first", F.min), ("last", F.max))],
    )
    pick = lambda name: F.when(F.col("numbered"), F.col(f"{name}_number.arrival_time")).otherwise(F.col(f"{name}_line.arrival_time"))
    ends = ends.select("trip_id", pick("first").alias("first_arrival"), pick("last").alias("last_arrival"))
    return ends.where((F.col("first_arrival") != "") & (F.col("last_arrival") != ""))


def trip_hours(stops: DataFrame) -> DataFrame:
    """First and last hour of each trip, as `trip_bounds` followed by the hour.

    Stop sequence and hour packed in one whole number keep this a hash aggregation; structs and
    texts would make Spark sort every stop first. The low half is the hour, -2**31 for a blank.
    """
    blank = -(2**31)
    hour = F.when(F.col("arrival_time") != "", leading_hour("arrival_time")).otherwise(blank)
    packed = F.shiftleft(F.col("stop_sequence").cast("bigint"), 32) + (hour.cast("bigint") - F.lit(blank))
    ends = _with_rows(stops).select("trip_id", packed.alias("_stop"), hour.alias("_hour"), "stop_row").groupBy("trip_id").agg(
        F.min("_stop").alias("_first"), F.max("_stop").alias("_last"), (F.count("_stop") == F.count("*")).alias("_numbered"),
        F.min_by("_hour", "stop_row").alias("_first_line"), F.max_by("_hour", "stop_row").alias("_last_line"),
    )
    low = F.lit((1 << 32) - 1)
    first, last = (
        F.when(F.col("_numbered"), (F.col(c).bitwiseAND(low) + F.lit(blank)).cast("int")).otherwise(F.col(f"{c}_line"))
        for c in ("_first", "_last")
    )
    ends = ends.select("trip_id", first.alias("first_hour"), last.alias("last_hour"))
    return ends.where((F.col("first_hour") != blank) & (F.col("last_hour") != blank))


def _span(first: Column, last: Column) -> Column:
    """Bits first..last set, none when last precedes first."""
    one = F.lit(1).cast("bigint")
    bits = F.call_function("shiftleft", one, (last + 1).cast("int")) - F.call_function(
        "shiftleft", one, first.cast("int")
    )
    return F.when(first <= last, bits).otherwise(F.lit(0).cast("bigint"))


def _day_hours(first: Column, last: Column) -> Column:
    """Hours 0-23 of the operating day as bits; hours below 0 count as 0."""
    low = F.greatest(F.lit(0), F.least(first, F.lit(24)))
    high = F.least(F.lit(23), F.greatest(last, F.when(first <= last, 0).otherwise(-1)))
    return F.when(first <= last, _span(low, high)).otherwise(F.lit(0).cast("bigint"))


def _next_day_hours(first: Column, last: Column) -> Column:
    """Hours 24 and later as bits of the next day; hour 48 and later counts as its hour 23."""
    low = F.least(F.lit(23), F.greatest(F.lit(0), first - 24))
    high = F.least(F.lit(23), last - 24)
    return F.when((first <= last) & (last >= 24), _span(low, high)).otherwise(F.lit(0).cast("bigint"))


def active_route_hours(
    dated: DataFrame,
    stops: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    days: Iterable[str | date],
) -> DataFrame:
    """Distinct (date, hour, route, direction) in which a trip runs, with the route's names.

    `dated` is (trip_id, operating_day) on the wanted days; hours past midnight are kept only when
    the day they fall on is wanted too. Hours travel as 24-bit sets and are merged with bit_or, so
    a route's trips shrink to one row per day before the shuffle; rows per hour come last.
    """
    wanted = [date.fromisoformat(str(d)) for d in days]
    running = dated.join(trip_hours(stops), "trip_id").join(trips, "trip_id")
    first, last = F.col("first_hour"), F.col("last_hour")
    day_parts = F.array(
        F.struct(F.col("operating_day").alias("date"), _day_hours(first, last).alias("hours")),
        F.struct(F.date_add("operating_day", 1).alias("date"), _next_day_hours(first, last).alias("hours")),
    )
    parts = running.select("route_id", "direction_id", F.inline(day_parts))
    parts = parts.where((F.col("hours") != 0) & F.col("date").isin(wanted))
    sets = parts.groupBy("date", "route_id", "direction_id").agg(F.bit_or("hours").alias("hours"))
    named = with_route_names(sets, routes)
    each = F.filter(
        F.sequence(F.lit(0), F.lit(23)),
        lambda h: F.call_function("shiftright", F.col("hours"), h).bitwiseAND(F.lit(1)) == 1,
    )
    return named.withColumn("hour", F.explode(each)).select(
        F.col("date").cast("string").alias("date"), *ROUTE_HOUR_COLUMNS[1:]
    )


def with_route_names(rows: DataFrame, routes: DataFrame) -> DataFrame:
    """Add route names, blank for a route the timetable does not list."""
    names = ["route_short_name", "route_long_name"]
    joined = rows.join(routes.select("route_id", *names), "route_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in names})


def schedule_summary(route_hours: DataFrame) -> DataFrame:
    """One row per route: names and direction -> date -> sorted hours (A10).

    Each level groups what the level below has already gathered: at most 24 hours per date, the
    wanted dates per direction, the directions per route.
    """
    dates = route_hours.groupBy("route_id", "direction_id", "date").agg(
        F.min(F.struct("route_short_name", "route_long_name")).alias("names"),
        F.sort_array(F.collect_set("hour")).alias("hours"),
    )
    directions = dates.groupBy("route_id", "direction_id").agg(
        F.min("names").alias("names"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("date", "hours")))).alias("dates"),
    )
    return directions.groupBy("route_id").agg(
        F.min("names.route_short_name").alias("short_name"),
        F.min("names.route_long_name").alias("long_name"),
        F.map_from_entries(F.collect_list(F.struct("direction_id", "dates"))).alias("directions"),
    )
