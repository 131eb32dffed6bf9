"""From scored rows to published documents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatflow.functions.clock import day_label
from seatflow.functions.scores import display_bucket, display_class, display_mean
from seatflow.operators.joins import first_wins
from seatflow.operators.ordering import keep_first

DAY_KEY = ["route_id", "direction_id", "date"]
CELL_COLUMNS = [*DAY_KEY, "hour", "type", "pred_avg", "pred_max", "actual_avg", "actual_max"]


def past_cells(scored: DataFrame) -> DataFrame:
    """Observed hours with predictions and actual values."""
    return scored.select(
        F.col("route_id").cast("string").alias("route_id"), F.col("direction_id").cast("int").alias("direction_id"),
        F.col("date").cast("string").alias("date"), F.col("hour").cast("int").alias("hour"),
        F.lit("past").alias("type"),
        F.col("pred_avg").cast("double").alias("pred_avg"), F.col("pred_max").cast("int").alias("pred_max"),
        F.col("avg_occupancy").cast("double").alias("actual_avg"),
        F.col("max_occupancy").cast("int").alias("actual_max"),
    )


def future_cells(scored: DataFrame) -> DataFrame:
    """Scheduled hours with predictions only."""
    empty = scored.withColumns({
        "avg_occupancy": F.lit(None).cast("double"), "max_occupancy": F.lit(None).cast("int")
    })
    return past_cells(empty).withColumn("type", F.lit("future"))


def merge_cells(past: DataFrame, future: DataFrame) -> DataFrame:
    """Routes with a past, all their directions; a future day replaces the whole past day."""
    kept = past.join(future.select(*DAY_KEY).distinct(), DAY_KEY, "left_anti")
    coming = future.join(past.select("route_id").distinct(), "route_id", "left_semi")
    return kept.select(*CELL_COLUMNS).unionByName(coming.select(*CELL_COLUMNS))


def names_from_schedule(known: DataFrame | None, route_hours: DataFrame) -> DataFrame:
    """(route_id, short_name, long_name): known names stay, the schedule adds the others."""
    fresh = route_hours.select(
        F.col("route_id").cast("string").alias("route_id"),
        F.col("route_short_name").alias("short_name"), F.col("route_long_name").alias("long_name"),
    )
    fresh = keep_first(fresh, ["route_id"], ["short_name", "long_name"])
    return fresh if known is None else first_wins(known, fresh, ["route_id"])


def route_documents(cells: DataFrame, names: DataFrame) -> DataFrame:
    """(route_id, document), document = {short_name, long_name, directions{days{type, hours}}}.

    A future hour has the two predictions only, a past hour the actual values too, so an hour is
    a VARIANT. Each grouping collects what the one below has gathered: hours of a day, published
    days of a direction, directions of a route.
    """
    whole = ["pred_avg", "pred_max", "actual_avg", "actual_max"]
    texts = [F.to_json(F.struct(*c), {"ignoreNullFields": "false"}) for c in (whole, whole[:2])]
    cell = F.parse_json(F.when(F.col("type") == "past", texts[0]).otherwise(texts[1]))
    days = cells.groupBy(*DAY_KEY, "type").agg(
        F.array_sort(F.collect_list(F.struct("hour", cell.alias("cell"))), lambda a, b: a["hour"] - b["hour"]).alias("hours")
    )
    day = F.struct("type", _as_map("hours", "hour", "cell").alias("hours"))
    directions = days.groupBy("route_id", "direction_id").agg(
        F.array_sort(
            F.collect_list(F.struct("date", day.alias("day"))),
            lambda a, b: F.when(a["date"] < b["date"], -1).when(a["date"] > b["date"], 1).otherwise(0),
        ).alias("days")
    )
    direction = F.struct(_as_map("days", "date", "day").alias("days"))
    routes = directions.groupBy("route_id").agg(
        F.array_sort(
            F.collect_list(F.struct("direction_id", direction.alias("direction"))),
            lambda a, b: a["direction_id"] - b["direction_id"],
        ).alias("directions")
    )
    named = routes.join(names.select("route_id", "short_name", "long_name"), "route_id", "left")
    return named.select(
        "route_id",
        F.struct(
            F.coalesce("short_name", F.lit("")).alias("short_name"),
            F.coalesce("long_name", F.lit("")).alias("long_name"),
            _as_map("directions", "direction_id", "direction").alias("directions"),
        ).alias("document"),
    )


def _as_map(entries: str, key: str, value: str):
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e[key].cast("string"), e[value])))


def publish_stats(cells: DataFrame) -> DataFrame:
    """Routes and hour cells published."""
    routes = cells.groupBy("route_id").agg(F.count("*").alias("n"))
    return routes.agg(F.count("*").alias("routes"), F.coalesce(F.sum("n"), F.lit(0)).alias("predictions"))


def serving_rows(cells: DataFrame, today: str | date) -> DataFrame:
    """Display rows of each route and direction in date and hour order.

    `is_default_day` marks today when the direction has it, else its first day. A direction's
    group is its published days, seven by default.
    """
    direction = Window.partitionBy("route_id", "direction_id")
    label = day_label(F.col("date"), today)
    current = F.max(F.when(label == "today", F.col("date"))).over(direction)
    default = F.coalesce(current, F.min("date").over(direction))
    return cells.select(
        *DAY_KEY, "hour", "type",
        label.alias("day_label"),
        (F.col("date") == default).alias("is_default_day"),
        F.row_number().over(direction.orderBy("date", "hour")).alias("place"),
        F.format_string("%02d:00", "hour").alias("hour_text"),
        display_mean(F.col("pred_avg")).alias("pred_avg_text"),
        display_class(F.col("pred_max")).alias("pred_max_text"),
        display_bucket(F.col("pred_avg")).alias("pred_avg_step"),
        F.when(F.col("type") == "past", display_mean(F.col("actual_avg"))).alias("actual_avg_text"),
        F.when(F.col("type") == "past", display_class(F.col("actual_max"))).alias("actual_max_text"),
    )


def serving_view(cells: DataFrame, route_id: str, direction_id: int, today: str | date) -> DataFrame:
    """The display rows of one route and direction."""
    chosen = cells.where((F.col("route_id") == route_id) & (F.col("direction_id") == direction_id))
    return serving_rows(chosen, today).orderBy("date", "hour")
