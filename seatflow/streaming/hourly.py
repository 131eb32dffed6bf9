"""Hourly occupancy from a stream of sightings.

The state is six counts per UTC hour, route and direction. Mean, maximum and mode, and the local
hour, are worked out when the counts are read: the two UTC hours that share one local hour in
autumn then add up instead of replacing each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seatflow.functions.clock import local_clock, month_tag, utc_clock
from seatflow.operators.occupancy import HOURLY_KEY, merge_counts, resolve_routes, status_counts, summarise
from seatflow.schemas import (
    COUNT_COLUMNS,
    LOCAL_ZONE,
    LOOKBACK_DAYS,
    SCORED_STATUSES,
    TRAFFIC_COLUMNS,
    FeatureTable,
    record,
)
from seatflow.sinks.tables import read_table, upsert

HOUR_COUNTS = FeatureTable(
    name="hour_counts",
    schema=record(
        ("text", "utc_date"), ("big", "utc_hour"), ("text", "route_id"), ("int", "direction_id"), ("text", "run"),
        ("big", " ".join(COUNT_COLUMNS)),
    ),
    key=["utc_date", "utc_hour", "route_id", "direction_id", "run"],
    partition="utc_date",
)


def hourly_counts(sightings: DataFrame, lateness: str = f"{LOOKBACK_DAYS} days") -> DataFrame:
    """Counts per UTC hour, route and direction; sightings later than `lateness` are dropped.

    `ts` is epoch seconds. Works on a stream and on a batch.
    """
    return _windowed(_timed(sightings, lateness))


def closed_hours(sightings: DataFrame, lateness: str, key: Sequence[str] = ("trip_id", "ts")) -> DataFrame:
    """The same counts for hours that are over, each once (Z1): an hour closes when the latest sighting is `lateness` past its end.

    A sighting that repeats an earlier one's `key` within `lateness`, or comes later than that, does not count. Both the keys and the
    open hours leave the state as the watermark moves, so the state holds no more than `lateness` and an hour.
    """
    return _windowed(_timed(sightings, lateness).dropDuplicatesWithinWatermark(list(key)))


def _timed(sightings: DataFrame, lateness: str) -> DataFrame:
    timed = sightings.where(F.col("occupancy").isin(SCORED_STATUSES)).withColumn("_at", F.timestamp_seconds("ts"))
    return timed.withWatermark("_at", lateness)


def _windowed(timed: DataFrame) -> DataFrame:
    counts = timed.groupBy(F.window("_at", "1 hour"), "route_id", "direction_id").agg(*status_counts())
    hour = F.unix_seconds("window.start")
    return counts.select(
        F.to_date(utc_clock(hour)).cast("string").alias("utc_date"), hour.alias("utc_hour"),
        "route_id", F.col("direction_id").cast("int").alias("direction_id"), *COUNT_COLUMNS,
    )


def upsert_counts(
    counts: DataFrame, path: str, checkpoint: str, available_now: bool = False, run: str | None = None
) -> StreamingQuery:
    """Write changed hours to the counts table; replaying a batch changes nothing.

    What a stream has counted is kept under its `run`, by default its checkpoint, and reading adds the
    runs up. So a stream with a new checkpoint over new files adds to what is there. It must not read
    files again that another run has read.
    """
    writer = counts.withColumn("run", F.lit(run or checkpoint)).writeStream.outputMode("update")
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda batch, _: upsert(batch, HOUR_COUNTS, path))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append_hours(counts: DataFrame, path: str, checkpoint: str, available_now: bool = False, run: str | None = None) -> StreamingQuery:
    """Append hours that are closed to a counts table; none is written twice."""
    writer = counts.withColumn("run", F.lit(run or checkpoint)).writeStream.outputMode("append").format("parquet")
    writer = writer.option("checkpointLocation", checkpoint).partitionBy(HOUR_COUNTS.partition)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def upsert_resolved(
    sightings: DataFrame, trips_path: str, path: str, checkpoint: str, available_now: bool = False, run: str | None = None
) -> StreamingQuery:
    """Resolve the routes of a stream of sightings by the trip map of their month, and add their counts.

    The maps (month, trip_id, route_id, direction_id) are read anew for each micro-batch, so a month's map may come while the stream
    runs. What a micro-batch counts is kept under its own number, so replaying it changes nothing, and no state is kept.
    """
    run = run or checkpoint

    def write(batch: DataFrame, number: int) -> None:
        trips = batch.sparkSession.read.parquet(trips_path)
        timed = batch.withColumn("month", month_tag(F.to_date(utc_clock("ts"))))
        counts = hourly_counts(resolve_routes(timed, trips))
        upsert(counts.withColumn("run", F.lit(f"{run}/{number}")), HOUR_COUNTS, path)

    writer = sightings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_hours(spark: SparkSession, path: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """The hourly traffic rows of a counts table, all runs together, by local hour."""
    counts = read_table(spark, HOUR_COUNTS, path)
    clock = local_clock(utc_clock("utc_hour"), zone)
    local = counts.withColumns({"date": F.to_date(clock), "hour": F.hour(clock)})
    return summarise(merge_counts(local, HOURLY_KEY)).select(*TRAFFIC_COLUMNS)
