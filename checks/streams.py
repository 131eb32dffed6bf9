"""Streams whose hours close, and streams that resolve routes by the month's trip map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import bindings as b
from checks.registry import case
from seatflow.functions.clock import month_tag, utc_clock
from seatflow.operators.occupancy import hourly_occupancy, resolve_routes
from seatflow.runtime import fresh_path
from seatflow.streaming.hourly import append_hours, closed_hours, read_hours, upsert_resolved

#: Days of sightings that arrive together, and how much later than the latest one a sighting may be.
SPAN, LATENESS = 4, "1 day"
DAY = 86400


def _arrivals(spark, folder) -> str:
    """Some files per span of days, in order: its sightings, repeats of them, repeats from the span before, and
    sightings of three spans before that come too late. One pass deals the sightings out to the spans."""
    seen = b.sightings(spark, folder).withColumn("span", F.floor(F.datediff(F.timestamp_seconds("ts"), F.lit("2024-01-01").cast("date")) / SPAN))
    repeated = seen.where("event_id % 5 = 0")
    late = seen.where("event_id % 7 = 0").withColumns({"event_id": F.col("event_id") + 10**9, "span": F.col("span") + 3})
    arriving = seen.unionByName(repeated).unionByName(repeated.withColumn("span", F.col("span") + 1)).unionByName(late)
    last = seen.agg(F.max("span")).first()[0]
    path, dealt = fresh_path(spark, "arrivals"), fresh_path(spark, "dealt")
    arriving.where(F.col("span").between(0, last)).write.partitionBy("span").parquet(dealt)
    dealt = spark.read.schema(arriving.schema).parquet(dealt)
    sizes = {r.span: r.n for r in dealt.groupBy("span").agg(F.count("*").alias("n")).collect()}  # a row per span
    for span in range(last + 1):
        _land(dealt.where(F.col("span") == span).drop("span"), sizes.get(span, 0), path, _files(spark))
    return path


def _files(spark) -> int:
    """Files of a span, which a micro-batch reads together."""
    return spark.sparkContext.defaultParallelism


def _land(rows: DataFrame, n: int, path: str, files: int) -> None:
    """Append the `n` rows as exactly `files` files, whatever their number: round-robin gives every file a row of a partition with
    as many, which one of 64 has; fewer rows are one file, and the others are empty."""
    many = n >= 64 * files
    rows = rows.coalesce(64).repartition(files) if many else rows.coalesce(1)
    rows.write.mode("append").parquet(path)
    for _ in range(0 if many else files - 1):
        rows.where(F.lit(False)).write.mode("append").parquet(path)


def _one_by_one(spark, path: str, files: int = 1) -> DataFrame:
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)


@case("stream_closed_hours", f"""WITH {b.SQL_OBS},
told AS (SELECT * FROM obs WHERE occupancy <> 'NO_DATA_AVAILABLE'),
closed AS (SELECT * FROM told WHERE ts - ts % 3600 + 3600 <= (SELECT max(ts) FROM told) - {DAY}),
{b.sql_hourly('closed')} SELECT {b.HOURLY_NAMES} FROM hourly""")
def stream_closed_hours(spark, folder):
    """Only hours that the watermark has passed; repeats and late sightings do not count."""
    path = fresh_path(spark, "closed")
    counts = closed_hours(_one_by_one(spark, _arrivals(spark, folder), _files(spark)), LATENESS, key=["event_id", "ts"])
    append_hours(counts, path, fresh_path(spark, "checkpoint"), available_now=True).awaitTermination()
    return b.with_text_date(read_hours(spark, path))


SQL_TWO_MONTHS = f"""{b.SQL_OBS},
moved AS (SELECT ts + (event_id % 2) * 31 * {DAY} AS ts, occupancy, trip_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE route_id END AS route_id FROM obs),
maps AS (
  SELECT '2024-01' AS month, CAST(o_orderkey AS VARCHAR) AS trip, o_custkey % 25 AS route, o_orderkey % 2 AS direction
  FROM orders WHERE o_orderkey % 5 <> 0
  UNION ALL SELECT '2024-02', CAST(o_orderkey AS VARCHAR), (o_custkey + 7) % 25, (o_orderkey + 1) % 2 FROM orders WHERE o_orderkey % 4 <> 0),
resolved AS (
  SELECT timezone('Europe/Stockholm', timezone('UTC', make_timestamp(ts * 1000000))) AS local_ts, occupancy,
    CASE WHEN route_id <> '' THEN route_id ELSE CAST(route AS VARCHAR) END AS route_id, coalesce(direction, 0) AS direction_id
  FROM moved LEFT JOIN maps ON trip = trip_id AND month = strftime(make_timestamp(ts * 1000000), '%Y-%m')
  WHERE route_id <> '' OR trip IS NOT NULL),
{b.sql_hourly('resolved')}"""


def _two_months(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Sightings of two months, some without a route, and a trip map per month that differ in routes and trips."""
    event = F.col("event_id")
    seen = b.sightings(spark, folder).drop("direction_id").withColumns({
        "ts": F.col("ts") + (event % 2) * 31 * DAY, "route_id": F.when(event % 3 == 0, "").otherwise(F.col("route_id"))})
    key = F.col("trip_id").cast("bigint")
    trips = b.trips(spark, folder).select("trip_id", "route_id", "direction_id")
    second = b.table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("trip_id"), ((F.col("o_custkey") + 7) % 25).cast("string").alias("route_id"),
        ((F.col("o_orderkey") + 1) % 2).cast("int").alias("direction_id"))
    maps = trips.where(key % 5 != 0).withColumn("month", F.lit("2024-01")).unionByName(
        second.where(key % 4 != 0).withColumn("month", F.lit("2024-02")))
    return seen, maps


@case("hourly_two_months", f"WITH {SQL_TWO_MONTHS} SELECT {b.HOURLY_NAMES} FROM hourly")
def hourly_two_months(spark, folder):
    seen, maps = _two_months(spark, folder)
    seen = seen.withColumn("month", month_tag(F.to_date(utc_clock("ts"))))
    return b.with_text_date(hourly_occupancy(resolve_routes(seen, maps)))


@case("stream_two_months", f"WITH {SQL_TWO_MONTHS} SELECT {b.HOURLY_NAMES} FROM hourly")
def stream_two_months(spark, folder):
    """The second month's map comes only after the stream has counted the first month."""
    seen, maps = _two_months(spark, folder)
    feed, trips, path, checkpoint = (fresh_path(spark, name) for name in ("feed", "trips", "hour_counts", "checkpoint"))
    for month in ("2024-01", "2024-02"):
        maps.where(F.col("month") == month).write.mode("append").parquet(trips)
        rows = seen.where((month_tag(F.to_date(utc_clock("ts"))) == "2024-01") == (month == "2024-01"))
        rows.repartition(2).write.mode("append").parquet(feed)
        upsert_resolved(_one_by_one(spark, feed), trips, path, checkpoint, available_now=True).awaitTermination()
    return b.with_text_date(read_hours(spark, path))
