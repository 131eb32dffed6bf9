"""Ingestion: sightings, sampling, hourly occupancy."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.registry import case
from seatflow.operators.occupancy import (
    counts_agree,
    coverage,
    date_range,
    distinct_dates,
    hourly_from_trips,
    local_hours,
    resolve_routes,
    usable_sightings,
    wrong_counts,
)
from seatflow.operators.ordering import evenly_spaced, example_row, keep_last, preview
from seatflow.schemas import SEED
from seatflow.sources.snapshots import decode_snapshots, path_date, snapshots_by_hour, with_path_clock


@case("hourly_occupancy", f"WITH {b.SQL_HOURLY} SELECT {b.HOURLY_NAMES} FROM hourly")
def hourly_occupancy(spark, folder):
    return b.hourly(spark, folder)


@case("occupancy_typed", f"WITH {b.SQL_HOURLY} SELECT {b.sql_typed()} FROM hourly")
def occupancy_typed(spark, folder):
    return b.with_text_time(b.typed_hourly(spark, folder))


SQL_SAMPLE = """
placed AS (
  SELECT *, row_number() OVER (PARTITION BY date_trunc('hour', utc) ORDER BY event_id) - 1 AS place,
    count(*) OVER (PARTITION BY date_trunc('hour', utc)) AS n FROM {source}),
picked AS (
  SELECT DISTINCT n, CAST(round_even(i * (n - 1) / ({k} - 1.0)::DOUBLE, 0) AS BIGINT) AS place
  FROM (SELECT DISTINCT n FROM placed), range({k}) AS r(i)),
sampled AS (SELECT p.* FROM placed p WHERE n <= {k} OR (n, place) IN (SELECT (n, place) FROM picked))"""


@case("snapshot_sample", f"""WITH {b.SQL_OBS}, {SQL_SAMPLE.format(source='obs', k=5)}
SELECT event_id, strftime(utc, '%Y-%m-%d') AS date, CAST(hour(utc) AS INTEGER) AS hour FROM sampled""")
def snapshot_sample(spark, folder):
    files = with_path_clock(b.snapshot_paths(spark, folder))
    return b.with_text_date(evenly_spaced(files, k=5)).select("event_id", "date", "hour")


@case("snapshot_listing", """
SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_files
FROM events GROUP BY 1, 2""")
def snapshot_listing(spark, folder):
    return b.with_text_date(snapshots_by_hour(with_path_clock(b.snapshot_paths(spark, folder))))


@case("vehicle_filters", f"WITH {b.SQL_VEHICLES} SELECT path, ts, occupancy, trip_id, route_id FROM usable")
def vehicle_filters(spark, folder):
    return usable_sightings(b.vehicles(spark, folder)).select("path", "ts", "occupancy", "trip_id", "route_id")


@case("snapshot_decode", f"WITH {b.SQL_VEHICLES} SELECT path, ts, occupancy, trip_id, route_id FROM usable")
def snapshot_decode(spark, folder):
    decoded = decode_snapshots(b.encoded_snapshots(spark, folder))
    return usable_sightings(decoded).select("path", "ts", "occupancy", "trip_id", "route_id")


@case("trip_route_resolution", f"""WITH {b.SQL_VEHICLES}, {b.SQL_RESOLVED}
SELECT path, ts, occupancy, route_id, CAST(direction_id AS INTEGER) AS direction_id FROM resolved""")
def trip_route_resolution(spark, folder):
    seen = usable_sightings(b.vehicles(spark, folder)).withColumn("month", F.date_format(path_date("path"), "yyyy-MM"))
    resolved = resolve_routes(seen, b.trip_map(spark, folder))
    return resolved.select("path", "ts", "occupancy", "route_id", "direction_id")


@case("hourly_from_trips", f"""WITH {b.SQL_VEHICLES}, {b.SQL_RESOLVED},
{b.sql_hourly('resolved', where="CAST(local_ts AS DATE) = CAST(utc AS DATE)")} SELECT {b.HOURLY_NAMES} FROM hourly""")
def resolved_hourly(spark, folder):
    seen = usable_sightings(b.vehicles(spark, folder)).withColumn("archive_date", path_date("path"))
    return b.with_text_date(hourly_from_trips(seen, b.trip_map(spark, folder)))


@case("dedup_keep_last", """
WITH twice AS (SELECT 0 AS file_seq, * FROM events UNION ALL
  SELECT 1, * REPLACE (value + 1 AS value) FROM events WHERE event_id % 2 = 0)
SELECT user_id, event_type, event_id, value, file_seq FROM twice
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY file_seq DESC, event_id DESC) = 1""")
def dedup_keep_last(spark, folder):
    events = b.table(spark, folder, "events").select("user_id", "event_type", "event_id", "value")
    again = events.where("event_id % 2 = 0").withColumns({"value": F.col("value") + 1, "file_seq": F.lit(1)})
    twice = events.withColumn("file_seq", F.lit(0)).unionByName(again)
    return keep_last(twice, ["user_id", "event_type"], ["file_seq", "event_id"])


@case("existing_dates", f"WITH {b.SQL_OBS} SELECT DISTINCT CAST(CAST(local_ts AS DATE) AS VARCHAR) AS date FROM obs")
def existing_dates(spark, folder):
    return distinct_dates(local_hours(b.sightings(spark, folder)))


def _altered(spark, folder):
    odd = (F.col("route_id") == "3") & (F.col("hour") == 5)
    return b.hourly(spark, folder).withColumn("n_obs", F.col("n_obs") + F.when(odd, 1).otherwise(0))


@case("count_validation", f"""WITH {b.SQL_HOURLY}
SELECT 'as built' AS rows_checked, true AS valid, CAST(0 AS BIGINT) AS n_wrong
UNION ALL SELECT 'altered', count(*) FILTER (route_id = '3' AND hour = 5) = 0,
  count(*) FILTER (route_id = '3' AND hour = 5) FROM hourly""")
def count_validation(spark, folder):
    rows = {"as built": b.hourly(spark, folder), "altered": _altered(spark, folder)}
    reports = [counts_agree(df).withColumn("rows_checked", F.lit(name)) for name, df in rows.items()]
    return reports[0].unionByName(reports[1])


@case("wrong_count_rows", f"""WITH {b.SQL_HOURLY} SELECT date, hour, route_id, direction_id, n_obs + 1 AS n_obs
FROM hourly WHERE route_id = '3' AND hour = 5""")
def wrong_count_rows(spark, folder):
    return wrong_counts(_altered(spark, folder)).select("date", "hour", "route_id", "direction_id", "n_obs")


@case("coverage_stats", f"""WITH {b.SQL_OBS}, days AS (SELECT *, CAST(CAST(local_ts AS DATE) AS VARCHAR) AS date FROM obs)
SELECT 'n_routes' AS stat, CAST(count(DISTINCT route_id) AS VARCHAR) AS value FROM days
UNION ALL SELECT 'n_pairs', CAST(count(DISTINCT (route_id, direction_id)) AS VARCHAR) FROM days
UNION ALL SELECT 'first_date', min(date) FROM days UNION ALL SELECT 'last_date', max(date) FROM days""")
def coverage_stats(spark, folder):
    rows = local_hours(b.sightings(spark, folder))
    stats = [coverage(rows), date_range(rows)]
    long = [
        df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("stat"), F.col(c).cast("string").alias("value")) for c in df.columns
        ]))) for df in stats
    ]
    return long[0].unionByName(long[1])


@case("ordered_preview", f"""WITH {b.SQL_HOURLY}
SELECT date, hour, route_id, direction_id, n_obs, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (ORDER BY date, hour, route_id, direction_id) AS place FROM hourly) WHERE place <= 20""")
def ordered_preview(spark, folder):
    rows = preview(b.hourly(spark, folder), ["date", "hour", "route_id", "direction_id"])
    return rows.select("date", "hour", "route_id", "direction_id", "n_obs", "place")


@case("input_example", f"""WITH {b.SQL_HOURLY} SELECT {b.HOURLY_NAMES} FROM hourly
ORDER BY md5(concat_ws('|', date, hour, route_id, direction_id, {SEED})), date, hour, route_id, direction_id LIMIT 1""")
def input_example(spark, folder):
    return b.with_text_date(example_row(b.hourly(spark, folder), ["date", "hour", "route_id", "direction_id"]))
