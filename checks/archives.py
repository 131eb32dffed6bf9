"""Snapshot archives read by the data source, and stored comments."""

from __future__ import annotations

from datetime import date, datetime, timezone

import pandas as pd
from pyarrow import fs
from pyspark.sql import functions as F

from checks import bindings as b
from checks.registry import case, memo
from seatflow.plans.ingest import archive_reader, hours_of_dates
from seatflow.runtime import fresh_path
from seatflow.schemas import CALENDAR
from seatflow.sinks.tables import upsert
from seatflow.sources.archive import archived_names, archived_snapshots
from seatflow.sources.snapshots import feed_message, snapshots_by_hour

FIRST, LAST, DAMAGED = date(2024, 1, 5), date(2024, 1, 20), date(2024, 1, 10)
FILES, PICKED = 6, 4
_ROOTS: dict[tuple, str] = memo()


def _feed(rows: pd.DataFrame, header: int) -> bytes:
    feed = feed_message()()
    feed.header.timestamp = header
    for number, row in enumerate(rows.itertuples()):
        entity = feed.entity.add(id=str(number))
        if row.has_vehicle:
            entity.vehicle.trip.trip_id, entity.vehicle.trip.route_id = row.trip_id, row.route_id
            if not pd.isna(row.vehicle_ts):
                entity.vehicle.timestamp = int(row.vehicle_ts)
            if not pd.isna(row.occupancy_status):
                entity.vehicle.occupancy_status = int(row.occupancy_status)
    return feed.SerializeToString()


def archive_root(spark, folder) -> str:
    """The events as snapshot files of several entities each, six an hour, every third without a time of its own; one is damaged."""
    key = (spark.sparkContext.applicationId, folder)
    if key in _ROOTS:
        return _ROOTS[key]
    root = fresh_path(spark, "archive")

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        path = rows["file"].iloc[0]
        year, month, day, hour, name = path.split("/")
        start = int(datetime(int(year), int(month), int(day), int(hour), tzinfo=timezone.utc).timestamp())
        whole = not name.startswith("zz")
        store, top = fs.FileSystem.from_uri(root)
        store.create_dir(f"{top}/{year}/{month}/{day}/{hour}", recursive=True)
        with store.open_output_stream(f"{top}/{path}") as out:
            out.write(_feed(rows, start if whole and int(name[:2]) % 3 else 0) if whole else b"\xff\xff damaged")
        return pd.DataFrame({"file": [path]})

    rows = b.vehicles(spark, folder)
    number = F.regexp_extract("path", r"(\d+)\.pb$", 1).cast("bigint") % FILES
    hour = F.regexp_extract("path", r"(\d{4}/\d\d/\d\d/\d\d)/", 1)
    rows = rows.withColumn("file", F.concat(hour, F.lit("/"), F.lpad(number.cast("string"), 2, "0"), F.lit(".pb")))
    broken = rows.limit(1).withColumn("file", F.lit(f"{DAMAGED:%Y/%m/%d}/05/zz.pb"))
    rows.unionByName(broken).groupBy("file").applyInPandas(write, "file string").write.format("noop").mode("overwrite").save()
    _ROOTS[key] = root
    return root


@case("archive_listing", f"""
SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour,
  count(DISTINCT event_id % {FILES}) + CASE WHEN CAST(ts AS DATE) = DATE '{DAMAGED}' AND hour(ts) = 5 THEN 1 ELSE 0 END AS n_files
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY CAST(ts AS DATE), 1, hour(ts)""")
def archive_listing(spark, folder):
    names = archived_names(spark, archive_root(spark, folder), FIRST, LAST)
    return b.with_text_date(snapshots_by_hour(names))


SQL_ARCHIVE = f"""{b.SQL_OBS},
files AS (SELECT DISTINCT date_trunc('hour', utc) AS h, event_id % {FILES} AS n FROM obs),
placed AS (SELECT h, n, row_number() OVER (PARTITION BY h ORDER BY n) - 1 AS place, count(*) OVER (PARTITION BY h) AS total FROM files),
picked AS (SELECT DISTINCT total, CAST(round_even(i * (total - 1) / ({PICKED} - 1.0)::DOUBLE, 0) AS BIGINT) AS place
  FROM (SELECT DISTINCT total FROM placed), range({PICKED}) AS r(i)),
chosen AS (SELECT h, n FROM placed WHERE total <= {PICKED} OR (total, place) IN (SELECT (total, place) FROM picked)),
usable AS (
  SELECT event_id, '' AS path, utc, CASE WHEN event_id % 7 <> 0 THEN ts ELSE epoch_us(h) // 1000000 END AS ts, occupancy, trip_id,
    CASE WHEN event_id % 3 = 0 THEN '' ELSE route_id END AS route_id
  FROM obs JOIN chosen ON h = date_trunc('hour', utc) AND n = event_id % {FILES}
  WHERE event_id % 17 <> 0 AND event_id % 11 <> 0 AND occupancy <> 'NO_DATA_AVAILABLE'
    AND NOT (event_id % 7 = 0 AND event_id % {FILES} % 3 = 0)
    AND CAST(utc AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}' AND CAST(utc AS DATE) <> DATE '{DAMAGED}'),
{b.SQL_RESOLVED}, {b.sql_hourly('resolved', where='CAST(local_ts AS DATE) = CAST(utc AS DATE)')}"""


def _decoded(spark, folder):
    root = archive_root(spark, folder)
    names = archived_names(spark, root, FIRST, LAST)
    files = archived_snapshots(spark, root, FIRST, LAST, PICKED)
    days = names.select("date").distinct()
    return hours_of_dates(names, archive_reader(files), b.trip_map(spark, folder), days, PICKED)


@case("archive_hours", f"WITH {SQL_ARCHIVE} SELECT {b.HOURLY_NAMES} FROM hourly")
def archive_hours(spark, folder):
    """From files through listing, sampling and decoding to hours; the day of the damaged file is left out."""
    return b.with_text_date(_decoded(spark, folder)[0].select(*[c.strip() for c in b.HOURLY_NAMES.split(",")]))


@case("archive_failures", f"SELECT '{DAMAGED}' AS date, 'decode' AS stage")
def archive_failures(spark, folder):
    return _decoded(spark, folder)[1].select("date", "stage")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@case("table_comments", "SELECT * FROM (VALUES " + ", ".join(f"({_quoted(c)}, {_quoted(t)})" for c, t in CALENDAR.comments.items()) + ") AS t(name, comment)")
def table_comments(spark, folder):
    """Comments of a feature table, read back from its files."""
    path = fresh_path(spark, "calendar")
    upsert(b.typed_calendar(spark, folder), CALENDAR, path)
    found = [(f.name, f.metadata["comment"]) for f in spark.read.parquet(path).schema.fields if "comment" in f.metadata]
    return spark.createDataFrame(found, "name string, comment string")
