"""Publishing, sinks, jobs and streams."""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import bindings as b
from checks.features import PAST_NAMES, SQL_FEATURES
from checks.models import SQL_PREDICTED, one_split_models
from checks.occupancy import SQL_SAMPLE
from checks.registry import case, memo
from checks.timetable import route_hours
from seatflow.functions.scores import mean_prediction
from seatflow.operators.joins import feature_view, missing_dates
from seatflow.operators.publish import (
    CELL_COLUMNS,
    merge_cells,
    names_from_schedule,
    publish_stats,
    route_documents,
    serving_rows,
)
from seatflow.plans.ingest import (
    TRAFFIC_SKETCHES,
    Buckets,
    Warehouse,
    archive_reader,
    backfill,
    bucket_tables,
    daily_features,
    decode_history,
    existing_dates,
    export_past,
    insert,
    refresh_sketches,
    with_line,
)
from seatflow.operators.quality import QualityError, require_counts
from seatflow.operators.sketches import distinct_error, rank_error, span_summary
from seatflow.plans.scoring import publish, score_future, score_past
from seatflow.plans.training import make_split, train
from seatflow.runtime import fresh_path, stored
from seatflow.schemas import CALENDAR, TRAFFIC, TUNE_TRIALS, WEATHER, WEATHER_FEATURES
from seatflow.sinks.reports import append_failures, save_dashboard, save_dates
from seatflow.sinks.tables import cluster_days, save_hourly, upsert
from seatflow.sources.snapshots import landed, with_path_clock
from seatflow.sources.tables import (
    feature_table,
    has_rows,
    past_export,
    parquet_files,
    split_frames,
    traffic_parquets,
)
from seatflow.streaming.hourly import hourly_counts, read_hours, upsert_counts

# --- publishing -------------------------------------------------------------------------------


def _cells(rows: DataFrame, kind: str) -> DataFrame:
    known = kind == "past"
    return rows.select(
        "route_id", "direction_id", "date", "hour", F.lit(kind).alias("type"),
        mean_prediction(F.col("avg_occupancy")).alias("pred_avg"),
        F.col("max_occupancy").cast("int").alias("pred_max"),
        (F.col("avg_occupancy") if known else F.lit(None)).cast("double").alias("actual_avg"),
        (F.col("max_occupancy") if known else F.lit(None)).cast("int").alias("actual_max"),
    )


def cells(spark, folder) -> DataFrame:
    """Hours up to 20 January as past, from 19 January as future; a route missing on either side."""
    rows = b.hourly(spark, folder)
    past = rows.where("date <= '2024-01-20' and route_id <> '3'")
    future = rows.where("date >= '2024-01-19' and route_id <> '5'")
    return merge_cells(_cells(past, "past"), _cells(future, "future"))


SQL_CELLS = f"""{b.SQL_HOURLY},
past AS (SELECT * FROM hourly WHERE date <= '2024-01-20' AND route_id <> '3'),
fut AS (SELECT * FROM hourly WHERE date >= '2024-01-19' AND route_id <> '5'),
cells AS (
  SELECT route_id, CAST(direction_id AS INTEGER) AS direction_id, date, CAST(hour AS INTEGER) AS hour, 'past' AS type,
    round_even(avg_occupancy * 100, 0) / 100 AS pred_avg, CAST(max_occupancy AS INTEGER) AS pred_max,
    avg_occupancy AS actual_avg, CAST(max_occupancy AS INTEGER) AS actual_max
  FROM past p WHERE NOT EXISTS (SELECT 1 FROM fut f WHERE f.route_id = p.route_id AND f.direction_id = p.direction_id AND f.date = p.date)
  UNION ALL SELECT route_id, CAST(direction_id AS INTEGER), date, CAST(hour AS INTEGER), 'future',
    round_even(avg_occupancy * 100, 0) / 100, CAST(max_occupancy AS INTEGER), NULL, NULL
  FROM fut WHERE route_id IN (SELECT route_id FROM past))"""


@case("merge_past_future", f"WITH {SQL_CELLS} SELECT {', '.join(CELL_COLUMNS)} FROM cells")
def merge_past_future(spark, folder):
    return cells(spark, folder)


@case("run_stats", f"WITH {SQL_CELLS} SELECT count(DISTINCT route_id) AS routes, count(*) AS predictions FROM cells")
def run_stats(spark, folder):
    return publish_stats(cells(spark, folder))


def _names(spark, folder) -> DataFrame:
    return names_from_schedule(None, b.routes(spark, folder))


DOCUMENT = """struct<short_name string, long_name string, directions map<string, struct<days map<string,
struct<type string, hours map<string, struct<pred_avg double, pred_max int, actual_avg double, actual_max int>>>>>>>"""


def flat_documents(documents: DataFrame) -> DataFrame:
    """Documents read back from their JSON text, one row per hour cell."""
    text = F.to_json("document", {"ignoreNullFields": "false"})
    rows = documents.select("route_id", F.from_json(text, DOCUMENT.replace("\n", " ")).alias("d"))
    rows = rows.select("route_id", "d.short_name", "d.long_name", F.explode("d.directions").alias("direction_id", "dir"))
    rows = rows.select("*", F.explode("dir.days").alias("date", "day"))
    rows = rows.select("*", "day.type", F.explode("day.hours").alias("hour", "cell"))
    return rows.select(
        "route_id", "short_name", "long_name", F.col("direction_id").cast("int").alias("direction_id"), "date",
        F.col("hour").cast("int").alias("hour"), "type", "cell.*",
    )


@case("dashboard_doc", f"""WITH {SQL_CELLS}
SELECT coalesce(CAST(n_nationkey AS VARCHAR), '') AS short_name, coalesce(n_name, '') AS long_name, c.*
FROM cells c LEFT JOIN nation ON n_nationkey < 23 AND CAST(n_nationkey AS VARCHAR) = c.route_id""")
def dashboard_doc(spark, folder):
    return flat_documents(route_documents(cells(spark, folder), _names(spark, folder)))


@case("published_document", f"""WITH {SQL_CELLS}
SELECT coalesce(CAST(n_nationkey AS VARCHAR), '') AS short_name, coalesce(n_name, '') AS long_name, c.*
FROM cells c LEFT JOIN nation ON n_nationkey < 23 AND CAST(n_nationkey AS VARCHAR) = c.route_id""")
def published_document(spark, folder):
    """The document as written: its route lines, each without the comma before it, read as JSON again."""
    path = fresh_path(spark, "dashboard")
    save_dashboard(route_documents(cells(spark, folder), _names(spark, folder)), path, "2024-01-20T08:00:00Z")
    line = F.regexp_replace("value", "^,", "")
    lines = spark.read.text(path).where(line.startswith('"')).select(F.concat(F.lit("{"), line, F.lit("}")).alias("text"))
    kind = f"map<string, {' '.join(DOCUMENT.split())}>"
    return flat_documents(lines.select(F.explode(F.from_json("text", kind)).alias("route_id", "document")))


def _sql_text(column: str) -> str:
    """One decimal, exact binary halves up."""
    return f"""coalesce(CASE WHEN {column} * 4 = floor({column} * 4) AND CAST({column} * 4 AS BIGINT) % 2 = 1
      THEN printf('%.1f', (floor({column} * 10) + 1) / 10) ELSE printf('%.1f', {column}) END, '-')"""


@case("serving_view", f"""WITH {SQL_CELLS}, days AS (
  SELECT *, max(CASE WHEN date = '2024-01-20' THEN date END) OVER w AS current, min(date) OVER w AS first_day,
    row_number() OVER (PARTITION BY route_id, direction_id ORDER BY date, hour) AS place
  FROM cells WINDOW w AS (PARTITION BY route_id, direction_id))
SELECT route_id, direction_id, date, hour, type,
  CASE WHEN date < '2024-01-20' THEN 'past' WHEN date = '2024-01-20' THEN 'today' ELSE 'future' END AS day_label,
  date = coalesce(current, first_day) AS is_default_day, CAST(place AS INTEGER) AS place, lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS hour_text,
  {_sql_text('pred_avg')} AS pred_avg_text, CAST(pred_max AS VARCHAR) AS pred_max_text,
  CAST(least(5, greatest(0, floor(pred_avg + 0.5))) AS INTEGER) AS pred_avg_step,
  CASE WHEN type = 'past' THEN {_sql_text('actual_avg')} END AS actual_avg_text,
  CASE WHEN type = 'past' THEN CAST(actual_max AS VARCHAR) END AS actual_max_text FROM days""")
def serving(spark, folder):
    return serving_rows(cells(spark, folder), "2024-01-20")


# --- tables, sinks ----------------------------------------------------------------------------


@case("upsert_idempotent", f"WITH {b.SQL_HOURLY} SELECT {b.sql_typed()} FROM hourly")
def upsert_idempotent(spark, folder):
    rows = stored(b.typed_hourly(spark, folder), "typed")
    path = fresh_path(spark, "traffic")
    old = rows.where("date <= '2024-01-15'").withColumn("avg_occupancy", F.lit(0).cast("float"))
    for batch in (old, rows.where("date >= '2024-01-10'"), rows, rows.where("hour % 2 = 0")):
        upsert(batch, TRAFFIC, path)
    return b.with_text_time(feature_table(spark, TRAFFIC, path))


@case("parquet_union_scan", f"WITH {b.SQL_HOURLY} SELECT {b.HOURLY_NAMES} FROM hourly")
def parquet_union_scan(spark, folder):
    rows = stored(b.hourly(spark, folder), "hourly")
    parts = [rows.withColumn("n_obs", F.lit(0).cast("bigint")), rows.where("hour < 12"), rows.where("hour >= 12")]
    files = []
    for number, part in enumerate(parts):
        path = fresh_path(spark, f"part{number}")
        save_hourly(part, path)
        files += parquet_files(spark, path)
    return traffic_parquets(spark, files)


@case("feature_scan", f"""WITH {b.SQL_HOURLY}, typed AS (SELECT {b.sql_typed()} FROM hourly)
SELECT date, route_id, n_obs, event_time, true AS table_has_rows FROM typed
WHERE event_time >= '2024-01-10 06:00:00' AND event_time < '2024-01-12 00:00:00'""")
def feature_scan(spark, folder):
    path = warehouse(spark, folder).path(TRAFFIC)
    found = has_rows(feature_table(spark, TRAFFIC, path))
    rows = feature_table(
        spark, TRAFFIC, path, ["date", "route_id", "n_obs", "event_time"], "2024-01-10 06:00:00", "2024-01-12"
    )
    return b.with_text_time(rows).withColumn("table_has_rows", F.lit(found))


@case("split_roundtrip", f"""WITH {SQL_FEATURES}
SELECT CASE WHEN date <= '2024-01-20' THEN 'train' ELSE 'test' END AS part, route_id, hour, max_occupancy, event_time
FROM features WHERE date BETWEEN '2024-01-01' AND '2024-01-28'""")
def split_roundtrip(spark, folder):
    path = fresh_path(spark, "split")
    tables = b.typed_hourly, b.typed_calendar, b.typed_weather
    rows = feature_view(*[t(spark, folder) for t in tables], "max_occupancy")
    make_split(rows, path, 1, ("2024-01-01", "2024-01-20"), ("2024-01-21", "2024-01-28"))
    both = [
        df.select(F.lit(n).alias("part"), "route_id", "hour", "max_occupancy", "event_time")
        for n, df in zip(("train", "test"), split_frames(spark, path, 1))
    ]
    return b.with_text_time(both[0].unionByName(both[1]))


@case("text_sinks", f"""WITH {b.SQL_WEATHER}
SELECT DISTINCT 'dates' AS sink, strftime(ts, '%Y-%m-%d') AS line FROM events
UNION ALL SELECT 'failures', CAST(CAST(d AS DATE) AS VARCHAR) || ' weather no rows'
FROM generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) AS s(d)
WHERE CAST(d AS DATE) NOT IN (SELECT day FROM weather)""")
def text_sinks(spark, folder):
    dates, failures = fresh_path(spark, "dates"), fresh_path(spark, "failures")
    save_dates(b.table(spark, folder, "events").select(F.to_date("ts").alias("date")), dates)
    gaps = missing_dates(spark, b.raw_weather(spark, folder), "2024-01-01", "2024-01-30")
    append_failures(
        b.with_text_date(gaps).withColumns({"stage": F.lit("weather"), "error": F.lit("no rows")}), failures
    )
    lines = spark.read.text(dates).select(F.lit("dates").alias("sink"), F.col("value").alias("line"))
    return lines.unionByName(
        spark.read.parquet(failures).select(F.lit("failures").alias("sink"), F.concat_ws(" ", "date", "stage", "error").alias("line"))
    )


# --- jobs -------------------------------------------------------------------------------------

_WAREHOUSES: dict[tuple, Warehouse] = memo()


def warehouse(spark, folder) -> Warehouse:
    """Feature tables backfilled from hourly files, once per session and table set."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _WAREHOUSES:
        files = fresh_path(spark, "hourly")
        save_hourly(stored(b.hourly(spark, folder), "hourly"), files)
        made = Warehouse(fresh_path(spark, "warehouse"))
        backfill(spark, made, parquet_files(spark, files), b.raw_weather(spark, folder))
        _WAREHOUSES[key] = made
    return _WAREHOUSES[key]


@case("job_backfill", f"WITH {b.SQL_HOURLY} SELECT {b.sql_typed()} FROM hourly")
def job_backfill(spark, folder):
    return b.with_text_time(warehouse(spark, folder).read(spark, TRAFFIC))


@case("job_backfill_weather", f"""WITH {b.SQL_WEATHER}
SELECT date, CAST(hour AS TINYINT) AS hour, {', '.join(WEATHER_FEATURES)},
  strftime(CAST(date AS TIMESTAMP) + to_hours(hour), '%Y-%m-%d %H:%M:%S') AS event_time FROM prev_weather""")
def job_backfill_weather(spark, folder):
    return b.with_text_time(warehouse(spark, folder).read(spark, WEATHER))


@case("job_backfill_calendar", f"""WITH {b.SQL_HOURLY}, {b.SQL_CALENDAR}
SELECT c.*, c.date || ' 00:00:00' AS event_time FROM calendar c
WHERE c.date BETWEEN (SELECT min(date) FROM hourly) AND (SELECT max(date) FROM hourly)""")
def job_backfill_calendar(spark, folder):
    return b.with_text_time(warehouse(spark, folder).read(spark, CALENDAR))


@case("job_existing_dates", f"WITH {b.SQL_HOURLY} SELECT DISTINCT date FROM hourly WHERE date >= '2024-01-10'")
def job_existing_dates(spark, folder):
    path = fresh_path(spark, "existing")
    existing_dates(spark, warehouse(spark, folder), "2024-01-10", path)
    return spark.read.text(path).toDF("date")


@case("job_export", f"WITH {SQL_FEATURES} SELECT {PAST_NAMES}, {', '.join(WEATHER_FEATURES)} FROM features WHERE date >= '2024-01-05'")
def job_export(spark, folder):
    path = fresh_path(spark, "export")
    export_past(spark, warehouse(spark, folder), "2024-01-05", path)
    return past_export(spark, path)


_BUCKETS: dict[tuple, Buckets] = memo()


def buckets(spark, folder) -> Buckets:
    """The backfilled tables in eight buckets of days, once per session and table set."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BUCKETS:
        root = fresh_path(spark, "buckets")
        _BUCKETS[key] = bucket_tables(spark, warehouse(spark, folder), f"days_{uuid.uuid4().hex}", root, 8)
    return _BUCKETS[key]


@case("job_export_buckets", f"WITH {SQL_FEATURES} SELECT {PAST_NAMES}, {', '.join(WEATHER_FEATURES)} FROM features WHERE date >= '2024-01-05'")
def job_export_buckets(spark, folder):
    """The export over tables in buckets of days, which moves no traffic row."""
    path = fresh_path(spark, "export")
    export_past(spark, buckets(spark, folder), "2024-01-05", path)
    return past_export(spark, path)


@case("clustered_scan", f"""WITH {b.SQL_HOURLY}, typed AS (SELECT {b.sql_typed()} FROM hourly)
SELECT * FROM typed WHERE route_id = '7' OR hour = 8""")
def clustered_scan(spark, folder):
    """Days rewritten in interleaved order of route and hour, read by either."""
    place = Warehouse(fresh_path(spark, "clustered"))
    upsert(warehouse(spark, folder).read(spark, TRAFFIC), TRAFFIC, place.path(TRAFFIC))
    first, last = place.read(spark, TRAFFIC).agg(F.min("date"), F.max("date")).first()
    if first is not None:
        cluster_days(spark, TRAFFIC, place.path(TRAFFIC), first, last, rows_per_file=64)
    return b.with_text_time(place.read(spark, TRAFFIC).where("route_id = '7' or hour = 8"))


SPANS = {"all": (None, None), "week": ("2024-01-08", "2024-01-14"), "none": ("2023-01-01", "2023-01-31")}


@case("span_sketches", f"""WITH {b.SQL_HOURLY}, spans(span, low, high) AS (VALUES ('all', '', '9'), ('week', '2024-01-08', '2024-01-14'), ('none', '2023-01-01', '2023-01-31'))
SELECT span, CAST(count(route_id) AS BIGINT) AS n, CAST(count(DISTINCT route_id) AS BIGINT) AS routes, CAST(count(DISTINCT route_id || '/' || direction_id) AS BIGINT) AS lines, TRUE AS near
FROM spans LEFT JOIN hourly ON date BETWEEN low AND high GROUP BY span""")
def span_sketches(spark, folder):
    """Sketches kept per day, half of the days replaced once, merged for three spans and held against the exact rows.

    `near`: each quantile's rank, and each distinct count, is off by no more than twice, and three times, its stated error.
    """
    place = warehouse(spark, folder)
    refresh_sketches(spark, place)
    refresh_sketches(spark, place, place.read(spark, TRAFFIC).where("hour = 9").select("date"))
    kept = feature_table(spark, TRAFFIC_SKETCHES, place.path(TRAFFIC_SKETCHES))
    rows, wanted = with_line(place.read(spark, TRAFFIC)), [0.0, 0.1, 0.5, 0.9, 1.0]
    out = None
    for span, (first, last) in SPANS.items():
        found = span_summary(kept, wanted, first, last).first()  # one row
        here = rows.where(F.col("date").between(first, last)) if first else rows
        value, all_rows = F.col("avg_occupancy").cast("double"), F.count("*")
        near = (all_rows == found.n) & (F.lit(found.avg_occupancy_quantiles is None) == (all_rows == 0))
        for guess, true in ((found.route_id_distinct, "route_id"), (found.line_distinct, "line")):
            near = near & (F.abs(F.lit(guess) - F.count_distinct(true)) <= 3 * distinct_error() * F.count_distinct(true))
        for p, guess in zip(wanted, found.avg_occupancy_quantiles or [], strict=False):
            slack = all_rows * 2 * rank_error()
            near = near & (F.count_if(value < guess) - slack <= all_rows * p) & (all_rows * p <= F.count_if(value <= guess) + slack)
        one = here.agg(F.lit(span).alias("span"), F.lit(found.n).cast("long").alias("n"), F.count_distinct("route_id").alias("routes"),
                       F.count_distinct("line").alias("lines"), near.alias("near"))
        out = one if out is None else out.unionByName(one)
    return out


@case("export_count", f"WITH {b.SQL_HOURLY} SELECT CAST(count(*) AS BIGINT) AS n_rows FROM hourly WHERE date >= '2024-01-05'")
def export_count(spark, folder):
    """The number of rows that the export reports."""
    n = export_past(spark, warehouse(spark, folder), "2024-01-05", fresh_path(spark, "export"))
    return spark.createDataFrame([(n,)], "n_rows long")


@case("quarantined_rows", f"""WITH {b.SQL_HOURLY}
SELECT 'kept' AS what, count(*) AS n FROM hourly
UNION ALL SELECT 'quarantined', count(*) FROM hourly WHERE route_id = '3' AND hour + 20 > 23
UNION ALL SELECT 'stopped', CAST(count(*) > 0 AS BIGINT) FROM hourly WHERE route_id = '3'""")
def quarantined_rows(spark, folder):
    """Rows that break a rule are written and copied aside; counts that do not add up stop a strict load."""
    three = F.col("route_id") == "3"
    rows = stored(b.typed_hourly(spark, folder).withColumn("hour", F.when(three, F.col("hour") + 20).otherwise(F.col("hour")).cast("tinyint")), "altered")
    place = Warehouse(fresh_path(spark, "checked"))
    insert(rows, TRAFFIC, place)
    try:
        require_counts(rows.withColumn("n_obs", F.when(three, F.col("n_obs") + 1).otherwise(F.col("n_obs"))), "fail")
        stopped = 0
    except QualityError:
        stopped = 1
    counts = [("kept", place.read(spark, TRAFFIC)), ("quarantined", spark.read.schema(TRAFFIC.schema).parquet(place.quarantine(TRAFFIC)))]
    out = spark.createDataFrame([("stopped", stopped)], "what string, n long")
    for what, kept in counts:
        out = out.unionByName(kept.agg(F.lit(what).alias("what"), F.count("*").alias("n")))
    return out


@case("insert_report", f"""WITH {b.SQL_HOURLY}
SELECT 'between' AS rule, 'hour' AS column_name, count(*) AS n_rows, count_if(route_id = '3' AND hour + 20 > 23) AS n_unexpected FROM hourly
UNION ALL SELECT 'not_null', 'route_id', count(*), count_if(route_id = '5') FROM hourly""")
def insert_report(spark, folder):
    """What an insert says of its rows, counted while it stores them."""
    rows = b.typed_hourly(spark, folder).withColumns({
        "hour": F.when(F.col("route_id") == "3", F.col("hour") + 20).otherwise(F.col("hour")).cast("tinyint"),
        "route_id": F.when(F.col("route_id") != "5", F.col("route_id")),
    })
    report = insert(rows, TRAFFIC, Warehouse(fresh_path(spark, "reported")))
    return report.where("column = 'route_id' or column = 'hour'").select("rule", F.col("column").alias("column_name"), "n_rows", "n_unexpected")


SQL_DECODED = f"""{b.SQL_OBS}, {SQL_SAMPLE.format(source='obs', k=30)}, {b.sql_usable('sampled')},
{b.SQL_RESOLVED}, {b.sql_hourly('resolved', where='CAST(local_ts AS DATE) = CAST(utc AS DATE)')}"""


def _archive(spark, folder):
    archive = b.encoded_snapshots(spark, folder)
    return with_path_clock(archive.select("path")), archive_reader(archive)


@case("job_decode", f"WITH {SQL_DECODED} SELECT {b.HOURLY_NAMES} FROM hourly")
def job_decode(spark, folder):
    out, failures = fresh_path(spark, "decoded"), fresh_path(spark, "failures")
    days = b.table(spark, folder, "events").select(F.to_date("ts").alias("date")).distinct()
    decode_history(*_archive(spark, folder), b.trip_map(spark, folder), days, out, failures)
    return b.with_text_date(spark.read.parquet(out))


@case("job_decode_landed", f"WITH {SQL_DECODED} SELECT {b.HOURLY_NAMES} FROM hourly")
def job_decode_landed(spark, folder):
    """The same files as a landed table by day, from which sampling and decoding read."""
    out, table = fresh_path(spark, "decoded"), fresh_path(spark, "landed")
    with_path_clock(b.encoded_snapshots(spark, folder)).write.partitionBy("date").parquet(table)
    archive = landed(spark, table)
    days = b.table(spark, folder, "events").select(F.to_date("ts").alias("date")).distinct()
    listing = archive.select("path", "date", "hour")
    decode_history(listing, archive_reader(archive), b.trip_map(spark, folder), days, out, fresh_path(spark, "failures"))
    return b.with_text_date(spark.read.parquet(out))


@case("job_features", f"WITH {SQL_DECODED} SELECT {b.sql_typed()} FROM hourly")
def job_features(spark, folder):
    place = Warehouse(fresh_path(spark, "daily"))
    daily_features(
        spark, place, date(2024, 1, 31), *_archive(spark, folder), b.trip_map(spark, folder),
        b.raw_weather(spark, folder), fresh_path(spark, "failures"), lookback=35,
    )
    return b.with_text_time(place.read(spark, TRAFFIC))


def sql_trained(trials: int) -> str:
    return f"""SELECT unnest(['n_trials', 'best_is_a_trial', 'error_on_scale']) AS fact, unnest([{trials}.0, 1.0, 1.0]) AS value"""


#: Settings that the queries draw from the whole grid: all for the means, fewer for the classes, whose rounds grow six trees each.
TRIALS = {"regressor": TUNE_TRIALS, "classifier": 12}


def _trained(spark, folder, kind: str) -> DataFrame:
    """The best of the drawn settings, fitted on all rows and measured on the later ones."""
    path = fresh_path(spark, "split")
    tables = (warehouse(spark, folder).read(spark, t) for t in (TRAFFIC, CALENDAR, WEATHER))
    label = "avg_occupancy" if kind == "regressor" else "max_occupancy"
    make_split(feature_view(*tables, label), path, 1, ("2024-01-01", "2024-01-20"), ("2024-01-21", "2024-01-31"))
    done = train(spark, path, 1, kind, fresh_path(spark, "model"), trials=TRIALS[kind])
    tried = done.trials.select("settings").collect()
    error = F.col("rmse").between(0, 5) if kind == "regressor" else F.col("weighted_recall").between(0, 1)
    facts = {
        "n_trials": F.lit(len(tried)), "best_is_a_trial": F.lit(json.dumps(done.best, sort_keys=True) in [r.settings for r in tried]),
        "error_on_scale": error,
    }
    rows = F.array(*[F.struct(F.lit(name).alias("fact"), fact.cast("double").alias("value")) for name, fact in facts.items()])
    return done.metrics.select(F.inline(rows))


@case("job_train", sql_trained(TRIALS["regressor"]))
def job_train(spark, folder):
    return _trained(spark, folder, "regressor")


@case("job_train_classes", sql_trained(TRIALS["classifier"]))
def job_train_classes(spark, folder):
    return _trained(spark, folder, "classifier")


@case("job_score_past", f"""WITH {b.SQL_HOURLY}
SELECT route_id, CAST(direction_id AS INTEGER) AS direction_id, date, CAST(hour AS INTEGER) AS hour, 'past' AS type,
  CAST(CAST(avg_occupancy AS FLOAT) AS DOUBLE) AS actual_avg, CAST(max_occupancy AS INTEGER) AS actual_max, {SQL_PREDICTED}
FROM hourly""")
def job_score_past(spark, folder):
    path = fresh_path(spark, "export")
    export_past(spark, warehouse(spark, folder), "2024-01-01", path)
    return score_past(past_export(spark, path), *one_split_models(spark, folder))


SCORED_DAYS = [date(2024, 1, day) for day in range(20, 24)]


def _future(spark, folder):
    weather = b.raw_weather(spark, folder)
    history, forecast = weather.where("date < '2024-01-20'"), weather.where("date >= '2024-01-20'")
    hours = route_hours(spark, folder, b.moved_trips(spark, folder), [str(d) for d in SCORED_DAYS])
    return hours, score_future(hours, SCORED_DAYS, history, forecast, *one_split_models(spark, folder))


SQL_FUTURE = b.sql_route_hours("(DATE '2024-01-01' + CAST(o_orderkey % 35 AS INTEGER))", "2024-01-20", "2024-01-23")


@case("job_score_future", f"""WITH {SQL_FUTURE}
SELECT route_id, direction_id, date, hour, 'future' AS type, CAST(NULL AS DOUBLE) AS actual_avg,
  CAST(NULL AS INTEGER) AS actual_max, {SQL_PREDICTED} FROM route_hours""")
def job_score_future(spark, folder):
    return _future(spark, folder)[1]


@case("job_publish", f"""WITH {SQL_FUTURE}, {b.SQL_HOURLY}
SELECT h.route_id, CAST(h.direction_id AS INTEGER) AS direction_id, h.date, CAST(h.hour AS INTEGER) AS hour, 'past' AS type,
  CAST(CAST(h.avg_occupancy AS FLOAT) AS DOUBLE) AS actual_avg, CAST(h.max_occupancy AS INTEGER) AS actual_max, {SQL_PREDICTED}
FROM hourly h WHERE NOT EXISTS (SELECT 1 FROM route_hours f
  WHERE f.route_id = h.route_id AND f.direction_id = h.direction_id AND f.date = h.date)
UNION ALL SELECT route_id, direction_id, date, hour, 'future', NULL, NULL, {SQL_PREDICTED} FROM route_hours
WHERE route_id IN (SELECT route_id FROM hourly)""")
def job_publish(spark, folder):
    path = fresh_path(spark, "export")
    export_past(spark, warehouse(spark, folder), "2024-01-01", path)
    past = score_past(past_export(spark, path), *one_split_models(spark, folder))
    hours, future = _future(spark, folder)
    merged, _ = publish(past, future, hours, fresh_path(spark, "dashboard"), "2024-01-20T08:00:00Z")
    return merged


# --- streams ----------------------------------------------------------------------------------


def _stream(spark, path: str, pattern: str | None = None, one_by_one: bool = False) -> DataFrame:
    schema = spark.read.option("pathGlobFilter", pattern or "*.parquet").parquet(path).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern or "*.parquet")
    if one_by_one:
        reader = reader.option("maxFilesPerTrigger", 1)
    return b.as_sightings(reader.parquet(path))


@case("stream_hourly", f"WITH {b.SQL_HOURLY} SELECT {b.HOURLY_NAMES} FROM hourly")
def stream_hourly(spark, folder):
    path = fresh_path(spark, "hour_counts")
    counts = hourly_counts(_stream(spark, folder, "events.parquet"), "3650 days")
    upsert_counts(counts, path, fresh_path(spark, "checkpoint"), available_now=True).awaitTermination()
    return b.with_text_date(read_hours(spark, path))


@case("stream_upsert", f"WITH {b.SQL_HOURLY} SELECT {b.HOURLY_NAMES} FROM hourly")
def stream_upsert(spark, folder):
    """Two streams with checkpoints of their own, over files that share their hours, into one table; the
    first is started twice."""
    path, events = fresh_path(spark, "hour_counts"), b.table(spark, folder, "events")
    for part in (0, 1):
        feed, checkpoint = fresh_path(spark, f"feed{part}"), fresh_path(spark, f"checkpoint{part}")
        events.where(F.col("event_id") % 2 == part).repartitionByRange(3, "ts").write.parquet(feed)
        for _ in range(2 - part):
            counts = hourly_counts(_stream(spark, feed, one_by_one=True), "3650 days")
            upsert_counts(counts, path, checkpoint, available_now=True).awaitTermination()
    return b.with_text_date(read_hours(spark, path))
