"""Jobs, publishing and streams, end to end on small inputs."""

import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from seatflow.operators import publish
from seatflow.operators.occupancy import hourly_occupancy
from seatflow.operators.publish import merge_cells, names_from_schedule, route_documents, serving_rows, serving_view
from seatflow.plans import ingest, scoring, training
from seatflow.operators.joins import feature_view, feature_view_by_day, past_rows, past_rows_by_day
from seatflow.schemas import CALENDAR, PAST_COLUMNS, SCORED_STATUSES, TRAFFIC, WEATHER
from seatflow.sinks.tables import open_buckets, save_hourly
from seatflow.sources.snapshots import land_snapshots, landed, list_snapshots
from seatflow.sources.tables import past_export
from seatflow.streaming.hourly import HOUR_COUNTS, hourly_counts, read_hours, upsert_counts
from test_occupancy import feed, utc

CELLS = "route_id string, direction_id int, date string, hour int, type string, pred_avg double, pred_max int, actual_avg double, actual_max int"


def past(route, direction, day, hour, avg=1.5):
    return route, direction, day, hour, "past", 1.25, 2, avg, 3


def future(route, direction, day, hour):
    return route, direction, day, hour, "future", 0.5, 1, None, None


def merged(spark):
    before = [past("a", 0, "2024-01-01", 8), past("a", 0, "2024-01-01", 10), past("a", 0, "2024-01-02", 9, None), past("b", 1, "2024-01-01", 7)]
    after = [future("a", 0, "2024-01-02", 12), future("a", 1, "2024-01-03", 6), future("c", 0, "2024-01-03", 6)]
    return merge_cells(spark.createDataFrame(before, CELLS), spark.createDataFrame(after, CELLS))


def test_merge_rules(spark):
    keys = {(r.route_id, r.direction_id, r.date, r.hour): r.type for r in merged(spark).collect()}
    assert keys == {("a", 0, "2024-01-01", 8): "past", ("a", 0, "2024-01-01", 10): "past", ("a", 0, "2024-01-02", 12): "future",
                    ("a", 1, "2024-01-03", 6): "future", ("b", 1, "2024-01-01", 7): "past"}
    assert tuple(publish.publish_stats(merged(spark)).first()) == (2, 5)


def test_documents(spark):
    names = spark.createDataFrame([("a", "5", "Öst - Väst")], "route_id string, short_name string, long_name string")
    rows = route_documents(merged(spark), names).select(
        "route_id", F.to_json("document", {"ignoreNullFields": "false"}).alias("text"))
    found = {r.route_id: json.loads(r.text) for r in rows.collect()}
    cell = {"pred_avg": 1.25, "pred_max": 2, "actual_avg": 1.5, "actual_max": 3}
    assert found == {
        "a": {"short_name": "5", "long_name": "Öst - Väst", "directions": {
            "0": {"days": {"2024-01-01": {"type": "past", "hours": {"8": cell, "10": cell}},
                           "2024-01-02": {"type": "future", "hours": {"12": {"pred_avg": 0.5, "pred_max": 1}}}}},
            "1": {"days": {"2024-01-03": {"type": "future", "hours": {"6": {"pred_avg": 0.5, "pred_max": 1}}}}}}},
        "b": {"short_name": "", "long_name": "", "directions": {
            "1": {"days": {"2024-01-01": {"type": "past", "hours": {"7": cell}}}}}},
    }
    missing = route_documents(spark.createDataFrame([past("z", 0, "2024-01-01", 1, None)], CELLS), names)
    assert '"actual_avg":null' in missing.select(F.to_json("document")).first()[0]


def test_serving(spark):
    rows = {(r.route_id, r.direction_id, r.date, r.hour): r for r in serving_rows(merged(spark), "2024-01-02").collect()}
    today = rows["a", 0, "2024-01-02", 12]
    assert today.day_label == "today" and today.is_default_day and today.place == 3 and today.hour_text == "12:00"
    assert today.pred_avg_text == "0.5" and today.actual_avg_text is None and today.pred_avg_step == 1
    assert rows["a", 1, "2024-01-03", 6].is_default_day and rows["b", 1, "2024-01-01", 7].actual_avg_text == "1.5"
    assert not rows["a", 0, "2024-01-01", 8].is_default_day
    view = serving_view(merged(spark), "a", 0, "2024-01-02").collect()
    assert [(r.date, r.hour) for r in view] == [("2024-01-01", 8), ("2024-01-01", 10), ("2024-01-02", 12)]


def test_names(spark):
    hours = spark.createDataFrame([("a", "1", "x"), ("a", "1", "x"), ("b", "2", "y")], "route_id string, route_short_name string, route_long_name string")
    known = spark.createDataFrame([("a", "kept", "kept")], "route_id string, short_name string, long_name string")
    assert sorted(tuple(r) for r in names_from_schedule(known, hours).collect()) == [("a", "kept", "kept"), ("b", "2", "y")]
    assert names_from_schedule(None, hours).count() == 2


# --- ingestion ---------------------------------------------------------------------------------

AIR = "date date, hour int, temperature_2m double, precipitation double, windspeed_10m double, cloudcover int"


def air(spark, first, days):
    rows = [(first + timedelta(days=d), h, float(d), 0.5, 3.0, h) for d in range(days) for h in range(24)]
    return spark.createDataFrame(rows, AIR)


def trip_map(spark, *months):
    return spark.createDataFrame([(m, f"t{n}", f"r{n % 2}", n % 2) for m in months for n in range(4)],
                                 "month string, trip_id string, route_id string, direction_id int")


def snapshots(root, day, hours=(6, 7), per_hour=4):
    for hour in hours:
        folder = root / day.strftime("%Y/%m/%d") / f"{hour:02d}"
        folder.mkdir(parents=True)
        for i in range(per_hour):
            stamp = utc(f"{day}T{hour:02d}:{i * 10:02d}:00")
            (folder / f"{i}.pb").write_bytes(feed([
                {"trip_id": f"t{n}", "timestamp": stamp, "occupancy_status": (n + i) % 6} for n in range(4)]))


def test_daily_job(spark, tmp_path):
    root = tmp_path / "feed"
    days = [date(2024, 1, d) for d in (30, 31)] + [date(2024, 2, 1)]
    for day in days:
        snapshots(root, day)
    (root / "2024/01/31/06/0.pb").write_bytes(b"\xff\xff broken")
    house = ingest.Warehouse(str(tmp_path / "house"))
    failures = str(tmp_path / "failures")
    weather = air(spark, date(2024, 1, 20), 20)

    def run(as_of, months):
        return sorted(r.date for r in ingest.daily_features(
            spark, house, as_of, list_snapshots(spark, str(root)), ingest.file_reader(spark), trip_map(spark, *months),
            weather, failures, k=3).collect())

    # 28 and 29 January have no files, 31 January a broken one, February no trip map yet
    assert run(date(2024, 2, 2), ["2024-01"]) == ["2024-01-30"]
    stages = {(r.date, r.stage) for r in spark.read.parquet(failures).collect()}
    assert stages == {("2024-01-28", "snapshots"), ("2024-01-29", "snapshots"), ("2024-01-31", "decode"), ("2024-02-01", "trip map")}
    traffic = house.read(spark, TRAFFIC)
    assert sorted((r.hour, r.route_id, r.n_obs) for r in traffic.collect()) == [(7, "r0", 6), (7, "r1", 6), (8, "r0", 6), (8, "r1", 6)]
    assert house.read(spark, CALENDAR).count() == 1 and house.read(spark, WEATHER).count() == 24
    assert house.read(spark, WEATHER).where("prev_temperature_2m is null").count() == 0

    (root / "2024/01/31/06/0.pb").write_bytes(b"")
    assert run(date(2024, 2, 2), ["2024-01", "2024-02"]) == ["2024-01-31", "2024-02-01"]
    assert run(date(2024, 2, 2), ["2024-01", "2024-02"]) == []
    assert house.read(spark, WEATHER).count() == 72 and house.read(spark, CALENDAR).count() == 3
    assert ingest.existing_dates(spark, house, "2024-01-31").count() == 2


def test_decode_job(spark, tmp_path):
    snapshots(tmp_path / "feed", date(2024, 1, 5))
    wanted = spark.createDataFrame([("2024-01-05",), ("2024-01-06",)], "date string")
    listing = list_snapshots(spark, str(tmp_path / "feed"))
    ingest.decode_history(listing, ingest.file_reader(spark), trip_map(spark, "2024-01"), wanted, str(tmp_path / "out"), str(tmp_path / "bad"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 4 and rows.agg(F.sum("n_obs")).first()[0] == 32
    assert [r.date for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["2024-01-06"]


def test_decode_job_over_landed_days(spark, tmp_path, plan_of):
    """Days are landed by folder, read from the table, and nothing of other days is opened."""
    days = [date(2024, 1, d) for d in (4, 5, 6, 7)]
    for day in days[:3]:
        snapshots(tmp_path / "feed", day)
    (tmp_path / "feed/2024/01/06/06/0.pb").write_bytes(b"\xff\xff broken")
    table = str(tmp_path / "landed")
    for _ in range(2):
        land_snapshots(spark, str(tmp_path / "feed"), days, table)
    archive = landed(spark, table)
    assert archive.count() == 24 and list_snapshots(spark, str(tmp_path / "feed"), days[1:]).count() == 16
    assert list_snapshots(spark, str(tmp_path / "feed"), days[3:]).count() == 0
    wanted = spark.createDataFrame([("2024-01-05",), ("2024-01-06",)], "date string")
    listing, reader = archive.select("path", "date", "hour"), ingest.archive_reader(archive)
    ingest.decode_history(listing, reader, trip_map(spark, "2024-01"), wanted, str(tmp_path / "out"), str(tmp_path / "bad"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.agg(F.sum("n_obs")).first()[0] == 32 and {str(r.date) for r in rows.collect()} == {"2024-01-05"}
    assert [(r.date, r.stage) for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == [("2024-01-06", "decode")]
    plan = plan_of(reader(listing.where("date = '2024-01-05'")))
    assert "content" in plan and "PartitionFilters: [isnotnull(date" in plan


def house_with_history(spark, tmp_path, days=30):
    rng = random.Random(1)
    start = utc("2024-01-01T00:00:00")
    seen = [(start + rng.randrange(days * 86400), str(n % 3), n % 2, rng.choice(SCORED_STATUSES)) for n in range(3000)]
    hours = hourly_occupancy(spark.createDataFrame(seen, "ts bigint, route_id string, direction_id int, occupancy string"))
    hours = hours.withColumn("date", F.col("date").cast("string"))
    save_hourly(hours, str(tmp_path / "hours"))
    house = ingest.Warehouse(str(tmp_path / "house"))
    files = [str(p) for p in (tmp_path / "hours").glob("*.parquet")]
    ingest.backfill(spark, house, files, air(spark, date(2023, 12, 31), 40))
    return house, files


def test_backfill_export_train_score_publish(spark, tmp_path):
    house, files = house_with_history(spark, tmp_path)
    before = house.read(spark, TRAFFIC).count()
    ingest.backfill(spark, house, files, air(spark, date(2023, 12, 31), 40), mode="fail")
    assert house.read(spark, TRAFFIC).count() == before > 500

    export = str(tmp_path / "export")
    exported = ingest.export_past(spark, house, "2024-01-10", export, until="2024-01-20")
    rows = past_export(spark, export)
    assert exported == rows.count() > 0
    span = rows.agg(F.min("date"), F.max("date")).first()
    assert rows.columns == PAST_COLUMNS and tuple(span) == ("2024-01-10", "2024-01-19")
    assert rows.where("prev_cloudcover is null or weekday is null").count() == 0
    assert ingest.export_past(spark, house, "2025-01-01", str(tmp_path / "none")) == 0

    small = {"rounds": 2, "depth": 2, "leaf_rows": 1, "step": 0.1}
    for kind, label in training.LABELS.items():
        view = feature_view(*[house.read(spark, t) for t in (TRAFFIC, CALENDAR, WEATHER)], label)
        training.make_split(view, str(tmp_path / kind), 1, ("2024-01-01", "2024-01-20"), ("2024-01-21", "2024-01-31"))
        done = training.train(spark, str(tmp_path / kind), 1, kind, str(tmp_path / "models" / kind), [small, {**small, "depth": 1}], 2)
        assert done.trials.count() == 2 and done.metrics.count() == 1
    models = [training.PipelineModel.load(str(tmp_path / "models" / kind / "pipeline")) for kind in training.LABELS]

    before, after = scoring.window_days(date(2024, 1, 18))
    assert [str(d) for d in before] == ["2024-01-15", "2024-01-16", "2024-01-17"] and len(after) == 4
    past_rows = scoring.score_past(rows.where(F.col("date").isin([str(d) for d in before])), *models)
    route_hours = spark.createDataFrame(
        [(str(d), h, r, 0, r, f"Line {r}") for d in after for h in (7, 8) for r in ("0", "9")],
        "date string, hour int, route_id string, direction_id int, route_short_name string, route_long_name string")
    weather = air(spark, date(2024, 1, 17), 5)
    future_rows = scoring.score_future(route_hours, after, weather.where("date < '2024-01-18'"), weather.where("date >= '2024-01-18'"), *models)
    bare = scoring.score_future(route_hours, after, None, None, *models)
    assert future_rows.count() == bare.count() == 16 and bare.where("pred_avg is null or pred_max is null").count() == 0
    cells, stats = scoring.publish(past_rows, future_rows, route_hours, str(tmp_path / "dash"), "2024-01-18T08:00:00Z")
    text = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "dash").glob("part-*")))
    found = json.loads(text)["routes"]
    assert "9" not in found and found["0"]["long_name"] == "Line 0" and found["1"]["long_name"] == ""
    days = found["0"]["directions"]["0"]["days"]
    assert days["2024-01-18"]["type"] == "future" and set(days["2024-01-18"]["hours"]) == {"7", "8"}
    counted = sum(len(d["hours"]) for r in found.values() for x in r["directions"].values() for d in x["days"].values())
    assert stats.first().predictions == counted == cells.count()


def test_buckets_of_days_join_without_moving_rows(spark, tmp_path, plan_of):
    house, _ = house_with_history(spark, tmp_path)
    made = ingest.bucket_tables(spark, house, "joined_days", str(tmp_path / "buckets"), 3)
    for table in (TRAFFIC, CALENDAR, WEATHER):  # as a session finds them that has not written them
        spark.sql(f"DROP TABLE {made.name(table)}")
        open_buckets(spark, table, made.name(table), str(tmp_path / "buckets" / table.name), 3)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = {kind: [source.read(spark, t) for t in (TRAFFIC, CALENDAR, WEATHER)] for kind, source in (("plain", house), ("buckets", made))}
        pairs = [(past_rows(*read["plain"]), past_rows_by_day(*read["buckets"])),
                 (feature_view(*read["plain"], "max_occupancy"), feature_view_by_day(*read["buckets"], "max_occupancy"))]
        for plain, moved in pairs:
            assert "Exchange" in plan_of(plain) and "Exchange" not in plan_of(moved)
            assert sorted(plain.collect(), key=str) == sorted(moved.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    plain, moved = str(tmp_path / "plain"), str(tmp_path / "moved")
    n = ingest.export_past(spark, house, "2024-01-10", plain, until="2024-01-20")
    assert ingest.export_past(spark, made, "2024-01-10", moved, until="2024-01-20") == n > 0
    assert past_export(spark, plain).exceptAll(past_export(spark, moved)).isEmpty()
    for table in (TRAFFIC, CALENDAR, WEATHER):
        spark.sql(f"DROP TABLE {made.name(table)}")


def test_failing_rows_are_inserted_and_copied(spark, tmp_path):
    from test_tables import typed

    house = ingest.Warehouse(str(tmp_path / "house"))
    rows = typed(spark, ("2024-01-01", 1, "a", 1.0), ("2024-01-01", 2, "a", 9.0))
    report = ingest.insert(rows, TRAFFIC, house)
    assert [r["column"] for r in report.where("not success").collect()] == ["avg_occupancy"]
    assert house.read(spark, TRAFFIC).count() == 2
    assert [r.hour for r in spark.read.parquet(house.quarantine(TRAFFIC)).collect()] == [2]


def test_insert_works_its_rows_out_once(spark, tmp_path):
    from test_tables import typed

    worked = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            worked.add(batch.num_rows)
            yield batch

    rows = typed(spark, ("2024-01-01", 1, "a", 1.0), ("2024-01-01", 2, "a", 9.0), ("2024-01-02", 2, None, 9.0))
    house = ingest.Warehouse(str(tmp_path / "house"))
    report = ingest.insert(rows.mapInArrow(count, rows.schema), TRAFFIC, house)
    assert worked.value == 3
    broken = {r["column"]: (r.n_rows, r.n_unexpected) for r in report.where("not success").collect()}
    assert broken == {"avg_occupancy": (3, 2), "route_id": (3, 1)}
    assert [tuple(r) for r in ingest.insert(rows.where("hour > 9"), TRAFFIC, house).select("n_rows").distinct().collect()] == [(0,)]


def test_wrong_counts_stop_a_backfill(spark, tmp_path):
    from seatflow.operators.quality import QualityError
    from test_tables import hours

    save_hourly(hours(spark, ("2024-01-01", 1, "a", 1.0)).withColumn("n_obs", F.lit(3)), str(tmp_path / "f"))
    files = [str(p) for p in (tmp_path / "f").glob("*.parquet")]
    house = ingest.Warehouse(str(tmp_path / "house"))
    with pytest.raises(QualityError):
        ingest.backfill(spark, house, files, air(spark, date(2023, 12, 31), 3))
    assert not (tmp_path / "house").exists()


# --- streams -----------------------------------------------------------------------------------

SEEN = "ts bigint, route_id string, direction_id int, occupancy string"


def drip(spark, folder, checkpoint, path, lateness):
    stream = spark.readStream.schema(SEEN).option("maxFilesPerTrigger", 1).parquet(str(folder))
    upsert_counts(hourly_counts(stream, lateness), path, checkpoint, available_now=True).awaitTermination()


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    rng = random.Random(4)
    start = utc("2024-10-26T20:00:00")
    rows = [(start + rng.randrange(10 * 3600), str(rng.randrange(2)), 0, rng.choice(SCORED_STATUSES)) for _ in range(900)]
    for n in range(3):
        spark.createDataFrame(rows[n::3], SEEN).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    path = str(tmp_path / "counts")
    expected = sorted(tuple(r) for r in hourly_occupancy(spark.createDataFrame(rows, SEEN)).collect())
    for _ in range(2):
        drip(spark, tmp_path / "feed", str(tmp_path / "checkpoint"), path, "100 days")
        assert sorted(tuple(r) for r in read_hours(spark, path).collect()) == expected
    # both UTC hours of the repeated local hour are in the same row
    local = [r for r in expected if (str(r[0]), r[1]) == ("2024-10-27", 2)]
    utc_hours = [utc("2024-10-27T00:00:00"), utc("2024-10-27T01:00:00")]
    assert sum(r[4] for r in local) == sum(1 for r in rows if r[0] - r[0] % 3600 in utc_hours)
    keys = spark.read.schema(HOUR_COUNTS.schema).parquet(path)
    assert keys.count() == keys.select(*HOUR_COUNTS.key).distinct().count()
    # a stream with a checkpoint of its own over new files of the same hours adds to them
    more = [(r[0], r[1], r[2], SCORED_STATUSES[0]) for r in rows[:50]]
    spark.createDataFrame(more, SEEN).coalesce(1).write.parquet(str(tmp_path / "later"))
    drip(spark, tmp_path / "later", str(tmp_path / "other"), path, "100 days")
    both = sorted(tuple(r) for r in hourly_occupancy(spark.createDataFrame(rows + more, SEEN)).collect())
    assert sorted(tuple(r) for r in read_hours(spark, path).collect()) == both


def test_late_sightings_are_dropped(spark, tmp_path):
    feed_folder, path, mark = tmp_path / "feed", str(tmp_path / "counts"), str(tmp_path / "checkpoint")

    def arrive(*times):
        rows = [(utc(t), "a", 0, "FULL") for t in times]
        spark.createDataFrame(rows, SEEN).coalesce(1).write.mode("append").parquet(str(feed_folder))
        drip(spark, feed_folder, mark, path, "2 hours")

    arrive("2024-01-01T10:10:00")
    arrive("2024-01-01T11:30:00", "2024-01-01T10:50:00")
    arrive("2024-01-01T20:00:00")
    arrive("2024-01-01T10:55:00", "2024-01-01T19:10:00")
    got = {r.hour: r.n_obs for r in read_hours(spark, path).collect()}
    assert got == {11: 2, 12: 1, 21: 1, 20: 1}
