"""Stored tables, upserts, reports."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from seatflow.functions.casts import with_event_time
from seatflow.operators import ordering
from seatflow.runtime import shared_folder
from seatflow.schemas import CALENDAR, TRAFFIC, TRAFFIC_COLUMNS
from seatflow.sinks import reports, tables
from seatflow.sources import tables as source


def hours(spark, *rows):
    """Hourly rows from (date, hour, route, average)."""
    df = spark.createDataFrame(rows, "date string, hour int, route_id string, avg_occupancy double")
    zeros = {c: F.lit(0) for c in ["direction_id", "n_obs", "n_empty", "n_many_seats", "n_few_seats", "n_standing",
                                   "n_crushed", "n_full", "max_occupancy", "mode_occupancy"]}
    return df.withColumns(zeros)


def typed(spark, *rows):
    return tables.conform(with_event_time(hours(spark, *rows)), TRAFFIC)


def content(spark, path):
    df = source.feature_table(spark, TRAFFIC, path)
    return sorted((r.date, r.hour, r.route_id, round(r.avg_occupancy, 3)) for r in df.collect())


def test_upsert_replaces_by_key_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "traffic")
    first = typed(spark, ("2024-01-01", 1, "a", 1.0), ("2024-01-01", 2, "a", 1.0), ("2024-01-02", 1, "a", 1.0))
    tables.upsert(first, TRAFFIC, path)
    untouched = {p.name for p in (tmp_path / "traffic" / "date=2024-01-02").iterdir()}
    second = typed(spark, ("2024-01-01", 2, "a", 2.0), ("2024-01-01", 3, "b", 2.0), ("2024-01-05", 0, "c", 2.0))
    expected = [("2024-01-01", 1, "a", 1.0), ("2024-01-01", 2, "a", 2.0), ("2024-01-01", 3, "b", 2.0),
                ("2024-01-02", 1, "a", 1.0), ("2024-01-05", 0, "c", 2.0)]
    for _ in range(2):
        tables.upsert(second, TRAFFIC, path)
        assert content(spark, path) == expected
    assert {p.name for p in (tmp_path / "traffic" / "date=2024-01-02").iterdir()} == untouched
    assert dict(source.feature_table(spark, TRAFFIC, path).dtypes)["n_obs"] == "smallint"


def test_upsert_of_every_other_day(spark, tmp_path):
    path = str(tmp_path / "traffic")
    days = [f"2024-01-{d:02d}" for d in range(1, 9)]
    tables.upsert(typed(spark, *[(d, 1, "a", 1.0) for d in days]), TRAFFIC, path)
    tables.upsert(typed(spark, *[(d, 1, "a", 2.0) for d in days[1::2]]), TRAFFIC, path)
    assert [r[3] for r in content(spark, path)] == [1.0, 2.0] * 4


def test_rows_without_a_day_survive(spark, tmp_path):
    path = str(tmp_path / "traffic")
    tables.upsert(typed(spark, (None, 1, "a", 1.0), (None, 2, "a", 1.0), ("2024-01-01", 2, "a", 1.0)), TRAFFIC, path)
    tables.upsert(typed(spark, ("2024-01-01", 2, "a", 2.0), (None, 3, "a", 2.0)), TRAFFIC, path)
    tables.upsert(typed(spark, (None, 2, "a", 3.0)), TRAFFIC, path)
    got = [(r.date, r.hour, r.avg_occupancy) for r in source.feature_table(spark, TRAFFIC, path).collect()]
    assert sorted(got, key=str) == [("2024-01-01", 2, 2.0), (None, 1, 1.0), (None, 2, 3.0), (None, 3, 2.0)]
    tables.upsert(typed(spark, ("2024-01-02", 2, "a", 2.0)), TRAFFIC, path)
    assert source.feature_table(spark, TRAFFIC, path).count() == 5


def test_incoming_rows_are_worked_out_once(spark, tmp_path):
    path = str(tmp_path / "traffic")
    tables.upsert(typed(spark, ("2024-01-01", 1, "a", 1.0)), TRAFFIC, path)
    worked = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            worked.add(batch.num_rows)
            yield batch

    rows = typed(spark, ("2024-01-01", 1, "a", 2.0), ("2024-01-02", 2, "a", 2.0))
    tables.upsert(rows.mapInArrow(count, rows.schema), TRAFFIC, path)
    assert worked.value == 2 and len(content(spark, path)) == 2


def test_unpartitioned_upsert_and_comments(spark, tmp_path):
    path = str(tmp_path / "calendar")
    rows = lambda *days: spark.createDataFrame([(d, m) for d, m in days], "date string, month int").withColumns({
        "weekday": F.lit("Monday"), "is_weekend": F.lit(False), "is_holiday_se": F.lit(False),
        "is_workday_se": F.lit(True), "event_time": F.col("date").cast("timestamp_ntz")})
    tables.upsert(rows(("2024-01-01", 9), ("2024-01-02", 1)), CALENDAR, path)
    tables.upsert(rows(("2024-01-01", 1), ("2024-01-03", 1)), CALENDAR, path)
    assert sorted((r.date, r.month) for r in tables.read_table(spark, CALENDAR, path).collect()) == [("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 1)]
    assert source.feature_table(spark, CALENDAR, path).columns == CALENDAR.schema.names
    assert {f.name: f.metadata["comment"] for f in spark.read.parquet(path).schema.fields if f.metadata} == CALENDAR.comments


def test_failed_upsert_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "calendar")
    rows = lambda day, month: spark.createDataFrame([(day, month)], "date string, month int").withColumns({
        "weekday": F.lit("Monday"), "is_weekend": F.lit(False), "is_holiday_se": F.lit(False),
        "is_workday_se": F.lit(True), "event_time": F.col("date").cast("timestamp_ntz")})
    tables.upsert(rows("2024-01-01", 1), CALENDAR, path)
    broken = rows("2024-01-02", 2).withColumn("is_weekend", F.raise_error(F.lit("broken")).cast("boolean"))
    with pytest.raises(Exception, match="broken"):
        tables.upsert(broken, CALENDAR, path)
    assert [r.date for r in tables.read_table(spark, CALENDAR, path).collect()] == ["2024-01-01"]


def test_repeated_keys_of_one_batch_leave_one_row(spark, tmp_path):
    path = str(tmp_path / "traffic")
    tables.upsert(typed(spark, ("2024-01-01", 1, "a", 1.0), ("2024-01-01", 1, "a", 3.0), ("2024-01-01", 1, "a", 2.0)), TRAFFIC, path)
    assert content(spark, path) == [("2024-01-01", 1, "a", 3.0)]


def test_comments(spark):
    assert all(f.metadata["comment"] for f in TRAFFIC.described().fields)


def test_merge_hook(spark, tmp_path):
    calls = []
    tables.upsert(typed(spark, ("2024-01-01", 1, "a", 1.0)), TRAFFIC, "there", merge=lambda df, table, path: calls.append((df.count(), table.name, path)))
    assert calls == [(1, "traffic", "there")]


def test_bounded_reads_prune_days(spark, tmp_path, plan_of):
    path = str(tmp_path / "traffic")
    tables.upsert(typed(spark, *[(f"2024-01-{d:02d}", h, "a", 1.0) for d in range(1, 10) for h in (3, 9)]), TRAFFIC, path)
    df = source.feature_table(spark, TRAFFIC, path, ["date", "hour"], "2024-01-04 06:00:00", "2024-01-06")
    assert sorted(tuple(r) for r in df.collect()) == [("2024-01-04", 9), ("2024-01-05", 3), ("2024-01-05", 9)]
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(event_time)" in plan
    assert "ReadSchema: struct<hour:tinyint,event_time:timestamp_ntz>" in plan
    assert source.has_rows(df) and not source.has_rows(df.where("hour > 20"))
    assert source.table_exists(spark, path, TRAFFIC.schema) and not source.table_exists(spark, path + "x", TRAFFIC.schema)


def scanned(df):
    """Rows that the scan of an executed plan gave out."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_clustered_days_let_reads_pass_over_rows(spark, tmp_path):
    path = str(tmp_path / "traffic")
    days = ("2024-01-01", "2024-01-02", "2024-01-03")
    tables.upsert(typed(spark, *[(d, h, f"line {r:02d}", 1.0) for d in days for h in range(24) for r in range(48)]), TRAFFIC, path)
    before = content(spark, path)
    untouched = {p.name for p in (tmp_path / "traffic" / "date=2024-01-03").iterdir()}
    wanted = {"route_id = 'line 17'": 24, "hour = 9": 48}
    read = lambda which: scanned(source.feature_table(spark, TRAFFIC, path).where(f"date < '2024-01-03' and {which}"))
    assert all(read(which) == 2 * 24 * 48 for which in wanted)
    tables.cluster_days(spark, TRAFFIC, path, "2024-01-01", "2024-01-02", rows_per_file=48)
    after = {which: read(which) for which in wanted}
    assert all(2 * n <= after[which] <= 24 * 48 for which, n in wanted.items()), after  # half of the rows at most
    assert content(spark, path) == before
    assert {p.name for p in (tmp_path / "traffic" / "date=2024-01-03").iterdir()} == untouched


def test_interleaved_order(spark):
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in "pqrs"], "a int, b string")
    placed, order = ordering.interleaved(rows, ["a", "b"], bits=2)
    got = {(r.a, r.b): r.place for r in placed.select("a", "b", order.alias("place")).collect()}
    spread = lambda x: (x & 1) | (x & 2) << 1
    assert got == {(a, b): spread(a) << 1 | spread(n) for a in range(4) for n, b in enumerate("pqrs")}
    gaps = spark.createDataFrame([(None, "x"), (1, None), (None, None)], "a int, b string")
    assert ordering.interleaved(gaps, ["a", "b"])[0].count() == 3
    assert ordering.interleaved(gaps.limit(0), ["a", "b"])[0].count() == 0


def test_files_are_united_in_the_order_given(spark, tmp_path):
    folders = []
    for n, rows in enumerate([[("2024-01-01", 1, "a", 1.0), ("2024-01-01", 2, "a", 1.0)], [("2024-01-01", 1, "a", 2.0)]]):
        folders.append(str(tmp_path / f"f+ {n}"))
        assert tables.save_hourly(hours(spark, *rows).coalesce(1), folders[-1])
    files = [f for folder in folders for f in source.parquet_files(spark, folder)]
    read = lambda paths: sorted((r.hour, r.avg_occupancy) for r in source.traffic_parquets(spark, paths).collect())
    assert read(files) == [(1, 2.0), (2, 1.0)] and read(files[::-1]) == [(1, 1.0), (2, 1.0)]
    assert source.traffic_parquets(spark, files).columns == TRAFFIC_COLUMNS
    plain = [str(next((tmp_path / f"f+ {n}").glob("*.parquet"))) for n in (0, 1)]
    assert read(plain) == [(1, 2.0), (2, 1.0)]
    schema = spark.read.parquet(folders[0]).schema
    assert source.traffic_parquets(spark, plain, schema).count() == 2
    wider = str(tmp_path / "wider")
    hours(spark, ("2024-01-01", 7, "a", 1.0)).withColumn("note", F.lit("x")).write.parquet(wider)
    assert "note" in source.union_parquets(spark, [plain[0], *source.parquet_files(spark, wider)]).columns


def test_last_row_of_one_file_wins(spark, tmp_path):
    path = str(tmp_path / "one")
    rows = [("2024-01-01", 1, "a", float(n)) for n in range(50)]
    hours(spark, *rows).coalesce(1).write.parquet(path)
    assert [r.avg_occupancy for r in source.traffic_parquets(spark, source.parquet_files(spark, path)).collect()] == [49.0]


def test_missing_inputs_are_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        source.traffic_parquets(spark, [])
    with pytest.raises(FileNotFoundError):
        source.parquet_files(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        source.parquet_files(spark, str(tmp_path / "empty"))
    assert tables.save_hourly(hours(spark, ("2024-01-01", 1, "a", 1.0)).limit(0), str(tmp_path / "no")) is False
    assert not (tmp_path / "no").exists()


def test_reports(spark, tmp_path):
    dates = spark.createDataFrame([(date(2024, 1, 2),), (date(2024, 1, 1),), (date(2024, 1, 2),)], "date date")
    reports.save_dates(dates, str(tmp_path / "dates"))
    [part] = (tmp_path / "dates").glob("part-*")
    assert part.read_text() == "2024-01-01\n2024-01-02\n"
    one = spark.createDataFrame([("2024-01-01", "decode", "x")], reports.FAILURES)
    for _ in range(2):
        reports.append_failures(one, str(tmp_path / "failures"))
    reports.append_failures(reports.no_failures(spark), str(tmp_path / "failures"))
    assert spark.read.parquet(str(tmp_path / "failures")).count() == 2


def test_dashboard_parts_make_one_document(spark, tmp_path):
    document = F.struct(F.concat(F.lit("Öst \""), "route_id").alias("short_name"), F.lit(None).cast("int").alias("pred"))
    routes = spark.range(50).select(F.concat(F.lit("r"), "id").alias("route_id")).select("route_id", document.alias("document"))
    reports.save_dashboard(routes.repartition(6), str(tmp_path / "out"), "2024-01-01T00:00:00Z")
    text = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "out").glob("part-*")))
    found = json.loads(text)
    assert found["generated_at"] == "2024-01-01T00:00:00Z" and list(found["routes"]) == sorted(f"r{n}" for n in range(50))
    assert found["routes"]["r7"] == {"short_name": 'Öst "r7', "pred": None} and "Öst" in text
    reports.save_dashboard(routes.limit(0), str(tmp_path / "none"), "x")
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))) == {"generated_at": "x", "routes": {}}


def test_shared_folder_prefers_the_session_setting(spark, monkeypatch):
    assert shared_folder(spark) == shared_folder(spark)
    spark.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))

    class Conf:
        def get(self, name, default=None):
            return "/shared" if name == "spark.checkpoint.dir" else default

    class Session:
        conf, sparkContext = Conf(), spark.sparkContext

    assert shared_folder(Session()) == "/shared"
