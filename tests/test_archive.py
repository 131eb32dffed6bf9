"""The snapshot archive source, and streams whose hours close or whose routes are resolved."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual

from seatflow.operators.ordering import evenly_spaced
from seatflow.schemas import SCORED_STATUSES
from seatflow.sources import archive
from seatflow.sources.snapshots import decode_snapshots, feed_message, with_path_clock
from seatflow.streaming.hourly import append_hours, closed_hours, read_hours, upsert_resolved


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    """Three days of two hours; file n of an hour has n + 1 entities, and one file is damaged."""
    top = tmp_path_factory.mktemp("archive")
    for day in (1, 2, 3):
        for hour in (4, 5):
            folder = top / f"2024/01/{day:02d}/{hour:02d}"
            folder.mkdir(parents=True)
            for n in range(7):
                feed = feed_message()()
                feed.header.timestamp = 1000 + n
                for e in range(n + 1):
                    vehicle = feed.entity.add(id=str(e)).vehicle
                    vehicle.trip.trip_id, vehicle.occupancy_status = f"{day}-{e}", e % 6
                (folder / f"{n}.pb").write_bytes(feed.SerializeToString())
            (folder / "notes.txt").write_text("no snapshot")
    (top / "2024/01/02/05/3.pb").write_bytes(b"\xff\xff")
    (top / "2024/01/odd").mkdir()
    (top / "2024/01/01/xx").mkdir()
    return str(top)


def test_days_reach_the_listing(root):
    def hours(*filters):
        reader = archive.ArchiveReader({"path": root})
        left = list(reader.pushFilters(list(filters)))
        return sorted((p.day.day, p.hour) for p in reader.partitions()), left

    every = [(d, h) for d in (1, 2, 3) for h in (4, 5)]
    assert hours() == (every, [])
    day = ("date",)
    assert hours(GreaterThan(day, date(2024, 1, 1)))[0] == every[2:]
    assert hours(GreaterThan(day, date(2024, 1, 1)), LessThanOrEqual(day, date(2024, 1, 2))) == (every[2:4], [])
    assert hours(EqualTo(day, date(2024, 1, 3)))[0] == every[4:] and hours(EqualTo(day, date(2023, 1, 3)))[0] == []
    assert hours(In(day, (date(2024, 1, 1), date(2024, 1, 3))), GreaterThan(day, date(2024, 1, 1)))[0] == every[4:]
    other = [IsNotNull(day), EqualTo(("hour",), 4)]
    assert hours(*other) == (every, other)  # Spark applies what the source does not take


def test_files_are_sampled_and_read_where_they_lie(spark, root):
    names = archive.archived_names(spark, root)
    assert names.count() == 42 and {r.date for r in names.select("date").distinct().collect()} == {date(2024, 1, d) for d in (1, 2, 3)}
    for k in (1, 2, 3, 5, 7, 30):
        picked = archive.archived_snapshots(spark, root, k=k)
        expected = evenly_spaced(with_path_clock(names.select("path")), k)
        assert sorted(r.path for r in picked.collect()) == sorted(r.path for r in expected.collect())
    some = archive.archived_snapshots(spark, root, date(2024, 1, 2), date(2024, 1, 2), k=3)
    rows = decode_snapshots(some).collect()
    good = [r for r in rows if r.error is None]
    assert len(rows) - len(good) == 1 and len(good) == 1 + 4 + 7 + 1 + 7  # files 0, 3 and 6 of two hours, one damaged
    assert {r.header_ts for r in good} == {1000, 1003, 1006}
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert some.rdd.getNumPartitions() == 2 and "snapshot_archive" in plan


def test_names_are_picked_evenly():
    names = list("abcdefgh")
    assert archive.evenly_picked(names, None) == archive.evenly_picked(names, 8) == names
    assert archive.evenly_picked(names, 1) == ["a"] and archive.evenly_picked(names, 2) == ["a", "h"] and archive.evenly_picked([], 3) == []


def test_an_archive_that_is_not_there_has_no_rows(spark, tmp_path):
    assert archive.archived_names(spark, str(tmp_path / "none"), date(2024, 1, 1), date(2024, 1, 3)).count() == 0


SEEN = "ts bigint, trip_id string, route_id string, direction_id int, occupancy string"


def utc(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def test_hours_close_once_and_repeats_do_not_count(spark, tmp_path):
    feed, path, mark = str(tmp_path / "feed"), str(tmp_path / "closed"), str(tmp_path / "mark")

    def arrive(*seen):
        rows = [(utc(f"2024-01-01T{at}:00"), trip, "a", 0, "FULL") for at, trip in seen]
        spark.createDataFrame(rows, SEEN).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(SEEN).option("maxFilesPerTrigger", 1).parquet(feed)
        append_hours(closed_hours(stream, "1 hour"), path, mark, available_now=True).awaitTermination()
        return {r.hour: r.n_obs for r in read_hours(spark, path).collect()}

    assert arrive(("10:05", "x"), ("10:05", "x"), ("10:05", "y")) == {}
    assert arrive(("10:05", "x"), ("10:50", "x"), ("11:20", "x")) == {}  # the hour is open for another hour
    assert arrive(("12:10", "x")) == {11: 3}  # local hour; x twice, y once
    assert arrive(("10:40", "late"), ("14:30", "x")) == {11: 3, 12: 1, 13: 1}
    assert arrive(("14:30", "x")) == {11: 3, 12: 1, 13: 1}


def test_routes_follow_the_map_of_their_month(spark, tmp_path):
    feed, maps, path, mark = (str(tmp_path / n) for n in ("feed", "maps", "counts", "mark"))

    def arrive(month, *seen):
        rows = [(utc(at), trip, route, None, SCORED_STATUSES[0]) for at, trip, route in seen]
        spark.createDataFrame(rows, SEEN).drop("direction_id").coalesce(1).write.mode("append").parquet(feed)
        spark.createDataFrame([(month, "t", f"r{month}", 1)], "month string, trip_id string, route_id string, direction_id int").write.mode("append").parquet(maps)
        stream = spark.readStream.schema("ts bigint, trip_id string, route_id string, occupancy string").parquet(feed)
        upsert_resolved(stream, maps, path, mark, available_now=True).awaitTermination()
        return sorted((str(r.date), r.hour, r.route_id, r.direction_id, r.n_obs) for r in read_hours(spark, path).collect())

    first = [("2024-01-05", 9, "own", 0, 1), ("2024-01-05", 9, "r2024-01", 1, 2)]
    assert arrive("2024-01", ("2024-01-05T08:10:00", "t", ""), ("2024-01-05T08:20:00", "t", ""), ("2024-01-05T08:30:00", "u", "own"), ("2024-01-05T08:30:00", "u", "")) == first
    both = [*first, ("2024-02-05", 9, "r2024-02", 1, 1)]
    assert arrive("2024-02", ("2024-02-05T08:10:00", "t", "")) == both
    again = [("2024-01-05", 9, "own", 0, 1), ("2024-01-05", 9, "r2024-01", 1, 3), both[2]]
    assert arrive("2024-03", ("2024-01-05T08:40:00", "t", "")) == again  # counts of micro-batches add up
    assert spark.read.parquet(path).select("run").distinct().count() == 3
    assert read_hours(spark, path).where(F.col("n_obs") < 1).count() == 0
