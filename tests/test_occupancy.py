"""Sightings, sampling, hourly aggregation."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from seatflow.operators.occupancy import (
    counts_agree,
    coverage,
    date_range,
    hourly_from_trips,
    hourly_occupancy,
    resolve_routes,
    usable_sightings,
    wrong_counts,
)
from seatflow.operators.ordering import evenly_spaced
from seatflow.schemas import SCORED_STATUSES, VEHICLES
from seatflow.sources.snapshots import (
    decode_snapshots,
    feed_message,
    list_snapshots,
    path_date,
    path_hour,
    read_chosen,
    snapshots_by_hour,
)

STOCKHOLM = ZoneInfo("Europe/Stockholm")
SEEN = "ts bigint, route_id string, direction_id int, occupancy string"


def utc(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def expected_hours(rows):
    """Hourly rows by a plain loop."""
    groups = defaultdict(list)
    for ts, route, direction, status in rows:
        if status in SCORED_STATUSES:
            local = datetime.fromtimestamp(ts, timezone.utc).astimezone(STOCKHOLM)
            groups[local.date(), local.hour, route, direction].append(SCORED_STATUSES.index(status))
    out = []
    for key, found in groups.items():
        counts = [found.count(s) for s in range(6)]
        common = min(s for s, n in Counter(found).items() if n == max(counts))
        out.append((*key, len(found), *counts, round(sum(found) / len(found), 4), max(found), common))
    return sorted(out)


def test_hourly_occupancy_against_a_loop(spark):
    rng = random.Random(7)
    start = utc("2024-10-26T20:00:00")
    rows = [
        (start + rng.randrange(12 * 3600), str(rng.randrange(3)), rng.randrange(2),
         rng.choice(SCORED_STATUSES + ["NOT_ACCEPTING_PASSENGERS", "NO_DATA_AVAILABLE"]))
        for _ in range(4000)
    ]
    got = hourly_occupancy(spark.createDataFrame(rows, SEEN)).collect()
    assert sorted(tuple(r) for r in got) == expected_hours(rows)


def test_ties_means_and_the_repeated_hour(spark):
    tie = [(utc("2024-03-01T10:00:00"), "a", 0, s) for s in ("FULL", "EMPTY", "FULL", "EMPTY")]
    thin = [(utc("2024-03-01T11:00:00"), "a", 0, "MANY_SEATS_AVAILABLE")] + [
        (utc("2024-03-01T11:00:01"), "a", 0, "EMPTY")] * 31
    autumn = [(utc("2024-10-27T00:30:00"), "a", 0, "FULL"), (utc("2024-10-27T01:30:00"), "a", 0, "EMPTY")]
    rows = {(str(r.date), r.hour): r for r in hourly_occupancy(spark.createDataFrame(tie + thin + autumn, SEEN)).collect()}
    assert rows["2024-03-01", 11].mode_occupancy == 0 and rows["2024-03-01", 11].max_occupancy == 5
    assert rows["2024-03-01", 12].avg_occupancy == 0.0312
    assert rows["2024-10-27", 2].n_obs == 2 and len(rows) == 3


def test_only_sightings_of_the_archive_day_count(spark):
    rows = [(utc("2024-01-01T22:59:59"), "a", 0, "FULL", "2024-01-01"), (utc("2024-01-01T23:00:00"), "a", 0, "EMPTY", "2024-01-01")]
    df = spark.createDataFrame(rows, SEEN + ", day string").withColumn("day", F.to_date("day"))
    [row] = hourly_occupancy(df, archive_date="day").collect()
    assert (row.hour, row.n_obs, row.max_occupancy) == (23, 1, 5)


def vehicle(path="p", header=100, has=True, ts=50, trip="t1", route="r", status=5, error=None):
    return path, header, has, ts, trip, route, status, error


def test_usable_sightings(spark):
    rows = [
        vehicle(), vehicle(ts=None), vehicle(ts=None, header=0), vehicle(ts=None, header=None), vehicle(ts=0),
        vehicle(has=False), vehicle(status=None), vehicle(status=7), vehicle(status=8), vehicle(status=6), vehicle(status=12),
    ]
    df = spark.createDataFrame(rows, VEHICLES)
    assert sorted((r.ts, r.occupancy) for r in usable_sightings(df).collect()) == [
        (0, "FULL"), (50, "FULL"), (50, "NOT_ACCEPTING_PASSENGERS"), (100, "FULL")]
    only_full = usable_sightings(df, ignored=["FULL"])
    assert {r.occupancy for r in only_full.collect()} == {"NO_DATA_AVAILABLE", "NOT_BOARDABLE", "NOT_ACCEPTING_PASSENGERS"}


TRIPS = [("2024-01", "t1", "m1", 1), ("2024-01", "t2", "m2", 0), ("2024-02", "t1", "n1", 0)]
TRIP_DDL = "month string, trip_id string, route_id string, direction_id int"


def test_route_resolution_rules(spark):
    trips = spark.createDataFrame(TRIPS, TRIP_DDL)
    rows = [
        (1, "2024-01", "t1", "feed"), (2, "2024-01", "gone", "feed"), (3, "2024-01", "", "feed"), (4, "2024-01", "t1", ""),
        (5, "2024-02", "t1", None), (6, "2024-01", "gone", ""), (7, "2024-01", None, None), (8, "2024-03", "t1", ""),
    ]
    df = spark.createDataFrame(rows, "ts bigint, month string, trip_id string, route_id string")
    got = {r.ts: (r.route_id, r.direction_id) for r in resolve_routes(df, trips).collect()}
    assert got == {1: ("feed", 1), 2: ("feed", 0), 3: ("feed", 0), 4: ("m1", 1), 5: ("n1", 0)}


def test_join_after_counting_equals_join_before(spark):
    rng = random.Random(3)
    start = utc("2024-01-10T00:00:00")
    rows = [
        (start + rng.randrange(20 * 3600), rng.choice(["t1", "t1", "t1", "t2", "gone", "", None]),
         rng.choice(["", "f1", None]), rng.choice(SCORED_STATUSES), None) for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "ts bigint, trip_id string, route_id string, occupancy string, error string")
    df = df.withColumn("archive_date", F.lit("2024-01-10").cast("date"))
    trips = spark.createDataFrame(TRIPS, TRIP_DDL)
    before = resolve_routes(df.withColumn("month", F.lit("2024-01")), trips)
    a = sorted(tuple(r) for r in hourly_occupancy(before, archive_date="archive_date").collect())
    b = sorted(tuple(r) for r in hourly_from_trips(df, trips).collect())
    assert a == b and len(a) > 40


def chosen(n, k):
    if n <= k:
        return list(range(n))
    return sorted({round(i * (n - 1) / (k - 1)) for i in range(k)})


def test_evenly_spaced_against_the_formula(spark):
    sizes = {h: n for h, n in enumerate([1, 3, 5, 10, 29, 30, 31, 59, 100, 137, 240, 399])}
    rows = [("2024-01-01", h, f"/d/{i:05d}.pb", i) for h, n in sizes.items() for i in range(n)]
    rows += [("2024-01-01", 24, "/d/x.pb", 0), ("2024-01-01", None, "/d/y.pb", 0)]
    df = spark.createDataFrame(rows, "date string, hour int, path string, i int").repartition(5)
    for k in (2, 5, 30):
        got = defaultdict(list)
        for r in evenly_spaced(df, k).collect():
            got[r.hour].append(r.i)
        assert {h: sorted(v) for h, v in got.items()} == {h: chosen(n, k) for h, n in sizes.items()}
    assert {(r.hour, r.i) for r in evenly_spaced(df, 1).collect()} == {(h, 0) for h in sizes}


def test_evenly_spaced_with_one_hour_holding_most_files(spark):
    df = spark.range(20000).selectExpr(
        "'2024-01-01' as date", "if(id % 10 = 0, 5, 8) as hour", "lpad(cast(id as string), 8, '0') as path")
    got = evenly_spaced(df, 30).groupBy("hour").agg(F.count("*").alias("n"), F.min("path").alias("lo"), F.max("path").alias("hi"))
    found = {r.hour: (r.n, int(r.lo), int(r.hi)) for r in got.collect()}
    assert found == {5: (30, 0, 19990), 8: (30, 1, 19999)}


def test_path_clock(spark):
    paths = [(f"/data/2025/01/15/{h}/x.pb",) for h in ("00", "08", "09", "12", "23")] + [("/data/x/y.pb",)]
    df = spark.createDataFrame(paths, "path string")
    assert [r[0] for r in df.select(path_hour("path")).collect()] == [0, 8, 9, 12, 23, None]
    assert [str(r[0]) for r in df.select(path_date("path")).collect()] == ["2025-01-15"] * 5 + ["None"]
    odd = spark.createDataFrame([("2025/01/15/08/x.pb",), ("/a/2025/13/15/08/x.pb",), ("x.pb",)], "path string")
    assert [str(r[0]) for r in odd.select(path_date("path")).collect()] == ["2025-01-15", "None", "None"]


def feed(entities, header=1000):
    message = feed_message()()
    if header is not None:
        message.header.timestamp = header
    for number, fields in enumerate(entities):
        entity = message.entity.add(id=str(number))
        if fields is None:
            continue
        entity.vehicle.SetInParent()
        for name, value in fields.items():
            target = entity.vehicle.trip if name in ("trip_id", "route_id") else entity.vehicle
            setattr(target, name, value)
    return message.SerializeToString()


def test_listing_sampling_and_decoding_files(spark, tmp_path, plan_of):
    for hour, n in ((8, 2), (9, 1), (12, 7)):
        folder = tmp_path / f"2025/01/15/{hour:02d}"
        folder.mkdir(parents=True)
        for i in range(n):
            (folder / f"{i:02d}.pb").write_bytes(feed([{"trip_id": "t", "route_id": "r", "timestamp": i, "occupancy_status": 2}]))
    (tmp_path / "2025/01/15/12/readme.txt").write_text("no")
    (tmp_path / "2025/01/15/08/01.pb").write_bytes(b"\xff\xff\xff broken")
    listing = list_snapshots(spark, str(tmp_path))
    assert {(str(r.date), r.hour): r.n_files for r in snapshots_by_hour(listing).collect()} == {
        ("2025-01-15", 8): 2, ("2025-01-15", 9): 1, ("2025-01-15", 12): 7}
    assert "content" not in plan_of(listing)
    rows = read_chosen(spark, evenly_spaced(listing, 3)).collect()
    assert sorted(r.path[-8:] for r in rows) == ["08/00.pb", "08/01.pb", "09/00.pb", "12/00.pb", "12/03.pb", "12/06.pb"]
    [bad] = [r for r in rows if r.error]
    assert bad.path.endswith("08/01.pb") and bad.has_vehicle is False
    assert read_chosen(spark, listing.where("hour = 3")).count() == 0


def test_decoded_fields(spark):
    content = feed([None, {}, {"timestamp": 0, "occupancy_status": 0}, {"trip_id": "t", "occupancy_status": 3}])
    empty = feed([{"occupancy_status": 1}], header=0)
    df = spark.createDataFrame([("a", bytearray(content)), ("b", bytearray(empty)), ("c", bytearray(b""))], "path string, content binary")
    rows = [tuple(r)[1:7] for r in decode_snapshots(df).collect()]
    assert rows == [
        (1000, False, None, "", "", None), (1000, True, None, "", "", None), (1000, True, 0, "", "", 0),
        (1000, True, None, "t", "", 3), (None, True, None, "", "", 1),
    ]


COUNTS = "n_obs int, n_empty int, n_many_seats int, n_few_seats int, n_standing int, n_crushed int, n_full int"


@pytest.mark.parametrize("rows,valid,n", [
    ([(10, 5, 5, 0, 0, 0, 0), (20, 10, 5, 0, 0, 0, 0)], False, 1),
    ([(10, 5, 5, 0, 0, 0, 0), (20, 10, 10, 0, 0, 0, 0)], True, 0),
    ([(5, 5, None, 0, 0, 0, 0)], True, 0), ([(None, 0, 0, 0, 0, 0, 0)], False, 1), ([], True, 0),
])
def test_counts_agree(spark, rows, valid, n):
    df = spark.createDataFrame(rows, COUNTS)
    assert tuple(counts_agree(df).first()) == (valid, n)
    assert wrong_counts(df).count() == n
    assert counts_agree(df.drop("n_full")).first().valid is False


def test_coverage_and_range(spark):
    rows = [("2024-01-03", "a", 0), ("2024-01-01", "a", 1), ("2024-01-02", "b", 0), ("2024-01-02", "b", 0)]
    df = spark.createDataFrame(rows, "date string, route_id string, direction_id int")
    assert tuple(coverage(df).first()) == (2, 3)
    assert [str(d) for d in date_range(df).first()] == ["2024-01-01", "2024-01-03"]
    assert tuple(coverage(df.limit(0)).first()) == (0, 0)


def test_arrivals_come_as_the_same_number_of_files_each(spark, tmp_path):
    """Spans of days with many, few and no sightings: a micro-batch that takes that many files takes one span."""
    import glob
    import os
    from datetime import datetime, timedelta

    from checks import streams

    start = datetime(2024, 1, 1)
    days = [0] * 1200 + [1, 2, 2] + [8, 8] + [12] * 30  # no sighting in the second span of four days
    events = [(i, start + timedelta(days=d, minutes=i % 1440), i % 50, "view", 1.0) for i, d in enumerate(days)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    path, files = streams._arrivals(spark, str(tmp_path)), streams._files(spark)
    found = sorted(glob.glob(f"{path.removeprefix('file://')}/part-*"), key=os.path.getmtime)
    assert len(found) == 4 * files > 4
    got = [sorted(r.event_id for r in spark.read.parquet(*found[k : k + files]).collect()) for k in range(0, len(found), files)]
    want = [[] for _ in range(7)]
    for i, d in enumerate(days):
        for span, event, here in ((d // 4, i, True), (d // 4, i, i % 5 == 0), (d // 4 + 1, i, i % 5 == 0), (d // 4 + 3, i + 10**9, i % 7 == 0)):
            want[span] += [event] if here else []
    assert got == [sorted(events) for events in want[:4]]
