"""Weather, calendar, timetable, joins, ordering, rules."""

import bisect
import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seatflow.functions.casts import schedule_types
from seatflow.operators import joins, ordering, quality, schedule
from seatflow.operators.calendar import calendar_between, calendar_features, holidays
from seatflow.operators.weather import (
    from_day,
    future_weather,
    joined_sources,
    with_previous_day,
    with_previous_day_framed,
)
from seatflow.schemas import ALL_FEATURES, CALENDAR, TRAFFIC, WEATHER, WEATHER_FEATURES
from seatflow.sources import timetable
from seatflow.sources.weather import read_weather

WEATHER_DDL = "date date, hour int, temperature_2m double, precipitation double, windspeed_10m double, cloudcover int"


def weather(spark, days, hours=(10, 11)):
    rows = [(d, h, d.day + h / 100, float(h), float(d.day), d.day) for d in days for h in hours]
    return spark.createDataFrame(rows, WEATHER_DDL)


@pytest.mark.parametrize("operator", [with_previous_day, with_previous_day_framed])
def test_previous_day(spark, operator):
    rows = [(date(2023, 1, 1), 10, 10.0, 0.0, 5.0, 50), (date(2023, 1, 1), 11, 11.0, 0.0, 5.0, 50),
            (date(2023, 1, 2), 10, 5.0, 1.0, 10.0, 100), (date(2023, 1, 2), 11, 6.0, 1.0, 10.0, 100)]
    got = {(r.date.day, r.hour): r for r in operator(spark.createDataFrame(rows, WEATHER_DDL)).collect()}
    assert len(got) == 4
    assert got[2, 10].prev_temperature_2m == 10.0 and got[2, 10].prev_precipitation == 0.0
    assert got[1, 10].prev_temperature_2m is None and got[2, 11].prev_cloudcover == 50


def test_previous_day_with_gaps_over_many_chunks(spark):
    days = [date(2023, 1, 1) + timedelta(days=n) for n in range(400) if n % 9 != 4]
    df = weather(spark, days)
    a, b = ([tuple(r) for r in op(df).select(sorted(op(df).columns)).collect()] for op in (with_previous_day, with_previous_day_framed))
    assert sorted(a, key=str) == sorted(b, key=str)
    found = {(r.date, r.hour): r.prev_windspeed_10m for r in with_previous_day(df).collect()}
    assert found == {(d, h): float((d - timedelta(1)).day) if d - timedelta(1) in days else None for d in days for h in (10, 11)}


def test_warm_up_day_and_sources(spark):
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    df = weather(spark, days)
    kept = from_day(with_previous_day(df), "2024-01-02")
    assert kept.count() == 4 and kept.where("prev_cloudcover is null").count() == 0
    history, forecast = df.where("date < '2024-01-02'"), df.where("date >= '2024-01-02'")
    wanted = spark.createDataFrame([(days[1],)], "date date")
    rows = future_weather(history, forecast, wanted).collect()
    assert len(rows) == 2 and all(r.prev_cloudcover == 1 for r in rows)
    assert future_weather(None, forecast, wanted).where("prev_cloudcover is null").count() == 2
    assert future_weather(history, None, wanted) is None and joined_sources(None, None) is None


def test_weather_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text("""{"latitude": 1, "hourly": {
        "time": ["2024-01-01T00:00", "2024-01-01T13:00"], "temperature_2m": [1.5, null], "precipitation": [0, 0.5],
        "windspeed_10m": [3, 4], "cloudcover": [50, 100]}}""")
    (tmp_path / "b.json").write_text('{"hourly": {"time": [], "temperature_2m": []}}')
    (tmp_path / "c.json").write_text('{"error": true}')
    rows = sorted(tuple(r) for r in read_weather(spark, str(tmp_path)).collect())
    assert rows == [
        (datetime(2024, 1, 1, 0), 1.5, 0.0, 3.0, 50, date(2024, 1, 1), 0),
        (datetime(2024, 1, 1, 13), None, 0.5, 4.0, 100, date(2024, 1, 1), 13)]


def test_calendar(spark):
    got = {r.date: r for r in calendar_between(spark, "2023-12-24", "2023-12-31").collect()}
    assert got["2023-12-25"].is_holiday_se and not got["2023-12-25"].is_weekend and not got["2023-12-25"].is_workday_se
    assert not got["2023-12-27"].is_holiday_se and got["2023-12-27"].is_workday_se
    assert got["2023-12-27"].weekday == "Wednesday" and got["2023-12-27"].month == 12
    assert got["2023-12-31"].is_weekend and not got["2023-12-31"].is_holiday_se
    extra = {r.date: r.is_holiday_se for r in calendar_between(spark, "2023-12-24", "2023-12-31", include_sundays=True, include_eves=True).collect()}
    assert extra["2023-12-24"] and extra["2023-12-31"] and not extra["2023-12-30"]
    rows = spark.createDataFrame([(datetime(2024, 6, 6, 12),)], "day timestamp_ntz")
    assert calendar_features(rows, column="day").first().day == "2024-06-06"


def test_holidays_of_any_year(spark):
    """The flag of a day agrees with the list of its year, without any years being named."""
    days = spark.sql("select explode(sequence(date'1900-01-01', date'2100-12-31')) as date")
    for eves in (False, True):
        listed = {r.date.isoformat() for r in holidays(spark, 1900, 2100, include_eves=eves).collect()}
        assert {r.date for r in calendar_features(days, include_eves=eves).where("is_holiday_se").collect()} == listed
    empty = spark.createDataFrame([(None,)], "date string")
    assert calendar_features(empty).first().is_holiday_se is False


def test_repeated_hours_of_a_day(spark):
    """All rows of an hour stay, and a previous one is a row that existed, in both forms."""
    rows = [("2024-01-01", 5, 7.0, 0.0, 1.0, 10), ("2024-01-01", 5, 3.0, 9.0, 1.0, 10), ("2024-01-02", 5, 1.0, 1.0, 1.0, 1), ("2024-01-02", 5, 2.0, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "date string, hour int, temperature_2m double, precipitation double, windspeed_10m double, cloudcover int")
    kept = lambda f: sorted((str(r.date), r.temperature_2m, r.prev_temperature_2m, r.prev_precipitation) for r in f(df).collect())
    assert kept(with_previous_day)[2:] == [("2024-01-02", 1.0, 7.0, 0.0), ("2024-01-02", 2.0, 7.0, 0.0)]
    assert [x[:2] for x in kept(with_previous_day)[:2]] == [("2024-01-01", 3.0), ("2024-01-01", 7.0)]
    key = lambda x: str(x)
    assert sorted(kept(with_previous_day), key=key) == sorted(kept(with_previous_day_framed), key=key)


def test_easter_and_moving_holidays(spark):
    easters = {r.date.year: r.date for r in holidays(spark, 1990, 2040).where("name = 'Easter Sunday'").collect()}
    known = {1990: "04-15", 2000: "04-23", 2008: "03-23", 2011: "04-24", 2024: "03-31", 2025: "04-20", 2026: "04-05", 2038: "04-25"}
    assert {y: easters[y].strftime("%m-%d") for y in known} == known
    by_name = {(r.name, r.date.year): r.date for r in holidays(spark, 2003, 2026, include_eves=True).collect()}
    assert by_name["Midsummer Day", 2024] == date(2024, 6, 22) and by_name["Midsummer Eve", 2026] == date(2026, 6, 19)
    assert by_name["All Saints", 2025] == date(2025, 11, 1) and by_name["All Saints", 2009] == date(2009, 10, 31)
    assert ("Whit Monday", 2004) in by_name and ("Whit Monday", 2005) not in by_name
    assert ("National Day", 2005) in by_name and ("National Day", 2004) not in by_name


# --- timetable ---------------------------------------------------------------------------------

def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_timetable_texts(spark, tmp_path):
    dated = write(tmp_path, "dated.txt", "journey_number,operating_day_date,trip_id\n1,20240102,t1\n1,20240102,t1\n2,20240103,t1\n3,20240105,t2\n4,20240102,\n")
    days = [date(2024, 1, 2), date(2024, 1, 3)]
    active = timetable.read_dated_trips(spark, dated, days)
    assert sorted((r.trip_id, str(r.operating_day)) for r in active.collect()) == [("t1", "2024-01-02"), ("t1", "2024-01-03")]
    trips = write(tmp_path, "trips.txt", "route_id,trip_id,direction_id\nold,t1,0\nr1,t1,1\nr2,t2,x\nr3,t3,\n,t4,1\nr5,,1\n")
    found = sorted(tuple(r) for r in timetable.read_trip_routes(spark, trips).collect())
    assert found == [("t1", "r1", 1), ("t2", "r2", 0), ("t3", "r3", 0)]
    assert [r.trip_id for r in timetable.read_trip_routes(spark, trips, active, "2024-01").collect()] == ["t1"]
    undirected = write(tmp_path, "undirected.txt", "trip_id,route_id\nt1,r1\n")
    assert tuple(timetable.read_trip_routes(spark, undirected).first()) == ("t1", "r1", 0)
    routes = write(tmp_path, "routes.txt", 'route_id,route_short_name,route_long_name\nr1,5,old\nr1,5,"Öst, ""Torget"" - Väst"\nr2,,\n,9,x\n')
    assert sorted(tuple(r) for r in timetable.read_route_names(spark, routes).collect()) == [
        ("r1", "5", 'Öst, "Torget" - Väst'), ("r2", "", "")]


def test_files_with_other_headers_and_stops_without_numbers(spark, tmp_path):
    (tmp_path / "trips").mkdir()
    write(tmp_path / "trips", "a.txt", "trip_id,route_id,direction_id\nA,r1,1\n")
    write(tmp_path / "trips", "b.txt", "route_id,direction_id,trip_id\nr2,0,B\nr9,1,A\n")
    write(tmp_path / "trips", "c d.txt", "\ufefftrip_id,route_id\nC,r3\n")
    got = sorted(tuple(r) for r in timetable.read_trip_routes(spark, str(tmp_path / "trips")).collect())
    assert got == [("A", "r9", 1), ("B", "r2", 0), ("C", "r3", 0)]
    times = write(tmp_path, "times.txt", "trip_id,arrival_time,stop_sequence\n" + "\n".join([
        "t1,09:00:00,2", "t1,08:00:00,1", "t2,07:00:00,", "t2,11:00:00,x", "t3,06:00:00,9", "t3,05:00:00,", "t3,04:00:00,1"]) + "\n")
    bare = write(tmp_path, "bare.txt", "trip_id,arrival_time\nt4,10:00:00\nt4,12:30:00\n")
    stops = timetable.read_stop_times(spark, times).unionByName(timetable.read_stop_times(spark, bare))
    hours = {r.trip_id: (r.first_hour, r.last_hour) for r in schedule.trip_hours(stops).collect()}
    assert hours == {"t1": (8, 9), "t2": (7, 11), "t3": (6, 4), "t4": (10, 12)}
    bounds = {r.trip_id: (int(r.first_arrival[:2]), int(r.last_arrival[:2])) for r in schedule.trip_bounds(stops).collect()}
    assert bounds == hours


STOPS = "trip_id string, arrival_time string, stop_sequence int"


def test_trip_bounds_and_hours(spark):
    rows = [("a", "07:10:00", 2), ("a", "06:50:00", 1), ("a", "25:00:00", 30), ("b", "", 1), ("b", "09:00:00", 2),
            ("c", "09:00:00", 1), ("c", "", 9), ("d", "x", 1), ("d", "05:00:00", 2), ("e", "", 2), ("e", "10:00:00", 1), ("e", "11:00:00", 3)]
    df = spark.createDataFrame(rows, STOPS)
    assert sorted(tuple(r) for r in schedule.trip_bounds(df).collect()) == [
        ("a", "06:50:00", "25:00:00"), ("d", "x", "05:00:00"), ("e", "10:00:00", "11:00:00")]
    assert sorted(tuple(r) for r in schedule.trip_hours(df).collect()) == [("a", 6, 25), ("d", 0, 5), ("e", 10, 11)]


def plain_hours(trips, days):
    out = set()
    for day, route, direction, first, last in trips:
        for h in range(first, last + 1):
            actual = day + timedelta(days=1) if h >= 24 else day
            hour = min(23, max(0, h - 24 if h >= 24 else h))
            if actual in days:
                out.add((str(actual), hour, route, direction))
    return out


def test_active_route_hours_against_a_loop(spark):
    rng = random.Random(5)
    days = [date(2024, 1, d) for d in (10, 11, 13)]
    trips, dated, stops, lines = [], [], [], []
    for n in range(400):
        first = rng.choice([-1, 0, 5, 12, 20, 23, 24, 30, 47, 48, 49, 60])
        last = first + rng.choice([0, 0, 1, 4, 9, 30, -3])
        day, route, direction = rng.choice(days), rng.choice(["r1", "r2", "r9"]), rng.randrange(2)
        trips.append((day, route, direction, first, last))
        dated.append((f"t{n}", day))
        stops += [(f"t{n}", f"{first:02d}:30:00", 1), (f"t{n}", "03:00:00", 2), (f"t{n}", f"{last:02d}:00:00", 3)]
        lines.append((f"t{n}", route, direction))
    dated += [("no-route", days[0]), ("no-stops", days[0])]
    stops += [("no-route", "05:00:00", 1)]
    lines += [("no-stops", "r1", 0)]
    names = spark.createDataFrame([("r1", "1", "One"), ("r2", "2", "Two")], "route_id string, route_short_name string, route_long_name string")
    found = schedule.active_route_hours(
        spark.createDataFrame(dated, "trip_id string, operating_day date"), spark.createDataFrame(stops, STOPS),
        spark.createDataFrame(lines, "trip_id string, route_id string, direction_id int"), names, days)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and {r[:4] for r in rows} == plain_hours(trips, days)
    assert {(r[2], r[4], r[5]) for r in rows} == {("r1", "1", "One"), ("r2", "2", "Two"), ("r9", "", "")}
    summary = {r.route_id: r for r in schedule.schedule_summary(found).collect()}
    expected = sorted(h for d, h, r, k in plain_hours(trips, days) if (d, r, k) == ("2024-01-11", "r1", 1))
    assert summary["r1"].directions[1]["2024-01-11"] == expected and summary["r9"].short_name == ""


def test_hours_after_midnight_of_the_day_before_are_lost(spark):
    dated = timetable.dated_trips(
        spark.createDataFrame([("t", "20240109"), ("t", "20240110")], "trip_id string, operating_day_date string"), ["2024-01-10"])
    stops = spark.createDataFrame([("t", "23:00:00", 1), ("t", "25:00:00", 2)], STOPS)
    lines = spark.createDataFrame([("t", "r", 0)], "trip_id string, route_id string, direction_id int")
    names = spark.createDataFrame([], "route_id string, route_short_name string, route_long_name string")
    rows = schedule.active_route_hours(dated, stops, lines, names, ["2024-01-10"]).collect()
    assert [(r.date, r.hour) for r in rows] == [("2024-01-10", 23)]


# --- joins -------------------------------------------------------------------------------------

def small_tables(spark):
    traffic = spark.createDataFrame(
        [("2024-01-01", 8, "a", 0, 1.5, 3), ("2024-01-02", 8, "a", 0, 2.5, 4), ("2024-01-09", 8, "b", 1, 0.0, 0)],
        "date string, hour int, route_id string, direction_id int, avg_occupancy double, max_occupancy int",
    ).withColumn("event_time", F.lit("2024-01-01 08:00:00").cast("timestamp_ntz"))
    calendar = calendar_between(spark, "2024-01-01", "2024-01-03").withColumn("event_time", F.lit(0))
    air = with_previous_day(weather(spark, [date(2024, 1, 1), date(2024, 1, 2)], (8,))).withColumn(
        "date", F.col("date").cast("string")).withColumn("event_time", F.lit(0))
    return traffic, calendar, air


def test_feature_joins_keep_left_rows(spark):
    traffic, calendar, air = small_tables(spark)
    past = joins.past_rows(traffic, calendar, air)
    assert past.count() == 3 and past.where("month is null").count() == 1
    filled = joins.fill_weather(past)
    assert filled.where("temperature_2m is null or prev_temperature_2m is null").count() == 0
    assert filled.where("month is null").count() == 1
    view = joins.feature_view(traffic, calendar, air, "max_occupancy")
    assert view.columns == [*ALL_FEATURES, "max_occupancy", "event_time"] and view.count() == 3
    assert joins.feature_view(traffic, calendar, air, "max_occupancy", how="inner").count() == 2
    hours = traffic.select("date", "hour", "route_id", "direction_id")
    assert joins.schedule_rows(schedule_types(hours), calendar, air).where("cloudcover is not null").count() == 2
    bare = joins.add_absent_features(joins.fill_weather(joins.schedule_rows(hours, calendar)))
    assert bare.where(" or ".join(f"{c} <> 0" for c in WEATHER_FEATURES)).count() == 0 and bare.count() == 3


def test_dates(spark):
    have = spark.createDataFrame([("2024-01-02",), ("2024-01-02",), ("2023-12-01",)], "date string")
    got = joins.missing_dates(spark, have, "2024-01-01", "2024-01-03").collect()
    assert sorted(str(r.date) for r in got) == ["2024-01-01", "2024-01-03"]
    assert joins.missing_dates(spark, have.limit(0), "2024-01-01", "2024-01-03").count() == 3
    with pytest.raises(RuntimeError):
        joins.missing_dates(spark, have.limit(0), "2024-01-01", "2024-01-03", need_existing=True)
    both = joins.requested_dates(have, spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "date string"))
    assert [str(r.date) for r in both.collect()] == ["2023-12-01", "2024-01-01", "2024-01-02"]


def test_first_wins(spark):
    known = spark.createDataFrame([("a", "A")], "route_id string, name string")
    fresh = spark.createDataFrame([("a", "new"), ("b", "B")], "route_id string, name string")
    assert sorted(tuple(r) for r in joins.first_wins(known, fresh, ["route_id"]).collect()) == [("a", "A"), ("b", "B")]


def test_spans(spark):
    times = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-02 23:00:00", "2024-01-03 00:00:00", "2023-12-31 23:59:59"]
    df = spark.createDataFrame([(t, t[:10]) for t in times], "t string, date string").withColumn("event_time", F.col("t").cast("timestamp_ntz"))
    count = lambda how: joins.in_span(df, "2024-01-01", "2024-01-02", how).count()
    assert (count("day"), count("instant"), count("none")) == (3, 2, 1)
    noon = lambda how: joins.in_span(df, "2023-12-31 23:59:59", "2024-01-02 12:00:00", how).count()
    assert (noon("day"), noon("instant"), noon("none")) == (4, 3, 3)
    train, test = joins.temporal_split(df, ("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-03"))
    assert (train.count(), test.count()) == (1, 3)


def test_as_of_against_a_search(spark):
    rng = random.Random(11)
    base = datetime(2024, 1, 1)
    moment = lambda: base + timedelta(minutes=rng.randrange(0, 60 * 24 * 6, 10))
    # key 0 holds most rows, key 3 has no right rows, NULL keys match nothing
    # and so do NULL times on either side
    left = [(i, rng.choice([0, 0, 0, 1, 2, 3, None]), None if i % 40 == 0 else moment()) for i in range(600)]
    right = [(rng.choice([0, 0, 0, 1, 2, None]), None if n % 30 == 0 else moment(), n) for n in range(300)]
    got = joins.as_of(
        spark.createDataFrame(left, "id int, k int, t timestamp_ntz"), spark.createDataFrame(right, "k int, rt timestamp_ntz, n int"),
        ["k"], "t", "rt", ["n"], tie=["n"])
    found = {r.id: r.n for r in got.collect()}
    assert len(found) == 600 == got.count()
    for i, k, t in left:
        series = sorted((rt, n) for rk, rt, n in right if rk == k and k is not None and rt is not None)
        place = bisect.bisect_right(series, (t, 10**9)) if t else 0
        assert found[i] == (series[place - 1][1] if place else None)


# --- ordering ----------------------------------------------------------------------------------

def test_keep_last_and_first(spark, plan_of):
    rows = [("a", 0, 5, "x"), ("a", 1, 1, "y"), ("a", 1, 0, "z"), ("b", 0, 0, "w")]
    df = spark.createDataFrame(rows, "k string, f int, r int, v string")
    last = ordering.keep_last(df, ["k"], ["f", "r"])
    assert sorted((r.k, r.v) for r in last.collect()) == [("a", "y"), ("b", "w")]
    assert sorted((r.k, r.v) for r in ordering.keep_first(df, ["k"], ["f", "r"]).collect()) == [("a", "x"), ("b", "w")]
    plan = last._jdf.queryExecution().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_ranked_over_a_skewed_group(spark):
    df = spark.range(30000).selectExpr("if(id % 7 = 0, cast(null as string), if(id % 7 < 6, 'hot', 'cold')) as g", "30000 - id as v")
    out = ordering.ranked(df, ["v"], ["g"])
    from pyspark.sql import Window

    w = Window.partitionBy("g").orderBy("v")
    check = out.withColumn("want", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(Window.partitionBy("g")))
    assert check.count() == 30000 and check.where("rank <> want or group_size <> n").count() == 0


@pytest.mark.parametrize("n", [0, 1, 9, 1001])
def test_temporal_cut(spark, n):
    df = spark.range(n).select((n - F.col("id")).alias("t"), "id")
    rows = ordering.temporal_cut(df, ["t", "id"]).collect()
    size = int(n * 0.30)
    assert sorted(r.t for r in rows) == list(range(1, size + 1))
    assert sorted(r.t for r in rows if r.part == "train") == list(range(1, int(size * 0.8) + 1))


def test_temporal_cut_of_equal_keys(spark):
    for keys in ([1] * 10, [1, 2, 2, 2, 2, 2, 3, 3, 4, 5], [1, 1, 1, 2, 2, 2, 2, 2, 2, 2]):
        df = spark.createDataFrame([(t, i) for i, t in enumerate(keys)], "t int, id int")
        for fraction in (0.3, 0.5, 1.0):
            rows = ordering.temporal_cut(df, ["t"], fraction).collect()
            size = int(len(keys) * fraction)
            assert sorted(r.t for r in rows) == keys[:size] and len({r.id for r in rows}) == size
            assert sorted(r.t for r in rows if r.part == "train") == keys[: int(size * 0.8)]


def test_medians_are_exact(spark):
    rng = random.Random(2)
    a = [rng.choice([1.0, 2.0, 3.0, 10.0, 2.5]) for _ in range(501)] + [None, float("nan")]
    b = [rng.random() for _ in range(502)] + [7.0]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    got = {r.feature: r.median for r in ordering.medians(df, ["a", "b"]).collect()}
    assert got == {"a": statistics.median(x for x in a if x is not None and x == x), "b": statistics.median(b)}
    four = spark.createDataFrame([(1,), (2,), (3,), (10,)], "x int")
    assert ordering.medians(four, ["x"]).first().median == 2.5


def test_most_frequent_and_picks(spark):
    df = spark.createDataFrame([("b", True), ("a", None), ("b", False), ("a", False), (None, True)], "c string, f boolean")
    assert {r.feature: r.value for r in ordering.most_frequent(df, ["c", "f"]).collect()} == {"c": "a", "f": "false"}
    trials = spark.createDataFrame([(2, 0.5), (0, 0.7), (1, 0.5), (3, None)], "trial int, score double")
    assert ordering.best_trial(trials, "score").first().trial == 1
    assert ordering.best_trial(trials, "score", maximize=True).first().trial == 0
    rows = spark.range(100)
    one = ordering.example_row(rows, ["id"]).collect()
    assert len(one) == 1 and one == ordering.example_row(rows.repartition(7), ["id"]).collect()
    assert [(r.id, r.place) for r in ordering.preview(rows.repartition(3), ["id"], 3).collect()] == [(0, 1), (1, 2), (2, 3)]
    assert [r.id for r in ordering.by_key(rows.repartition(3), ["id"]).limit(3).collect()] == [0, 1, 2]


def test_route_listing(spark):
    rows = [("1", "10"), ("2", "2"), ("3", "2b"), ("4", "x"), ("5", " 7 a"), ("6", ""), ("7", "-3")]
    df = spark.createDataFrame(rows, "route_id string, short_name string")
    assert [r.route_id for r in ordering.route_listing(df).collect()] == ["7", "6", "4", "2", "3", "5", "1"]


# --- rules -------------------------------------------------------------------------------------

def traffic_row(**changes):
    row = dict(date="2024-01-01", hour=8, route_id="a", direction_id=0, n_obs=1, n_empty=1, n_many_seats=0, n_few_seats=0,
               n_standing=0, n_crushed=0, n_full=0, avg_occupancy=0.0, max_occupancy=0, mode_occupancy=0,
               event_time=datetime(2024, 1, 1, 8))
    return {**row, **changes}


def test_rule_counts(spark):
    assert [len(quality.SUITES[n]) for n in ("traffic", "weather", "calendar")] == [15, 19, 7]
    rows = [traffic_row(), traffic_row(hour=24, route_id=None), traffic_row(hour=None, direction_id=2, avg_occupancy=5.5), traffic_row(n_full=-1)]
    df = spark.createDataFrame(rows, TRAFFIC.schema)
    report = {(r.rule, r["column"]): (r.n_rows, r.n_unexpected, r.success) for r in quality.check(df, "traffic").collect()}
    broken = {k: v[1] for k, v in report.items() if not v[2]}
    assert broken == {("between", "hour"): 1, ("not_null", "route_id"): 1, ("in_set", "direction_id"): 1,
                      ("between", "avg_occupancy"): 1, ("between", "n_full"): 1}
    assert report["not_null", "date"] == (4, 0, True)
    good, bad = quality.split_valid(df, "traffic")
    assert (good.count(), bad.count()) == (1, 3)


def test_policies(spark, caplog):
    wrong = spark.createDataFrame([traffic_row(n_obs=2)], TRAFFIC.schema)
    quality.require_counts(wrong, "warn")
    assert "n_obs" in caplog.text
    with pytest.raises(quality.QualityError):
        quality.require_counts(wrong, "fail")
    bad = spark.createDataFrame([traffic_row(hour=99), traffic_row()], TRAFFIC.schema)
    report, failing = quality.validated(bad, "traffic", "warn")
    assert failing.count() == 1 and report.where("not success").count() == 1
    assert quality.validated(bad.where("hour < 24"), "traffic", "fail")[1] is None
    with pytest.raises(quality.QualityError, match="hour"):
        quality.validated(bad, "traffic", "fail")
    assert set(quality.SUITES) == {TRAFFIC.name, WEATHER.name, CALENDAR.name}
