"""Column expressions, one batch of literals per rule."""

import math
from datetime import date, datetime, timezone
from decimal import ROUND_HALF_UP, Decimal
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from seatflow.functions import casts, clock, scores
from seatflow.schemas import CALENDAR, SCORED_STATUSES, TRAFFIC, WEATHER


def values(spark, rows, ddl, **exprs):
    df = spark.createDataFrame(rows, ddl).select(*[e.alias(n) for n, e in exprs.items()])
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("text,hour", [
    ("08:30:00", 8), ("00:30:00", 0), ("25:03:00", 25), ("26:45:00", 26), ("", 0), ("invalid", 0), (None, 0),
    (" 7:10:00", 7), ("4.5:00", 0),
])
def test_leading_hour(spark, text, hour):
    assert values(spark, [(text,)], "t string", h=clock.leading_hour("t")) == [(hour,)]


@pytest.mark.parametrize("hour,day,expected", [
    (10, "2026-01-11", ("2026-01-11", 10)), (0, "2026-01-11", ("2026-01-11", 0)), (23, "2026-01-11", ("2026-01-11", 23)),
    (24, "2026-01-11", ("2026-01-12", 0)), (25, "2026-01-11", ("2026-01-12", 1)), (26, "2026-01-11", ("2026-01-12", 2)),
    (25, "2026-01-31", ("2026-02-01", 1)), (25, "2025-12-31", ("2026-01-01", 1)),
    (49, "2026-01-11", ("2026-01-12", 23)), (-2, "2026-01-11", ("2026-01-11", 0)),
])
def test_calendar_hour(spark, hour, day, expected):
    h, d = F.col("h"), F.to_date("d")
    got = values(spark, [(hour, day)], "h int, d string", d=clock.calendar_day(h, d).cast("string"), h=clock.calendar_hour(h))
    assert got == [expected]


@pytest.mark.parametrize("first,last,expected", [
    (10, 10, [("2026-01-11", 10)]),
    (6, 9, [("2026-01-11", h) for h in (6, 7, 8, 9)]),
    (23, 26, [("2026-01-11", 23), ("2026-01-12", 0), ("2026-01-12", 1), ("2026-01-12", 2)]),
    (24, 26, [("2026-01-12", 0), ("2026-01-12", 1), ("2026-01-12", 2)]),
    (5, 3, []),
])
def test_hours_of_trip(spark, first, last, expected):
    hours = clock.hours_of_trip(F.col("a"), F.col("b"), F.lit("2026-01-11").cast("date"))
    [(found,)] = values(spark, [(first, last)], "a int, b int", h=hours)
    assert [(str(r["date"]), r["hour"]) for r in found] == expected


def test_dates_and_labels(spark):
    assert values(spark, [("20260111",), ("2026-1-1x",)], "t string", d=clock.compact_date("t")) == [(date(2026, 1, 11),), (None,)]
    assert values(spark, [("1",), ("",), ("x",), (None,), ("0",)], "t string", v=clock.int_or_zero("t")) == [(1,), (0,), (0,), (0,), (0,)]
    day = F.to_date("t")
    assert values(spark, [("2024-02-29",)], "t string", a=clock.month_tag(day), b=clock.month_start(day)) == [("2024-02", date(2024, 2, 1))]
    label = clock.day_label(F.col("t"), "2024-01-02")
    assert values(spark, [("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "t string", v=label) == [("past",), ("today",), ("future",)]
    cap = clock.capped_end(F.to_date("t"), F.lit("2024-01-10").cast("date"))
    assert values(spark, [("2024-01-04",), ("2024-01-12",)], "t string", v=cap) == [(date(2024, 1, 4),), (date(2024, 1, 9),)]


def test_spines_and_windows(spark):
    assert [r.date for r in clock.date_spine(spark, "2024-02-28", "2024-03-01").collect()] == [
        date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert clock.date_spine(spark, "2024-03-01", "2024-02-28").count() == 0
    days = {str(r.date): r.type for r in clock.scoring_window(spark, "2024-01-10").collect()}
    assert len(days) == 7 and days["2024-01-07"] == "past" and days["2024-01-10"] == "future" and days["2024-01-13"] == "future"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Stockholm"])
def test_local_clock_does_not_depend_on_the_session_zone(spark, zone):
    # both clock changes of 2024 and a plain summer hour
    epochs = [1711846799, 1711846800, 1729988999, 1729989000, 1729992600, 1720000000]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        utc = clock.utc_clock("e")
        got = values(
            spark, [(e,) for e in epochs], "e bigint",
            local=clock.local_clock(utc).cast("string"), back=clock.epoch_seconds(utc),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    stockholm = ZoneInfo("Europe/Stockholm")
    for epoch, (local, back) in zip(epochs, got):
        expected = datetime.fromtimestamp(epoch, timezone.utc).astimezone(stockholm)
        assert local == expected.strftime("%Y-%m-%d %H:%M:%S") and back == epoch


def test_event_time(spark):
    rows = [("2023-01-01", 8), ("2023-01-02", 14), ("2023-06-15", 0), ("2023-06-15", 23)]
    df = casts.with_event_time(spark.createDataFrame(rows, "date string, hour int"))
    assert [str(r.event_time) for r in df.collect()] == [
        "2023-01-01 08:00:00", "2023-01-02 14:00:00", "2023-06-15 00:00:00", "2023-06-15 23:00:00"]
    assert dict(df.dtypes)["event_time"] == "timestamp_ntz"
    day = casts.with_event_time(spark.createDataFrame([("2023-03-15",)], "date string"), hour=None)
    assert str(day.first().event_time) == "2023-03-15 00:00:00"


def test_exact_mean_rounds_as_the_binary_quotient_does(spark):
    """All means of 32n observations, where decimal ties occur, against Python's own rounding."""
    pairs = spark.range(1, 26).selectExpr("id * 32 as n").selectExpr("n", "explode(sequence(0L, 5 * n)) as total")
    rows = pairs.select("total", "n", scores.exact_mean("total", "n").alias("m")).toPandas()
    wrong = [r for r in rows.itertuples() if r.m != round(r.total / r.n, 4)]
    assert len(rows) > 50000 and not wrong
    # one exact tie to even, two that binary pushes apart
    got = values(spark, [(1, 32), (1, 160), (3, 160)], "t bigint, n bigint", m=scores.exact_mean("t", "n"))
    assert got == [(0.0312,), (0.0063,), (0.0187 if round(3 / 160, 4) == 0.0187 else 0.0188,)]


def test_statuses(spark):
    codes = [(i,) for i in [*range(9), 9, 42]]
    names = [v for (v,) in values(spark, codes, "c int", s=scores.status_name(F.col("c")))]
    assert names[:6] == SCORED_STATUSES and names[7:] == ["NO_DATA_AVAILABLE", "NOT_BOARDABLE", None, None]
    got = values(spark, [(s,) for s in SCORED_STATUSES + ["NOT_BOARDABLE", "x"]], "s string", v=scores.score_of(F.col("s")))
    assert [v for (v,) in got] == [0, 1, 2, 3, 4, 5, None, None]


def test_predictions(spark):
    rows = [(0.125,), (2.675,), (1.005,), (-3.0,), (7.5,), (float("nan"),), (None,), (2.5,), (3.5,)]
    x = F.col("x")
    got = values(spark, rows, "x double", a=scores.mean_prediction(x), b=scores.class_prediction(x))
    assert [a for a, _ in got] == [0.12, 2.68, 1.0, 0.0, 5.0, None, None, 2.5, 3.5]
    assert [b for _, b in got] == [0, 3, 1, 0, 5, None, None, 2, 4]


def test_display(spark):
    numbers = [i / 100 for i in range(501)] + [0.05, 4.949999, 1e-9]
    got = values(spark, [(v,) for v in numbers], "x double", t=scores.display_mean(F.col("x")))
    assert [t for (t,) in got] == [str(Decimal(v).quantize(Decimal("0.1"), ROUND_HALF_UP)) for v in numbers]
    x = F.col("x")
    got = values(spark, [(0.5,), (2.4999,), (6.0,), (-1.0,), (None,)], "x double",
                 s=scores.display_bucket(x), c=scores.display_class(x), m=scores.display_mean(x))
    assert got == [(1, "1", "0.5"), (2, "2", "2.5"), (5, "6", "6.0"), (0, "-1", "-1.0"), (None, "-", "-")]


def test_weights_and_cost(spark):
    y = F.col("y")
    got = values(spark, [(i,) for i in range(6)], "y int", s=scores.sample_weight(y), c=scores.class_weight(y))
    assert got == [(1.0, 1.0), (1.5, 1.5), (2.0, 3.0), (2.5, 5.0), (3.0, 8.0), (3.5, 10.0)]
    cost = scores.ordinal_cost_term(y, F.col("p"))
    assert values(spark, [(5, 0), (0, 5), (3, 3)], "y int, p int", v=cost) == [(20.0,), (5.0,), (0.0,)]


def test_traffic_types(spark):
    df = spark.createDataFrame(
        [("2023-01-01", 8, 100, 0, 10, 5, 5, 0, 0, 0, 0, 1, 0.5, 1), ("2023-01-01", 9, 200, 1, 20, 10, 10, 0, 0, 0, 0, 1, 0.5, 1)],
        "date string, hour int, route_id int, direction_id int, n_obs int, n_empty int, n_many_seats int, n_few_seats int,"
        " n_standing int, n_crushed int, n_full int, max_occupancy int, avg_occupancy double, mode_occupancy bigint",
    )
    typed = casts.with_event_time(casts.traffic_types(df))
    assert [r.route_id for r in typed.collect()] == ["100", "200"]
    stored = {f.name: f.dataType for f in TRAFFIC.schema.fields}
    assert {f.name: f.dataType for f in typed.schema.fields} == stored


def test_weather_and_calendar_types(spark):
    names = [f.name for f in WEATHER.schema.fields if f.name not in ("date", "event_time")]
    ddl = "date timestamp_ntz, time string, " + ", ".join(f"{n} double" for n in names)
    row = (datetime(2023, 1, 1), "x", *[1.0] * len(names))
    typed = casts.with_event_time(casts.weather_types(spark.createDataFrame([row], ddl)))
    assert {f.name: f.dataType for f in typed.schema.fields} == {f.name: f.dataType for f in WEATHER.schema.fields}
    assert typed.first().date == "2023-01-01"
    months = casts.calendar_types(spark.createDataFrame([(3,)], "month int"))
    assert months.schema["month"].dataType == CALENDAR.schema["month"].dataType


def test_casts(spark):
    df = spark.createDataFrame([(1, 1.5, 7, True)], "a int, b double, c int, f boolean")
    assert dict(casts.narrow_ints(df, ["a", "gone"], "int8").dtypes)["a"] == "tinyint"
    assert dict(casts.narrow_ints(df, ["a"]).dtypes)["a"] == "smallint"
    assert dict(casts.narrow_floats(df, ["b"]).dtypes)["b"] == "float"
    assert casts.as_text(df, ["c"]).first().c == "7"
    assert casts.as_text(spark.createDataFrame([(None,)], "c int"), ["c"]).first().c is None
    assert df.select(casts.flag(F.col("f"))).first()[0] == 1
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        casts.narrow_ints(spark.createDataFrame([(300,)], "a int"), ["a"], "int8").collect()
    assert values(spark, [(float("nan"),), (1.0,), (None,)], "x double", v=casts.nan_as_null(F.col("x"))) == [(None,), (1.0,), (None,)]


@pytest.mark.parametrize("low,high,kind", [
    (0, 255, "smallint"), (-128, 127, "tinyint"), (0, 256, "int"), (0, 65535, "int"), (-129, 127, "smallint"),
    (0, 2**32 - 1, "bigint"), (-1, 2**31 - 1, "int"), (-1, 2**31, "bigint"), (0, 2**32, "bigint"),
])
def test_smallest_int(low, high, kind):
    assert casts.smallest_int(low, high) == kind


def test_narrow_to_range(spark):
    df = spark.createDataFrame([(5,)], "a bigint")
    assert dict(casts.narrow_to_range(df, "a", -5, 5).dtypes)["a"] == "tinyint"
    assert not math.isnan(casts.narrow_to_range(df, "a", 0, 9).first().a)
