"""Weather, calendar, types, joins, splits and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.registry import case
from seatflow.functions.casts import (
    as_text,
    flag,
    nan_as_null,
    narrow_floats,
    narrow_ints,
    smallest_int,
    weather_types,
)
from seatflow.functions.clock import capped_end, date_spine, scoring_window
from seatflow.functions.scores import (
    class_prediction,
    display_bucket,
    display_class,
    display_mean,
    mean_prediction,
)
from seatflow.operators.joins import (
    add_absent_features,
    as_of,
    feature_view,
    fill_weather,
    missing_dates,
    past_rows,
    requested_dates,
    temporal_split,
)
from seatflow.operators.ordering import temporal_cut
from seatflow.operators.quality import check
from seatflow.operators.weather import from_day, future_weather, with_previous_day, with_previous_day_framed
from seatflow.schemas import ALL_FEATURES, WEATHER_FEATURES
from seatflow.sources.weather import read_weather
from seatflow.runtime import fresh_path

WEATHER_NAMES = ", ".join(WEATHER_FEATURES)
SQL_WEATHER_ROWS = f"WITH {b.SQL_WEATHER} SELECT date, CAST(hour AS TINYINT) AS hour, {WEATHER_NAMES} FROM prev_weather"


@case("prev_day_weather", SQL_WEATHER_ROWS)
def prev_day_weather(spark, folder):
    return b.typed_weather(spark, folder).drop("event_time")


@case("prev_day_weather_frame", SQL_WEATHER_ROWS)
def prev_day_weather_frame(spark, folder):
    return weather_types(with_previous_day_framed(b.raw_weather(spark, folder)))


@case("calendar_dim", f"""WITH {b.SQL_CALENDAR}
SELECT date, month, weekday, is_weekend, is_holiday_se, is_workday_se, date || ' 00:00:00' AS event_time FROM calendar""")
def calendar_dim(spark, folder):
    return b.with_text_time(b.typed_calendar(spark, folder))


@case("weather_json_explode", f"""WITH {b.SQL_WEATHER}
SELECT strftime(day, '%Y-%m-%d') AS date, CAST(hour AS INTEGER) AS hour, temperature_2m, precipitation,
  windspeed_10m, cloudcover FROM weather""")
def weather_json_explode(spark, folder):
    rows = b.raw_weather(spark, folder)
    names = ["temperature_2m", "precipitation", "windspeed_10m", "cloudcover"]
    time = F.concat(F.col("date").cast("string"), F.lit("T"), F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00"))
    # one document per day, 24 hours at most
    hours = rows.withColumn("time", time).groupBy("date").agg(
        F.sort_array(F.collect_list(F.struct("time", *names))).alias("hours")
    )
    document = F.struct(*[F.col(f"hours.{n}").alias(n) for n in ["time", *names]])
    path = fresh_path(spark, "weather_json")
    hours.select(F.to_json(F.struct(document.alias("hourly"))).alias("value")).write.text(path)
    return b.with_text_date(read_weather(spark, path, multi_line=False).drop("time"))


@case("missing_dates", f"""WITH {b.SQL_WEATHER}
SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date
FROM generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY) AS s(d)
WHERE CAST(d AS DATE) NOT IN (SELECT day FROM weather)""")
def missing(spark, folder):
    return b.with_text_date(missing_dates(spark, b.raw_weather(spark, folder), "2024-01-01", "2024-02-05"))


@case("requested_dates", """
SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date
FROM generate_series(DATE '1996-02-25', DATE '1996-03-10', INTERVAL 1 DAY) AS s(d)
UNION SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders""")
def requested(spark, folder):
    listed = b.trips(spark, folder).select(F.col("operating_day").alias("date"))
    return b.with_text_date(requested_dates(date_spine(spark, "1996-02-25", "1996-03-10"), listed))


@case("date_cap", """
SELECT CAST(o_custkey % 25 AS VARCHAR) AS route_id, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_date,
  CAST(least(CAST(max(o_orderdate) AS DATE), DATE '1999-12-31') AS VARCHAR) AS last_date
FROM orders GROUP BY 1 HAVING CAST(min(o_orderdate) AS DATE) <= least(CAST(max(o_orderdate) AS DATE), DATE '1999-12-31')""")
def date_cap(spark, folder):
    spans = b.trips(spark, folder).groupBy("route_id").agg(
        F.min("operating_day").alias("first_date"), F.max("operating_day").alias("last_date")
    )
    capped = spans.withColumn("last_date", capped_end(F.col("last_date"), F.lit("2000-01-01").cast("date")))
    return capped.where("first_date <= last_date").select(
        "route_id", F.col("first_date").cast("string").alias("first_date"), F.col("last_date").cast("string").alias("last_date")
    )


@case("scoring_days", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY 1)
SELECT CAST(day AS VARCHAR) AS date, CASE WHEN day < DATE '2024-01-15' THEN 'past' ELSE 'future' END AS type, n_events
FROM d WHERE day BETWEEN DATE '2024-01-12' AND DATE '2024-01-18'""")
def scoring_days(spark, folder):
    counts = b.table(spark, folder, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count("*").alias("n_events"))
    return b.with_text_date(scoring_window(spark, "2024-01-15").join(counts, "date"))


SQL_FEATURES = f"""{b.SQL_HOURLY}, {b.SQL_WEATHER}, {b.SQL_CALENDAR},
typed AS (SELECT {b.sql_typed()} FROM hourly),
features AS (
  SELECT t.*, c.month, c.weekday, c.is_weekend, c.is_holiday_se, c.is_workday_se,
    {', '.join('w.' + c for c in WEATHER_FEATURES)}
  FROM typed t LEFT JOIN calendar c ON c.date = t.date LEFT JOIN prev_weather w ON w.date = t.date AND w.hour = t.hour)"""
PAST_NAMES = (
    "date, hour, route_id, direction_id, avg_occupancy, max_occupancy, month, weekday, is_weekend, "
    "is_holiday_se, is_workday_se"
)
FILLED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in WEATHER_FEATURES)


@case("feature_join", f"WITH {SQL_FEATURES} SELECT {PAST_NAMES}, {FILLED} FROM features")
def feature_join(spark, folder):
    tables = b.typed_hourly, b.typed_calendar, b.typed_weather
    return fill_weather(past_rows(*[t(spark, folder) for t in tables]))


@case("feature_view", f"WITH {SQL_FEATURES} SELECT {', '.join(ALL_FEATURES)}, max_occupancy, event_time FROM features")
def view(spark, folder):
    tables = b.typed_hourly, b.typed_calendar, b.typed_weather
    return b.with_text_time(feature_view(*[t(spark, folder) for t in tables], "max_occupancy"))


@case("asof_feature", """
WITH l AS (SELECT event_id, user_id, CASE WHEN event_id % 50 <> 0 THEN ts END AS ts FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, ts, max_by(event_id, event_id) AS view_id, max_by(value, event_id) AS view_value
  FROM events WHERE event_type = 'view' AND event_id % 40 <> 0 GROUP BY user_id, ts)
SELECT l.event_id, l.user_id, strftime(l.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, r.view_id, r.view_value
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def asof_feature(spark, folder):
    """Some rows of both sides have no time, and so no match."""
    events = b.table(spark, folder, "events")
    timed = lambda every: F.when(F.col("event_id") % every != 0, F.col("ts"))
    left = events.where("event_type = 'purchase'").select("event_id", "user_id", timed(50).alias("ts"))
    right = events.where("event_type = 'view'").select(
        "user_id", timed(40).alias("view_ts"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
    )
    found = as_of(left, right, ["user_id"], "ts", "view_ts", ["view_id", "view_value"], tie=["view_id"])
    return found.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@case("absent_features", f"""WITH {SQL_FEATURES} SELECT date, hour, route_id, direction_id, month, 0 AS cloudcover, 0 AS prev_cloudcover FROM features""")
def absent_features(spark, folder):
    """A frame without two of the feature columns gets them as 0."""
    rows = feature_join(spark, folder).drop("cloudcover", "prev_cloudcover")
    return add_absent_features(rows).select("date", "hour", "route_id", "direction_id", "month", "cloudcover", "prev_cloudcover")


@case("weather_from_day", f"""WITH {b.SQL_WEATHER}
SELECT date, CAST(hour AS TINYINT) AS hour, {WEATHER_NAMES} FROM prev_weather WHERE date >= '2024-01-09'""")
def weather_from_day(spark, folder):
    """Previous-day columns over all days, then without the days before the first wanted one."""
    return weather_types(from_day(with_previous_day(b.raw_weather(spark, folder)), "2024-01-09"))


@case("temporal_split_counts", f"""WITH {b.SQL_HOURLY}
SELECT CASE WHEN date <= '2024-01-20' THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows,
  CAST(sum(n_obs) AS BIGINT) AS n_obs FROM hourly
WHERE date < '2024-01-20' OR (date = '2024-01-20' AND hour <= 12) OR date > '2024-01-21' OR (date = '2024-01-21' AND hour >= 12)
GROUP BY 1""")
def split_counts(spark, folder):
    bounds = ("2000-01-01", "2024-01-20 12:00:00"), ("2024-01-21 12:00:00", "2100-01-01")
    parts = temporal_split(b.typed_hourly(spark, folder), *bounds, inclusive="instant")
    both = [df.withColumn("part", F.lit(name)) for name, df in zip(("train", "test"), parts)]
    return both[0].unionByName(both[1]).groupBy("part").agg(
        F.count("*").alias("n_rows"), F.sum("n_obs").alias("n_obs")
    )


@case("temporal_cut", """
WITH n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS place, count(*) OVER () AS n FROM events),
c AS (SELECT *, CAST(floor(n * 0.3::DOUBLE) AS BIGINT) AS size FROM n)
SELECT event_id, CASE WHEN place < floor(size * 0.8::DOUBLE) THEN 'train' ELSE 'validation' END AS part
FROM c WHERE place < size""")
def cut(spark, folder):
    rows = b.table(spark, folder, "events").select("event_id", "ts")
    return temporal_cut(rows, ["ts", "event_id"]).select("event_id", "part")


def _sql_rules(suite: str, rules: list[tuple[str, str, str]], source: str) -> str:
    lines = [
        f"SELECT '{suite}' AS suite, '{rule}' AS rule, '{column}' AS \"column\", count(*) AS n_rows, "
        f"count(*) FILTER ({broken}) AS n_unexpected, count(*) FILTER ({broken}) = 0 AS success FROM {source}"
        for rule, column, broken in rules
    ]
    return " UNION ALL ".join(lines)


def _nulls(*columns: str) -> list[tuple[str, str, str]]:
    return [("not_null", c, f"{c} IS NULL") for c in columns]


def _range(column: str, low, high=None) -> tuple[str, str, str]:
    return ("between", column, f"{column} < {low}" + (f" OR {column} > {high}" if high is not None else ""))


COUNTS = ["n_obs", "n_empty", "n_many_seats", "n_few_seats", "n_standing", "n_crushed", "n_full"]
SQL_TRAFFIC_RULES = _sql_rules("traffic", [
    *_nulls("date", "route_id", "event_time"), _range("hour", 0, 23), ("in_set", "direction_id", "direction_id NOT IN (0, 1)"),
    *[_range(c, 0) for c in COUNTS], *[_range(f"{c}_occupancy", 0, 5) for c in ("avg", "max", "mode")],
], "altered")


@case("dq_traffic", f"""WITH {b.SQL_HOURLY}, typed AS (SELECT {b.sql_typed()} FROM hourly),
altered AS (SELECT * REPLACE (CASE WHEN route_id = '3' THEN hour + 20 ELSE hour END AS hour,
  CASE WHEN route_id = '7' THEN 2 ELSE direction_id END AS direction_id,
  CASE WHEN route_id = '9' THEN NULL ELSE route_id END AS route_id,
  CASE WHEN hour = 4 THEN -n_full ELSE n_full END AS n_full) FROM typed) {SQL_TRAFFIC_RULES}""")
def dq_traffic(spark, folder):
    route = F.col("route_id")
    altered = b.typed_hourly(spark, folder).withColumns({
        "hour": F.when(route == "3", F.col("hour") + 20).otherwise(F.col("hour")),
        "direction_id": F.when(route == "7", 2).otherwise(F.col("direction_id")),
        "route_id": F.when(route != "9", route),
        "n_full": F.when(F.col("hour") == 4, -F.col("n_full")).otherwise(F.col("n_full")),
    })
    return check(altered, "traffic")


SQL_WEATHER_RULES = _sql_rules("weather", [
    *_nulls("date", "event_time", *WEATHER_FEATURES), _range("hour", 0, 23),
    *[_range(p + c, low, high) for p in ("", "prev_") for c, low, high in (
        ("precipitation", 0, 50), ("windspeed_10m", 0, 100), ("cloudcover", 0, 100), ("temperature_2m", -50, 50))],
], "typed_weather")


@case("dq_weather", f"WITH {b.SQL_WEATHER}, typed_weather AS (SELECT *, date AS event_time FROM prev_weather) {SQL_WEATHER_RULES}")
def dq_weather(spark, folder):
    return check(b.typed_weather(spark, folder), "weather")


SQL_CALENDAR_RULES = _sql_rules("calendar", [
    *_nulls("date", "event_time"), _range("month", 1, 12),
    ("in_set", "weekday", "weekday NOT IN ('Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday')"),
    *[("in_set", c, f"{c} NOT IN (true, false)") for c in ("is_weekend", "is_holiday_se", "is_workday_se")],
], "altered")


@case("dq_calendar", f"""WITH {b.SQL_CALENDAR},
altered AS (SELECT *, date AS event_time FROM (SELECT * REPLACE (CASE WHEN month = 6 THEN month + 7 ELSE month END AS month,
  CASE WHEN weekday = 'Friday' THEN 'fri' ELSE weekday END AS weekday) FROM calendar)) {SQL_CALENDAR_RULES}""")
def dq_calendar(spark, folder):
    altered = b.typed_calendar(spark, folder).withColumns({
        "month": F.when(F.col("month") == 6, 13).otherwise(F.col("month")),
        "weekday": F.when(F.col("weekday") == "Friday", "fri").otherwise(F.col("weekday")),
    })
    return check(altered, "calendar")


@case("type_narrowing", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
  CAST(o_totalprice AS FLOAT) AS o_totalprice, CAST(o_orderstatus = 'O' AS INTEGER) AS is_open,
  'smallint' AS small_type, 'tinyint' AS signed_type, 'int' AS wide_type FROM orders""")
def type_narrowing(spark, folder):
    rows = b.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    rows = narrow_ints(rows, ["o_custkey", "not_there"], "int32")
    rows = as_text(narrow_floats(rows, ["o_totalprice"]), ["o_orderkey"])
    return rows.select(
        "o_orderkey", "o_custkey", "o_totalprice", flag(F.col("o_orderstatus") == "O").alias("is_open"),
        F.lit(smallest_int(0, 255)).alias("small_type"), F.lit(smallest_int(-128, 127)).alias("signed_type"),
        F.lit(smallest_int(0, 65535)).alias("wide_type"),
    )


@case("nan_to_null", "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events")
def nan_to_null(spark, folder):
    value = F.when(F.col("event_id") % 5 == 0, float("nan")).otherwise(F.col("value"))
    return b.table(spark, folder, "events").select("event_id", nan_as_null(value).alias("value"))


@case("future_weather", f"""WITH {b.SQL_WEATHER} SELECT date, CAST(hour AS TINYINT) AS hour, {WEATHER_NAMES}
FROM prev_weather WHERE date BETWEEN '2024-01-20' AND '2024-01-23'""")
def future(spark, folder):
    rows = b.raw_weather(spark, folder)
    days = scoring_window(spark, "2024-01-20").where("type = 'future'")
    return weather_types(future_weather(rows.where("date < '2024-01-20'"), rows.where("date >= '2024-01-20'"), days))


@case("clip_round", """
WITH v AS (SELECT event_id, value / 80 - 0.5 AS x, round_even(value, 0) / 40 AS q FROM events),
c AS (SELECT *, least(greatest(x, 0), 5) AS held, least(q, 5) AS shown FROM v)
SELECT event_id, round_even(held * 100, 0) / 100 AS mean_pred, CAST(round_even(held, 0) AS INTEGER) AS class_pred,
  CAST(least(5, greatest(0, floor(q + 0.5))) AS INTEGER) AS step, CAST(CAST(floor(q + 0.5) AS BIGINT) AS VARCHAR) AS class_text,
  CASE WHEN shown * 4 = floor(shown * 4) AND CAST(shown * 4 AS BIGINT) % 2 = 1
    THEN printf('%.1f', (floor(shown * 10) + 1) / 10) ELSE printf('%.1f', shown) END AS mean_text
FROM c""")
def clip_round(spark, folder):
    x = F.col("value") / 80 - 0.5
    q = F.rint("value") / 40
    return b.table(spark, folder, "events").select(
        "event_id", mean_prediction(x).alias("mean_pred"), class_prediction(x).alias("class_pred"),
        display_bucket(q).alias("step"), display_class(q).alias("class_text"),
        display_mean(F.least(q, F.lit(5.0))).alias("mean_text"),
    )
