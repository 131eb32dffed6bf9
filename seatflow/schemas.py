"""Fixed values of the domain: statuses, columns, schemas, table declarations."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LOCAL_ZONE = "Europe/Stockholm"
SNAPSHOTS_PER_HOUR = 30
LOOKBACK_DAYS = 5
PAST_DAYS = 3
FUTURE_DAYS = 3

# Public realtime-feed status codes, in code order.
STATUS_CODES = {
    0: "EMPTY",
    1: "MANY_SEATS_AVAILABLE",
    2: "FEW_SEATS_AVAILABLE",
    3: "STANDING_ROOM_ONLY",
    4: "CRUSHED_STANDING_ROOM_ONLY",
    5: "FULL",
    6: "NOT_ACCEPTING_PASSENGERS",
    7: "NO_DATA_AVAILABLE",
    8: "NOT_BOARDABLE",
}
# The first six codes are the ordinal scale 0-5; a status off the scale has no score.
SCORED_STATUSES = [STATUS_CODES[code] for code in range(6)]
IGNORED_STATUSES = ["NO_DATA_AVAILABLE", "NOT_BOARDABLE"]
CLASSES = range(6)
CLASS_NAMES = ["EMPTY", "MANY_SEATS", "FEW_SEATS", "STANDING", "CRUSHED", "FULL"]
# Recall weight of each class.
CLASS_WEIGHTS = {0: 1.0, 1: 1.5, 2: 3.0, 3: 5.0, 4: 8.0, 5: 10.0}

COUNT_COLUMNS = ["n_empty", "n_many_seats", "n_few_seats", "n_standing", "n_crushed", "n_full"]
TRAFFIC_KEY = ["route_id", "direction_id", "date", "hour"]
TRAFFIC_COLUMNS = [
    "date", "hour", "route_id", "direction_id", "n_obs", *COUNT_COLUMNS,
    "avg_occupancy", "max_occupancy", "mode_occupancy",
]

WEATHER_MEASURES = ["temperature_2m", "precipitation", "windspeed_10m", "cloudcover"]
PREVIOUS_MEASURES = [f"prev_{name}" for name in WEATHER_MEASURES]

TRAFFIC_FEATURES = ["hour", "route_id", "direction_id"]
WEATHER_FEATURES = WEATHER_MEASURES + PREVIOUS_MEASURES
CALENDAR_FEATURES = ["month", "weekday", "is_weekend", "is_holiday_se", "is_workday_se"]
ALL_FEATURES = TRAFFIC_FEATURES + WEATHER_FEATURES + CALENDAR_FEATURES

CATEGORICAL_FEATURES = ["route_id", "direction_id", "weekday"]
NUMERIC_FEATURES = ["hour", "month", *WEATHER_FEATURES]
BOOLEAN_FEATURES = ["is_weekend", "is_holiday_se", "is_workday_se"]

PAST_COLUMNS = [
    "date", "hour", "route_id", "direction_id", "avg_occupancy", "max_occupancy",
    *CALENDAR_FEATURES, *WEATHER_FEATURES,
]

# Train and test span, both ends named as days.
TRAIN_SPAN = ("2022-10-01", "2025-11-30")
TEST_SPAN = ("2025-12-01", "2026-01-08")
TUNE_FRACTION = 0.30
TUNE_TRAIN_FRACTION = 0.8
TUNE_TRIALS = 30
SEED = 42

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


_TYPES = {
    "text": T.StringType(), "tiny": T.ByteType(), "small": T.ShortType(), "int": T.IntegerType(),
    "big": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "flag": T.BooleanType(),
    "clock": T.TimestampNTZType(),
}


def record(*typed: tuple[str, str]) -> T.StructType:
    """A schema from (type, columns) pairs in order."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for kind, names in typed for name in names.split()])


DATED_TRIPS_CSV = record(("text", "trip_id operating_day_date dated_vehicle_journey_gid journey_number"))
STOP_TIMES_CSV = record(("text", "trip_id arrival_time stop_sequence"))
TRIPS_CSV = record(("text", "trip_id route_id direction_id"))
ROUTES_CSV = record(("text", "route_id route_short_name route_long_name"))
WEATHER_JSON = T.StructType([
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
        T.StructField("windspeed_10m", T.ArrayType(T.DoubleType())),
        T.StructField("cloudcover", T.ArrayType(T.IntegerType())),
    ]))
])
VEHICLES = record(
    ("text", "path"), ("big", "header_ts"), ("flag", "has_vehicle"), ("big", "vehicle_ts"),
    ("text", "trip_id route_id"), ("int", "occupancy_status"), ("text", "error"),
)


@dataclass(frozen=True)
class FeatureTable:
    """A keyed table: types at rest, primary key, optional partition column, comments."""

    name: str
    schema: T.StructType
    key: list[str]
    partition: str | None = None
    comments: dict[str, str] = field(default_factory=dict)

    def described(self) -> T.StructType:
        """The schema with each column's comment as field metadata (K8)."""
        return T.StructType([
            T.StructField(f.name, f.dataType, True, {"comment": self.comments.get(f.name, "")})
            for f in self.schema.fields
        ])


_PER_STATUS = {
    column: f"Sightings whose status was {status}"
    for column, status in zip(COUNT_COLUMNS, SCORED_STATUSES)
}

TRAFFIC = FeatureTable(
    name="traffic",
    schema=record(
        ("text", "date"), ("tiny", "hour"), ("text", "route_id"), ("tiny", "direction_id"), ("small", "n_obs"),
        ("small", " ".join(COUNT_COLUMNS)), ("float", "avg_occupancy"), ("tiny", "max_occupancy"),
        ("big", "mode_occupancy"), ("clock", "event_time"),
    ),
    key=TRAFFIC_KEY,
    partition="date",
    comments={
        "date": "Local calendar day, yyyy-MM-dd",
        "hour": "Local hour, 0 to 23",
        "route_id": "Line the vehicles served",
        "direction_id": "0 or 1, the way the line was run",
        "n_obs": "Scored sightings in the hour",
        **_PER_STATUS,
        "avg_occupancy": "Mean score, 0 to 5, four decimals",
        "max_occupancy": "Highest score seen",
        "mode_occupancy": "Most common score, the lowest one on a tie",
        "event_time": "Local start of the hour",
    },
)

WEATHER = FeatureTable(
    name="weather",
    schema=record(
        ("text", "date"), ("tiny", "hour"),
        ("float", "temperature_2m precipitation windspeed_10m"), ("tiny", "cloudcover"),
        ("float", "prev_temperature_2m prev_precipitation prev_windspeed_10m"), ("tiny", "prev_cloudcover"),
        ("clock", "event_time"),
    ),
    key=["date", "hour"],
    partition="date",
    comments={
        "date": "Local calendar day, yyyy-MM-dd",
        "hour": "Local hour, 0 to 23",
        "temperature_2m": "Air temperature two metres up, degrees Celsius",
        "precipitation": "Rain and snow in the hour, mm",
        "windspeed_10m": "Wind ten metres up, km/h",
        "cloudcover": "Sky covered, percent",
        **{f"prev_{name}": f"{name} one calendar day earlier, same hour" for name in WEATHER_MEASURES},
        "event_time": "Local start of the hour",
    },
)

CALENDAR = FeatureTable(
    name="calendar",
    schema=record(
        ("text", "date"), ("small", "month"), ("text", "weekday"),
        ("flag", "is_weekend is_holiday_se is_workday_se"), ("clock", "event_time"),
    ),
    key=["date"],
    comments={
        "date": "Calendar day, yyyy-MM-dd",
        "month": "Month number",
        "weekday": "English name of the day",
        "is_weekend": "Saturday or Sunday",
        "is_holiday_se": "Public holiday in Sweden",
        "is_workday_se": "Neither weekend nor public holiday",
        "event_time": "Midnight at the start of the day",
    },
)

FEATURE_TABLES = {table.name: table for table in (TRAFFIC, WEATHER, CALENDAR)}
