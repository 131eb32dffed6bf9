"""Types at rest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.functions.clock import event_time, iso_date
from seatflow.schemas import COUNT_COLUMNS, PREVIOUS_MEASURES, WEATHER_MEASURES

_INTS = {
    "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint",
    "uint8": "smallint", "uint16": "int", "uint32": "bigint",
}


def _cast_present(df: DataFrame, columns: Iterable[str], to: str) -> DataFrame:
    present = {c: F.col(c).cast(to) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def narrow_ints(df: DataFrame, columns: Iterable[str], target: str = "int16") -> DataFrame:
    """Cast the listed columns that exist; a value that does not fit raises."""
    return _cast_present(df, columns, _INTS[target])


def narrow_floats(df: DataFrame, columns: Iterable[str], target: str = "float32") -> DataFrame:
    """Spark has no half-precision type, so 16 and 32 bits are both FLOAT (P5)."""
    return _cast_present(df, columns, "double" if target == "float64" else "float")


def as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Text columns; NULL stays NULL."""
    return _cast_present(df, columns, "string")


def smallest_int(low: int, high: int) -> str:
    """Spark type for whole numbers low..high: unsigned width first, then signed."""
    for bits in (8, 16, 32):
        if low >= 0 and high < 2**bits:
            return _INTS[f"uint{bits}"]
        if low >= -(2 ** (bits - 1)) and high < 2 ** (bits - 1):
            return _INTS[f"int{bits}"]
    return "bigint"


def narrow_to_range(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.withColumn(column, F.col(column).cast(smallest_int(low, high)))


def flag(value: Column) -> Column:
    """Boolean as 0 or 1."""
    return value.cast("int")


def nan_as_null(value: Column) -> Column:
    """NaN becomes NULL, everything else stays."""
    return F.when(~F.isnan(value), value)


def traffic_types(df: DataFrame) -> DataFrame:
    """Stored types of the hourly traffic table; `mode_occupancy` keeps its width."""
    df = as_text(df, ["route_id"])
    if "date" in df.columns:
        df = df.withColumn("date", iso_date("date"))
    df = narrow_ints(df, ["direction_id", "hour", "max_occupancy"], "int8")
    df = narrow_ints(df, ["n_obs", *COUNT_COLUMNS], "int16")
    return narrow_floats(df, ["avg_occupancy"])


def weather_types(df: DataFrame) -> DataFrame:
    """Stored types of the weather table, without the source's `time`."""
    df = df.drop("time")
    if "date" in df.columns:
        df = df.withColumn("date", iso_date("date"))
    df = narrow_ints(df, ["hour", "cloudcover", "prev_cloudcover"], "int8")
    measures = [c for c in WEATHER_MEASURES + PREVIOUS_MEASURES if not c.endswith("cloudcover")]
    return narrow_floats(df, measures)


def calendar_types(df: DataFrame) -> DataFrame:
    """Stored types of the calendar."""
    return narrow_ints(df, ["month"], "int16")


def schedule_types(df: DataFrame) -> DataFrame:
    """Key types of route-hours before they are joined to features."""
    return as_text(narrow_ints(df, ["hour", "direction_id"], "int32"), ["date", "route_id"])


def with_event_time(df: DataFrame, day: str = "date", hour: str | None = "hour") -> DataFrame:
    """Add `event_time` from the day, and the hour unless it is None (P10)."""
    return df.withColumn("event_time", event_time(day, hour))
