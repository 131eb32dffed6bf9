"""Column rules checked in one pass, and what to do with rows that fail (Q1-Q8)."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from seatflow.operators.occupancy import counts_agree
from seatflow.schemas import COUNT_COLUMNS, PREVIOUS_MEASURES, WEATHER_MEASURES, WEEKDAYS

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Rule:
    """One column rule; a NULL breaks only a `not_null` rule."""

    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()

    def broken(self) -> Column:
        column = F.col(self.column)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "in_set":
            return F.coalesce(~column.isin(list(self.allowed)), F.lit(False))
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (column < self.low)
        if self.high is not None:
            outside = outside | (column > self.high)
        return F.coalesce(outside, F.lit(False))


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def between(column: str, low: float | None = None, high: float | None = None) -> Rule:
    return Rule("between", column, low, high)


def in_set(column: str, *allowed) -> Rule:
    return Rule("in_set", column, allowed=allowed)


# The rules of each feature table.
TRAFFIC_RULES = [
    not_null("date"), between("hour", 0, 23), not_null("route_id"), in_set("direction_id", 0, 1),
    between("n_obs", 0), *[between(c, 0) for c in COUNT_COLUMNS],
    between("avg_occupancy", 0, 5), between("max_occupancy", 0, 5), between("mode_occupancy", 0, 5),
    not_null("event_time"),
]
_WEATHER_BOUNDS = {
    "precipitation": (0, 50), "windspeed_10m": (0, 100), "cloudcover": (0, 100), "temperature_2m": (-50, 50),
}
WEATHER_RULES = [
    not_null("date"), between("hour", 0, 23),
    *[not_null(c) for c in WEATHER_MEASURES + PREVIOUS_MEASURES],
    *[between(p + c, *bounds) for c, bounds in _WEATHER_BOUNDS.items() for p in ("", "prev_")],
    not_null("event_time"),
]
CALENDAR_RULES = [
    not_null("date"), between("month", 1, 12), in_set("weekday", *WEEKDAYS),
    *[in_set(c, True, False) for c in ("is_weekend", "is_holiday_se", "is_workday_se")],
    not_null("event_time"),
]
SUITES = {"traffic": TRAFFIC_RULES, "weather": WEATHER_RULES, "calendar": CALENDAR_RULES}


def tallies(rules: Sequence[Rule]) -> list[Column]:
    """Rows seen, and rows that break each rule, as aggregates to select or to observe."""
    broken = [F.count(F.when(rule.broken(), 1)).alias(f"r{i}") for i, rule in enumerate(rules)]
    return [F.count("*").alias("n_rows"), *broken]


def check(rows: DataFrame, suite: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """One row per rule: rows seen, rows that break it, success. All rules share one aggregation."""
    rules = SUITES[suite] if rules is None else rules
    return _report(rows.agg(*tallies(rules)), suite, rules)


def report_of(spark: SparkSession, seen: Row, suite: str) -> DataFrame:
    """The report of `check` from tallies that a write has taken."""
    names = ["n_rows", *[f"r{i}" for i in range(len(SUITES[suite]))]]
    counted = spark.createDataFrame([tuple(seen[n] for n in names)], ", ".join(f"{n} long" for n in names))
    return _report(counted, suite, SUITES[suite])


def _report(counted: DataFrame, suite: str, rules: Sequence[Rule]) -> DataFrame:
    lines = F.array(*[
        F.struct(F.lit(r.kind).alias("rule"), F.lit(r.column).alias("column"), F.col(f"r{i}").alias("n_unexpected"))
        for i, r in enumerate(rules)
    ])
    return counted.select("n_rows", F.inline(lines)).select(
        F.lit(suite).alias("suite"), "rule", "column", "n_rows", "n_unexpected",
        (F.col("n_unexpected") == 0).alias("success"),
    )


def split_valid(rows: DataFrame, suite: str) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the others for quarantine (Q8)."""
    broken = reduce(lambda a, b: a | b, [rule.broken() for rule in SUITES[suite]])
    return rows.where(~broken), rows.where(broken)


class QualityError(ValueError):
    """A check failed where the policy is to stop."""


def _handle(message: str, mode: str) -> None:
    if mode == "fail":
        raise QualityError(message)
    log.warning(message)


def require_counts(rows: DataFrame, mode: str = "warn") -> None:
    """Counts that do not add up stop a backfill and only warn in the daily job (Q7)."""
    require(counts_agree(rows).first().valid, mode)


def require(valid: bool, mode: str = "warn") -> None:
    """`require_counts` for an answer that a write has taken."""
    if not valid:
        _handle("status counts do not add up to n_obs", mode)


def validated(rows: DataFrame, suite: str, mode: str = "warn") -> tuple[DataFrame, DataFrame | None]:
    """The suite's report over rows at rest, and the rows that break a rule if there are any (Q8)."""
    seen = rows.agg(*tallies(SUITES[suite])).first()
    return report_of(rows.sparkSession, seen, suite), failing_rows(rows, seen, suite, mode)


def failing_rows(rows: DataFrame, seen: Row, suite: str, mode: str = "warn") -> DataFrame | None:
    """Before an insert: the rows that break a rule, if the tallies `seen` of these rows count any (Q8).

    "warn" logs the failing columns, "fail" raises. The rows are read only if there is something to find.
    """
    failed = [rule.column for i, rule in enumerate(SUITES[suite]) if seen[f"r{i}"]]
    if not failed:
        return None
    _handle(f"{suite}: rules broken on {', '.join(failed)}", mode)
    return split_valid(rows, suite)[1]
