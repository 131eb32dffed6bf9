"""Summaries kept per day and merged over any span: quantiles and distinct counts.

The exact forms, `ordering.medians` and `occupancy.coverage`, read every row of the span. Here a day is
summed up once, in a few KB whatever it holds, and a span of days reads one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.schemas import FeatureTable, record

#: Size of the quantile sketches and bits of the distinct-count sketches.
QUANTILE_SIZE, DISTINCT_BITS = 800, 12


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """How far the rank of a quantile may be off, as a share of the rows, with 99 % confidence; merging adds nothing."""
    return 2.296 / size**0.9723


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (bits / 2)


def sketch_table(name: str, numbers: Sequence[str], values: Sequence[str]) -> FeatureTable:
    """The table that `day_sketches` fills, one row a day. It holds a row per day in all, so it has no partitions."""
    schema = record(("text", "date"), ("big", "n"))
    for column in [*(f"{c}_quantiles" for c in numbers), *(f"{c}_distinct" for c in values)]:
        schema = schema.add(column, "binary")
    return FeatureTable(
        name=name, schema=schema, key=["date"],
        comments={"date": "Local calendar day, yyyy-MM-dd", "n": "Rows of the day"},
    )


def day_sketches(rows: DataFrame, numbers: Sequence[str], values: Sequence[str], size: int = QUANTILE_SIZE) -> DataFrame:
    """One row per `date`: its rows, a quantile sketch of each of `numbers`, a distinct-count sketch of each of `values`.

    Sketches are partial aggregates, so a day of any size sends one sketch per task. NULL and NaN count in no sketch.
    """
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    return rows.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count("*").alias("n"),
        *[F.kll_sketch_agg_double(number(c), F.lit(size)).alias(f"{c}_quantiles") for c in numbers],
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(DISTINCT_BITS)).alias(f"{c}_distinct") for c in values],
    )


def span_summary(
    sketches: DataFrame, probabilities: Sequence[float], first: str | None = None, last: str | None = None
) -> DataFrame:
    """One row for the days first..last: `n`, `<number>_quantiles` in the order of `probabilities`, `<value>_distinct`.

    Quantiles are NULL where the span has no numbers; without days `n` and the distinct counts are 0.
    """
    day = F.col("date")
    if first is not None:
        sketches = sketches.where(day >= first)
    if last is not None:
        sketches = sketches.where(day <= last)
    numbers = [c for c in sketches.columns if c.endswith("_quantiles")]
    values = [c for c in sketches.columns if c.endswith("_distinct")]
    merged = sketches.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *[F.kll_merge_agg_double(c).alias(c) for c in numbers],
        *[F.hll_union_agg(c).alias(c) for c in values],
    )
    return merged.select(
        "n",
        *[_quantiles(F.col(c), probabilities).alias(c) for c in numbers],
        *[F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).alias(c) for c in values],
    )


def _quantiles(sketch: Column, probabilities: Sequence[float]) -> Column:
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, wanted))
