"""Summaries per day against the rows they sum up."""

import random

import pytest
from pyspark.sql import functions as F

from seatflow.operators.sketches import QUANTILE_SIZE, day_sketches, distinct_error, rank_error, span_summary
from seatflow.plans import ingest
from seatflow.runtime import stored
from seatflow.schemas import TRAFFIC
from seatflow.sources.tables import feature_table

KIND = "date string, x double, who string"


def test_merged_days_are_within_the_stated_error(spark):
    rng = random.Random(5)
    rows = [(f"2024-01-{1 + i % 20:02d}", rng.gauss(0, 1) ** 3, f"n{rng.randrange(6000)}") for i in range(30000)]
    kept = stored(day_sketches(spark.createDataFrame(rows, KIND).repartition(7), ["x"], ["who"]), "kept")
    assert kept.count() == 20 and kept.select(F.max(F.length("x_quantiles"))).first()[0] < 40 * QUANTILE_SIZE
    wanted = [0.01, 0.25, 0.5, 0.75, 0.99]
    for first, last in ((None, None), ("2024-01-03", "2024-01-09")):
        here = [r for r in rows if (first or "") <= r[0] <= (last or "9")]
        got = span_summary(kept, wanted, first, last).first()
        assert got.n == len(here)
        for p, value in zip(wanted, got.x_quantiles, strict=True):
            assert abs(sum(r[1] <= value for r in here) / len(here) - p) <= 2 * rank_error()
        names = len({r[2] for r in here})
        assert abs(got.who_distinct - names) <= 4 * distinct_error() * names


def test_gaps_and_empty_spans(spark):
    rows = [("2024-01-01", None, None), ("2024-01-01", float("nan"), "a"), ("2024-01-02", 3.0, "a"), (None, 9.0, "b")]
    kept = day_sketches(spark.createDataFrame(rows, KIND), ["x"], ["who"])
    both = span_summary(kept, [0.0, 1.0], "2024-01-01", "2024-01-02").first()
    assert (both.n, both.x_quantiles, both.who_distinct) == (3, [3.0, 3.0], 1)
    assert tuple(span_summary(kept, [0.5], "2024-01-01", "2024-01-01").first()) == (2, None, 1)
    assert tuple(span_summary(kept, [0.5], "2025-01-01").first()) == (0, None, 0)
    assert span_summary(kept, [0.5]).first().n == 4
    assert day_sketches(spark.createDataFrame([], KIND), ["x"], ["who"]).count() == 0


def test_a_replaced_day_is_summed_up_anew(spark, tmp_path):
    from test_tables import typed

    house = ingest.Warehouse(str(tmp_path / "house"))
    ingest.insert(typed(spark, ("2024-01-01", 1, "a", 1.0), ("2024-01-02", 1, "b", 2.0), ("2024-01-03", 1, "c", 3.0)), TRAFFIC, house)
    ingest.refresh_sketches(spark, house)
    ingest.insert(typed(spark, ("2024-01-02", 1, "b", 4.0), ("2024-01-02", 2, "d", 5.0)), TRAFFIC, house)
    ingest.refresh_sketches(spark, house, spark.createDataFrame([("2024-01-02",)], "date string"))
    ingest.refresh_sketches(spark, house, spark.createDataFrame([], "date string"))
    kept = feature_table(spark, ingest.TRAFFIC_SKETCHES, house.path(ingest.TRAFFIC_SKETCHES))
    got = span_summary(kept, [0.0, 1.0]).first()
    assert (got.n, got.avg_occupancy_quantiles, got.route_id_distinct, got.line_distinct) == (4, [1.0, 5.0], 4, 4)
    assert span_summary(kept, [0.0], "2024-01-02", "2024-01-02").first().avg_occupancy_quantiles == [pytest.approx(4.0)]
