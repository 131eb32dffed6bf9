"""Looking values up where one of them may hold much of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A value is hot if more than one in so many rows holds it, so there are fewer hot values than that.
SHARE = 1000


def left_join(rows: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """`rows.join(table, on, "left")` for a `table` with one row per value of the column `on`.

    Rows of hot values stay where they are and get theirs from a broadcast of fewer than `SHARE` rows; NULLs, which match
    nothing, are not moved either. All others meet by a shuffle. `rows` is read four times, so it should be at rest;
    `table` has no column of `rows` but `on`. Without rows the result is empty.
    """
    known = rows.where(F.col(on).isNotNull())
    total = known.count()
    hot = known.groupBy(on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") * SHARE > total).select(on)
    hot = [r[0] for r in hot.collect()]  # fewer than `SHARE`
    names = rows.sparkSession.createDataFrame([(value,) for value in hot], rows.select(on).schema)
    parts = [
        rows.where(F.col(on).isNull()).join(F.broadcast(table.limit(0)), on, "left"),
        known.join(F.broadcast(names), on, "left_anti").join(table, on, "left"),
        known.join(F.broadcast(names), on, "left_semi").join(F.broadcast(table.join(F.broadcast(names), on, "left_semi")), on, "left"),
    ]
    return reduce(DataFrame.unionByName, parts if hot else parts[:2])
