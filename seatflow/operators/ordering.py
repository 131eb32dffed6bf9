"""Order-dependent operators: last row wins, ranks over any group size, cuts, picks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatflow.runtime import stored
from seatflow.schemas import SEED, SNAPSHOTS_PER_HOUR, TUNE_FRACTION, TUNE_TRAIN_FRACTION

# monotonically_increasing_id() keeps the partition in its high bits, the row in its low 33
_ROW_BITS = 33


def first_per(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Spark keeps one row per key on the map side of the shuffle for this shape of filter
    # (WindowGroupLimit), so a key that holds much of the data does not travel whole.
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in the stated order."""
    return first_per(df, key, [F.col(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the stated order."""
    return first_per(df, key, [F.col(c).asc_nulls_last() for c in order])


def sliced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows range-partitioned on a total order, with their slice and their place in it.

    Stored once, because everything computed per slice must refer to the same cut. The number of
    slices is left to the session, which also joins small ones at run time.
    """
    cut = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    cut = stored(cut.withColumn("_at", F.monotonically_increasing_id()), "sliced")
    return cut.withColumns({
        "_slice": F.shiftright("_at", _ROW_BITS),
        "_at": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    })


def _with_slice_sums(cut: DataFrame, by: Sequence[str], amount: Column) -> DataFrame:
    """Add per row the amount its group has in earlier slices, and in all slices."""
    sums = cut.groupBy(*by, "_slice").agg(F.sum(amount).alias("_n"), F.min("_at").alias("_start"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_slice").alias("_sum_slice"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"),
        "_start",
        F.sum("_n").over(group).alias("group_size"),
    )
    if not by:
        sums = F.broadcast(sums)  # one row per slice, at most spark.sql.shuffle.partitions
    same = [F.col("_slice") == F.col("_sum_slice")]
    same += [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return cut.join(sums, reduce(lambda a, b: a & b, same), "left")


def ranked(df: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add `rank` (from 0) and `group_size` within `by`; `by` + `order` must be a total order.

    A window over a group would sort the whole group in one task. Here rows are range-partitioned
    on (by, order), so a large group spans many slices; a row's rank is its place in the slice plus
    the rows its group has in earlier slices. The sums hold one row per group and slice.
    """
    by = list(by)
    cut = sliced(df, by + [c for c in order if c not in by])
    out = _with_slice_sums(cut, by, F.lit(1))
    rank = F.col("_at") - F.col("_start") + F.col("_earlier")
    return out.select(*df.columns, rank.alias("rank"), "group_size")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 12) -> tuple[DataFrame, Column]:
    """`df` with a whole number per row, and that column: the bits of all `columns`' ranks in turn, highest first.

    Near numbers are near in every column. A column counts by the rank of its value among the distinct ones, spread over
    2**bits steps, so texts and skewed numbers use all bits; NULL ranks first. At most 62 bits in all.
    """
    bits = min(bits, 62 // len(columns))
    for c in columns:
        steps = ranked(df.select(F.col(c).alias("_value")).distinct(), ["_value"])
        step = F.floor(F.col("rank") * (1 << bits) / F.col("group_size")).cast("bigint")
        steps = steps.select("_value", step.alias(f"_step_{c}"))
        df = df.join(steps, F.col(c).eqNullSafe(F.col("_value"))).drop("_value")
    place = F.lit(0).cast("bigint")
    for bit in range(bits):
        for nth, c in enumerate(reversed(columns)):
            here = F.shiftright(f"_step_{c}", bit).bitwiseAND(F.lit(1))
            place = place + F.shiftleft(here, bit * len(columns) + nth)
    df = df.withColumn("_interleaved", place).drop(*[f"_step_{c}" for c in columns])
    return df, F.col("_interleaved")


def medians(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of each column as (feature, median), the mean of the middle two for an even count.

    Equal values are counted first; the middle is then found in a running total over the distinct
    values, sliced like `ranked`, so no column's values meet in one task.
    """
    present = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("value"))
        for c in columns
    ])
    long = rows.select(F.inline(present)).where("value is not null")
    counted = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
    cut = _with_slice_sums(sliced(counted, ["feature", "value"]), ["feature"], F.col("n"))
    inside = Window.partitionBy("feature", "_slice").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_earlier") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    end = F.col("_before") + F.col("n")
    middles = (F.floor((F.col("group_size") - 1) / 2), F.floor(F.col("group_size") / 2))
    hit = [(F.col("_before") <= m) & (m < end) for m in middles]
    middle = cut.withColumn("_before", start).where(hit[0] | hit[1])
    return middle.groupBy("feature").agg(F.avg("value").alias("median"))


def quantiles(rows: DataFrame, by: str, column: str, share: float) -> DataFrame:
    """Exact quantile of `column` in each group of `by` as (by, quantile), between two values the point on the line; sliced like `ranked`."""
    counted = rows.groupBy(by, column).agg(F.count("*").alias("_count"))
    cut = _with_slice_sums(sliced(counted, [by, column]), [by], F.col("_count"))
    inside = Window.partitionBy(by, "_slice").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_before", F.col("_earlier") + F.coalesce(F.sum("_count").over(inside), F.lit(0)))
    place = (F.col("group_size") - 1) * F.lit(share)
    low, high = F.floor(place), F.ceil(place)
    holds = lambda at: (F.col("_before") <= at) & (at < F.col("_before") + F.col("_count"))
    near = cut.where(holds(low) | holds(high)).withColumns({"_to_low": high - place, "_to_high": place - low})
    below, above, down, up = F.min(column), F.max(column), F.min("_to_low"), F.min("_to_high")
    return near.groupBy(by).agg(F.when(up == 0, below).otherwise(down * below + up * above).alias("quantile"))


def most_frequent(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Commonest value of each column as text, (feature, value); the smallest one on a tie."""
    present = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    long = rows.select(F.inline(present)).where("value is not null")
    counted = long.groupBy("feature", "value").agg((-F.count("*")).alias("_less"))
    return keep_first(counted, ["feature"], ["_less", "value"]).drop("_less")


def evenly_spaced(
    files: DataFrame, k: int = SNAPSHOTS_PER_HOUR, by: Sequence[str] = ("date", "hour"), order: str = "path"
) -> DataFrame:
    """k evenly spaced rows per group, both ends included; all rows of a group no larger.

    Place i of k is rank round(i * (n - 1) / (k - 1)), halves to even. A rank is one of them when
    the place just below or above rank * (k - 1) / (n - 1) maps to it. Hours outside 0-23 are
    dropped. k = 1, which has no spacing, takes the first row.
    """
    if "hour" in by:
        files = files.where(F.col("hour").between(0, 23))
    rows = ranked(files, [order], by)
    if k <= 1:
        return rows.where(F.col("rank") < k).drop("rank", "group_size")
    last = F.greatest(F.col("group_size") - 1, F.lit(1))
    place = F.col("rank") * (k - 1) / last
    hits = [F.rint(p * last / F.lit(k - 1)) == F.col("rank") for p in (F.floor(place), F.ceil(place))]
    return rows.where((F.col("group_size") <= k) | hits[0] | hits[1]).drop("rank", "group_size")


def temporal_cut(
    rows: DataFrame,
    order: Sequence[str],
    fraction: float = TUNE_FRACTION,
    train_fraction: float = TUNE_TRAIN_FRACTION,
) -> DataFrame:
    """The first `fraction` of the rows in time order, marked `train` or `validation` in `part`.

    Only the columns of `order` are ranked; the rows themselves are then filtered by the two keys at which the
    parts end. Where rows on both sides of an end have the same key, the rows are ranked instead, so the parts keep their sizes.
    """
    kinds = dict(rows.dtypes)
    keys = ranked(rows.select(*order), order)
    sample = F.floor(F.col("group_size") * F.lit(fraction))
    last, first = sample - 1, F.floor(sample * F.lit(train_fraction))
    place = F.col("rank")
    near = place.isin(last, sample, first - 1, first)
    cuts = keys.where(near).select(
        (place == last).alias("_last"), (place == sample).alias("_after"), (place == first - 1).alias("_before"),
        (place == first).alias("_first"), *[F.col(c).cast("string") for c in order])
    cuts = cuts.collect()  # four rows at most
    key = lambda flag: next((tuple(r[c] for c in order) for r in cuts if r[flag]), None)
    end, middle = key("_last"), key("_first")
    if end is None:
        return rows.where(F.lit(False)).withColumn("part", F.lit("train"))
    if end == key("_after") or middle is not None and middle == key("_before"):
        part = F.when(place < first, "train").otherwise("validation")
        return ranked(rows, order).where(place <= last).withColumn("part", part).drop("rank", "group_size")
    here = F.struct(*order)
    at = lambda values: F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(order, values, strict=True)])
    part = F.lit("train") if middle is None else F.when(here < at(middle), "train").otherwise("validation")
    return rows.where(here <= at(end)).withColumn("part", part)


def by_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows in key order, for a sink that must be sorted (O1, O2)."""
    return df.orderBy(*key)


def preview(df: DataFrame, key: Sequence[str], n: int = 20) -> DataFrame:
    """The first n rows in key order with their place."""
    first = df.orderBy(*key).limit(n)
    return first.withColumn("place", F.row_number().over(Window.orderBy(*key)))


def example_row(df: DataFrame, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """One row chosen by a seeded hash of its key."""
    text = [F.col(c).cast("string") for c in key]
    return df.orderBy(F.md5(F.concat_ws("|", *text, F.lit(str(seed)))), *key).limit(1)


def best_trial(trials: DataFrame, score: str, maximize: bool = False) -> DataFrame:
    """The best-scored trial, the first one on a tie."""
    order = F.col(score).desc_nulls_last() if maximize else F.col(score).asc_nulls_last()
    return trials.orderBy(order, "trial").limit(1)


def listing_number(short_name: Column) -> Column:
    """Leading whole number of a route's short name, 0 when it has none (O3)."""
    return F.coalesce(F.regexp_extract(short_name, r"^\s*([+-]?\d+)", 1).try_cast("bigint"), F.lit(0))


def route_listing(routes: DataFrame) -> DataFrame:
    """Routes by leading number, then by text (O3)."""
    return routes.withColumn("number", listing_number(F.col("short_name"))).orderBy("number", "short_name", "route_id")
