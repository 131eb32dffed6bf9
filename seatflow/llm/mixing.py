"""Mix sources to target weights by fitting each source's word budget exactly.

A source gets whole copies of all its documents while they fit its target; what remains is a
subset-sum problem over the exact counts of document lengths: a proportional share of every length,
then a bounded-knapsack table over the few words still missing. Documents of a length are chosen in
a seeded order. Only counts by length meet in one task (a source's distinct lengths, not its rows).

NULL and empty texts have size 0 and take 0 words; a NULL source is a source of its own, last in order;
NULL or repeated ids are rows like others; an empty table gives no rows. Other columns are ignored,
apart from `mix`, which keeps them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatflow.runtime import stored

WORD = r"[^\x20\x09-\x0D]+"
MOST_COPIES = 3
ROWS_PER_SLICE = 256


def word_count(text: Column) -> Column:
    """Words of the whole text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """Adds `target` to one row per source (`source`, `source_size`).

    Weights repeat in code-point order of the sources, NULL last. All words are shared by weight, no
    source beyond `most` times its size. What is over goes to the others by weight: with sources in
    order of bound per weight, the level of the unbounded ones is the highest level that any
    number of leading bounded sources leaves.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    order = Window.orderBy(F.col("_bound") / F.col("_weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_bound").over(before), F.lit(0))
    return (
        sources.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int")))
        .withColumn("_bound", F.col("source_size") * most)
        .withColumn("_level", left.cast("double") / F.sum("_weight").over(onward))
        .withColumn("_level", F.max("_level").over(whole))
        .withColumn("target", F.least(F.col("_bound").cast("double"), F.col("_weight") * F.col("_level")))
        .select("source", "source_size", "target")
    )


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the words come to `budget`, or as near below as counts allow.

    Lengths are distinct and positive. A proportional floor is taken of each, then one more of those
    with the largest remainders while they fit; the rest, less than the longest document, is
    filled by a bounded knapsack over the documents still left.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0 or not total:
        return np.zeros_like(counts)
    share = counts * (budget / total)
    taken = np.minimum(np.floor(share).astype(np.int64), counts)
    rest = budget - int((taken * lengths).sum())
    order = np.argsort(taken - share, kind="stable")
    order = order[taken[order] < counts[order]]
    fits = np.cumsum(lengths[order]) <= rest
    taken[order[fits]] += 1
    rest = budget - int((taken * lengths).sum())
    return taken + _knapsack(lengths, counts - taken, rest)


def _knapsack(lengths: np.ndarray, room: np.ndarray, rest: int) -> np.ndarray:
    """Subset-sum over `room[i]` pieces of `lengths[i]`: the largest reachable total up to `rest`."""
    out = np.zeros_like(room)
    if rest <= 0:
        return out
    reached = np.zeros(rest + 1, bool)
    reached[0] = True
    item, times = np.full(rest + 1, -1), np.zeros(rest + 1, np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        left, pieces = min(int(room[i]), rest // int(lengths[i])), 1
        while left > 0 and not reached[rest]:
            pieces = min(pieces, left)
            step = pieces * int(lengths[i])
            fresh = np.flatnonzero(reached[:-step] & ~reached[step:]) + step if step <= rest else np.zeros(0, np.int64)
            reached[fresh], item[fresh], times[fresh] = True, i, pieces
            left, pieces = left - pieces, pieces * 2
        if reached[rest]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at > 0:  # each step goes to a total reached before this piece was looked at
        out[item[at]] += times[at]
        at -= int(times[at] * lengths[item[at]])
    return out


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies and how many documents of each length get one more, for one source."""
    size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    budget = int(np.floor(target + 0.5))
    copies = min(budget // size, MOST_COPIES) if size else 0
    lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    some = lengths > 0
    extra = np.zeros(len(rows), np.int64)
    if copies < MOST_COPIES and size:
        extra[some] = fit_budget(lengths[some], counts[some], budget - copies * size)
    return rows[["source", "size", "source_size", "target"]].assign(copies=copies, extra=extra)


def draw(seed: int) -> Column:
    """The seeded number by which documents of one length are put in order."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def allotted(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Every row of `docs` as (doc_id, source, size, source_size, target, copies): how often the mix takes it."""
    keyed = stored(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            draw(seed).alias("_draw"),
        ),
        "mix-sizes",
    )
    lengths = stored(keyed.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-lengths")
    sources = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    fitted = (
        lengths.join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        .groupBy("source")
        .applyInPandas(_fit_source, "source string, size long, source_size long, target double, copies long, extra long")
    )
    most = lengths.agg(F.max("n")).first()[0] or 0
    slices = -(-most // ROWS_PER_SLICE) or 1  # a length that many documents share is ranked in slices
    keyed = keyed.withColumn("_slice", F.pmod(F.col("_draw"), F.lit(slices)))
    per_slice = keyed.groupBy("source", "size", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("source", "size").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = per_slice.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    plan = (
        per_slice.join(
            fitted.withColumnsRenamed({"source": "_s", "size": "_l"}),
            F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_l")),
        )
        .select(F.col("source").alias("_s"), F.col("size").alias("_l"), F.col("_slice").alias("_k"),
                "source_size", "target", "copies", (F.col("extra") - F.col("_before")).alias("_more"))
    )
    place = F.row_number().over(Window.partitionBy("source", "size", "_slice").orderBy("_draw", "doc_id"))
    return (
        keyed.withColumn("_place", place)
        .join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_l")) & (F.col("_slice") == F.col("_k")))
        .select("doc_id", "source", "size", "source_size", "target", "_draw",
                (F.col("copies") + (F.col("_place") <= F.col("_more")).cast("long")).alias("copies"))
    )


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The documents that the mix takes, all columns kept, with `copies`, how often (1 to 3).

    Rows that agree in id, source and text are alike: the copies of their group go to them in turn.
    """
    alike = F.struct("_draw", "doc_id", "source")
    chosen = allotted(docs, seed).where("copies > 0").withColumn("_key", alike)
    in_turn = Window.partitionBy("_key").orderBy(F.col("copies").desc())
    chosen = chosen.select("_key", F.row_number().over(in_turn).alias("_nth"), "copies")
    columns = [c for c in docs.columns if c != "copies"]
    own = docs.select(F.struct(*columns).alias("_doc"), "doc_id", "source", draw(seed).alias("_draw"))
    own = own.select("_doc", "_draw", alike.alias("_key"))
    own = own.withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy("_draw")))
    return own.join(chosen, ["_key", "_nth"]).select("_doc.*", "copies")
