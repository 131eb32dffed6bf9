"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.runtime import stored

#: Links (16 bytes each) that one task joins up by itself.
LAST_LINKS = 1_000_000


def joined_up(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, least vertex of each one's component), by hooking and pointer jumping."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(names))
    while True:
        x, y = label[left], label[right]
        if (x == y).all():
            return names, names[label]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        vertices, least = joined_up(*(np.concatenate(c) for c in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(vertices), pa.array(least)], ["v", "to"])


def _contracted(links: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """(moves, links left) of one round: every vertex goes to the least of itself and its neighbours."""
    order = lambda c: F.struct(F.xxhash64(F.lit(turn), c), c.alias("v"))
    both = links.union(links.select("b", "a"))
    moves = both.groupBy("a").agg(F.min(order(F.col("b"))).alias("_to"))
    moves = stored(moves.select(F.col("a").alias("v"), F.least(F.col("_to"), order(F.col("a"))).getField("v").alias("to")), "moves")
    at = lambda end: moves.select(F.col("v").alias(end), F.col("to").alias(f"_{end}"))
    left = links.join(at("a"), "a").join(at("b"), "b").where("_a <> _b")
    return moves, stored(left.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(v, label) for every vertex of `links` (a long, b long); a label is one of the component's vertices.

    In each round every vertex moves to the least of itself and its neighbours, in an order drawn
    anew, and the links are carried over to where their ends went, which halves the vertices or better. When no more
    links are left than a task may hold, one task joins these up. Rounds are written out, so a lost
    executor costs a re-read.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels, turn, done = None, 0, False
    while not done:
        done = links.count() <= LAST_LINKS
        if done:
            moves = stored(links.coalesce(1).mapInArrow(_last, "v long, to long"), "moves")
        else:
            moves, links = _contracted(links, turn)
        if labels is None:
            labels = moves.withColumnRenamed("to", "label")
        else:
            onward = moves.select(F.col("v").alias("label"), "to")
            labels = labels.join(onward, "label", "left").select("v", F.coalesce("to", "label").alias("label"))
        turn += 1
    return stored(labels, "labels")
