"""Connected components of a table of links, by alternating star steps.

Every round is two grouped minima and two joins; a round's links are written to
the shared folder, so the lineage stays short and lost executors cost one round
at most.  Nothing is collected but a count and a checksum.  Before the first
round each task replaces its links by stars, so that a dense group brings as
many rows as it has nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.session import materialize


def smallest_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 the smallest node of their component."""
    label = np.arange(n)
    while len(left):
        # Roots are hooked, not the ends of links, so a link whose ends agree may go: they share a root for good.
        a, b = label[left], label[right]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(onward := label[label], label):
            label = onward
        differ = label[left] != label[right]
        left, right = left[differ], right[differ]
    return label


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a batch as stars around the smallest node."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = smallest_labels(len(nodes), index[: len(a)], index[len(a) :])
        out = np.flatnonzero(label != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(nodes[label[out]])], ["a", "b"])


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step; links are kept as a > b."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.filter(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(lowest, "u")
    other = joined.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return lowest.select(F.col("u").alias("a"), F.col("m").alias("b")).unionAll(other).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a bigint, b bigint`` that is not the smallest of its component.

    ``component`` is the smallest node that links reach.  Repeated links, both
    directions and links to oneself are allowed, links with a NULL are ignored;
    no link gives no row.
    """
    clean = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a").isNull() | F.col("b").isNull()).alias("_n"))
    clean = clean.filter(~F.col("_n") & (F.col("a") != F.col("b"))).select("a", "b")
    now = materialize(clean.mapInArrow(_stars, "a bigint, b bigint").distinct())
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    state = mark(now)
    while state[0]:
        following = materialize(_round(now))
        reached = mark(following)
        now = following
        if reached == state:
            break
        state = reached
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
