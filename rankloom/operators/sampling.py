"""Deterministic sampling and splitting by key hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.hashing import HASH_SPACE, hash32, hash_order
from rankloom.functions.numeric import ratio_below_one
from rankloom.operators.ordering import top_k_per_key


def balanced_sample(
    df: DataFrame,
    key: str,
    row_id: str,
    tag: str = "tag",
    positive: int = 1,
    negative: int = 0,
    cap: int = 7,
    seed: int = 777,
) -> DataFrame:
    """Per key the same number of random positives and negatives, at most ``cap`` each.

    Adds ``label``.  The cap is applied first (map-side), so the balancing
    window sees at most ``2 * cap`` rows per key however active the key is.
    """
    candidates = df.filter(F.col(tag).isin(positive, negative)).withColumn("_h", hash32(seed, row_id))
    kept = top_k_per_key(candidates, [key, tag], [F.asc("_h"), F.asc(row_id)], cap, rank="_rank")
    per_key = Window.partitionBy(key)
    pair_count = F.least(
        F.count_if(F.col(tag) == positive).over(per_key), F.count_if(F.col(tag) == negative).over(per_key)
    )
    return (
        kept.withColumn("_m", pair_count)
        .filter(F.col("_rank") <= F.col("_m"))
        .withColumn("label", (F.col(tag) == positive).cast("int"))
        .drop("_h", "_rank", "_m")
    )


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Total, positives and negatives in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )


def kept_by_downsampling(df: DataFrame, label: str, row_id: Sequence[str], seed: int = 777) -> Column:
    """Whether a row of ``df`` stays: all positives, and negatives with probability positives / negatives.

    Raises when positives are not the minority.
    """
    counts = label_counts(df, label)
    # One row: evaluated once as a scalar subquery, no join.
    limit = counts.select(
        (ratio_below_one(F.col("positives"), F.col("negatives")) * F.lit(float(HASH_SPACE))).alias("limit")
    ).scalar()
    return (F.col(label) == 1) | ((F.col(label) == 0) & (hash32(seed, *row_id) < limit))


def downsample_negatives(df: DataFrame, label: str, row_id: Sequence[str], seed: int = 777) -> DataFrame:
    """The rows that :func:`kept_by_downsampling` keeps, in one scan instead of a union of two."""
    return df.filter(kept_by_downsampling(df, label, row_id, seed))


def split_fold(df: DataFrame, key: Sequence[str], folds: int = 10, seed: int = 777, out: str = "fold") -> DataFrame:
    """Stable fold number 0..folds-1 by key hash; fold 0 is the evaluation share."""
    return df.withColumn(out, F.pmod(hash32(seed, *key), F.lit(folds)).cast("int"))


def split_train_eval(df: DataFrame, key: Sequence[str], folds: int = 10, seed: int = 777):
    """Disjoint and complete (train, eval) pair."""
    marked = split_fold(df, key, folds, seed, out="_fold")
    return marked.filter(F.col("_fold") != 0).drop("_fold"), marked.filter(F.col("_fold") == 0).drop("_fold")


def shuffled(df: DataFrame, key: Sequence[str], seed: int = 777) -> DataFrame:
    """Seeded random order (parallel range sort on the hash)."""
    return df.orderBy(hash_order(seed, *key), *key)


def repeat_epochs(df: DataFrame, epochs: int, out: str = "epoch") -> DataFrame:
    """The whole dataset ``epochs`` times, numbered from 1; one scan."""
    if epochs < 1:
        raise ValueError("epochs must be at least 1")
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(epochs))))
