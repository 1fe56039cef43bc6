"""Lookups of a dimension that is unique by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.skew import BROADCAST_ROWS, broadcast_if_small, fits_broadcast, hot_keys
from rankloom.session import bucketed, materialize

HOT_ROWS = 5_000_000


def dimension_join(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    fits: bool | None = None,
) -> DataFrame:
    """Add the non-key columns of ``dim``; ``on`` pairs (left, dim) key columns.

    A dimension of at most ``max_rows`` rows (and a bounded size) is broadcast;
    it is measured first, so pass a stored table.  A larger one is shuffled on
    the key, except for keys with more than ``hot_rows`` rows on the left:
    there are at most ``rows / hot_rows`` of those, so their dimension rows are
    broadcast and their left rows stay where they are.  Rows without a key
    cannot match and are kept out of the shuffle as well.
    ``fits`` hands over the result of a size check that was already made.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    dim_keys = [d for _, d in on]
    values = [c for c in dim.columns if c not in dim_keys]
    lefts = [left for left, _ in on]
    right = dim.select(*[F.col(d).alias(f"_k{i}") for i, d in enumerate(dim_keys)], *values)

    def joined(left: DataFrame, side: DataFrame, kind: str) -> DataFrame:
        cond = F.col(lefts[0]) == F.col("_k0")
        for i, name in enumerate(lefts[1:], start=1):
            cond = cond & (F.col(name) == F.col(f"_k{i}"))
        return left.join(side, cond, kind).select(*df.columns, *values)

    if fits if fits is not None else fits_broadcast(right, max_rows):
        return joined(df, F.broadcast(right), how)

    # NaN is a key like any other; only NULL never matches.
    no_key = F.lit(False)
    for name in lefts:
        no_key = no_key | F.col(name).isNull()
    keyed = df.filter(~no_key)
    hot = materialize(hot_keys(keyed, lefts, hot_rows).select(*lefts))
    if hot.count() == 0:
        result = joined(keyed, right, how)
    else:
        names = [f"_k{i}" for i in range(len(on))]
        few = broadcast_if_small(hot)
        hot_right = materialize(right.join(few.toDF(*names), names, "left_semi"))
        heavy = joined(keyed.join(few, lefts, "left_semi"), broadcast_if_small(hot_right), how)
        result = joined(keyed.join(few, lefts, "left_anti"), right, how).unionByName(heavy)
    if how == "left":
        bare = df.filter(no_key).select(
            *df.columns, *[F.lit(None).cast(dim.schema[v].dataType).alias(v) for v in values]
        )
        result = result.unionByName(bare)
    return result


def enrich_pairs(
    pairs: DataFrame,
    profile: DataFrame,
    key: str = "pid",
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """Join a pair table twice with the same profile; both sides must exist.

    A profile that is too large to be sent to the tasks is written once in
    buckets of its key, and both joins read it from there: its columns are not
    shuffled, only the pairs are.
    """
    values = [c for c in profile.columns if c != key]
    fits = fits_broadcast(profile, max_rows)
    stored = profile if fits else bucketed(profile.filter(F.col(key).isNotNull()), key, buckets)
    result = pairs
    for side in ("item2", "item1"):
        tagged = stored.select(F.col(key), *[F.col(v).alias(f"{v}{side[-1]}") for v in values])
        result = dimension_join(result, tagged, [(side, key)], "inner", max_rows, hot_rows, fits)
    return result


def positional_zip(left: DataFrame, right: DataFrame, left_order, right_order, position: str = "position"):
    """Join two ordered tables by their 0-based row number."""
    from rankloom.operators.ordering import ordered_prefix

    a = ordered_prefix(left, left_order, position=position)
    b = ordered_prefix(right, right_order, position=position)
    return a.join(b, position).withColumn(position, F.col(position) - 1)
