"""Multi-valued id and value fields: multi-hot counts, reductions, embedding pools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.arrays import let, value_counts
from rankloom.operators.encode import outside_message
from rankloom.operators.joins import dimension_join
from rankloom.operators.skew import broadcast_if_small
from rankloom.operators.vectors import vector_sums


def multihot(df: DataFrame, key: str, ids: str, depth: int, combiner: str = "sum", outside: str = "raise") -> DataFrame:
    """Sparse multi-hot rows ``(key, id, value)`` with value > 0; ``key`` is unique per row.

    ``sum`` counts an id, ``mean`` divides by the number of ids of the row,
    ``max`` caps the count at 1.  An id outside ``0 <= id < depth`` has no
    position: it is an error, or left out with ``outside="drop"``.  NULL ids
    only count for the mean.  Ids are counted inside their row, nothing is
    shuffled.
    """
    if outside not in ("drop", "raise"):
        raise ValueError("outside must be 'drop' or 'raise'")
    if combiner not in ("sum", "mean", "max"):
        raise ValueError("combiner must be sum, mean or max")
    counted = df.select(key, F.size(ids).alias("_size"), F.explode(value_counts(F.col(ids))).alias("_e"))
    counted = counted.select(key, "_size", F.col("_e.value").alias("id"), F.col("_e.n").alias("_n"))
    inside = (F.col("id") >= 0) & (F.col("id") < depth)
    if outside == "raise":
        # In a filter, so that the check is made even where the id is not read.
        inside = F.when(inside, F.lit(True)).otherwise(F.raise_error(outside_message(F.col("id"), depth)).cast("boolean"))
    counted = counted.filter(inside)
    value = {
        "sum": F.col("_n").cast("double"),
        "mean": F.col("_n") / F.col("_size"),
        "max": F.lit(1.0),
    }
    return counted.select(key, "id", value[combiner].alias("value"))


def multihot_dense(ids: Column, depth: int, combiner: str = "sum") -> Column:
    """Dense multi-hot vector of one row's id list, for small depths."""
    hits = F.transform(
        F.sequence(F.lit(0), F.lit(depth - 1)),
        lambda d: F.size(F.filter(ids, lambda i: i == d)).cast("double"),
    )
    if combiner == "sum":
        return hits
    if combiner == "mean":
        return F.transform(hits, lambda h: F.when(F.size(ids) > 0, h / F.size(ids)).otherwise(F.lit(0.0)))
    if combiner == "max":
        return F.transform(hits, lambda h: F.least(h, F.lit(1.0)))
    raise ValueError("combiner must be sum, mean or max")


POOLS = ("sum", "mean", "sqrtn", "fm")


def embedding_pool(
    df: DataFrame,
    key: str,
    ids: str,
    table: DataFrame,
    dim: int,
    pools: dict[str, str],
    weights: str | None = None,
    id_col: str = "id",
    vec_col: str = "vec",
    keep: Sequence[str] = (),
    **sizes,
) -> DataFrame:
    """Pool the vectors of each row's ids; an empty row gives zeros.

    ``pools`` maps an output column to its combiner.  ``sum``: weighted sum.
    ``mean``: weighted sum over the number of ids.  ``sqrtn``: weighted sum over
    the root of the summed squared weights.  ``fm``: half of the squared sum
    less the sum of squares.  ``keep`` are columns of ``df`` that stay; ``key``
    is unique.  See ``vector_sums`` for NULLs and unknown ids.
    """
    if not set(pools.values()) <= set(POOLS):
        raise ValueError("a combiner is one of " + ", ".join(POOLS))
    entry = lambda i, w: F.struct(F.lit(0).alias("position"), i.alias("id"), w.alias("weight"))
    if weights is None:
        entries = F.transform(ids, lambda i: entry(i, F.lit(1.0)))
    else:
        entries = F.zip_with(ids, weights, lambda i, w: entry(i, w.cast("double")))
    squares = "fm" in pools.values()
    sums = vector_sums(df, key, entries, table, dim, squares=squares, keep=keep, id_col=id_col, vec_col=vec_col, **sizes)
    count, w2 = F.get("_n", F.lit(0)).cast("double"), F.get("_w2", F.lit(0))
    over = {"mean": F.try_divide(F.lit(1.0), count), "sqrtn": F.try_divide(F.lit(1.0), F.sqrt(w2))}

    def pooled(how: str) -> Column:
        if how == "sum":
            return F.col("_s")
        if how == "fm":
            return F.zip_with("_s", "_q", lambda s, q: F.lit(0.5) * (s * s - q))
        return let(F.coalesce(over[how], F.lit(0.0)), lambda scale: F.transform("_s", lambda x: x * scale))

    return sums.select(key, *keep, *[pooled(how).alias(out) for out, how in pools.items()])


def fm_second_order(vectors: Sequence[Column]) -> Column:
    """``0.5 * ((sum v)^2 - sum v^2)`` per dimension over the field vectors of a row.

    The fields of a sample are columns of one row, so nothing is shuffled.  A
    missing vector counts as zeros.
    """

    def add(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: x + y)

    present = F.filter(F.array(*[v.cast("array<double>") for v in vectors]), lambda v: v.isNotNull())

    def fold(vs: Column) -> Column:
        zero = F.array_repeat(F.lit(0.0), F.size(F.get(vs, F.lit(0))))
        sums = F.aggregate(vs, zero, add)
        squares = F.aggregate(vs, zero, lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y * y))
        return F.zip_with(sums, squares, lambda s, q: F.lit(0.5) * (s * s - q))

    return let(present, fold)


def linear_score(features: DataFrame, key: str, token: str, weights: DataFrame, bias: float, **sizes) -> DataFrame:
    """``sum(weight of token) + bias`` per row and its sigmoid; unknown tokens weigh 0.

    ``features`` has one row per (key, token); ``weights`` is ``(token, w)``.
    """
    table = weights.select(F.col("token").alias("_t"), F.col("w").alias("_w"))
    found = dimension_join(features.select(key, token), table, [(token, "_t")], **sizes)
    logit = F.sum(F.coalesce("_w", F.lit(0.0))) + F.lit(float(bias))
    return found.groupBy(key).agg(logit.alias("logit")).withColumn(
        "score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit")))
    )


def merge_shards(df: DataFrame, shard: str, row: str, out: str = "id") -> DataFrame:
    """Concatenate numbered shards: global row id = rows of earlier shards + own row.

    ``shard`` is numeric, so part 10 comes after part 2.  The offsets have one
    row per shard.
    """
    from pyspark.sql import Window

    sizes = df.groupBy(shard).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(shard).alias("_shard"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rest: Sequence[str] = [c for c in df.columns if c not in (shard, row)]
    return df.join(broadcast_if_small(offsets), F.col(shard) == F.col("_shard")).select(
        (F.col("_off") + F.col(row)).alias(out), *rest
    )
