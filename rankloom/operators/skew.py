"""Size checks that decide between a broadcast and a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limits of a broadcast side; both must hold.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 256 * 1024 * 1024

# Hot keys are looked for in this share of the rows when the limit is large.
SAMPLED_SHARE = 1 / 64


def _width(field: T.StructField) -> Column:
    """Bytes of a value, close enough for a size limit."""
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.NumericType):
            return F.greatest(F.coalesce(F.size(col), F.lit(0)), F.lit(0)) * 8
        return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    return F.lit(8)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small in rows and measured bytes (one aggregate, nothing is moved).

    The lineage of ``df`` runs for this, so pass a stored or materialized table.
    """
    width = F.lit(0)
    for field in df.schema.fields:
        width = width + _width(field)
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("b")).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a row check; otherwise a plain join side.

    Without the hint AQE still turns the join into a broadcast when the
    measured size allows it, and splits skewed partitions when it does not.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys with more than ``max_rows`` rows and their row count ``n_rows``.

    There are at most ``total / max_rows`` of them.  For a large limit the
    counts are estimated from a sample of the rows, which keeps the counting
    shuffle small; a key near the limit may fall on either side.  The answer
    only steers how rows are distributed, never which rows are kept.  Write it
    out before using it twice.
    """
    share = SAMPLED_SHARE if max_rows * SAMPLED_SHARE >= 1000 else 1.0
    rows = df.select(*keys)
    if share < 1.0:
        rows = rows.sample(withReplacement=False, fraction=share, seed=777)
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows * share)
    return counted.select(*keys, (F.col("_n") / F.lit(share)).cast("bigint").alias("n_rows"))
