"""Seeded, portable pseudo-randomness.

``rand()`` gives different values when a task is retried on another executor.
An md5 of the seed and the row key is stable across retries, partitionings and
engines, so sampling, splitting and shuffling are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def hash32(seed: int, *keys: Column | str) -> Column:
    """First 32 bits of md5('seed:key[:key...]') as bigint."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_order(seed: int, *keys: Column | str) -> Column:
    """Sort key of a seeded shuffle."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def hash_fraction(seed: int, *keys: Column | str) -> Column:
    """Uniform double in [0, 1)."""
    return hash32(seed, *keys).cast("double") / F.lit(float(HASH_SPACE))
