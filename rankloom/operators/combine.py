"""User-defined combiners in the create / merge form.

Built-in aggregates are the first choice.  This is for states they cannot
express: partial states are built next to the data, one per key and Arrow
batch, and only states are shuffled.  Behind the shuffle the states of a
partition are sorted by key and folded batch by batch, so Python is called once
per batch and holds one batch and one open key, however many states a key has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Frames = Callable[[pd.DataFrame], pd.DataFrame]


def _fold(frames: Iterator[pd.DataFrame], keys: Sequence[str], merge: Frames) -> Iterator[pd.DataFrame]:
    """Merged states of frames in key order; the last key of a frame waits for the next one."""
    held = None
    for frame in frames:
        if not len(frame):
            continue
        whole = frame if held is None else pd.concat([held, frame], ignore_index=True)
        last = whole[list(keys)].iloc[-1]
        merged = merge(whole)
        open_ = pd.Series(True, index=merged.index)
        for key in keys:
            open_ &= merged[key].isna() if pd.isna(last[key]) else merged[key] == last[key]
        held = merged[open_]
        yield merged[~open_]
    if held is not None:
        yield held


def combine_by_key(
    df: DataFrame, keys: Sequence[str], create: Frames, merge: Frames, state: str, salts: int = 32
) -> DataFrame:
    """``create`` turns rows into states, ``merge`` turns states into fewer states.

    Both take a pandas frame with any number of keys and return one with at
    most one row per key.  ``state`` is the schema of the result.  The states
    of a key are first merged in ``salts`` groups, so those of a hot key are
    folded in parallel before they meet in one task; with one salt they are
    shuffled once.
    """
    keys = list(keys)

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield create(frame)

    def folded(states: DataFrame, *salt) -> DataFrame:
        placed = states.repartition(*map(F.col, keys), *salt).sortWithinPartitions(*map(F.col, keys))
        return placed.mapInPandas(lambda frames: _fold(frames, keys, merge), state)

    states = df.mapInPandas(partial, state)
    if salts > 1:
        states = folded(states, F.spark_partition_id() % salts)
    return folded(states)
