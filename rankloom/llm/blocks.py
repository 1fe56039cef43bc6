"""Comparisons within groups of any size, in blocks of bounded size.

A group is cut into chunks by a hash; every pair of chunks is a block.  Blocks
are shuffled, so no task holds more than two chunks at a time however large a
group is, and a hot group becomes many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS = 1024


def in_blocks(
    rows: DataFrame, group: str, spread: Column, chunk_rows: int = CHUNK_ROWS, *, size: str | None = None, limit: int = 0, few_groups: bool = False
) -> DataFrame:
    """``rows`` (with a bigint column ``group``) dealt to blocks: adds ``block`` and ``chunk``.

    A block is ``array(group, i, j)`` with i <= j; rows of chunk i and j meet
    there, and ``chunk`` tells them apart.  Groups of one row are left out.
    With ``size``, a column of bytes, chunks also hold about ``limit`` of them.
    With ``few_groups`` their sizes are sent to the tasks and rows are shuffled once.
    Blocks are contiguous and ordered within the result's partitions.
    """
    total = F.sum(size) if size else F.lit(0).cast("bigint")
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), total.alias("_s")).filter("_n > 1")
    sized = rows.join(F.broadcast(sizes) if few_groups else sizes, group)
    chunks = F.ceil(F.col("_n") / chunk_rows)
    if size:
        # No more chunks than rows: a large row is a chunk by itself.
        chunks = F.least(F.greatest(chunks, F.ceil(F.col("_s") / limit)), F.col("_n"))
    sized = sized.withColumn("_k", chunks).withColumn("chunk", F.pmod(F.xxhash64(spread, F.lit(1)), F.col("_k")).cast("bigint"))
    dealt = sized.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k") - 1)))
    block = F.array(F.col(group), F.least("chunk", "_o"), F.greatest("chunk", "_o"))
    dealt = dealt.withColumn("block", block).drop("_n", "_s", "_k", "_o")
    return dealt.repartition("block").sortWithinPartitions("block", "chunk")


def by_block(batches: Iterator[pa.RecordBatch], at: int, work: Callable[[pa.Table], pa.RecordBatch | None]) -> Iterator[pa.RecordBatch]:
    """Call ``work`` with the rows of each block; ``at`` is the index of ``block``."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(at).flatten().to_numpy().reshape(-1, 3)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        begin = 0
        for end in [*cuts.tolist(), len(keys)]:
            here = tuple(keys[begin])
            if key is not None and here != key:
                done = work(pa.Table.from_batches(held))
                held = []
                if done is not None and done.num_rows:
                    yield done
            key = here
            held.append(batch.slice(begin, end - begin))
            begin = end
    if held:
        done = work(pa.Table.from_batches(held))
        if done is not None and done.num_rows:
            yield done
