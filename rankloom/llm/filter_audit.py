"""Filter interaction audit: what every filter removes at every place of every filter order.

A document's outcome depends only on the set of filters it fails.  Documents
are therefore counted once per part and failure mask (a cell); all orders are
read off the survivors of the 2**k sets of active filters.  A Gray-code walk
visits the sets so that one filter is toggled at a time: each mask cell keeps
the number of active filters it fails, and the survivors change by the cells
whose number leaves or reaches zero.  The stored states are differenced for the
steps of the orders.

Nothing but whole numbers per cell leaves the counting job.  Texts are compared
by their SHA-256; copies are counted before they are shuffled, so a text that
fills a third of the table is a few rows per task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The filters, in the order of their bits.
LETTERS = "ABCDE"
GAP = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
PARTS_AT_ONCE = 128


def text_failures(text: Column, words: Column) -> list[Column]:
    """Filters A to D on a text and the array of its words."""
    count, capitals = F.size(words), F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]", ""))
    return [
        count < 100,
        F.size(F.array_distinct(words)).cast("bigint") * 100 < count.cast("bigint") * 80,
        capitals.cast("bigint") * 100 > F.length(text).cast("bigint") * 10,
        text.rlike(MARKS),
    ]


def filter_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents per part and set of failed filters.

    ``good`` and ``toxic`` count those that ``labels`` (doc_id, quality, toxic)
    gives a 1; several labels of one id are taken together.  A NULL text is
    empty, a NULL part is the empty string.  Filter E fails where a smaller id
    has the same text; repeated rows of one id do not fail by each other, and a
    row without an id has no label, fails by no other and makes none fail.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    rows = rows.withColumn("words", F.array_remove(F.split("text", GAP), ""))
    mask = F.lit(0)
    for bit, fails in enumerate(text_failures(F.col("text"), F.col("words"))):
        mask = mask + F.when(fails, 1 << bit).otherwise(0)
    rows = rows.select("doc", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("same"))
    counted = rows.groupBy("doc", "part", "mask", F.when(F.col("doc").isNotNull(), F.col("same")).alias("same")).agg(F.count(F.lit(1)).alias("n"))

    one = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc"))
    known = known.agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    no = F.lit(False)
    named = counted.filter("doc is not null").join(known, "doc", "left")
    named = named.withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
    # One row per text, part and label; the smallest id of a text is found among these few.
    few = named.groupBy("same", "mask", "part", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct("doc", "n")).alias("least"))
    few = few.withColumn("first", F.col("least.doc") == F.min("least.doc").over(Window.partitionBy("same")))
    stays = F.when(F.col("first"), F.col("least.n")).otherwise(F.lit(0).cast("bigint"))
    repeated = 1 << (len(LETTERS) - 1)
    split = F.array(
        F.struct(F.col("mask"), stays.alias("n")), F.struct((F.col("mask") + repeated).alias("mask"), (F.col("n") - stays).alias("n"))
    )
    split = few.select("part", "good", "toxic", F.explode(split).alias("c")).select("part", "c.mask", "c.n", "good", "toxic").filter("n > 0")
    unnamed = counted.filter("doc is null").select("part", "mask", "n", no.alias("good"), no.alias("toxic"))
    of = lambda name: F.sum(F.when(F.col(name), F.col("n")).otherwise(F.lit(0).cast("bigint")))
    cells = split.unionByName(unnamed).groupBy("part", "mask")
    return cells.agg(F.sum("n").alias("n"), of("good").alias("good"), of("toxic").alias("toxic"))


def gray_walk(cells: np.ndarray) -> np.ndarray:
    """(parts, 2**k masks, counts) to the survivors of every filter set, in the same shape."""
    size = cells.shape[1]
    masks = np.arange(size)
    failing = np.zeros(size, np.int64)  # active filters that a cell fails
    alive = cells.sum(axis=1)
    states = np.empty_like(cells)
    states[:, 0] = alive
    active = 0
    for step in range(1, size):
        bit = step & -step
        active ^= bit
        hit = (masks & bit) != 0
        if active & bit:
            failing[hit] += 1
            alive = alive - cells[:, hit & (failing == 1)].sum(axis=1)
        else:
            failing[hit] -= 1
            alive = alive + cells[:, hit & (failing == 0)].sum(axis=1)
        states[:, active] = alive
    return states


def _steps(batches: Iterator[pa.RecordBatch], letters: str) -> Iterator[pa.RecordBatch]:
    """(part, masks, counts of the masks) to one row per part, order and step."""
    k = len(letters)
    size = 1 << k
    orders = list(permutations(range(k)))
    bits = 1 << np.array(orders).reshape(len(orders), k)
    after = np.cumsum(bits, axis=1)
    before, letter = after - bits, np.array(orders).reshape(-1)
    names = np.repeat(["".join(letters[i] for i in o) for o in orders], k)
    fails = np.array([(np.arange(size) >> i) & 1 for i in range(k)])
    for whole in batches:
        for at in range(0, whole.num_rows, PARTS_AT_ONCE):
            batch = whole.slice(at, PARTS_AT_ONCE)
            parts = batch.num_rows
            cells = np.zeros((parts, size, 3), np.int64)
            row = np.repeat(np.arange(parts), np.diff(batch.column(1).offsets.to_numpy()))
            for i in range(3):
                cells[row, batch.column(1).flatten().to_numpy(), i] = batch.column(2 + i).flatten().to_numpy()
            states = gray_walk(cells)
            gone = (states[:, before] - states[:, after]).reshape(parts, len(letter), 3)
            failing = np.einsum("pm,km->pk", cells[:, :, 0], fails)
            shapley = np.zeros((parts, k), np.int64)
            np.add.at(shapley, (slice(None), letter), gone[:, :, 0])
            columns = [
                states[:, after].reshape(parts, len(letter), 3)[:, :, 0],
                gone[:, :, 0],
                failing[:, letter] - gone[:, :, 0],
                cells[:, 1 << letter, 0],
                gone[:, :, 1],
                gone[:, :, 2],
                shapley[:, letter],
            ]
            part = batch.column(0).take(pa.array(np.repeat(np.arange(parts), len(letter))))
            order = pa.array(np.tile(names, parts), pa.string())
            step = pa.array(np.tile(np.tile(np.arange(1, k + 1), len(orders)), parts), pa.int32())
            yield pa.RecordBatch.from_arrays([part, order, step, *[pa.array(c.reshape(-1)) for c in columns]], [f.split()[0] for f in SCHEMA.split(", ")])


SCHEMA = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
    "good_lost bigint, toxic_lost bigint, shapley bigint"
)


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of ``letters`` and step, from ``part, mask, n, good, toxic``.

    Bit i of a mask is letter i; a part has at most 2**k rows.  ``kept`` is
    what is left after the step and ``removed`` what it removes; ``redundant``
    fails its filter but was removed earlier; ``unique_fails`` fails no other;
    ``shapley`` sums what the filter removes over all orders.  No rows, no parts.
    """
    whole = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))
    whole = whole.select("part", *[F.col(f"c.{name}").alias(name) for name in ("mask", "n", "good", "toxic")])
    return whole.mapInArrow(lambda batches: _steps(batches, letters), SCHEMA)
