"""Embedding near-duplicates: spherical k-means cells and blocked cosine products.

Vectors with one label that are equal number by number are one class, so copies
are never compared.  Classes are assigned to the ``PROBES`` cells with the
nearest centroids, so that most pairs that a border separates meet in a cell
that is near to both; no vector is in more cells, whatever the data.  Beyond
``MAX_CELLS`` cells each of these is divided in turn by centroids of its own,
so the rows of a cell do not grow with the table.  Within a label and cell,
blocks of bounded size are compared by a matrix product in double precision; a
block returns counts and a spanning forest, not pairs.  A pair that meets in
several cells is counted in the one with the smallest number.

Centroids are fitted on bounded samples; every vector is indexed.  The number
of probes makes recall a measured quantity: the tests hold it against brute
force.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.blocks import by_block, in_blocks
from rankloom.llm.components import components, smallest_labels
from rankloom.session import materialize

SAMPLE_ROWS = 8192
MAX_CELLS = 1024
CELL_ROWS = 512
PROBES = 3
# Cells that a cell is divided into, sampled rows for each of them, and numbers of all centroids of that level at most.
MAX_FINE = 64
FINE_SAMPLE = 32
FINE_NUMBERS = 1 << 23
STEPS = 8
PAIRS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 2048


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that very large and very small numbers do no harm."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def spherical_kmeans(rows: np.ndarray, k: int, steps: int = STEPS, seed: int = 5) -> np.ndarray:
    """At most ``k`` unit centroids of unit rows."""
    k = min(k, len(rows))
    centres = rows[np.sort(np.random.default_rng(seed).choice(len(rows), k, replace=False))]
    for _ in range(steps):
        nearest = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        length = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centres)
    return centres


@dataclass(frozen=True)
class Cells:
    """Centroids by vector length; ``fine`` holds those inside each of them (number by coarse cell), where there are any."""

    coarse: dict[int, np.ndarray]
    fine: dict[tuple[int, int], np.ndarray]

    def nearest(self, unit: np.ndarray, probes: int) -> list[list[int]]:
        """The sorted cells of unit rows of one length."""
        size = unit.shape[1]
        centres = self.coarse.get(size)
        if centres is None:
            return [[0]] * len(unit)
        top = _largest(unit @ centres.T, probes)
        if not self.fine:
            return np.sort(top, axis=1).tolist()
        inside = max(len(f) for f in self.fine.values())
        near = np.full((len(unit), top.shape[1], inside), -np.inf)
        for c in np.unique(top):
            row, at = np.nonzero(top == c)
            centroids = self.fine.get((size, int(c)), centres[c : c + 1])
            near[row, at, : len(centroids)] = unit[row] @ centroids.T
        best = _largest(near.reshape(len(unit), -1), probes)
        number = np.take_along_axis(top, best // inside, 1) * inside + best % inside
        known = np.isfinite(np.take_along_axis(near.reshape(len(unit), -1), best, 1))
        return [sorted(n[k].tolist()) for n, k in zip(number, known)]


def _largest(values: np.ndarray, count: int) -> np.ndarray:
    """Columns of the largest values of each row."""
    if values.shape[1] <= count:
        return np.broadcast_to(np.arange(values.shape[1]), values.shape)
    return np.argpartition(-values, count - 1, axis=1)[:, :count]


def _hashed() -> Column:
    return F.xxhash64("vector", F.lit(3))


def fit_cells(
    classes: DataFrame, count: int, sample_rows: int = SAMPLE_ROWS, max_cells: int = MAX_CELLS, cell_rows: int = CELL_ROWS
) -> Cells:
    """Centroids from the ``sample_rows`` classes with the smallest hash of their vector; for more than ``max_cells``
    cells each one is divided by centroids from the ``FINE_SAMPLE`` classes for each with the smallest hash in it."""
    sample = classes.orderBy(_hashed(), "node").select("vector").limit(sample_rows).collect()
    wanted = max(1, math.ceil(count / cell_rows))
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row["vector"]), []).append(row["vector"])
    coarse = {size: spherical_kmeans(_unit(np.array(rows, float)), min(max_cells, wanted)) for size, rows in by_size.items()}
    widest = sum(len(c) * size for size, c in coarse.items())
    inside = min(MAX_FINE, math.ceil(wanted / max_cells), FINE_NUMBERS // max(1, widest))
    if inside < 2:
        return Cells(coarse, {})
    only = Cells(coarse, {})
    schema = T.StructType([*classes.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    placed = classes.mapInArrow(lambda batches: _assign(batches, only, 1), schema)
    placed = placed.select("vector", F.size("vector").alias("size"), F.get("cells", F.lit(0)).alias("cell"), _hashed().alias("h"))
    few = Window.partitionBy("size", "cell").orderBy("h", "vector")
    few = placed.withColumn("r", F.row_number().over(few)).filter(F.col("r") <= inside * FINE_SAMPLE).select("size", "cell", "vector")

    def divided(key: tuple, rows: pa.Table) -> pa.Table:
        vectors = _unit(rows.column("vector").combine_chunks().flatten().to_numpy().astype(float).reshape(rows.num_rows, -1))
        centroids = spherical_kmeans(vectors, inside)
        place = {name: pa.array([k.as_py()], pa.int32()) for name, k in zip(("size", "cell"), key)}
        return pa.table({**place, "centroids": [centroids.reshape(-1).tolist()]})

    # One row per coarse cell, FINE_NUMBERS numbers in all.
    found = few.groupBy("size", "cell").applyInArrow(divided, "size int, cell int, centroids array<double>").collect()
    return Cells(coarse, {(r["size"], r["cell"]): np.array(r["centroids"]).reshape(-1, r["size"]) for r in found})


def _assign(batches: Iterator[pa.RecordBatch], cells: Cells, probes: int) -> Iterator[pa.RecordBatch]:
    """(node, label, weight, vector) to the same with the sorted list of cells."""
    for whole in batches:
        for begin in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(begin, ROWS_AT_ONCE)
            vectors = batch.column(3).to_pylist()
            found: list[list[int]] = [[0]] * len(vectors)
            for size in {len(v) for v in vectors}:
                where = [i for i, v in enumerate(vectors) if len(v) == size]
                for i, listed in zip(where, cells.nearest(_unit(np.array([vectors[i] for i in where], float)), probes)):
                    found[i] = listed
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], ["node", "label", "weight", "vector", "cells"])


def _compare(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows (node, weight, vector, cells, cell, block, chunk) to (a, b, links): links of a, and a forest link to b where given."""

    def work(rows: pa.Table) -> pa.RecordBatch | None:
        rows = rows.combine_chunks()
        chunk = rows.column("chunk").to_numpy()
        _, i, j = rows.column("block")[0].as_py()
        split = int((chunk == chunk[0]).sum())
        if i != j and split == len(chunk):
            return None
        size = len(rows.column("vector")[0])
        unit = _unit(rows.column("vector").combine_chunks().flatten().to_numpy().astype(float).reshape(-1, size))
        node, weight = rows.column("node").to_numpy(), rows.column("weight").to_numpy()
        cell = rows.column("cell")[0].as_py()
        lists = rows.column("cells").to_pylist()
        width = max(map(len, lists))
        cells = np.array([x + [-1 - n] * (width - len(x)) for n, x in enumerate(lists)])
        links = np.zeros(len(node), np.int64)
        lefts, rights = [], []
        a_rows = np.arange(split if i != j else len(node))
        b_first = split if i != j else 0
        step = max(1, PAIRS_AT_ONCE // max(1, len(node) - b_first))
        for begin in range(0, len(a_rows), step):
            block = a_rows[begin : begin + step]
            left, right = np.nonzero(unit[block] @ unit[b_first:].T >= least)
            left, right = block[left], right + b_first
            if i == j:
                left, right = left[left < right], right[left < right]
            for at in range(0, len(left), PAIRS_AT_ONCE // 16):
                x, y = left[at : at + PAIRS_AT_ONCE // 16], right[at : at + PAIRS_AT_ONCE // 16]
                shared = (cells[x][:, :, None] == cells[y][:, None, :]).any(2)
                first = np.where(shared, cells[x], np.iinfo(np.int64).max).min(1)
                mine = first == cell
                x, y = x[mine], y[mine]
                np.add.at(links, x, weight[y])
                np.add.at(links, y, weight[x])
                lefts.append(x)
                rights.append(y)
        if not links.any():
            return None
        label = smallest_labels(len(node), np.concatenate(lefts), np.concatenate(rights))
        out = np.flatnonzero(links)
        other = [int(node[label[n]]) if label[n] != n else None for n in out]
        return pa.RecordBatch.from_arrays([pa.array(node[out]), pa.array(other, pa.int64()), pa.array(links[out])], ["a", "b", "links"])

    yield from by_block(batches, 5, work)


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.93,
    probes: int = PROBES,
    max_cells: int = MAX_CELLS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``id_col, n_links, component_id, kept``, one row per input row.

    Two rows link if their labels are equal and not NULL and their cosine is at
    least ``least``.  Vectors that are NULL, empty, zero or hold a NULL or a
    number that is not finite link with nothing, nor do vectors of different
    lengths with each other, nor rows with a NULL id.  Rows that repeat an id
    are one node: they get the sum of its links and one component.  Other
    columns are not read.
    """
    vector = F.col(f"`{vector_col}`")
    source = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").alias("label"), vector.cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    source = source.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # Both zeros are one; 128 bits stand for a vector where only its name is wanted.
    usable = source.filter("usable").withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    usable = usable.withColumns({"h1": F.xxhash64("vector", F.lit(21)), "h2": F.xxhash64("vector", F.lit(22))})
    grouped = usable.groupBy("label", "vector", "h1", "h2").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight"))
    stored = materialize(grouped.select("node", "label", "weight", "vector", "h1", "h2"))
    classes = stored.select("node", "label", "weight", "vector")
    count = classes.count()
    cells = fit_cells(classes, count, max_cells=max_cells, cell_rows=cell_rows)
    schema = T.StructType([*classes.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    celled = classes.mapInArrow(lambda batches: _assign(batches, cells, probes), schema)
    placed = celled.withColumn("cell", F.explode("cells")).withColumn("place", F.xxhash64("label", F.size("vector"), "cell"))
    blocks = in_blocks(placed, "place", F.col("node"))
    found = materialize(
        blocks.select("node", "weight", "vector", "cells", "cell", "block", "chunk").mapInArrow(
            lambda batches: _compare(batches, least), "a bigint, b bigint, links bigint"
        )
    )
    joined = components(found.filter(F.col("b").isNotNull()).select("a", "b"))
    linked = found.groupBy("a").agg(F.sum("links").alias("links"))
    named = (
        stored.select("label", "h1", "h2", "node", "weight")
        .join(linked.withColumnRenamed("a", "node"), "node", "left")
        .join(joined, "node", "left")
        .select(
            F.col("label").alias("l"),
            F.col("h1").alias("k1"),
            F.col("h2").alias("k2"),
            (F.coalesce("links", F.lit(0).cast("bigint")) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    done = usable.select("id", "label", "h1", "h2")
    done = done.join(named, (F.col("label") == F.col("l")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
    alone = source.filter("not usable").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    rows = done.select("id", "n_links", "component_id").unionByName(alone)
    return rows.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
