"""Weighted sums of looked-up vectors, as matrix operations on Arrow batches.

Every row has a list of entries (position, id, weight); position p of its
result is the sum of weight times vector over its entries at p.  A small,
measured table goes to the tasks and nothing is shuffled: every Python worker
holds it up to a few MB; beyond that it is broadcast once per executor, the
joined vectors of a row follow each other and are summed where they lie.  A
larger one is joined; the joined vectors are summed batch by batch before the
shuffle and merged in one sorted pass behind it, so a row that is a third of
all entries arrives as one partial sum per batch.  The plan does not depend on
the number of components.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.arrays import pad_to
from rankloom.operators.joins import dimension_join
from rankloom.operators.skew import BROADCAST_ROWS, fits_broadcast

# A table up to this size is sent to the tasks, and one up to the smaller size is held by every Python worker.
TABLE_BYTES = 64 * 1024 * 1024
WORKER_BYTES = 4 * 1024 * 1024
NUMBERS_AT_ONCE = 1 << 21

SUMS = ("_n", "_w2", "_s", "_q")


@dataclass(frozen=True)
class Shape:
    """Positions per row, components per vector, and whether squares are summed as well."""

    positions: int
    dim: int
    squares: bool

    @property
    def width(self) -> int:
        return self.positions * self.dim


class Totals:
    """Counts, squared weights, sums and sums of squares of n rows."""

    def __init__(self, n: int, shape: Shape):
        self.n, self.shape = n, shape
        self.count = np.zeros(n * shape.positions, np.int64)
        self.w2 = np.zeros(n * shape.positions)
        self.sums = np.zeros((n * shape.positions, shape.dim))
        self.squares = np.zeros_like(self.sums) if shape.squares else None

    def add(self, segment: np.ndarray, weight: np.ndarray, known: np.ndarray, vectors, at: np.ndarray) -> None:
        """Entries of segments (row x positions + position); ``vectors[at]`` are those of the ``known`` ones."""
        self.count += np.bincount(segment, minlength=len(self.count))
        self.w2 += np.bincount(segment, weight**2, minlength=len(self.count))
        order = np.argsort(segment[known], kind="stable")
        segment, weight, at = segment[known][order], weight[known][order], at[known][order]
        step = max(1, NUMBERS_AT_ONCE // self.shape.dim)
        for i in range(0, len(segment), step):
            piece = segment[i : i + step]
            starts = np.flatnonzero(np.diff(piece, prepend=-1))
            terms = vectors[at[i : i + step]] * weight[i : i + step, None]
            self.sums[piece[starts]] += np.add.reduceat(terms, starts)
            if self.shape.squares:
                self.squares[piece[starts]] += np.add.reduceat(terms**2, starts)

    def resume(self, first: list[np.ndarray]) -> None:
        """Go on with the totals of a row, as ``last`` gives them, in the first one."""
        for own, given in zip(self._all(), first):
            own[: len(given)] = given

    def last(self) -> list[np.ndarray]:
        return [x[(self.n - 1) * self.shape.positions :].copy() for x in self._all()]

    def _all(self) -> list[np.ndarray]:
        return [self.count, self.w2, self.sums, *([self.squares] if self.shape.squares else [])]

    def columns(self) -> list[pa.Array]:
        n, p = self.n, self.shape.positions
        wide = [self.sums, self.squares] if self.shape.squares else [self.sums]
        return [as_lists(x) for x in (self.count.reshape(n, p), self.w2.reshape(n, p), *[w.reshape(n, self.shape.width) for w in wide])]


def as_lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int64) * width, pa.int32()), pa.array(matrix.reshape(-1)))


def _weights(column: pa.Array) -> np.ndarray:
    return column.fill_null(0.0).to_numpy(zero_copy_only=False)


def _lookup(batches: Iterator[pa.RecordBatch], ids: pa.Array, vectors: np.ndarray, shape: Shape) -> Iterator[pa.RecordBatch]:
    """(..., position, id, weight lists) to (..., sums) with the whole table at hand."""
    rows = max(1, NUMBERS_AT_ONCE // shape.width)
    for whole in batches:
        for begin in range(0, whole.num_rows, rows):
            batch = whole.slice(begin, rows)
            position, names, weight = (batch.column(batch.num_columns - k) for k in (3, 2, 1))
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(names).fill_null(0).to_numpy())
            names, weight = names.flatten(), _weights(weight.flatten())
            present = names.is_valid().to_numpy(zero_copy_only=False)
            at = pc.index_in(names, value_set=ids).fill_null(-1).to_numpy()
            segment = row * shape.positions + position.flatten().to_numpy()
            totals = Totals(batch.num_rows, shape)
            totals.add(segment[present], weight[present], at[present] >= 0, vectors, at[present])
            columns = [*batch.columns[:-3], *totals.columns()]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-3], *SUMS[: 3 + shape.squares]])


def _groups(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
    """Group number of every row by its key, and key and payload per group, in order of appearance.

    The payload of a key is on one of its rows, here or in another batch.
    """
    n = batch.num_rows
    code = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    here = np.full(code.max(initial=-1) + 1, 2 * n)
    row = np.arange(n)
    np.minimum.at(here, code, np.where(batch.column(1).is_valid().to_numpy(zero_copy_only=False), row, row + n))
    return code, [c.take(pa.array(here % n)) for c in batch.columns[:2]]


def _combine(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[pa.RecordBatch]:
    """Joined entries (key, payload, position, present, weight, vector) to partial sums by key, batch by batch."""
    step = max(1, NUMBERS_AT_ONCE // shape.width)
    for whole in batches:
        for begin in range(0, whole.num_rows, step):
            batch = whole.slice(begin, step)
            code, named = _groups(batch)
            position, present, weight, vector = batch.columns[2:]
            known = vector.is_valid().to_numpy(zero_copy_only=False)
            at = np.cumsum(known) - 1
            vectors = vector.drop_null().flatten().to_numpy().reshape(-1, shape.dim)
            here = present.to_numpy(zero_copy_only=False)
            segment = code * shape.positions + position.to_numpy()
            totals = Totals(len(named[0]), shape)
            totals.add(segment[here], _weights(weight)[here], known[here], vectors, at[here])
            yield pa.RecordBatch.from_arrays([*named, *totals.columns()], [*batch.schema.names[:2], *SUMS[: 3 + shape.squares]])


def _in_place(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[pa.RecordBatch]:
    """Joined entries (..., place, position, present, weight, vector) to (..., sums): a row's entries follow each other.

    ``place`` counts a row's entries from 0; its last row waits for the next batch.
    """
    step = max(1, NUMBERS_AT_ONCE // shape.width)
    names = None
    held = None
    for whole in batches:
        for begin in range(0, whole.num_rows, step):
            batch = whole.slice(begin, step)
            names = [*batch.schema.names[:-5], *SUMS[: 3 + shape.squares]]
            place, position, present, weight, vector = batch.columns[-5:]
            starts = place.to_numpy() == 0
            # Entries before the first start belong to the row that is held.
            row = np.cumsum(starts) - 1 + (held is not None)
            known = vector.is_valid().to_numpy(zero_copy_only=False)
            at = np.cumsum(known) - 1
            vectors = vector.drop_null().flatten().to_numpy().reshape(-1, shape.dim)
            here = present.to_numpy(zero_copy_only=False)
            n = int(row[-1]) + 1
            totals = Totals(n, shape)
            if held is not None:
                totals.resume(held[1])
            segment = row * shape.positions + position.to_numpy()
            totals.add(segment[here], _weights(weight)[here], known[here], vectors, at[here])
            kept = pa.RecordBatch.from_arrays(batch.columns[:-5], batch.schema.names[:-5]).take(pa.array(np.flatnonzero(starts)))
            if held is not None:
                kept = pa.Table.from_batches([held[0], kept]).combine_chunks().to_batches()[0]
            done = pa.RecordBatch.from_arrays([*kept.columns, *totals.columns()], names)
            held = kept.slice(n - 1), totals.last()
            yield done.slice(0, n - 1)
    if held is not None:
        totals = Totals(1, shape)
        totals.resume(held[1])
        yield pa.RecordBatch.from_arrays([*held[0].columns, *totals.columns()], names)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums in key order to one row per key; the last key of a batch waits for the next one."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        code, named = _groups(batch)
        sums = []
        for column in batch.columns[2:]:
            matrix = column.flatten().to_numpy().reshape(batch.num_rows, -1)
            sums.append(as_lists(np.add.reduceat(matrix, np.flatnonzero(np.diff(code, prepend=-1)))))
        merged = pa.RecordBatch.from_arrays([*named, *sums], batch.schema.names)
        held = merged.slice(merged.num_rows - 1)
        yield merged.slice(0, merged.num_rows - 1)
    if held is not None:
        yield held


def vector_sums(
    df: DataFrame,
    key: str,
    entries: Column,
    table: DataFrame,
    dim: int,
    positions: int = 1,
    squares: bool = False,
    keep: Sequence[str] = (),
    id_col: str = "id",
    vec_col: str = "vec",
    max_rows: int = BROADCAST_ROWS,
    **sizes,
) -> DataFrame:
    """``key, keep..., _n, _w2, _s[, _q]`` per row of ``df``; ``key`` is unique.

    ``entries`` is ``array<struct<position, id, weight>>``.  By position: ``_n``
    counts ids that are not NULL, ``_w2`` sums their squared weights, and
    ``_s`` (and ``_q``: of the squared terms) holds ``dim`` sums per position.
    A NULL weight counts as 0, an id without a vector adds nothing; a row
    without entries gets zeros.  ``table`` is unique by id; its vectors are cut
    or filled with zeros to ``dim`` components.
    """
    shape = Shape(positions, dim, squares)
    vec = F.transform(F.col(vec_col).cast("array<double>"), lambda x: F.coalesce(x, F.lit(0.0)))
    vectors = table.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
    vectors = vectors.select(F.col(id_col).alias("_vid"), pad_to(vec, dim, F.lit(0.0), surplus="cut").alias("_vec"))
    groups = [key, *keep]
    rows = df.select(*groups, F.coalesce(entries, F.array().cast(df.select(entries.alias("e")).schema["e"].dataType)).alias("_e"))
    lists = [T.StructField(n, T.ArrayType(T.LongType() if n == "_n" else T.DoubleType())) for n in SUMS[: 3 + squares]]
    out = T.StructType([*rows.select(*groups).schema.fields, *lists])
    if fits_broadcast(vectors, max_rows, WORKER_BYTES):
        held = vectors.toArrow().combine_chunks()
        ids = held.column("_vid").combine_chunks()
        matrix = held.column("_vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        parts = rows.select(
            *groups,
            F.transform("_e", lambda e: e["position"].cast("int")).alias("_p"),
            F.transform("_e", lambda e: e["id"]).cast(T.ArrayType(vectors.schema["_vid"].dataType)).alias("_i"),
            F.transform("_e", lambda e: e["weight"].cast("double")).alias("_w"),
        )
        return parts.mapInArrow(lambda batches: _lookup(batches, ids, matrix, shape), out)
    if fits_broadcast(vectors, max_rows, TABLE_BYTES):
        # The join keeps the order of the entries, so nothing is shuffled; rows without entries stay as one without an id.
        ranked = vectors.withColumn("_o", F.monotonically_increasing_id())
        first = ranked.groupBy("_vid").agg(F.min_by("_vec", "_o").alias("_vec"))
        each = rows.select(*groups, F.posexplode_outer("_e").alias("_at", "_e"))
        found = each.join(F.broadcast(first), F.col("_e.id").cast(vectors.schema["_vid"].dataType) == F.col("_vid"), "left").select(
            *groups,
            F.coalesce("_at", F.lit(0)).alias("_at"),
            F.coalesce(F.col("_e.position").cast("int"), F.lit(0)).alias("_p"),
            F.col("_e.id").isNotNull().alias("_h"),
            F.col("_e.weight").cast("double").alias("_w"),
            "_vec",
        )
        return found.mapInArrow(lambda batches: _in_place(batches, shape), out)
    # Rows without entries stay as an entry without an id; what is kept travels on a row's first entry.
    payload = F.struct(F.lit(True).alias("_"), *keep)
    payload_type = rows.select(payload.alias("p")).schema["p"].dataType
    each = rows.select(key, payload.alias("_k"), F.posexplode_outer("_e").alias("_at", "_e")).select(
        key,
        F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("_k")).alias("_k"),
        F.coalesce(F.col("_e.position").cast("int"), F.lit(0)).alias("_p"),
        F.col("_e.id").alias("_i"),
        F.col("_e.weight").cast("double").alias("_w"),
    )
    found = dimension_join(each, vectors, [("_i", "_vid")], max_rows=max_rows, **sizes)
    found = found.select(key, "_k", "_p", F.col("_i").isNotNull().alias("_h"), "_w", "_vec")
    kinds = T.StructType([rows.schema[key], T.StructField("_k", payload_type), *lists])
    partial = found.mapInArrow(lambda batches: _combine(batches, shape), kinds)
    placed = partial.repartition(F.col(key)).sortWithinPartitions(key)
    return placed.mapInArrow(_merge, kinds).select(key, *[F.col(f"_k.`{c}`") for c in keep], *SUMS[: 3 + squares])
