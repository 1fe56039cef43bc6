"""Vector code compression: integer product quantisation with Drake-Hamerly adaptive bounds.

A vector is cut into equal consecutive parts; each part has a codebook of
``entries`` vectors, refined by rounds of assigning and averaging in whole
numbers.  Between rounds every vector keeps, for each part, its ``b`` closest
entries, a lower bound of its distance to each of them but the first, which is
the assigned one and has an upper bound, and one outer bound for all others.
When entries move, bounds move with them; distances are computed only where
the bounds cannot decide, among the few entries that can still be nearest.

Bounds are rounded away from the decision and decide only when strictly apart;
everything else is settled by squared distances in whole numbers, ties going to
the lower index.  The codes are those of the plain algorithm.

A round is one pass over the rows: each task returns its rows with new bounds
and the sums of its parts by entry, in one table.  The driver sees the sums of
entries, which no number of rows makes larger.  The table of a round rests on
the files of the round before, which go once it is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators.skew import fits_broadcast
from rankloom.session import materialize, scratch_path

ENTRIES = 16
PARTS = 8
ROUNDS = 6
SCALE = 4096
# Bounds kept per part at first, and the least number of them, as shares of the entries.
FIRST_SHARE, LEAST_SHARE = 3 / 8, 1 / 8
# The next b covers this share of the undecided cases of a round.
COVERED = 0.95
# Moves are taken a little too long, by more than the rounding of double-precision sums and roots.
SLACK = 1e-12
NUMBERS_AT_ONCE = 1 << 19

# Vectors and bounds are rows of numbers of one width: kept as bytes, they pass through Spark without a look at each number.
STATE = "vector binary, near binary, bounds binary, sums array<bigint>, used array<bigint>"
NAMES = ("id", "label", "vector", "near", "bounds", "sums", "used")


@dataclass(frozen=True)
class Bounds:
    """Of n parts: assigned and next entries (n, b), their lower bounds (n, b - 1), upper and outer bound (n)."""

    near: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    outer: np.ndarray


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def squared(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number rows (n, d) to entries (k, d) or to own entries (n, k, d)."""
    if entries.ndim == 2:
        entries = entries[None]
    total = np.zeros((len(rows), entries.shape[1]), np.int64)
    for i in range(rows.shape[1]):
        apart = rows[:, i, None] - entries[:, :, i]
        total += apart * apart
    return total


def assign_all(rows: np.ndarray, book: np.ndarray, b: int) -> Bounds:
    """Bounds from all distances."""
    far = squared(rows, book)
    order = np.argsort(far, axis=1, kind="stable")  # ties: lower index first
    apart = np.sqrt(np.take_along_axis(far, order, 1).astype(float))
    outer = _down(apart[:, b]) if b < len(book) else np.full(len(rows), np.inf, np.float32)
    return Bounds(order[:, :b].astype(np.int8), _down(apart[:, 1:b]), _up(apart[:, 0]), outer)


def moved(bounds: Bounds, moves: np.ndarray) -> Bounds:
    """Bounds that hold after every entry has moved by at most ``moves``."""
    near = bounds.near
    upper = _up(bounds.upper.astype(float) + moves[near[:, 0]])
    lower = bounds.lower.astype(float) - moves[near[:, 1:]]
    outer = bounds.outer.astype(float) - moves.max()
    return Bounds(near, _down(lower), upper, _down(outer))


def reassign(rows: np.ndarray, book: np.ndarray, bounds: Bounds, used: np.ndarray) -> Bounds:
    """Bounds with the nearest entry of the moved ``book``; ``used[z]`` counts cases that needed the first z entries."""
    b = bounds.near.shape[1]
    near, lower, upper, outer = bounds.near.copy(), bounds.lower.copy(), bounds.upper.copy(), bounds.outer.copy()
    # rest[:, z] is a lower bound for all entries but the first z + 1.
    rest = np.minimum.accumulate(np.concatenate([lower, outer[:, None]], 1)[:, ::-1], axis=1)[:, ::-1]
    open_ = np.flatnonzero(upper >= rest[:, 0])
    if len(open_):
        own = squared(rows[open_], book[near[open_, :1].astype(int)])[:, 0]
        upper[open_] = _up(np.sqrt(own.astype(float)))
        open_ = open_[upper[open_] >= rest[open_, 0]]
    need = (upper[open_, None] >= rest[open_]).sum(axis=1) + 1  # rest falls towards the front, so these come first
    used += np.bincount(need, minlength=len(used))[: len(used)]
    for z in range(2, b + 1):
        at = open_[need == z]
        if len(at):
            ids = near[at, :z].astype(int)
            far = squared(rows[at], book[ids])
            order = np.lexsort((ids, far), axis=1)
            apart = np.sqrt(np.take_along_axis(far, order, 1).astype(float))
            near[at, :z] = np.take_along_axis(ids, order, 1)
            upper[at], lower[at, : z - 1] = _up(apart[:, 0]), _down(apart[:, 1:])
    at = open_[need > b]
    if len(at):
        new = assign_all(rows[at], book, b)
        near[at], lower[at], upper[at], outer[at] = new.near, new.lower, new.upper, new.outer
    return Bounds(near, lower, upper, outer)


def shrink(bounds: Bounds, b: int) -> Bounds:
    """The same with fewer entries; what is dropped goes into the outer bound."""
    if b >= bounds.near.shape[1]:
        return bounds
    outer = np.minimum(bounds.outer, bounds.lower[:, b - 1 :].min(axis=1))
    return Bounds(bounds.near[:, :b], bounds.lower[:, : b - 1], bounds.upper, outer)


def next_size(used: np.ndarray, b: int, entries: int) -> int:
    """The b of the next round: least that covers most undecided cases, never more than now (``used[z]``: cases by need)."""
    least = min(b, max(2, round(entries * LEAST_SHARE)))
    if not used.sum():
        return least
    enough = int(np.searchsorted(np.cumsum(used), COVERED * used.sum()))
    return max(least, min(b, enough))


def _ints(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _unpacked(column: pa.Array, kind: np.dtype, width: int) -> np.ndarray:
    """Rows of bytes as a matrix of numbers."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat.view(kind).reshape(len(column), width)


def _packed(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    ends = np.arange(n + 1, dtype=np.int32) * np.int32(width * matrix.itemsize)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix))])


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.reshape(-1), pa.int64()))


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a bounded amount of numbers, none empty."""
    rows = max(1, NUMBERS_AT_ONCE // width)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


@dataclass(frozen=True)
class Round:
    """What a task needs: the codebooks, how far entries moved, and b by part before and in this round."""

    books: np.ndarray  # (parts, entries, d)
    moves: np.ndarray | None  # (parts, entries); None: the first round, vectors are lists and all distances are computed
    old_b: tuple[int, ...]
    b: tuple[int, ...]
    kind: np.dtype  # of the components in bytes


def _pass(batches: Iterator[pa.RecordBatch], now: Round) -> Iterator[pa.RecordBatch]:
    """(id, label, vector[, near, bounds]) to the same with new state; at the end one row of sums and uses."""
    parts, k, d = now.books.shape
    sums = np.zeros((parts, k, d + 1), np.int64)
    used = np.zeros((parts, k + 2), np.int64)
    kinds = None
    old = sum(now.old_b)
    for batch in _slices(batches, parts * d):
        if now.moves is None:
            rows = _ints(batch.column(2), parts * d)
        else:
            rows = _unpacked(batch.column(2), now.kind, parts * d)
            near = _unpacked(batch.column(3), np.dtype(np.int8), old)
            bounds = _unpacked(batch.column(4), np.dtype(np.float32), old + parts)
        rows = rows.astype(np.int64)
        held: list[Bounds] = []
        at = 0
        for p in range(parts):
            mine = rows[:, p * d : (p + 1) * d]
            if now.moves is None:
                done = assign_all(mine, now.books[p], now.b[p])
            else:
                b = now.old_b[p]
                # Lower bounds of a part, its upper and its outer bound follow each other.
                of = bounds[:, at + p : at + p + b + 1]
                before = Bounds(near[:, at : at + b], of[:, : b - 1], of[:, b - 1], of[:, b])
                at += b
                done = reassign(mine, now.books[p], moved(shrink(before, now.b[p]), now.moves[p]), used[p])
            held.append(done)
            code = done.near[:, 0].astype(int)
            np.add.at(sums[p], code, np.concatenate([mine, np.ones((len(mine), 1), np.int64)], 1))
        state = [
            _packed(rows.astype(now.kind)) if now.moves is None else batch.column(2),
            _packed(np.concatenate([h.near for h in held], 1)),
            _packed(np.concatenate([x for h in held for x in (h.lower, h.upper[:, None], h.outer[:, None])], 1)),
        ]
        empty = [pa.nulls(batch.num_rows, pa.list_(pa.int64()))] * 2
        done = pa.RecordBatch.from_arrays([*batch.columns[:2], *state, *empty], NAMES)
        kinds = done.schema.types
        yield done
    if kinds:
        nothing = [pa.nulls(1, kind) for kind in kinds[:5]]
        yield pa.RecordBatch.from_arrays([*nothing, _lists(sums.reshape(1, -1)), _lists(used.reshape(1, -1))], NAMES)


def _total(found: DataFrame, column: str, length: int) -> np.ndarray:
    """Elementwise sum of the tasks' lists; one row per task comes in, ``length`` numbers come out."""
    each = found.filter(F.col(column).isNotNull()).select(F.posexplode(column).alias("i", "x"))
    out = np.zeros(length, np.int64)
    for row in each.groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[row["i"]] = row["x"]
    return out


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    """The table written and read back, and its folder."""
    path = scratch_path(df.sparkSession, "codes")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _forget(spark: SparkSession, path: str) -> None:
    """Delete a round's table that the next round has replaced."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """``id, label, vector`` with whole-number vectors floor(scale * x), without unusable rows."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").alias("label"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.filter(finite & (F.size("vector") > 0))
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("bigint")))


@dataclass(frozen=True)
class Codes:
    """Assigned rows (``id, label, vector, near, ...``) and their folder, the codebooks (parts, entries, d), and b by part and round."""

    rows: DataFrame
    path: str
    books: np.ndarray
    sizes: list[tuple[int, ...]]
    asked: list[int]
    kind: np.dtype

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def learn_codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes | None:
    """Codebooks and final codes of ``id, label, vector``; None for an empty table.

    The first codebook are the vectors of the ``entries`` smallest ids (all, if
    fewer), ids that repeat by their vectors, rows without an id last.  All
    vectors must have one length that ``parts`` divides, and components that
    leave room for exact squared distances; anything else is an error.
    """
    spark = rows.sparkSession
    rows, path = _write(rows)
    first = [r["vector"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()]
    if not first:
        return None  # nothing was written but the empty table
    width = len(first[0])
    biggest = F.array_max(F.transform("vector", F.abs))
    seen = rows.agg(F.min(F.size("vector")).alias("short"), F.max(F.size("vector")).alias("long"), F.max(biggest).alias("big")).first()
    if seen["short"] != seen["long"] or width % parts:
        raise ValueError(f"vectors need one length that {parts} divides, found {seen['short']} to {seen['long']}")
    if (2 * seen["big"]) ** 2 * (width // parts) >= 2**62:
        raise ValueError(f"components up to {seen['big']} leave no room for exact squared distances")
    books = np.array(first, np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    k = len(first)
    b = (max(2, round(k * FIRST_SHARE)) if k > 1 else 1,) * parts
    kind = rows.schema["label"].dataType.simpleString()
    schema = f"id bigint, label {kind}, {STATE}"
    width_of = np.dtype(next(t for t in ("<i2", "<i4", "<i8") if seen["big"] <= np.iinfo(t).max))
    now, held, sizes, asked = Round(books, None, b, b, width_of), rows, [], []
    for turn in range(rounds + 1):
        source = held.select("id", "label", "vector", "near", "bounds") if turn else held
        found, onward = _write(source.mapInArrow(lambda batches, now=now: _pass(batches, now), schema))
        _forget(spark, path)
        path = onward
        held = found.filter("vector is not null")
        sizes.append(now.b)
        used = _total(found, "used", parts * (k + 2)).reshape(parts, k + 2)
        asked.append(int(used.sum()))
        if turn == rounds:
            break
        sums = _total(found, "sums", parts * k * (width // parts + 1)).reshape(parts, k, -1)
        count = sums[:, :, -1:]
        new = np.where(count > 0, np.floor_divide(sums[:, :, :-1], np.maximum(count, 1)), books)
        moves = np.sqrt(((new - books).astype(float) ** 2).sum(axis=2)) * (1 + SLACK)
        b = tuple(next_size(used[p], now.b[p], k) if turn else now.b[p] for p in range(parts)) if k > 1 else now.b
        now, books = Round(new, moves, now.b, b, width_of), new
    return Codes(held, path, books, sizes, asked, width_of)


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, b: tuple[int, ...], kind: np.dtype) -> Iterator[pa.RecordBatch]:
    """(id, label, vector, near) to (id, label, code, error)."""
    parts, _, d = books.shape
    starts = np.cumsum([0, *b[:-1]])
    for batch in _slices(batches, parts * d):
        rows = _unpacked(batch.column(2), kind, parts * d).astype(np.int64)
        codes = _unpacked(batch.column(3), np.dtype(np.int8), sum(b))[:, starts].astype(int)
        error = np.zeros(len(rows), np.int64)
        for p in range(parts):
            error += squared(rows[:, p * d : (p + 1) * d], books[p][codes[:, p], None])[:, 0]
        text = [bytes(c).hex() for c in codes.astype(np.uint8)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error)], ["id", "label", "code", "error"])


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """``id_col, code, error, label_error, codebooks_sha256``, one row per usable input row.

    ``code`` has two hex digits per part, ``error`` is the summed squared
    distance in whole numbers, ``label_error`` its sum over equal labels (NULLs
    together).  Rows whose vector is NULL, empty or holds a NULL or a number
    that is not finite are dropped.  Rows that repeat an id are rows of their
    own.  Other columns are not read.  See ``learn_codes`` for what is an error.
    """
    spark = vectors.sparkSession
    if not 1 <= entries <= 127:
        raise ValueError("entries must be between 1 and 127")
    done = learn_codes(whole_vectors(vectors, id_col, vector_col, label_col, scale), parts, entries, rounds)
    kind = vectors.select(F.col(f"`{label_col}`")).schema[0].dataType.simpleString()
    if done is None:
        return spark.createDataFrame([], f"`{id_col}` bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    books, b, width = done.books, done.sizes[-1], done.kind
    coded = done.rows.select("id", "label", "vector", "near").mapInArrow(
        lambda batches: _coded(batches, books, b, width), f"id bigint, label {kind}, code string, error bigint"
    )
    coded = materialize(coded)
    _forget(spark, done.path)
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "same"))
    side = F.broadcast(sums) if fits_broadcast(sums) else sums
    known = coded.join(side, F.col("label").eqNullSafe(F.col("same")))
    return known.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(done.sha256).alias("codebooks_sha256"))
