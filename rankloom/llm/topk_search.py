"""Exact top-k search by inner product, block at a time.

Rows are put in an order that keeps like vectors together (cells fitted on a
bounded sample, then ids) and cut into blocks of consecutive rows.  A block
stores its rows (a forward index) and, per term (component), the largest and
smallest weight.  For a query the summed term maxima bound every score in a
block; blocks are scored in falling order of their bounds until the bound is
below the k-th best score found.  Blocks of one shard are kept together, and
a shard has the term maxima of all its blocks.

Two passes: every query first searches the shard that holds it, which gives a
k-th score to start from; then it goes to every other shard whose bound reaches
that score.  A task holds one shard and a bounded number of queries.  Scores
are whole numbers; nothing is approximate, whatever order or cells are used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.embedding_dedup import spherical_kmeans
from rankloom.session import materialize

BLOCK_ROWS = 64
SHARD_ROWS = 8192
# Queries that meet a shard, or shards that meet a chunk of queries, in one task.
CHUNK_QUERIES = 8192
GROUP_SHARDS = 1024
SAMPLE_ROWS = 8192
MAX_CELLS = 1024
CELL_ROWS = 512
NUMBERS_AT_ONCE = 1 << 20

BLOCKS = (
    "shard bigint, size int, row array<bigint>, id array<bigint>, query array<boolean>, vector array<bigint>, "
    "low array<bigint>, high array<bigint>, shard_low array<bigint>, shard_high array<bigint>"
)
QUERIES = "row bigint, query_id bigint, size int, vector array<bigint>, shard bigint, kth bigint, id array<bigint>, score array<bigint>"
FOUND = "row bigint, query_id bigint, id array<bigint>, score array<bigint>"


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact left @ right.T of whole numbers."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if most < 2**53:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    if most < 2**63:
        return left @ right.T
    raise OverflowError("an inner product may not fit into 64 bits")


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Summed term maxima (queries, blocks): no row within [low, high] scores more."""
    return products(np.maximum(queries, 0), high) + products(np.minimum(queries, 0), low)


class Best:
    """The k best (score, then smaller id) of each of n queries; ``floor`` is a score known to be reached."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.n, self.k = n, k
        self.query, self.id, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.floor = np.full(n, np.iinfo(np.int64).min) if floor is None else floor.copy()

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids, score = np.concatenate([self.query, query]), np.concatenate([self.id, ids]), np.concatenate([self.score, score])
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        full = rank == self.k - 1
        self.floor[query[full]] = np.maximum(self.floor[query[full]], score[full])
        keep = rank < self.k
        self.query, self.id, self.score = query[keep], ids[keep], score[keep]

    def lists(self, values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(self.query, np.arange(self.n + 1)), pa.int32()), pa.array(values))


def search_shard(vectors: np.ndarray, own: np.ndarray, best: Best, shard: dict) -> int:
    """Score the blocks of a shard for all queries, each in its own order; returns scored (query, block) pairs.

    Waves of 1, 2, 4, ... blocks per query: a wave scores block after block for
    the queries that have it next, and raises the k-th scores before the next.
    """
    limit = bounds(vectors, shard["low"], shard["high"])
    order = np.argsort(-limit, axis=1, kind="stable")
    begin, width, scored = 0, 1, 0
    alive = np.arange(len(vectors))
    while begin < order.shape[1] and len(alive):
        wave = order[alive, begin : begin + width]
        wanted = np.take_along_axis(limit[alive], wave, 1) >= best.floor[alive, None]
        who, blocks = np.repeat(alive, wave.shape[1])[wanted.reshape(-1)], wave[wanted]
        sort = np.argsort(blocks, kind="stable")
        who, blocks = who[sort], blocks[sort]
        scored += len(who)
        cuts = np.flatnonzero(np.diff(blocks, prepend=-1))
        new, size = [], 0
        for at, end in zip(cuts, [*cuts[1:], len(blocks)]):
            rows, ids, block = shard["blocks"][blocks[at]]
            step = max(1, NUMBERS_AT_ONCE // max(1, len(rows)))
            for q in (who[i : min(i + step, end)] for i in range(at, end, step)):
                score = products(vectors[q], block)
                good = (score >= best.floor[q, None]) & (rows[None, :] != own[q, None])
                x, y = np.nonzero(good)
                new.append((q[x], ids[y], score[x, y]))
                size += len(x)
                if size > NUMBERS_AT_ONCE:
                    best.add(*map(np.concatenate, zip(*new)))
                    new, size = [], 0
        if new:
            best.add(*map(np.concatenate, zip(*new)))
        begin, width = begin + width, width * 2
        if begin < order.shape[1]:
            alive = alive[limit[alive, order[alive, begin]] >= best.floor[alive]]
    return scored


def _numbers(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, width)


def _shard(blocks: pa.Table) -> dict:
    """A shard's blocks as arrays."""
    size = blocks.column("size")[0].as_py()
    parts = []
    for b in range(blocks.num_rows):
        row, ids, vector = (blocks.column(c)[b].values.to_numpy() for c in ("row", "id", "vector"))
        parts.append((row, ids, vector.reshape(len(row), size)))
    return {"size": size, "blocks": parts, "low": _numbers(blocks.column("low"), size), "high": _numbers(blocks.column("high"), size)}


def _rows_of(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(matrix.reshape(-1)))


def _cells(batches: Iterator[pa.RecordBatch], centres: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(id, query, size, vector) to the same with the cell of the nearest centroid."""
    for batch in batches:
        size = batch.column(2).to_numpy()
        cell = np.zeros(len(size), np.int32)
        for width, centre in centres.items():
            at = np.flatnonzero(size == width)
            rows = max(1, NUMBERS_AT_ONCE // max(width, len(centre)))
            for piece in (at[i : i + rows] for i in range(0, len(at), rows)):
                vectors = batch.column(3).take(pa.array(piece)).flatten().to_numpy().reshape(-1, width)
                cell[piece] = (vectors.astype(float) @ centre.T).argmax(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])


def _pack(batches: Iterator[pa.RecordBatch], block_rows: int, shard_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (id, query, size, vector, row) of a partition to blocks; shards are named by their first row."""
    held: list[pa.RecordBatch] = []
    count, width = 0, None

    def shard() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        vectors = _numbers(rows.column("vector"), width)
        cuts = np.arange(0, len(vectors), block_rows)
        ends = np.append(cuts, len(vectors))
        low, high = np.minimum.reduceat(vectors, cuts), np.maximum.reduceat(vectors, cuts)
        cut = lambda values, by: pa.ListArray.from_arrays(pa.array(ends * by, pa.int32()), values)
        n = len(cuts)
        of_shard = [pa.array([m.tolist()] + [None] * (n - 1), pa.list_(pa.int64())) for m in (low.min(0), high.max(0))]
        first = rows.column("row")[0].as_py()
        flat = {c: rows.column(c).combine_chunks() for c in ("row", "id", "query")}
        columns = [pa.array(np.full(n, first)), pa.array(np.full(n, width), pa.int32()), *[cut(flat[c], 1) for c in ("row", "id", "query")]]
        columns += [cut(pa.array(vectors.reshape(-1)), width), _rows_of(low), _rows_of(high), *of_shard]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in BLOCKS.split(", ")])

    for batch in batches:
        sizes = batch.column(2).to_numpy()
        at = 0
        while at < len(sizes):
            if width is not None and (count == shard_rows or sizes[at] != width):
                yield shard()
                held, count = [], 0
            width = int(sizes[at])
            change = np.flatnonzero(sizes[at:] != width)
            end = min(at + shard_rows - count, at + (int(change[0]) if len(change) else len(sizes) - at))
            held.append(batch.slice(at, end - at))
            count, at = count + end - at, end
    if held:
        yield shard()


def index_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The written block table of ``id, query, vector`` (whole numbers, not empty): ``BLOCKS``.

    All rows are indexed; only the cells, which decide the order, are fitted on
    ``SAMPLE_ROWS`` rows.  Vectors of different lengths are in different shards.
    """
    rows = materialize(rows.withColumn("size", F.size("vector")).select("id", "query", "size", "vector"))
    count = rows.count()
    sample = rows.orderBy(F.xxhash64("vector", F.lit(11)), "vector").select("vector").limit(SAMPLE_ROWS).collect()
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(len(r["vector"]), []).append(r["vector"])
    centres = {}
    for size, vectors in by_size.items():
        plain = np.array(vectors, float)
        plain = plain[np.abs(plain).max(axis=1) > 0]
        if len(plain):
            plain /= np.linalg.norm(plain, axis=1, keepdims=True)
            centres[size] = spherical_kmeans(plain, max(1, min(MAX_CELLS, math.ceil(count / CELL_ROWS))))
    celled = rows.mapInArrow(lambda b: _cells(b, centres), "id bigint, query boolean, size int, vector array<bigint>, cell int")
    # The row's place in the input breaks ties, so a range can be cut within equal rows.
    keys = ["size", "cell", "id", "_at"]
    spread = celled.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = spread.withColumn("row", F.monotonically_increasing_id()).select("id", "query", "size", "vector", "row")
    return materialize(numbered.mapInArrow(lambda b: _pack(b, block_rows, shard_rows), BLOCKS))


def _home(blocks: pa.Table, k: int) -> pa.Table:
    """The queries of a shard, searched in it."""
    shard = _shard(blocks)
    size = shard["size"]
    asks = np.concatenate([blocks.column("query")[b].values.to_numpy(zero_copy_only=False) for b in range(blocks.num_rows)])
    rows, ids, vectors = (np.concatenate([part[i] for part in shard["blocks"]])[asks] for i in range(3))
    best = Best(len(rows), k)
    search_shard(vectors, rows, best, shard)
    known = best.floor > np.iinfo(np.int64).min
    columns = [
        pa.array(rows),
        pa.array(ids),
        pa.array(np.full(len(rows), size), pa.int32()),
        _rows_of(vectors),
        pa.array(np.full(len(rows), blocks.column("shard")[0].as_py(), np.int64)),
        pa.array(best.floor, mask=~known),
        best.lists(best.id),
        best.lists(best.score),
    ]
    return pa.Table.from_arrays(columns, [f.split()[0] for f in QUERIES.split(", ")])


def _floor(queries: pa.Table) -> np.ndarray:
    return queries.column("kth").fill_null(np.iinfo(np.int64).min).to_numpy()


def _meets(queries: pa.Table, shards: pa.Table) -> pa.Table:
    """Queries (row, query_id, size, vector, shard, kth) and the other shards (shard, low, high) whose bound they must look behind."""
    out = []
    if queries.num_rows and shards.num_rows:
        size = queries.column("size")[0].as_py()
        names, home, floor = shards.column("shard").to_numpy(), queries.column("shard").to_numpy(), _floor(queries)
        low, high = (_numbers(shards.column(c), size) for c in ("shard_low", "shard_high"))
        vectors = _numbers(queries.column("vector"), size)
        step = max(1, NUMBERS_AT_ONCE // max(len(names), size))
        for at in range(0, len(vectors), step):
            piece = slice(at, at + step)
            reach = (bounds(vectors[piece], low, high) >= floor[piece, None]) & (names[None, :] != home[piece, None])
            q, s = np.nonzero(reach)
            found = queries.select(["row", "query_id", "vector", "kth"]).take(pa.array(q + at))
            out.append(found.append_column("shard", pa.array(names[s])))
    return pa.concat_tables(out).select(["shard", "row", "query_id", "vector", "kth"]) if out else _MET.empty_table()


_MET = pa.schema(
    [("shard", pa.int64()), ("row", pa.int64()), ("query_id", pa.int64()), ("vector", pa.list_(pa.int64())), ("kth", pa.int64())]
)
_FOUND = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("id", pa.list_(pa.int64())), ("score", pa.list_(pa.int64()))])


def _away(queries: pa.Table, blocks: pa.Table, k: int) -> pa.Table:
    """Queries (shard, row, query_id, vector, kth) searched in a shard that is not their own."""
    if not queries.num_rows or not blocks.num_rows:
        return _FOUND.empty_table()
    shard = _shard(blocks)
    rows, vectors = queries.column("row").to_numpy(), _numbers(queries.column("vector"), shard["size"])
    best = Best(len(rows), k, _floor(queries))
    search_shard(vectors, rows, best, shard)
    return pa.Table.from_arrays([queries.column("row"), queries.column("query_id"), best.lists(best.id), best.lists(best.score)], schema=_FOUND)


def top_k(
    vectors: DataFrame,
    every: int = 50,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, id_col, score``: each query's ``k`` rows of highest inner product, ties to the smaller id.

    Components become floor(scale * x).  Queries are the rows whose id is
    divisible by ``every``; candidates all other rows of the same length (fewer
    than ``k`` give fewer rows).  Rows whose id or vector is NULL, whose vector
    is empty or holds a NULL or a number that is not finite take no part.  Rows
    that repeat an id are queries and candidates of their own.  Scores that
    might not fit into 64 bits are an error.  Other columns are not read.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.filter(F.col("id").isNotNull() & finite & (F.size("vector") > 0))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("bigint")))
    blocks = index_blocks(rows.withColumn("query", F.col("id") % every == 0), block_rows, shard_rows)

    home = materialize(blocks.drop("shard_low", "shard_high").groupBy("shard").applyInArrow(lambda t: _home(t, k), QUERIES))
    shards = blocks.filter(F.col("shard_low").isNotNull()).select("shard", "size", "shard_low", "shard_high")
    chunks = max(1, math.ceil(home.count() / CHUNK_QUERIES))
    groups = max(1, math.ceil(shards.count() / GROUP_SHARDS))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    chunk = lambda name: F.pmod(F.xxhash64(F.col(name), F.lit(2)), F.lit(chunks)).cast("int")
    asking = home.select("row", "query_id", "size", "vector", "shard", "kth", chunk("row").alias("chunk"), all_of(groups).alias("group"))
    dealt = shards.withColumns({"group": F.pmod(F.xxhash64("shard", F.lit(4)), F.lit(groups)).cast("int"), "chunk": all_of(chunks)})
    same = ["size", "chunk", "group"]
    met = asking.groupBy(*same).cogroup(dealt.groupBy(*same)).applyInArrow(
        _meets, "shard bigint, row bigint, query_id bigint, vector array<bigint>, kth bigint"
    )
    met = materialize(met.withColumn("chunk", chunk("row")))
    copied = blocks.drop("shard_low", "shard_high", "query").withColumn("chunk", all_of(chunks))
    away = met.groupBy("shard", "chunk").cogroup(copied.groupBy("shard", "chunk")).applyInArrow(lambda q, b: _away(q, b, k), FOUND)
    found = home.select("row", "query_id", "id", "score").unionByName(away)
    pairs = found.select("row", "query_id", F.explode(F.arrays_zip("id", "score")).alias("f")).select("row", "query_id", "f.id", "f.score")
    place = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    ranked = pairs.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
