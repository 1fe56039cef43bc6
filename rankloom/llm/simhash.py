"""SimHash near-duplicates found through tables of distances to pivots.

A fingerprint is known by its Hamming distances to many reference fingerprints
(pivots).  Two fingerprints within r bits differ by r at most in every
distance.  The 64 bits are cut into r + 1 runs; a pair within r bits agrees in
one of them, and then all distances to pivots that differ from the zero pivot
only within that run have equal offsets from the distance to the zero pivot.
So pairs meet by a hash join on those offsets, are discarded when the largest
coordinate difference exceeds r, and survivors are verified bit by bit.  No
pair within r bits is lost.

Documents with one fingerprint are one class, so copies are never paired.
Classes that share offsets are compared in blocks of bounded size, and a block
returns a spanning forest of its links instead of all pairs.

Sets of similarity 0.8 differ in 10 of 64 bits, where unlike texts are found as
well.  They are told by wide fingerprints of 1,024 bits, of which they differ in
160 to 200 and unlike ones in 512.  At that radius no run must agree, so there
are as many runs, each short, as let a pair miss all of them once in 2,500
times; the join key is again the offsets of a run's pivots.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from math import ceil, log, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.batches import pieces
from rankloom.llm.blocks import by_block, in_blocks
from rankloom.llm.components import components, smallest_labels
from rankloom.session import materialize

HASH_SEED = 42
PIVOT_SEED = 7
PIVOTS_PER_RUN = 8
COUNTED = 1 << 15

WIDE = 1024
# 64-bit words of a wide fingerprint that travel to the blocks.
SHOWN = 4
# A bit of two sets of similarity 0.8 differs with this probability at most (8 of 10 shingles; 0.152 for long texts).
DIFFERS = 0.1915
MISSED = 1 / 2500
# Bits of a run: so many that about half as many classes as this share one by chance, eight at least.
RUN_ROWS = 4096
LEAST_BITS = 8
WIDE_PIVOTS = 16
TIES = 64
PAIRS_AT_ONCE = 1 << 18


def fingerprint(text: str | None, words: int) -> int:
    """Bit i is set if it is set in over half of the hashes of the ``words``-word shingles."""
    import xxhash

    found = (text or "").encode("utf-8").lower().split()  # bytes: A-Z, and the six white space bytes
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    starts = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
    ends = starts + sizes
    if len(found) > words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = partial(xxhash.xxh64_intdigest, seed=HASH_SEED)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), COUNTED):
        spans = zip(starts[at : at + COUNTED].tolist(), ends[at : at + COUNTED].tolist())
        hashes = np.array([digest(joined[s:e]) for s, e in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``id, fp bigint``, one row per document; NULL and blank texts have fingerprint 0."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 1):
            found = np.array([fingerprint(t, words) for t in piece.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    return source.mapInArrow(run, schema)


@cache
def pivots(radius: int, per_run: int = PIVOTS_PER_RUN, seed: int = PIVOT_SEED) -> tuple[tuple[int, ...], ...]:
    """Reference fingerprints of each of the ``radius + 1`` runs of bits: random within the run, zero elsewhere."""
    rng = np.random.default_rng(seed)
    edges = np.linspace(0, 64, radius + 2).round().astype(int)
    runs = []
    for low, high in zip(edges[:-1], edges[1:]):
        bits = rng.integers(0, 2, (per_run, high - low))
        runs.append(tuple(int(sum(int(b) << int(low + k) for k, b in enumerate(row))) for row in bits))
    return tuple(runs)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def meeting_keys(fp: Column, radius: int) -> Column:
    """One hash per run over the offsets of its pivots' distances from the zero pivot's."""
    keys = []
    for number, run in enumerate(pivots(radius)):
        offsets = [F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))) - F.bit_count(fp) for p in run]
        keys.append(F.xxhash64(F.lit(number), *offsets))
    return F.array(*keys)


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    table = np.array([0, *[p for run in pivots(radius) for p in run]], np.uint64)

    def work(rows: pa.Table) -> pa.RecordBatch | None:
        fp = rows.column("fp").to_numpy().view(np.uint64)
        chunk = rows.column("chunk").to_numpy()
        split = int((chunk == chunk[0]).sum())
        coordinates = np.bitwise_count(fp[:, None] ^ table[None, :]).astype(np.int16)
        _, i, j = rows.column("block")[0].as_py()
        if i == j:
            left, right = np.triu_indices(len(fp), 1)
        elif split == len(fp):
            return None
        else:
            left, right = (x.ravel() for x in np.meshgrid(np.arange(split), np.arange(split, len(fp)), indexing="ij"))
        for k in range(len(table)):
            near = np.abs(coordinates[left, k] - coordinates[right, k]) <= radius
            left, right = left[near], right[near]
            if not len(left):
                return None
        near = np.bitwise_count(fp[left] ^ fp[right]) <= radius
        left, right = left[near], right[near]
        label = smallest_labels(len(fp), left, right)
        out = np.flatnonzero(label != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[out]), pa.array(signed[label[out]])], ["a", "b"])

    yield from by_block(batches, 1, work)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """``id_col, fingerprint, component_id``, one row per input row.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the smallest
    id that links of at most ``radius`` differing bits reach, the row's own
    included (NULL ids do not count, unless a component has no other).  NULL,
    empty and blank texts have fingerprint 0 and are linked like any other.
    Other columns are not read; repeated rows give repeated rows.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, words))
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")))
    met = classes.select("fp", F.explode(meeting_keys(F.col("fp"), radius)).alias("meet"))
    blocks = in_blocks(met, "meet", F.col("fp")).select("fp", "block", "chunk")
    links = blocks.mapInArrow(lambda batches: _links(batches, radius), "a bigint, b bigint")
    labels = components(links)
    labelled = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("label")
    )
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    named = labelled.select("fp", "label").join(smallest, "label").select("fp", "component_id")
    done = prints.join(named, "fp")
    return done.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


class WideHash:
    """Fingerprints of ``WIDE`` bits of sets of 64-bit shingle hashes."""

    def __init__(self):
        rng = np.random.default_rng(HASH_SEED)
        self.turn = rng.integers(0, 1 << 64, WIDE // 64, np.uint64)
        self.odd = rng.integers(0, 1 << 64, WIDE // 64, np.uint64) | np.uint64(1)

    def __call__(self, shingles: np.ndarray) -> bytes:
        """Bit i is set if it is set in over half of the shingles' hashes; a tie is decided by weights that they carry."""
        ones = np.zeros(WIDE, np.int64)
        tie = ones
        for at in range(0, len(shingles), 255):  # a byte per bit holds their sum
            hashes = shingles[at : at + 255, None] ^ self.turn
            hashes ^= hashes >> np.uint64(33)
            hashes *= self.odd
            hashes ^= hashes >> np.uint64(32)
            hashes *= np.uint64(0x9FB21C651E98DF25)
            hashes ^= hashes >> np.uint64(31)
            bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), axis=1, bitorder="little")
            if not at:
                # Ties of larger sets are rare.
                some = slice(0, TIES if len(shingles) <= TIES else 1)
                weight = (shingles[some] >> np.uint64(44)).astype(np.float32) + 1
                tie = weight @ (2 * bits[some].astype(np.float32) - 1) > 0
            ones += bits.view(np.uint64).sum(axis=0, dtype=np.uint64).view(np.uint8)
        return np.packbits(2 * ones + tie > len(shingles), bitorder="little").tobytes()


def within(bits: int) -> int:
    """Differing bits, of so many, that a pair of similarity 0.8 hardly ever exceeds; unlike ones differ in half of them."""
    return int(bits * DIFFERS + 5.5 * sqrt(bits * DIFFERS * (1 - DIFFERS)))


def runs_for(classes: int) -> tuple[int, int]:
    """Number of runs and their bits for so many classes.  The runs lie side by side in the fingerprint."""
    bits = max(LEAST_BITS, ceil(log2(max(classes, 1) * 2 / RUN_ROWS)))
    return min(WIDE // bits, ceil(log(MISSED) / log(1 - (1 - DIFFERS) ** bits))), bits


def print_matrix(prints: pa.Array) -> np.ndarray:
    """Fingerprints as rows of 64-bit words."""
    return np.frombuffer(b"".join(prints.to_pylist()), "<u8").reshape(len(prints), -1)


def wide_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def _run_rows(classes: DataFrame, runs: int, bits: int) -> DataFrame:
    """``class, meet, w0..`` of ``class, print``: a row per run, with a hash over the offsets of its pivots' distances."""
    shown = [f"w{k}" for k in range(SHOWN)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(PIVOT_SEED)
        table = rng.integers(0, 2, (runs, bits, WIDE_PIVOTS)).astype(np.float32)
        weight = table.sum(axis=1, keepdims=True)
        factor = rng.integers(-(1 << 63), 1 << 63, (runs, WIDE_PIVOTS + 1), np.int64)
        for piece in pieces(batches, 1):
            words = print_matrix(piece.column(1))
            n = len(words)
            fp = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")[:, : runs * bits]
            # The distance to a pivot less that to the zero pivot, by run, row and pivot.
            offsets = weight - 2 * np.matmul(fp.reshape(n, runs, bits).transpose(1, 0, 2).astype(np.float32), table)
            meet = (offsets.astype(np.int64) * factor[:, None, 1:]).sum(axis=2) + factor[:, :1]
            columns = [np.tile(c, runs) for c in (piece.column(0).to_numpy(), *words.view(np.int64)[:, :SHOWN].T)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (columns[0], meet.ravel(), *columns[1:])], ["class", "meet", *shown])

    schema = ", ".join(f"{name} bigint" for name in ("class", "meet", *shown))
    return classes.select("class", "print").mapInArrow(run, schema)


def _near_prints(rows: pa.Table) -> pa.RecordBatch | None:
    """Pairs of a block: every class with its smallest partner, and stars over what partners connect (not direct)."""
    rows = rows.combine_chunks()
    chunk = rows.column("chunk").to_numpy()
    _, i, j = rows.column("block")[0].as_py()
    n, split = len(chunk), int((chunk == chunk[0]).sum())
    if i != j and split == n:
        return None
    names = rows.column("class").to_numpy()
    words = [rows.column(f"w{k}").to_numpy().view(np.uint64) for k in range(SHOWN)]
    rank = np.argsort(np.argsort(names))
    sorted_names = np.sort(names)
    least, label = np.full(n, n), np.arange(n)
    step = max(1, PAIRS_AT_ONCE // n)
    for at in range(0, n if i == j else split, step):
        x = np.arange(at, min(at + step, n if i == j else split))
        y = np.arange(at if i == j else split, n)
        apart = np.bitwise_count(words[0][x, None] ^ words[0][None, y])
        apart += np.bitwise_count(words[1][x, None] ^ words[1][None, y])
        a, b = np.nonzero(apart <= within(128))
        a, b = x[a], y[b]
        a, b = a[a != b], b[a != b]
        near = sum(np.bitwise_count(w[a] ^ w[b]).astype(np.int64) for w in words) <= within(64 * SHOWN)
        a, b = rank[a[near]], rank[b[near]]
        if len(a):
            np.minimum.at(least, a, b)
            np.minimum.at(least, b, a)
            label = smallest_labels(n, np.concatenate([np.arange(n), a]), np.concatenate([label, b]))
    direct, star = np.flatnonzero(least < n), np.flatnonzero(label != np.arange(n))
    ends = [np.concatenate([sorted_names[direct], sorted_names[star]]), np.concatenate([sorted_names[least[direct]], sorted_names[label[star]]])]
    kind = np.arange(len(ends[0])) < len(direct)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(*ends)), pa.array(np.minimum(*ends)), pa.array(kind)], ["a", "b", "direct"])


def near_prints(classes: DataFrame) -> DataFrame:
    """``a, b, direct`` of ``class bigint, print binary``, a stored table with a row per class.

    Classes within the radius on the shown bits are connected by these rows;
    where ``direct`` is set, a and b are within it themselves, and every class
    is so paired with the smallest of its partners that meets it in a run.
    Blank fingerprints are left out by the caller.
    """
    runs, bits = runs_for(classes.count())
    dealt = in_blocks(_run_rows(classes, runs, bits), "meet", F.col("class"), chunk_rows=RUN_ROWS, few_groups=True)
    blocks = dealt.select("class", "block", "chunk", *[f"w{k}" for k in range(SHOWN)])
    return blocks.mapInArrow(lambda batches: by_block(batches, 1, _near_prints), "a bigint, b bigint, direct boolean").distinct()
