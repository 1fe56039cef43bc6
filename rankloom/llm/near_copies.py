"""Near copies by the Jaccard similarity of their five-word shingles, found by SimHash.

Candidates come from wide SimHash fingerprints through tables of distances to
pivots (``simhash.near_prints``), and every link is verified by the exact
similarity of the sets of shingle hashes.  Of pairs with similarity 0.8 or more
hardly any lies within two of 64 bits, so fingerprints have 1,024 bits and the
radius is that of such pairs; no pair below 0.8 is linked.

Texts with one set are one class, so copies are never paired.  A class is first
held against the smallest of its partners: the pair is dropped if the whole
fingerprints are too far apart, and a set travels once per pair that is left.
Only groups of connected fingerprints that these links leave in several
components are compared further, on fingerprints in blocks of bounded size, and
the sets of the few classes with a partner there in blocks of bounded bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.batches import pieces
from rankloom.llm.bitmap import bit_map
from rankloom.llm.blocks import by_block, in_blocks
from rankloom.llm.components import components
from rankloom.llm.simhash import WIDE, WideHash, near_prints, print_matrix, wide_distances, within
from rankloom.session import materialize

WORDS = 5
# Bytes of sets that meet in a block, about; a larger set is a chunk of its own.
BLOCK_BYTES = 8 << 20
PAIRS_AT_ONCE = 1 << 15
CACHED_WORDS = 150_000
_MULTIPLIER = 0x9E3779B97F4A7C15


class Shingler:
    """Sets of shingle hashes; hashes of words are remembered, up to a bound."""

    def __init__(self):
        self.at: dict[bytes, int] = {}
        self.powers = np.array([pow(_MULTIPLIER, k + 1, 1 << 64) for k in range(WORDS)], np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted hashes of the five-word shingles; a shorter text is one shingle, a blank one has none."""
        import xxhash

        found = (text or "").encode("utf-8").lower().split()  # bytes: A-Z, and the six white space bytes
        if not found:
            return np.zeros(0, np.uint64)
        at = self.at
        if len(at) + len(found) > CACHED_WORDS:
            at.clear()
        for word in set(found).difference(at):
            at[word] = xxhash.xxh64_intdigest(word)
        value = np.fromiter(map(at.__getitem__, found), np.uint64, len(found))
        size = min(WORDS, len(found))
        n = len(found) - size + 1
        total = np.full(n, size, np.uint64)
        for k in range(size):
            total += value[k : k + n] * self.powers[k]
        total ^= total >> np.uint64(29)
        total *= np.uint64(_MULTIPLIER)
        total ^= total >> np.uint64(32)
        return np.unique(total)


def _class(shingles: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).view(np.int64))


def _signed(docs: DataFrame) -> DataFrame:
    """``id, class, print`` of ``id, text``; a text without a shingle has no fingerprint."""
    schema = T.StructType([docs.schema["id"], T.StructField("class", T.LongType()), T.StructField("print", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, wide = Shingler(), WideHash()
        for piece in pieces(batches, 1):
            sets = [shingler.shingles(t) for t in piece.column(1).to_pylist()]
            prints = [wide(s) if len(s) else None for s in sets]
            columns = [piece.column(0), pa.array([_class(s) for s in sets], pa.int64()), pa.array(prints, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "class", "print"])

    return docs.mapInArrow(run, schema)


def _sets(texts: DataFrame) -> DataFrame:
    """``class, set`` of ``class, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for piece in pieces(batches, 1):
            sets = [shingler.shingles(t).view(np.int64) for t in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sets, pa.list_(pa.int64()))], ["class", "set"])

    return texts.mapInArrow(run, "class bigint, set array<bigint>")


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, fingerprint of a, of b) that are near by all bits."""
    for batch in batches:
        if batch.num_rows:
            near = wide_distances(print_matrix(batch.column(2)), print_matrix(batch.column(3))) <= within(WIDE)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(near)) for c in batch.columns[:2]], ["a", "b"])


def _open_pairs(rows: pa.Table) -> pa.RecordBatch | None:
    """Classes of a block with a partner: of another component, alike by fingerprint, neither being the head that was compared before."""
    rows = rows.combine_chunks()
    chunk, label, head = (rows.column(c).to_numpy() for c in ("chunk", "label", "head"))
    names, meet = rows.column("class").to_numpy(), rows.column("meet")[0].as_py()
    _, i, j = rows.column("block")[0].as_py()
    split = int((chunk == chunk[0]).sum())
    if i != j and split == len(names):
        return None
    prints = print_matrix(rows.column("print"))
    first, other = np.arange(split if i != j else len(names)), np.arange(split if i != j else 0, len(names))
    found = np.zeros(len(names), bool)
    step = max(1, PAIRS_AT_ONCE // len(other))
    for at in range(0, len(first), step):
        x = first[at : at + step]
        fresh = (label[x, None] != label[None, other]) & (names[x] != head[x])[:, None] & (names[other] != head[other])[None, :]
        a, b = np.nonzero(fresh)
        near = wide_distances(prints[x[a]], prints[other[b]]) <= within(WIDE)
        found[x[a[near]]] = True
        found[other[b[near]]] = True
    out = np.flatnonzero(found)
    return pa.RecordBatch.from_arrays([pa.array(names[out]), pa.array(np.full(len(out), meet, np.int64))], ["class", "meet"])


def _compare(rows: pa.Table) -> pa.RecordBatch | None:
    """Links of a block as stars; pairs that are connected already are not compared."""
    rows = rows.combine_chunks()
    names, chunk = rows.column("class").to_numpy(), rows.column("chunk").to_numpy()
    _, i, j = rows.column("block")[0].as_py()
    n, split = len(names), int((chunk == chunk[0]).sum())
    if i != j and split == n:
        return None
    sets = rows.column("set").combine_chunks()
    sets = sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets
    offsets = sets.offsets.to_numpy()
    codes = np.unique(sets.flatten().to_numpy(), return_inverse=True)[1]
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    marked = np.zeros(int(codes.max()) + 1, bool)
    label = np.arange(n)
    for at in range(n if i == j else split):
        other = np.arange(at + 1 if i == j else split, n)
        fits = 5 * np.minimum(sizes[other], sizes[at]) >= 4 * np.maximum(sizes[other], sizes[at])
        other = other[fits & (label[other] != label[at])]
        if not len(other):
            continue
        own = codes[offsets[at] : offsets[at + 1]]
        marked[own] = True
        shared = np.add.reduceat(marked[codes], offsets[:-1], dtype=np.int64)[other]
        marked[own] = False
        near = other[5 * shared >= 4 * (sizes[other] + sizes[at] - shared)]
        if len(near):
            joined = np.isin(label, label[np.append(near, at)])
            label[joined] = label[joined].min()
    out = np.flatnonzero(label != np.arange(n))
    return pa.RecordBatch.from_arrays([pa.array(names[out]), pa.array(names[label[out]])], ["a", "b"])


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, component_id``, one row per input row; rows of one id have one text.

    ``component_id`` is the smallest id that links of similarity 0.8 or more
    reach, the row's own included.  NULL and blank texts are copies of each other.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = materialize(_signed(source))
    classes = materialize(signed.groupBy("class").agg(F.min("id").alias("first"), F.first("print").alias("print")))
    found = materialize(near_prints(classes.filter("print is not null")))
    prints = lambda side: classes.select(F.col("class").alias(side), F.col("print").alias(f"print_{side}"))
    pairs = found.filter("direct").join(prints("a"), "a").join(prints("b"), "b").select("a", "b", "print_a", "print_b")
    pairs = materialize(pairs.mapInArrow(_alike, "a bigint, b bigint"))

    def sets_of(wanted: DataFrame) -> DataFrame:
        """Sets of classes, each from the text of its smallest id."""
        chosen = materialize(classes.join(wanted.select("class").distinct(), "class", "left_semi").select("class", "first"))
        # Most texts have no part in this: they are passed over where they lie.
        near = source.filter(bit_map(chosen, "first")(F.col("id")))
        texts = near.join(chosen, F.col("id") == F.col("first")).select("class", "text")
        return materialize(_sets(texts).dropDuplicates(["class"]))

    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("class")))
    side = lambda name: sets.select(F.col("class").alias(name), F.col("set").alias(f"set_{name}"))
    shared, total = F.size(F.array_intersect("set_a", "set_b")), F.size("set_a") + F.size("set_b")
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(5 * F.least(F.size("set_a"), F.size("set_b")) >= 4 * F.greatest(F.size("set_a"), F.size("set_b")))
    links = materialize(both.filter(5 * shared >= 4 * (total - shared)).select("a", "b"))
    labels = components(links)

    # Groups of two were compared; of the others, those that hold several components go on.
    near = components(found.select("a", "b")).select(F.col("node").alias("class"), F.col("component").alias("meet"))
    met = near.unionByName(near.select(F.col("meet").alias("class"), "meet").distinct())
    labelled = met.join(labels.withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.select("meet", "class", F.col("meet").alias("head"), F.coalesce("component", "class").alias("label"))
    open_ = labelled.groupBy("meet").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"))
    open_ = open_.filter("n > 2 and low <> high").select("meet")
    rows = labelled.join(open_, "meet").join(classes.select("class", "print"), "class")
    blocks = in_blocks(rows, "meet", F.col("class")).select("class", "block", "chunk", "meet", "label", "head", "print")
    left = materialize(blocks.mapInArrow(lambda batches: by_block(batches, 1, _open_pairs), "class bigint, meet bigint").distinct())
    weighed = left.join(sets_of(left), "class").withColumn("bytes", F.size("set").cast("bigint") * 8)
    blocks = in_blocks(weighed, "meet", F.col("class"), size="bytes", limit=BLOCK_BYTES).select("class", "block", "chunk", "set")
    more = materialize(blocks.mapInArrow(lambda batches: by_block(batches, 1, _compare), "a bigint, b bigint"))
    joined = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    labels = components(joined)
    labelled = classes.join(labels.withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.select("class", "first", F.coalesce("component", "class").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    named = labelled.select("class", "label").join(smallest, "label").select("class", "component_id")
    return signed.select("id", "class").join(named, "class").select(F.col("id").alias(id_col), "component_id")
