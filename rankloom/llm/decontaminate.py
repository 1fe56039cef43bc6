"""Benchmark decontamination by templates.

Words become a template: numbers, names (capitalised words inside a sentence,
runs of them as one) and units (behind a number) are replaced by typed
placeholders, everything else is lower-cased.  Windows of a template are
hashed; document windows are joined with benchmark windows on the hash.  A
match of a document and an item holds only if it is consistent: one value of a
slot in the item always stands for one value in the document and the other way
round.  So questions with other numbers and names are caught too.

Document windows are made in one pass over the texts.  A bit map of fixed size
over the benchmark's hashes drops most of those without a partner before the
join (it has no false negatives), so the join gets few rows whatever side is
large, and nothing of the documents is broadcast or collected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.batches import pieces
from rankloom.session import materialize

WINDOW = 8
LEAST_WORDS = 4  # of a window that are no placeholders
LEAST_WINDOWS = 3
LITERAL = 1 << 32  # sets hashes of tokens apart from those of templates
BITS = 24
CACHED_WORDS = 400_000
CACHED_LENGTH = 48

# Words that are a unit behind a number.
UNITS = frozenset(
    """mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs
    pound pounds oz ounce ounces ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day
    days week weeks month months year years dollar dollars euro euros cent cents usd eur gbp percent degree degrees
    celsius fahrenheit kmh mph hz khz mhz ghz w kw kwh v volt volts kb mb gb tb""".split()
)
_TOKEN = re.compile(r"[.!?\n]|\d+(?:[.,]\d+)*|[^\W\d_]+")
END, WORD, NUMBER = 0, 1, 2
_MULTIPLIER = 0x9E3779B97F4A7C15
# Stand-ins of the placeholders in the hash of a template.
NUM_SLOT, NAME_SLOT, UNIT_SLOT = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3


class Templates:
    """Windows of texts; properties of words are remembered, up to a bound."""

    def __init__(self, window: int = WINDOW, least_words: int = LEAST_WORDS):
        self.window, self.least_words = window, least_words
        self.at: dict[str, int] = {}
        self.hashes = np.zeros(1024, np.uint64)
        self.kinds = np.zeros((1024, 3), np.uint8)  # kind, capitalised, unit
        self.powers = np.array([pow(_MULTIPLIER, k + 1, 1 << 64) for k in range(window)], np.uint64)

    def _add(self, word: str) -> int:
        import xxhash

        index = len(self.at)
        if index == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.kinds = np.concatenate([self.kinds, np.zeros_like(self.kinds)])
        lower = word.lower()
        kind = END if word in ".!?\n" else NUMBER if word[0].isdecimal() else WORD
        self.hashes[index] = xxhash.xxh64_intdigest(lower.encode("utf-8", "surrogatepass"))
        self.kinds[index] = (kind, word[0].isupper(), lower in UNITS)
        self.at[word] = index
        return index

    def _tokens(self, text: str | None) -> np.ndarray:
        words = _TOKEN.findall(text or "")
        if len(self.at) + len(words) > CACHED_WORDS:
            self.at.clear()
        at, add = self.at, self._add
        return np.fromiter((at[w] if w in at else add(w) for w in words), np.int64, len(words))

    def _hashes(self, code: np.ndarray, size: int, seed: int) -> np.ndarray:
        n = len(code) - size + 1
        total = np.full(n, seed, np.uint64)
        for k in range(size):
            total += code[k : k + n] * self.powers[k]
        total ^= total >> np.uint64(29)
        total *= np.uint64(_MULTIPLIER)
        total ^= total >> np.uint64(32)
        return total

    def windows(self, text: str | None, wanted: np.ndarray | None = None, sizes: Sequence[int] | None = None) -> list[tuple[int, int, list[int]]]:
        """Place, hash and slot values of the windows, of those in the bit map if there is one.

        Windows have the lengths ``sizes``; without, a template shorter than a
        window is one window.  Windows with fewer than ``least_words`` words that
        are no placeholders say too little and are left out.  A slot's value is a
        hash of the words that stand there.
        """
        return self._windows(self._tokens(text), wanted, sizes)

    def _windows(self, index: np.ndarray, wanted: np.ndarray | None, sizes: Sequence[int] | None) -> list[tuple[int, int, list[int]]]:
        kinds, value = self.kinds[index], self.hashes[index]
        kind = kinds[:, 0]
        before = np.concatenate([[END], kind])[:-1]
        unit = (kind == WORD) & (kinds[:, 2] == 1) & (before == NUMBER)
        name = (kind == WORD) & (kinds[:, 1] == 1) & (before != END) & ~unit
        number = kind == NUMBER
        code = np.where(number, np.uint64(NUM_SLOT), np.where(name, np.uint64(NAME_SLOT), np.where(unit, np.uint64(UNIT_SLOT), value)))
        slot = number | name | unit
        keep = kind != END
        later = name & np.concatenate([[False], name])[:-1]  # a name of several words is one slot
        if later.any():
            first = np.flatnonzero(~later)
            value = value.copy()
            value[first] = np.add.reduceat(value, first)
            keep &= ~later
        code, slot, value = code[keep], slot[keep], value[keep]
        signed = value.view(np.int64)
        out = []
        for size in [min(self.window, len(code))] if sizes is None else sizes:
            n = len(code) - size + 1
            if not size or n < 1:
                continue
            total = self._hashes(code, size, size)
            plain = np.zeros(n, np.int64)
            for k in range(size):
                plain += ~slot[k : k + n]
            good = plain >= min(self.least_words, size)
            if wanted is not None:
                good &= _listed(wanted, total)
            out += [
                (g, h, signed[g : g + size][slot[g : g + size]].tolist())
                for g, h in zip(np.flatnonzero(good).tolist(), total[good].view(np.int64).tolist())
            ]
        return out

    def _literal(self, index: np.ndarray, wanted: np.ndarray | None, sizes: Sequence[int] | None) -> list[tuple[int, int, list[int]]]:
        """The same for windows of the lower-cased tokens themselves, without placeholders."""
        code = self.hashes[index[self.kinds[index, 0] != END]]
        out = []
        for size in [min(self.window, len(code))] if sizes is None else sizes:
            if size and len(code) >= size:
                total = self._hashes(code, size, LITERAL + size)
                good = np.ones(len(total), bool) if wanted is None else _listed(wanted, total)
                out += [(g, h, []) for g, h in zip(np.flatnonzero(good).tolist(), total[good].view(np.int64).tolist())]
        return out

    def item_windows(self, text: str | None) -> list[tuple[int, int, list[int], int, bool]]:
        """Windows of an item with their length and whether they are literal.

        An item with few windows, those at its begin aside (the words before a
        copy decide there what is a name), also has literal ones, so that its
        verbatim copies are found.
        """
        index = self._tokens(text)
        found = self._windows(index, None, None)
        kinds = self.kinds[index, 0]
        raw = int((kinds != END).sum())
        size = self._template_size(index)
        out = [(*w, size, False) for w in found]
        if sum(place > 1 for place, _, _ in found) < LEAST_WINDOWS:
            out += [(*w, min(self.window, raw), True) for w in self._literal(index, None, None)]
        return out

    def _template_size(self, index: np.ndarray) -> int:
        kinds = self.kinds[index]
        kind = kinds[:, 0]
        before = np.concatenate([[END], kind])[:-1]
        name = (kind == WORD) & (kinds[:, 1] == 1) & (before != END) & ~((kinds[:, 2] == 1) & (before == NUMBER))
        later = name & np.concatenate([[False], name])[:-1]
        return min(self.window, int(((kind != END) & ~later).sum()))

    def document_windows(self, text: str | None, wanted: np.ndarray, sizes: Sequence[int], literal: Sequence[int]) -> list[tuple[int, int, list[int], int, bool]]:
        """Windows of a document of the lengths that the items have."""
        index = self._tokens(text)
        out = [(*w, 0, False) for w in self._windows(index, wanted, sizes)]
        return out + [(*w, 0, True) for w in self._literal(index, wanted, literal)] if literal else out


def _listed(wanted: np.ndarray, total: np.ndarray) -> np.ndarray:
    place = total >> np.uint64(64 - BITS)
    return (wanted[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def template_windows(
    texts: DataFrame,
    id_col: str,
    text_col: str,
    wanted: bytes | None = None,
    window: int = WINDOW,
    least_words: int = LEAST_WORDS,
    sizes: Sequence[int] = (),
    literal: Sequence[int] = (),
) -> DataFrame:
    """``id, row, place, hash, slots, size, literal``: the windows of every text; with a bit map those of a document, else of an item.

    ``row`` is a digest of the text, which tells rows apart that share an id.
    """
    source = texts.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", source.schema["id"].dataType),
            T.StructField("row", T.BinaryType()),
            T.StructField("place", T.LongType()),
            T.StructField("hash", T.LongType()),
            T.StructField("slots", T.ArrayType(T.LongType())),
            T.StructField("size", T.LongType()),
            T.StructField("literal", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        templates = Templates(window, least_words)
        bits = None if wanted is None else np.frombuffer(wanted, np.uint8)
        for piece in pieces(batches, 1):
            owner, found, rows = [], [], []
            for n, text in enumerate(piece.column(1).to_pylist()):
                here = templates.item_windows(text) if bits is None else templates.document_windows(text, bits, sizes, literal)
                owner += [n] * len(here)
                found += here
                rows += [xxhash.xxh3_128_digest((text or "").encode("utf-8"))] * len(here) if here else []
            if owner:
                places, hashes, slots, lengths, literals = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(pa.array(owner, pa.int64())),
                        pa.array(rows, pa.binary()),
                        pa.array(places, pa.int64()),
                        pa.array(hashes, pa.int64()),
                        pa.array(slots, pa.list_(pa.int64())),
                        pa.array(lengths, pa.int64()),
                        pa.array(literals, pa.bool_()),
                    ],
                    schema.names,
                )

    return source.mapInArrow(run, schema)


def bit_map(windows: DataFrame) -> bytes:
    """2**24 bits, one set for the upper bits of every hash: 2 MB however large the benchmark is."""
    place = F.shiftrightunsigned("hash", 64 - BITS)
    words = windows.groupBy(F.shiftright(place, 5).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITS}) & 31 as int))")).alias("bits")
    )
    out = np.zeros(1 << (BITS - 5), "<u4")
    found = words.collect()  # at most 2**19 rows of two numbers
    out[[r["word"] for r in found]] = [r["bits"] for r in found]
    return out.tobytes()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    least_windows: int = LEAST_WINDOWS,
) -> DataFrame:
    """``id_col, item_col, n_windows, item_windows, verbatim``: documents that hold a benchmark item or a variant of it.

    ``n_windows`` counts the item's windows in the largest consistent copy in
    the document, of ``item_windows``; a pair is returned from
    ``least_windows`` on (or all, if the item has fewer).  ``verbatim`` says
    that all slots of that copy have the item's own values.  NULL and empty texts hold nothing
    and leak nothing.  Every text is searched by itself, also where rows share
    an id or have none; their pair is returned once, with the larger copy.
    Repeated rows count once.  Other columns are not read.
    """
    items = materialize(
        template_windows(benchmark, item_col, item_text_col, None, window)
        .distinct()
        .select(F.col("id").alias("item"), F.col("row").alias("item_row"), F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots"), "size", "literal")
    )
    lengths = [(r["size"], r["literal"]) for r in items.select("size", "literal").distinct().collect()]  # at most 2 x window rows
    sizes, literal = (sorted(n for n, is_literal in lengths if is_literal == kind) for kind in (False, True))
    totals = items.groupBy("item", "item_row", "literal").agg(F.countDistinct("item_place").alias("item_windows"))
    totals = totals.select(F.col("item").alias("of"), F.col("item_row").alias("of_row"), F.col("literal").alias("kind"), "item_windows")
    met = template_windows(docs, id_col, text_col, bit_map(items), window, sizes=sizes, literal=literal).drop("size", "literal")
    pairs = met.join(items, "hash").withColumn("shift", F.col("place") - F.col("item_place"))
    # One copy of an item has one shift; its windows must agree on what stands for what.
    values = F.zip_with("item_slots", "slots", lambda was, now: F.struct(was.alias("was"), now.alias("now")))
    copies = pairs.groupBy("id", "row", "item", "item_row", "literal", "shift").agg(
        F.countDistinct("item_place").alias("n_windows"), F.array_distinct(F.flatten(F.collect_set(values))).alias("values")
    )
    one_way = F.size("values") == F.size(F.array_distinct(F.transform("values", lambda v: v["was"])))
    other_way = F.size("values") == F.size(F.array_distinct(F.transform("values", lambda v: v["now"])))
    verbatim = F.forall("values", lambda v: v["was"] == v["now"])
    best = (
        copies.filter(one_way & other_way)
        .groupBy("id", "row", "item", "item_row", "literal")
        .agg(F.max(F.struct("n_windows", verbatim.alias("verbatim"))).alias("best"))
    )
    same = F.col("item").eqNullSafe(F.col("of")) & (F.col("item_row") == F.col("of_row")) & (F.col("literal") == F.col("kind"))
    found = best.join(totals, same)
    found = found.filter(F.col("best.n_windows") >= F.least(F.lit(least_windows), F.col("item_windows")))
    # A copy that both kinds of windows find is told by its template.
    told = found.groupBy("id", "row", "item", "item_row").agg(F.min(F.struct("literal", "best.n_windows", "item_windows", "best.verbatim")).alias("told"))
    told = told.groupBy("id", "item").agg(F.max(F.struct("told.n_windows", "told.verbatim", "told.item_windows")).alias("told"))
    return told.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "told.n_windows", "told.item_windows", "told.verbatim")
