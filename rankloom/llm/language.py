"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram binds the vectors of
its letters, each rotated by its position, by multiplication; a text bundles
its n-grams by addition; a language's prototype bundles the training texts of
that language, each scaled to length one.  A text belongs to the prototype with
the largest cosine.

Learning reduces each task's texts to one vector per language before the
shuffle, and prototypes are summed by language and dimension, so what is
gathered has (languages x dimensions) rows per task whatever the skew.
Predicting goes row by row without a shuffle; prototypes are a small matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.batches import pieces

DIMENSIONS = 1024
SIZE = 3
SEED = 20240613
UNKNOWN = "und"
# Steps of the fixed grid on which vectors are summed, so that sums do not depend on their order.
GRID = 1 << 20
CACHED_GRAMS = 30_000
# Letters of a text that are counted at once; longer texts are counted in parts.
CHUNK = 1 << 20


class Encoder:
    """Vectors of texts; n-gram vectors are remembered, up to a bound."""

    def __init__(self, dimensions: int = DIMENSIONS, size: int = SIZE, seed: int = SEED):
        self.dimensions, self.size, self.seed = dimensions, size, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.grams = np.zeros((1024, dimensions), np.float32)
        self.word = np.zeros(0x110000, np.uint32)  # a letter itself, 0 unknown yet, 1 for everything else

    def letter(self, code: int) -> np.ndarray:
        known = self.letters.get(code)
        if known is None:
            signs = np.random.default_rng((self.seed, code)).integers(0, 2, self.dimensions)
            known = self.letters[code] = (2 * signs - 1).astype(np.float32)
        return known

    def codes(self, text: str) -> np.ndarray:
        """Letters in lower case, with one blank (1) for every run of other characters, and around the text."""
        raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        new = np.unique(raw[self.word[raw] == 0])
        for code in new.tolist():
            self.word[code] = code if chr(code).isalpha() else 1
        codes = np.concatenate(([1], self.word[raw], [1])).astype(np.uint64)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 1) | (codes[:-1] != 1)
        return codes[keep]

    def _row(self, packed: int) -> int:
        row = self.rows.get(packed)
        if row is None:
            row = len(self.rows)
            if row == len(self.grams):
                self.grams = np.concatenate([self.grams, np.zeros_like(self.grams)])
            vector = np.ones(self.dimensions, np.float32)
            for k in range(self.size):
                code = (packed >> (21 * (self.size - 1 - k))) & 0x1FFFFF
                vector = vector * np.roll(self.letter(code), self.size - 1 - k)
            self.grams[row] = vector
            self.rows[packed] = row
        return row

    def vector(self, text: str) -> np.ndarray | None:
        """The bundle of all n-grams, in double precision; None without a letter."""
        codes = self.codes(text)
        if len(codes) < 2 or not (codes != 1).any():
            return None
        total = np.zeros(self.dimensions)
        for begin in range(0, len(codes), CHUNK):
            part = codes[begin : begin + CHUNK + self.size - 1]
            n = len(part) - self.size + 1
            if n <= 0:
                continue
            packed = np.zeros(n, np.uint64)
            for k in range(self.size):
                packed = (packed << np.uint64(21)) | part[k : k + n]
            grams, counts = np.unique(packed, return_counts=True)
            for at in range(0, len(grams), CACHED_GRAMS // 4):
                few = grams[at : at + CACHED_GRAMS // 4].tolist()
                if len(self.rows) + len(few) > CACHED_GRAMS:
                    self.rows.clear()
                rows = [self._row(g) for g in few]
                # Sums of whole numbers below 2**24 are exact in single precision.
                total += counts[at : at + CACHED_GRAMS // 4].astype(np.float32) @ self.grams[rows]
        return total


@dataclass(frozen=True)
class Profiles:
    """Prototypes by language, and how vectors are made."""

    languages: tuple[str, ...]
    matrix: np.ndarray  # a unit row per language
    dimensions: int = DIMENSIONS
    size: int = SIZE
    seed: int = SEED


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, size: int = SIZE, seed: int = SEED) -> Profiles:
    """Prototypes from all rows with a text and a language; rows without either teach nothing.

    The number of languages must fit the driver: one vector each is collected.
    """
    source = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    source = source.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("dim", T.IntegerType()), T.StructField("total", T.LongType())])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dimensions, size, seed)
        sums: dict[str, np.ndarray] = {}
        for piece in pieces(batches, 1):
            for lang, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                vector = encoder.vector(text)
                if vector is None:
                    continue
                length = np.sqrt(vector @ vector)
                if length > 0:
                    unit = np.rint(vector / length * GRID).astype(np.int64)
                    sums[lang] = sums[lang] + unit if lang in sums else unit
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(total)], ["lang", "dim", "total"]
            )

    rows = source.mapInArrow(bundle, schema).groupBy("lang", "dim").agg(F.sum("total").alias("total"))
    each = rows.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("dim", "total"))).alias("v")).select("lang", F.col("v.total").alias("v"))
    found = sorted((r["lang"], r["v"]) for r in each.collect())
    matrix = np.array([v for _, v in found], float).reshape(len(found), dimensions)
    norms = np.sqrt((matrix**2).sum(1, keepdims=True))
    return Profiles(tuple(lang for lang, _ in found), matrix / np.where(norms > 0, norms, 1), dimensions, size, seed)


def predict_language(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns in ``keep``, ``lang_pred`` and ``score``, one row per input row.

    The score is the cosine with the winning prototype, cut to 0 to 1; equal
    cosines go to the language that sorts first.  A text that is NULL or has no
    letter, and any text if nothing was learned, is ``und`` with score 0.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep])
    names = ["id", *[f"k_{c}" for c in keep]]
    schema = T.StructType([*[source.schema[n] for n in names], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    languages, matrix = profiles.languages, profiles.matrix
    dimensions, size, seed = profiles.dimensions, profiles.size, profiles.seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dimensions, size, seed)

        def judge(text: str | None) -> tuple[str, float]:
            vector = encoder.vector(text) if text is not None and languages else None
            if vector is None:
                return UNKNOWN, 0.0
            length = np.sqrt(vector @ vector)
            cosines = np.round(matrix @ vector / (length if length > 0 else 1), 12)
            best = int(np.argmax(cosines))
            return languages[best], float(min(1.0, max(0.0, cosines[best])))

        for piece in pieces(batches, 1):
            said = [judge(t) for t in piece.column(1).to_pylist()]
            columns = [c for i, c in enumerate(piece.columns) if i != 1]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([x for x, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())], [*names, "lang_pred", "score"]
            )

    return source.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, **{f"k_{c}": c for c in keep}})


def held_out(id_col: Column) -> Column:
    """Every fifth document by a checksum of its id; a NULL id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(True))
