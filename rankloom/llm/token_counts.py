"""Token counts with a shortcut for whole tokens.

Offline, on the driver, every vocabulary string is merged by itself; those that
end as one piece are proved to count one wherever they stand alone between two
cuts that no merge crosses.  A pre-token in that set is one token.  Only the
others are merged, and short ones are remembered per task.  No ids are made.

Rows pass one by one through ``mapInArrow``; there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.batches import pieces
from rankloom.llm.sp_model import MergeModel, marked, splitter

CACHED_CHARS = 48
CACHED_PARTS = 400_000


class Counts(dict):
    """Number of tokens of a pre-token: 1 for whole tokens, else counted by merging."""

    def __init__(self, model: MergeModel, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.model, self.whole = model, whole
        self.chars = frozenset(p for p in model.ids if len(p) == 1)

    def __missing__(self, part: str) -> int:
        if self.chars.issuperset(part):
            n = len(self.model.merge(part))
        else:
            n = begin = 0
            for i, char in enumerate(part):
                if char not in self.chars:
                    n += (len(self.model.merge(part[begin:i])) if begin < i else 0) + len(char.encode("utf-8"))
                    begin = i + 1
            if begin < len(part):
                n += len(self.model.merge(part[begin:]))
        if len(part) <= CACHED_CHARS:
            if len(self) >= CACHED_PARTS + len(self.whole):
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[part] = n
        return n


def count_tokens(docs: DataFrame, model: MergeModel, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens), one row per input row.

    NULL counts as the empty text: no byte, no token.  Begin, end and added
    special tokens are not counted; special strings inside a text are ordinary
    text.  Other columns are not read, so their names cannot clash; repeated
    rows give repeated rows and an empty table gives none.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    whole = model.whole()
    schema = T.StructType(
        [T.StructField("id", source.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, split = Counts(model, whole), splitter(model)
        for piece in pieces(batches, 1):
            texts = piece.column(1).to_pylist()
            tokens = [sum(map(counts.__getitem__, split.findall(marked(model, t)))) for t in texts]
            sizes = [len(t.encode("utf-8")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    counted = source.mapInArrow(run, schema)
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
