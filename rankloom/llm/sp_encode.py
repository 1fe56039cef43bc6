"""Exact SentencePiece encoding by backtracking, and decoding.

A text is cut where no piece can span the cut; each part is encoded from left
to right.  An Aho-Corasick automaton gives the longest piece at every position.
A piece is accepted if the position behind it has not failed before and if
re-merging it with the piece to its left gives exactly the two pieces (the
merges of both are taken back from the latest on, and at no point may the two
pieces that meet at the cut have a merge that comes first).  Else
the next shorter piece is tried, and when none is left the position is marked as
failed in a bit field and the piece before it is taken back.  Every position
fails once at most, so the work is linear in the text, and the result is the
one that merging by priority gives.

Rows pass one by one through ``mapInArrow``: no shuffle, nothing collected, and
a lost executor only repeats its own scan splits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.batches import pieces
from rankloom.llm.sp_model import BYTE, CONTROL, NEVER, SPACE, UNKNOWN, MergeModel, marked, splitter

# Parts up to this length are remembered, at most twice so many of them per task.
CACHED_CHARS = 48
CACHED_PARTS = 200_000
# The same for pairs of pieces.
CACHED_PAIRS = 400_000


class Encoder:
    def __init__(self, model: MergeModel, alone: frozenset[str] | None = None):
        """``alone``: the pieces that their own text merges into; others never occur in an encoding."""
        import ahocorasick

        self.model, self.split = model, splitter(model)
        alone = model.whole() if alone is None else alone
        self.halves = model.halves(alone)
        self.chars = frozenset(p for p in model.ids if len(p) == 1)
        self.automaton = ahocorasick.Automaton()
        for piece in alone:
            self.automaton.add_word(piece, (len(piece) - 1, piece))
        self.automaton.make_automaton()
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in alone), None) for p in alone}
        self.fits: dict[tuple[str, str], bool] = {}
        self.parts = _Parts(self)

    def compatible(self, left: str, right: str) -> bool:
        """Whether the text of both merges into exactly these two pieces."""
        rank, halves = self.model.rank, self.halves
        if not all(len(piece) == 1 or piece in halves for piece in (left, right)):
            return self.model.merge(left + right) == [left, right]
        left_until = right_until = NEVER  # the merge that uses each up
        while True:
            made = rank.get(left + right)
            # Of equal merges the leftmost comes first, so one inside the left piece wins.
            if made is not None and made < left_until and made <= right_until:
                return False
            last_left = rank[left] if left in halves else -1
            last_right = rank[right] if right in halves else -1
            if last_left < 0 and last_right < 0:
                return True
            if last_left > last_right:
                left_until, left = last_left, halves[left][1]
            else:
                right_until, right = last_right, halves[right][0]

    def known_part(self, part: str) -> list[str]:
        """Pieces of a part whose characters are all pieces."""
        # Matches come by their end, so the longest of each start comes last.
        longest = {end - back: piece for end, (back, piece) in self.automaton.iter(part)}
        n, fits, shorter, failed = len(part), self.fits, self.shorter, None
        out: list[str] = []
        at, piece, left = 0, longest[0], None
        while True:
            while piece is not None:
                end = at + len(piece)
                if failed is None or not failed[end]:
                    if left is None:
                        break
                    fit = fits.get((left, piece))
                    if fit is None:
                        if len(fits) > CACHED_PAIRS:
                            fits.clear()
                        fit = fits[left, piece] = self.compatible(left, piece)
                    if fit:
                        break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                if end == n:
                    return out
                at, left, piece = end, piece, longest[end]
            else:
                if left is None:
                    raise ValueError(f"no encoding of {part[:40]!r}")
                if failed is None:
                    failed = bytearray(n + 1)
                failed[at] = 1
                piece = out.pop()
                at -= len(piece)
                left = out[-1] if out else None

    def part(self, part: str) -> tuple[int, ...]:
        """Ids of a part; a character that is no piece becomes its bytes."""
        ids = self.model.ids
        if self.chars.issuperset(part):
            return tuple(map(ids.__getitem__, self.known_part(part)))
        out, begin = [], 0
        for i, char in enumerate(part):
            if char not in ids:
                if begin < i:
                    out += map(ids.__getitem__, self.known_part(part[begin:i]))
                out += [self.model.byte_ids[b] for b in char.encode("utf-8")]
                begin = i + 1
        if begin < len(part):
            out += map(ids.__getitem__, self.known_part(part[begin:]))
        return tuple(out)

    def encode(self, text: str | None, end: bool = True) -> list[int]:
        found = self.split.findall(marked(self.model, text or ""))
        out = list(chain.from_iterable(map(self.parts.__getitem__, found)))
        if end:
            out.append(self.model.end_id)
        return out


class _Parts(dict):
    """Ids of short parts; long ones are encoded anew each time.

    When it is full it becomes the older half, from which parts that are met
    again come back, so frequent parts are never forgotten.
    """

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, part: str) -> tuple[int, ...]:
        ids = self.older.get(part)
        if ids is None:
            ids = self.encoder.part(part)
        if len(part) <= CACHED_CHARS:
            if len(self) >= CACHED_PARTS:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


class Decoder:
    """Text of ids: control pieces say nothing, byte pieces are UTF-8, one leading space is taken off."""

    def __init__(self, model: MergeModel):
        self.model = model
        self.bytes = [self._text(i) for i in range(len(model.pieces))]
        self.silent = {i for i, kind in enumerate(model.types) if kind == CONTROL}

    def _text(self, token: int) -> bytes:
        kind, piece = self.model.types[token], self.model.pieces[token]
        if kind == CONTROL:
            return b""
        if kind == BYTE:
            return bytes([self.model.byte_ids.index(token)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return piece.replace(SPACE, " ").encode()

    def decode(self, ids: Iterable[int] | None) -> str:
        ids = list(ids or ())
        if ids and ids[-1] in self.silent:
            ids.pop()
        if self.silent.isdisjoint(ids):
            runs = [ids]
        else:  # bytes on two sides of a control piece make no common character
            runs = [list(run) for silent, run in groupby(ids, self.silent.__contains__) if not silent]
        raw = [b"".join(map(self.bytes.__getitem__, run)) for run in runs]
        if self.model.add_prefix and raw and raw[0][:1] == b" " and self.model.pieces[runs[0][0]].startswith(SPACE):
            raw[0] = raw[0][1:]
        try:
            return "".join(run.decode("utf-8") for run in raw)
        except UnicodeDecodeError:
            return "".join(map(_lenient, raw))


def _lenient(raw: bytes) -> str:
    """Every byte that begins no valid character becomes one replacement mark."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def encode_texts(
    docs: DataFrame, model: MergeModel, id_col: str = "doc_id", text_col: str = "text", end: bool = True, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``id_col``, the columns in ``keep`` and the ids of the text (``ids array<int>``), one row per input row.

    NULL counts as the empty text, whose ids are the end id alone.  Other
    columns are not read, so their names cannot clash.  Repeated rows and ids
    give repeated rows; an empty table gives none.
    """
    kept = [f"k_{c}" for c in keep]
    source = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)]
    )
    names = ["id", *kept, "ids"]
    schema = T.StructType([*[source.schema[n] for n in names[:-1]], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    alone = model.whole()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, alone)
        for piece in pieces(batches, 1):
            ids = [encoder.encode(t, end) for t in piece.column(1).to_pylist()]
            others = [c for i, c in enumerate(piece.columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*others, pa.array(ids, pa.list_(pa.int32()))], names)

    return source.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, **dict(zip(kept, keep))})


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    """Rows of a list column; a NULL row is empty."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield values[begin:end].tolist()


def decode_ids(encoded: DataFrame, model: MergeModel, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, the ids and their text (``decoded string``); NULL ids give the empty text."""
    source = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    schema = T.StructType([*source.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for piece in pieces(batches, 1):
            texts = [decoder.decode(ids) for ids in _lists(piece.column(1))]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    return source.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, "ids": ids_col})
