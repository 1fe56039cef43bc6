"""A merge-type SentencePiece model: its file, its merges and what follows from them.

The model file is a protocol buffer; the few fields needed here are read
directly.  Supported are models without user-defined pieces, with the identity
normalizer and byte fallback, in which no piece has the space mark behind
another character.  Others are refused, since the results would not be exact.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

SPACE = "▁"
# Fixed values of the model format: piece types and the merge-type algorithm.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGE_TYPE = 2
NEVER = 1 << 60
# Above so many symbols merges are found with a heap.
SHORT = 24


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


@dataclass
class MergeModel:
    """Pieces by id, their merge priority, and the ids of the byte pieces."""

    pieces: list[str]
    types: list[int]
    scores: list[float]
    add_prefix: bool = True
    ids: dict[str, int] = field(init=False)
    rank: dict[str, int] = field(init=False)  # 0 merges first; equal scores share a rank
    byte_ids: list[int] = field(init=False)
    end_id: int = field(init=False)

    def __post_init__(self):
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.types[i] == NORMAL}
        order = {score: k for k, score in enumerate(sorted({self.scores[i] for i in self.ids.values()}, reverse=True))}
        self.rank = {p: order[self.scores[i]] for p, i in self.ids.items()}
        by_name = {p: i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        try:
            self.byte_ids = [by_name[f"<0x{b:02X}>"] for b in range(256)]
            self.end_id = self.pieces.index("</s>")
        except (KeyError, ValueError):
            raise ValueError("the model has no byte pieces or no end piece") from None
        if USER_DEFINED in self.types:
            raise ValueError("user-defined pieces are not supported")
        for piece in self.ids:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} crosses a word boundary")
            if any(c not in self.ids for c in piece):
                raise ValueError(f"piece {piece!r} has a character that is no piece")

    @classmethod
    def parse(cls, data: bytes) -> MergeModel:
        pieces, types, scores, add_prefix = [], [], [], True
        for number, value in _fields(data):
            if number == 1:
                text, kind, score = "", NORMAL, 0.0
                for inner, x in _fields(value):
                    if inner == 1:
                        text = x.decode("utf-8")
                    elif inner == 2:
                        score = struct.unpack("<f", x)[0]
                    elif inner == 3:
                        kind = x
                pieces.append(text)
                types.append(kind)
                scores.append(score)
            elif number == 2:
                trainer = dict(_fields(value))
                if trainer.get(3, 1) != MERGE_TYPE or not trainer.get(35, 0):
                    raise ValueError("only merge-type models with byte fallback are supported")
            elif number == 3:
                rules = dict(_fields(value))
                if rules.get(1, b"identity") != b"identity" or rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("only the identity normalizer that keeps extra spaces is supported")
                add_prefix = bool(rules.get(3, 1))
        return cls(pieces, types, scores, add_prefix)

    def merge(self, text: str) -> list[str]:
        """Merge adjacent pieces, the best score first and the leftmost of equals, as the library does."""
        return self._merge_long(text) if len(text) > SHORT else self._merge_short(text)

    def _merge_short(self, text: str, stop: int = 1) -> list[str]:
        rank, parts = self.rank.get, list(text)
        order = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while len(parts) > stop:
            best = min(order)
            if best == NEVER:
                break
            at = order.index(best)
            joined = parts[at] = parts[at] + parts.pop(at + 1)
            del order[at]
            if at:
                order[at - 1] = rank(parts[at - 1] + joined, NEVER)
            if at < len(order):
                order[at] = rank(joined + parts[at + 1], NEVER)
        return parts

    def _merge_long(self, text: str) -> list[str]:
        rank, parts = self.rank, list(text)
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < n:
                joined = parts[left] + parts[right]
                if joined in rank:
                    heapq.heappush(heap, (rank[joined], left, joined))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, joined = heapq.heappop(heap)
            right = after[left] if parts[left] else n
            if right >= n or parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [p for p in parts if p]

    def whole(self) -> frozenset[str]:
        """The pieces whose own text merges into exactly that piece."""
        return frozenset(piece for piece in self.ids if self.merge(piece) == [piece])

    def halves(self, alone: frozenset[str]) -> dict[str, tuple[str, str]]:
        """The two pieces that the last merge of a longer piece in ``alone`` joins.

        Only for pieces in whose making every merge comes after those of its
        parts, as it is in a vocabulary learnt by merging.  Others (say runs of
        spaces added by hand) are left out.
        """
        out = {}
        for piece in sorted(alone, key=len):
            if len(piece) > 1:
                left, right = self._merge_short(piece, stop=2)
                regular = all(len(half) == 1 or half in out for half in (left, right))
                if regular and max(self.made(left), self.made(right)) < self.rank[piece]:
                    out[piece] = (left, right)
        return out

    def made(self, piece: str) -> int:
        """Rank of the merge that makes the piece; characters are there from the start."""
        return self.rank[piece] if len(piece) > 1 else -1


def load(path: str) -> MergeModel:
    """Read a model file (on the driver; tasks get the parsed model)."""
    with open(path, "rb") as file:
        return MergeModel.parse(file.read())


# Boundaries that no merge crosses: in front of a run of space marks, and around a line end.
def splitter(model: MergeModel):
    """Compiled pattern that cuts marked text where no piece can span the cut.

    A space mark occurs only in front of a piece, so a run of marks begins a
    new part.  A line end is cut off as well where it is no piece.
    """
    import re

    alone = "" if "\n" in model.ids or any("\n" in p for p in model.ids) else "\n"
    return re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + (f"|{alone}" if alone else ""))


def marked(model: MergeModel, text: str) -> str:
    """The text as the library's normalizer hands it to the encoder."""
    if not text:
        return ""
    return (SPACE if model.add_prefix else "") + text.replace(" ", SPACE)
