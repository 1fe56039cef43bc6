"""Columnar coding of framed ``tf.train.Example`` messages: a batch of rows at a time, with numpy.

Encoding builds ragged byte columns and joins them row by row.  Decoding walks
all messages of a buffer together: a step handles one field of every message,
so the number of Python steps depends on the fields of a row, not on the rows.
Features that are not wanted are skipped before their values are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Fixed values of the format: reflected Castagnoli polynomial, CRC mask, field numbers of the value lists.
CRC_POLYNOMIAL = 0x82F63B78
CRC_MASK_DELTA = 0xA282EAD8
LISTS = {"bytes": 1, "float": 2, "int64": 3}

HEAD = 12  # length and its checksum
TAIL = 4  # checksum of the message
VARINT = 10  # bytes of the longest one
_SPAN = 1024


# --- checksums ------------------------------------------------------------------


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(CRC_POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


_TABLE = _byte_table()


def _distance_tables(span: int) -> np.ndarray:
    """Row d: effect on the checksum of a byte that is followed by d more bytes."""
    rows = [_TABLE]
    for _ in range(span - 1):
        rows.append(_TABLE[rows[-1] & 0xFF] ^ (rows[-1] >> np.uint32(8)))
    return np.stack(rows)


def _zero_checksums(span: int) -> np.ndarray:
    """Checksums of 0, 1, ... zero bytes."""
    out, crc = [], 0xFFFFFFFF
    for _ in range(span + 1):
        out.append(crc ^ 0xFFFFFFFF)
        crc = int(_TABLE[crc & 0xFF]) ^ (crc >> 8)
    return np.array(out, np.uint32)


_DISTANCE = _distance_tables(_SPAN + 4)
_ZEROS = _zero_checksums(_SPAN)


def crc32c(data: bytes) -> int:
    """CRC-32C of one string, a block of bytes at a time: the checksum is the XOR of each byte's own effect."""
    octets = np.frombuffer(data, dtype=np.uint8)
    crc = 0xFFFFFFFF
    for at in range(0, len(octets), _SPAN):
        block = octets[at : at + _SPAN]
        n = len(block)
        effect = int(np.bitwise_xor.reduce(_DISTANCE[np.arange(n - 1, -1, -1), block]))
        # The running checksum acts like four extra bytes XORed onto the block's start.
        for i in range(min(4, n)):
            effect ^= int(_DISTANCE[n - 1 - i, (crc >> (8 * i)) & 0xFF])
        crc = effect ^ (crc >> (8 * n) if n < 4 else 0)
    return crc ^ 0xFFFFFFFF


def masked(crc: np.ndarray) -> np.ndarray:
    crc = np.asarray(crc, np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(CRC_MASK_DELTA)


# --- ragged byte columns --------------------------------------------------------


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all bytes of the ranges, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


@dataclass(frozen=True)
class Ragged:
    """Byte strings of n rows, end to end."""

    flat: np.ndarray
    lengths: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    def grouped(self, counts: np.ndarray) -> "Ragged":
        """Rows of ``counts`` consecutive strings each."""
        ends = np.concatenate([[0], np.cumsum(self.lengths)])
        at = np.concatenate([[0], np.cumsum(counts)])
        return Ragged(self.flat, np.diff(ends[at]))


def constant(data: bytes, n: int) -> Ragged:
    return Ragged(np.tile(np.frombuffer(data, np.uint8), n), np.full(n, len(data), np.int64))


def fixed(values: np.ndarray) -> Ragged:
    """Little-endian numbers, one per row."""
    wide = values.astype(values.dtype.newbyteorder("<"))
    return Ragged(np.frombuffer(wide.tobytes(), np.uint8), np.full(len(values), values.dtype.itemsize, np.int64))


def varints(values: np.ndarray) -> Ragged:
    values = values.astype(np.uint64) if values.dtype != np.int64 else values.view(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(1, VARINT):
        size += values >= np.uint64(1 << (7 * k))
    most = int(size.max(initial=1))
    step = np.arange(most)
    octets = ((values[:, None] >> (np.uint64(7) * step.astype(np.uint64))) & np.uint64(0x7F)).astype(np.uint8)
    octets |= np.where(step < size[:, None] - 1, 0x80, 0).astype(np.uint8)
    return Ragged(octets[step < size[:, None]], size)


def joined(parts: Sequence[Ragged]) -> Ragged:
    """The parts of every row, one behind the other."""
    lengths = np.sum([p.lengths for p in parts], axis=0)
    out = np.empty(int(lengths.sum()), np.uint8)
    at = np.cumsum(lengths) - lengths
    for part in parts:
        out[_places(at, part.lengths)] = part.flat
        at = at + part.lengths
    return Ragged(out, lengths)


def field(number: int, body: Ragged) -> Ragged:
    """A length-delimited field."""
    return joined([constant(bytes([number << 3 | 2]), len(body.lengths)), varints(body.lengths), body])


def checksums(rows: Ragged) -> np.ndarray:
    """CRC-32C of every row."""
    out = np.zeros(len(rows.lengths), np.uint32)
    short = (rows.lengths > 0) & (rows.lengths <= _SPAN)
    if short.any():
        length = rows.lengths[short]
        octets = rows.flat if short.all() else rows.flat[_places(rows.starts[short], length)]
        starts = np.cumsum(length) - length
        behind = np.repeat(starts + length - 1, length) - np.arange(len(octets))
        out[short] = np.bitwise_xor.reduceat(_DISTANCE[behind, octets], starts) ^ _ZEROS[length]
    for i in np.flatnonzero(rows.lengths > _SPAN):
        begin = rows.starts[i]
        out[i] = crc32c(rows.flat[begin : begin + rows.lengths[i]].tobytes())
    return out


# --- encoding -------------------------------------------------------------------


def _cells(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All values of a column and how many each row has; NULL has none."""
    if pa.types.is_list(column.type):
        counts = column.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        values = column.flatten()
        if values.null_count:
            raise ValueError("an Example cannot hold a NULL inside a list")
        return values, counts
    return column.drop_null(), column.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)


def _strings(values: pa.Array) -> Ragged:
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(values) else np.zeros(0, np.uint8)
    return Ragged(flat, np.diff(at))


def encode(batch: pa.RecordBatch, kinds: dict[str, str]) -> Ragged:
    """One Example per row, features in the order of the columns."""
    entries = []
    n = batch.num_rows
    for name, column in zip(batch.schema.names, batch.columns):
        values, counts = _cells(column)
        kind = kinds[name]
        if kind == "bytes":
            body = field(1, _strings(values)).grouped(counts)
        elif kind == "float":
            body = field(1, fixed(values.to_numpy(zero_copy_only=False).astype(np.float32)).grouped(counts))
        else:
            body = field(1, varints(values.cast(pa.int64()).to_numpy(zero_copy_only=False)).grouped(counts))
        title = field(1, constant(name.encode(), n))
        entries.append(field(1, joined([title, field(2, field(LISTS[kind], body))])))
    return field(1, joined(entries)) if entries else constant(b"\x0a\x00", n)


def framed(messages: Ragged) -> np.ndarray:
    """The bytes of the records: length, its checksum, message, its checksum."""
    size = fixed(messages.lengths.astype(np.uint64))
    return joined([size, fixed(masked(checksums(size))), messages, fixed(masked(checksums(messages)))]).flat


# --- decoding -------------------------------------------------------------------


def padded(data: bytes) -> np.ndarray:
    """A buffer behind whose end a varint can be read."""
    return np.concatenate([np.frombuffer(data, np.uint8), np.zeros(VARINT, np.uint8)])


def _read_varints(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Varints at the given places, and where they end."""
    octet = buf[at]
    value, end = (octet & 0x7F).astype(np.uint64), at + 1
    open_ = np.flatnonzero(octet >= 0x80)
    for k in range(1, VARINT):
        if not len(open_):
            return value, end
        octet = buf[end[open_]]
        value[open_] |= (octet & 0x7F).astype(np.uint64) << np.uint64(7 * k)
        end[open_] += 1
        open_ = open_[octet >= 0x80]
    if len(open_):
        raise ValueError("damaged Example: a varint has no end")
    return value, end


def _fields(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """The first, second, ... fields of messages: (message, number, wire type, begin and end of the value)."""
    now = start.copy()
    active = np.flatnonzero(now < end)
    while len(active):
        tag, at = _read_varints(buf, now[active])
        wire = (tag & np.uint64(7)).astype(np.int64)
        begin, stop = at.copy(), at.copy()
        read = (wire == 0) | (wire == 2)
        value, behind = _read_varints(buf, at[read])
        begin[read] = np.where(wire[read] == 2, behind, at[read])
        size = np.minimum(value, np.uint64(len(buf))).astype(np.int64)
        stop[read] = np.where(wire[read] == 2, behind + size, behind)
        stop[wire == 5] += 4
        stop[wire == 1] += 8
        if (stop > end[active]).any() or not (read | (wire == 5) | (wire == 1)).all():
            raise ValueError("damaged Example: a field does not fit its message")
        yield active, (tag >> np.uint64(3)).astype(np.int64), wire, begin, stop
        now[active] = stop
        active = active[stop < end[active]]


def _collected(buf: np.ndarray, start: np.ndarray, end: np.ndarray, number: int | None = None) -> tuple[np.ndarray, ...]:
    """All fields of the messages with this number (None: any), by message and then in their order: (message, number, wire, begin, end)."""
    found = list(_fields(buf, start, end))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    columns = [np.concatenate(c) for c in zip(*found)]
    if number is not None:
        keep = columns[1] == number
        columns = [c[keep] for c in columns]
    order = np.argsort(columns[0], kind="stable")
    return tuple(c[order] for c in columns)


def _last(owner: np.ndarray) -> np.ndarray:
    """Index of the last of each run of equal owners."""
    return np.flatnonzero(np.diff(owner, append=-1) != 0)


def _packed_ints(octets: np.ndarray) -> np.ndarray:
    ends = octets < 0x80
    if ends.all():
        return octets.astype(np.int64)
    stops = np.flatnonzero(ends)
    if not ends[-1]:
        raise ValueError("damaged Example: a varint has no end")
    starts = np.concatenate([[0], stops[:-1] + 1])
    if (stops - starts).max() >= VARINT:
        raise ValueError("damaged Example: a varint has no end")
    turn = np.arange(len(octets)) - np.repeat(starts, stops - starts + 1)
    parts = (octets & 0x7F).astype(np.uint64) << (np.uint64(7) * turn.astype(np.uint64))
    return np.bitwise_or.reduceat(parts, starts).view(np.int64)


@dataclass(frozen=True)
class Values:
    """Values of one feature and kind: how many each record has, and all of them in the order of the records."""

    counts: np.ndarray
    values: pa.Array


def _values(buf: np.ndarray, kind: str, record: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> Values:
    """Values of the lists at [start, end) of their records (rising)."""
    owner, _, _, begin, stop = _collected(buf, start, end, 1)
    length = stop - begin
    octets = buf[_places(begin, length)]
    if kind == "bytes":
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        values = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(octets)])
        each = np.ones(len(length), np.int64)
    elif kind == "float":
        if (length % 4).any():
            raise ValueError("damaged Example: half a number")
        values, each = pa.array(np.frombuffer(octets.tobytes(), "<f4")), length // 4
    else:
        values = pa.array(_packed_ints(octets)) if len(octets) else pa.array([], pa.int64())
        done = np.concatenate([[0], np.cumsum(octets < 0x80)])
        at = np.concatenate([[0], np.cumsum(length)])
        each = np.diff(done[at])
    counts = np.zeros(n, np.int64)
    np.add.at(counts, record[owner], each)
    return Values(counts, values)


def _names(buf: np.ndarray, start: np.ndarray, end: np.ndarray, wanted: Sequence[str] | None) -> Iterator[tuple[str, np.ndarray]]:
    """Names and which of the keys carry them; those wanted, or all that occur."""
    length = end - start
    if wanted is not None:
        for name in wanted:
            octets = np.frombuffer(name.encode(), np.uint8)
            at = np.flatnonzero(length == len(octets))
            same = (buf[start[at, None] + np.arange(len(octets))] == octets).all(axis=1)
            yield name, at[same]
        return
    for size in np.unique(length).tolist():
        at = np.flatnonzero(length == size)
        keys, which = np.unique(buf[start[at, None] + np.arange(size)], axis=0, return_inverse=True)
        for k, key in enumerate(keys):
            yield key.tobytes().decode(), at[which.reshape(-1) == k]


def decode(buf: np.ndarray, start: np.ndarray, end: np.ndarray, wanted: Sequence[str] | None = None) -> dict[str, dict[str, Values]]:
    """Features of the Examples at [start, end) of a padded buffer: name to kind to values.

    Where a record names a feature twice the last one counts.  A feature without
    a list has the kind ``""``.
    """
    n = len(start)
    record, _, _, begin, stop = _collected(buf, start, end, 1)
    part, _, _, begin, stop = _collected(buf, begin, stop, 1)
    record = record[part]
    owner, number, _, at, to = _collected(buf, begin, stop)
    spans = {}
    for role in (1, 2):
        mine = np.flatnonzero(number == role)
        mine = mine[_last(owner[mine])]
        spans[role] = np.zeros((2, len(record)), np.int64)
        spans[role][:, owner[mine]] = at[mine], to[mine]
    out: dict[str, dict[str, Values]] = {}
    for name, entries in _names(buf, *spans[1], wanted):
        entries = entries[_last(record[entries])]
        owner, number, _, at, to = _collected(buf, spans[2][0][entries], spans[2][1][entries])
        last = _last(owner)
        owner, number, at, to = owner[last], number[last], at[last], to[last]
        found = {}
        for kind, code in LISTS.items():
            mine = np.flatnonzero(number == code)
            if len(mine):
                found[kind] = _values(buf, kind, record[entries[owner[mine]]], at[mine], to[mine], n)
        if len(owner) < len(entries):
            found[""] = Values(np.zeros(n, np.int64), pa.array([], pa.int64()))
        out[name] = found
    return out


# --- framing --------------------------------------------------------------------


_HEADS: dict[int, bytes] = {}


def head(size: int) -> bytes:
    """Length and its checksum; lengths repeat a lot within a file."""
    found = _HEADS.get(size)
    if found is None:
        if len(_HEADS) > 65536:
            _HEADS.clear()
        length = size.to_bytes(8, "little")
        found = _HEADS[size] = length + int(masked(np.array([crc32c(length)]))[0]).to_bytes(4, "little")
    return found


def heads_in(octets: np.ndarray) -> np.ndarray:
    """Places where eight bytes are followed by their masked checksum."""
    n = len(octets) - HEAD + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    crc = np.full(n, _ZEROS[8], np.uint32)
    for i in range(8):
        crc ^= _DISTANCE[7 - i, octets[i : i + n]]
    said = np.zeros(n, np.uint32)
    for i in range(4):
        said |= octets[8 + i : 8 + i + n].astype(np.uint32) << np.uint32(8 * i)
    return np.flatnonzero(masked(crc) == said)
