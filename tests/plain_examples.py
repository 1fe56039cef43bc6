"""A row-at-a-time coder of Examples, written apart from the library's, to hold it against."""

from __future__ import annotations

import struct


def crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def masked_crc(data):
    crc = crc32c(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def varint(n):
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def field(number, body):
    return varint(number << 3 | 2) + varint(len(body)) + body


def feature(kind, values, packed=True):
    if kind == "bytes":
        return field(1, b"".join(field(1, v) for v in values))
    if kind == "float":
        return field(2, field(1, struct.pack(f"<{len(values)}f", *values)) if packed else b"".join(b"\x0d" + struct.pack("<f", v) for v in values))
    return field(3, field(1, b"".join(map(varint, values))) if packed else b"".join(b"\x08" + varint(v) for v in values))


def encode_example(row, packed=True):
    """``{name: (kind, values)}`` to a serialized Example."""
    return field(1, b"".join(field(1, field(1, name.encode()) + field(2, feature(*v, packed))) for name, v in row.items()))


def record(message):
    size = struct.pack("<Q", len(message))
    return size + struct.pack("<I", masked_crc(size)) + message + struct.pack("<I", masked_crc(message))


def write_record(stream, message):
    stream.write(record(message))
