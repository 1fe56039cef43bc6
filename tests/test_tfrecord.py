"""The columnar coder against a row-at-a-time one, and files read in ranges."""

import io
import random

import numpy as np
import pyarrow as pa
import pytest

import plain_examples as plain
from rankloom.sources import example_codec as codec
from rankloom.sources import tfrecord as tf


def random_rows(n, seed=1):
    rng = random.Random(seed)
    number = lambda: rng.choice([0, 1, 127, 128, 300, 2**31, 2**62, -1, -(2**63), rng.randrange(10**6)])
    rows = []
    for _ in range(n):
        row = {
            "i": ("int64", [number() for _ in range(rng.randrange(4))]),
            "f": ("float", [rng.choice([0.0, -1.5, 3.25, 1e30]) for _ in range(rng.randrange(4))]),
            "é": ("bytes", [bytes(rng.randrange(256) for _ in range(rng.randrange(300))) for _ in range(rng.randrange(3))]),
            "long name": ("bytes", [b"x" * rng.randrange(2000)]),
        }
        names = list(row)
        rng.shuffle(names)
        rows.append({k: row[k] for k in names[: rng.randrange(5)]})
    return rows


def test_checksums():
    assert codec.crc32c(b"123456789") == 0xE3069283 and codec.crc32c(b"") == 0
    assert codec.crc32c(b"\x00" * 32) == 0x8A9136AA and codec.crc32c(b"\xff" * 32) == 0x62A8AB43
    rng = random.Random(2)
    rows = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 2, 3, 4, 5, 100, 1023, 1024, 1025, 1026, 1027, 1028, 5000)]
    ragged = codec.Ragged(np.frombuffer(b"".join(rows), np.uint8), np.array([len(r) for r in rows]))
    assert codec.checksums(ragged).tolist() == [plain.crc32c(r) for r in rows] == [codec.crc32c(r) for r in rows]
    assert codec.head(7) == plain.record(b"1234567")[:12]


def test_varints():
    values = [0, 1, 127, 128, 16383, 16384, 2**35, 2**63 - 1, -1, -(2**63)]
    ragged = codec.varints(np.array(values, np.int64))
    assert ragged.flat.tobytes() == b"".join(map(plain.varint, values))
    buf = codec.padded(ragged.flat.tobytes())
    got, end = codec._read_varints(buf, ragged.starts)
    assert got.view(np.int64).tolist() == values and end.tolist() == (ragged.starts + ragged.lengths).tolist()


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("wanted", [None, ["f", "é", "nothing"]])
def test_decode(packed, wanted):
    rows = random_rows(200)
    messages = [plain.encode_example(r, packed) for r in rows] + [b"", plain.field(1, b""), plain.field(7, b"unknown") + plain.encode_example({"f": ("float", [1.0])})]
    rows += [{}, {}, {"f": ("float", [1.0])}]
    twice = {"f": ("float", [9.0])}
    messages.append(plain.encode_example({"f": ("float", [1.0, 2.0])}) + plain.encode_example(twice))
    rows.append(twice)
    ends = np.cumsum([len(m) for m in messages])
    found = codec.decode(codec.padded(b"".join(messages)), ends - [len(m) for m in messages], ends, wanted)
    names = {n for r in rows for n in r} if wanted is None else set(wanted)
    assert set(found) == names
    for name in names:
        got = [[] for _ in rows]
        for v in found[name].values():
            at = np.concatenate([[0], np.cumsum(v.counts)])
            for k in range(len(rows)):
                got[k] += v.values.slice(at[k], at[k + 1] - at[k]).to_pylist()
        want = [[x for x in r.get(name, ("", []))[1]] for r in rows]
        assert got == [[np.float32(x) if isinstance(x, float) else x for x in w] for w in want]


def test_encode_like_the_plain_coder():
    rows = [([1, -5, 2**40], 1.5, b"a", ["x", "é"]), ([], None, None, []), (None, -2.0, b"", None), ([7], 0.0, b"z" * 400, ["q" * 130])]
    columns = [
        pa.array([r[0] for r in rows], pa.list_(pa.int64())), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.binary()),
        pa.array([r[3] for r in rows], pa.list_(pa.string())),
    ]
    batch = pa.RecordBatch.from_arrays(columns, ["i", "f", "b", "s"])
    kinds = {"i": "int64", "f": "float", "b": "bytes", "s": "bytes"}
    listed = lambda x: x if isinstance(x, list) else [] if x is None else [x]
    want = [plain.encode_example({n: (kinds[n], [x.encode() if isinstance(x, str) else x for x in listed(v)]) for n, v in zip("ifbs", r)}) for r in rows]
    for at in (0, 1, 3):
        assert codec.framed(codec.encode(batch.slice(at), kinds)).tobytes() == b"".join(map(plain.record, want[at:]))
    with pytest.raises(ValueError, match="NULL inside"):
        codec.encode(pa.RecordBatch.from_arrays([pa.array([[1, None]])], ["i"]), kinds)


@pytest.mark.parametrize("message", [b"\x0a\x05\x0a", b"\x0a\xff\xff\xff\xff\xff\xff\xff\xff\xff\xff\xff", b"\x0b\x01"])
def test_damaged_messages(message):
    with pytest.raises(ValueError, match="damaged"):
        codec.decode(codec.padded(message), np.array([0]), np.array([len(message)]))


@pytest.mark.parametrize("split", [0, 1, 37, 1000, 10**6])
@pytest.mark.parametrize("chunk", [64, 4 << 20])
def test_every_record_is_in_one_range(monkeypatch, split, chunk):
    monkeypatch.setattr(tf, "CHUNK_BYTES", chunk)
    rng = random.Random(3)
    bodies = [b"", b"x" * 3000, b"\x00" * 50] + [bytes(rng.randrange(256) for _ in range(rng.randrange(90))) for _ in range(40)]
    if split not in (1, 37):  # messages that are files of records themselves, shorter than a range
        bodies = [plain.record(b"inner") * 3, *bodies, plain.record(plain.record(b"deep"))]
    data = b"".join(map(plain.record, bodies))
    got = []
    for task in tf.cut([("a", len(data))], split):
        for _, *span in task:
            for found, start, length in tf._chunks(io.BytesIO(data), *span, True):
                got += [found[s : s + n] for s, n in zip(start.tolist(), length.tolist())]
    assert got == bodies


def test_cut():
    files = [("a", 10), ("b", 0), ("c", 25), ("d", 3), ("e", 3)]
    tasks = tf.cut(files, 10)
    assert tasks == [(("a", 0, 10, 10),), (("c", 0, 10, 25),), (("c", 10, 20, 25),), (("c", 20, 25, 25), ("d", 0, 3, 3)), (("e", 0, 3, 3),)]
    assert tf.cut(files, 0) == [(("a", 0, 10, 10),), (("c", 0, 25, 25),), (("d", 0, 3, 3),), (("e", 0, 3, 3),)]
    assert tf.cut([], 10) == []


def test_one_file_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "one")
    rows = [(i, [float(i), i / 2], f"text {i}" * (i % 7), None if i % 3 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, v array<float>, s string, n int").coalesce(1)
    tf.write_tfrecords(df, path)
    back = tf.read_tfrecords(spark, path, split=20_000)
    assert back.rdd.getNumPartitions() > 5
    assert sorted((r["id"], r["v"], r["s"], r["n"]) for r in back.collect()) == rows
    few = tf.read_tfrecords(spark, path, schema="s string, missing array<bigint>, id int", split=50_000)
    assert sorted((r["id"], r["s"], r["missing"]) for r in few.collect()) == [(r[0], r[2], []) for r in rows]


def test_mixed_kinds_and_wrong_types(spark, tmp_path):
    path = tmp_path / "mixed"
    path.mkdir()
    with open(path / "a.tfrecord", "wb") as stream:
        for row in ({"x": ("int64", [1])}, {"x": ("float", [2.5])}, {}, {"x": ("int64", [4])}, {"x": ("float", [])}):
            plain.write_record(stream, plain.encode_example(row))
    got = tf.read_tfrecords(spark, str(path), schema="x double").collect()
    assert [r["x"] for r in got] == [1.0, 2.5, None, 4.0, None]
    assert [r["x"] for r in tf.read_tfrecords(spark, str(path), schema="x array<double>").collect()] == [[1.0], [2.5], [], [4.0], []]
    with pytest.raises(Exception, match="cannot be read as"):
        tf.read_tfrecords(spark, str(path), schema="x bigint").collect()
