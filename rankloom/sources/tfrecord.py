"""TFRecord files of ``tf.train.Example`` messages as a Spark data source.

    rankloom.sources.tfrecord.register(spark)
    df.write.format("tfrecord").mode("append").save(path)
    spark.read.format("tfrecord").option("binary", "image").load(path)

A record is length (8 bytes), its masked CRC32C, the message and the masked
CRC32C of the message, all little-endian.  Large files are read in byte ranges:
a range owns the records that begin in it and finds the first one by the
checksum of its length.  Small files share a task.  Records are coded a batch
at a time (``example_codec``); features outside the schema are skipped.
Nothing passes through the driver but file names and sizes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from rankloom.sources.example_codec import HEAD, TAIL, Ragged, Values, checksums, decode, encode, framed, head, heads_in, masked, padded

# Rows that are encoded, and bytes that are read and decoded, at once.
BATCH_ROWS = 4096
CHUNK_BYTES = 4 << 20
# Bytes of a task: larger files are cut, smaller ones share it.
SPLIT_BYTES = 32 << 20
# File operations of a commit that run at the same time.
COMMIT_THREADS = 32

INT64_TYPES = ("boolean", "tinyint", "smallint", "int", "bigint")
FLOAT_TYPES = ("float", "double")
BYTES_TYPES = ("string", "binary")
_KIND = {
    **{t: "int64" for t in INT64_TYPES},
    **{t: "float" for t in FLOAT_TYPES},
    **{t: "bytes" for t in BYTES_TYPES},
    **{f"array<{t}>": "int64" for t in INT64_TYPES},
    **{f"array<{t}>": "float" for t in FLOAT_TYPES},
}
_STORED = {"int64": "bigint", "float": "float", "bytes": "binary"}


# --- plan-time type check -------------------------------------------------------


def example_type(dtype: str) -> str:
    """``int64``, ``float`` or ``bytes``; raises for a type an Example cannot hold."""
    if dtype not in _KIND:
        raise ValueError(f"type {dtype} cannot be stored in an Example")
    return _KIND[dtype]


def coerce(df: DataFrame) -> DataFrame:
    """Cast every column to what an Example stores: bigint, float, binary or arrays of them."""

    def cast(name: str, dtype: str):
        stored = _STORED[example_type(dtype)]
        return F.col(f"`{name}`").cast(f"array<{stored}>" if dtype.startswith("array<") else stored).alias(name)

    return df.select(*[cast(name, dtype) for name, dtype in df.dtypes])


def read_type(dtype: str, binary: bool = False) -> str:
    """Type with which a written column comes back."""
    kind = example_type(dtype)
    base = {"int64": "bigint", "float": "double", "bytes": "binary" if binary else "string"}[kind]
    return f"array<{base}>" if dtype.startswith("array<") else base


# --- files ----------------------------------------------------------------------


def _filesystem(path: str):
    """File system and place of a path with its scheme: file, hdfs, s3 or gs."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        raise ValueError(f"path {path!r} has no scheme: every executor would take it for a place on its own disk")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the session's default file system where it has none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


# --- data source ----------------------------------------------------------------


@dataclass
class _Ranges(InputPartition):
    """(file, begin, end, size) of the byte ranges of a task."""

    ranges: tuple[tuple[str, int, int, int], ...]


@dataclass
class _Written(WriterCommitMessage):
    path: str


def cut(files: Sequence[tuple[str, int]], split: int) -> list[tuple[tuple[str, int, int, int], ...]]:
    """Byte ranges of (file, size) for tasks of at most about ``split`` bytes; with 0 files stay whole."""
    tasks, held, room = [], [], split
    for path, size in files:
        step = split if split else max(size, 1)
        for begin in range(0, size, step):
            span = min(step, size - begin)
            if held and span > room:
                tasks.append(tuple(held))
                held, room = [], split
            held.append((path, begin, begin + span, size))
            room -= span
    return [*tasks, tuple(held)] if held else tasks


def _first_record(stream, begin: int, end: int, size: int) -> int | None:
    """Place of the first record that begins in [begin, end)."""
    if begin == 0:
        return 0
    at = begin
    while at < end:
        stream.seek(at)
        octets = np.frombuffer(stream.read(min(CHUNK_BYTES, size - at)), np.uint8)
        for found in heads_in(octets).tolist():
            if at + found >= end:
                return None
            # The record must fit, and another one or the end of the file must follow.
            after = at + found + HEAD + int.from_bytes(octets[found : found + 8].tobytes(), "little") + TAIL
            if after == size:
                return at + found
            if after + HEAD <= size:
                stream.seek(after)
                follows = stream.read(HEAD)
                if head(int.from_bytes(follows[:8], "little")) == follows:
                    return at + found
        at += max(1, len(octets) - HEAD + 1)
    return None


def _chunks(stream, begin: int, end: int, size: int, verify: bool) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Buffers with the places and lengths of the messages of the records that begin in the range."""
    place = _first_record(stream, begin, end, size)
    if place is None:
        return
    stream.seek(place)
    data = b""
    while place < end:
        more = stream.read(CHUNK_BYTES)
        data += more
        at, starts, lengths = 0, [], []
        while place + at < end and at + HEAD <= len(data):
            length = int.from_bytes(data[at : at + 8], "little")
            if verify and head(length) != data[at : at + HEAD]:
                raise ValueError("TFRecord length checksum mismatch")
            if at + HEAD + length + TAIL > len(data):
                break
            starts.append(at + HEAD)
            lengths.append(length)
            at += HEAD + length + TAIL
        if starts:
            yield data, np.array(starts), np.array(lengths)
        elif not more:
            raise ValueError("truncated TFRecord header" if len(data) < HEAD else "truncated TFRecord message")
        place += at
        data = data[at:]


def _decoded(stream, ranges: Sequence[int], verify: bool, wanted: Sequence[str] | None):
    """Number of records and their features, buffer by buffer."""
    for data, start, length in _chunks(stream, *ranges, verify):
        buf = padded(data)
        if verify:
            inside = np.concatenate([buf[s : s + n] for s, n in zip(start.tolist(), length.tolist())])
            said = buf[(start + length)[:, None] + np.arange(TAIL)].view("<u4").reshape(-1)
            if (masked(checksums(Ragged(inside, length))) != said).any():
                raise ValueError("TFRecord message checksum mismatch")
        yield len(start), decode(buf, start, start + length, wanted)


def _features(system, ranges) -> list[tuple[str, str, int]]:
    """Name, kind and largest number of values of every feature in some byte ranges."""
    found: dict[tuple[str, str], int] = {}
    for path, *span in ranges:
        with system.open_input_file(path) as stream:
            for _, features in _decoded(stream, span, True, None):
                for name, kinds in features.items():
                    for kind, values in kinds.items():
                        most = int(values.counts.max(initial=0))
                        key = (name, kind if most else "")
                        found[key] = max(found.get(key, 0), most)
    return [(name, kind, most) for (name, kind), most in found.items()]


def _column(field: T.StructField, arrow: pa.DataType, kinds: dict[str, Values], n: int) -> pa.Array:
    """A feature as a column of the wanted type; a record without it has NULL or an empty list."""
    repeated = isinstance(field.dataType, T.ArrayType)
    target = arrow.value_type if repeated else arrow
    given = [v for v in kinds.values() if len(v.values)]
    parts = [_cast(field.name, v.values, target) for v in given]
    counts = np.sum([v.counts for v in given], axis=0).astype(np.int64) if given else np.zeros(n, np.int64)
    values = pa.concat_arrays(parts) if parts else pa.array([], target)
    if len(given) > 1:  # values of several kinds: in the order of their records
        owner = np.concatenate([np.repeat(np.arange(n), v.counts) for v in given])
        values = values.take(pa.array(np.argsort(owner, kind="stable")))
    ends = np.concatenate([[0], np.cumsum(counts)])
    if repeated:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
    if counts.max(initial=0) > 1:
        raise ValueError(f"feature {field.name!r} has {counts.max()} values in a record; read it as an array")
    if len(values) == n:
        return values
    return values.take(pa.array(ends[:-1], mask=counts == 0))


def _cast(name: str, values: pa.Array, target: pa.DataType) -> pa.Array:
    try:
        return values.cast(target)
    except pa.ArrowException as problem:
        raise ValueError(f"feature {name!r} holds {values.type} and cannot be read as {target}: {problem}") from problem


def schema_of(rows, binary) -> T.StructType:
    """Schema of features given as (name, kind, largest number of values).

    Names are sorted; a feature with several values in any record is an array;
    one without any value is a string.  A feature of two kinds is an error.
    """
    kinds: dict[str, set[str]] = {}
    most: dict[str, int] = {}
    for name, kind, n in rows:
        kinds.setdefault(name, set()).update({kind} - {""})
        most[name] = max(most.get(name, 0), n)
    if not kinds:
        raise ValueError("no record to infer a schema from; pass one with .schema(...)")
    base = {"int64": T.LongType(), "float": T.DoubleType()}
    fields = []
    for name in sorted(kinds):
        if len(kinds[name]) > 1:
            raise ValueError(f"feature {name!r} is of several kinds: {', '.join(sorted(kinds[name]))}")
        kind = next(iter(kinds[name]), "bytes")
        value: T.DataType = T.BinaryType() if name in binary else base.get(kind, T.StringType())
        fields.append(T.StructField(name, T.ArrayType(value) if most[name] > 1 else value))
    return T.StructType(fields)


FEATURES_SCHEMA = "name string, kind string, most bigint"


class TFRecordSource(DataSource):
    """Options: ``path``, ``binary`` (comma list of bytes features read as binary), ``verify`` (checksums, default
    true) and ``split``: bytes of a task, 0 to keep files whole; of a stream also ``state``, ``max_files``, ``max_bytes``.  A file whose messages hold TFRecord files of their
    own that are longer than a task must be kept whole."""

    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def _binary(self) -> set[str]:
        return {n for n in self.options.get("binary", "").split(",") if n}

    def files(self) -> list[tuple[str, int]]:
        """Files and their sizes."""
        from pyarrow import fs

        system, root = _filesystem(self.options["path"])
        info = system.get_file_info(root)
        if info.type == fs.FileType.File:
            return [(root, info.size)]
        listed = system.get_file_info(fs.FileSelector(root, recursive=True))
        return sorted(
            (f.path, f.size) for f in listed if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))
        )

    def schema(self) -> T.StructType:
        """From all records, read here one after the other; :func:`read_tfrecords` does it as a job."""
        system, _ = _filesystem(self.options["path"])
        rows = [row for task in cut(self.files(), SPLIT_BYTES) for row in _features(system, task)]
        return schema_of(rows, self._binary())

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.files(), schema, self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(self, schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(schema, self.options, overwrite)


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], schema: T.StructType, options) -> None:
        self.tasks, self.wanted = cut(files, int(options.get("split", SPLIT_BYTES))), schema
        self.root, self.verify = options["path"], options.get("verify", "true") == "true"
        self.only_features = options.get("features", "false") == "true"

    def partitions(self):
        return [_Ranges(task) for task in self.tasks]

    def read(self, partition: _Ranges):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(self.wanted)
        system, _ = _filesystem(self.root)
        if self.only_features:
            rows = _features(system, partition.ranges)
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
            return
        names = self.wanted.fieldNames()
        for path, *span in partition.ranges:
            with system.open_input_file(path) as stream:
                for n, found in _decoded(stream, span, self.verify, names):
                    columns = [_column(f, a.type, found[f.name], n) for f, a in zip(self.wanted.fields, arrow)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)


class FileLog:
    """The files of a stream in the order in which they were taken in, as small files in a shared folder.

    A segment ``begin-end.json`` lists the files of one batch.  It is written
    before its offset is handed out, so whatever Spark has stored is in the log,
    and a batch that is run again has the same files.
    """

    def __init__(self, path: str) -> None:
        self.system, self.root = _filesystem(path)
        self.system.create_dir(self.root, recursive=True)
        self.segments: list[tuple[int, int, str]] = []
        self.refresh()

    def refresh(self) -> None:
        from pyarrow import fs

        names = [f.base_name for f in self.system.get_file_info(fs.FileSelector(self.root)) if f.base_name.endswith(".json")]
        self.segments = sorted((*map(int, n.removesuffix(".json").split("-")), n) for n in names)

    @property
    def end(self) -> int:
        return self.segments[-1][1] if self.segments else 0

    def files(self, begin: int, end: int) -> list[tuple[str, int]]:
        out: list[tuple[str, int]] = []
        for first, behind, name in self.segments:
            if first < end and behind > begin:
                with self.system.open_input_stream(f"{self.root}/{name}") as stream:
                    listed = json.loads(stream.read())
                out += [(path, size) for path, size in listed[max(begin - first, 0) : end - first]]
        return out

    def append(self, files: Sequence[tuple[str, int]]) -> None:
        name = f"{self.end:012d}-{self.end + len(files):012d}.json"
        hidden = f"{self.root}/_{uuid.uuid4().hex}"
        with self.system.open_output_stream(hidden) as stream:
            stream.write(json.dumps(files).encode())
        self.system.move(hidden, f"{self.root}/{name}")
        self.segments.append((self.end, self.end + len(files), name))


class _StreamReader(DataSourceStreamReader):
    """Offsets count the files of a :class:`FileLog`; a batch takes a bounded number of new ones."""

    def __init__(self, source: TFRecordSource, schema: T.StructType, options) -> None:
        if "state" not in options:
            raise ValueError("a stream of TFRecords needs the option 'state', a shared folder of its own")
        self.source, self.batches = source, _Reader([], schema, options)
        self.state, self.split = options["state"], int(options.get("split", SPLIT_BYTES))
        self.max_files, self.max_bytes = int(options.get("max_files", 0)), int(options.get("max_bytes", 0))
        self.log: FileLog | None = None
        self.taken: set[str] = set()

    def _open(self) -> FileLog:
        if self.log is None:
            self.log = FileLog(self.state)
            self.taken = {path for path, _ in self.log.files(0, self.log.end)}
        return self.log

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        log = self._open()
        new = [f for f in self.source.files() if f[0] not in self.taken]
        batch: list[tuple[str, int]] = []
        for path, size in new:
            full = self.max_files and len(batch) >= self.max_files
            heavy = self.max_bytes and batch and sum(s for _, s in batch) + size > self.max_bytes
            if full or heavy:
                break
            batch.append((path, size))
        if batch:
            log.append(batch)
            self.taken.update(path for path, _ in batch)
        return {"files": log.end}

    def partitions(self, start: dict, end: dict):
        return [_Ranges(task) for task in cut(self._open().files(start["files"], end["files"]), self.split)]

    def read(self, partition: _Ranges):
        yield from self.batches.read(partition)


class _Writer(DataSourceArrowWriter):
    """One file per task under a temporary name; the commit renames them."""

    def __init__(self, schema: T.StructType, options, overwrite: bool) -> None:
        self.root, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex[:12]
        self.kinds = {f.name: example_type(f.dataType.simpleString()) for f in schema.fields}

    def write(self, iterator) -> _Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, root = _filesystem(self.root)
        system.create_dir(root, recursive=True)
        path = f"{root}/_tmp-{self.job}-{context.partitionId():05d}-{context.taskAttemptId()}.tfrecord"
        with system.open_output_stream(path) as stream:
            for batch in iterator:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    stream.write(framed(encode(batch.slice(at, BATCH_ROWS), self.kinds)))
        return _Written(path)

    def commit(self, messages) -> None:
        from pyarrow import fs

        system, root = _filesystem(self.root)
        done = sorted(m.path for m in messages if m is not None)
        with ThreadPoolExecutor(COMMIT_THREADS) as pool:
            if self.overwrite and system.get_file_info(root).type == fs.FileType.Directory:
                old = system.get_file_info(fs.FileSelector(root, recursive=True))
                gone = [f.path for f in old if f.type == fs.FileType.File and not f.base_name.startswith("_tmp-")]
                list(pool.map(system.delete_file, gone))
            names = [f"{root}/part-{i:05d}-{self.job}.tfrecord" for i in range(len(done))]
            list(pool.map(system.move, done, names))

    def abort(self, messages) -> None:
        system, _ = _filesystem(self.root)
        for message in messages:
            if message is not None:
                system.delete_file(message.path)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TFRecordSource)


def write_tfrecords(df: DataFrame, path: str, mode: str = "append") -> None:
    register(df.sparkSession)
    coerce(df).write.format("tfrecord").mode(mode).save(qualified(df.sparkSession, path))


def read_tfrecords(
    spark: SparkSession, path: str, schema=None, binary: tuple[str, ...] = (), split: int = SPLIT_BYTES
) -> DataFrame:
    """Rows of all records below ``path``; without a schema it is inferred from all of them by a job."""
    register(spark)
    path = qualified(spark, path)
    reader = spark.read.format("tfrecord").option("binary", ",".join(binary)).option("split", split)
    if schema is None:
        features = spark.read.format("tfrecord").option("features", "true").option("split", split).schema(FEATURES_SCHEMA).load(path)
        found = features.groupBy("name", "kind").agg(F.max("most").alias("most")).collect()  # one row per feature and kind
        schema = schema_of([tuple(r) for r in found], set(binary))
    return reader.schema(schema).load(path)
