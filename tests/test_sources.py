import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankloom.sources import dated, delimited, interactions, sinks
from plain_examples import encode_example, write_record
from rankloom.sources import tfrecord as tf

USER_LINES = [
    "u1|a,b,c|2019-09-01 10:00:00.0,2019-09-01 10:05:00.0,2019-09-01 10:09:00.0|a|2019-09-01 10:07:00.0|a,b|2019-09-01 10:01:00.0,2019-09-01 10:06:00.0",
    "u2|d|2019-09-01 11:00:00.0||||",
]


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_user_lines(spark):
    log = interactions.explode_user_lines(lines(spark, USER_LINES))
    got = [(r["cid"], r["ts"].strftime("%H:%M"), r["pid"], r["tag"]) for r in log.orderBy("cid", "ts", "pid", "tag").collect()]
    assert got == [
        ("u1", "10:00", "a", 0),
        ("u1", "10:01", "a", 1),
        ("u1", "10:05", "b", 0),
        ("u1", "10:06", "b", 1),
        ("u1", "10:07", "a", 2),
        ("u1", "10:09", "c", 0),
        ("u2", "11:00", "d", 0),
    ]


def test_user_lines_misaligned_raise(spark):
    bad = lines(spark, ["u1|a,b|2019-09-01 10:00:00||||"])
    with pytest.raises(Exception, match="items and times differ"):
        interactions.explode_user_lines(bad).collect()


def test_arity(spark):
    rows = lines(spark, ["a|b|1", "a|b", "a|b|c|d", "||"])
    assert delimited.split_lines(rows, "|", ["x", "y", "z"], bad="drop").count() == 2
    with pytest.raises(Exception, match="expected 3 fields"):
        delimited.split_lines(rows, "|", ["x", "y", "z"]).collect()


def test_pairs_skip_bad_and_blank(spark, tmp_path):
    path = str(tmp_path / "pairs")
    lines(spark, ["a|b|1", "a|b", "a|b|c|d", "|b|1", "a|  |1", "a|b|"]).write.text(path)
    assert [tuple(r) for r in delimited.read_pairs(spark, path).collect()] == [("a", "b", "1")]


def test_header_schema(spark):
    assert delimited.positional_schema("log_date|pid|ctr").fieldNames() == ["log_date", "pid", "ctr"]
    assert [tuple(r) for r in delimited.ordinal_dictionary(lines(spark, ["a|b"])).collect()] == [(1, "a"), (2, "b")]


def test_day_folders(spark, tmp_path):
    for day in ("2019-09-01", "2019-09-02", "2019-09-03"):
        lines(spark, [day]).coalesce(1).write.text(str(tmp_path / day / "hour=1"))
    assert dated.day_list("2019-09-30:2019-10-01") == ["2019-09-30", "2019-10-01"]
    assert dated.day_list("2019-09-02:2019-09-01") == []
    got = dated.read_days(spark, str(tmp_path), "2019-09-01:2019-09-02", name_glob="part-*")
    assert sorted(r["value"] for r in got.collect()) == ["2019-09-01", "2019-09-02"]
    with pytest.raises(ValueError):
        dated.read_days(spark, str(tmp_path), "2019-09-02:2019-09-01")


def test_partition_pruning_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("date", F.date_add(F.lit("2019-09-01").cast("date"), F.col("id").cast("int"))).write.partitionBy("date").parquet(path)
    df = dated.filter_days(spark.read.parquet(path), "2019-09-02:2019-09-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert df.count() == 2
    assert dated.snapshot(spark.read.parquet(path), "2019-09-05", 3).first()["date"] == dt.date(2019, 9, 2)


def test_sample_line(spark):
    row = spark.createDataFrame([(1, 5, 7, [1, 2], [], None)], "label int, cid int, pid int, click array<int>, order_cross array<int>, f1 double")
    line = row.select(sinks.sample_line(lists=("click", "order_cross"), profile=("f1",)).alias("l")).first()["l"]
    assert line == "1@5|7|1, 2||"


def test_recommendation_json(spark):
    row = spark.range(1).select(sinks.recommendation_json(F.lit(7), F.array(F.lit(9), F.lit(8))).alias("j")).first()["j"]
    assert row == '{"item_key":{"s":"7"},"info":{"l":[{"n":"9"},{"n":"8"}]}}'


def test_overwrite_replaces_only_written_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_replacing(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, partition=["p"])
    sinks.write_replacing(spark.createDataFrame([(9, "b")], "v int, p string"), path, partition=["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("v", "p").collect()) == [(1, "a"), (9, "b")]


# --- TFRecord -------------------------------------------------------------------


ALL_TYPES = """f float, d double, b boolean, t tinyint, s smallint, i int, l bigint, txt string, raw binary,
  fs array<float>, ds array<double>, bs array<boolean>, ns array<int>, ls array<bigint>"""


def test_tfrecord_round_trip(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = spark.createDataFrame(
        [
            (1.5, 2.5, True, 1, 2, -3, -(1 << 40), "é", bytearray(b"\x00\xff"), [1.0, 2.0], [3.5, 4.5], [True, False], [1, -2], [5, 6]),
            (0.0, -1.0, False, -1, 0, 7, 8, "", bytearray(b""), [0.5, 0.25], [1.0, 2.0], [False, True], [3, 4], [7, 8]),
        ],
        ALL_TYPES,
    )
    tf.write_tfrecords(rows, path)
    back = tf.read_tfrecords(spark, path, binary=("raw",))
    assert [f.name for f in back.schema.fields] == sorted(rows.columns)
    assert dict(back.dtypes)["raw"] == "binary" and dict(back.dtypes)["fs"] == "array<double>"
    first = {r["txt"]: r for r in back.collect()}["é"]
    assert (first["f"], first["b"], first["i"], first["l"]) == (1.5, 1, -3, -(1 << 40))
    assert bytes(first["raw"]) == b"\x00\xff"
    assert (first["bs"], first["ns"], first["ds"]) == ([1, 0], [1, -2], [3.5, 4.5])


def test_tfrecord_overwrite_and_nulls(spark, tmp_path):
    path = str(tmp_path / "records")
    tf.write_tfrecords(spark.range(5), path)
    tf.write_tfrecords(spark.createDataFrame([(1, None), (2, "x")], "id bigint, s string"), path, mode="overwrite")
    back = tf.read_tfrecords(spark, path, schema="id bigint, s string")
    assert sorted((r["id"], r["s"]) for r in back.collect()) == [(1, None), (2, "x")]


@pytest.mark.parametrize("dtype", ["date", "timestamp", "decimal(10,2)", "map<string,int>", "struct<a:int>", "array<string>"])
def test_types_an_example_cannot_hold(dtype):
    with pytest.raises(ValueError, match="cannot be stored"):
        tf.example_type(dtype)


def test_multi_value_bytes_are_read_completely(spark, tmp_path):
    path = tmp_path / "one.tfrecord"
    with open(path, "wb") as stream:
        write_record(stream, encode_example({"words": ("bytes", [b"a", b"b"]), "none": ("int64", [])}))
    row = tf.read_tfrecords(spark, str(path)).first()
    assert row["words"] == ["a", "b"] and row["none"] is None


def test_damage_is_found(spark, tmp_path):
    path = tmp_path / "bad.tfrecord"
    with open(path, "wb") as stream:
        write_record(stream, encode_example({"x": ("int64", [1])}))
    data = bytearray(path.read_bytes())
    data[14] ^= 1
    path.write_bytes(bytes(data))
    with pytest.raises(Exception, match="checksum"):
        tf.read_tfrecords(spark, str(path), schema="x bigint").collect()


def test_schema_is_that_of_all_records(spark, tmp_path):
    """Features that come late, and lists that start with one value."""
    path = tmp_path / "mixed"
    path.mkdir()
    records = [
        {"v": ("float", [1.0])},
        {"v": ("float", [1.0, 2.0, 3.0]), "late": ("bytes", [b"x"])},
        {"v": ("float", []), "i": ("int64", [7])},
    ]
    for n, record in enumerate(records):
        with open(path / f"part-{n}.tfrecord", "wb") as stream:
            write_record(stream, encode_example(record))
    back = tf.read_tfrecords(spark, str(path))
    assert dict(back.dtypes) == {"v": "array<double>", "late": "string", "i": "bigint"}
    assert sorted((r["v"], r["late"], r["i"]) for r in back.collect() if r["v"]) == [([1.0], None, None), ([1.0, 2.0, 3.0], "x", None)]
    tf.register(spark)
    assert spark.read.format("tfrecord").load(f"file://{path}").schema == back.schema
    with pytest.raises(Exception, match="no scheme"):
        spark.read.format("tfrecord").load(str(path))
    with pytest.raises(Exception, match="3 values"):
        tf.read_tfrecords(spark, str(path), schema="v double").collect()
    with open(path / "part-9.tfrecord", "wb") as stream:
        write_record(stream, encode_example({"i": ("float", [1.0])}))
    with pytest.raises(ValueError, match="several kinds"):
        tf.read_tfrecords(spark, str(path))
