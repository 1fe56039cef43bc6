import pytest
from pyspark.sql import functions as F

from rankloom.functions import arrays, dates, numeric, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value,shown", [(0.5, "0.5"), (0.0, "0"), (0.1234567, "0.123457"), (10.0, "10"), (-0.25, "-0.25"), (100.5, "100.5")]
)
def test_trim_decimal(spark, value, shown):
    assert one(spark, text.trim_decimal(F.col("v")), v=value) == shown


def test_split_keeps_empty_fields_and_literal_delimiters(spark):
    assert one(spark, text.split_on("v", "|"), v="a||b|") == ["a", "", "b", ""]
    assert one(spark, text.token_list("v"), v=",a,,b,") == ["a", "b"]
    assert one(spark, text.split_pick("v", "|", 9), v="a|b") is None


def test_strip_brackets(spark):
    assert one(spark, text.strip_brackets(F.col("v")), v="[12]") == "12"
    assert one(spark, text.strip_brackets(F.col("v")), v="") == ""


def test_to_double_blank_is_missing_but_garbage_raises(spark):
    assert one(spark, text.to_double("v"), v="") is None
    assert one(spark, text.to_double("v", 0.0), v="") == 0.0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, text.to_double("v"), v="abc")


def test_dates(spark):
    assert one(spark, dates.shift_date("v", -3), v="2019-09-03") == "2019-08-31"
    assert one(spark, dates.shift_date("v", -3), v="") == ""
    assert one(spark, dates.shift_date("v", 1), v="2019-01-01:2019-02-28") == "2019-03-01"
    assert dates.shift_day("2019-09-01:2019-09-03", -1) == "2019-09-02"
    days = dates.day_range(F.to_date(F.col("a")), F.to_date(F.col("b")))
    assert [d.isoformat() for d in one(spark, days, a="2019-09-30", b="2019-10-01")] == ["2019-09-30", "2019-10-01"]
    assert one(spark, days, a="2019-09-30", b="2019-09-01") == []
    assert one(spark, dates.parse_seconds("v"), v="2019-09-01 10:00:00.75").isoformat() == "2019-09-01T10:00:00"


def test_tail_and_padding(spark):
    assert one(spark, arrays.tail(F.col("v"), 2), v=[1, 2, 3]) == [2, 3]
    assert one(spark, arrays.tail(F.col("v"), 20), v=[1, 2, 3]) == [1, 2, 3]
    assert one(spark, arrays.pad_to(F.col("v"), 5, F.lit(0).cast("bigint")), v=[1, 1, 2]) == [1, 1, 2, 0, 0]
    assert one(spark, arrays.pad_to(F.col("v"), 2, F.lit(0).cast("bigint"), surplus="cut"), v=[1, 1, 2]) == [1, 1]


def test_reductions_of_nothing(spark):
    empty = F.array().cast("array<double>")
    assert one(spark, arrays.reduce_values(empty, "sum")) == 0.0
    assert one(spark, arrays.reduce_values(empty, "mean")) == 0.0
    assert one(spark, arrays.reduce_values(empty, "max")) is None
    assert one(spark, arrays.reduce_values(F.col("v"), "centered_l2"), v=[1.0, 3.0]) == pytest.approx(2**0.5)
    with pytest.raises(ValueError):
        arrays.reduce_values(empty, "median")


def test_masked_softmax(spark):
    weights = one(spark, arrays.masked_softmax(F.col("s"), F.col("m")), s=[1000.0, 1000.0, 5.0], m=[1, 1, 0])
    assert weights == pytest.approx([0.5, 0.5, 0.0])
    assert one(spark, arrays.masked_softmax(F.col("s"), F.col("m")), s=[1.0, 2.0], m=[0, 0]) == [0.0, 0.0]


def test_interaction_and_thirds(spark):
    assert one(spark, arrays.interaction(F.col("a"), F.col("b")), a=[1.0, 2.0], b=[3.0, 5.0]) == [
        1.0, 2.0, 3.0, 5.0, -2.0, -3.0, 3.0, 10.0
    ]
    parts = arrays.thirds(F.col("v"))
    assert [one(spark, p, v=[1, 2, 3, 4, 5, 6]) for p in parts] == [[1, 2], [3, 4], [5, 6]]


def test_bucket_trimmed_matches_definition(spark):
    rows = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(None,)], "v double")
    got = {r["v"]: r["b"] for r in rows.select("v", numeric.bucket_trimmed(F.col("v"), F.lit(3.0), F.lit(9.0), 5).alias("b")).collect()}
    assert (got[3.0], got[4.0], got[7.0], got[9.0], got[None]) == (1, 1, 2, 4, 0)
    assert 3 not in got.values()  # the bucket below the last one never occurs


def test_bucket_minmax(spark):
    rows = spark.range(9).select(
        "id", numeric.bucket_minmax(F.col("id").cast("double"), F.lit(0.0), F.lit(8.0), 5).alias("b")
    )
    assert [r["b"] for r in rows.orderBy("id").collect()] == [0, 1, 1, 2, 2, 3, 3, 4, 4]
    assert one(spark, numeric.bucket_minmax(F.lit(4.0), F.lit(4.0), F.lit(4.0), 5)) == 0


def test_minmax_scale(spark):
    assert one(spark, numeric.minmax_scale(F.lit(90.0), F.lit(0.0), F.lit(50.0), clip=50.0)) == 1.0
    assert one(spark, numeric.minmax_scale(F.lit(90.0), F.lit(0.0), F.lit(50.0))) == 1.8
    assert one(spark, numeric.minmax_scale(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0))) == 0.0


def test_ratio_guard_raises(spark):
    assert one(spark, numeric.ratio_below_one(F.lit(1), F.lit(4))) == 0.25
    with pytest.raises(Exception, match="ratio must be below 1"):
        one(spark, numeric.ratio_below_one(F.lit(4), F.lit(4)))


def test_losses(spark):
    assert one(spark, numeric.logloss(F.lit(1), F.lit(0.0))) == pytest.approx(16.118, abs=1e-3)
    assert one(spark, numeric.logloss_from_logit(F.lit(0), F.lit(800.0))) == pytest.approx(800.0)
    with pytest.raises(ValueError):
        numeric.focal(F.lit(1), F.lit(0.5), form="cubic")


def test_session_sizing():
    from rankloom.session import sized_for

    assert sized_for(1)["spark.sql.shuffle.partitions"] == "200"
    large = sized_for(100 * 2**40)
    assert large["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (128 * 2**20))
    assert sized_for(1, split_mb=512)["spark.sql.files.maxPartitionBytes"] == "512m"
