"""The bit map lets no wanted row pass by, and few strangers."""

import pytest
from pyspark.sql import functions as F

from rankloom.llm import bitmap
from rankloom.llm.bitmap import bit_map


@pytest.mark.parametrize("most", [26, 16])
def test_no_wanted_row_is_missed(spark, monkeypatch, most):
    monkeypatch.setattr(bitmap, "MOST_BITS", most)
    key = F.struct(F.col("id"), F.col("id").cast("string").alias("s"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"))
    rows = spark.range(60_000).select("id", key.alias("k"))
    wanted = rows.filter("id % 20 = 3").select("k").cache()
    test = bit_map(wanted, "k")
    found = {r["id"] for r in rows.filter(test(F.col("k"))).select("id").collect()}
    assert found >= set(range(3, 60_000, 20))
    assert len(found) < (9_000 if most == 26 else 30_000)


def test_nothing_is_wanted(spark):
    rows = spark.range(100).select(F.col("id").alias("k"))
    assert rows.filter(bit_map(rows.limit(0), "k")(F.col("k"))).count() == 0
