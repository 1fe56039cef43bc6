"""Interaction logs in long form: one row per impression, click or order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.dates import parse_seconds
from rankloom.functions.text import split_on, token_list
from rankloom.sources.delimited import split_lines

IMPRESSION, CLICK, ORDER = 0, 1, 2

# Field order of a user line on disk.
USER_LINE = ["cid", "imp", "imptime", "order", "ordertime", "click", "clicktime"]


def _aligned(items: Column, times: Column, tag: int, line: Column) -> Column:
    """Items and times as structs; raises when the lists differ in length."""
    zipped = F.zip_with(
        items, times, lambda i, t: F.struct(i.alias("pid"), parse_seconds(t).alias("ts"), F.lit(tag).alias("tag"))
    )
    return F.when(F.size(items) == F.size(times), zipped).otherwise(
        F.raise_error(F.concat(F.lit("items and times differ for "), line))
    )


def explode_user_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``cid|imp|imptime|order|ordertime|click|clicktime`` to ``(cid, pid, ts, tag, seq)``.

    ``seq`` is unique within a line and makes the time order of a user total.
    """
    fields = split_lines(lines, "|", USER_LINE, column=column)

    def times(name: str) -> Column:
        text = F.col(name)
        return F.when(text == "", F.array().cast("array<string>")).otherwise(split_on(text, ","))

    parts = [
        _aligned(token_list(F.col(name)), times(f"{name}time"), tag, F.col("cid"))
        for name, tag in (("imp", IMPRESSION), ("click", CLICK), ("order", ORDER))
    ]
    return fields.select("cid", F.posexplode(F.concat(*parts)).alias("seq", "e")).select(
        "cid", "e.pid", "e.ts", "e.tag", "seq"
    )


def read_user_log(spark: SparkSession, path) -> DataFrame:
    return explode_user_lines(spark.read.text(path))


def from_events(events: DataFrame) -> DataFrame:
    """Long form of an event table with view, click and purchase rows."""
    tag = (
        F.when(F.col("event_type") == "view", IMPRESSION)
        .when(F.col("event_type") == "click", CLICK)
        .when(F.col("event_type") == "purchase", ORDER)
    )
    return events.filter(F.col("event_type").isin("view", "click", "purchase")).select(
        F.col("user_id").cast("string").alias("cid"),
        F.get_json_object("props", "$.k").alias("pid"),
        "ts",
        tag.alias("tag"),
        "event_id",
    )
