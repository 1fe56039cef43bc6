"""Inputs organised in one folder per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.dates import shift_day


def day_list(text: str) -> list[str]:
    """``a`` or ``a:b`` (inclusive) to days; a reversed range is empty."""
    first, _, last = text.partition(":")
    start, end = dt.date.fromisoformat(first), dt.date.fromisoformat(last or first)
    return [(start + dt.timedelta(days=i)).isoformat() for i in range((end - start).days + 1)]


def filter_days(df: DataFrame, days: str, column: str = "date") -> DataFrame:
    """Keep ``a`` or ``a:b``; on a partition column this prunes folders."""
    first, _, last = days.partition(":")
    return df.filter(F.col(column).between(F.lit(first).cast("date"), F.lit(last or first).cast("date")))


def read_days(
    spark: SparkSession, root: str, days: str, fmt: str = "text", schema=None, name_glob: str | None = None
) -> DataFrame:
    """Union of the plain day folders ``root/yyyy-MM-dd``, nested files included."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    paths = [f"{root.rstrip('/')}/{day}" for day in day_list(days)]
    if not paths:
        raise ValueError(f"empty day range {days!r}")
    return reader.load(paths)


def snapshot(df: DataFrame, run_date: str, lag: int, column: str = "date") -> DataFrame:
    """The dimension snapshot of ``lag`` days before ``run_date`` (one partition)."""
    return df.filter(F.col(column) == F.lit(shift_day(run_date, -lag)).cast("date"))
