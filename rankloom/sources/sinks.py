"""Text, JSON and dated outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import list_text


def joined_line(columns: Sequence[Column | str], delim: str, null: str = "") -> Column:
    """One text line; unlike plain ``concat_ws`` a NULL keeps its place."""
    return F.concat_ws(
        delim, *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null)) for c in columns]
    )


def sample_line(
    label: Column | str = "label",
    scalars: Sequence[str] = ("cid", "pid"),
    lists: Sequence[str] = ("click", "click_cross", "order_cross"),
    profile: Sequence[str] = (),
) -> Column:
    """``label@cid|pid|click|click_cross|order_cross|profile...`` with lists as ``1, 2``."""
    body = joined_line([*scalars, *[list_text(F.col(c)) for c in lists], *profile], "|")
    head = F.col(label) if isinstance(label, str) else label
    return F.concat_ws("@", head.cast("string"), body)


def write_text(df: DataFrame, line: Column, path: str, mode: str = "error") -> None:
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_replacing(df: DataFrame, path: str, fmt: str = "parquet", partition: Sequence[str] = ()) -> None:
    """Replace the target; with ``partition`` only the partitions that are written."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition:
        writer = writer.partitionBy(*partition).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def recommendation_json(key: Column, ids: Column) -> Column:
    """``{"item_key":{"s":..},"info":{"l":[{"n":..},..]}}`` with typed string values."""
    return F.to_json(
        F.struct(
            F.struct(key.cast("string").alias("s")).alias("item_key"),
            F.struct(F.transform(ids, lambda i: F.struct(i.cast("string").alias("n"))).alias("l")).alias("info"),
        )
    )
