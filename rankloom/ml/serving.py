"""Key/value tables for online serving."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import field_token
from rankloom.operators.joins import dimension_join


def field_weights(field: str, vocab: DataFrame, weights: DataFrame, id_col: str = "id", value: str = "vec") -> DataFrame:
    """``(key, vec)`` of one field: tokens prefixed by the field name, joined on the stored id."""
    rows = vocab.select("token", F.col("id").alias("_vid"))
    table = weights.select(F.col(id_col).alias("_wid"), F.col(value).alias("vec"))
    return dimension_join(rows, table, [("_vid", "_wid")], how="inner").select(
        field_token(field, F.col("token")).alias("key"), "vec"
    )


def union_all(frames) -> DataFrame:
    """Union by name of a list of DataFrames."""
    return reduce(DataFrame.unionByName, frames)


def serving_table(fields: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """One ``(key, vec)`` table of all fields."""
    return union_all([field_weights(name, vocab, weights) for name, (vocab, weights) in fields.items()])


def write_serving_table(table: DataFrame, path: str, mode: str = "error") -> None:
    table.select(F.concat_ws(",", "key", "vec").alias("value")).write.mode(mode).text(path)
