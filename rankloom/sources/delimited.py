"""Delimited text with a fixed layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.text import drop_first_char, drop_last_char, is_nonblank, split_on, to_double


def split_lines(lines: DataFrame, delim: str, names: Sequence[str], bad: str = "fail", column: str = "value"):
    """Split a text column into named string fields.

    ``bad='fail'`` raises on a line with another number of fields and shows the
    line; ``bad='drop'`` skips such lines.
    """
    fields = lines.select(split_on(F.col(column), delim).alias("_f"), F.col(column).alias("_line"))
    arity = F.size("_f") == len(names)
    if bad == "drop":
        fields = fields.filter(arity)
    elif bad == "fail":
        checked = F.when(arity, F.col("_f")).otherwise(
            F.raise_error(F.concat(F.lit(f"expected {len(names)} fields: "), F.col("_line")))
        )
        fields = fields.withColumn("_f", checked)
    else:
        raise ValueError("bad must be 'fail' or 'drop'")
    return fields.select(*[F.get("_f", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_delimited(spark: SparkSession, path, delim: str, names: Sequence[str], bad: str = "fail") -> DataFrame:
    return split_lines(spark.read.text(path), delim, names, bad)


def read_headed(spark: SparkSession, path, delim: str, names: Sequence[str], key: str) -> DataFrame:
    """Delimited text whose header line repeats the column names.

    The header is dropped by content, so it is found in every file of a
    directory and wherever the file is split.
    """
    table = read_delimited(spark, path, delim, names)
    return table.filter(F.col(key) != F.lit(key))


def positional_schema(header: str, delim: str = "|") -> T.StructType:
    """String schema from a header line, in file order."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in header.split(delim)])


def ordinal_dictionary(lines: DataFrame, delim: str = "|", column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., ordinal, name)`` rows of header lines, ordinals from 1."""
    named = lines.select(*keep, F.posexplode(split_on(F.col(column), delim)).alias("_p", "name"))
    return named.select(*keep, (F.col("_p") + 1).alias("ordinal"), "name")


def pick_columns(
    lines: DataFrame,
    delim: str,
    key_index: int,
    indexes: Sequence[int],
    missing: float | None = None,
    column: str = "value",
    key: str = "pid",
) -> DataFrame:
    """Key field and some numeric fields by ordinal (0-based); blank -> ``missing``."""
    fields = lines.select(split_on(F.col(column), delim).alias("_f"))
    at = lambda i: F.get("_f", F.lit(i))
    return fields.select(at(key_index).alias(key), *[to_double(at(i), missing).alias(f"c{i}") for i in indexes])


def nonblank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose listed fields all hold more than spaces, with spaces removed for the test only."""
    keep: Column = F.lit(True)
    for name in columns:
        keep = keep & is_nonblank(F.col(name))
    return df.filter(keep)


def read_pairs(spark: SparkSession, path, train: bool = True) -> DataFrame:
    """Pair labels ``item1|item2|label`` (train) or tab separated (inference)."""
    table = read_delimited(spark, path, "|" if train else "\t", ["item1", "item2", "label"], bad="drop")
    return nonblank_rows(table, ["item1", "item2", "label"])


def parse_neighbours(rows: DataFrame) -> DataFrame:
    """``(pid, match_id, score)`` from four CSV text fields of a bracketed list.

    The first field starts with one bracket character and the last one ends
    with one; the score is the product of the two score fields.
    """
    first, match, left, right = [F.col(c) for c in rows.columns]
    return rows.select(
        F.trim(drop_first_char(first)).cast("bigint").alias("pid"),
        F.trim(match).cast("bigint").alias("match_id"),
        (F.trim(left).cast("double") * F.trim(drop_last_char(right)).cast("double")).alias("score"),
    )


def read_neighbours(spark: SparkSession, path) -> DataFrame:
    """Neighbour lists from headerless CSV files."""
    rows = spark.read.schema("a string, b string, c string, d string").option("mode", "FAILFAST").csv(path)
    return parse_neighbours(rows)
