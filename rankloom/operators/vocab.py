"""Vocabularies: ordered token tables with dense ids, 0 is the default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.arrays import zip_padded
from rankloom.operators.ordering import ordered_prefix

DEFAULT_TOKEN = "DEFAULT"
UNKNOWN_TOKEN = "<unk>"

def frequency_order() -> list[Column]:
    """Most frequent first, ties by token."""
    return [F.desc("n"), F.asc("token")]


def token_frequency(df: DataFrame, token: str = "token", by: Sequence[str] = (), weight: Column | None = None):
    """``(by..., token, n)`` over non-empty tokens."""
    count = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        df.filter(F.col(token).isNotNull() & (F.col(token) != ""))
        .groupBy(*by, F.col(token).alias("token"))
        .agg(count.cast("bigint").alias("n"))
    )


def flatten_tokens(samples: DataFrame) -> DataFrame:
    """One row per position of a sample: ``(cid, pid, cross_pair)``, short lists padded with ''.

    The target item leads the item list; the user is repeated on every row.
    """
    items = F.concat(F.array("pid"), F.col("click"))
    pairs = F.concat("click_cross", "order_cross")
    return samples.select("cid", F.explode(zip_padded("", pid=items, cross_pair=pairs)).alias("z")).select(
        "cid", "z.pid", "z.cross_pair"
    )


def sample_token_counts(samples: DataFrame) -> DataFrame:
    """``(field, token, n)`` of :func:`flatten_tokens` without writing the padded rows.

    A user counts once per padded row, which is the length of the longer list.
    """
    n_items = F.size("click") + 1
    n_pairs = F.size("click_cross") + F.size("order_cross")

    def one(field: str, token: Column, n: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), token.alias("token"), n.cast("bigint").alias("w"))

    tokens = F.concat(
        F.array(one("cid", F.col("cid"), F.greatest(n_items, n_pairs)), one("pid", F.col("pid"), F.lit(1))),
        F.transform("click", lambda t: one("pid", t, F.lit(1))),
        F.transform(F.concat("click_cross", "order_cross"), lambda t: one("cross", t, F.lit(1))),
    )
    long = samples.select(F.explode(tokens).alias("t")).select("t.field", "t.token", "t.w")
    return token_frequency(long, by=["field"], weight=F.col("w"))


def coverage_vocabulary(
    counts: DataFrame,
    rates: dict[str, float] | float,
    by: str | None = None,
    totals: dict[str, int] | int | None = None,
) -> DataFrame:
    """Head of the frequency order whose running count stays below rate * total.

    The comparison is strict, so the token that reaches the threshold is out.
    ``totals`` replaces the number of counted tokens (for instance by the
    number of padded rows).  Ids are dense from 1 in frequency order.
    """
    groups = [by] if by else []
    placed = ordered_prefix(
        counts, frequency_order(), by=groups, sums={"running": F.col("n")}, position="id", group_totals=totals is None
    )
    if by:
        rate = F.element_at(F.create_map(*[F.lit(x) for kv in rates.items() for x in kv]), F.col(by))
    else:
        rate = F.lit(float(rates))
    if totals is None:
        total = F.col("total_running")
    elif by:
        total = F.element_at(F.create_map(*[F.lit(x) for kv in totals.items() for x in kv]), F.col(by))
    else:
        total = F.lit(totals)
    threshold = rate * total
    return placed.filter(F.col("running") < threshold).select(*groups, "token", "n", "running", "id")


def min_count_vocabulary(counts: DataFrame, cutoff: int, by: str | None = None) -> DataFrame:
    """Tokens seen at least ``cutoff`` times, ids from 1 in frequency order."""
    groups = [by] if by else []
    kept = counts.filter(F.col("n") >= cutoff)
    return ordered_prefix(kept, frequency_order(), by=groups, position="id").select(*groups, "token", "n", "id")


def dense_ids(counts: DataFrame) -> DataFrame:
    """Ids 1..n in frequency order."""
    return ordered_prefix(counts, frequency_order(), position="id").select("token", "n", "id")


def with_default(vocab: DataFrame, token: str = DEFAULT_TOKEN, by: str | None = None, fields: Sequence[str] = ()):
    """Add the default token with id 0 (one row, or one per field)."""
    spark = vocab.sparkSession
    if by:
        extra = spark.createDataFrame([(f, token, 0) for f in fields], f"{by} string, token string, id bigint")
        return extra.unionByName(vocab.select(by, "token", "id"))
    extra = spark.createDataFrame([(token, 0)], "token string, id bigint")
    return extra.unionByName(vocab.select("token", "id"))
