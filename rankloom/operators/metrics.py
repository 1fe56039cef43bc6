"""Ranking and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.numeric import focal, logloss
from rankloom.operators.ordering import ordered_prefix


def auc(df: DataFrame, label: str = "label", score: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC per group, ties count one half; NULL when a class is missing.

    Rows are counted per distinct score first, so a score shared by a third of
    the rows is one row of the ordering.
    """
    counts = df.groupBy(*by, F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )
    placed = ordered_prefix(counts, [F.asc("_score")], by=by, sums={"_upto": F.col("_neg")}, position="_at")
    wins = F.sum(F.col("_pos") * (F.col("_upto") - F.col("_neg") + F.col("_neg") * F.lit(0.5)))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return placed.groupBy(*by).agg(F.try_divide(wins, pairs).alias("auc"))


def precision_half(df: DataFrame, label: str = "label", score: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with ``|p - y| < 0.5``."""
    hit = F.abs(F.col(score) - F.col(label)) < 0.5
    return df.groupBy(*by).agg(F.avg(hit.cast("double")).alias("precision"))


def mean_logloss(df: DataFrame, label: str = "label", score: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(logloss(F.col(label), F.col(score))).alias("logloss"))


def mean_focal(
    df: DataFrame,
    label: str = "label",
    score: str = "pred",
    weight: str | None = None,
    alpha: float = 0.25,
    gamma: float = 2.0,
    form: str = "linear",
    by: Sequence[str] = (),
) -> DataFrame:
    """Weighted mean focal loss, rescaled by N / (sum of weights + 1)."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    term = focal(F.col(label), F.col(score), alpha, gamma, form) * w
    return df.groupBy(*by).agg(
        (F.avg(term) * F.count(F.lit(1)) / (F.sum(w) + F.lit(1.0))).alias("focal")
    )


def residuals(df: DataFrame, label: str = "label", score: str = "pred", keys: Sequence[str] = ()) -> DataFrame:
    """Label, prediction and their difference."""
    return df.select(
        *keys,
        F.col(label).alias("label"),
        F.col(score).alias("prediction"),
        (F.col(label).cast("double") - F.col(score)).alias("residual"),
    )
