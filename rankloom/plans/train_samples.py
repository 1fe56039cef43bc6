"""Labelled, encoded training samples from an interaction log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.numeric import bucket_minmax, bucket_trimmed
from rankloom.operators.encode import encode_lists
from rankloom.operators.history import MAX_ROWS_PER_KEY, cross_tokens, last_n_history
from rankloom.operators.joins import dimension_join
from rankloom.operators.ordering import order_statistics, order_statistics_approx
from rankloom.operators.sampling import balanced_sample, split_fold
from rankloom.operators.skew import broadcast_if_small
from rankloom.operators.vocab import coverage_vocabulary, sample_token_counts, with_default
from rankloom.session import materialize
from rankloom.sources.interactions import CLICK, IMPRESSION, ORDER
from rankloom.sources.sinks import sample_line


@dataclass(frozen=True)
class SampleSettings:
    """Sizes and rates of the sample job."""

    history: int | None = 20  # None: whole histories
    per_user: int = 7
    rates: tuple[tuple[str, float], ...] = (("cid", 0.8), ("pid", 0.9), ("cross", 0.5))
    buckets: int = 3000
    seed: int = 777
    folds: int = 10
    rows_total: bool = False
    max_rows_per_user: int = MAX_ROWS_PER_KEY


def label_samples(log: DataFrame, row_id: str, settings: SampleSettings = SampleSettings()) -> DataFrame:
    """Sampled targets with their point-in-time histories.

    Targets are sampled before histories are built, and impressions that were
    not drawn never reach the history shuffle, nor do events of users without a
    target.  The log is evaluated once: its few columns are written and reread.
    """
    order = ["ts", "pid", "tag", row_id]
    log = materialize(log.select("cid", *order))
    targets = balanced_sample(
        log, "cid", row_id, positive=CLICK, negative=IMPRESSION, cap=settings.per_user, seed=settings.seed
    )
    targets = materialize(targets.select("cid", "label", *order))
    users = materialize(targets.select(F.col("cid").alias("_user")).distinct())
    sources = log.filter(F.col("tag").isin(CLICK, ORDER)).join(
        broadcast_if_small(users), F.col("cid").eqNullSafe(F.col("_user")), "left_semi"
    )
    sources = sources.withColumn(
        "stream", F.when(F.col("tag") == CLICK, "click").otherwise("order")
    )
    found = last_n_history(
        targets,
        sources,
        ["cid"],
        order,
        item="pid",
        stream="stream",
        streams=["click", "order"],
        n=settings.history,
        max_rows_per_key=settings.max_rows_per_user,
        few_targets=True,
    )
    crossed = cross_tokens(
        cross_tokens(found, "pid", "click_history", "click_cross"), "pid", "order_history", "order_cross"
    )
    return crossed.select(
        F.col(row_id).alias("sample_id"),
        "cid",
        "pid",
        "label",
        F.col("click_history").alias("click"),
        "click_cross",
        "order_cross",
    )


def learn_vocabularies(samples: DataFrame, settings: SampleSettings = SampleSettings()) -> DataFrame:
    """``(field, token, id)`` for users, items and pairs, DEFAULT at 0.

    ``settings.rows_total`` measures coverage against the number of padded rows
    instead of the number of tokens.
    """
    rates = dict(settings.rates)
    totals = None
    if settings.rows_total:
        rows = samples.agg(
            F.sum(F.greatest(F.size("click") + 1, F.size("click_cross") + F.size("order_cross"))).alias("n")
        ).first()["n"]
        totals = {f: int(rows or 0) for f in rates}
    counts = sample_token_counts(samples)
    vocab = coverage_vocabulary(counts, rates, by="field", totals=totals)
    return with_default(vocab, by="field", fields=sorted(rates))


def bucket_profile(
    profile: DataFrame, key: str, columns: Sequence[str], groups: int, mode: str = "trimmed", exact: bool = True
) -> DataFrame:
    """Profile with every numeric column replaced by its bucket number."""
    if mode == "minmax":
        stats = profile.agg(
            F.struct(
                *[F.min(c).cast("double").alias(f"{c}_lo") for c in columns],
                *[F.max(c).cast("double").alias(f"{c}_hi") for c in columns],
            ).alias("s")
        )
        bucket = bucket_minmax
    else:
        rank = order_statistics if exact else order_statistics_approx
        stats = rank(profile, columns, groups).agg(
            F.struct(
                *[F.max(F.when(F.col("field") == c, F.col("lo"))).alias(f"{c}_lo") for c in columns],
                *[F.max(F.when(F.col("field") == c, F.col("hi"))).alias(f"{c}_hi") for c in columns],
            ).alias("s")
        )
        bucket = bucket_trimmed
    limits = profile.select(key, *columns).withColumn("_s", stats.scalar())
    return limits.select(
        key,
        *[bucket(F.col(c).cast("double"), F.col(f"_s.{c}_lo"), F.col(f"_s.{c}_hi"), groups).alias(c) for c in columns],
    )


def encode_samples(
    samples: DataFrame, vocab: DataFrame, profile: DataFrame, key: str, keep_missing: bool = False, drop_empty: bool = False
) -> DataFrame:
    """Attach profile buckets and replace every token by its id.

    Samples whose item has no profile are dropped, or kept with zeros when
    ``keep_missing`` is set.
    """
    columns = [c for c in profile.columns if c != key]
    rows = dimension_join(samples, profile, [("pid", key)], how="left" if keep_missing else "inner")
    if keep_missing:
        rows = rows.na.fill(0, subset=columns)
    return encode_lists(
        rows,
        vocab,
        "sample_id",
        lists={"click": "pid", "click_cross": "cross", "order_cross": "cross"},
        scalars={"cid": "cid", "pid": "pid"},
        drop_empty=drop_empty,
    )


def train_samples(
    log: DataFrame,
    row_id: str,
    profile: DataFrame,
    profile_key: str,
    profile_columns: Sequence[str],
    settings: SampleSettings = SampleSettings(),
    drop_empty: bool = False,
    keep_missing: bool = False,
    bucket_mode: str = "trimmed",
) -> DataFrame:
    """Encoded samples with their text line and fold (0 = evaluation).

    ``keep_missing`` keeps samples whose item has no profile (bucket 0);
    ``bucket_mode`` is ``trimmed`` or ``minmax``, where a blank counts as 0.
    """
    samples = materialize(label_samples(log, row_id, settings))
    vocab = materialize(learn_vocabularies(samples, settings))
    if bucket_mode == "minmax":
        profile = profile.na.fill(0, subset=list(profile_columns))
    buckets = bucket_profile(profile, profile_key, profile_columns, settings.buckets, mode=bucket_mode)
    encoded = encode_samples(samples, vocab, buckets, profile_key, keep_missing=keep_missing, drop_empty=drop_empty)
    folded = split_fold(encoded, ["sample_id"], settings.folds, settings.seed)
    return folded.withColumn("line", sample_line(profile=list(profile_columns)))
