"""Item pairs enriched with the profile of both items, and recommendation lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.operators.joins import enrich_pairs
from rankloom.operators.ordering import top_k_per_key
from rankloom.operators.sampling import kept_by_downsampling
from rankloom.session import materialize
from rankloom.sources.sinks import recommendation_json


def pair_training_set(labels: DataFrame, profile: DataFrame, row_id: Sequence[str], key: str = "pid", seed: int = 777, **sizes):
    """(training, evaluation): balanced sample and full set, both enriched.

    All pairs are enriched once and written; the sample is a flag of them.
    """
    sampled = F.coalesce(kept_by_downsampling(labels, "label", row_id, seed), F.lit(False))
    enriched = materialize(enrich_pairs(labels.withColumn("_sampled", sampled), profile, key, **sizes))
    return enriched.filter("_sampled").drop("_sampled"), enriched.drop("_sampled")


def pair_inference_lines(pairs: DataFrame, profile: DataFrame, key: str = "pid", features: str = "features") -> DataFrame:
    """``item1@item2@features1@features2`` for pairs whose items both have a profile."""
    found = enrich_pairs(pairs.select("item1", "item2"), profile.select(key, features), key)
    return found.select(F.concat_ws("@", "item1", "item2", f"{features}1", f"{features}2").alias("value"))


def top_recommendations(
    pairs: DataFrame, key: str, item: str, score: Column, k: int = 200, salts: int = 16
) -> DataFrame:
    """``(key, items, json)``: the ``k`` best items per key, best first.

    The cut to ``k`` happens before any list is collected, so a list never
    holds more than ``k`` entries.
    """
    scored = pairs.select(key, item, score.alias("_score"))
    best = top_k_per_key(scored, [key], [F.desc("_score"), F.asc(item)], k, rank="_rank", salts=salts)
    lists = best.groupBy(key).agg(F.collect_list(F.struct(F.col("_rank").alias("r"), F.col(item).alias("i"))).alias("_l"))
    ids = F.transform(F.array_sort("_l"), lambda s: s["i"])
    return lists.select(key, ids.alias("items"), recommendation_json(F.col(key), ids).alias("json"))
