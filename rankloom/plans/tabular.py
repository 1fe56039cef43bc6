"""Tabular click data: clipped min-max numbers and cut-off vocabularies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.numeric import clip_upper, minmax_scale
from rankloom.functions.text import trim_decimal
from rankloom.operators.encode import encode_lists
from rankloom.operators.vocab import min_count_vocabulary, token_frequency
from rankloom.session import materialize

# Upper clip point of each of the 13 integer columns.
CLIP_POINTS = (20, 600, 100, 50, 64000, 500, 100, 50, 500, 10, 10, 10, 50)


NUMBERS = [f"I{i}" for i in range(1, 14)]
CATEGORIES = [f"C{i}" for i in range(1, 27)]


def clip_points() -> dict[str, int]:
    """Clip point by integer column."""
    return dict(zip(NUMBERS, CLIP_POINTS))


def read_tabular(spark: SparkSession, path) -> DataFrame:
    """Tab separated label, 13 integers and 26 categories; blank is missing, a bad line raises."""
    fields = ["label int", *[f"{c} bigint" for c in NUMBERS], *[f"{c} string" for c in CATEGORIES]]
    reader = spark.read.schema(", ".join(fields)).option("sep", "\t").option("mode", "FAILFAST").option("quote", "")
    return reader.csv(path)


def clipped_minmax(df: DataFrame, clips: dict[str, float]) -> DataFrame:
    """One row of ``<c>_min`` and ``<c>_max`` after clipping; missing values are ignored."""
    return df.agg(
        *[F.min(clip_upper(F.col(c), limit)).alias(f"{c}_min") for c, limit in clips.items()],
        *[F.max(clip_upper(F.col(c), limit)).alias(f"{c}_max") for c, limit in clips.items()],
    )


def categorical_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(field, token, n)`` of all columns in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("token")) for c in columns])
    return token_frequency(df.select(F.explode(cells).alias("x")).select("x.field", "x.token"), by=["field"])


def tabular_features(
    df: DataFrame,
    key: str,
    label: str,
    clips: dict[str, float],
    categories: Sequence[str],
    cutoff: int = 200,
    clip_on_apply: bool = True,
) -> DataFrame:
    """``key``, ``label``, scaled numbers as text, category ids and the joined line."""
    stats = clipped_minmax(df, clips)
    limits = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    vocab = materialize(min_count_vocabulary(categorical_counts(df, categories), cutoff, by="field"))
    rows = df.select(key, label, *clips, *categories).withColumn("_s", limits)
    scaled = rows.select(
        key,
        label,
        *[
            trim_decimal(
                minmax_scale(
                    F.col(c),
                    F.col(f"_s.{c}_min").cast("double"),
                    F.col(f"_s.{c}_max").cast("double"),
                    clip=limit if clip_on_apply else None,
                )
            ).alias(c)
            for c, limit in clips.items()
        ],
        *categories,
    )
    encoded = encode_lists(scaled, vocab, key, lists={}, scalars={c: c for c in categories})
    line = F.concat_ws("\t", F.col(label).cast("string"), *clips, *[F.col(c).cast("string") for c in categories])
    return encoded.withColumn("line", line)
