"""Queries on tokens: op3 and op4."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.registry import query, table
from rankloom.llm.sp_encode import decode_ids, encode_texts
from rankloom.llm.sp_model import MergeModel, load
from rankloom.llm.token_counts import count_tokens


@cache
def piece_model(name: str = "piece_bpe_32k.model") -> MergeModel:
    import public_tokenizers

    return load(public_tokenizers.path(name))


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return count_tokens(table(spark, sf_dir, "documents"), piece_model())


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of all documents, as digests."""
    model = piece_model()
    done = decode_ids(encode_texts(table(spark, sf_dir, "documents"), model), model)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
