"""Query op10: the language of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.language import held_out, learn_profiles, predict_language
from rankloom.llm.registry import query, table


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from documents that are not held out, predict all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = learn_profiles(docs.filter(~held_out(F.col("doc_id"))))
    done = predict_language(docs.select("doc_id", "text"), profiles)
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
