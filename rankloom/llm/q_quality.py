"""Query op1: perplexity and verdict of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.quality import judge, learn, score
from rankloom.llm.registry import query, table


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model from trusted documents, verdict for every one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    model, limits = learn(docs, table(spark, sf_dir, "labels"))
    return judge(score(docs, model), limits).select("doc_id", "lang", "lm_chars", "perplexity", "excess", "limit", "kept")
