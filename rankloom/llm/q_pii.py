"""Query op6: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.pii import BASE, find_spans, span_list
from rankloom.llm.registry import query, table


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the given kinds, and all spans."""
    found = find_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    counts = [_count(i).alias(f"n_{kind.name}") for i, kind in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def _count(rank: int):
    return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("bigint")
