"""Query op9: near-duplicate documents by fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.registry import query, table
from rankloom.llm.simhash import near_duplicates


@query("op9_simhash_dedup")
def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents: three-word shingles, two bits."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)
