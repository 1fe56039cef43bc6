"""Query op7: benchmark items in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.decontaminate import find_leaks
from rankloom.llm.registry import query, table


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an item or a re-parameterised variant of one, with the item."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
