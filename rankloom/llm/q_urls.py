"""Query op5: verdicts for all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.registry import query, table
from rankloom.llm.url_filter import ALLOW, BLOCK, Rule, judge_urls, labelled_urls, train_judge

# Given with the contract.
RULES = (
    Rule(ALLOW, "com/"),
    Rule(BLOCK, "example.com/en/"),
    Rule(ALLOW, "www.example.com/en/"),
    Rule(BLOCK, "net/es/"),
    Rule(BLOCK, "net/fr/"),
)


@query("op5_url_filter")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules first; the model, trained on the small labelled table, judges the rest."""
    return judge_urls(table(spark, sf_dir, "pages"), RULES, train_judge(labelled_urls(spark)))
