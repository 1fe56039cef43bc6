"""Query op11: the best five of every fiftieth vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.registry import query, table
from rankloom.llm.topk_search import top_k

SQL = """WITH k AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT r, vec_id, list_transform(e, lambda x: floor(256 * x)) AS e FROM k),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.e) = len(c.e)),
n AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM n WHERE rank <= 5"""


@query("op11_topk_search", SQL)
def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner products of whole-number vectors, five per query."""
    return top_k(table(spark, sf_dir, "embeddings"))
