"""Query op8: near-duplicate vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.embedding_dedup import near_vectors
from rankloom.llm.registry import query, table


SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
  p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
  r AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
  n AS (SELECT a, count(*) AS n FROM p GROUP BY a),
  c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(c.b, vec_id)) AS component_id,
  vec_id <= coalesce(c.b, vec_id) AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN c ON vec_id = c.a"""


@query("op8_embedding_dedup", SQL)
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and representative of all vectors."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
