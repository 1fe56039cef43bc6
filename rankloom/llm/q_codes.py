"""Query op13: codes of all vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.registry import query, table
from rankloom.llm.vector_codes import ROUNDS, compress


def _sql() -> str:
    """Plain rounds of assigning and averaging, one pair of statements per round."""
    steps = [
        """k AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """v AS MATERIALIZED (SELECT vec_id, r, (i - 1) // (len(e) // 8) AS p, (i - 1) % (len(e) // 8) AS q, CAST(floor(4096 * e[i]) AS BIGINT) AS x
  FROM k, LATERAL (SELECT unnest(range(1, len(e) + 1)) AS i))""",
        "b0 AS MATERIALIZED (SELECT p, r - 1 AS c, q, x AS y FROM v WHERE r <= 16)",
    ]
    for n in range(ROUNDS + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (SELECT vec_id, r, p, min(d * 16 + c) % 16 AS c, min(d * 16 + c) // 16 AS d FROM (
  SELECT vec_id, r, v.p, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d FROM v JOIN b{n} b ON v.p = b.p AND v.q = b.q GROUP BY vec_id, r, v.p, c) GROUP BY vec_id, r, p)"""
        )
        if n < ROUNDS:
            steps.append(
                f"""b{n + 1} AS MATERIALIZED (SELECT b.p, b.c, b.q, coalesce(m.y, b.y) AS y FROM b{n} b LEFT JOIN (
  SELECT a.p, a.c, v.q, CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS y FROM a{n} a JOIN v ON a.r = v.r AND a.p = v.p GROUP BY a.p, a.c, v.q) m
  ON b.p = m.p AND b.c = m.c AND b.q = m.q)"""
            )
    last = f"a{ROUNDS}"
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
f AS (SELECT r, string_agg(printf('%02x', c), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM {last} GROUP BY r)
SELECT k.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, c, q)) FROM b{ROUNDS}) AS codebooks_sha256
FROM f JOIN k ON f.r = k.r"""
    )


@query("op13_vector_codes", _sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight parts, sixteen entries, six rounds."""
    return compress(table(spark, sf_dir, "embeddings"))
