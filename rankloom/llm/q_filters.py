"""Query op12: the audit of five filters over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.filter_audit import audit, filter_cells
from rankloom.llm.registry import query, table

SQL = r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN w.doc_id > first THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY part, mask),
f(x, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, f.x, f.bit, (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE position(g.x IN filter_order) < step) AS before
  FROM o, range(1, 6) r(step) JOIN f ON f.x = filter_order[step]),
a AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, x,
    sum(CASE WHEN mask & (before + bit)::BIGINT = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before::BIGINT = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before::BIGINT <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before::BIGINT = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before::BIGINT = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM s, c GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM a"""


@query("op12_filter_audit", SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, by language."""
    return audit(filter_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
