"""Registry of queries and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.sources.interactions import from_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(table(spark, sf_dir, "events"))


def text(col, sep: str = ","):
    """Array column as text for comparison."""
    return F.array_join(F.transform(col, lambda x: x.cast("string")), sep)


# SQL fragments shared by the statements.
INTER = """inter AS (
  SELECT CAST(user_id AS VARCHAR) AS cid, json_extract_string(props, '$.k') AS pid, ts,
         CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS tag, event_id
  FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""


def sql_hash(seed: int, expr: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({expr} AS VARCHAR)), 1, 8))::BIGINT"


SAMPLED = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cid, tag ORDER BY {sql_hash(777, 'event_id')}, event_id) AS rn
  FROM inter WHERE tag IN (0, 1)),
sizes AS (
  SELECT cid, least(count(*) FILTER (WHERE tag = 1), count(*) FILTER (WHERE tag = 0), 7) AS m
  FROM inter WHERE tag IN (0, 1) GROUP BY cid),
sampled AS (
  SELECT r.event_id, r.cid, r.pid, r.ts, r.tag FROM ranked r JOIN sizes s ON r.cid = s.cid WHERE r.rn <= s.m)"""

HISTORY = """hist AS (
  SELECT event_id, cid, pid, tag,
         coalesce(list(pid) FILTER (WHERE tag = 1) OVER w, []) AS clicks,
         coalesce(list(pid) FILTER (WHERE tag = 2) OVER w, []) AS orders_
  FROM inter
  WINDOW w AS (PARTITION BY cid ORDER BY ts, pid, tag, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
last20 AS (
  SELECT event_id, cid, pid, tag,
         clicks[greatest(len(clicks) - 19, 1):len(clicks)] AS click,
         orders_[greatest(len(orders_) - 19, 1):len(orders_)] AS ord
  FROM hist)"""

SAMPLES = """samples AS (
  SELECT s.event_id AS sample_id, s.cid, s.pid, s.tag AS label, l.click,
         [s.pid || ',' || h FOR h IN l.click] AS click_cross,
         [s.pid || ',' || h FOR h IN l.ord] AS order_cross
  FROM sampled s JOIN last20 l ON s.event_id = l.event_id)"""

TOKENS = """tokens AS (
  SELECT 'pid' AS field, pid AS token, 1 AS w FROM samples
  UNION ALL SELECT 'pid', unnest(click), 1 FROM samples
  UNION ALL SELECT 'cross', unnest(click_cross), 1 FROM samples
  UNION ALL SELECT 'cross', unnest(order_cross), 1 FROM samples
  UNION ALL SELECT 'cid', cid, greatest(1 + len(click), len(click_cross) + len(order_cross)) FROM samples),
counts AS (SELECT field, token, CAST(sum(w) AS BIGINT) AS n FROM tokens GROUP BY field, token)"""

VOCAB = """running AS (
  SELECT field, token, n, row_number() OVER o AS id, sum(n) OVER (o ROWS UNBOUNDED PRECEDING) AS acc,
         sum(n) OVER (PARTITION BY field) AS total
  FROM counts WINDOW o AS (PARTITION BY field ORDER BY n DESC, token)),
vocab AS (
  SELECT field, token, CAST(id AS BIGINT) AS id FROM running
  WHERE acc < CASE field WHEN 'cid' THEN 8e-1 WHEN 'pid' THEN 9e-1 ELSE 5e-1 END * total)"""
