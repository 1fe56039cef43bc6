"""Query op2: all conversations through the template and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.chat import format_paths, read_back, reply_paths, threads
from rankloom.llm.registry import query, table

# Given with the contract: a conversation whose texts look like the template.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"

_ESCAPES = """length({c}) - length(replace({c}, '\\', '')) + (length({c}) - length(replace({c}, '</turn>', ''))) // 7
  + length({c}) - length(replace({c}, '#', '')) - len(regexp_extract_all({c}, '#+'))"""

SQL = f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE_TEXT}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + {_ESCAPES.format(c='role')} + (length(role) - length(replace(role, ': ', ''))) // 2
    + length(text) + {_ESCAPES.format(c='text')}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


@query("op2_chat_format", SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted; digests of what is read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(PROBE_TEXT).alias("text")
    )
    messages = threads(rows.unionByName(probe))
    done = read_back(format_paths(messages, reply_paths(messages)))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("turns", lambda t: t["loss"]), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
