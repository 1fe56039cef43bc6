"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage
before kept; its result is written as Parquet and reread for the next one.
All but the last return the columns of ``documents``; the last adds ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.bitmap import bit_map
from rankloom.llm.decontaminate import find_leaks
from rankloom.llm.near_copies import near_copies
from rankloom.llm.pii import find_spans, redact
from rankloom.llm.q_tokens import piece_model
from rankloom.llm.quality import judge, learn, score
from rankloom.llm.registry import table
from rankloom.llm.sp_encode import encode_texts
from rankloom.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the limit of their language; empty texts go."""
    docs = docs.select(*COLUMNS)
    model, limits = learn(docs, table(spark, sf_dir, "labels"))
    return judge(score(docs, model), limits).filter("kept").select(*COLUMNS)


def told_apart() -> Column:
    """A row's own key, by id: rows that share one, or have none (they come last), differ by a digest of their columns."""
    blank = F.lit("")
    columns = [F.coalesce("text", blank), F.coalesce("lang", blank), F.coalesce("source", blank), F.coalesce(F.col("n_chars").cast("string"), blank)]
    return F.struct(
        F.col("doc_id").isNull().alias("unnamed"),
        F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("doc_id"),
        F.unhex(F.md5(F.concat_ws("\n", *columns))).alias("digest"),
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id.

    A group are texts that links of five-word similarity 0.8 or more reach;
    candidates come from SimHash through distances to pivots, with fingerprints
    wide enough for that similarity, and links are verified.
    Of equal rows one stays.  Rows that are neither equal to another nor go
    are told by a bit map and are not shuffled.
    """
    key = "__key"
    docs = docs.select(*COLUMNS).withColumn(key, told_apart())
    groups = near_copies(docs, id_col=key).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first("component_id").alias("first"))
    special = groups.select(key, "n", (F.col(key) == F.col("first")).alias("stays")).filter("n > 1 or not stays")
    special = materialize(special.select(F.col(key).alias("other"), "stays"))
    is_special = bit_map(special, "other")(F.col(key))
    plain = docs.filter(~is_special)
    # Copies are merged before they are shuffled.
    rest = docs.filter(is_special).dropDuplicates([*COLUMNS, key])
    rest = rest.join(special, F.col(key) == F.col("other"), "left").filter(F.coalesce("stays", F.lit(True)))
    return plain.select(*COLUMNS).unionByName(rest.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item or a re-parameterised variant of one.

    Rows are judged one by one: a leaking row takes no other row of its id along.
    """
    key = "__key"
    docs = docs.select(*COLUMNS).withColumn(key, told_apart())
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark"), id_col=key)
    leaks = materialize(leaks.select(F.col(key).alias("leaking")).distinct())
    return docs.join(leaks, F.col(key) == F.col("leaking"), "left_anti").select(*COLUMNS)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the new text."""
    found = find_spans(docs.select(*COLUMNS), out="__spans")
    clean = found.withColumn("text", redact(F.col("text"), F.col("__spans")))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with the end id, and their number; one row per document."""
    encoded = encode_texts(docs.select(*COLUMNS), piece_model(), keep=("lang", "source", "n_chars"))
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii", private),
    ("sentencepiece", encode),
]
# No stage but the fourth could be said in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
