"""Queries over feature encoding, attention pooling, interactions and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.functions import arrays
from rankloom.functions.hashing import hash32
from rankloom.functions.numeric import sigmoid
from rankloom.functions.text import field_token
from rankloom.ml.learners import ctcvr
from rankloom.operators.bags import embedding_pool, linear_score, multihot
from rankloom.operators.encode import encode_token, encode_with_rules, onehot_positions, tabled_id
from rankloom.operators.features import (
    FeatureSpec,
    deep_vectors,
    dense_values,
    encode_features,
    longest_lists,
    numeric_embedding,
    plan_features,
    sparse_entries,
)
from rankloom.operators.joins import dimension_join
from rankloom.operators.metrics import auc, mean_focal, mean_logloss, precision_half, residuals
from rankloom.operators.vocab import coverage_vocabulary, dense_ids, min_count_vocabulary, token_frequency
from rankloom.plans.catalog import query, table, text
from rankloom.plans.q_vocab import BAG_SQL, bags
from rankloom.plans.tabular import categorical_counts
from rankloom.session import materialize

BRAND_SQL = "bv AS (SELECT p_brand AS token, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS id FROM part GROUP BY 1)"


def brand_vocab(spark, sf_dir):
    return materialize(dense_ids(token_frequency(table(spark, sf_dir, "part"), "p_brand")))


# Positions, combinations, variable lengths, default tails, shared and own vectors.
SPECS = (
    FeatureSpec("brand", "category", "p_brand", "vocabulary_list", ("onehot", "embedding"), groups=("wide",)),
    FeatureSpec("words", "category", "words", "vocabulary_list", ("onehot", "embedding"), num=3, groups=("wide", "seq")),
    FeatureSpec("size", "category", "p_size", "tabled", ("onehot",), size=64, groups=("wide",)),
    FeatureSpec("digits", "category", "digits", "tabled", ("onehot", "embedding"), num=5, combiner="mean", size=10),
    FeatureSpec("lead", "category", "lead", "vocabulary_list", ("onehot",), num=-1, groups=("seq",)),
    FeatureSpec("price", "numeric", "p_retailprice", None, ("value", "embedding"), groups=("wide",)),
    FeatureSpec("pair", "numeric", "pair", None, ("value", "embedding"), num=2, same=False),
    FeatureSpec("spread", "numeric", "spread", None, ("value", "embedding"), num=-3, combiner="mean"),
    FeatureSpec("unused", "numeric", "p_partkey", None, ("value",), ignore=True),
)
DEEP_DIM = 4

# The same from the contract: every position of a one-hot category is a block as wide as its table (id 0 is the default),
# padding is the id behind the table and takes no index, a combined category is one block of shares; dense values and deep
# positions follow the order of the features.
SPEC_SQL = """p AS (SELECT *, string_split(p_name, ' ') AS words, string_split(p_name, ' ')[1:p_size % 3] AS lead,
      [CAST(x AS BIGINT) FOR x IN string_split_regex(CAST(p_partkey AS VARCHAR), '') IF x <> ''] AS digits FROM part),
  w AS (SELECT p_partkey, i, words[i] AS token FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM p)),
  o AS (SELECT p_partkey, i, lead[i] AS token FROM (SELECT *, unnest(range(1, len(lead) + 1)) AS i FROM p)),
  bv AS (SELECT p_brand AS token, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS id FROM part GROUP BY 1 HAVING count(*) >= 2),
  wv AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS id FROM w GROUP BY 1 HAVING count(*) >= 2),
  ov AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS id FROM o GROUP BY 1 HAVING count(*) >= 2),
  d AS (SELECT (SELECT count(*) FROM bv) + 1 AS nb, (SELECT count(*) FROM wv) + 1 AS nw, (SELECT count(*) FROM ov) + 1 AS no,
      (SELECT greatest(max(len(lead)), 1) FROM p) AS most),
  ids AS (SELECT p_partkey, 'brand' AS f, 0 AS slot, coalesce(bv.id, 0) AS id FROM p LEFT JOIN bv ON bv.token = p_brand
    UNION ALL SELECT p_partkey, 'words', i - 1, coalesce(wv.id, 0) FROM w LEFT JOIN wv ON wv.token = w.token
    UNION ALL SELECT p_partkey, 'size', 0, p_size FROM p
    UNION ALL SELECT p_partkey, 'digits', i - 1, digits[i] FROM (SELECT *, unnest(range(1, len(digits) + 1)) AS i FROM p)
    UNION ALL SELECT p_partkey, 'lead', i - 1, coalesce(ov.id, 0) FROM o LEFT JOIN ov ON ov.token = o.token)"""


def _spec_rows(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    words, digits = F.split("p_name", " "), F.filter(F.split(F.col("p_partkey").cast("string"), ""), lambda x: x != "")
    part = part.select(
        "p_partkey",
        "p_brand",
        "p_size",
        "p_retailprice",
        words.alias("words"),
        F.slice(words, F.lit(1), F.col("p_size") % 3).alias("lead"),
        F.transform(digits, lambda x: x.cast("bigint")).alias("digits"),
        F.array(F.col("p_size").cast("double"), F.col("p_retailprice") / 100).alias("pair"),
        F.slice(F.array(F.lit(1.0), F.lit(5.0), F.lit(9.0)), F.lit(1), F.col("p_partkey").cast("int") % 4).alias("spread"),
    )
    token = lambda field, col: part.select(F.lit(field).alias("field"), col.alias("token"))
    tokens = token("words", F.explode("words")).unionByName(token("brand", F.col("p_brand"))).unionByName(token("lead", F.explode("lead")))
    vocab = materialize(min_count_vocabulary(token_frequency(tokens, by=["field"]), 2, by="field"))
    sizes = {r["field"]: r["n"] + 1 for r in vocab.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per field
    plan = plan_features(SPECS, sizes, longest_lists(part, SPECS))
    return encode_features(part, plan, "p_partkey", vocab), plan


@query(
    "feature_spec",
    f"""WITH {SPEC_SQL}, l AS (SELECT p_partkey, f, list(id ORDER BY slot) AS ids FROM ids GROUP BY p_partkey, f),
        one AS (SELECT p.p_partkey, max(CASE WHEN f = 'brand' THEN ids END) AS brand, max(CASE WHEN f = 'words' THEN ids END) AS words,
            max(CASE WHEN f = 'size' THEN ids END) AS size, max(CASE WHEN f = 'digits' THEN ids END) AS digits,
            coalesce(max(CASE WHEN f = 'lead' THEN ids END), []) AS lead, any_value(p_retailprice) AS price, any_value(p_size) AS first
          FROM p JOIN l USING (p_partkey) GROUP BY p.p_partkey)
        SELECT p_partkey, array_to_string(brand, ',') AS brand, array_to_string(words || [nw FOR x IN range(0, 3 - len(words))], ',') AS words,
          array_to_string(size, ',') AS size, array_to_string(digits, ',') AS digits,
          array_to_string(lead || [no FOR x IN range(0, most - len(lead))], ',') AS lead,
          round(price, 4) AS price, round(first + price / 100, 4) AS pair, CAST(p_partkey % 4 AS INTEGER) AS spread
        FROM one, d""",
)
def feature_spec(spark, sf_dir):
    rows, _ = _spec_rows(spark, sf_dir)
    ids = [text(F.col(name)).alias(name) for name in ("brand", "words", "size", "digits", "lead")]
    return rows.select(
        "p_partkey",
        *ids,
        F.round(F.get("price", F.lit(0)), 4).alias("price"),
        F.round(arrays.total(F.col("pair")), 4).alias("pair"),
        F.size("spread").alias("spread"),
    )


@query(
    "wide_assemble",
    f"""WITH {SPEC_SQL}, places AS (
          SELECT p_partkey, id AS index, 1.0::DOUBLE AS value FROM ids WHERE f = 'brand'
          UNION ALL SELECT p_partkey, nb + slot * nw + id, 1.0 FROM ids, d WHERE f = 'words'
          UNION ALL SELECT p_partkey, nb + 3 * nw + id, 1.0 FROM ids, d WHERE f = 'size'
          UNION ALL SELECT p_partkey, nb + 3 * nw + 64 + id, count(*) / CAST(sum(count(*)) OVER (PARTITION BY p_partkey) AS DOUBLE)
            FROM ids, d WHERE f = 'digits' GROUP BY p_partkey, nb + 3 * nw + 64 + id
          UNION ALL SELECT p_partkey, nb + 3 * nw + 74 + slot * no + id, 1.0 FROM ids, d WHERE f = 'lead'),
        sparse AS (SELECT p_partkey, string_agg(CAST(index AS VARCHAR), ',' ORDER BY index) AS indexes, round(sum(value * (index + 1)), 4) AS total
          FROM places GROUP BY p_partkey),
        terms AS (
          SELECT p_partkey, 0 AS position, id AS v, 1.0::DOUBLE AS weight FROM ids WHERE f = 'brand'
          UNION ALL SELECT p_partkey, 1 + slot, 100 + id, 1.0 FROM ids WHERE f = 'words'
          UNION ALL SELECT p_partkey, 4, 200 + id, 1.0 / count(*) OVER (PARTITION BY p_partkey) FROM ids WHERE f = 'digits'
          UNION ALL SELECT p_partkey, 5, 300, p_retailprice FROM p
          UNION ALL SELECT p_partkey, 6, 310, p_size FROM p
          UNION ALL SELECT p_partkey, 7, 311, p_retailprice / 100 FROM p
          UNION ALL SELECT p_partkey, 8, 320, ([0, 1, 3, 5])[p_partkey % 4 + 1] FROM p),
        deep AS (SELECT p_partkey, round(sum(weight * (position + 1) * embedding[1]), 3) AS deep0, round(sum(weight * (position + 1) * embedding[4]), 3) AS deep3
          FROM terms JOIN embeddings ON v = vec_id GROUP BY p_partkey)
        SELECT p.p_partkey, indexes, total, CAST(nb + 3 * nw + 74 + most * no AS BIGINT) AS width, round(p_retailprice, 4) AS price,
          round(p_retailprice + p_size + p_retailprice / 100 + ([0, 1, 3, 5])[p.p_partkey % 4 + 1], 4) AS dense, deep0, deep3, 9 AS vectors
        FROM p, d, sparse, deep WHERE p.p_partkey = sparse.p_partkey AND p.p_partkey = deep.p_partkey""",
)
def wide_assemble(spark, sf_dir):
    """Sparse, dense and deep vectors of all features, and the width of the plan."""
    rows, plan = _spec_rows(spark, sf_dir)
    rows = rows.select("*", sparse_entries(plan), dense_values(plan))
    at = F.create_map(*[F.lit(x) for pair in (("brand", 0), ("words", 100), ("digits", 200), ("price", 300), ("pair", 310), ("spread", 320)) for x in pair])
    emb = table(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, DEEP_DIM).alias("vec"))
    ends = {"brand": 100, "words": 200, "digits": 300, "price": 301, "pair": 312, "spread": 321}
    owner = F.array(*[F.when((F.col("vec_id") >= at[F.lit(name)]) & (F.col("vec_id") < end), F.lit(name)) for name, end in ends.items()])
    tables = emb.select(F.explode(F.array_compact(owner)).alias("feature"), "vec_id", "vec")
    tables = tables.select("feature", (F.col("vec_id") - at[F.col("feature")]).alias("id"), "vec")
    done = deep_vectors(rows, plan, "p_partkey", tables, DEEP_DIM, keep=["sparse", "dense"])
    weighed = lambda d: F.transform("deep", lambda v, i: (i + 1) * F.get(v, F.lit(d)))
    return done.select(
        "p_partkey",
        text(F.transform("sparse", lambda e: e["index"])).alias("indexes"),
        F.round(arrays.total(F.transform("sparse", lambda e: e["value"] * (e["index"] + 1))), 4).alias("total"),
        F.lit(plan.sparse_width).cast("bigint").alias("width"),
        F.round(F.get("dense", F.lit(0)), 4).alias("price"),
        F.round(arrays.total(F.col("dense")), 4).alias("dense"),
        F.round(arrays.total(weighed(0)), 3).alias("deep0"),
        F.round(arrays.total(weighed(3)), 3).alias("deep3"),
        F.size("deep").alias("vectors"),
    )


@query(
    "enc_vocab_list",
    """WITH n AS (SELECT p_brand AS token, count(*) AS n FROM part GROUP BY 1),
       bv AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id, sum(n) OVER (ORDER BY n DESC, token) AS acc, sum(n) OVER () AS total FROM n)
       SELECT p_partkey, CAST(coalesce(id, 0) AS BIGINT) AS brand FROM part LEFT JOIN bv ON p_brand = token AND acc < 8e-1 * total""",
)
def enc_vocab_list(spark, sf_dir):
    """Brands outside the most frequent four fifths of the parts get the default id."""
    counts = token_frequency(table(spark, sf_dir, "part"), "p_brand")
    vocab = materialize(coverage_vocabulary(counts, 0.8).select("token", "id"))
    return encode_token(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand")), vocab, "brand", "brand")


@query("enc_tabled", "SELECT p_partkey, CAST(p_size AS BIGINT) AS size FROM part")
def enc_tabled(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", tabled_id(F.col("p_size"), 64).alias("size"))


@query(
    "enc_onehot",
    f"WITH {BAG_SQL} SELECT event_id, CAST(i AS INTEGER) AS position, id FROM bag WHERE id < 30",
)
def enc_onehot(spark, sf_dir):
    return onehot_positions(bags(spark, sf_dir), ["event_id"], "ids", 30)


@query(
    "enc_multihot",
    f"""WITH {BAG_SQL}, m AS (SELECT event_id, id, count(*) / CAST(max(event_id % 4) AS DOUBLE) AS v FROM bag GROUP BY event_id, id)
        SELECT event_id, round(sum(v), 6) AS total, count(*) AS n, max(id) AS top FROM m GROUP BY event_id""",
)
def enc_multihot(spark, sf_dir):
    rows = multihot(bags(spark, sf_dir), "event_id", "ids", 40, "mean")
    return rows.groupBy("event_id").agg(
        F.round(F.sum("value"), 6).alias("total"), F.count(F.lit(1)).alias("n"), F.max("id").alias("top")
    )


@query(
    "enc_embedding",
    """SELECT event_id, CAST(embedding[1] AS DOUBLE) AS first, round(list_sum(embedding[1:63]::DOUBLE[]), 5) AS body,
              CAST(embedding[64] AS DOUBLE) AS first_order
       FROM events LEFT JOIN embeddings ON vec_id = CAST(json_extract_string(props, '$.k') AS BIGINT)""",
)
def enc_embedding(spark, sf_dir):
    """63 components of the vector and the last one as first-order weight."""
    rows = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("id"))
    emb = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    found = dimension_join(rows, emb, [("id", "vec_id")])
    return found.select(
        "event_id",
        F.get("vec", F.lit(0)).cast("double").alias("first"),
        F.round(arrays.total(F.slice("vec", 1, 63)), 5).alias("body"),
        F.get("vec", F.lit(63)).cast("double").alias("first_order"),
    )


@query(
    "enc_numeric_value",
    "SELECT l_orderkey, l_linenumber, l_quantity AS quantity, round(l_quantity + l_discount, 6) AS total FROM lineitem",
)
def enc_numeric_value(spark, sf_dir):
    values = F.array("l_quantity", "l_discount")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.get(values, F.lit(0)).alias("quantity"),
        F.round(arrays.reduce_values(values, "sum"), 6).alias("total"),
    )


@query(
    "enc_numeric_embedding",
    """SELECT l_orderkey, l_linenumber, round(l_quantity * 5e-1, 6) AS shared0, round(l_discount * -25e-2, 6) AS shared1,
              round(l_quantity * 1e-1, 6) AS own0, round(l_discount * 4e-1, 6) AS own1 FROM lineitem""",
)
def enc_numeric_embedding(spark, sf_dir):
    """One shared vector for both values, and one vector per value."""
    values = F.array("l_quantity", "l_discount")
    shared = numeric_embedding(values, [[0.5, -0.25]])
    own = numeric_embedding(values, [[0.1, 0.2], [0.3, 0.4]])
    at = lambda arr, i, j: F.round(F.get(F.get(arr, F.lit(i)), F.lit(j)), 6)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        at(shared, 0, 0).alias("shared0"),
        at(shared, 1, 1).alias("shared1"),
        at(own, 0, 0).alias("own0"),
        at(own, 1, 1).alias("own1"),
    )


@query(
    "enc_fill_tail_default",
    f"""WITH {BRAND_SQL},
        t AS (SELECT p_partkey, i, CASE WHEN i = 1 THEN CASE WHEN p_size % 5 = 0 THEN 'Brand#1' ELSE p_brand END ELSE 'no such brand' END AS token
              FROM (SELECT *, unnest(range(1, 3)) AS i FROM part) WHERE i <= p_size % 3)
        SELECT p_partkey, array_to_string(coalesce(list(coalesce(id, 7) ORDER BY i) FILTER (WHERE i IS NOT NULL), []) ||
               [99 FOR x IN range(0, 3 - CAST(count(i) AS INTEGER))], ',') AS ids
        FROM part LEFT JOIN t USING (p_partkey) LEFT JOIN bv ON t.token = bv.token GROUP BY p_partkey""",
)
def enc_fill_tail_default(spark, sf_dir):
    """Blank token -> fill token, unknown -> id 7, short list -> padded with 99."""
    first = F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.col("p_brand"))
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.slice(F.array(first, F.lit("no such brand")), F.lit(1), F.col("p_size") % 3).alias("ids")
    )
    found = encode_with_rules(rows, brand_vocab(spark, sf_dir), "p_partkey", "ids", num=3, fill="Brand#1", default=7, tail=99)
    return found.select("p_partkey", text(F.col("ids")).alias("ids"))


@query(
    "sequence_mask",
    """SELECT event_id, array_to_string([CASE WHEN i < event_id % 6 AND i <> 0 THEN 1 ELSE 0 END FOR i IN range(0, 5)], ',') AS mask FROM events""",
)
def sequence_mask(spark, sf_dir):
    ids = F.slice(F.sequence(F.lit(0), F.lit(6)), F.lit(1), (F.col("event_id") % 6).cast("int"))
    padded = arrays.pad_to(ids, 5, F.lit(0), surplus="cut")
    return table(spark, sf_dir, "events").select(
        "event_id", text(F.transform(padded, lambda x: (x != 0).cast("int"))).alias("mask")
    )


@query(
    "masked_softmax_pool",
    """WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
       b AS (SELECT event_id, i, (k * (i + 1) + event_id) % 500 AS id, ((event_id + i * 3) % 7) / 2e0 AS score, CASE WHEN (k + i) % 3 = 0 THEN 0 ELSE 1 END AS mask
             FROM (SELECT *, unnest(range(0, event_id % 4)) AS i FROM e)),
       x AS (SELECT event_id, id, CASE WHEN mask = 1 THEN exp(score - max(CASE WHEN mask = 1 THEN score END) OVER (PARTITION BY event_id)) ELSE 0 END AS p FROM b),
       w AS (SELECT event_id, id, CASE WHEN sum(p) OVER (PARTITION BY event_id) > 0 THEN p / sum(p) OVER (PARTITION BY event_id) ELSE 0 END AS w FROM x),
       r AS (SELECT event_id, sum(w) AS mass, sum(w * embedding[1]) AS d0, sum(w * embedding[64]) AS d63 FROM w JOIN embeddings ON id = vec_id GROUP BY event_id)
       SELECT e.event_id, round(coalesce(mass, 0), 6) AS mass, round(coalesce(d0, 0), 5) AS d0, round(coalesce(d63, 0), 5) AS d63
       FROM e LEFT JOIN r ON e.event_id = r.event_id""",
)
def masked_softmax_pool(spark, sf_dir):
    """Attention weights over unmasked positions, then the weighted vector sum."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    steps = F.slice(F.sequence(F.lit(0), F.lit(3)), F.lit(1), (F.col("event_id") % 4).cast("int"))
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.transform(steps, lambda i: (k * (i + 1) + F.col("event_id")) % 500).alias("ids"),
        F.transform(steps, lambda i: ((F.col("event_id") + i * 3) % 7) / 2.0).alias("scores"),
        F.transform(steps, lambda i: ((k + i) % 3 != 0).cast("int")).alias("mask"),
    )
    weighted = rows.withColumn("w", arrays.masked_softmax(F.col("scores"), F.col("mask")))
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    mass = weighted.select("event_id", "ids", "w", arrays.total(F.col("w")).alias("mass"))
    pooled = embedding_pool(mass, "event_id", "ids", emb, 64, {"v": "sum"}, weights="w", keep=["mass"])
    return pooled.select(
        "event_id",
        F.round("mass", 6).alias("mass"),
        F.round(F.get("v", F.lit(0)), 5).alias("d0"),
        F.round(F.get("v", F.lit(63)), 5).alias("d63"),
    )


@query(
    "pair_interaction",
    """SELECT a.vec_id, CAST(len(a.embedding) * 4 AS INTEGER) AS width, CAST(a.embedding[1] AS DOUBLE) AS a0, CAST(b.embedding[1] AS DOUBLE) AS b0,
              round(a.embedding[1]::DOUBLE - b.embedding[1]::DOUBLE, 7) AS diff0, round(a.embedding[64]::DOUBLE * b.embedding[64]::DOUBLE, 7) AS prod63
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def pair_interaction(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    following = emb.select((F.col("vec_id") - 1).alias("prev"), F.col("a").alias("b"))
    pairs = dimension_join(emb, following, [("vec_id", "prev")], how="inner")
    vec = pairs.select("vec_id", arrays.interaction(F.col("a"), F.col("b")).alias("v"))
    at = lambda i: F.get("v", F.lit(i))
    return vec.select(
        "vec_id",
        F.size("v").alias("width"),
        at(0).alias("a0"),
        at(64).alias("b0"),
        F.round(at(128), 7).alias("diff0"),
        F.round(at(255), 7).alias("prod63"),
    )


@query(
    "fm_second_order",
    """WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id FROM events),
       f AS (SELECT event_id, k AS id FROM e UNION ALL SELECT event_id, user_id % 500 FROM e UNION ALL SELECT event_id, event_id % 500 FROM e),
       d AS (SELECT event_id, unnest(range(1, 65)) AS d, embedding FROM f JOIN embeddings ON id = vec_id),
       s AS (SELECT event_id, d, 5e-1 * (sum(embedding[d]::DOUBLE) * sum(embedding[d]::DOUBLE) - sum(embedding[d]::DOUBLE * embedding[d]::DOUBLE)) AS v FROM d GROUP BY event_id, d)
       SELECT event_id, round(max(CASE WHEN d = 1 THEN v END), 6) AS d0, round(sum(v), 5) AS total FROM s GROUP BY event_id""",
)
def fm_query(spark, sf_dir):
    """Three field vectors per event; the second-order term per dimension."""
    ids = F.array(F.get_json_object("props", "$.k").cast("bigint"), F.col("user_id") % 500, F.col("event_id") % 500)
    rows = table(spark, sf_dir, "events").select("event_id", ids.alias("ids"))
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    scored = embedding_pool(rows, "event_id", "ids", emb, 64, {"fm": "fm"})
    return scored.select(
        "event_id", F.round(F.get("fm", F.lit(0)), 6).alias("d0"), F.round(arrays.total(F.col("fm")), 5).alias("total")
    )


@query(
    "linear_score",
    """WITH e AS (SELECT event_id, 'type_' || event_type AS t1, 'user_' || user_id AS t2, 'k_' || json_extract_string(props, '$.k') AS t3 FROM events),
       f AS (SELECT event_id, unnest([t1, t2, t3]) AS token FROM e),
       w AS (SELECT token, (('0x' || substr(md5('5:' || token), 1, 8))::BIGINT % 2001 - 1000) / 1e3 AS w FROM (SELECT DISTINCT token FROM f) WHERE token <> 'type_error'),
       s AS (SELECT event_id, sum(coalesce(w, 0)) + 25e-2 AS logit FROM f LEFT JOIN w USING (token) GROUP BY event_id)
       SELECT event_id, round(logit, 6) AS logit, round(1 / (1 + exp(-logit)), 6) AS score FROM s""",
)
def linear_score_query(spark, sf_dir):
    """Wide score from ``field_token`` weights; one token has no weight."""
    k = F.get_json_object("props", "$.k")
    tokens = F.array(
        field_token("type", F.col("event_type")), field_token("user", F.col("user_id").cast("string")), field_token("k", k)
    )
    features = table(spark, sf_dir, "events").select("event_id", F.explode(tokens).alias("token"))
    known = features.select("token").distinct().filter(F.col("token") != "type_error")
    weights = materialize(known.withColumn("w", (hash32(5, "token") % 2001 - 1000) / 1000.0))
    scored = linear_score(features, "event_id", "token", weights, 0.25)
    return scored.select("event_id", F.round("logit", 6).alias("logit"), F.round("score", 6).alias("score"))


@query(
    "multitask_ctcvr",
    """SELECT l_orderkey, l_linenumber, round(l_discount * 10 * l_tax * 10, 8) AS pctcvr,
              CAST(l_returnflag <> 'N' AS INTEGER) AS click, CAST(l_returnflag = 'R' AS INTEGER) AS conversion FROM lineitem""",
)
def multitask_ctcvr(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_discount") * 10).alias("pctr"),
        (F.col("l_tax") * 10).alias("pcvr"),
        (F.col("l_returnflag") != "N").cast("int").alias("click"),
        (F.col("l_returnflag") == "R").cast("int").alias("conversion"),
    )
    return ctcvr(rows).select(
        "l_orderkey", "l_linenumber", F.round("pctcvr", 8).alias("pctcvr"), "click", "conversion"
    )


@query(
    "pairwise_triplet",
    """WITH t AS (SELECT event_id, [event_id, event_id + 1, user_id, user_id + 1, event_id % 10, event_id % 10 + 1] AS v FROM events)
       SELECT event_id, CAST(1 AS INTEGER) AS label, array_to_string(v[1:2] || v[3:4], ',') AS features FROM t
       UNION ALL SELECT event_id, 0, array_to_string(v[1:2] || v[5:6], ',') FROM t""",
)
def pairwise_triplet(spark, sf_dir):
    """Thirds (trigger, positive, negative) to one row per pair."""
    parts = F.array("event_id", F.col("event_id") + 1, "user_id", F.col("user_id") + 1, F.col("event_id") % 10, F.col("event_id") % 10 + 1)
    trigger, positive, negative = arrays.thirds(F.col("v"))
    both = F.array(
        F.struct(F.lit(1).alias("label"), F.concat(trigger, positive).alias("f")),
        F.struct(F.lit(0).alias("label"), F.concat(trigger, negative).alias("f")),
    )
    rows = table(spark, sf_dir, "events").select("event_id", parts.alias("v"))
    return rows.select("event_id", F.explode(both).alias("p")).select(
        "event_id", "p.label", text(F.col("p.f")).alias("features")
    )


# --- metrics ---------------------------------------------------------------------------

SCORED_SQL = """s AS (SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS label,
    CAST(l_returnflag <> 'N' AS INTEGER) AS click, l_discount * 5e0 + l_tax * 2e0 AS pred FROM lineitem)"""


def scored(spark, sf_dir):
    """Labels and probabilities with many ties."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_returnflag") != "N").cast("int").alias("click"),
        (F.col("l_discount") * 5.0 + F.col("l_tax") * 2.0).alias("pred"),
    )


def _auc_sql(rows: str, by: str) -> str:
    part = f"PARTITION BY {by}" if by else ""
    with_by = f"{by}, " if by else ""
    comma = f"PARTITION BY {by}, pred" if by else "PARTITION BY pred"
    group = f"GROUP BY {by}" if by else ""
    return f"""WITH {rows}, r AS (SELECT {with_by}label, rank() OVER ({part} ORDER BY pred) + (count(*) OVER ({comma}) - 1) / 2e0 AS r FROM s)
      SELECT {with_by}round(CASE WHEN count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0) = 0 THEN NULL ELSE
        (sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2e0)
        / (count(*) FILTER (WHERE label = 1) * CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE)) END, 9) AS auc FROM r {group}"""


@query("eval_auc", _auc_sql(SCORED_SQL, ""))
def eval_auc(spark, sf_dir):
    return auc(scored(spark, sf_dir)).select(F.round("auc", 9).alias("auc"))


TASK_SQL = """s AS (SELECT 'click' AS task, CAST(l_returnflag <> 'N' AS INTEGER) AS label, l_discount * 5e0 + l_tax * 2e0 AS pred FROM lineitem
  UNION ALL SELECT 'conversion', CAST(l_returnflag = 'R' AS INTEGER), l_discount * 5e0 + l_tax * 2e0 FROM lineitem
  UNION ALL SELECT 'none', 0, l_discount * 5e0 + l_tax * 2e0 FROM lineitem)"""


def tasks(spark, sf_dir):
    """Three tasks; the last one has a single class."""
    rows = scored(spark, sf_dir)
    entries = F.array(
        F.struct(F.lit("click").alias("task"), F.col("click").alias("label"), "pred"),
        F.struct(F.lit("conversion").alias("task"), F.col("label"), "pred"),
        F.struct(F.lit("none").alias("task"), F.lit(0).alias("label"), "pred"),
    )
    return rows.select(F.explode(entries).alias("t")).select("t.task", "t.label", "t.pred")


@query("eval_auc_multitask", _auc_sql(TASK_SQL, "task"))
def eval_auc_multitask(spark, sf_dir):
    return auc(tasks(spark, sf_dir), by=["task"]).select("task", F.round("auc", 9).alias("auc"))


@query(
    "eval_precision_half",
    f"WITH {TASK_SQL} SELECT task, round(avg(CASE WHEN abs(pred - label) < 5e-1 THEN 1e0 ELSE 0e0 END), 9) AS precision FROM s GROUP BY task",
)
def eval_precision_half(spark, sf_dir):
    return precision_half(tasks(spark, sf_dir), by=["task"]).select("task", F.round("precision", 9).alias("precision"))


@query(
    "eval_logloss",
    f"WITH {TASK_SQL} SELECT task, round(avg(-label * ln(pred + 1e-7) - (1 - label) * ln(1 - pred + 1e-7)), 7) AS logloss FROM s GROUP BY task",
)
def eval_logloss(spark, sf_dir):
    return mean_logloss(tasks(spark, sf_dir), by=["task"]).select("task", F.round("logloss", 7).alias("logloss"))


@query(
    "eval_focal",
    f"""WITH {SCORED_SQL}, q AS (SELECT click AS w, label AS y, 1 / (1 + exp(-pred)) AS p FROM s)
        SELECT round(avg((-y * 97e-2 * ((1 - p) * 2e0) * ln(p) - (1 - y) * 3e-2 * p * p * ln(1 - p)) * w) * count(*) / (sum(w) + 1), 7) AS focal FROM q""",
)
def eval_focal(spark, sf_dir):
    """Conversion loss weighted by the click label."""
    rows = scored(spark, sf_dir).withColumn("p", sigmoid(F.col("pred")))
    return mean_focal(rows, score="p", weight="click", alpha=0.03).select(F.round("focal", 7).alias("focal"))


@query(
    "report_residual",
    f"WITH {SCORED_SQL} SELECT l_orderkey, l_linenumber, label, pred AS prediction, label - pred AS residual FROM s",
)
def report_residual(spark, sf_dir):
    return residuals(scored(spark, sf_dir), keys=["l_orderkey", "l_linenumber"])


@query(
    "categorical_counts",
    """SELECT 'status' AS field, o_orderstatus AS token, count(*) AS n FROM orders GROUP BY 2
       UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2""",
)
def categorical_counts_query(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    )
    return categorical_counts(rows, ["status", "priority"])
