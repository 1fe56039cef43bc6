"""Queries over aggregations, windows and vocabularies, and the sample job."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.functions import arrays
from rankloom.operators.bags import embedding_pool, merge_shards, multihot
from rankloom.operators.history import cross_tokens, last_n_history
from rankloom.operators.ordering import order_statistics, ordered_prefix, top_k_per_key
from rankloom.operators.sampling import balanced_sample, label_counts
from rankloom.operators.vocab import (
    coverage_vocabulary,
    dense_ids,
    flatten_tokens,
    frequency_order,
    min_count_vocabulary,
    sample_token_counts,
    token_frequency,
    with_default,
)
from rankloom.plans.catalog import (
    HISTORY,
    INTER,
    SAMPLED,
    SAMPLES,
    TOKENS,
    VOCAB,
    interactions,
    query,
    table,
    text,
)
from rankloom.plans.tabular import clipped_minmax, tabular_features
from rankloom.plans.train_samples import SampleSettings, label_samples, learn_vocabularies, train_samples
from rankloom.session import materialize

# --- aggregations ------------------------------------------------------------------


@query("agg_token_frequency", "SELECT CAST(l_partkey AS VARCHAR) AS token, count(*) AS n FROM lineitem GROUP BY 1")
def agg_token_frequency(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("token"))
    return token_frequency(rows)


SAMPLE_CTE = f"{INTER}, {SAMPLED}, {HISTORY}, {SAMPLES}"


@query(
    "agg_tokens_of_sample",
    f"""WITH {SAMPLE_CTE}, f AS (SELECT cid, [pid] || click AS items, click_cross || order_cross AS pairs FROM samples),
        g AS (SELECT cid, items, pairs, unnest(range(1, greatest(len(items), len(pairs)) + 1)) AS i FROM f)
        SELECT cid, coalesce(items[i], '') AS pid, coalesce(pairs[i], '') AS cross_pair FROM g""",
)
def agg_tokens_of_sample(spark, sf_dir):
    return flatten_tokens(label_samples(interactions(spark, sf_dir), "event_id"))


@query(
    "agg_global_count",
    """SELECT count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'R') AS positives,
              count(*) FILTER (WHERE l_returnflag <> 'R') AS negatives FROM lineitem""",
)
def agg_global_count(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("label"))
    return label_counts(rows)


@query(
    "agg_minmax_multi",
    """SELECT min(l_quantity) AS qmin, max(l_quantity) AS qmax, min(l_extendedprice) AS pmin, max(l_extendedprice) AS pmax,
              min(l_tax) AS tmin, max(l_tax) AS tmax FROM lineitem""",
)
def agg_minmax_multi(spark, sf_dir):
    cols = {"q": "l_quantity", "p": "l_extendedprice", "t": "l_tax"}
    return table(spark, sf_dir, "lineitem").agg(
        *[f(c).alias(f"{k}{n}") for k, c in cols.items() for n, f in (("min", F.min), ("max", F.max))]
    )


@query(
    "agg_clipped_minmax",
    """SELECT min(least(l_quantity, 20)) AS q_min, max(least(l_quantity, 20)) AS q_max,
              min(CASE WHEN l_linenumber > 1 THEN least(l_extendedprice, 60000) END) AS p_min,
              max(CASE WHEN l_linenumber > 1 THEN least(l_extendedprice, 60000) END) AS p_max FROM lineitem""",
)
def agg_clipped_minmax(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("q"), F.when(F.col("l_linenumber") > 1, F.col("l_extendedprice")).alias("p")
    )
    return clipped_minmax(rows, {"q": 20.0, "p": 60000.0})


@query(
    "agg_order_statistic",
    """WITH r AS (SELECT 'price' AS field, l_extendedprice AS v FROM lineitem UNION ALL
                  SELECT 'quantity', l_quantity FROM lineitem WHERE l_linenumber > 2 UNION ALL
                  SELECT 'discount', l_discount FROM lineitem),
       o AS (SELECT field, v, row_number() OVER (PARTITION BY field ORDER BY v) - 1 AS rn, count(*) OVER (PARTITION BY field) AS n FROM r)
       SELECT field, max(CASE WHEN rn = n // 3000 THEN v END) AS lo, max(CASE WHEN rn = least(n - n // 3000, n - 1) THEN v END) AS hi
       FROM o GROUP BY field""",
)
def agg_order_statistic(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linenumber") > 2, F.col("l_quantity")).alias("quantity"),
        F.col("l_discount").alias("discount"),
    )
    return order_statistics(rows, ["price", "quantity", "discount"], 3000)


BAG_SQL = """e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
  bag AS (SELECT event_id, i, (k * (i + 1) + event_id) % 40 AS id FROM (SELECT *, unnest(range(0, event_id % 4)) AS i FROM e))"""


def bags(spark, sf_dir, modulus: int = 40):
    """Per event a bag of 0 to 3 ids; ids repeat within a bag."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    steps = F.slice(F.sequence(F.lit(0), F.lit(3)), F.lit(1), (F.col("event_id") % 4).cast("int"))
    ids = F.transform(steps, lambda i: (k * (i + 1) + F.col("event_id")) % modulus)
    return table(spark, sf_dir, "events").select("event_id", ids.alias("ids"))


@query(
    "agg_collect_ordered",
    f"""WITH {BAG_SQL} SELECT event_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY i DESC) AS ids FROM bag GROUP BY event_id""",
)
def agg_collect_ordered(spark, sf_dir):
    """Exploded lists come back in index order; a list is bounded by the row it came from."""
    rows = bags(spark, sf_dir).select("event_id", F.posexplode("ids").alias("pos", "id"))
    listed = rows.groupBy("event_id").agg(
        F.collect_list(F.struct((-F.col("pos")).alias("pos"), F.col("id").alias("item"))).alias("l")
    )
    return listed.select("event_id", text(arrays.sort_by_index(F.col("l"))).alias("ids"))


@query(
    "agg_topk_list",
    """WITH r AS (SELECT l_suppkey AS pid, l_partkey AS item, max(l_quantity * l_discount) AS score FROM lineitem GROUP BY 1, 2),
       t AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY score DESC, item) AS rn FROM r)
       SELECT pid, string_agg(CAST(item AS VARCHAR), ',' ORDER BY rn) AS items FROM t WHERE rn <= 200 GROUP BY pid""",
)
def agg_topk_list(spark, sf_dir):
    pairs = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("pid"), F.col("l_partkey").alias("item"))
        .agg(F.max(F.col("l_quantity") * F.col("l_discount")).alias("score"))
    )
    best = top_k_per_key(pairs, ["pid"], [F.desc("score"), F.asc("item")], 200)
    listed = best.groupBy("pid").agg(F.collect_list(F.struct(F.col("rank").alias("pos"), "item")).alias("l"))
    return listed.select("pid", text(arrays.sort_by_index(F.col("l"))).alias("items"))


@query(
    "agg_combine_by_key",
    """SELECT l_suppkey AS key, CAST(sum(l_linenumber) AS BIGINT) AS total, count(*) AS n,
              max(l_quantity) AS best, min(l_quantity) AS worst FROM lineitem GROUP BY 1""",
)
def agg_combine_by_key(spark, sf_dir):
    """create / merge value / merge combiners as built-in partial and final aggregates."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy(F.col("l_suppkey").alias("key")).agg(
        F.sum("l_linenumber").alias("total"),
        F.count(F.lit(1)).alias("n"),
        F.max("l_quantity").alias("best"),
        F.min("l_quantity").alias("worst"),
    )


_MULTIHOT = {"sum": "CAST(count(*) AS DOUBLE)", "mean": "count(*) / CAST(max(event_id % 4) AS DOUBLE)", "max": "1.0::DOUBLE"}


def _register_multihot(combiner: str, value: str) -> None:
    @query(
        f"agg_multihot_{combiner}",
        f"WITH {BAG_SQL} SELECT event_id, id, {value} AS value FROM bag GROUP BY event_id, id",
    )
    def run(spark, sf_dir):
        return multihot(bags(spark, sf_dir), "event_id", "ids", 40, combiner)


for _name, _value in _MULTIHOT.items():
    _register_multihot(_name, _value)


@query(
    "agg_sparse_reduce",
    f"""WITH {BAG_SQL} SELECT e.event_id, CAST(coalesce(sum(id), 0) AS DOUBLE) AS total, coalesce(avg(id), 0) AS mean, max(id) AS top
        FROM e LEFT JOIN bag ON e.event_id = bag.event_id GROUP BY e.event_id""",
)
def agg_sparse_reduce(spark, sf_dir):
    ids = F.col("ids")
    return bags(spark, sf_dir).select(
        "event_id",
        arrays.reduce_values(ids, "sum").alias("total"),
        arrays.reduce_values(ids, "mean").alias("mean"),
        arrays.reduce_values(ids, "max").alias("top"),
    )


@query(
    "agg_reduce_modes",
    f"""WITH {BAG_SQL}, m AS (SELECT event_id, id, avg(id) OVER (PARTITION BY event_id) AS c FROM bag)
        SELECT event_id, CAST(sum(id) AS DOUBLE) AS total, round(avg(id), 6) AS mean, CAST(max(id) AS BIGINT) AS top,
               round(sqrt(sum((id - c) * (id - c))), 6) AS spread FROM m GROUP BY event_id""",
)
def agg_reduce_modes(spark, sf_dir):
    ids = F.col("ids")
    return bags(spark, sf_dir).filter(F.size("ids") > 0).select(
        "event_id",
        arrays.reduce_values(ids, "sum").alias("total"),
        F.round(arrays.reduce_values(ids, "mean"), 6).alias("mean"),
        arrays.reduce_values(ids, "max").alias("top"),
        F.round(arrays.reduce_values(ids, "centered_l2"), 6).alias("spread"),
    )


@query(
    "agg_embedding_pool",
    """WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
       bag AS (SELECT event_id, (k * (i + 1) + event_id) % 600 AS id FROM (SELECT *, unnest(range(0, event_id % 4)) AS i FROM e)),
       p AS (SELECT event_id, count(*) AS n, sum(embedding[1]::DOUBLE) AS s0, sum(embedding[32]::DOUBLE) AS s31,
                    sum(embedding[64]::DOUBLE) AS s63, sum(list_sum(embedding::DOUBLE[])) AS st
             FROM bag LEFT JOIN embeddings ON id = vec_id GROUP BY event_id)
       SELECT e.event_id, round(coalesce(s0, 0), 5) AS sum0, round(coalesce(s31 / n, 0), 5) AS mean31,
              round(coalesce(s63 / sqrt(n), 0), 5) AS sqrtn63, round(coalesce(st, 0), 4) AS total
       FROM e LEFT JOIN p ON e.event_id = p.event_id""",
)
def agg_embedding_pool(spark, sf_dir):
    """Sum, mean and sqrtn pools of the same bags; ids without a vector add nothing."""
    rows = bags(spark, sf_dir, 600)
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    pooled = embedding_pool(rows, "event_id", "ids", emb, 64, {"s": "sum", "m": "mean", "q": "sqrtn"})
    return pooled.select(
        "event_id",
        F.round(F.get("s", F.lit(0)), 5).alias("sum0"),
        F.round(F.get("m", F.lit(31)), 5).alias("mean31"),
        F.round(F.get("q", F.lit(63)), 5).alias("sqrtn63"),
        F.round(arrays.total(F.col("s")), 4).alias("total"),
    )


@query(
    "agg_merge_shards",
    """WITH s AS (SELECT vec_id % 12 AS shard, vec_id // 12 AS r, label, vec_id FROM embeddings),
       o AS (SELECT shard, sum(count(*)) OVER (ORDER BY shard) - count(*) AS off FROM s GROUP BY shard)
       SELECT CAST(off + r AS BIGINT) AS id, label, vec_id FROM s JOIN o ON s.shard = o.shard""",
)
def agg_merge_shards(spark, sf_dir):
    """Twelve row shards back to one table; shard 10 follows shard 9."""
    shards = table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 12).alias("shard"), F.floor(F.col("vec_id") / 12).alias("r"), "label", "vec_id"
    )
    return merge_shards(shards, "shard", "r")


# --- windows, histories, vocabularies --------------------------------------------------


@query(
    "win_running_sum",
    """WITH c AS (SELECT CAST(l_partkey AS VARCHAR) AS token, count(*) AS n FROM lineitem GROUP BY 1)
       SELECT token, n, CAST(sum(n) OVER (ORDER BY n DESC, token ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM c""",
)
def win_running_sum(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("token"))
    placed = ordered_prefix(token_frequency(rows), frequency_order(), sums={"running": F.col("n")})
    return placed.select("token", "n", "running")


@query(
    "vocab_by_coverage",
    """WITH c AS (SELECT CAST(l_partkey AS VARCHAR) AS token, count(*) AS n FROM lineitem GROUP BY 1),
       r AS (SELECT token, n, sum(n) OVER (ORDER BY n DESC, token ROWS UNBOUNDED PRECEDING) AS acc,
                    row_number() OVER (ORDER BY n DESC, token) AS id, sum(n) OVER () AS total FROM c)
       SELECT token, n, CAST(acc AS BIGINT) AS running, CAST(id AS BIGINT) AS id FROM r WHERE acc < 9e-1 * total""",
)
def vocab_by_coverage(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("token"))
    return coverage_vocabulary(token_frequency(rows), 0.9)


@query(
    "vocab_dense_id",
    """SELECT CAST(l_partkey AS VARCHAR) AS token, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) AS BIGINT) AS id
       FROM lineitem GROUP BY 1 UNION ALL SELECT 'DEFAULT', 0""",
)
def vocab_dense_id(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("token"))
    return with_default(dense_ids(token_frequency(rows)))


@query(
    "vocab_by_min_count",
    """SELECT CAST(l_partkey AS VARCHAR) AS token, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) AS BIGINT) AS id
       FROM lineitem GROUP BY 1 HAVING count(*) >= 30 UNION ALL SELECT '<unk>', 0""",
)
def vocab_by_min_count(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("token"))
    return with_default(min_count_vocabulary(token_frequency(rows), 30), token="<unk>")


def _histories(spark, sf_dir):
    log = interactions(spark, sf_dir)
    sources = log.filter(F.col("tag") > 0).withColumn("stream", F.when(F.col("tag") == 1, "click").otherwise("order"))
    return last_n_history(
        log, sources, ["cid"], ["ts", "pid", "tag", "event_id"], "pid", "stream", ["click", "order"], n=20
    )


@query(
    "win_history_last_n",
    f"""WITH {INTER}, {HISTORY} SELECT event_id, cid, pid, tag, array_to_string(click, ',') AS click,
        array_to_string(ord, ',') AS orders FROM last20""",
)
def win_history_last_n(spark, sf_dir):
    return _histories(spark, sf_dir).select(
        "event_id", "cid", "pid", "tag", text(F.col("click_history")).alias("click"), text(F.col("order_history")).alias("orders")
    )


@query(
    "win_history_all",
    f"""WITH {INTER}, {SAMPLED}, {HISTORY} SELECT s.event_id, s.pid, s.tag AS label, array_to_string(h.clicks, ',') AS click,
        array_to_string(h.orders_, ',') AS orders FROM sampled s JOIN hist h ON s.event_id = h.event_id""",
)
def win_history_all(spark, sf_dir):
    """Whole histories of the sampled targets."""
    log = interactions(spark, sf_dir)
    samples = label_samples(log, "event_id", SampleSettings(history=None))
    orders = F.transform("order_cross", lambda t: F.split(t, ",")[1])
    return samples.select(
        F.col("sample_id").alias("event_id"), "pid", "label", text(F.col("click")).alias("click"), text(orders).alias("orders")
    )


@query(
    "win_history_cross",
    f"""WITH {INTER}, {HISTORY} SELECT event_id, array_to_string([pid || ',' || h FOR h IN click], ';') AS click_cross,
        array_to_string([pid || ',' || h FOR h IN ord], ';') AS order_cross FROM last20""",
)
def win_history_cross(spark, sf_dir):
    rows = cross_tokens(_histories(spark, sf_dir), "pid", "click_history", "click_cross")
    rows = cross_tokens(rows, "pid", "order_history", "order_cross")
    return rows.select(
        "event_id", text(F.col("click_cross"), ";").alias("click_cross"), text(F.col("order_cross"), ";").alias("order_cross")
    )


@query(
    "sample_balanced_per_user",
    f"WITH {INTER}, {SAMPLED} SELECT event_id, cid, pid, tag AS label FROM sampled",
)
def sample_balanced_per_user(spark, sf_dir):
    return balanced_sample(interactions(spark, sf_dir), "cid", "event_id").select("event_id", "cid", "pid", "label")


# --- sample job ------------------------------------------------------------------------


@query(
    "labelled_samples",
    f"""WITH {SAMPLE_CTE} SELECT sample_id, cid, pid, label, array_to_string(click, ';') AS click,
        array_to_string(click_cross, ';') AS click_cross, array_to_string(order_cross, ';') AS order_cross FROM samples""",
)
def labelled_samples(spark, sf_dir):
    rows = label_samples(interactions(spark, sf_dir), "event_id")
    lists = ["click", "click_cross", "order_cross"]
    return rows.select("sample_id", "cid", "pid", "label", *[text(F.col(c), ";").alias(c) for c in lists])


@query(
    "sample_vocabularies",
    f"""WITH {SAMPLE_CTE}, {TOKENS}, {VOCAB} SELECT * FROM vocab
        UNION ALL SELECT unnest(['cid', 'cross', 'pid']), 'DEFAULT', 0""",
)
def sample_vocabularies(spark, sf_dir):
    return learn_vocabularies(materialize(label_samples(interactions(spark, sf_dir), "event_id")))


@query("sample_token_counts", f"WITH {SAMPLE_CTE}, {TOKENS} SELECT field, token, n FROM counts")
def sample_token_counts_query(spark, sf_dir):
    return sample_token_counts(label_samples(interactions(spark, sf_dir), "event_id"))


PROFILE_BUCKETS = """prof AS (SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS price,
    CAST(p_size AS DOUBLE) AS size FROM part),
  pr AS (SELECT price, row_number() OVER (ORDER BY price) - 1 AS rn, count(*) OVER () AS n FROM prof WHERE price IS NOT NULL),
  sr AS (SELECT size, row_number() OVER (ORDER BY size) - 1 AS rn, count(*) OVER () AS n FROM prof),
  lim AS (SELECT (SELECT max(price) FROM pr WHERE rn = n // 30) AS plo, (SELECT max(price) FROM pr WHERE rn = least(n - n // 30, n - 1)) AS phi,
                 (SELECT max(size) FROM sr WHERE rn = n // 30) AS slo, (SELECT max(size) FROM sr WHERE rn = least(n - n // 30, n - 1)) AS shi),
  buckets AS (SELECT key,
     CAST(CASE WHEN price IS NULL THEN 0 WHEN price <= plo THEN 1 WHEN price >= phi THEN 29 ELSE ceil(27e0 * (price - plo) / (phi - plo)) END AS BIGINT) AS price,
     CAST(CASE WHEN size IS NULL THEN 0 WHEN size <= slo THEN 1 WHEN size >= shi THEN 29 ELSE ceil(27e0 * (size - slo) / (shi - slo)) END AS BIGINT) AS size
     FROM prof, lim)"""


def _encoded_list(column: str, field: str) -> str:
    return f"""{column}_e AS (SELECT sample_id, string_agg(CAST(coalesce(id, 0) AS VARCHAR), ', ' ORDER BY i) AS ids
      FROM (SELECT sample_id, {column}[i] AS token, i FROM (SELECT sample_id, {column}, unnest(range(1, len({column}) + 1)) AS i FROM samples)) x
      LEFT JOIN vocab ON vocab.token = x.token AND vocab.field = '{field}' GROUP BY sample_id)"""


TRAIN_SQL = f"""WITH {SAMPLE_CTE}, {TOKENS}, {VOCAB}, {PROFILE_BUCKETS},
  {_encoded_list('click', 'pid')}, {_encoded_list('click_cross', 'cross')}, {_encoded_list('order_cross', 'cross')}
  SELECT s.sample_id, s.label, CAST(('0x' || substr(md5('777:' || s.sample_id), 1, 8))::BIGINT % 10 AS INTEGER) AS fold,
    s.label || '@' || coalesce(vc.id, 0) || '|' || coalesce(vp.id, 0) || '|' || coalesce(c.ids, '') || '|' || coalesce(cc.ids, '') || '|' ||
    coalesce(oc.ids, '') || '|' || b.price || '|' || b.size AS line
  FROM samples s JOIN buckets b ON s.pid = b.key
  LEFT JOIN vocab vc ON vc.token = s.cid AND vc.field = 'cid' LEFT JOIN vocab vp ON vp.token = s.pid AND vp.field = 'pid'
  LEFT JOIN click_e c ON c.sample_id = s.sample_id LEFT JOIN click_cross_e cc ON cc.sample_id = s.sample_id
  LEFT JOIN order_cross_e oc ON oc.sample_id = s.sample_id"""


def _sample_profile(spark, sf_dir):
    """Profile with missing prices."""
    return (
        table(spark, sf_dir, "part")
        .select(
            F.col("p_partkey").cast("string").alias("key"),
            F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice")).alias("price"),
            F.col("p_size").cast("double").alias("size"),
        )
    )


@query("train_samples", TRAIN_SQL)
def train_samples_query(spark, sf_dir):
    """Log to encoded sample lines with fold, the whole job."""
    profile = _sample_profile(spark, sf_dir)
    done = train_samples(
        interactions(spark, sf_dir), "event_id", profile, "key", ["price", "size"], SampleSettings(buckets=30)
    )
    return done.select("sample_id", "label", "fold", "line")


MINMAX_BUCKETS = """prof AS (SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_size % 7 = 0 THEN 0 ELSE p_retailprice END AS price,
    CAST(p_size AS DOUBLE) AS size FROM part),
  lim AS (SELECT min(price) AS plo, max(price) AS phi, min(size) AS slo, max(size) AS shi FROM prof),
  buckets AS (SELECT key, CAST(ceil((price - plo) / ((phi - plo) / 29e0)) AS BIGINT) AS price,
     CAST(ceil((size - slo) / ((shi - slo) / 29e0)) AS BIGINT) AS size FROM prof, lim)"""


def _two_per_user(sql: str) -> str:
    return sql.replace("count(*) FILTER (WHERE tag = 0), 7)", "count(*) FILTER (WHERE tag = 0), 2)")


@query(
    "train_samples_left",
    _two_per_user(
        TRAIN_SQL.replace(PROFILE_BUCKETS, MINMAX_BUCKETS)
        .replace("FROM samples s JOIN buckets b", "FROM samples s LEFT JOIN buckets b")
        .replace("b.price", "coalesce(b.price, 0)")
        .replace("b.size", "coalesce(b.size, 0)")
    ),
)
def train_samples_left(spark, sf_dir):
    """Two samples per user and label, min-max buckets, items without profile kept."""
    done = train_samples(
        interactions(spark, sf_dir),
        "event_id",
        _sample_profile(spark, sf_dir),
        "key",
        ["price", "size"],
        SampleSettings(buckets=30, per_user=2),
        keep_missing=True,
        bucket_mode="minmax",
    )
    return done.select("sample_id", "label", "fold", "line")


# --- tabular job ------------------------------------------------------------------------


def _tabular_sql() -> str:
    return """WITH t AS (SELECT o_orderkey AS key, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS price, CAST(o_custkey AS DOUBLE) AS cust,
        o_orderpriority AS priority, CAST(o_custkey % 400 AS VARCHAR) AS grp FROM orders),
      s AS (SELECT min(least(price, 300000)) AS plo, max(least(price, 300000)) AS phi, min(least(cust, 1000)) AS clo, max(least(cust, 1000)) AS chi FROM t
            WHERE TRUE),
      v AS (SELECT 'priority' AS field, priority AS token, count(*) AS n FROM t GROUP BY 2 UNION ALL SELECT 'grp', grp, count(*) FROM t GROUP BY 2),
      i AS (SELECT field, token, row_number() OVER (PARTITION BY field ORDER BY n DESC, token) AS id FROM v WHERE n >= 38)
      SELECT key, label || chr(9) ||
        regexp_replace(printf('%.6f', (least(coalesce(price, 0), 300000) - plo) / (phi - plo)), '\\.?0+$', '') || chr(9) ||
        regexp_replace(printf('%.6f', (least(cust, 1000) - clo) / (chi - clo)), '\\.?0+$', '') || chr(9) ||
        coalesce(a.id, 0) || chr(9) || coalesce(b.id, 0) AS line
      FROM t CROSS JOIN s LEFT JOIN i a ON a.field = 'priority' AND a.token = priority LEFT JOIN i b ON b.field = 'grp' AND b.token = grp"""


@query("tabular_features", _tabular_sql())
def tabular_features_query(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("price"),
        F.col("o_custkey").cast("double").alias("cust"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("o_custkey") % 400).cast("string").alias("grp"),
    )
    clips = {"price": 300000.0, "cust": 1000.0}
    return tabular_features(rows, "key", "label", clips, ["priority", "grp"], cutoff=38).select("key", "line")
