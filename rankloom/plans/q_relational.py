"""Queries over projections, filters, joins, orders and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankloom.functions.text import token_list
from rankloom.ml.serving import serving_table, union_all, write_serving_table
from rankloom.operators.encode import encode_lists, encode_token
from rankloom.operators.joins import dimension_join, enrich_pairs, positional_zip
from rankloom.operators.ordering import ordered_prefix, shard_rows, take_at_positions
from rankloom.operators.sampling import (
    downsample_negatives,
    repeat_epochs,
    shuffled,
    split_fold,
    split_train_eval,
)
from rankloom.operators.vocab import coverage_vocabulary, dense_ids, token_frequency, with_default
from rankloom.plans.catalog import INTER, interactions, query, sql_hash, table, text
from rankloom.plans.pairs import pair_inference_lines, pair_training_set, top_recommendations
from rankloom.session import materialize, scratch_path
from rankloom.sources.delimited import nonblank_rows, read_pairs
from rankloom.sources.sinks import joined_line, sample_line, write_text


# --- projections and filters -----------------------------------------------------


@query(
    "project_select_rename_drop",
    """SELECT l_partkey AS item1, l_suppkey AS item2, l_quantity AS value FROM lineitem""",
)
def project_select_rename_drop(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_tax")
    return rows.withColumnsRenamed({"l_partkey": "item1", "l_suppkey": "item2", "l_quantity": "value"}).drop("l_tax")


def _pair_texts(spark, sf_dir):
    """Pairs in which some fields are blank or spaces only."""
    key = F.col("l_orderkey") + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(key % 7 == 0, F.lit("")).otherwise(F.col("l_partkey").cast("string")).alias("item1"),
        F.when(key % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("l_suppkey").cast("string"))).alias("item2"),
        F.when(F.col("l_returnflag") == "R", "1").otherwise("0").alias("label"),
    )


@query(
    "filter_nonblank",
    """SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS item1, ' ' || l_suppkey AS item2,
              CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS label
       FROM lineitem WHERE (l_orderkey + l_linenumber) % 7 <> 0 AND (l_orderkey + l_linenumber) % 5 <> 0""",
)
def filter_nonblank(spark, sf_dir):
    return nonblank_rows(_pair_texts(spark, sf_dir), ["item1", "item2", "label"])


@query(
    "filter_token_nonempty",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type || ',' || user_id END AS tokens FROM events""",
)
def filter_token_nonempty(spark, sf_dir):
    raw = F.when(F.col("event_id") % 3 == 0, F.lit(",,")).otherwise(
        F.concat(F.lit(","), F.col("event_type"), F.lit(",,"), F.col("user_id").cast("string"))
    )
    return table(spark, sf_dir, "events").select("event_id", text(token_list(raw)).alias("tokens"))


@query(
    "filter_label",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'positive' ELSE 'negative' END AS side
       FROM lineitem WHERE l_returnflag IN ('R', 'N')""",
)
def filter_label(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "N", 0).alias("label")
    )
    positives = rows.filter(F.col("label") == 1).withColumn("side", F.lit("positive"))
    negatives = rows.filter(F.col("label") == 0).withColumn("side", F.lit("negative"))
    return positives.unionByName(negatives).drop("label")


@query(
    "filter_not_null",
    """SELECT event_id, p_name AS features FROM events
       JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)""",
)
def filter_not_null(spark, sf_dir):
    """Left join and not-null filter: Catalyst turns it into an inner join."""
    events = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("pid"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("features"))
    found = dimension_join(events, part, [("pid", "p_partkey")])
    return found.filter(F.col("features").isNotNull()).select("event_id", "features")


@query(
    "fill_null",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS custkey,
              CASE WHEN o_orderkey % 4 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS price FROM orders""",
)
def fill_null(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("custkey"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("price"),
    )
    return rows.na.fill(0)


@query(
    "serialize_row",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END || '@' || l_orderkey || '|' || l_partkey || '|' ||
              CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber || ', ' || l_suppkey ELSE '' END || '|' || l_linenumber AS line
       FROM lineitem""",
)
def serialize_row(spark, sf_dir):
    ids = F.array(F.col("l_linenumber").cast("bigint"), F.col("l_suppkey"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("pid"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.when(F.col("l_linenumber") % 2 == 0, ids).otherwise(F.array().cast("array<bigint>")).alias("click"),
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        sample_line("label", ["l_orderkey", "pid"], ["click"], ["l_linenumber"]).alias("line"),
    )


@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3200")
def limit_rows(spark, sf_dir):
    """The first 3200 rows of an ordered table."""
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(3200)
    )


@query(
    "output_format_select",
    """SELECT l_orderkey || chr(9) || l_linenumber || chr(9) || printf('%.4f', l_discount) || chr(9) || l_partkey AS line FROM lineitem""",
)
def output_format_select(spark, sf_dir):
    """Ordered mix of id and prediction columns, tab separated."""
    out = ["l_orderkey", "l_linenumber", F.format_string("%.4f", "l_discount"), "l_partkey"]
    return table(spark, sf_dir, "lineitem").select(joined_line(out, "\t").alias("line"))


# --- joins -----------------------------------------------------------------------

PID_VOCAB = """pv AS (
  SELECT pid AS token, row_number() OVER (ORDER BY count(*) DESC, pid) AS id FROM inter WHERE tag = 1 GROUP BY pid)"""


def _click_vocab(spark, sf_dir):
    """Ids of clicked items in frequency order."""
    clicks = interactions(spark, sf_dir).filter(F.col("tag") == 1)
    return materialize(dense_ids(token_frequency(clicks, "pid")))


@query(
    "join_vocab_encode",
    f"""WITH {INTER}, {PID_VOCAB},
        running AS (SELECT pid AS token, count(*) AS n FROM inter WHERE tag = 1 GROUP BY pid),
        kept AS (SELECT token FROM (SELECT token, sum(n) OVER (ORDER BY n DESC, token) AS acc, sum(n) OVER () AS total FROM running)
                 WHERE acc < 9e-1 * total)
        SELECT event_id, CASE WHEN kept.token IS NULL THEN 0 ELSE CAST(id AS BIGINT) END AS pid
        FROM inter LEFT JOIN pv ON pid = pv.token LEFT JOIN kept ON pid = kept.token""",
)
def join_vocab_encode(spark, sf_dir):
    """Items outside the most frequent nine tenths of the clicks get the default id."""
    clicks = interactions(spark, sf_dir).filter(F.col("tag") == 1)
    vocab = materialize(coverage_vocabulary(token_frequency(clicks, "pid"), 0.9).select("token", "id"))
    return encode_token(interactions(spark, sf_dir).select("event_id", "pid"), vocab, "pid", "pid")


PROFILE_SQL = "prof AS (SELECT CAST(p_partkey AS VARCHAR) AS key, p_size, p_retailprice FROM part)"


def _profile(spark, sf_dir):
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").cast("string").alias("key"), "p_size", "p_retailprice")
    )


@query(
    "join_profile_inner",
    f"WITH {INTER}, {PROFILE_SQL} SELECT event_id, pid, p_size, p_retailprice FROM inter JOIN prof ON pid = key",
)
def join_profile_inner(spark, sf_dir):
    rows = interactions(spark, sf_dir).select("event_id", "pid")
    return dimension_join(rows, _profile(spark, sf_dir), [("pid", "key")], how="inner")


@query(
    "join_profile_left",
    f"""WITH {INTER}, {PROFILE_SQL}
        SELECT event_id, pid, coalesce(p_size, 0) AS p_size, coalesce(p_retailprice, 0) AS p_retailprice
        FROM inter LEFT JOIN prof ON pid = key""",
)
def join_profile_left(spark, sf_dir):
    rows = interactions(spark, sf_dir).select("event_id", "pid")
    return dimension_join(rows, _profile(spark, sf_dir), [("pid", "key")]).na.fill(0)


def _k_lists(spark, sf_dir):
    """Per event a list of 0 to 3 item tokens and one of 0 to 1 user tokens."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    steps = F.slice(F.sequence(F.lit(0), F.lit(3)), F.lit(1), (F.col("event_id") % 4).cast("int"))
    items = F.transform(steps, lambda i: ((k * (i + 1) + i) % 110).cast("string"))
    second = F.when(F.col("event_id") % 2 == 0, F.array(k.cast("string"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "events").select("event_id", "event_type", items.alias("items"), second.alias("second"))


LISTS_SQL = """e AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
  il AS (SELECT event_id, i, CAST((k * (i + 1) + i) % 110 AS VARCHAR) AS token FROM (SELECT *, unnest(range(0, event_id % 4)) AS i FROM e)),
  ie AS (SELECT event_id, string_agg(CAST(coalesce(id, 0) AS VARCHAR), ',' ORDER BY i) AS items FROM il LEFT JOIN pv ON il.token = pv.token GROUP BY event_id)"""


@query(
    "join_list_encode",
    f"""WITH {INTER}, {PID_VOCAB}, {LISTS_SQL}
        SELECT e.event_id, e.event_type, coalesce(items, '') AS items FROM e LEFT JOIN ie ON e.event_id = ie.event_id""",
)
def join_list_encode(spark, sf_dir):
    rows = _k_lists(spark, sf_dir).drop("second")
    found = encode_lists(rows, _click_vocab(spark, sf_dir), "event_id", {"items": None})
    return found.select("event_id", "event_type", text(F.col("items")).alias("items"))


@query(
    "join_list_encode_combine",
    f"""WITH {INTER}, {PID_VOCAB}, {LISTS_SQL}
        SELECT e.event_id, items, CAST(coalesce(id, 0) AS VARCHAR) AS second
        FROM e JOIN ie ON e.event_id = ie.event_id LEFT JOIN pv ON CAST(k AS VARCHAR) = token WHERE e.event_id % 2 = 0""",
)
def join_list_encode_combine(spark, sf_dir):
    """Two lists through one lookup; samples with an empty list are dropped."""
    found = encode_lists(
        _k_lists(spark, sf_dir),
        _click_vocab(spark, sf_dir),
        "event_id",
        {"items": None, "second": None},
        drop_empty=True,
    )
    return found.select("event_id", text(F.col("items")).alias("items"), text(F.col("second")).alias("second"))


@query(
    "join_reassemble",
    """SELECT o_orderkey, o_custkey, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price FROM orders
       WHERE o_orderstatus <> 'P' AND o_totalprice > 1000""",
)
def join_reassemble(spark, sf_dir):
    """Per-field tables joined back on the row key."""
    orders = table(spark, sf_dir, "orders")
    fields = [
        orders.select("o_orderkey", "o_custkey"),
        orders.filter(F.col("o_orderstatus") != "P").select("o_orderkey", F.col("o_orderstatus").alias("status")),
        orders.select("o_orderkey", F.col("o_orderpriority").alias("priority")),
        orders.filter(F.col("o_totalprice") > 1000).select("o_orderkey", F.col("o_totalprice").alias("price")),
    ]
    result = fields[0]
    for other in fields[1:]:
        result = result.join(other, "o_orderkey")
    return result


@query(
    "join_pair_profiles",
    """SELECT l_orderkey, l_linenumber, a.p_partkey AS item1, b.p_partkey AS item2, a.p_name AS name1, b.p_name AS name2,
              a.p_size AS size1, b.p_size AS size2
       FROM lineitem JOIN part a ON l_partkey = a.p_partkey JOIN part b ON l_suppkey = b.p_partkey""",
)
def join_pair_profiles(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("item1"), F.col("l_suppkey").alias("item2")
    )
    profile = (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("pid"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    )
    return enrich_pairs(pairs, profile)


@query(
    "join_positional_zip",
    """WITH a AS (SELECT c_name AS token, row_number() OVER (ORDER BY c_custkey) - 1 AS position FROM customer),
            b AS (SELECT o_totalprice AS weight, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position FROM orders)
       SELECT a.position, token, weight FROM a JOIN b ON a.position = b.position""",
)
def join_positional_zip(spark, sf_dir):
    tokens = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("token"))
    weights = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("weight"))
    zipped = positional_zip(tokens, weights, [F.asc("c_custkey")], [F.asc("weight"), F.asc("o_orderkey")])
    return zipped.select("position", "token", "weight")


SERVING_SQL = f"""{INTER}, {PID_VOCAB},
  cv AS (SELECT cid AS token, row_number() OVER (ORDER BY count(*) DESC, cid) AS id FROM inter WHERE tag = 1 GROUP BY cid),
  w AS (SELECT vec_id AS id, CAST(label AS VARCHAR) || ' ' || CAST(vec_id AS VARCHAR) AS vec FROM embeddings),
  pt AS (SELECT token, id FROM pv UNION ALL SELECT 'DEFAULT', 0), ct AS (SELECT token, id FROM cv UNION ALL SELECT 'DEFAULT', 0),
  serving AS (SELECT 'itemid_' || token AS key, vec FROM pt JOIN w ON pt.id = w.id
  UNION ALL SELECT 'cid_' || token, vec FROM ct JOIN w ON ct.id = w.id)"""


def _serving(spark, sf_dir):
    log = interactions(spark, sf_dir).filter(F.col("tag") == 1)
    weights = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.concat_ws(" ", F.col("label").cast("string"), F.col("vec_id").cast("string")).alias("vec"),
    )
    items = materialize(with_default(dense_ids(token_frequency(log, "pid"))))
    users = materialize(with_default(dense_ids(token_frequency(log, "cid"))))
    return serving_table({"itemid": (items, weights), "cid": (users, weights)})


@query("join_weight_merge_union", f"WITH {SERVING_SQL} SELECT key, vec FROM serving")
def join_weight_merge_union(spark, sf_dir):
    return _serving(spark, sf_dir)


@query("serving_table_export", f"WITH {SERVING_SQL} SELECT key || ',' || vec AS value FROM serving")
def serving_table_export(spark, sf_dir):
    path = scratch_path(spark, "serving")
    write_serving_table(_serving(spark, sf_dir), path)
    return spark.read.text(path)


# --- orders, limits, top-k ---------------------------------------------------------


@query(
    "sort_tuple",
    f"""WITH {INTER} SELECT cid, row_number() OVER (PARTITION BY cid ORDER BY ts, pid, tag, event_id) AS position, pid, tag, event_id FROM inter""",
)
def sort_tuple(spark, sf_dir):
    """Every user's rows numbered in (time, item, tag) order; no user is collected."""
    order = [F.asc("ts"), F.asc("pid"), F.asc("tag"), F.asc("event_id")]
    return ordered_prefix(interactions(spark, sf_dir), order, by=["cid"]).drop("ts")


@query("sort_global", "SELECT l_partkey AS token, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, token")
def sort_global(spark, sf_dir):
    """Range-partitioned global sort, most frequent first."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("token"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "token")
    )


@query(
    "topk_recs",
    """WITH s AS (SELECT l_suppkey AS pid, l_orderkey * 10 + l_linenumber AS item, l_quantity * l_discount AS score FROM lineitem),
       r AS (SELECT pid, item, row_number() OVER (PARTITION BY pid ORDER BY score DESC, item) AS rn FROM s)
       SELECT pid, '{"item_key":{"s":"' || pid || '"},"info":{"l":[' || string_agg('{"n":"' || item || '"}', ',' ORDER BY rn) || ']}}' AS json
       FROM r WHERE rn <= 200 GROUP BY pid""",
)
def topk_recs(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("pid"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item"),
        "l_quantity",
        "l_discount",
    )
    return top_recommendations(pairs, "pid", "item", F.col("l_quantity") * F.col("l_discount")).select("pid", "json")


@query(
    "take_at_rank",
    """SELECT position, o_orderkey, o_totalprice FROM (
         SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position, o_orderkey, o_totalprice FROM orders)
       WHERE position IN (0, 37, 1200)""",
)
def take_at_rank(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return take_at_positions(orders, [F.asc("o_totalprice"), F.asc("o_orderkey")], [0, 37, 1200])


# --- set operations ----------------------------------------------------------------


@query(
    "union_default_row",
    f"""WITH {INTER}, {PID_VOCAB} SELECT token, CAST(id AS BIGINT) AS id FROM pv UNION ALL SELECT 'DEFAULT', 0""",
)
def union_default_row(spark, sf_dir):
    return with_default(_click_vocab(spark, sf_dir))


PAIR_SQL = f"""p AS (SELECT l_orderkey, l_linenumber, l_partkey AS item1, l_suppkey AS item2, CAST(l_returnflag = 'R' AS INTEGER) AS label,
    ('0x' || substr(md5('777:' || l_orderkey || ':' || l_linenumber), 1, 8))::BIGINT AS h FROM lineitem),
  c AS (SELECT count(*) FILTER (WHERE label = 1) / CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) * 4294967296e0 AS lim FROM p),
  s AS (SELECT l_orderkey, l_linenumber, item1, item2, label FROM p, c WHERE label = 1 OR h < lim)"""


def _pairs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("item1"),
        F.col("l_suppkey").alias("item2"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


@query("sample_negatives_ratio", f"WITH {PAIR_SQL} SELECT l_orderkey, l_linenumber, item1, item2 FROM s WHERE label = 0")
def sample_negatives_ratio(spark, sf_dir):
    balanced = downsample_negatives(_pairs(spark, sf_dir), "label", ["l_orderkey", "l_linenumber"])
    return balanced.filter(F.col("label") == 0).drop("label")


@query("union_pos_neg", f"WITH {PAIR_SQL} SELECT * FROM s")
def union_pos_neg(spark, sf_dir):
    return downsample_negatives(_pairs(spark, sf_dir), "label", ["l_orderkey", "l_linenumber"])


@query(
    "pair_training_set",
    f"""WITH {PAIR_SQL}, prof AS (SELECT p_partkey, p_name FROM part),
        j AS (SELECT 'train' AS part, * FROM s UNION ALL SELECT 'eval', l_orderkey, l_linenumber, item1, item2, label FROM p)
        SELECT part, l_orderkey, l_linenumber, label || '@' || a.p_name || '@' || b.p_name AS line
        FROM j JOIN prof a ON item1 = a.p_partkey JOIN prof b ON item2 = b.p_partkey""",
)
def pair_training_set_query(spark, sf_dir):
    """Balanced training rows and the full evaluation set, both with two profiles."""
    profile = (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("pid"), F.col("p_name").alias("features"))
    )
    train, full = pair_training_set(_pairs(spark, sf_dir), profile, ["l_orderkey", "l_linenumber"])
    both = train.withColumn("part", F.lit("train")).unionByName(full.withColumn("part", F.lit("eval")))
    line = F.concat_ws("@", F.col("label").cast("string"), "features1", "features2")
    return both.select("part", "l_orderkey", "l_linenumber", line.alias("line"))


@query(
    "pair_inference_set",
    """SELECT l_partkey || '@' || l_suppkey || '@' || a.p_name || '@' || b.p_name AS value FROM lineitem
       JOIN part a ON l_partkey = a.p_partkey JOIN part b ON l_suppkey = b.p_partkey""",
)
def pair_inference_set(spark, sf_dir):
    """Tab separated pairs to lines with both profiles."""
    path = scratch_path(spark, "infer")
    write_text(table(spark, sf_dir, "lineitem"), joined_line(["l_partkey", "l_suppkey", "l_quantity"], "\t"), path)
    profile = (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").cast("string").alias("pid"), F.col("p_name").alias("features"))
    )
    return pair_inference_lines(read_pairs(spark, path, train=False), profile)


@query(
    "union_reduce",
    """SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS balance FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier
       UNION ALL SELECT 'part', p_partkey, p_retailprice FROM part""",
)
def union_reduce(spark, sf_dir):
    parts = [("customer", "c_custkey", "c_acctbal"), ("supplier", "s_suppkey", "s_acctbal"), ("part", "p_partkey", "p_retailprice")]
    return union_all(
        table(spark, sf_dir, t).select(F.lit(t).alias("kind"), F.col(k).alias("key"), F.col(b).alias("balance"))
        for t, k, b in parts
    )


@query("union_epochs", "SELECT o_orderkey, CAST(e AS INTEGER) AS epoch FROM orders, (SELECT unnest(range(1, 4)) AS e)")
def union_epochs(spark, sf_dir):
    return repeat_epochs(table(spark, sf_dir, "orders").select("o_orderkey"), 3)


# --- splitting, sharding, shuffling --------------------------------------------------


@query(
    "split_train_eval",
    f"""SELECT o_orderkey, CASE WHEN {sql_hash(777, 'o_orderkey')} % 10 = 0 THEN 'eval' ELSE 'train' END AS part FROM orders""",
)
def split_train_eval_query(spark, sf_dir):
    train, held = split_train_eval(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("eval")))


@query(
    "split_folds",
    f"SELECT o_orderkey, CAST({sql_hash(123, 'o_orderkey')} % 10 AS INTEGER) AS fold FROM orders",
)
def split_folds(spark, sf_dir):
    return split_fold(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], seed=123)


@query(
    "shard_rows",
    """SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i % 8 = 3""",
)
def shard_rows_query(spark, sf_dir):
    return shard_rows(table(spark, sf_dir, "orders").select("o_orderkey"), [F.asc("o_orderkey")], 8, 3)


@query(
    "shuffle_order",
    """SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY md5('777:' || l_orderkey || ':' || l_linenumber)""",
)
def shuffle_order(spark, sf_dir):
    return shuffled(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query(
    "win_partition_order",
    """SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS INTEGER) AS idx
       FROM lineitem""",
)
def win_partition_order(spark, sf_dir):
    """Every line numbered within its order."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    return rows.withColumn("idx", F.row_number().over(order)).drop("l_partkey")


