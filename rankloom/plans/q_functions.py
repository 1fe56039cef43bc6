"""Queries over scalar and array expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.functions import arrays, dates, numeric
from rankloom.functions import text as tx
from rankloom.plans.catalog import query, table, text
from rankloom.plans.train_samples import bucket_profile
from rankloom.sources.sinks import recommendation_json

def k_col():
    return F.get_json_object("props", "$.k").cast("bigint")


SQL_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query(
    "str_split_pick",
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', 2) AS second,
              split_part(p_brand, '#', 2) AS brand, CAST(NULL AS VARCHAR) AS ninth FROM part""",
)
def str_split_pick(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        tx.split_pick("p_name", " ", 0).alias("first"),
        tx.split_pick("p_name", " ", 1).alias("second"),
        tx.split_pick("p_brand", "#", 1).alias("brand"),
        tx.split_pick("p_name", " ", 8).alias("ninth"),
    )


@query(
    "str_strip_replace",
    """SELECT p_partkey, replace(p_name, ' ', '') AS packed, substr(p_name, 2, length(p_name) - 2) AS inner_name,
              starts_with(p_brand, 'Brand#1') AS brand1, ends_with(p_name, 'bolt') AS bolt FROM part""",
)
def str_strip_replace(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        tx.strip_spaces("p_name").alias("packed"),
        tx.strip_brackets(F.col("p_name")).alias("inner_name"),
        F.col("p_brand").startswith("Brand#1").alias("brand1"),
        F.col("p_name").endswith("bolt").alias("bolt"),
    )


@query(
    "str_pair_concat",
    """SELECT l_orderkey, l_linenumber, l_partkey || ',' || l_suppkey AS pair, 'item_' || l_partkey AS key FROM lineitem""",
)
def str_pair_concat(spark, sf_dir):
    part = F.col("l_partkey").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        tx.pair_token(part, F.col("l_suppkey").cast("string")).alias("pair"),
        tx.field_token("item", part).alias("key"),
    )


@query(
    "str_array_join",
    """SELECT event_id, array_to_string([k + i FOR i IN range(0, event_id % 4)], ', ') AS ids
       FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def str_array_join(spark, sf_dir):
    ids = F.transform(F.slice(F.sequence(F.lit(0), F.lit(3)), F.lit(1), (F.col("event_id") % 4).cast("int")), lambda i: i + k_col())
    return table(spark, sf_dir, "events").select("event_id", tx.list_text(ids).alias("ids"))


@query(
    "num_format_trim",
    """SELECT l_orderkey, l_linenumber,
              regexp_replace(printf('%.6f', l_discount), '\\.?0+$', '') AS discount,
              regexp_replace(printf('%.6f', l_quantity / 8), '\\.?0+$', '') AS eighth,
              regexp_replace(printf('%.6f', l_quantity * 10), '\\.?0+$', '') AS tens FROM lineitem""",
)
def num_format_trim(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        tx.trim_decimal(F.col("l_discount")).alias("discount"),
        tx.trim_decimal(F.col("l_quantity") / 8).alias("eighth"),
        tx.trim_decimal(F.col("l_quantity") * 10).alias("tens"),
    )


@query(
    "cast_numeric",
    f"""SELECT event_id, {SQL_K} AS k, CAST({SQL_K} AS DOUBLE) AS kd, CAST(user_id AS VARCHAR) AS cid,
               CASE WHEN {SQL_K} % 5 = 0 THEN NULL ELSE CAST({SQL_K} AS DOUBLE) END AS blank FROM events""",
)
def cast_numeric(spark, sf_dir):
    k_text = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        "event_id",
        k_text.cast("bigint").alias("k"),
        tx.to_double(k_text).alias("kd"),
        F.col("user_id").cast("string").alias("cid"),
        tx.to_double(F.when(k_col() % 5 == 0, F.lit("")).otherwise(k_text)).alias("blank"),
    )


@query(
    "ts_parse_trunc",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts FROM events""",
)
def ts_parse_trunc(spark, sf_dir):
    written = F.col("ts").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", dates.parse_seconds(written).cast("string").alias("ts")
    )


@query(
    "date_shift",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN ''
              ELSE strftime(o_orderdate - INTERVAL 3 DAY, '%Y-%m-%d') END AS shifted FROM orders""",
)
def date_shift(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    arg = (
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(""))
        .when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("1990-01-01:"), day))
        .otherwise(day)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.shift_date(arg, -3).alias("shifted"))


@query(
    "date_interval",
    """SELECT o_orderkey, CAST(i AS INTEGER) AS i, strftime(o_orderdate + to_days(CAST(i AS INTEGER)), '%Y-%m-%d') AS day
       FROM (SELECT o_orderkey, o_orderdate, unnest(range(0, o_orderkey % 4)) AS i FROM orders)""",
)
def date_interval(spark, sf_dir):
    """0 to 3 days per order; the reversed range of every fourth order is empty."""
    start = F.to_date("o_orderdate")
    end = F.date_add(start, (F.col("o_orderkey") % 4 - 1).cast("int"))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", F.posexplode(dates.day_range(start, end)).alias("i", "d"))
        .select("o_orderkey", "i", F.date_format("d", "yyyy-MM-dd").alias("day"))
    )


@query(
    "bucket_minmax",
    """WITH s AS (SELECT CAST(min(p_retailprice) AS DOUBLE) AS plo, CAST(max(p_retailprice) AS DOUBLE) AS phi,
                         CAST(min(p_size) AS DOUBLE) AS slo, CAST(max(p_size) AS DOUBLE) AS shi FROM part)
       SELECT p_partkey, CAST(ceil((p_retailprice - plo) / ((phi - plo) / 2999e0)) AS BIGINT) AS p_retailprice,
              CAST(ceil((p_size - slo) / ((shi - slo) / 2999e0)) AS BIGINT) AS p_size FROM part, s""",
)
def bucket_minmax(spark, sf_dir):
    return bucket_profile(table(spark, sf_dir, "part"), "p_partkey", ["p_retailprice", "p_size"], 3000, mode="minmax")


TRIMMED_SQL = """v AS (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS price, CAST(p_size AS DOUBLE) AS size FROM part),
  pr AS (SELECT price, row_number() OVER (ORDER BY price) - 1 AS rn, count(*) OVER () AS n FROM v WHERE price IS NOT NULL),
  sr AS (SELECT size, row_number() OVER (ORDER BY size) - 1 AS rn, count(*) OVER () AS n FROM v WHERE size IS NOT NULL),
  b AS (SELECT (SELECT max(price) FROM pr WHERE rn = n // 30) AS plo, (SELECT max(price) FROM pr WHERE rn = least(n - n // 30, n - 1)) AS phi,
               (SELECT max(size) FROM sr WHERE rn = n // 30) AS slo, (SELECT max(size) FROM sr WHERE rn = least(n - n // 30, n - 1)) AS shi)"""


@query(
    "bucket_trimmed",
    f"""WITH {TRIMMED_SQL}
       SELECT p_partkey,
         CAST(CASE WHEN price IS NULL THEN 0 WHEN price <= plo THEN 1 WHEN price >= phi THEN 29
              ELSE ceil(27e0 * (price - plo) / (phi - plo)) END AS BIGINT) AS price,
         CAST(CASE WHEN size IS NULL THEN 0 WHEN size <= slo THEN 1 WHEN size >= shi THEN 29
              ELSE ceil(27e0 * (size - slo) / (shi - slo)) END AS BIGINT) AS size
       FROM v, b""",
)
def bucket_trimmed(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice")).alias("price"),
        F.col("p_size").cast("double").alias("size"),
    )
    return bucket_profile(part, "p_partkey", ["price", "size"], 30)


@query(
    "norm_minmax",
    """WITH s AS (SELECT min(least(o_totalprice, 300000)) AS lo, max(least(o_totalprice, 300000)) AS hi FROM orders)
       SELECT o_orderkey,
              round((least(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_totalprice END, 300000) - lo) / (hi - lo), 8) AS scaled,
              round((CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_totalprice END - lo) / (hi - lo), 8) AS unclipped
       FROM orders, s""",
)
def norm_minmax(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    price = numeric.clip_upper(F.col("o_totalprice"), 300000.0)
    limits = orders.agg(F.struct(F.min(price).alias("lo"), F.max(price).alias("hi")).alias("s")).scalar()
    value = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice"))
    rows = orders.select("o_orderkey", value.alias("v"), limits.alias("s"))
    return rows.select(
        "o_orderkey",
        F.round(numeric.minmax_scale(F.col("v"), F.col("s.lo"), F.col("s.hi"), clip=300000.0), 8).alias("scaled"),
        F.round(numeric.minmax_scale(F.col("v"), F.col("s.lo"), F.col("s.hi")), 8).alias("unclipped"),
    )


@query(
    "clip_upper",
    """SELECT l_orderkey, l_linenumber, least(l_quantity, 20.0::DOUBLE) AS q, least(l_extendedprice, 600.0::DOUBLE) AS p FROM lineitem""",
)
def clip_upper(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numeric.clip_upper(F.col("l_quantity"), 20.0).alias("q"),
        numeric.clip_upper(F.col("l_extendedprice"), 600.0).alias("p"),
    )


@query("score_product", "SELECT l_orderkey, l_linenumber, l_quantity * l_discount AS score FROM lineitem")
def score_product(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_discount")).alias("score")
    )


@query(
    "ratio_guard",
    """SELECT l_linestatus AS status, count(*) FILTER (WHERE l_returnflag = 'R') / CAST(count(*) FILTER (WHERE l_returnflag <> 'R') AS DOUBLE) AS ratio
       FROM lineitem GROUP BY 1""",
)
def ratio_guard(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linestatus").alias("status")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("p"), F.count_if(F.col("l_returnflag") != "R").alias("n")
    )
    return counts.select("status", numeric.ratio_below_one(F.col("p"), F.col("n")).alias("ratio"))


def _range(limit: int, size):
    """``[0, 1, ..., size - 1]`` with ``size`` < ``limit``."""
    return F.slice(F.sequence(F.lit(0), F.lit(limit)), F.lit(1), size.cast("int"))


@query(
    "arr_slice_tail",
    """SELECT event_id, array_to_string([i FOR i IN range(0, event_id % 31) IF i >= event_id % 31 - 20], ',') AS tail,
              array_to_string([i FOR i IN range(0, event_id % 31) IF i < 5], ',') AS head FROM events""",
)
def arr_slice_tail(spark, sf_dir):
    arr = _range(31, F.col("event_id") % 31)
    return table(spark, sf_dir, "events").select(
        "event_id", text(arrays.tail(arr, 20)).alias("tail"), text(arrays.head(arr, 5)).alias("head")
    )


@query(
    "arr_zip_pad",
    """WITH e AS (SELECT event_id, range(0, event_id % 3) AS a, range(0, event_id % 5) AS b FROM events)
       SELECT event_id, array_to_string([coalesce(CAST(a[i] AS VARCHAR), '') || ':' || coalesce(CAST(b[i] AS VARCHAR), '')
              FOR i IN range(1, greatest(len(a), len(b)) + 1)], ' ') AS zipped FROM e""",
)
def arr_zip_pad(spark, sf_dir):
    a = _range(5, F.col("event_id") % 3).cast("array<string>")
    b = _range(5, F.col("event_id") % 5).cast("array<string>")
    zipped = arrays.zip_padded("", a=a, b=b)
    return table(spark, sf_dir, "events").select(
        "event_id", text(F.transform(zipped, lambda s: F.concat_ws(":", s["a"], s["b"])), " ").alias("zipped")
    )


@query(
    "arr_to_dense",
    """SELECT event_id, array_to_string([CASE WHEN i < event_id % 9 THEN i + 1 ELSE 0 END FOR i IN range(0, 5)], ',') AS dense FROM events""",
)
def arr_to_dense(spark, sf_dir):
    ids = F.transform(_range(9, F.col("event_id") % 9), lambda i: i + 1)
    return table(spark, sf_dir, "events").select("event_id", text(arrays.pad_to(ids, 5, F.lit(0), surplus="cut")).alias("dense"))


@query(
    "arr_enumerate",
    """SELECT p_partkey AS row_num, CAST(i AS INTEGER) AS idx, w[i + 1] AS item
       FROM (SELECT p_partkey, string_split(p_name, ' ') AS w, unnest(range(0, len(string_split(p_name, ' ')))) AS i FROM part)""",
)
def arr_enumerate(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_num"), F.posexplode(tx.split_on("p_name", " ")).alias("idx", "item")
    )


@query(
    "arr_sort_by_idx",
    """SELECT p_partkey, array_to_string(list_reverse(string_split(p_name || ' ' || p_type, ' ')), ' ') AS words FROM part""",
)
def arr_sort_by_idx(spark, sf_dir):
    words = tx.split_on(F.concat_ws(" ", "p_name", "p_type"), " ")
    keyed = F.transform(words, lambda w, i: F.struct((-i).alias("pos"), w.alias("item")))
    return table(spark, sf_dir, "part").select("p_partkey", text(arrays.sort_by_index(keyed), " ").alias("words"))


def logit_col():
    return F.col("l_discount") * 20 - F.col("l_tax") * 10 - F.lit(0.5)


def label_col():
    return (F.col("l_returnflag") == "R").cast("int")


SQL_LOGIT = "(l_discount * 20 - l_tax * 10 - 5e-1)"
SQL_Y = "CAST(l_returnflag = 'R' AS INTEGER)"


@query(
    "sigmoid",
    f"SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-{SQL_LOGIT})), 8) AS p FROM lineitem",
)
def sigmoid(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(numeric.sigmoid(logit_col()), 8).alias("p")
    )


@query(
    "logloss_term",
    f"""SELECT l_orderkey, l_linenumber,
          round(-y * ln(p + 1e-7) - (1 - y) * ln(1 - p + 1e-7), 6) AS loss,
          round(greatest(x, 0e0) - x * y + ln(1 + exp(-abs(x))), 6) AS from_logit
        FROM (SELECT l_orderkey, l_linenumber, l_discount * 10 AS p, {SQL_LOGIT} AS x, {SQL_Y} AS y FROM lineitem)""",
)
def logloss_term(spark, sf_dir):
    """Probabilities include exactly 0 and 1."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(numeric.logloss(label_col(), F.col("l_discount") * 10), 6).alias("loss"),
        F.round(numeric.logloss_from_logit(label_col(), logit_col()), 6).alias("from_logit"),
    )


@query(
    "focal_term",
    f"""SELECT l_orderkey, l_linenumber,
          round(-y * 75e-2 * ((1 - p) * 2e0) * ln(p) - (1 - y) * 25e-2 * p * p * ln(1 - p), 6) AS linear,
          round(-y * 75e-2 * ((1 - p) * (1 - p)) * ln(p) - (1 - y) * 25e-2 * p * p * ln(1 - p), 6) AS power
        FROM (SELECT l_orderkey, l_linenumber, 1 / (1 + exp(-{SQL_LOGIT})) AS p, {SQL_Y} AS y FROM lineitem)""",
)
def focal_term(spark, sf_dir):
    p = numeric.sigmoid(logit_col())
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(numeric.focal(label_col(), p), 6).alias("linear"),
        F.round(numeric.focal(label_col(), p, form="power"), 6).alias("power"),
    )


@query(
    "json_typed",
    """SELECT s_suppkey, '{"item_key":{"s":"' || s_suppkey || '"},"info":{"l":[{"n":"' || s_nationkey || '"},{"n":"' || (s_nationkey + 1) || '"}]}}' AS json
       FROM supplier""",
)
def json_typed(spark, sf_dir):
    ids = F.array("s_nationkey", F.col("s_nationkey") + 1)
    return table(spark, sf_dir, "supplier").select("s_suppkey", recommendation_json(F.col("s_suppkey"), ids).alias("json"))
