"""Queries over sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.plans.catalog import query, table
from rankloom.plans.pairs import top_recommendations
from rankloom.session import scratch_path
from rankloom.sources.dated import filter_days, read_days, snapshot
from rankloom.sources.delimited import (
    ordinal_dictionary,
    pick_columns,
    positional_schema,
    read_delimited,
    read_headed,
    read_neighbours,
)
from rankloom.sources.interactions import read_user_log
from rankloom.sources.sinks import joined_line, write_replacing, write_text
from rankloom.sources.tfrecord import coerce, read_tfrecords, read_type, write_tfrecords


@query(
    "scan_text_split",
    """SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, CAST(o_custkey AS VARCHAR) AS custkey,
              o_orderstatus AS status, o_orderpriority AS priority FROM orders""",
)
def scan_text_split(spark, sf_dir):
    path = scratch_path(spark, "lines")
    orders = table(spark, sf_dir, "orders")
    write_text(orders, joined_line(["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"], "|"), path)
    return read_delimited(spark, path, "|", ["orderkey", "custkey", "status", "priority"])


@query(
    "scan_text_arity_filter",
    """SELECT CAST(l_partkey AS VARCHAR) AS item1, CAST(l_suppkey AS VARCHAR) AS item2,
              CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS label
       FROM lineitem WHERE l_linenumber % 3 = 0""",
)
def scan_text_arity_filter(spark, sf_dir):
    path = scratch_path(spark, "pairs")
    label = F.when(F.col("l_returnflag") == "R", "1").otherwise("0")
    full = joined_line(["l_partkey", "l_suppkey", label], "|")
    kind = F.col("l_linenumber") % 3
    line = F.when(kind == 0, full).when(kind == 1, joined_line(["l_partkey", label], "|")).otherwise(
        F.concat(full, F.lit("|x"))
    )
    write_text(table(spark, sf_dir, "lineitem"), line, path)
    return read_delimited(spark, path, "|", ["item1", "item2", "label"], bad="drop")


@query(
    "scan_user_log",
    """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS cid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                         date_trunc('second', ts) AS ts, event_id FROM events),
       x AS (SELECT cid, event_id, 0 AS tag, i AS j, k + i AS item, ts + to_seconds(i) AS t
             FROM (SELECT *, unnest(range(0, event_id % 3)) AS i FROM e)
             UNION ALL SELECT cid, event_id, 1, i, k + i, ts + to_seconds(60 + i)
             FROM (SELECT *, unnest(range(0, (event_id // 3) % 2)) AS i FROM e)
             UNION ALL SELECT cid, event_id, 2, i, k + i, ts + to_seconds(120 + i)
             FROM (SELECT *, unnest(range(0, (event_id // 6) % 2)) AS i FROM e))
       SELECT cid || ':' || event_id AS cid, CAST(item AS VARCHAR) AS pid,
              strftime(t, '%Y-%m-%d %H:%M:%S') AS ts, tag,
              CAST(row_number() OVER (PARTITION BY event_id ORDER BY tag, j) - 1 AS INTEGER) AS seq FROM x""",
)
def scan_user_log(spark, sf_dir):
    """Seven-field lines with lists of 0 to 2 entries, read back in long form."""
    events = table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.substring_index(F.col("ts").cast("string"), ".", 1).cast("timestamp_ntz").alias("t"),
    )

    def steps(n):
        return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<bigint>"))

    def lists(n, shift):
        items = F.transform(steps(n), lambda i: (F.col("k") + i - 1).cast("string"))
        times = F.transform(
            steps(n),
            lambda i: F.concat(
                (F.col("t") + F.make_dt_interval(secs=(i + (shift - 1)).cast("decimal(18,6)"))).cast("string"), F.lit(".0")
            ),
        )
        return F.array_join(items, ","), F.array_join(times, ",")

    n = F.col("event_id")
    imp = lists(n % 3, 0)
    click = lists(F.floor(n / 3) % 2, 60)
    order = lists(F.floor(n / 6) % 2, 120)
    line = F.concat_ws("|", F.concat_ws(":", "user_id", "event_id"), *imp, *order, *click)
    path = scratch_path(spark, "userlog")
    write_text(events, line, path)
    return read_user_log(spark, path).select(
        "cid", "pid", F.col("ts").cast("string").alias("ts"), "tag", "seq"
    )


@query(
    "scan_header_drop",
    """SELECT CAST(c_custkey AS VARCHAR) AS pid, c_name AS name, c_mktsegment AS segment FROM customer""",
)
def scan_header_drop(spark, sf_dir):
    path = scratch_path(spark, "headed")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("pid"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    rows.write.option("header", True).option("sep", "|").csv(path)
    names = [f.name for f in positional_schema("pid|name|segment").fields]
    return read_headed(spark, path, "|", names, key="pid")


@query(
    "scan_pick_columns",
    """SELECT CAST(p_partkey AS VARCHAR) AS pid,
              CASE WHEN p_size < 10 THEN 0.0::DOUBLE ELSE p_retailprice END AS c3, CAST(p_size AS DOUBLE) AS c4
       FROM part""",
)
def scan_pick_columns(spark, sf_dir):
    path = scratch_path(spark, "profile")
    price = F.when(F.col("p_size") >= 10, F.col("p_retailprice"))
    write_text(
        table(spark, sf_dir, "part"), joined_line([F.lit("2019-09-01"), "p_partkey", "p_name", price, "p_size"], "|"), path
    )
    return pick_columns(spark.read.text(path), "|", 1, [3, 4], missing=0.0)


@query(
    "scan_date_range",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS date, CAST(o_orderkey AS VARCHAR) AS value
       FROM orders WHERE date_trunc('month', o_orderdate) BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'""",
)
def scan_date_range(spark, sf_dir):
    path = scratch_path(spark, "dated")
    orders = table(spark, sf_dir, "orders").select(
        F.trunc("o_orderdate", "month").alias("date"), F.col("o_orderkey").cast("string").alias("value")
    )
    orders.write.partitionBy("date").text(path)
    dated = spark.read.schema("value string, date date").text(path)
    return filter_days(dated, "1996-03-01:1997-02-28").select(F.col("date").cast("string").alias("date"), "value")


WALK_DAYS = ("2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08")


@query(
    "scan_folder_walk",
    """SELECT CAST(event_id AS VARCHAR) AS value, event_type AS kind FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-06' AND DATE '2024-01-08' AND event_type <> 'view'""",
)
def scan_folder_walk(spark, sf_dir):
    """Plain day folders with nested ones, walked for a range of days; files are picked by their names."""
    path = scratch_path(spark, "days")
    events = table(spark, sf_dir, "events").select("ts", F.col("event_id").cast("string").alias("value"), "event_type")
    for day in WALK_DAYS:
        of_day = events.filter(F.to_date("ts") == F.lit(day).cast("date")).drop("ts")
        of_day.filter("event_type <> 'view'").write.partitionBy("event_type").csv(f"{path}/{day}/clicks")
        of_day.filter("event_type = 'view'").drop("event_type").write.json(f"{path}/{day}/views")
    read = read_days(spark, path, "2024-01-06:2024-01-08", "text", "value string", "*.csv")
    # The kind is the name of the nested folder.
    return read.select("value", F.regexp_extract(F.input_file_name(), "event_type=([^/]+)/", 1).alias("kind"))


@query(
    "snapshot_lag",
    """SELECT event_id, CAST(ts AS DATE)::VARCHAR AS date FROM events
       WHERE CAST(ts AS DATE) = DATE '2024-01-10' - INTERVAL 3 DAY""",
)
def snapshot_lag(spark, sf_dir):
    path = scratch_path(spark, "snapshots")
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("date"))
    write_replacing(events, path, partition=["date"])
    return snapshot(spark.read.parquet(path), "2024-01-10", lag=3).select(
        "event_id", F.col("date").cast("string").alias("date")
    )


@query("scan_csv", "SELECT s_suppkey AS pid, s_nationkey AS match_id, s_acctbal AS score FROM supplier")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal").write.csv(path)
    return spark.read.schema("pid bigint, match_id int, score double").option("mode", "FAILFAST").csv(path)


@query(
    "positional_schema",
    """SELECT p_partkey AS file, CAST(o AS INTEGER) AS ordinal, name FROM (
         SELECT p_partkey, 1 AS o, p_brand AS name FROM part UNION ALL
         SELECT p_partkey, 2, p_type FROM part UNION ALL SELECT p_partkey, 3, p_name FROM part)""",
)
def positional_schema_query(spark, sf_dir):
    """Header lines (one per file) to ordinal -> name rows."""
    heads = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("file"), joined_line(["p_brand", "p_type", "p_name"], "|").alias("value")
    )
    return ordinal_dictionary(heads, keep=["file"])


@query(
    "tfrecord_write",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice > 200000 AS large FROM orders",
)
def tfrecord_write(spark, sf_dir):
    path = scratch_path(spark, "tfrecord")
    orders = table(spark, sf_dir, "orders").withColumn("large", F.col("o_totalprice") > 200000)
    write_tfrecords(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "large"), path)
    return read_tfrecords(spark, path, schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string, large boolean")


@query(
    "tfrecord_read",
    """SELECT vec_id, CAST(label AS BIGINT) AS label, len(embedding) AS dim,
              CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[64] AS DOUBLE) AS last FROM embeddings""",
)
def tfrecord_read(spark, sf_dir):
    """The schema comes from all records."""
    path = scratch_path(spark, "tfrecord")
    write_tfrecords(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), path)
    rows = read_tfrecords(spark, path)
    return rows.select(
        "vec_id",
        "label",
        F.size("embedding").cast("bigint").alias("dim"),
        F.get("embedding", F.lit(0)).alias("first"),
        F.get("embedding", F.lit(63)).alias("last"),
    )


@query(
    "example_schema_infer",
    """SELECT l_orderkey AS orderkey, CAST(l_linenumber AS BIGINT) AS linenumber,
              CAST(CAST(l_extendedprice AS REAL) AS DOUBLE) AS price, l_returnflag AS flag FROM lineitem""",
)
def example_schema_infer(spark, sf_dir):
    """Stored and read-back types of an Example, as casts in the plan."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
    )
    stored = coerce(rows)
    return stored.select(*[F.col(c).cast(read_type(t)).alias(c) for c, t in rows.dtypes])


@query(
    "sink_text",
    """SELECT CAST(l_orderkey AS VARCHAR) || '|' || l_linenumber || ', ' || (l_linenumber + 1) AS value FROM lineitem""",
)
def sink_text(spark, sf_dir):
    path = scratch_path(spark, "text")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.array("l_linenumber", F.col("l_linenumber") + 1).alias("ids")
    )
    write_text(rows, joined_line(["l_orderkey", F.array_join(F.col("ids").cast("array<string>"), ", ")], "|"), path)
    return spark.read.text(path)


@query(
    "sink_overwrite",
    """SELECT o_orderstatus AS status, count(*) AS n FROM orders
       WHERE o_orderstatus <> 'F' OR o_totalprice > 200000 GROUP BY 1""",
)
def sink_overwrite(spark, sf_dir):
    """The second write replaces only the partition it contains."""
    path = scratch_path(spark, "overwrite")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    write_replacing(rows, path, partition=["status"])
    large = rows.filter((F.col("status") == "F") & (F.col("o_totalprice") > 200000))
    write_replacing(large, path, partition=["status"])
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sink_json_lines",
    """WITH s AS (SELECT l_partkey AS pid, l_orderkey * 10 + l_linenumber AS item, l_quantity * l_discount AS score FROM lineitem),
       r AS (SELECT pid, item, row_number() OVER (PARTITION BY pid ORDER BY score DESC, item) AS rn FROM s)
       SELECT CAST(pid AS VARCHAR) AS item_key, count(*) AS n,
              CAST(max(CASE WHEN rn = 1 THEN item END) AS VARCHAR) AS best FROM r WHERE rn <= 200 GROUP BY pid""",
)
def sink_json_lines(spark, sf_dir):
    """JSON lines are written, read back and parsed."""
    path = scratch_path(spark, "json")
    pairs = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("pid"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item"),
        "l_quantity",
        "l_discount",
    )
    recs = top_recommendations(pairs, "pid", "item", F.col("l_quantity") * F.col("l_discount"))
    write_text(recs, F.col("json"), path)
    schema = "item_key struct<s: string>, info struct<l: array<struct<n: string>>>"
    lines = spark.read.text(path).select(F.from_json("value", schema).alias("j"))
    return lines.select(
        F.col("j.item_key.s").alias("item_key"),
        F.size("j.info.l").cast("bigint").alias("n"),
        F.get("j.info.l", F.lit(0))["n"].alias("best"),
    )


@query(
    "recs_from_neighbours",
    """WITH s AS (SELECT CAST(l_suppkey AS INTEGER) AS pid, CAST(l_partkey AS INTEGER) AS item, l_orderkey, l_linenumber, l_quantity * l_discount AS score FROM lineitem),
       r AS (SELECT pid, item, row_number() OVER (PARTITION BY pid ORDER BY score DESC, item) AS rn FROM s)
       SELECT CAST(pid AS BIGINT) AS pid, '{"item_key":{"s":"' || pid || '"},"info":{"l":[' || string_agg('{"n":"' || item || '"}', ',' ORDER BY rn) || ']}}' AS json
       FROM r WHERE rn <= 200 GROUP BY pid""",
)
def recs_from_neighbours(spark, sf_dir):
    """Bracketed CSV neighbour lists to one JSON line per item."""
    path = scratch_path(spark, "neighbours")
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("("), F.col("l_suppkey").cast("string")),
        F.concat(F.lit(" "), F.col("l_partkey").cast("string")),
        F.concat(F.lit(" "), F.col("l_quantity").cast("string")),
        F.concat(F.lit(" "), F.col("l_discount").cast("string"), F.lit(")")),
    )
    rows.write.csv(path)
    pairs = read_neighbours(spark, path)
    recs = top_recommendations(pairs, "pid", "match_id", F.col("score"))
    return recs.select(F.col("pid").cast("bigint").alias("pid"), "json")
