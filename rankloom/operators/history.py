"""Point-in-time histories: the last ``n`` earlier items of each stream.

The naive form collects a growing list per row.  Here every source row keeps
only the last ``n`` items of its own stream (a sliding frame of ``n`` rows) and
each target picks up the latest such list before it, so the work per row is
bounded by ``n``.

A key with very many rows (one user with a third of the log) is cut into
ordered chunks that are processed in parallel; the last ``n`` items of the
chunks before are carried in.

Without a limit (``n=None``) no row keeps a list.  A key (or a chunk of a busy
one) has one sorted array of its sources, and a target takes what lies before
it when its own row is made; so memory grows with the events of a key, not with
their square, and only the result holds lists per target.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.arrays import tail
from rankloom.operators.ordering import _range_sorted
from rankloom.operators.skew import broadcast_if_small, hot_keys
from rankloom.session import materialize

MAX_ROWS_PER_KEY = 1_000_000


def _events(targets, sources, keys, order, item, stream):
    """Targets and sources in one relation; a target sorts before its own source row."""
    probe = targets.select(
        *keys,
        *order,
        F.lit(0).alias("_src"),
        F.lit(None).cast("string").alias("_stream"),
        F.lit(None).cast(sources.schema[item].dataType).alias("_item"),
        F.struct(*targets.columns).alias("_target"),
    )
    source = sources.select(
        *keys,
        *order,
        F.lit(1).alias("_src"),
        F.col(stream).cast("string").alias("_stream"),
        F.col(item).alias("_item"),
        F.lit(None).cast(probe.schema["_target"].dataType).alias("_target"),
    )
    return probe.unionByName(source)


def _with_tails(events: DataFrame, part: Sequence[str], order: Sequence[str], streams, n: int) -> DataFrame:
    """Latest list of each stream at or before every row (targets are no source)."""
    sort = [*order, "_src"]
    own = Window.partitionBy(*part, "_stream").orderBy(*sort).rowsBetween(-(n - 1), Window.currentRow)
    seen = Window.partitionBy(*part).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    listed = events.withColumn("_tail", F.when(F.col("_src") == 1, F.collect_list("_item").over(own)))
    return listed.withColumns(
        {
            f"_last_{s}": F.last(F.when(F.col("_stream") == s, F.col("_tail")), ignorenulls=True).over(seen)
            for s in streams
        }
    )


def _finish(rows: DataFrame, streams, n: int, carried: bool) -> DataFrame:
    item_array = rows.schema["_tail"].dataType
    empty = F.array().cast(item_array)

    def full(s):
        mine = F.coalesce(F.col(f"_last_{s}"), empty)
        return tail(F.concat(F.coalesce(F.col(f"_carry_{s}"), empty), mine), n) if carried else mine

    return rows.filter(F.col("_src") == 0).select("_target.*", *[full(s).alias(f"{s}_history") for s in streams])


def _matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys where NULL equals NULL: rows without a user are one history like any other."""
    side = right.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_on_{k}"))
    joined = left.join(side, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_on_{k}" for k in keys])


def _plain(events, keys, order, streams, n):
    # One shuffle on the key serves both windows.
    return _finish(_with_tails(events.repartition(*keys), keys, order, streams, n), streams, n, carried=False)


def _chunked(events, keys, order, streams, n, total_rows, max_rows):
    parts = max(1, math.ceil(total_rows / max_rows))
    chunks = _range_sorted(events, [*keys, *order, "_src"], parts)
    part = [*keys, "_chunk"]
    rows = _with_tails(chunks.repartition(*part), part, order, streams, n)

    # What a chunk hands on: its last n items per stream, with their order.
    handed = (
        rows.filter(F.col("_src") == 1)
        .groupBy(*part, "_stream")
        .agg(F.max_by("_tail", "_row").alias("_tail"))
        .select(*part, "_stream", F.posexplode("_tail").alias("_at", "_item"))
    )
    starts = chunks.select(*part).distinct().withColumn("_at", F.lit(-1))
    # At most n items per stream and chunk; if even that is a lot for one key,
    # it is cut into chunks in turn.
    carry_rows = parts * (n * len(streams) + 1)
    place = ["_step", "_at"]
    starts, handed = (t.withColumnRenamed("_chunk", "_step") for t in (starts, handed))
    passed_on = _events(starts, handed, list(keys), place, "_item", "_stream")
    if max_rows < carry_rows < total_rows // 2:
        carry = _chunked(materialize(passed_on), keys, place, streams, n, carry_rows, max_rows)
    else:
        carry = _plain(passed_on, keys, place, streams, n)
    carry = carry.select(
        *keys, F.col("_step").alias("_chunk"), *[F.col(f"{s}_history").alias(f"_carry_{s}") for s in streams]
    )
    return _finish(_matched(rows, broadcast_if_small(materialize(carry)), part, "left"), streams, n, carried=True)


def _sources_of(order: Sequence[str]) -> Column:
    """Aggregate of a group: its sources in order."""
    at = F.struct(*order)
    source = F.when(F.col("_src") == 1, F.struct(at.alias("at"), F.col("_stream").alias("stream"), F.col("_item").alias("item")))
    return F.array_sort(F.collect_list(source)).alias("_sources")


def _before(stream: str):
    """Items of a stream among ``_sources`` strictly before ``_at``."""
    mine = F.filter("_sources", lambda e: (e["stream"] == stream) & (e["at"] < F.col("_at")))
    return F.transform(mine, lambda e: e["item"])


def _all_before(events: DataFrame, keys: Sequence[str], order: Sequence[str], streams) -> DataFrame:
    """Whole histories of keys with a bounded number of rows: one shuffle, one array per key."""
    target = F.when(F.col("_src") == 0, F.struct(F.struct(*order).alias("at"), F.col("_target").alias("row")))
    grouped = events.groupBy(*keys).agg(_sources_of(order), F.collect_list(target).alias("_targets"))
    each = grouped.select("_sources", F.explode("_targets").alias("_t"))
    each = each.select("_sources", F.col("_t.at").alias("_at"), F.col("_t.row").alias("_target"))
    return each.select("_target.*", *[_before(s).alias(f"{s}_history") for s in streams])


def _all_before_chunked(events: DataFrame, keys: Sequence[str], order: Sequence[str], streams, total_rows: int, max_rows: int) -> DataFrame:
    """Whole histories of busy keys: arrays by chunk, joined piece by piece to the targets behind them."""
    chunks = _range_sorted(events, [*keys, *order, "_src"], max(1, math.ceil(total_rows / max_rows)))
    part = [*keys, "_chunk"]
    lists = materialize(chunks.filter("_src = 1").groupBy(*part).agg(_sources_of(order)))
    targets = chunks.filter("_src = 0").select(*keys, F.col("_chunk").alias("_own"), F.col("_row").alias("_id"), F.struct(*order).alias("_at"), "_target")
    pieces = targets.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), "_own")))
    pieces = pieces.withColumn("_target", F.when(F.col("_chunk") == F.col("_own"), F.col("_target")))
    found = _matched(pieces, lists, part, "left").select("_id", "_chunk", "_target", *[_before(s).alias(f"_of_{s}") for s in streams])
    whole = found.groupBy("_id").agg(
        F.first("_target", ignorenulls=True).alias("_target"),
        *[F.array_sort(F.collect_list(F.struct("_chunk", F.col(f"_of_{s}").alias("items")))).alias(f"_of_{s}") for s in streams],
    )
    empty = F.array().cast(found.schema[f"_of_{streams[0]}"].dataType) if streams else None
    joined = [F.flatten(F.transform(f"_of_{s}", lambda e: F.coalesce(e["items"], empty))).alias(f"{s}_history") for s in streams]
    return whole.select("_target.*", *joined)


def last_n_history(
    targets: DataFrame,
    sources: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    item: str,
    stream: str,
    streams: Sequence[str],
    n: int | None = 20,
    max_rows_per_key: int = MAX_ROWS_PER_KEY,
    few_targets: bool = False,
) -> DataFrame:
    """Add ``<s>_history`` for every stream: the last ``n`` items strictly before, or all of them (``n=None``).

    "Before" is by ``order``, which should end in a unique column; a source
    that ties with the target on all of it does not count as earlier.
    ``few_targets`` says that targets are bounded per key (sampled), so only
    sources are counted to find keys that need chunks.  Rows with a NULL key
    share one history, which is cut into chunks like that of any busy user.
    """
    keys, order = list(keys), list(order)
    used = sources.filter(F.col(stream).isin(*streams))
    events = _events(targets, used, keys, order, item, stream)
    hot = hot_keys(used if few_targets else events, keys, max_rows_per_key)
    total_hot = hot.agg(F.sum("n_rows")).first()[0]
    regular_of = (lambda e: _all_before(e, keys, order, streams)) if n is None else (lambda e: _plain(e, keys, order, streams, n))
    if not total_hot:
        return regular_of(events)
    hot_side = broadcast_if_small(materialize(hot.select(*keys)))
    regular = regular_of(_matched(events, hot_side, keys, "left_anti"))
    busy = _matched(events, hot_side, keys, "left_semi")
    if n is None:
        heavy = _all_before_chunked(busy, keys, order, streams, total_hot, max_rows_per_key)
    else:
        heavy = _chunked(busy, keys, order, streams, n, total_hot, max_rows_per_key)
    return regular.unionByName(heavy)


def cross_tokens(df: DataFrame, target: str, history: str, out: str) -> DataFrame:
    """``target,item`` for every item of a history."""
    return df.withColumn(out, F.transform(F.col(history), lambda h: F.concat(F.col(target), F.lit(","), h)))
