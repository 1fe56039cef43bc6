"""Positions and running totals along a total order, without a single-task sort.

A window without PARTITION BY moves every row to one task.  Here the rows are
range-partitioned and sorted in parallel, each partition is numbered and summed
in its sorted pass, and the partitions' totals (one row per partition) shift
the local numbers into global ones.  Single ranks need no sort at all: they are
found by counting digits of an order-preserving key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.operators.skew import broadcast_if_small
from rankloom.session import materialize

# Parts of a key that are ranked by themselves where Spark does not cut on the map side.
SALTS_WITHOUT_CUT = 32
_ROWS_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _scan(batches: Iterator[pa.RecordBatch], by: Sequence[int], sums: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """Add the local position and running sums per group to the sorted rows of one partition."""
    last: pa.RecordBatch | None = None
    count, totals = 0, [0] * len(sums)  # of the group that the previous batch ended in
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        begins = np.zeros(n, bool)
        for at in by:
            column = batch.column(at)
            known = column if last is None else pa.concat_arrays([last.column(at), column])
            code = known.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            begins |= np.diff(code, prepend=code[:1])[-n:] != 0
        row = np.arange(n)
        start = np.maximum.accumulate(np.where(begins, row, -1))
        local = np.where(start < 0, row + count, row - start) + 1
        runs = []
        for k, at in enumerate(sums):
            x = batch.column(at).fill_null(0).to_numpy(zero_copy_only=False)
            runs.append(_running(x, begins, totals[k]))
            totals[k] = runs[-1][-1]
        last, count = batch.slice(n - 1), int(local[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(local), *[pa.array(r) for r in runs]],
            [*batch.schema.names, "_local", *[f"_run{batch.schema.names[at]}" for at in sums]],
        )


def _running(x: np.ndarray, begins: np.ndarray, carried) -> np.ndarray:
    """Inclusive sums that start anew where ``begins``; ``carried`` belongs to the rows before the first of these."""
    if x.dtype == np.int64:
        # Checked, and exact when the sum before a group is taken off again.
        up = pc.cumulative_sum_checked(pa.array(x)).to_numpy()
        base = np.concatenate([[0], up[:-1]])[np.maximum.accumulate(np.where(begins, np.arange(len(x)), 0))]
        open_ = np.cumsum(begins) == 0
        return np.where(open_, pc.add_checked(pa.array(up), int(carried)).to_numpy() if open_.any() else 0, up - base)
    out = np.empty(len(x))
    cuts = [0, *np.flatnonzero(begins).tolist(), len(x)]
    for i, (begin, end) in enumerate(zip(cuts, cuts[1:])):
        if end > begin:
            piece = x[begin:end].copy()
            piece[0] += carried if i == 0 else 0.0
            out[begin:end] = np.cumsum(piece)
    return out


def _addend(df: DataFrame, expr: Column) -> Column:
    kind = df.select(expr.alias("x")).schema["x"].dataType
    if isinstance(kind, T.IntegralType):
        return expr.cast("bigint")
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return expr.cast("double")
    raise ValueError(f"running sums are of integers or floating-point numbers, not {kind.simpleString()}")


def _range_numbered(df: DataFrame, keys: Sequence[Column | str], parts: int | None) -> DataFrame:
    spread = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    numbered = spread.sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    return numbered.withColumn("_chunk", F.shiftright("_row", _ROWS_BITS))


def _range_sorted(df: DataFrame, keys: Sequence[Column | str], parts: int | None) -> DataFrame:
    # Range bounds come from a sample, so a second evaluation could cut the
    # rows differently.  The written table is cut once.
    return materialize(_range_numbered(df, keys, parts))


def _range_scanned(df: DataFrame, by: Sequence[str], order: Sequence[Column], addends: Sequence[str], parts: int | None) -> DataFrame:
    """The same by group and order, with positions and sums inside the range."""
    ranged = _range_numbered(df, [*by, *order], parts)
    if not by and not addends:
        return materialize(ranged.withColumn("_local", F.col("_row") - F.shiftleft("_chunk", _ROWS_BITS) + 1))
    names = ranged.columns
    added = [T.StructField("_local", T.LongType()), *[T.StructField(f"_run{a}", ranged.schema[a].dataType) for a in addends]]
    at, of = [names.index(b) for b in by], [names.index(a) for a in addends]
    return materialize(ranged.mapInArrow(lambda batches: _scan(batches, at, of), T.StructType([*ranged.schema.fields, *added])))


def ordered_prefix(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    sums: dict[str, Column] | None = None,
    position: str = "position",
    parts: int | None = None,
    group_totals: bool = False,
) -> DataFrame:
    """Add the 1-based ``position`` and inclusive running ``sums`` per group.

    ``order`` must be a total order within a group.  ``sums`` maps an output
    column to the expression that is accumulated, an integer or floating-point
    number (NULL counts as 0).  ``group_totals`` also adds the sums of the whole
    group as ``total_<name>``.  The rows are exchanged once, by range.
    """
    by, sums = list(by), dict(sums or {})
    addends = {f"_add_{name}": _addend(df, expr) for name, expr in sums.items()}
    ranged = _range_scanned(df.withColumns(addends) if addends else df, by, order, list(addends), parts)

    totals = ranged.groupBy(*by, "_chunk").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(a).alias(f"_sum{a}") for a in addends]
    )
    # At most one row per (group, chunk); with few groups this is a handful of
    # rows per partition, so its own window stays small.
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.col("_chunk").alias("_at"),
        F.sum("_n").over(earlier).alias("_n_before"),
        *[F.sum(f"_sum{a}").over(earlier).alias(f"_before{a}") for a in addends],
    )
    # Only the first group of a chunk can have rows in an earlier chunk, so at
    # most one shift per chunk is left: bounded by the partition count.
    shifts = shifts.filter(F.col("_n_before").isNotNull())
    same = F.col("_chunk") == F.col("_at")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_by_{b}"))

    joined = ranged.join(F.broadcast(shifts), same, "left")
    whole = []
    if group_totals:
        whole = [f"total_{name}" for name in sums]
        per_group = totals.groupBy(*by).agg(
            *[F.sum(f"_sum_add_{name}").alias(f"total_{name}") for name in sums]
        )
        if by:
            joined = joined.join(broadcast_if_small(per_group), by)
        else:
            joined = joined.withColumns({w: per_group.select(w).scalar() for w in whole})
    return joined.select(
        *[F.col(c) for c in df.columns],
        (F.col("_local") + F.coalesce("_n_before", F.lit(0))).alias(position),
        *[
            (F.col(f"_run_add_{name}") + F.coalesce(f"_before_add_{name}", F.lit(0))).alias(name)
            for name in sums
        ],
        *whole,
    )


def take_at_positions(df: DataFrame, order: Sequence[Column], positions: Sequence[int], column: str = "position"):
    """Rows whose 0-based global index is in ``positions``."""
    placed = ordered_prefix(df, order, position=column)
    return placed.withColumn(column, F.col(column) - 1).filter(F.col(column).isin([int(p) for p in positions]))


def shard_rows(df: DataFrame, order: Sequence[Column], shards: int, index: int) -> DataFrame:
    """Every ``shards``-th row in order, starting at ``index``."""
    placed = ordered_prefix(df, order, position="_pos")
    return placed.filter((F.col("_pos") - 1) % shards == index).drop("_pos")


def top_k_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank", salts: int = 1
) -> DataFrame:
    """First ``k`` rows of each key.

    Spark keeps only ``k`` rows per key and map task before the shuffle
    (WindowGroupLimit), so a hot key arrives as ``k`` rows per map task.  With
    ``salts`` > 1 those are cut once more in parallel before the last step;
    worth it when ``k`` times the number of map tasks is large.  They are used
    as well when ``k`` is above the session's limit for the cut on the map side.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit and salts == 1:
        salts = SALTS_WITHOUT_CUT
    if salts > 1:
        pick = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
            .withColumn("_cut", F.row_number().over(pick))
            .filter(F.col("_cut") <= k)
            .drop("_cut", "_salt")
        )
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
        F.col(rank) <= k
    )


def order_keys(values: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of doubles: NaN is one value above all others, both zeros are one."""
    values = np.where(np.isnan(values), np.nan, values) + 0.0
    bits = values.view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(2**63 - 1))


def key_value(key: int) -> float:
    """The double of an order key."""
    bits = np.int64(key)
    return float((bits ^ ((bits >> np.int64(63)) & np.int64(2**63 - 1))).view(np.float64))


# Bits of the key that a round of the selection fixes.
DIGIT = 16


def _digits(batches: Iterator[pa.RecordBatch], wanted: Sequence[tuple[int, int, int]], shift: int) -> Iterator[pa.RecordBatch]:
    """Counts of the next digit: (field, prefix) pairs in ``wanted`` as (number, column, prefix) to rows of counts.

    One row per pair, digit and batch with the number of values and the
    smallest and largest key.
    """
    for batch in batches:
        out = []
        for column in {c for _, c, _ in wanted}:
            keys = np.sort(order_keys(batch.column(column).drop_null().to_numpy()))
            for number, _, prefix in (w for w in wanted if w[1] == column):
                if shift < 64 - DIGIT:
                    low = prefix << (shift + DIGIT)
                    begin, end = np.searchsorted(keys, low), np.searchsorted(keys, low + (1 << (shift + DIGIT)) - 1, side="right")
                    mine = keys[begin:end]
                else:
                    mine = keys
                if len(mine):
                    digit = mine >> shift
                    cuts = np.flatnonzero(np.diff(digit, prepend=digit[0] - 1))
                    ends = np.append(cuts[1:], len(mine))
                    out.append((np.full(len(cuts), number), digit[cuts], ends - cuts, mine[cuts], mine[ends - 1]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["number", "digit", "n", "low", "high"])


def ranked_values(df: DataFrame, columns: Sequence[str], ranks: Callable[[int], Sequence[int]]) -> dict[str, list[float]]:
    """The values of the 0-based ranks ``ranks(n)`` of every column with n > 0 non-missing values.

    Selection instead of a sort: a round counts the values by the next 16 bits
    of an order-preserving key, for all columns at once, and only within the
    prefixes that hold a wanted rank.  A rank is settled when its bucket holds
    one value, after four rounds at the latest.  A round shuffles at most 65,536
    counts per prefix, whatever the number of rows; the driver sees one row per
    wanted rank.  ``df`` is read once per round and must give the same rows.
    """
    columns = list(columns)
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    found: dict[int, dict[int, float]] = {}
    want: dict[int, list[int]] = {}  # column -> ranks
    open_: dict[tuple[int, int], dict[int, int]] = {(i, 0): {} for i in range(len(columns))}  # (column, prefix) -> rank: rank inside
    for turn, shift in enumerate(range(64 - DIGIT, -1, -DIGIT)):
        numbered = list(open_)
        wanted = [(k, i, prefix) for k, (i, prefix) in enumerate(numbered)]
        schema = "number bigint, digit bigint, n bigint, low bigint, high bigint"
        counts = rows.mapInArrow(lambda batches, w=wanted, s=shift: _digits(batches, w, s), schema)
        counts = counts.groupBy("number", "digit").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        inside = Window.partitionBy("number").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = counts.withColumn("upto", F.sum("n").over(inside))
        if turn == 0:
            upto = materialize(upto)
            for r in upto.groupBy("number").agg(F.max("upto").alias("n")).collect():  # a row per column
                want[r["number"]] = list(ranks(r["n"]))
                open_[numbered[r["number"]]] = {rank: rank for rank in want[r["number"]]}
        asked = [(k, rank, at) for k, pair in enumerate(numbered) for rank, at in open_[pair].items()]
        if not asked:
            break
        side = df.sparkSession.createDataFrame(asked, "k bigint, rank bigint, at bigint")  # a row per wanted rank
        first = F.col("upto") - F.col("n")
        here = (F.col("number") == F.col("k")) & (F.col("at") >= first) & (F.col("at") < F.col("upto"))
        holds = upto.join(F.broadcast(side), here).select("number", "digit", "low", "high", "rank", (F.col("at") - first).alias("at"))
        open_ = {}
        for r in holds.collect():
            column = numbered[r["number"]][0]
            if r["low"] == r["high"]:
                found.setdefault(column, {})[r["rank"]] = key_value(r["low"])
            else:
                open_.setdefault((column, r["digit"]), {})[r["rank"]] = r["at"]
        if not open_:
            break
    return {columns[i]: [found[i][rank] for rank in wanted] for i, wanted in want.items()}


def order_statistics(df: DataFrame, columns: Sequence[str], groups: int) -> DataFrame:
    """Exact ``n//groups``-th and ``(n - n//groups)``-th smallest value per column: ``(field, lo, hi)``.

    Ranks are 0-based over the values that are not NULL and clamped to
    ``n - 1``; a column without one has no row.  NaN is the largest value.
    """

    def ranks(n: int) -> list[int]:
        low = n // groups
        return [min(low, n - 1), min(n - low, n - 1)]

    found = ranked_values(df, columns, ranks)
    return df.sparkSession.createDataFrame([(c, *v) for c, v in found.items()], "field string, lo double, hi double")


def order_statistics_approx(df: DataFrame, columns: Sequence[str], groups: int, accuracy: int = 10000) -> DataFrame:
    """Same output from mergeable quantile sketches: one pass, no sort."""
    share = 1.0 / groups
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("v")) for c in columns])
        ).alias("s")
    ).select("s.field", "s.v")
    return (
        long.filter(F.col("v").isNotNull())
        .groupBy("field")
        .agg(F.percentile_approx("v", [share, 1.0 - share], accuracy).alias("q"))
        .select("field", F.get("q", F.lit(0)).alias("lo"), F.get("q", F.lit(1)).alias("hi"))
    )
