"""Replace tokens by vocabulary ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.arrays import pad_to, sort_by_index
from rankloom.operators.joins import dimension_join
from rankloom.operators.skew import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast


def encode_token(df: DataFrame, vocab: DataFrame, token: str, out: str, default: int = 0, **sizes) -> DataFrame:
    """Id of a scalar token; a token outside the vocabulary gets ``default``."""
    table = vocab.select(F.col("token").alias("_token"), F.col("id").alias("_id"))
    found = dimension_join(df, table, [(token, "_token")], **sizes)
    keep = [c for c in df.columns if c != out]
    return found.select(*keep, F.coalesce("_id", F.lit(default).cast("bigint")).alias(out))


def _broadcast_fields(vocab: DataFrame, fields: set[str], max_rows: int) -> set[str]:
    """Fields whose vocabularies fit into a broadcast together, smallest first."""
    measured = vocab.filter(F.col("field").isin(*fields)).groupBy("field")
    sizes = measured.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("token") + 16).alias("b"))
    found = {r["field"]: (r["n"], r["b"]) for r in sizes.collect()}  # one row per field
    max_bytes = BROADCAST_BYTES
    chosen: set[str] = set()
    for name in sorted(fields, key=lambda f: found.get(f, (0, 0))):
        rows, size = found.get(name, (0, 0))
        if rows > max_rows or size > max_bytes:
            break
        max_rows, max_bytes = max_rows - rows, max_bytes - size
        chosen.add(name)
    return chosen


def encode_lists(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    lists: dict[str, str | None],
    scalars: dict[str, str | None] | None = None,
    default: int = 0,
    drop_empty: bool = False,
    max_rows: int = BROADCAST_ROWS,
    **sizes,
) -> DataFrame:
    """Encode list columns (and scalar columns) with one regrouping.

    ``lists`` and ``scalars`` map a column to the vocabulary field it belongs
    to, or to None for a vocabulary without a ``field`` column.  Every token of
    every column becomes one row; fields with small vocabularies are looked up
    by broadcast, only the tokens of large ones are shuffled; and the rows of a
    sample come back together by ``key`` (unique per row).  The other columns
    travel on one anchor row per sample, which also keeps samples whose lists
    are empty or NULL; a NULL list comes back empty.  ``drop_empty`` removes
    those samples.
    """
    scalars = dict(scalars or {})
    slots = {**lists, **scalars}
    fields = {f for f in slots.values() if f is not None}
    if drop_empty:
        for name in lists:
            df = df.filter(F.size(name) > 0)
    rest = [c for c in df.columns if c not in slots and c != key]
    payload = F.struct(*rest) if rest else F.struct(F.lit(1).alias("_one"))
    payload_type = df.select(payload.alias("p")).schema["p"].dataType

    def entry(slot: str, pos: Column, field: str | None, token: Column) -> Column:
        return F.struct(
            F.lit(slot).alias("slot"), pos.alias("pos"), F.lit(field).cast("string").alias("field"), token.alias("token")
        )

    def entries(slot: str) -> Column:
        if slot in scalars:
            return F.array(entry(slot, F.lit(0), slots[slot], F.col(slot).cast("string")))
        rows = F.transform(slot, lambda t, i: entry(slot, i, slots[slot], t.cast("string")))
        return F.filter(F.coalesce(rows, none(slot)), lambda e: e["pos"] >= 0)

    def none(slot: str) -> Column:
        """Stands for a NULL list, which would take the other lists of its sample with it."""
        return F.array(entry(slot, F.lit(-1), slots[slot], F.lit(None).cast("string")))

    def token_rows(names: Sequence[str], anchored: bool) -> DataFrame:
        parts = [entries(n) for n in names]
        if anchored:
            parts.insert(0, F.array(entry("", F.lit(0), None, F.lit(None).cast("string"))))
        exploded = df.select(key, payload.alias("_row"), F.explode(F.concat(*parts)).alias("e"))
        own = F.when(F.col("e.slot") == "", F.col("_row")) if anchored else F.lit(None)
        return exploded.select(key, own.cast(payload_type).alias("_row"), "e.slot", "e.pos", "e.field", "e.token")

    on = [("field", "_field"), ("token", "_token")] if fields else [("token", "_token")]
    tagged = [F.col("field").alias("_field")] if fields else []
    table = vocab.select(*tagged, F.col("token").alias("_token"), F.col("id").alias("_id"))
    if fields:
        near = _broadcast_fields(vocab, fields, max_rows)
    else:
        near = {None} if fits_broadcast(vocab, max_rows) else set()
    small = [n for n, f in slots.items() if f in near or (f is None and fields)]
    large = [n for n in slots if n not in small]
    side = table.filter(F.col("_field").isin(*near)) if fields else table
    found = dimension_join(token_rows(small, anchored=True), side, on, fits=True) if small or fields else None
    if large:
        far = table.filter(~F.col("_field").isin(*near)) if near and fields else table
        looked_up = dimension_join(token_rows(large, anchored=found is None), far, on, fits=False, **sizes)
        found = looked_up if found is None else found.unionByName(looked_up)
    found = found.withColumn("_id", F.coalesce("_id", F.lit(default).cast("bigint")))

    def column(name: str) -> Column:
        mine = F.col("slot") == name
        if name in scalars:
            return F.max(F.when(mine, F.col("_id"))).alias(name)
        listed = F.collect_list(F.when(mine, F.struct("pos", F.col("_id").alias("item"))))
        return sort_by_index(listed).alias(name)

    grouped = found.groupBy(key).agg(F.first("_row", ignorenulls=True).alias("_row"), *[column(name) for name in slots])
    return grouped.select(*[F.col(f"_row.{c}") if c in rest else F.col(c) for c in df.columns])


def encode_with_rules(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    column: str,
    num: int,
    fill: str = "",
    default: int = 0,
    tail: int = 0,
    surplus: str = "raise",
) -> DataFrame:
    """List encoding with per-feature values: blank -> ``fill``, miss -> ``default``, padding -> ``tail``.

    A list of more than ``num`` values is an error, unless ``surplus="cut"``.
    """
    filled = df.withColumn(column, F.transform(column, lambda t: F.when(t == "", F.lit(fill)).otherwise(t)))
    ids = encode_lists(filled, vocab, key, {column: None}, default=default)
    return ids.withColumn(column, pad_to(F.col(column), num, F.lit(tail).cast("bigint"), surplus))


def outside_message(col: Column, size: int) -> Column:
    return F.concat(F.lit(f"id outside 0..{size - 1}: "), F.coalesce(col.cast("string"), F.lit("NULL")))


def tabled_id(col: Column, size: int) -> Column:
    """An id that is already an integer; raises outside ``0 <= id < size``."""
    value = col.cast("bigint")
    return F.when((value >= 0) & (value < size), value).otherwise(F.raise_error(outside_message(value, size)))


def onehot_positions(df: DataFrame, key: Sequence[str], ids: str, depth: int) -> DataFrame:
    """One-hot vectors in sparse form: ``(key..., position, id)`` of the ones."""
    return (
        df.select(*key, F.posexplode(ids).alias("position", "id"))
        .filter((F.col("id") >= 0) & (F.col("id") < depth))
    )


def onehot(ids: Column, depth: int) -> Column:
    """Dense one-hot vector per position of a short id list."""
    return F.transform(ids, lambda i: F.transform(F.sequence(F.lit(0), F.lit(depth - 1)), lambda d: (d == i).cast("double")))
