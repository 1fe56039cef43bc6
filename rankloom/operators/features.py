"""Config-driven feature encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.arrays import pad_to, reduce_values, value_counts
from rankloom.operators.encode import encode_lists, outside_message, tabled_id
from rankloom.operators.vectors import vector_sums


@dataclass(frozen=True)
class FeatureSpec:
    """One feature: where it comes from and how a ranker sees it.

    ``num`` values per row, or with ``num < 0`` as many as the longest row of
    the table has; ``combiner`` other than ``none`` merges them into one.
    ``fill`` replaces a blank token, ``default`` is the id of an unknown token,
    ``tail`` pads short lists; without one, categories are padded with the size
    of their table, which is no id, and numbers with 0.  ``same``: all values
    of a numeric field share one vector, else each has its own.
    """

    name: str
    kind: str  # category | numeric
    column: str | None = None
    transform: str | None = None  # vocabulary_list | tabled
    style: tuple[str, ...] = ("value",)  # onehot, embedding, value
    num: int = 1
    combiner: str = "none"
    same: bool = True
    embed_dim: int | None = None
    size: int | None = None
    fill: str = ""
    default: int = 0
    tail: int | None = None
    groups: tuple[str, ...] = ()
    ignore: bool = False

    def __post_init__(self) -> None:
        if self.kind not in ("category", "numeric"):
            raise ValueError(f"{self.name}: kind must be category or numeric")
        if self.kind == "category" and self.transform not in ("vocabulary_list", "tabled"):
            raise ValueError(f"{self.name}: a category needs vocabulary_list or tabled")
        if self.num == 0:
            raise ValueError(f"{self.name}: num must not be 0")
        if self.transform == "tabled" and not self.size:
            raise ValueError(f"{self.name}: tabled needs a size")

    @classmethod
    def from_config(cls, name: str, record: Mapping) -> "FeatureSpec":
        """One record of a feature configuration.

        ``{type, transform, style: [..], multi: {num, same, combiner},
        parameter: {name, embed_dim, default, fill, tail, size}, group: [..], ignore}``
        """
        multi, parameter = record.get("multi") or {}, record.get("parameter") or {}
        style = record.get("style") or ()
        return cls(
            name=name,
            kind=record["type"],
            column=parameter.get("column"),
            transform=record.get("transform"),
            style=(style,) if isinstance(style, str) else tuple(style),
            num=multi.get("num", 1),
            combiner=multi.get("combiner", "none"),
            same=multi.get("same", True),
            embed_dim=parameter.get("embed_dim"),
            size=parameter.get("size"),
            fill=str(parameter.get("fill", "")),
            default=parameter.get("default", 0),
            tail=parameter.get("tail"),
            groups=tuple(record.get("group") or ()),
            ignore=bool(record.get("ignore", False)),
        )

    @property
    def source(self) -> str:
        return self.column or self.name

    @property
    def slots(self) -> int:
        """Positions of the feature as far as its record tells."""
        return 1 if self.combiner != "none" else abs(self.num)


@dataclass
class Widths:
    wide: int = 0
    deep: int = 0
    deep_vectors: int = 0
    category_vectors: int = 0
    numeric_vectors: int = 0
    dense: int = 0
    groups: dict[str, list[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Place:
    """Where a feature lies: its ``slots`` positions from ``start`` on, each of ``depth`` indexes (1: a number or a vector)."""

    spec: FeatureSpec
    start: int
    slots: int
    depth: int

    @property
    def end(self) -> int:
        return self.start + self.slots * self.depth


@dataclass(frozen=True)
class FeaturePlan:
    """Layout of the sparse, dense and deep vectors of a list of features, in their order.

    ``sparse``: one-hot categories, a block of the table's size per position.
    ``dense``: numbers, one place per value.  ``deep``: vectors, one per
    position; ``tables`` numbers the rows of their tables, the table of a category having one
    row per id, that of a number one shared row or one per position.
    """

    specs: tuple[FeatureSpec, ...]
    depths: Mapping[str, int]
    slots: Mapping[str, int]
    sparse: tuple[Place, ...]
    dense: tuple[Place, ...]
    deep: tuple[Place, ...]
    tables: Mapping[str, range]

    @property
    def sparse_width(self) -> int:
        return self.sparse[-1].end if self.sparse else 0

    @property
    def dense_width(self) -> int:
        return self.dense[-1].end if self.dense else 0

    @property
    def deep_vectors(self) -> int:
        return self.deep[-1].end if self.deep else 0

    def tail(self, s: FeatureSpec) -> int | float:
        """What fills a short list: by default the size of the table, which is no id, or 0 for numbers."""
        if s.tail is not None:
            return s.tail
        return self.depths[s.name] if s.kind == "category" else 0

    def of_group(self, group: str) -> "FeaturePlan":
        """The plan of the features of one group; tables keep their numbers."""
        chosen = [s for s in self.specs if group in s.groups]
        if not chosen:
            raise ValueError(f"no feature in group {group!r}")
        return _laid_out(chosen, self.depths, self.slots, self.tables)


def specs_from_config(config: Mapping[str, Mapping], columns: Mapping[int, str]) -> list[FeatureSpec]:
    """Specs in file order: ``columns`` maps ordinals to names, as a positional schema does.

    Columns without a record are not features.
    """
    return [FeatureSpec.from_config(columns[i], config[columns[i]]) for i in sorted(columns) if columns[i] in config]


def active(specs: Sequence[FeatureSpec]) -> list[FeatureSpec]:
    return [s for s in specs if not s.ignore]


def _table_rows(s: FeatureSpec, depths: Mapping[str, int], slots: Mapping[str, int]) -> int:
    """Rows of a feature's table of vectors."""
    if s.kind == "category":
        return depths[s.name]
    return 1 if s.same else max(abs(s.num), slots[s.name])


def _laid_out(specs, depths, slots, tables=None) -> FeaturePlan:
    sparse, dense, deep, starts = [], [], [], {}
    ends = {"sparse": 0, "dense": 0, "deep": 0, "table": 0}

    def place(s: FeatureSpec, where: list[Place], name: str, depth: int) -> None:
        where.append(Place(s, ends[name], slots[s.name], depth))
        ends[name] = where[-1].end

    for s in specs:
        if s.kind == "category" and "onehot" in s.style:
            place(s, sparse, "sparse", depths[s.name])
        if s.kind == "numeric" and "value" in s.style:
            place(s, dense, "dense", 1)
        if "embedding" in s.style:
            place(s, deep, "deep", 1)
            starts[s.name] = range(ends["table"], ends["table"] + _table_rows(s, depths, slots))
            ends["table"] = starts[s.name].stop
    return FeaturePlan(tuple(specs), dict(depths), dict(slots), tuple(sparse), tuple(dense), tuple(deep), tables or starts)


def plan_features(specs: Sequence[FeatureSpec], sizes: Mapping[str, int], lengths: Mapping[str, int] | None = None) -> FeaturePlan:
    """The layout of the active features.

    ``sizes`` holds vocabulary sizes including the default.  ``lengths`` holds
    the positions of features with ``num < 0`` (see ``longest_lists``); without
    it they have ``-num``.  A combined feature has one position.
    """
    used = active(specs)
    depths = {s.name: s.size if s.transform == "tabled" else sizes[s.name] for s in used if s.kind == "category"}
    lengths = lengths or {}
    return _laid_out(used, depths, {s.name: lengths.get(s.name, s.slots) if s.num < 0 and s.combiner == "none" else s.slots for s in used})


def longest_lists(df: DataFrame, specs: Sequence[FeatureSpec]) -> dict[str, int]:
    """Longest list of every uncombined feature with ``num < 0``, at least 1: one aggregate over the rows."""
    free = [s for s in active(specs) if s.num < 0 and s.combiner == "none"]
    if not free:
        return {}
    found = df.agg(*[F.max(F.size(_as_list(df, s))).alias(s.name) for s in free]).first()
    return {s.name: max(1, found[s.name] or 0) for s in free}


def widths(specs: Sequence[FeatureSpec], embed_dim: int, sizes: Mapping[str, int], first_order: int = 0) -> Widths:
    """Vector widths a model needs; ``sizes`` holds vocabulary sizes including the default."""
    return plan_widths(plan_features(specs, sizes), embed_dim, first_order)


def plan_widths(plan: FeaturePlan, embed_dim: int, first_order: int = 0) -> Widths:
    out = Widths(wide=plan.sparse_width, deep_vectors=plan.deep_vectors, dense=plan.dense_width)
    for s in plan.specs:
        for g in s.groups:
            out.groups.setdefault(g, []).append(s.name)
        if s.kind == "category":
            out.category_vectors += plan.slots[s.name]
        elif "embedding" in s.style:
            out.numeric_vectors += plan.slots[s.name]
    for place in plan.deep:
        own = place.spec.embed_dim if place.spec.kind == "category" else None
        out.deep += ((own or embed_dim) + first_order) * place.slots
    return out


def _as_list(df: DataFrame, spec: FeatureSpec) -> Column:
    dtype = df.schema[spec.source].dataType.typeName()
    return F.col(spec.source) if dtype == "array" else F.array(F.col(spec.source))


def encode_features(
    df: DataFrame, plan: FeaturePlan, key: str, vocabularies: DataFrame | None = None, **sizes
) -> DataFrame:
    """``key`` plus one column per active feature.

    Categories become ``array<bigint>`` ids, numeric fields ``array<double>``.
    Uncombined lists are filled up to their positions with the feature's tail,
    longer ones are an error; combined ones keep their length, a NULL list is
    empty.  ``vocabularies`` is ``(field, token, id)`` with the feature name as
    field; all vocabulary features are looked up together.
    """
    used = plan.specs
    vocab = [s for s in used if s.transform == "vocabulary_list"]

    def prepared(s: FeatureSpec) -> Column:
        values = _as_list(df, s)
        if s.transform == "vocabulary_list":
            text = F.transform(values, lambda v: F.coalesce(v.cast("string"), F.lit("")))
            return F.transform(text, lambda v: F.when(v == "", F.lit(s.fill)).otherwise(v))
        if s.transform == "tabled":
            ids = F.transform(values, lambda v: tabled_id(v if not s.fill else F.coalesce(v, F.lit(int(s.fill))), s.size))
            return F.coalesce(ids, F.array().cast("array<bigint>"))
        blank = float(s.fill) if s.fill else 0.0
        numbers = F.transform(values, lambda v: F.coalesce(v.cast("double"), F.lit(blank)))
        return F.coalesce(numbers, F.array().cast("array<double>"))

    def finished(s: FeatureSpec) -> Column:
        col = F.col(s.name)
        if s.transform == "vocabulary_list":
            col = F.transform(col, lambda i: F.when(i < 0, F.lit(s.default).cast("bigint")).otherwise(i))
        if s.combiner == "none":
            pad = F.lit(plan.tail(s)).cast("bigint" if s.kind == "category" else "double")
            col = pad_to(col, plan.slots[s.name], pad)
        return col

    rows = df.select(key, *[prepared(s).alias(s.name) for s in used])
    if vocab:
        if vocabularies is None:
            raise ValueError("vocabulary features need vocabularies")
        rows = encode_lists(rows, vocabularies, key, {s.name: s.name for s in vocab}, default=-1, **sizes)
    return rows.select(key, *[finished(s).alias(s.name) for s in used])


def _combined(how: str, n: Column, size: Column) -> Column:
    """Value of an id that occurs ``n`` times among ``size``."""
    if how == "sum":
        return n.cast("double")
    if how == "mean":
        return n / size
    if how == "max":
        return F.lit(1.0)
    raise ValueError(f"a one-hot category cannot be combined by {how!r}")


def sparse_entries(plan: FeaturePlan, out: str = "sparse", outside: str = "raise") -> Column:
    """The sparse vector: ``array<struct<index, value>>`` by rising index, below ``plan.sparse_width``, none twice.

    A position with id i is 1 at its block's start + i; the padding of short
    lists has no index.  A combined feature has one block, in which a repeated
    id is counted (``sum``), shared among all ids (``mean``) or 1 (``max``).
    Other ids outside the block are an error, or left out with
    ``outside="drop"``.
    """
    if outside not in ("drop", "raise"):
        raise ValueError("outside must be 'drop' or 'raise'")

    def inside(p: Place, i: Column) -> Column:
        good = (i >= 0) & (i < p.depth)
        if outside == "drop":
            return good
        wrong = F.raise_error(outside_message(i, p.depth)).cast("boolean")
        padding = i == F.lit(plan.tail(p.spec)) if p.spec.combiner == "none" else F.lit(False)
        return F.when(good, F.lit(True)).when(padding, F.lit(False)).otherwise(wrong)

    def entry(index: Column, value: Column) -> Column:
        return F.struct(index.cast("bigint").alias("index"), value.alias("value"))

    def entries(p: Place) -> Column:
        ids = F.col(p.spec.name)
        if p.spec.combiner == "none":
            placed = F.transform(ids, lambda i, at: F.struct(i.alias("i"), at.alias("at")))
            known = F.filter(placed, lambda e: inside(p, e["i"]))
            return F.transform(known, lambda e: entry(e["at"] * p.depth + e["i"] + p.start, F.lit(1.0)))
        known = F.filter(value_counts(ids), lambda e: inside(p, e["value"]))
        return F.transform(known, lambda e: entry(e["value"] + p.start, _combined(p.spec.combiner, e["n"], F.size(ids))))

    none = F.array().cast("array<struct<index:bigint,value:double>>")
    # Blocks follow each other, and each part is in order, so the whole is.
    return F.concat(none, *[entries(p) for p in plan.sparse]).alias(out)


def _numbers(s: FeatureSpec) -> Column:
    """A numeric feature's places: its values, or their combination."""
    return F.array(reduce_values(F.col(s.name), s.combiner)) if s.combiner != "none" else F.col(s.name)


def dense_values(plan: FeaturePlan, out: str = "dense") -> Column:
    """The numbers of a row, ``plan.dense_width`` of them; combined fields are one number."""
    return F.concat(F.array().cast("array<double>"), *[_numbers(p.spec) for p in plan.dense]).alias(out)


def deep_entries(plan: FeaturePlan, out: str = "deep") -> Column:
    """``array<struct<position, id, weight>>``: the table rows whose weighted sum is the vector of a position.

    A category's id has weight 1, or its share if combined by ``mean``; padding
    has no row.  A number weighs its shared vector (``same``) or that of its
    position.  A combined number weighs the shared vector by the combination;
    without ``same`` its terms are summed or averaged (not for ``max``).
    """
    kinds = "array<struct<position:int,id:bigint,weight:double>>"

    def entry(at: Column, i: Column, weight: Column) -> Column:
        return F.struct(at.cast("int").alias("position"), i.cast("bigint").alias("id"), weight.alias("weight"))

    def entries(p: Place) -> Column:
        s, base = p.spec, plan.tables[p.spec.name].start
        values, here = F.col(s.name), F.lit(p.start)
        if s.kind == "category":
            depth = plan.depths[s.name]
            row = lambda i: F.when((i >= 0) & (i < depth), i + base)
            if s.combiner == "none":
                found = F.transform(values, lambda i, at: entry(at + here, row(i), F.lit(1.0)))
            else:
                if s.combiner not in ("sum", "mean"):
                    raise ValueError(f"{s.name}: vectors are combined by sum or mean")
                share = F.lit(1.0) / F.size(values) if s.combiner == "mean" else F.lit(1.0)
                found = F.transform(values, lambda i: entry(here, row(i), share))
            return F.filter(found, lambda e: e["id"].isNotNull())
        if s.combiner == "none":
            return F.transform(values, lambda v, at: entry(at + here, F.lit(base) if s.same else at + base, v))
        if s.same:
            return F.transform(_numbers(s), lambda v: entry(here, F.lit(base), v))
        if s.combiner not in ("sum", "mean"):
            raise ValueError(f"{s.name}: vectors are combined by sum or mean")
        share = F.lit(1.0) / F.size(values) if s.combiner == "mean" else F.lit(1.0)
        return F.transform(values, lambda v, at: entry(here, at + base, v * share))

    none = F.array().cast(kinds)
    return F.concat(none, *[entries(p).cast(kinds) for p in plan.deep]).alias(out)


def deep_vectors(
    rows: DataFrame, plan: FeaturePlan, key: str, tables: DataFrame, dim: int, keep: Sequence[str] = (), out: str = "deep", **sizes
) -> DataFrame:
    """``key, keep..., out``: one vector of ``dim`` components per position, as ``array<array<double>>``.

    ``tables`` is ``(feature, id, vec)`` with the rows of every deep feature; an
    id without a row, and a position without an id, is a vector of zeros.  Rows
    behind the end of a feature's table are not read.
    """
    number = F.lit(None).cast("bigint")
    for name, rows_of in plan.tables.items():
        mine = (F.col("feature") == name) & (F.col("id") >= 0) & (F.col("id") < len(rows_of))
        number = F.when(mine, F.col("id") + rows_of.start).otherwise(number)
    numbered = tables.select(number.cast("bigint").alias("id"), "vec").filter("id is not null")
    positions = max(1, plan.deep_vectors)
    sums = vector_sums(rows, key, deep_entries(plan), numbered, dim, positions=positions, keep=keep, **sizes)
    cut = F.transform(F.sequence(F.lit(0), F.lit(positions - 1)), lambda p: F.slice("_s", p * dim + 1, dim))
    return sums.select(key, *keep, (cut if plan.deep else F.array().cast("array<array<double>>")).alias(out))


def numeric_embedding(values: Column, vectors: Sequence[Sequence[float]]) -> Column:
    """Value times vector: one shared vector, or one per value of the field.

    Returns ``array<array<double>>``.
    """
    table = F.array(*[F.array(*[F.lit(float(x)) for x in v]) for v in vectors])
    shared = len(vectors) == 1
    return F.transform(
        values,
        lambda x, i: F.transform(F.get(table, F.lit(0) if shared else i), lambda w: w * x.cast("double")),
    )
