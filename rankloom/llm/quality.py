"""Quality by perplexity: an interpolated modified Kneser-Ney model of characters.

Training: every task counts the n-grams of its trusted texts; counts are summed
over n-grams, and the probabilities of each order follow from joins of the
n-grams with the totals of their contexts and with the probabilities of the
order below, all sharded by the hash of the key.  Only the discounts (a few
numbers) pass through the driver.

Scoring: the table of probabilities goes to the tasks if it is small by a check
of its rows; else the texts' n-grams are joined with it, sharded by n-gram, and
summed per document.  Both ways give the same perplexity.

Thresholds: quantiles of held-out trusted perplexities for each language.

Characters are classes of 12 bits (those above U+07FF share 2048 classes), so an
n-gram of five is one exact 60-bit number: the context is the number without
its last class, the suffix is the number without its first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.batches import pieces
from rankloom.operators.skew import fits_broadcast
from rankloom.session import materialize

ORDER = 5
CLASS_BITS = 12
START, SPACE, DIGIT = 2, 32, 48
# A table of so many n-grams at most is sent to the tasks: 16 bytes each and a sixteenth of that as n-grams of lower orders.
SENT_ROWS = 4_000_000
# Different n-grams that a task holds before it hands on their counts.
HELD_GRAMS = 1_000_000
# Characters that are looked up at once.
SCORED_AT_ONCE = 1 << 18
# Bins of the logarithm of the perplexity, from which quantiles are read.
BINS = 1000
# Logarithms that are summed over a shuffle are whole numbers of this part of one.
LOG_UNIT = 1 << 32
# With so many characters a text's excess counts half as much squared as that of a long one.
STEADY_CHARS = 300


def _class_table() -> np.ndarray:
    """Class of every code point: white space is one class, digits are one, others are themselves."""
    table = np.arange(0x110000, dtype=np.uint32)
    table = np.where(table < 2048, table, 2048 + table % 2048)
    table[[9, 10, 11, 12, 13, 28, 29, 30, 31, 133, 160]] = SPACE
    table[48:58] = DIGIT
    table[:9] = 1
    return table.astype(np.uint64)


def classes(text: str, table: np.ndarray) -> np.ndarray:
    """Classes of the text without leading, trailing and repeated white space."""
    raw = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not len(raw):
        return raw
    blank = raw == SPACE
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[0] = not blank[0]
    raw = raw[keep]
    return raw[:-1] if len(raw) and raw[-1] == SPACE else raw


def grams(codes: np.ndarray, order: int) -> np.ndarray:
    """The n-gram of the given order that ends at each character; the text begins behind start marks."""
    padded = np.concatenate([np.full(order - 1, START, np.uint64), codes])
    out = np.zeros(len(codes), np.uint64)
    for k in range(order):
        out = (out << np.uint64(CLASS_BITS)) | padded[k : k + len(codes)]
    return out


def count_grams(texts: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """``gram, n``: counts of all n-grams of the highest order."""
    source = texts.select(F.col(f"`{text_col}`").alias("text")).filter(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _class_table()
        held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def batch(g, n):
            return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n)], ["gram", "n"])

        for piece in pieces(batches, 0):
            found = [grams(classes(t, table), order) for t in piece.column(0).to_pylist()]
            new, n = np.unique(np.concatenate(found), return_counts=True)
            both, index = np.unique(np.concatenate([held, new]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, index, np.concatenate([counts, n]))
            held, counts = both, total
            if len(held) > HELD_GRAMS:
                yield batch(held, counts)
                held, counts = held[:0], counts[:0]
        yield batch(held, counts)

    return source.mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """``table``: order, gram, logp (of its last character) and back (log weight of the order below behind it)."""

    table: DataFrame
    unknown: float
    order: int = ORDER
    rows: int = 0


def _discounts(level: DataFrame) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from the numbers of n-grams with counts 1 to 4."""
    n = {r["n"]: r["c"] for r in level.filter("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d1 = 1 - 2 * y * n2 / n1 if n1 else 0.5
    d2 = 2 - 3 * y * n3 / n2 if n2 else 1.0
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.5
    # Small tables can give values outside their range.
    return min(max(d1, 0.1), 1.0), min(max(d2, 0.1), 2.0), min(max(d3, 0.1), 3.0)


def train(texts: DataFrame, text_col: str = "text", order: int = ORDER) -> Model:
    """Model of all given texts; without any character every probability is the same."""
    levels = {order: materialize(count_grams(texts, text_col, order))}
    for k in range(order - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (CLASS_BITS * k)) - 1))
        first = F.shiftright(suffix, CLASS_BITS * (k - 1)).bitwiseAND(F.lit((1 << CLASS_BITS) - 1))
        # Below the top, an n-gram counts the different characters before it; nothing comes before the start.
        seen = levels[k + 1].select(suffix.alias("gram"), F.when(first == START, F.col("n")).otherwise(1).alias("n"))
        levels[k] = materialize(seen.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("gram") != START))
    letters = levels[1].count()
    below, unknown, done = None, 1.0, []
    for k in range(1, order + 1):
        d1, d2, d3 = _discounts(levels[k])
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        level = levels[k].withColumn("ctx", F.shiftright("gram", CLASS_BITS)).withColumn("d", discount)
        # Whole numbers are summed, so the order of the rows changes nothing in the last bit.
        kinds = [F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count_if(F.col("n") > 2)]
        totals = level.groupBy("ctx").agg(F.sum("n").alias("total"), *[c.alias(f"n{i}") for i, c in enumerate(kinds)])
        given = F.col("n0") * F.lit(d1) + F.col("n1") * F.lit(d2) + F.col("n2") * F.lit(d3)
        level = level.join(totals.select("ctx", "total", given.alias("given")), "ctx")
        share, rest = (F.col("n") - F.col("d")) / F.col("total"), F.col("given") / F.col("total")
        if k == 1:
            base = 1.0 / (letters + 1)
            level = materialize(level.select("gram", (share + rest * base).alias("p"), rest.alias("rest")))
            first = level.select("rest").first()
            unknown = (first["rest"] if first else 1.0) * base
        else:
            shorter = below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            level = level.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << (CLASS_BITS * (k - 1))) - 1)))
            level = level.join(shorter, "suffix", "left")
            level = materialize(level.select("gram", "ctx", (share + rest * F.coalesce("lower", F.lit(unknown))).alias("p"), rest.alias("rest")))
            # The weight of the order below, by context: kept with the context's own n-gram.
            weights = level.groupBy("ctx").agg(F.max("rest").alias("rest")).select(F.lit(k - 1).alias("order"), F.col("ctx").alias("gram"), "rest")
            done.append(("back", weights))
        done.append(("p", level.select(F.lit(k).alias("order"), "gram", "p")))
        below = level
    none = F.lit(None).cast("double")
    parts = [df.select("order", "gram", (F.log("p") if kind == "p" else none).alias("logp"), (none if kind == "p" else F.log("rest")).alias("back")) for kind, df in done]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionAll(part)
    table = materialize(union.groupBy("order", "gram").agg(F.max("logp").alias("logp"), F.max("back").alias("back")))
    return Model(table, float(np.log(unknown)), order, table.count())


class Scorer:
    """The model's table in sorted arrays, one pair for every order."""

    def __init__(self, arrays: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], unknown: float, order: int):
        self.arrays, self.unknown, self.order = arrays, unknown, order
        self.table = _class_table()

    def find(self, order: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = self.arrays[order][0]
        if not len(known):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return at, known[at] == keys

    def logs(self, top: np.ndarray) -> np.ndarray:
        """Log probabilities of the last characters of n-grams of the highest order."""
        out = np.zeros(len(top))
        open_ = np.arange(len(top))
        for k in range(self.order, 0, -1):
            keys = top[open_] & np.uint64((1 << (CLASS_BITS * k)) - 1)
            at, hit = self.find(k, keys)
            logp = self.arrays[k][1][at] if len(self.arrays[k][0]) else np.full(len(at), np.nan)
            hit &= ~np.isnan(logp)
            out[open_[hit]] += logp[hit]
            open_, keys = open_[~hit], keys[~hit]
            if not len(open_):
                return out
            if k > 1:
                at, hit = self.find(k - 1, keys >> np.uint64(CLASS_BITS))
                if hit.any():
                    back = self.arrays[k - 1][2][at[hit]]
                    out[open_[hit]] += np.where(np.isnan(back), 0.0, back)
        out[open_] += self.unknown
        return out

    def score(self, texts: list[str | None]) -> tuple[list[int], list[float | None]]:
        """Characters and perplexity of each text."""
        found = [grams(classes(t or "", self.table), self.order) for t in texts]
        sizes = [len(g) for g in found]
        top = np.concatenate(found) if found else np.zeros(0, np.uint64)
        logs = np.empty(len(top))
        for at in range(0, len(top), SCORED_AT_ONCE):
            logs[at : at + SCORED_AT_ONCE] = self.logs(top[at : at + SCORED_AT_ONCE])
        ends = np.cumsum(sizes)
        means = [float(np.exp(-logs[e - n : e].sum() / n)) if n else None for n, e in zip(sizes, ends)]
        return sizes, means


def _scored_here(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    rows = model.table.toArrow()
    order, gram = rows.column("order").to_numpy(), rows.column("gram").to_numpy().view(np.uint64)
    logp, back = (rows.column(c).to_numpy() for c in ("logp", "back"))
    arrays = {}
    for k in range(1, model.order + 1):
        where = np.flatnonzero(order == k)
        where = where[np.argsort(gram[where])]
        arrays[k] = (gram[where], logp[where].astype(float), back[where].astype(float))
    sent = docs.sparkSession.sparkContext.broadcast((arrays, model.unknown, model.order))
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("lm_chars", T.LongType()), T.StructField("perplexity", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for piece in pieces(batches, at):
            sizes, found = scorer.score(piece.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(sizes, pa.int64()), pa.array(found, pa.float64())], [*piece.schema.names, "lm_chars", "perplexity"]
            )

    return docs.mapInArrow(run, schema)


def _scored_by_join(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    """The same for a table of any size: n-grams of the texts, counted per text, meet the table shard by shard."""
    taken = {c.lower() for c in docs.columns}
    row, total, size = (next(n for k in range(len(taken) + 1) if (n := f"{name}_{k}") not in taken) for name in ("row", "log", "chars"))
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    source = keyed.select(F.col(row).alias("__row"), F.col(f"`{text_col}`").alias("text"))
    order = model.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _class_table()
        for piece in pieces(batches, 1):
            for row, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                top, n = np.unique(grams(classes(text or "", table), order), return_counts=True)
                if len(top):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(top), row)), pa.array(top.view(np.int64)), pa.array(n)], ["__row", "top", "n"]
                    )

    found = source.mapInArrow(run, "__row bigint, top bigint, n bigint")
    # What an n-gram scores does not depend on the text, so each different one is looked up once.
    grams_ = materialize(found.select("top").distinct())
    state = grams_.select("top", F.lit(0.0).alias("log"), F.lit(False).alias("done"))
    for k in range(order, 0, -1):
        level = model.table.filter(F.col("order") == k).select(F.col("gram").alias("g"), "logp").filter(F.col("logp").isNotNull())
        state = state.withColumn("g", F.col("top").bitwiseAND(F.lit((1 << (CLASS_BITS * k)) - 1))).join(level, "g", "left")
        hit = ~F.col("done") & F.col("logp").isNotNull()
        state = state.select("top", (F.col("log") + F.when(hit, F.col("logp")).otherwise(0.0)).alias("log"), (F.col("done") | hit).alias("done"), "g")
        if k > 1:
            back = model.table.filter(F.col("order") == k - 1).select(F.col("gram").alias("c"), "back").filter(F.col("back").isNotNull())
            state = state.withColumn("c", F.shiftright("g", CLASS_BITS)).join(back, "c", "left")
            weight = F.when(~F.col("done"), F.coalesce("back", F.lit(0.0))).otherwise(0.0)
            state = state.select("top", (F.col("log") + weight).alias("log"), "done")
    logs = state.select("top", (F.col("log") + F.when(F.col("done"), 0.0).otherwise(model.unknown)).alias("log"))
    # Logarithms are summed as whole numbers, so the result does not depend on the order of the rows.
    part = F.col("n") * F.round(F.col("log") * LOG_UNIT).cast("bigint")
    sums = found.join(logs, "top").groupBy(F.col("__row").alias(row)).agg(F.sum("n").alias(size), F.sum(part).alias(total))
    done = keyed.join(sums, row, "left")
    mean = F.col(total) / F.lit(float(LOG_UNIT)) / F.col(size)
    added = {"lm_chars": F.coalesce(F.col(size), F.lit(0).cast("bigint")), "perplexity": F.exp(-mean)}
    return done.withColumns(added).drop(row, total, size)


def score(docs: DataFrame, model: Model, text_col: str = "text", sent_rows: int = SENT_ROWS) -> DataFrame:
    """Adds ``lm_chars`` and ``perplexity`` (NULL without a character) to every row; columns of those names are replaced."""
    docs = docs.drop("lm_chars", "perplexity")
    return (_scored_here if model.rows <= sent_rows else _scored_by_join)(docs, model, text_col)


@dataclass
class Limits:
    """Typical log perplexity and largest excess, by language and overall (language NULL)."""

    rows: list[tuple[str | None, float, float]]


def _excess(middle: Column) -> Column:
    """How far the log perplexity is above the middle; short texts vary more, so theirs counts less."""
    n = F.col("lm_chars").cast("double")
    return (F.log("perplexity") - middle) * F.sqrt(n / (n + STEADY_CHARS))


def _quantile(df: DataFrame, value: Column, share: float) -> DataFrame:
    """``lang, q`` from counts in bins of 1/1000: exact to the bin, whatever the partitioning; lang NULL is all rows."""
    from pyspark.sql import Window

    binned = df.select("lang", F.round(value * BINS).cast("bigint").alias("bin"))
    counts = binned.cube("lang", "bin").agg(F.grouping("lang").alias("all"), F.grouping("bin").alias("sum"), F.count(F.lit(1)).alias("n"))
    counts = counts.filter("sum = 0").filter("all = 1 or lang is not null")
    order = Window.partitionBy("lang").orderBy("bin")
    running = counts.select("lang", "bin", F.sum("n").over(order).alias("upto"), F.sum("n").over(Window.partitionBy("lang")).alias("total"))
    return running.filter(F.col("upto") >= F.col("total") * share).groupBy("lang").agg((F.min("bin") / BINS).alias("q"), F.max("total").alias("total"))


def fit_limits(scored: DataFrame, share: float = 0.995, slack: float = 1.5, least: float = 0.2, least_texts: int = 30) -> Limits:
    """Limits from held-out trusted texts that were scored.

    For each language the middle is the median of the log perplexity and the
    limit is the ``share`` quantile of the excess over it, times ``slack``.
    A language with fewer than ``least_texts`` texts has the limits of all texts
    together; if these are fewer as well, they have no such quantile and the
    limit is at least ``least``.  Without texts there is no limit.  One row for
    each language is collected.
    """
    usable = scored.filter(F.col("perplexity").isNotNull())
    middles = _quantile(usable, F.log("perplexity"), 0.5).withColumnRenamed("q", "middle")
    found = middles.collect()
    few = any(r["lang"] is None and r["total"] < least_texts for r in found)
    middles = [(r["lang"], r["middle"]) for r in found if r["lang"] is None or r["total"] >= least_texts]
    if not middles:
        return Limits([])
    overall = dict(middles)[None]
    middle = F.lit(overall)
    for lang, value in middles:
        if lang is not None:
            middle = F.when(F.col("lang") == lang, value).otherwise(middle)
    tops = {r["lang"]: r["q"] for r in _quantile(usable, _excess(middle), share).collect()}
    # Texts of no known language are held against the middle of all, so their limit is too.
    tops[None] = next(r["q"] for r in _quantile(usable, _excess(F.lit(overall)), share).collect() if r["lang"] is None)
    lowest = least if few else 10 / BINS  # ten bins: far below any real quantile, above the rounding of bins
    return Limits([(lang, value, max(lowest, slack * tops[lang])) for lang, value in middles])


def judge(scored: DataFrame, limits: Limits, lang_col: str = "lang") -> DataFrame:
    """Adds ``excess``, ``limit`` and ``kept``; columns of these names are replaced.

    A text is kept if its excess is within the limit of its language; a language
    that is NULL or was not seen has the limit of all.  A text without a
    character is not kept.  Without limits every text with a character is kept.
    """
    if not limits.rows:
        none = F.lit(None).cast("double")
        return scored.withColumns({"excess": none, "limit": none, "kept": F.col("perplexity").isNotNull()})
    middle = limit = None
    for lang, m, top in sorted(limits.rows, key=lambda r: r[0] is not None):
        if lang is None:
            middle, limit = F.lit(m), F.lit(top)
        else:
            here = F.col(f"`{lang_col}`") == lang
            middle, limit = F.when(here, m).otherwise(middle), F.when(here, top).otherwise(limit)
    return scored.withColumns({"excess": _excess(middle), "limit": limit}).withColumn("kept", F.coalesce(F.col("excess") <= F.col("limit"), F.lit(False)))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[Model, Limits]:
    """Model and limits from the trusted documents: labelled quality 1 and not toxic.

    Every fifth of them, by a checksum of the id, is held out of the model and
    gives the limits.  Ids without a label, or NULL, are not trusted; repeated
    labels count once.
    """
    trusted = labels.filter("quality = 1 and toxic = 0").select(F.col("doc_id").alias(id_col)).distinct()
    if fits_broadcast(trusted, max_rows=2_000_000):
        trusted = F.broadcast(trusted)
    good = docs.select(id_col, F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).join(trusted, id_col, "left_semi")
    held = F.crc32(F.col(id_col).cast("string")) % 5 == 0
    model = train(good.filter(~held))
    seen = materialize(score(good.filter(held), model).select("lang", "lm_chars", "perplexity"))
    return model, fit_limits(seen)
