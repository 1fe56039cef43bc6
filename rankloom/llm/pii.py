"""Personal data: expressions propose spans, checksums confirm them, context adjusts the score.

Only column functions are used, row by row without a shuffle.  All matches of an
expression and the text between them come from two passes of Java's matcher;
positions are running sums over their lengths, taken in blocks so that a text
with very many matches costs no quadratic time.

The expressions are the given ones, written so that they find the same spans in
linear time on any text: possessive where nothing could be given back, and begun
only where a run begins or the last match ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
CONTEXT_CHARS = 40
KEEP_FROM = 0.5


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def always(text: Column) -> Column:
    return F.lit(True)


def ip_parts(text: Column) -> Column:
    """No part above 255; leading zeros do not count."""
    parts = F.transform(F.split(text, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: F.when(F.length(p) <= 3, F.concat(F.lit("0"), p).cast("int") <= 255).otherwise(False))


def luhn(text: Column) -> Column:
    """12 to 19 digits with a right Luhn sum."""
    digits = _digits(text)

    def value(char: Column, at: Column) -> Column:
        digit = char.cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(at % 2 == 1, twice).otherwise(digit)

    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    total = F.aggregate(F.transform(chars, value), F.lit(0), lambda a, b: a + b)
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


def phone_digits(text: Column) -> Column:
    return F.length(_digits(text)).between(9, 15)


def mod97(text: Column) -> Column:
    """15 to 34 letters and digits whose rearranged number leaves 1 when divided by 97."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    chars = F.filter(F.split(turned, ""), lambda c: c != "")

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.when(F.length(plain).between(15, 34), F.aggregate(chars, F.lit(0), step) == 1).otherwise(False)


@dataclass(frozen=True)
class Kind:
    """One recognizer.

    ``score`` is what a confirmed span has by itself; one of ``context`` within
    40 code points before it (back to the candidate before) adds ``bonus``.
    Spans from ``KEEP_FROM`` on are kept.  ``hint`` is a cheap test that every
    text with a match passes.
    """

    name: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    context: str = ""
    bonus: float = 0.0
    hint: Callable[[Column], Column] = always


def _has(part: str) -> Callable[[Column], Column]:
    return lambda text: text.contains(part)


def _like(pattern: str) -> Callable[[Column], Column]:
    return lambda text: text.rlike(pattern)


# The four given kinds, in the given order; they are kept whatever stands around them.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", always, 0.9, "mail|contact", 0.1, _has("@")),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ip_parts, 0.6, r"\bip\b|address|server|host", 0.3, _like(r"[0-9]\.[0-9]")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", luhn, 0.6, "card|visa|master|credit|karte|tarjeta|carte", 0.3, _like("[0-9][0-9 -]{10}")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", phone_digits, 0.7, "phone|tel|call|mobil|fax", 0.3, _like(r"\+[0-9]")),
)
# Lengths of IBANs by country (IBAN registry).
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
# An IBAN ends with its country's length, so a word behind it is not taken in.
_IBAN = "|".join(f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())
# What the method adds.  The last two need a word nearby that says what they are.
ADDED = (
    Kind("iban", rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])", mod97, 0.8, "iban|konto|account|cuenta|compte", 0.2, _like("[A-Z]{2}[0-9]{2}")),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", always, 0.3, r"\bssn\b|social security|tax", 0.5, _like("[0-9]-[0-9]{2}-[0-9]")),
    Kind("local_phone", r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", always, 0.3, "phone|tel|call|mobil|fax", 0.5, _like("[0-9][ .-][0-9]{4}")),
)
KINDS = BASE + ADDED


def _gaps(text: Column, kind: Kind) -> Column:
    """Candidates with what stands before each: array of (gap, before, found)."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    pairs = F.zip_with(
        F.slice(between, 1, F.size(found)),
        found,
        lambda gap, match: F.struct(F.length(gap).alias("gap"), F.right(gap, F.lit(CONTEXT_CHARS)).alias("before"), match.alias("found")),
    )
    none = F.filter(F.array(F.struct(F.lit(0).alias("gap"), F.lit("").alias("before"), F.lit("").alias("found"))), lambda x: F.lit(False))
    return F.when(kind.hint(text), pairs).otherwise(none)


def _length(x: Column) -> Column:
    return x["gap"] + F.length(x["found"])


def _blocks(gaps: Column) -> Column:
    number = F.ceil(F.size(gaps) / BLOCK).cast("int")
    starts = F.when(number > 0, F.sequence(F.lit(0), number - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda b: F.slice(gaps, b * BLOCK + 1, BLOCK))


def _offsets(blocks: Column) -> Column:
    """Code points before each block."""
    sums = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + _length(x)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
    return F.aggregate(sums, start, step)["out"]


def _placed(blocks: Column, offsets: Column) -> Column:
    """Every candidate as (start, end, before, found)."""
    empty = F.array().cast("array<struct<start:int,end:int,before:string,found:string>>")

    def step(a, x):
        start = a["at"] + x["gap"]
        end = start + F.length(x["found"])
        span = F.struct(start.alias("start"), end.alias("end"), x["before"].alias("before"), x["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

    def place(block, at):
        return F.aggregate(block, F.struct(at.alias("at"), empty.alias("out")), step)["out"]

    return F.flatten(F.zip_with(blocks, offsets, place))


def find_spans(docs: DataFrame, text_col: str = "text", out: str = "spans", kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """Adds ``out``: array of (start, rank, kind, end, score), by start and then by the order of ``kinds``.

    Positions count code points, the end is exclusive.  Within a kind spans do
    not overlap and a failed match is not tried again; spans of different kinds
    may overlap.  A NULL or empty text has no span.  All other columns stay; a
    column that is named like ``out`` is replaced.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    names = [f"__pii_{i}" for i in range(len(kinds))]
    df = docs.withColumns({n: _gaps(text, k) for n, k in zip(names, kinds)})
    df = df.withColumns({n: _blocks(F.col(n)) for n in names})
    df = df.withColumns({f"{n}_at": _offsets(F.col(n)) for n in names})
    df = df.withColumns({n: _placed(F.col(n), F.col(f"{n}_at")) for n in names})

    def scored(rank: int, kind: Kind) -> Column:
        def span(x):
            near = F.lower(x["before"]).rlike(kind.context) if kind.context else F.lit(False)
            score = F.lit(kind.score) + F.when(near, kind.bonus).otherwise(0.0)
            return F.struct(
                x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), x["end"].alias("end"), score.alias("score")
            )

        confirmed = F.filter(F.col(names[rank]), lambda x: kind.confirm(x["found"]))
        return F.filter(F.transform(confirmed, span), lambda s: s["score"] >= KEEP_FROM)

    found = F.array_sort(F.concat(*[scored(i, k) for i, k in enumerate(kinds)]))
    return df.withColumn(out, found).drop(*names, *[f"{n}_at" for n in names])


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; spans that overlap become one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, s):
        fresh = s["start"] >= a["at"]
        gap = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        joined = F.concat(a["out"], gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(fresh, joined).otherwise(a["out"]).alias("out"))

    done = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, done))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
