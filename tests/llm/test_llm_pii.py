"""Spans against Python's expressions."""

import random
import re

from pyspark.sql import functions as F

from rankloom.llm.pii import BASE, find_spans, redact, span_list

EXPRESSIONS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def confirmed(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(EXPRESSIONS.items()):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if confirmed(kind, m[0])]
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def texts():
    rng = random.Random(6)
    parts = ["a", "b.c", "@", "x-y", "_", ".", "..", " ", "-", "  ", "4111", "1111", "255", "256", "0", "007", "1.2.3.4", "+1", "+", "(", ")", "\n", "é😀", "user@mail.example.com",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 555-0100", "%", "9" * 15]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    out += ["a@b.c_d@e.f@g.h", "1.2.3.4.5.6.7.8", "1.2.3.4" * 500, "12 " * 3000, "4111111111111111 " * 700, None, ""]
    return out


def test_base_spans_like_python(spark):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id int, text string, spans string, kind string")
    found = find_spans(docs).select("doc_id", span_list(F.filter("spans", lambda s: s["rank"] < len(BASE))).alias("list"), "kind")
    got = {r["doc_id"]: r["list"] for r in found.collect()}
    for i, text, _, _ in rows:
        assert got[i] == ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text)), text and text[:100]


def test_long_texts_take_linear_time(spark):
    """Texts on which the given expressions themselves would take quadratic time."""
    n = 300_000
    cases = {"a" * n: "", "1" * n: "", "1 " * n: "", "+1" + " " * n: "", "a@" + "b." * n + "c": f"email:0:{2 * n + 3}", "1." * n: None}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id int, text string")
    got = {r["doc_id"]: r["s"] for r in find_spans(docs).select("doc_id", span_list(F.col("spans")).alias("s")).collect()}
    for i, want in enumerate(cases.values()):
        if want is not None:
            assert got[i] == want
    assert len(got[5].split(",")) == n // 4


def spans_of(spark, text):
    row = find_spans(spark.createDataFrame([(text,)], "text string")).first()
    return [(s["kind"], text[s["start"] : s["end"]]) for s in row["spans"]], [s["score"] for s in row["spans"]]


def test_checksums_and_context_add_spans(spark):
    assert ("iban", "DE89 3704 0044 0532 0130 00") in spans_of(spark, "Konto DE89 3704 0044 0532 0130 00 danke")[0]
    assert not [k for k, _ in spans_of(spark, "Konto DE88 3704 0044 0532 0130 00 danke")[0] if k == "iban"]
    assert ("national_id", "078-05-1120") in spans_of(spark, "my SSN 078-05-1120")[0]
    assert spans_of(spark, "part 078-05-1120")[0] == []
    near, far = spans_of(spark, "mail me: a@b.org")[1], spans_of(spark, "see a@b.org")[1]
    assert near[0] > far[0]


def test_redaction(spark):
    text = "x a@b.org, 10.0.0.1 and +1 (555) 555-0100."
    rows = [(text,), (None,), ("",), ("clean é",)]
    found = find_spans(spark.createDataFrame(rows, "text string"))
    got = [r["t"] for r in found.select(redact(F.col("text"), F.col("spans")).alias("t")).collect()]
    assert got == ["x <EMAIL>, <IP> and <PHONE>.", None, "", "clean é"]
    overlap = "+4111 1111 1111 1111"[:20]
    one = find_spans(spark.createDataFrame([(overlap,)], "text string")).select(redact(F.col("text"), F.col("spans")).alias("t")).first()["t"]
    assert not re.search("[0-9]{4}", one)


def test_empty_table(spark):
    assert find_spans(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_ibans_before_capital_words(spark):
    texts = {
        1: "IBAN DE89370400440532013000 Bitte",
        2: "DE89 3704 0044 0532 0130 00 BIC COBADEFF",
        3: "GB82WEST12345698765432.",
        4: "FR14 2004 1010 0505 0001 3M02 606 Merci",
        5: "DE89370400440532013001 Bitte",  # fails mod 97
        6: "XX89370400440532013000",
        7: "DE893704004405320130001",  # longer than the country's
        8: "NO93 8601 1117 947 OG",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    got = {}
    for r in find_spans(docs).collect():
        got[r["doc_id"]] = [r["text"][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "iban"]
    assert got == {
        1: ["DE89370400440532013000"], 2: ["DE89 3704 0044 0532 0130 00"], 3: ["GB82WEST12345698765432"], 4: ["FR14 2004 1010 0505 0001 3M02 606"],
        5: [], 6: [], 7: [], 8: ["NO93 8601 1117 947"],
    }
