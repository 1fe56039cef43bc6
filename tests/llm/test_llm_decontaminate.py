"""Copies and variants of items, and what only looks like one."""

import random

import numpy as np

from rankloom.llm.decontaminate import Templates, find_leaks

QUESTION = "A train leaves the station with 120 passengers and the driver Mary Smith stops after 35 miles to let 20 people out."
VARIANT = "A train leaves the station with 77 passengers and the driver Bob stops after 9 km to let 14 people out."
TWICE = "There were 12 boxes in the hall and then 12 boxes in the yard so that 12 people came to carry them home."
MIXED = "There were 12 boxes in the hall and then 13 boxes in the yard so that 14 people came to carry them home."
OTHER = "The garden has a long wall with old trees and nobody has been there for many years except the birds."
SHORT = "Only four words here"


def leaks(spark, docs, items):
    docs = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id bigint, text string, hash int, item_id int")
    items = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, id int")
    return {(r["doc_id"], r["item_id"]): r for r in find_leaks(docs, items).collect()}


def test_leaks(spark):
    items = [(1, QUESTION), (2, TWICE), (3, SHORT), (4, None), (5, ""), (None, OTHER), (1, QUESTION)]
    docs = [
        (10, f"Some words before. {QUESTION} And some behind."),
        (11, f"Other text\n{VARIANT}\nmore text"),
        (12, MIXED),
        (13, TWICE.replace("12", "99")),
        (14, "Nothing of the kind is in here, only words and 12 numbers and 35 miles."),
        (15, f"x. {SHORT}"),
        (16, SHORT),
        (17, None),
        (18, ""),
        (19, "12 35 20 77 Mary Smith Bob 9 km " * 2000),
        (20, (QUESTION + " ") * 300),
        (21, f"{QUESTION} {VARIANT}"),
        (None, TWICE),
        (22, QUESTION),
        (22, QUESTION),
        (23, OTHER),
    ]
    got = leaks(spark, docs, items)
    # A short item counts inside a longer document as well: (15, 3).
    assert set(got) == {(10, 1), (11, 1), (13, 2), (15, 3), (16, 3), (20, 1), (21, 1), (None, 2), (22, 1), (23, None)}
    assert got[10, 1]["verbatim"] and not got[11, 1]["verbatim"] and got[20, 1]["verbatim"] and not got[13, 2]["verbatim"]
    assert got[22, 1]["n_windows"] == got[22, 1]["item_windows"] > 3


def test_short_and_slot_heavy_items(spark):
    table = "12 kg 35 Mary 20 km 77 Bob Smith 9 13 14 15 16 17 18"
    items = [(1, SHORT), (2, "3 + 4 = 7"), (3, table), (4, "ALL WORDS ARE CAPITAL IN THIS ITEM AND IT IS LONG"), (5, QUESTION)]
    docs = [
        (10, f"Long text with many other words before it. {SHORT}. And more words behind it."),
        (11, f"Long text with many other words in one sentence then {SHORT} and more words behind it"),
        (12, "The sum is 3 + 4 = 7 and this is known to everybody who can count."),
        (13, "The sum is 3 + 5 = 8 and this is known to everybody who can count."),
        (14, f"Values of the table: {table} and some words."),
        (15, f"Values of the table: {table.replace('35', '36').replace('9 13 14 15', '9 15 14 13')} and some words."),
        (16, f"He said {items[3][1]} to all of them"),
        (17, f"He said so. {VARIANT}"),
    ]
    assert set(leaks(spark, docs, items)) == {(10, 1), (11, 1), (12, 2), (14, 3), (16, 4), (17, 5)}


def test_rows_that_share_an_id(spark):
    """A copy and a variant under one id do not spoil each other; nor do items, nor rows without an id."""
    docs = [(7, QUESTION), (7, VARIANT), (8, QUESTION), (9, "Nothing of the kind."), (None, VARIANT), (None, "Nothing at all."), (None, QUESTION)]
    got = leaks(spark, docs, [(1, QUESTION)])
    assert set(got) == {(7, 1), (8, 1), (None, 1)} and got[7, 1]["verbatim"] and got[None, 1]["verbatim"]
    assert set(leaks(spark, [(7, VARIANT), (8, TWICE)], [(1, QUESTION), (1, TWICE)])) == {(7, 1), (8, 1)}


def plain_leaks(docs, items, window=8, least_words=4, least=3):
    """Windows, slots and consistency over all pairs of texts."""
    templates = Templates(window, least_words)
    sizes, literal = set(), set()
    cut = []
    for item, text in items:
        windows = templates.item_windows(text)
        cut.append((item, windows))
        for w in windows:
            (literal if w[4] else sizes).add(w[3])
    every = np.full(1 << 21, 255, np.uint8)
    out = set()
    for doc, text in docs:
        mine = templates.document_windows(text, every, sorted(sizes), sorted(literal))
        for item, windows in cut:
            for kind in (False, True):
                total = len({w[0] for w in windows if w[4] == kind})
                copies = {}
                for place, hashed, slots, _, literal_kind in mine:
                    for w in windows:
                        if w[4] == kind and w[1] == hashed:
                            seen, pairs = copies.setdefault(place - w[0], (set(), set()))
                            seen.add(w[0])
                            pairs |= set(zip(w[2], slots))
                good = [len(s) for s, p in copies.values() if len(p) == len({a for a, _ in p}) == len({b for _, b in p})]
                if total and good and max(good) >= min(least, total):
                    out.add((doc, item))
    return out


def test_against_all_pairs_of_texts(spark):
    rng = random.Random(4)
    words = ["the", "of", "train", "leaves", "with", "Mary", "Bob", "Smith", "12", "77", "9", "km", "kg", "and", "box", "people", ".", "home", "ALL"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(2, 30)))) for i in range(25)]
    docs = []
    for d in range(120):
        text = [rng.choices(words, k=rng.randint(0, 25)) for _ in range(3)]
        _, item = rng.choice(items)
        if d % 3:
            changed = [rng.choice(words) if rng.random() < 0.04 else {"12": "13", "Mary": "Ann"}.get(w, w) if d % 2 else w for w in item.split()]
            text[1] = changed
        docs.append((d, " ".join(w for t in text for w in t)))
    got, want = set(leaks(spark, docs, items)), plain_leaks(docs, items)
    assert len(want) > 40 and got == want


def test_nothing(spark):
    assert leaks(spark, [(1, QUESTION)], []) == {} and leaks(spark, [], [(1, QUESTION)]) == {}


def test_placeholders():
    templates = Templates()
    same = [[(g, h) for g, h, _ in templates.windows(t)] for t in (QUESTION, VARIANT)]
    assert same[0] == same[1] and len(same[0]) > 5
    assert templates.windows("one two three. Four") and not templates.windows("1 2 3 4 5 6 7 8 9")
    slots = [s for _, _, s in templates.windows(TWICE)]
    assert len({v for s in slots for v in s}) == 1
