"""The audit against filters that are applied one after the other."""

import re
from itertools import permutations

import numpy as np

from rankloom.llm.filter_audit import audit, filter_cells, gray_walk


def fails(text, repeated):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": repeated,
    }


def plain_audit(docs, labels):
    texts = {}
    for i, text, _ in docs:
        if i is not None:
            texts[text or ""] = min(i, texts.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, lang in docs:
        repeated = i is not None and i > texts[text or ""]
        parts.setdefault(lang or "", []).append((fails(text or "", repeated), i in good, i in toxic))
    out = set()
    for part, members in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        rows = []
        for order in permutations("ABCDE"):
            left = members
            for step, x in enumerate(order, 1):
                gone = [m for m in left if m[0][x]]
                left = [m for m in left if not m[0][x]]
                failing = sum(m[0][x] for m in members)
                only = sum(m[0][x] and sum(m[0].values()) == 1 for m in members)
                shapley[x] += len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), only, sum(m[1] for m in gone), sum(m[2] for m in gone)))
        out |= {(*r, shapley[r[1][r[2] - 1]]) for r in rows}
    return out


def test_audit(spark):
    rng = np.random.default_rng(6)
    vocabulary = [f"w{i}" for i in range(400)]

    def prose(n, distinct, extra=""):
        words = rng.permutation(vocabulary)[:distinct].tolist()
        return " ".join((words * (n // distinct + 1))[:n]) + extra

    texts = [prose(150, 150), prose(150, 120), prose(150, 119), prose(99, 99), prose(100, 100), prose(120, 120, " A|B"), prose(200, 200).upper(), prose(130, 60, " #"), prose(110, 110, " É ü 漢字 𝒜")]
    texts += ["", None, "\n\t \x0b", "A", "A" * 9 + "b" * 81, "A" * 9 + "b" * 80, "x\x85y\xa0z", "$", prose(60000, 300) + " END", "q" * 100000]
    docs = [(int(i), texts[int(rng.integers(len(texts)))], [None, "", "en", "de"][int(rng.integers(4))]) for i in rng.integers(0, 90, 260)]
    docs += [(None, texts[0], "en"), (None, texts[0], "en"), (None, None, None), (-1, texts[3], "zz"), (5000, texts[3], "en"), (5000, texts[3], "en")]
    labels = [(int(i), [None, 0, 1][int(rng.integers(3))], [None, 0, 1][int(rng.integers(3))]) for i in rng.integers(0, 90, 80)] + [(None, 1, 1), (5000, 1, 0), (5000, 0, 1)]
    table = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id bigint, text string, lang string, part string, mask int, n int").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = audit(filter_cells(table, marks)).collect()
    assert len(got) == 5 * 120 * len({d[2] or "" for d in docs})
    assert {tuple(r) for r in got} == plain_audit(docs, labels)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit(filter_cells(docs, labels)).count() == 0
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    assert {tuple(r) for r in audit(filter_cells(one, labels)).collect()} == plain_audit([(1, None, None)], [])


def test_walk_states_are_survivors():
    cells = np.random.default_rng(1).integers(0, 9, (3, 16, 2))
    states = gray_walk(cells)
    for subset in range(16):
        alive = [m for m in range(16) if not m & subset]
        assert (states[:, subset] == cells[:, alive].sum(axis=1)).all()
