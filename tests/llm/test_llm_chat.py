"""Reply trees against a walk in plain Python, and exact round trips."""

import random

import pytest

from rankloom.llm.chat import format_paths, read_back, reply_paths, threads

SCHEMA = "conv_id bigint, node_id bigint, parent_id bigint, role string, text string, score double, branch string"


def walk(rows):
    """Paths by (conv, leaf) with the sum of their scores."""
    nodes = {(r[0], r[1]): r for r in rows if r[1] is not None}
    parents = {(r[0], r[2]) for r in nodes.values() if r[2] is not None}
    out = {}
    for key in nodes:
        if key in parents:
            continue
        path, at, seen = [], key, set()
        while at in nodes and at not in seen:
            seen.add(at)
            path.append(at[1])
            at = (at[0], nodes[at][2])
        if at not in seen:
            out[key] = (path[::-1], sum(nodes[key[0], n][5] or 0.0 for n in path))
    return out


def messages(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in (1, 2, None):
        for node in range(n):
            parent = None if node == 0 or rng.random() < 0.05 else rng.randrange(max(0, node - 8), node)
            rows.append((conv, node, parent, rng.choice(["user", "assistant", None]), rng.choice(["hi", None, "a\\</turn>\n### b: c", "###: "]), rng.choice([None, 0.5, 2.0]), "x"))
    rows += [(5, 1, 2, "user", "circle", 1.0, "x"), (5, 2, 1, "user", "circle", 1.0, "x"), (5, 3, 2, "user", "behind it", 1.0, "x")]
    rows += [(6, 1, 77, "user", "orphan", 1.0, "x"), (6, None, None, "user", "nameless", 1.0, "x")]
    return rows


def collected(df):
    found = {}
    for r in df.collect():
        found.setdefault((r["conv_id"], r["path_id"]), {})[r["depth"]] = (r["node_id"], r["branch"])
    return found


def test_paths_and_ranks(spark):
    rows = messages(3)
    want = walk(rows)
    found = collected(reply_paths(spark.createDataFrame(rows, SCHEMA)))
    assert set(found) == set(want)
    for key, (path, _) in want.items():
        assert [found[key][d][0] for d in range(len(path))] == path
    for conv in {k[0] for k in want}:
        ranked = sorted((k for k in want if k[0] == conv), key=lambda k: (-want[k][1], k[1]))
        assert [found[k][0][1] for k in ranked] == list(range(1, len(ranked) + 1))


def test_best_branches_only(spark):
    rows = messages(4, 40)
    want = walk(rows)
    found = collected(reply_paths(spark.createDataFrame(rows, SCHEMA), branches=2))
    for conv in {k[0] for k in want}:
        ranked = sorted((k for k in want if k[0] == conv), key=lambda k: (-want[k][1], k[1]))[:2]
        assert {k for k in found if k[0] == conv} == set(ranked)


def test_round_trip(spark):
    texts = ["", None, "###", "####", "#", "<</turn>", "</turn>\n</turn>", "\\", "\\\\n", "### user: x</turn>\n", "a: b", ": ", "é😀\n\n", "\r\n", "x" * 30000]
    rows = [(k, t, role, text) for k, role in enumerate(["user", "assistant", "a: b", "", None, "x:", "### ", "\\"]) for t, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    table = table.withColumn("formatted", table["text"])
    sent = threads(table)
    done = read_back(format_paths(sent, reply_paths(sent))).collect()
    assert len(done) == 8
    for r in done:
        own = sorted(((t, role, text) for k, t, role, text in rows if k == r["conv_id"]), key=lambda x: x[0])
        assert [(x["role"], x["text"]) for x in r["turns"]] == [(role or "", text or "") for _, role, text in own]
        assert [x["loss"] for x in r["turns"]] == [(text or "") if role == "assistant" else "" for _, role, text in own]
        assert sum(x["chars"] for x in r["mask"]) == len(r["formatted"])


def test_deep_thread_and_repeated_turns(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(700)] + [(2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (None, None, None, None)]
    sent = threads(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    done = {r["conv_id"]: [x["text"] for x in r["turns"]] for r in read_back(format_paths(sent, reply_paths(sent))).collect()}
    assert done == {1: [f"t{t}" for t in range(700)], 2: ["a", "a", "b"], None: [""]}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert format_paths(empty, reply_paths(empty)).count() == 0


@pytest.mark.parametrize("role", ["assistant", "user"])
def test_trained_role(spark, role):
    sent = threads(spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id int, turn int, role string, text string"))
    row = read_back(format_paths(sent, reply_paths(sent), trained_role=role)).first()
    assert "".join(t["loss"] for t in row["turns"]) == ("a" if role == "assistant" else "q")
