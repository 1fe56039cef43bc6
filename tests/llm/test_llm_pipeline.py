"""Every stage on its own input against a brute-force version."""

import os

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from test_llm_groups import smallest_reached  # noqa: E402
from test_llm_near_copies import shingles  # noqa: E402
from test_llm_pii import base_spans  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
STAGES = dict(corpus_pipeline.STAGES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest documents, and odd rows with a column that the stages do not know."""
    from pyspark.sql import functions as F

    given = spark.read.parquet(f"{SF}/documents.parquet")
    first = given.orderBy("doc_id").first()
    odd = [
        (900, None, "en", "s", 0), (901, "", None, None, None), (None, first["text"], "en", "s", 1), (None, "an only text of its own kind here", None, "s", 1),
        (None, "an only text of its own kind here", None, "s", 1), (first["doc_id"], first["text"], first["lang"], first["source"], first["n_chars"]),
        (902, "call +1 (555) 555-0100 or a@b.org, 10.1.1.1", "en", "s", 43), (903, "word " * 60000, "en", "s", 300000),
    ]
    return given.union(spark.createDataFrame(odd, SCHEMA)).withColumn("id", F.lit("clash")).withColumn("spans", F.lit(1)).cache()


def rows(df):
    return [tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in df.collect()]


def order(rows):
    return sorted(rows, key=repr)


def test_quality_keeps_rows_as_they_are(spark, docs):
    before, after = rows(docs), rows(STAGES["quality_classifier"](spark, docs, SF))
    assert set(after) <= set(before)
    gone = [r for r in before if r not in set(after)]
    assert (900, None, "en", "s", 0) in gone and (901, "", None, None, None) in gone
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r for r in before if labels.get(r[0]) == (1, 0)]
    assert sum(r in set(after) for r in good) >= 0.97 * len(good)


def test_one_document_of_each_group(spark, docs):
    """Groups are what links of five-word similarity 0.8 or more reach."""
    got = rows(STAGES["simhash_near_dedup"](spark, docs, SF))
    before = rows(docs)
    texts = sorted({r[1] or "" for r in before})
    sets = [shingles(t) for t in texts]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    reached = smallest_reached(range(len(texts)), near)
    group = {t: reached[k] for k, t in enumerate(texts)}
    members = {}
    for r in before:
        members.setdefault(group[r[1] or ""], []).append(r)
    assert len(got) == len(members) < len(texts)
    assert {group[r[1] or ""] for r in got} == set(members)
    for r in got:
        ids = [m[0] for m in members[group[r[1] or ""]] if m[0] is not None]
        assert r in before and r[0] == (min(ids) if ids else None)


def test_leaks_go(spark, docs):
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = rows(docs)
    leaking = {r[0] for r in before if any(i in " ".join((r[1] or "").split()) for i in items)}
    assert leaking
    assert order(rows(STAGES["benchmark_decontamination"](spark, docs, SF))) == order([r for r in before if r[0] not in leaking])


def test_clean_rows_stay_beside_leaks_of_their_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = "A clean text that has nothing to do with it."
    given = [(7, f"Before. {item} After.", "en", "s", 1), (7, clean, "en", "s", 1), (None, item, "en", "s", 1), (None, clean, "en", "s", 1), (None, clean, "en", "s", 1)]
    left = rows(STAGES["benchmark_decontamination"](spark, spark.createDataFrame(given, SCHEMA), SF))
    assert order(left) == order([given[1], given[3], given[4]])


def test_private_data_goes(spark, docs):
    got = rows(STAGES["pii"](spark, docs, SF))
    before = {(r[0], r[3]): r for r in rows(docs)}
    assert len(got) == docs.count()
    changed = 0
    for r in got:
        assert base_spans(r[1]) == [] and (r[4] == len(r[1]) if r[1] is not None else r[4] is None)
        if (r[0], r[3]) in before and not base_spans(before[r[0], r[3]][1]) and r[0] is not None:
            assert r[1] == before[r[0], r[3]][1]
        else:
            changed += 1
    assert changed


def test_ids_of_the_library(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))
    texts = {}
    for r in rows(docs):
        texts.setdefault((r[0], r[3]), []).append(library.encode(r[1] or "", add_eos=True))
    got = STAGES["sentencepiece"](spark, docs, SF).collect()
    assert len(got) == docs.count()
    assert all(r["ids"] in texts[r["doc_id"], r["source"]] and r["n_tokens"] == len(r["ids"]) for r in got)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_documents(spark, docs, name):
    done = STAGES[name](spark, docs.limit(0), SF)
    assert done.count() == 0
    if name != "sentencepiece":
        assert tuple(done.columns) == corpus_pipeline.COLUMNS


def test_run(spark):
    done = corpus_pipeline.run(spark, SF)
    assert 0 < done.count() < 200 and {"doc_id", "ids", "n_tokens"} <= set(done.columns)
