"""Encoding, decoding and counting against the library."""

import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("public_tokenizers")

from rankloom.llm.sp_encode import Decoder, Encoder, decode_ids, encode_texts  # noqa: E402
from rankloom.llm.sp_model import load, marked, splitter  # noqa: E402
from rankloom.llm.token_counts import Counts, count_tokens  # noqa: E402

PATH = tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "▁", "é", "日本", "😀", "ü", "<s>", "</s>", "<0x0A>", "\x00", "　", "1", "23", "...", "!!", "ing",
         "tion", "%%%", "\r\n", "ﬀ", "́", "က", "thereof", " a", "=-"]
HARD = ["", " ", "a" * 5000, " " * 3000, "ab" * 4000, "thing" * 3000, "=-" * 2000, "é" * 999 + " " * 77 + "\n" * 50, "\U0001f600" * 500]


@pytest.fixture(scope="module")
def model():
    return load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(4)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(4000)] + HARD


def test_encode_like_the_library(model, library):
    encoder = Encoder(model)
    for text in texts():
        assert encoder.encode(text) == library.encode(text, add_eos=True), text[:80]


def test_count_like_the_library(model, library):
    counts, split = Counts(model, model.whole()), splitter(model)
    for text in texts():
        assert sum(map(counts.__getitem__, split.findall(marked(model, text)))) == len(library.encode(text)), text[:80]


def test_whole_tokens_are_proved(model, library):
    whole = model.whole()
    for piece in random.Random(1).sample(sorted(whole), 300):
        assert model.merge(piece) == [piece]
    assert all(model.ids[p] == library.piece_to_id(p) for p in list(whole)[:50])


def test_decode_like_the_library(model, library):
    decoder, rng = Decoder(model), random.Random(8)
    for text in texts():
        ids = library.encode(text, add_eos=True)
        assert decoder.decode(ids) == library.decode(ids)
    low = [1, 2, *range(3, 259)]
    for _ in range(2000):
        ids = [rng.choice(low) if rng.random() < 0.7 else rng.randint(259, 31999) for _ in range(rng.randint(0, 7))]
        assert decoder.decode(ids) == library.decode(ids), ids
    assert decoder.decode(None) == decoder.decode([]) == ""


def test_compatibility_is_re_merging(model):
    encoder, rng = Encoder(model), random.Random(3)
    some = rng.sample(sorted(encoder.shorter), 400)
    for left in some:
        right = rng.choice(some)
        assert encoder.compatible(left, right) == (model.merge(left + right) == [left, right]), (left, right)


def test_short_and_long_merging_agree(model):
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("abcdehinorst▁") for _ in range(rng.randint(1, 40)))
        assert model._merge_short(text) == model._merge_long(text)


ROWS = [(1, "the thing", 7), (1, "the thing", 7), (None, "x", 1), (2, None, 1), (3, "", 1), (4, "word " * 30000, 1)]
SCHEMA = "doc_id bigint, text string, ids int"


def test_rows(spark, model, library):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = decode_ids(encode_texts(docs, model), model)
    rows = {(r["doc_id"], r["decoded"]): r["ids"] for r in got.collect()}
    assert got.count() == len(ROWS)
    for key, text, _ in ROWS:
        assert rows[key, text or ""] == library.encode(text or "", add_eos=True)
    counted = count_tokens(docs, model, limit=10).collect()
    assert len(counted) == len(ROWS)
    for row in counted:
        text = next((t or "") for k, t, _ in ROWS if k == row["doc_id"])
        want = len(library.encode(text))
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), want, want > 10)


def test_empty_table(spark, model):
    docs = spark.createDataFrame([], SCHEMA)
    assert decode_ids(encode_texts(docs, model), model).count() == count_tokens(docs, model).count() == 0
