import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cytoframe.llm import pieces

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
ENCODER = pieces.encoder(pieces.default_model())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "e", "t", "h", "th", "in", " ", "  ", "▁", "\n", "\t", "é", "漢", "7", "\U0001f600", "\x00", "�", "<s>", "<0x41>", "</s>", "<unk>"]), max_size=60).map("".join))
def test_ids_are_the_library_s_on_few_characters(text):
    ids = ENCODER.encode(text)
    assert ids == LIBRARY.encode(text) and ENCODER.decode(ids) == LIBRARY.decode(LIBRARY.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_the_library_s_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER.encode(text) == LIBRARY.encode(text)


def test_chunks_are_merged_as_by_plain_merging():
    r = random.Random(5)
    for _ in range(3000):
        text = pieces.SPACE + "".join(r.choice(["th", "e", "in", "g", "an", "s", pieces.SPACE]) for _ in range(r.randint(0, 9)))
        found, at = [], 0
        for size in ENCODER.sizes(text):
            found.append(text[at : at + size])
            at += size
        assert found == ENCODER.merged(text)


@pytest.mark.parametrize("text", ["a" * 100_000, "th" * 50_000, " " * 100_003, "漢字" * 20_000, "\U0001f600" * 20_000, "\n" * 50_000, "the cat, " * 30_000])
def test_long_texts_are_encoded_whole(text):
    assert ENCODER.encode(text) == LIBRARY.encode(text)


def test_random_letters_without_spaces():
    r = random.Random(2)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyzABC0123+/") for _ in range(100_000))
    assert ENCODER.encode(text) == LIBRARY.encode(text)


def test_what_a_worker_keeps_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "CHUNKS_KEPT", 10)
    monkeypatch.setattr(pieces, "PAIRS_KEPT", 20)
    e = pieces.PieceEncoder(pieces.default_model())
    for k in range(300):
        text = f"word{k} und{k * k} {'x' * k}"
        assert e.encode(text) == LIBRARY.encode(text)
        assert len(e.chunks) <= 10 and len(e.pairs) <= 20


def test_table(spark):
    rows = [(1, "Hello  world\n", "x", 1), (2, None, "y", 2), (3, "", None, 3), (1, "again the same id", "", 4), (1, "Hello  world\n", "x", 1), (None, "no id", "z", 5), (4, "long " * 40_000, "q", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids int")
    found = pieces.encode_documents(docs)
    got = sorted(map(tuple, pieces.digests(found).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        ids = LIBRARY.encode(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    again = pieces.decode_documents(found).where("doc_id = 1").collect()
    assert sorted(r.text for r in again) == ["Hello  world\n", "Hello  world\n", "again the same id"]
    assert pieces.encode_documents(docs.limit(0)).count() == 0 and pieces.decode_documents(found.limit(0)).count() == 0
    unread = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in pieces.decode_documents(unread).collect()] == ["", ""]


def test_query_equals_the_library(spark):
    from cytoframe.llm import queries

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.queries()["op12_sentencepiece"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = LIBRARY.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
