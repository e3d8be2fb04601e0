import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import edges
from starfold.llm import bpe
from starfold.llm.queries import BPE

REFERENCE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
CODEC = bpe.codec(**BPE)


def ids_of(text):
    return REFERENCE.encode(text, add_special_tokens=False).ids


@pytest.fixture
def short_leaf(monkeypatch):
    monkeypatch.setattr(bpe, "LEAF", 8)


TEXTS = [
    "", "a", "hello world", "x" * 300, " " * 100 + "a", "a" + "\n" * 77, "'s't're've'" * 20, "...'s '''s" * 15,
    "é" * 90, "😀" * 40, "中文字" * 50, "1234567890" * 30, "<|endoftext|>" * 9, "ab<|endoftext|> cd\t\t\r\n  e" * 9,
    "The the THE tHe " * 25, "   　x" * 20, "á" * 60, "!?#$%&" * 40 + "word", "ab " * 5 + "q" * 100 + " z",
]


@pytest.mark.parametrize("text", TEXTS)
def test_tree_gives_the_tokens_of_the_whole(short_leaf, text):
    assert CODEC.encode(text) == ids_of(text)
    assert CODEC.decode(CODEC.encode(text)) == REFERENCE.decode(ids_of(text), skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"aab' s\n.é😀1tre<|中", "<|endoftext|>"]), max_size=120).map("".join), st.integers(0, 120))
def test_any_cut_joins_to_the_same_tokens(text, at):
    at = CODEC.cut(text, min(at, len(text)), 0)
    assert CODEC.join(ids_of(text[:at]), ids_of(text[at:])) == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(*[st.text(st.characters(exclude_categories=["Cs"]), max_size=80)] * 3)
def test_parts_join_in_a_tree(a, b, c):
    assert CODEC.join_all([ids_of(a), ids_of(b), ids_of(c)]) == ids_of(a + b + c)


def test_pieces_are_the_text():
    for text in (edges.LONG, "x" * 1000, "a b " * 300, "", "<|endoftext|>" * 50, "ab<|endoftext|>" * 50):
        for size in (7, 100, 4096):
            parts = CODEC.pieces(text, size)
            assert "".join(parts) == text and max(map(len, parts)) <= max(size, 13)
            assert CODEC.join_all([CODEC.encode(p) for p in parts]) == ids_of(text)


@pytest.mark.parametrize("spread", [40, 65_536])
def test_documents(spark, spread):
    docs = edges.documents(spark)
    got = bpe.encode(docs, **BPE, keep_ids=True, spread=spread)
    assert set(got.columns) == set(docs.columns) - {"text"} | {"ids_sha256", "decoded_sha256"}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for i, t in edges.TEXTS:
        ids = ids_of(t or "")
        expected.append((i or 0, len(ids), sha(",".join(map(str, ids))), sha(REFERENCE.decode(ids, skip_special_tokens=False))))
    rows = got.collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(expected)
    texts = bpe.decode(got.select("doc_id", "ids"), **BPE).collect()
    assert sorted((r.doc_id or 0, r.text) for r in texts) == sorted((i or 0, t or "") for i, t in edges.TEXTS)
    assert bpe.encode(docs.limit(0), **BPE).count() == 0
