import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import edges
from starfold.llm import packing
from starfold.llm.common import table
from starfold.llm.queries import WORDS
from starfold.llm.word_bpe import word_codec

REFERENCE = Tokenizer.from_file(WORDS["model"])
CODEC = word_codec(WORDS["model"])


def ids_of(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids


def own(text):
    return np.frombuffer(CODEC.encode(text), "<u4").tolist()


PARTS = [
    "<|endoftext|>", "<|startoftext|>", "<|end", "Σ", "ΑΣ", "é", "é", " ", "\n", "\t", "\x1c", "\x85", "　",
    " ", "İ", "ß", "ﬁ", "1", "22", "'s", "'S", "'ll", "it's", "?!", "😀", "न", "ि", "한", "각", "a", "B", "中",
    "_", "-", " ", "ͅ", "\x00", "Ⅷ", "½", "֘", "꟒", "\U00010940",
]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_ids_are_those_of_the_library(text):
    assert own(text) == ids_of(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_of_any_text(text):
    assert own(text) == ids_of(text)


def test_least_squares_against_a_dense_check():
    """No column can still help, and those in use are balanced: the conditions of the least value."""
    rng = np.random.default_rng(4)
    for _ in range(5):
        histogram = rng.integers(0, 200, 24).astype(float)
        rows = packing.combinations(24, histogram > 0)
        assert all(r.sum() == 24 for r in rows) and len(np.unique(rows, axis=0)) == len(rows)
        x = packing.nonnegative_least_squares(rows, histogram)
        assert (x >= 0).all()
        design = np.zeros((25, len(rows)))
        for j, row in enumerate(rows):
            for step in row[row > 0]:
                design[step, j] += 1
        gain = design[1:].T @ (histogram - design[1:] @ x) / histogram.sum()
        assert gain.max() < 1e-6 and np.abs(gain[x > 1e-6]).max() < 1e-6


def check(rows, wanted, window=4096, padding=None):
    """``wanted``: for each document its ids; documents of equal ids are told apart by nothing."""
    held, of = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r.sequence_id].append(r)
        of[r.doc_id, r.doc_tokens].append(r)
    padded = total = 0
    for parts in held.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        total += at
        padded += window - at if at & (at - 1) else 0
    assert sorted(held) == list(range(len(held)))
    expected = defaultdict(list)
    for doc_id, ids in wanted:
        expected[doc_id, len(ids)].append(ids)
    assert set(of) == set(expected)
    for key, copies in expected.items():
        ids = np.array(copies[0], "<u4")
        covered = np.zeros(len(ids), int)
        for r in of[key]:
            covered[r.start : r.start + r.length] += 1
            if all(c == copies[0] for c in copies):
                assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        assert (covered == len(copies)).all()
    if padding is not None:
        assert padded <= padding * total
    return len(held)


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    tokens = packing.tokenized(docs, **WORDS)
    pieces = packing.pack(tokens)
    rows = packing.digests(pieces, tokens).collect()
    number = check(rows, [(r.doc_id, [*ids_of(r.text), 2]) for r in docs.collect()], padding=0.01)
    packed = packing.sequences(pieces, tokens).collect()
    assert len(packed) == number and all(len(s.ids) == 4 * s.length for s in packed)


def test_awkward_documents(spark):
    docs = edges.documents(spark)
    tokens = packing.tokenized(docs, **WORDS)
    rows = packing.digests(packing.pack(tokens), tokens).collect()
    check(rows, [(i, [*ids_of(t), 2]) for i, t in edges.TEXTS])
    none = packing.tokenized(docs.limit(0), **WORDS)
    assert packing.digests(packing.pack(none), none).count() == 0


@pytest.mark.parametrize("lengths", [[2500] * 40, [1] * 9, [64, 64, 64], [33, 31, 40, 24, 64, 200, 7], []])
def test_lengths_that_do_not_combine_are_cut(spark, lengths, monkeypatch):
    monkeypatch.setattr(packing, "_STRETCH", 4)
    docs = spark.createDataFrame([(i, " ".join(["the"] * (n - 1))) for i, n in enumerate(lengths)], "doc_id long, text string")
    tokens = packing.tokenized(docs.repartition(3), **WORDS, window=64)
    rows = packing.digests(packing.pack(tokens, window=64, grain=4), tokens).collect()
    word = ids_of("the")[0]
    check(rows, [(i, [word] * (n - 1) + [2]) for i, n in enumerate(lengths)], window=64, padding=0.1)
