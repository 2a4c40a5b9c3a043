"""Packing: every id in one piece, sequences full or of a power of two, ids as the tokenizer gives them."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from areaflow.llm import packing
from areaflow.llm.queries import tokenizer_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60))
def test_windows_are_packed_without_padding(lengths):
    doc, start, length, seq, offset, sizes = packing.pack_window(np.array(lengths, dtype=np.int64), 16, 0.1)
    for d, n in enumerate(lengths):
        own = sorted((s, k) for x, s, k in zip(doc.tolist(), start.tolist(), length.tolist()) if x == d)
        at = 0
        for s, k in own:
            assert s == at and k > 0
            at += k
        assert at == n
    for q, size in enumerate(sizes.tolist()):
        own = sorted((o, k) for x, o, k in zip(seq.tolist(), offset.tolist(), length.tolist()) if x == q)
        at = 0
        for o, k in own:
            assert o == at
            at += k
        assert at == size and (size == 16 or size & (size - 1) == 0)


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1500, 400)
    _, _, length, seq, _, sizes = packing.pack_window(lengths, 2048, 1 / 1024)
    cost = np.bincount(seq, weights=length + length**2 / 1024, minlength=len(sizes))[sizes == 2048]
    assert cost.std() < 0.3 * cost.mean()


@pytest.fixture(scope="module")
def words():
    return packing.WordIds(tokenizer_path())


ODD = ["", "  \n", "Plain words, twice plain.", "É ÀÉ ß İstanbul ΣΑΣ it's don't ﬁ 12a3 é 日本語 ÅÅ Dž", "a\x0bb\x1cc d e", "<|endoftext|> x!", "!!...?", "x" * 3000]


def test_remembered_ids_equal_the_tokenizer(words):
    expected = [np.array(e.ids, dtype="<u4").tobytes() for e in words.full.encode_batch(ODD, add_special_tokens=False)]
    assert words(ODD) == expected == words(ODD)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text_encodes_as_the_tokenizer_does(words, text):
    assert words([text])[0] == np.array(words.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_forgetting_words_changes_nothing(words, monkeypatch):
    expected = words(ODD)
    monkeypatch.setattr(packing, "REMEMBERED", 0)
    assert words(ODD + ["new words here"])[: len(ODD)] == expected


def test_pieces_of_a_table(spark, frame, words):
    rows = [(1, t, "x") for t in ODD] + [(None, None, "x"), (None, None, "x"), (2, "long text " * 3000, None)]
    docs = frame("doc_id long, text string, start string", *rows)
    got = packing.pack(docs, tokenizer_path(), size=64, window_tokens=500).collect()
    assert sum(r["length"] for r in got) == sum(len(x) // 4 + 1 for x in words([r[1] for r in rows]))
    assert all(len(r["ids"]) == 4 * r["length"] and r["length"] <= 64 for r in got)
    long = b"".join(r["ids"] for r in sorted((r for r in got if r["doc_id"] == 2), key=lambda r: r["start"]))
    assert long == words([rows[-1][1]])[0] + np.array([1], dtype="<u4").tobytes()
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["sequence_tokens"]))
    for pieces in by_sequence.values():
        at = 0
        for o, k, _ in sorted(pieces):
            assert o == at
            at += k
        assert at == pieces[0][2]
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0
