"""Spelling variants: pairs, forms and roots as comparing all words gives them."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from areaflow.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced letter makes one word the other, by trying."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    """Rows (word, form, root, n, n_near, form_n) by definition."""
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = 1 if key is None else crc32(f"{key}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    words = {w: n for w, n in total.items() if n >= 3 and len(w) >= 5}
    forms, out = {}, []
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = (best if best and words[best] >= 2 * n else None, len(others))
    for w, (form, count) in forms.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, form, root, words[w], count, words.get(form)))
    return sorted(out)


def texts(seed, docs=300):
    draw = random.Random(seed)
    letters = "aeinrstéü"
    stems = ["".join(draw.choices(letters, k=draw.randint(4, 8))) for _ in range(60)]
    rows = []
    for d in range(docs):
        words = []
        for _ in range(60):
            w = draw.choice(stems[: draw.randint(1, len(stems))])
            if draw.random() < 0.3:
                k = draw.randrange(len(w))
                w = draw.choice([w[:k] + w[k + 1 :], w[:k] + draw.choice(letters) + w[k:], w[:k] + draw.choice(letters) + w[k + 1 :]])
            words.append(w.upper() if draw.random() < 0.1 else w)
        rows.append((d, draw.choice([" ", "-", "1", "中"]).join(words)))
    return rows


def result(df):
    rows = spelling.variants(df).collect()
    return sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows), key=lambda r: r[0])


@pytest.mark.parametrize(("cell", "sample", "leaf", "pairs"), [(8192, 1 << 16, 32, 1 << 19), (20, 1 << 16, 4, 50), (20, 100, 4, 50), (7, 1 << 16, 1, 1)])
def test_equals_all_pairs(frame, monkeypatch, cell, sample, leaf, pairs):
    monkeypatch.setattr(spelling, "CELL_WORDS", cell)
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", sample)
    monkeypatch.setattr(spelling, "LEAF_WORDS", leaf)
    monkeypatch.setattr(spelling, "PAIRS", pairs)
    monkeypatch.setattr(spelling, "COMPARED", 3000)
    rows = texts(cell)
    expected = brute(rows)
    assert len(expected) > 300 and sum(r[1] is not None for r in expected) > 50
    assert max(len({r[0], r[1], r[2]} - {None}) for r in expected) == 3  # ways of two steps at least
    df = frame("doc_id long, text string", *rows).repartition(5)
    assert result(df) == expected


def test_runs_and_dropped_letters(frame):
    rows = [(k, "Straße, straße; gaçon gaçona Ābcdefg x́abcde naïve naïves") for k in range(400)] + [(None, "nullkeys nullkeys nullkeyz nullkeyz nullkeyz nullkeyz")]
    assert spelling.runs("ÉtÉœa中B1c_d") == ["ÉtÉ".encode(), b"a", b"b", b"c", b"d"]
    assert result(frame("doc_id long, text string", *rows)) == brute(rows)
    held = {r["word"]: r["n"] for r in spelling.counted(frame("doc_id long, text string", *rows[:400])).collect()}
    assert sum(held.values()) == sum(len(spelling.runs(t)) for _, t in rows[:400])
    assert any(w in held for w in ("traße", "sraße", "staße", "strße", "strae", "straß"))


def test_odd_rows(frame):
    long = "anagrams" * 40_000  # one run of 320,000 letters
    rows = [(1, None), (2, ""), (3, "1 2 3"), (4, long), (4, long), (4, long), (5, long + "s " + "other " * 3), (6, (long + "s ") * 2), (7, "tiny tiny tiny")]
    kind = "doc_id long, text string, word string, n long, root int, cell int"
    found = result(frame(kind, *[(*r, "given", 1, 2, 3) for r in rows]))
    assert [(w[:12], (f or "")[:4], n, near) for w, f, _, n, near, _ in found] == [("anagramsanag", "", 3, 1), ("anagramsanag", "", 3, 1), ("other", "", 3, 0)]
    assert result(frame("doc_id long, text string")) == []
    assert result(frame("doc_id long, text string", (1, None), (2, ""))) == []


def test_ties_and_chains(frame):
    counts = {"abcde": 3, "abcdf": 6, "abcdg": 6, "abxdf": 12, "ayxdf": 24, "zzzzz": 5}
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    found = {r[0]: r for r in result(frame("doc_id long, text string", (None, text)))}
    assert found["abcde"][1:] == ("abcdf", "ayxdf", 3, 2, 6)  # two of the same n: the first in order
    assert found["abcdg"][1:] == (None, "abcdg", 6, 2, None) and found["abcdf"][1:3] == ("abxdf", "ayxdf")
    assert found["zzzzz"][1:] == (None, "zzzzz", 5, 0, None)


@pytest.mark.parametrize("seed", range(4))
def test_tree_walk_reaches_every_near_word(seed):
    draw = np.random.default_rng(seed)
    words = sorted({bytes(draw.choice(spelling.LETTERS[:5], 7)) for _ in range(400)})
    points = spelling.points_of(spelling.letters_of(words, 7))
    root = spelling.tree(points, 5)
    leaf_of = spelling.homes(root, points)
    reach = {(int(r), leaf.leaf) for leaf, rows in spelling.reached(root, points, 1) for r in rows}
    text = [w.decode("latin-1") for w in words]
    pairs = [(i, j) for i in range(len(text)) for j in range(len(text)) if near(text[i], text[j])]
    assert pairs and all((i, leaf_of[j]) in reach for i, j in pairs)
    assert len(reach) < 0.8 * len(words) * (leaf_of.max() + 1)
    assert (np.abs(points[[i for i, _ in pairs]] - points[[j for _, j in pairs]]).sum(axis=1) == 2).all()
