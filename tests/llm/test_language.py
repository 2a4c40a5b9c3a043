"""Languages: families first, pairs second; undetermined texts; bounded samples."""

import random

import pytest
from pyspark.sql import functions as F

from areaflow.llm import language

SYLLABLES = {"aa": "lo mi tra ser vo", "ab": "lo mi tro sor vu", "ba": "kh grn stz üf pf", "bb": "kh grm stx ef pf"}


def text(rng, lang, n=40):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return language.fit([(text(rng, k), k) for k in SYLLABLES for _ in range(60)])


def test_families_hold_the_alike(model):
    assert sorted(model.families) == [["aa", "ab"], ["ba", "bb"]]


def test_held_out_texts(model):
    rng = random.Random(2)
    cases = [(k, text(rng, k)) for k in SYLLABLES for _ in range(50)]
    assert sum(model.predict(t)[0] == k for k, t in cases) >= 0.98 * len(cases)
    assert all(0 <= model.predict(t)[1] <= 1 for _, t in cases)


@pytest.mark.parametrize("nothing", [None, "", " \n", "12 !? 34"])
def test_texts_without_letters_are_undetermined(model, nothing):
    assert model.predict(nothing) == ("und", 0.0)


def test_long_texts_count_whole(model, monkeypatch):
    long = text(random.Random(3), "ba", 3000)
    whole = language.features(long)
    monkeypatch.setattr(language, "CHUNK", 1000)
    assert abs(whole - language.features(long)).max() < 0.05
    assert model.predict("12 " * 5000 + text(random.Random(4), "bb", 400))[0] == "bb"


def test_table(frame, model):
    rng = random.Random(5)
    docs = frame("doc_id long, text string, lang string, language string", (1, text(rng, "aa"), "aa", "x"), (2, None, "aa", "x"), (None, text(rng, "ba"), "ba", "x"), (1, "zz", None, "x"))
    got = {(r["doc_id"], r["text"]): r["language"]["lang_pred"] for r in language.identified(docs, model).collect()}
    assert list(got.values()).count("und") == 1 and set(got.values()) >= {"aa", "ba", "und"}
    assert [lang for _, lang in language.sample(docs, F.lit(True), "doc_id", "text", "lang")] == ["aa"]
    assert language.identified(docs.limit(0), model).count() == 0


def test_nothing_or_one_language_to_learn():
    assert language.fit([]).predict("word") == ("und", 0.0)
    assert language.fit([("word", "aa"), ("...", "ab")]).predict("other") == ("aa", 1.0)
