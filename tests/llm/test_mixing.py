"""Mixing: budgets against a plain recursion, prefixes against sorted leaves."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from areaflow.llm import mixing
from areaflow.llm.check_sql import mixing_sql


def share(budget, nodes):
    """Budgets of (capacity, weight) nodes: fill those that are full one by one, split the rest by weight."""
    full, out = set(), {}
    while True:
        left = budget - sum(nodes[k][0] for k in full)
        weight = sum(w for k, (_, w) in nodes.items() if k not in full)
        new = {k for k, (c, w) in nodes.items() if k not in full and c * weight <= left * w}
        if not new:
            break
        full |= new
    for k, (c, w) in nodes.items():
        out[k] = c if k in full else left * w // weight
    return out


def plan(leaves, total, epochs):
    """Budget of each (domain, lang, source) leaf with tokens, from the top down."""
    weights = {d: w for d, (w, _) in mixing.DOMAINS.items()}
    above = {(): total}
    for depth in (1, 2, 3):
        below = {}
        for parent, budget in above.items():
            nodes = {}
            for path, tokens in leaves.items():
                if path[: depth - 1] == parent:
                    w = (weights.get(path[0], 1), mixing.LANGUAGES.get(path[1], 1), 1)[depth - 1]
                    nodes[path[:depth]] = (nodes.get(path[:depth], (0, 0))[0] + tokens * epochs, w)
            below |= share(budget, nodes)
        above = below
    return above


def documents(spark, n=600):
    words = F.array_join(F.array_repeat(F.lit("w"), (F.pmod(F.xxhash64("id"), F.lit(40)) + 1).cast("int")), " ")
    lang = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 2 == 0, "en").otherwise("fr")
    source = F.when(F.col("id") % 3 == 0, "src0").when(F.col("id") % 50 == 1, "src5").when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("src"), F.col("id") % 20))
    return spark.range(n).select(F.col("id").alias("doc_id"), words.alias("text"), lang.alias("lang"), source.alias("source"), F.lit("own").alias("mix_copies"))


@pytest.mark.parametrize(("range_docs", "epochs"), [(5000, 2), (3, 2), (3, 5), (1, 1)])
def test_budgets_and_prefixes(spark, monkeypatch, range_docs, epochs):
    monkeypatch.setattr(mixing, "RANGE_DOCS", range_docs)
    docs = documents(spark).repartition(3)
    domain = {s: d for d, (_, listed) in mixing.DOMAINS.items() for s in listed}
    by_leaf = {}
    for r in docs.collect():
        path = (domain.get(r["source"], "other"), r["lang"] or "", r["source"] or "")
        by_leaf.setdefault(path, []).append((r["doc_id"], len(r["text"].split())))
    tokens = {p: sum(n for _, n in rows) for p, rows in by_leaf.items()}
    total = sum(tokens.values()) * 4 // 5
    budgets, expected = plan(tokens, total, epochs), {}
    assert total - len(budgets) * 3 <= sum(budgets.values()) <= total
    for path, rows in by_leaf.items():
        whole, part = min(epochs, budgets[path] // tokens[path]), budgets[path] % tokens[path]
        at = 0
        for i, n in sorted(rows, key=lambda r: hashlib.md5(f"17|{whole + 1}|{r[0]}".encode()).hexdigest()):
            at += n
            copies = min(epochs, whole + (at <= part))
            if copies:
                expected[i] = (copies, budgets[path])
    got = mixing.mixed(docs, max_epochs=epochs)
    assert {r["doc_id"]: (r["mix_copies"], r["mix_budget"]) for r in got.collect()} == expected
    again = mixing.repeated(got, docs.drop("mix_copies").columns)
    assert again.count() == sum(c for c, _ in expected.values()) and again.columns == ["doc_id", "text", "lang", "source"]


def test_shortages_go_to_siblings_before_ancestors():
    leaves = {("web", "en", "src0"): 10, ("web", "en", "src1"): 1000, ("web", "fr", "src0"): 1000, ("books", "en", "src5"): 1000}
    got = plan(leaves, 800, 1)
    web = 800 * 5 // 8
    assert got["web", "en", "src0"] == 10 and got["web", "en", "src1"] == web * 4 // 6 - 10
    assert got["web", "fr", "src0"] == web * 2 // 6 and got["books", "en", "src5"] == 300


def test_nulls_repeats_and_empty_tables(frame):
    schema = "doc_id long, text string, lang string, source string"
    docs = frame(schema, (None, None, None, None), (1, "", "en", "src0"), (1, "a b", "en", "src0"), (1, "a b", "en", "src0"), (None, "c", None, "src1"))
    found = mixing.mixed(docs, share=(1, 1)).collect()
    assert sorted((r["text"] or "", r["mix_tokens"], r["mix_copies"]) for r in found if r["mix_tokens"] == 0) == [("", 0, 1)] * 2
    assert sum(r["mix_tokens"] * r["mix_copies"] for r in found) in (4, 5)
    assert mixing.mixed(docs.limit(0)).count() == 0
    assert [r["mix_copies"] for r in mixing.mixed(frame(schema, (1, None, None, None))).collect()] == [1]


def test_leaf_of_empty_texts_as_the_sql_has_it(frame):
    rows = [(1, "", "en", "src0"), (2, None, "en", "src0"), (3, "a b c d e", "en", "src1"), (4, "f g h", "en", "src5")]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    expected = con.execute(mixing_sql()).df()
    found = mixing.mixed(frame("doc_id long, text string, lang string, source string", *rows)).select(*expected.columns).toPandas()
    key = lambda df: sorted(map(tuple, df.astype(str).to_numpy().tolist()))
    assert key(found) == key(expected) and {1, 2} <= set(found["doc_id"])


def test_tree_of_other_sources(frame):
    from areaflow.llm import mixing

    docs = frame("doc_id long, text string, lang string, source string", *[(k, "a b", "xx", s) for k, s in enumerate(["n1", "n2"] * 20)])
    domains = {"one": (3, ("n1",)), "two": (1, ("n2",))}
    found = mixing.mixed(docs, share=(1, 2), domains=domains, languages={}).collect()
    assert {r["source"]: (r["mix_domain"], r["mix_budget"]) for r in found} == {"n1": ("one", 30), "n2": ("two", 10)}
