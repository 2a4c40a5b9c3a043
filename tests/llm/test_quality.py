"""Quality rules: counts by definition, thresholds from sketches, and what is kept."""

import re
from collections import Counter

from pyspark.sql import functions as F

from areaflow.llm import quality
from areaflow.llm.common import saved

TEXTS = [
    None, "", "   ", "one", "a b c d e a b c d e", "a b c d e f a b c d e f a b c d e f", "x # y $$ <b>\nx # y $$ <b>\n\n \nz",
    "same " * 40, "é à ü\vß\fz\r\nq", "l\nl\nl\nm", "a b c d e x a b c d e y q a b c d",
]


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    symbols = sum(text.count(c) for c in quality.SYMBOLS)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_follow_the_definition(frame):
    docs = frame("doc_id long, text string, n_words string", *[(i, t, "own") for i, t in enumerate(TEXTS)])
    got = {r["doc_id"]: tuple(r[c] for c in quality.BASE) for r in quality.with_counts(docs).collect()}
    assert got == {i: counts(t) for i, t in enumerate(TEXTS)}


def corpus(spark):
    plain = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("word"), F.pmod(F.xxhash64(k, "id"), F.lit(9000)))), " ")
    text = F.when(F.col("id") % 20 == 7, F.regexp_replace(plain, "word", "%%w##")).otherwise(plain)
    source = F.when(F.col("id") < 500, "big").when(F.col("id") < 520, "small")
    return spark.range(900).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), source.alias("source"), F.lit(1).alias("kept"))


def test_outliers_go_and_clean_documents_stay(spark):
    docs = corpus(spark)
    stay = quality.keep_good(docs)
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] for r in stay.select("doc_id").collect()) == [i for i in range(900) if i % 20 != 7]


def test_small_groups_take_merged_sketches(spark):
    counted = saved(quality.with_counts(corpus(spark)), "t")
    limits = {r["source"]: r.asDict() for r in quality.thresholds(counted).collect()}
    assert set(limits) == {"big", "small", None}
    merged = quality.fences(quality.merged(quality.sketches(counted, ("lang", "source")), ("lang",)), ("lang",))
    high = {r["measure"]: r["high"] for r in merged.collect()}
    assert limits["small"]["high_word_length"] == high["word_length"]


def test_sketch_quartiles_are_close(spark):
    values = spark.range(1, 5001).select(F.lit("m").alias("g"), F.lit("word_length").alias("measure"), F.col("id").alias("value"), F.lit(1).alias("n"))
    bits = "greatest(length(bin(value)) - 5, 0)"
    rounded = values.withColumn("value", F.expr(f"shiftleft(shiftright(value, {bits}), {bits})"))
    row = quality.fences(quality.merged(rounded, ("g",)), ("g",)).first()
    q1, q3 = 1250, 3750
    assert abs(row["low"] - (q1 - 3 * (q3 - q1))) < 600 and abs(row["high"] - (q3 + 3 * (q3 - q1))) < 600


def test_nulls_and_empty_tables(frame):
    docs = frame("doc_id long, text string, lang string, source string", (None, None, None, None), (1, "", "en", None))
    assert quality.keep_good(docs).count() == quality.keep_good(docs.limit(0)).count() == 0


def test_clashing_names(frame):
    names = ["_words", "_lines", "_body", "_hashes", "_placed", "_in0", "_lang", "_source", "_limit_lang", "n_words", "kept"]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names)
    docs = frame(schema, *[(k, "one two three four five six seven eight nine ten " * (k % 3 + 1), "en", None, *names) for k in range(12)])
    counted = quality.with_counts(docs)
    found = quality.verdicts(counted, quality.thresholds(counted)).toPandas()
    assert len(found) == 12 and set(found["n_words"]) == {10, 20, 30} and found["kept"].dtype == bool
    assert all((found[n] == n).all() for n in names if n not in ("n_words", "kept"))
    assert quality.keep_good(docs).columns == docs.columns
    empty = quality.with_counts(docs.limit(0))
    assert quality.verdicts(empty, quality.thresholds(empty)).count() == 0
