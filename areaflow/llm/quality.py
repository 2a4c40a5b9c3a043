"""Quality rules with adaptive thresholds, in DataFrame expressions only.

Each rule measures a share of a text in thousandths. Per language and source, a mergeable quantile sketch of every
measure is kept: counts by rounded value, five significant bits each, so that a quantile is exact to one part in 32
and sketches merge by adding counts. A value is an outlier beyond a quartile by more than `REACH` times the spread
between the quartiles, or times the measure's least spread where the group hardly varies. A group too small for
quartiles of its own takes those of its language, then those of all documents, by merging sketches.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaflow.llm.common import saved, words

#: Fixed values of the base rules: least words of a text, largest percentage of words in repeated windows, window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
#: Quartile distances beyond a quartile that are still normal.
REACH = 3
#: Documents that a group needs for a sketch of its own.
LEAST_DOCS = 200
#: Groups up to which thresholds are sent to every task; beyond that they are joined by shuffle.
BROADCAST_GROUPS = 10_000


@dataclass(frozen=True)
class Measure:
    """A text's measure in thousandths, its least spread, and whether low values are outliers, too."""

    name: str
    part: str
    whole: str
    least_spread: int
    low: bool = False


MEASURES = (
    Measure("symbols_per_word", "n_symbols", "n_words", 20),
    Measure("duplicate_lines", "n_dup_lines", "n_lines", 150),
    Measure("repeated_words", "n_repeat_words", "n_words", 60),
    Measure("word_length", "word_chars", "n_words", 1000, low=True),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(hashes: Column, counted: Column) -> Column:
    """Words in windows found twice or more, from the windows sorted as (hash, position).

    Positions of such windows in order cover as many new words each as they are apart, at most a window's length.
    """
    starts = F.filter(
        counted,
        lambda x, i: (x["h"] == F.get(counted, i - 1)["h"]) | (x["h"] == F.get(counted, i + 1)["h"]),
    )
    at = F.array_sort(F.transform(starts, lambda x: x["p"]))
    covered = F.aggregate(
        at,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(p - s["last"], F.lit(WINDOW))).alias("n")),
        lambda s: s["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(covered)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (all long) to the columns.

    Counts cover the whole text, of any length. A null text is as an empty one: all counts are zero. Repeated rows each
    get their counts, an empty table gives no rows, and columns of the new names are replaced. Save the result before
    filtering by a count: a pushed-down filter would repeat the work on arrays in every reference to it.
    """
    new = {*BASE, "n_lines"}
    kept = {f"_in{k}": c for k, c in enumerate(docs.columns) if c not in new}
    text = f"_in{docs.columns.index(text)}"
    docs = docs.toDF(*[f"_in{k}" for k in range(len(docs.columns))])
    own = [F.col(c) for c in kept]
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select(*own, body.alias("_body"), words(F.col(text)).alias("_words"), lines.alias("_lines"))
    n = F.size("_words")
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))), lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<long>"))
    hashed = split.select("*", windows.alias("_hashes"))
    placed = F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    symbols = F.length("_body") - F.length(F.translate("_body", SYMBOLS, ""))
    found = hashed.select("*", placed.alias("_placed")).select(
        *own,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_hashes"), F.col("_placed")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    return found.toDF(*kept.values(), *found.columns[len(kept) :])


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def thousandths(m: Measure) -> Column:
    return F.floor(1000 * F.col(m.part) / F.greatest(F.col(m.whole), F.lit(1))).cast("long")


def sketches(counted: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Counts of the rounded values of every measure by group: (groups, measure, value, n).

    Texts that fail a base rule are no model for a group and stay out of it.
    """
    pairs = F.array(*[F.struct(F.lit(m.name).alias("measure"), thousandths(m).alias("value")) for m in MEASURES])
    long_form = counted.filter(~base_failed()).select(*groups, F.explode(pairs).alias("m")).select(*groups, "m.*")
    bits = "greatest(length(bin(value)) - 5, 0)"
    rounded = F.expr(f"shiftleft(shiftright(value, {bits}), {bits})")
    return long_form.groupBy(*groups, "measure", rounded.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    return sketch.groupBy(*groups, "measure", "value").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Lowest and highest normal value (low, high) of each measure by group, with the documents seen (docs)."""
    by = [*groups, "measure"]
    w = Window.partitionBy(*by)
    running = sketch.select("*", F.sum("n").over(w.orderBy("value")).alias("upto"), F.sum("n").over(w).alias("docs"))
    first = lambda share: F.min(F.when(F.col("upto") * 4 >= F.col("docs") * share, F.col("value")))
    quartiles = running.groupBy(*by).agg(first(1).alias("q1"), first(3).alias("q3"), F.max("docs").alias("docs"))
    least = F.create_map(*[x for m in MEASURES for x in (F.lit(m.name), F.lit(m.least_spread))])[F.col("measure")]
    spread = REACH * F.greatest(F.col("q3") - F.col("q1"), least)
    return quartiles.select(*by, (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"), "docs")


def thresholds(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per language and source that occur (nulls are values of their own) with low_<measure> and
    high_<measure>: from the group's sketch, or a merged one where it holds too few documents."""
    fine = saved(sketches(counted.select(F.col(lang).alias("lang"), F.col(source).alias("source"), *BASE, "n_lines"), ("lang", "source")), "quality-sketches")
    wide = {}
    for level, groups in (("g", ("lang", "source")), ("l", ("lang",)), ("a", ())):
        f = fences(fine if len(groups) == 2 else merged(fine, groups), groups)
        columns = [F.max("docs").alias(f"{level}_docs")]
        for m in MEASURES:
            of = F.col("measure") == m.name
            columns += [F.max(F.when(of, F.col(x))).alias(f"{level}_{x}_{m.name}") for x in ("low", "high")]
        wide[level] = f.groupBy(*groups).agg(*columns) if groups else f.agg(*columns)
    l, a = wide["l"].withColumnRenamed("lang", "_l"), wide["a"]
    out = wide["g"].join(l, F.col("lang").eqNullSafe(F.col("_l")), "left").join(F.broadcast(a))  # a is one row
    enough = lambda level: F.coalesce(F.col(f"{level}_docs") >= LEAST_DOCS, F.lit(False))
    pick = lambda x: F.when(enough("g"), F.col(f"g_{x}")).when(enough("l"), F.col(f"l_{x}")).otherwise(F.col(f"a_{x}"))
    return saved(out.select("lang", "source", *[pick(f"{x}_{m.name}").alias(f"{x}_{m.name}") for m in MEASURES for x in ("low", "high")]), "quality-thresholds")


def verdicts(counted: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Add base_failed and kept: no base rule failed, and no measure is outside the group's thresholds.

    Null languages and sources are values of their own, repeated rows get the same verdict, a group without thresholds
    has none to fail, and an empty table gives no rows. Columns of the new names are replaced.
    """
    mark = "_limit_"
    while any(c.lower().startswith(mark) for c in counted.columns):
        mark = "_" + mark
    limits = limits.withColumnsRenamed({c: f"{mark}{c}" for c in limits.columns})
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    own = [F.col(f"`{c}`") for c in counted.columns if c not in ("base_failed", "kept")]
    joined = counted.join(limits, F.col(lang).eqNullSafe(F.col(f"{mark}lang")) & F.col(source).eqNullSafe(F.col(f"{mark}source")), "left")
    within = [
        (thousandths(m) <= F.col(f"{mark}high_{m.name}")) & ((thousandths(m) >= F.col(f"{mark}low_{m.name}")) if m.low else F.lit(True))
        for m in MEASURES
    ]
    fine = reduce(lambda a, b: a & b, [F.coalesce(x, F.lit(True)) for x in within])
    return joined.select(*own, base_failed().alias("base_failed"), (~base_failed() & fine).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that no rule rejects, with the columns of the input."""
    names = [f"_in{k}" for k in range(len(docs.columns))]
    at = lambda c: names[docs.columns.index(c)]
    counted = saved(with_counts(docs.toDF(*names), at(text)), "quality-counted")
    limits = thresholds(counted, at(lang), at(source))
    return verdicts(counted, limits, at(lang), at(source)).filter("kept").select(*names).toDF(*docs.columns)
