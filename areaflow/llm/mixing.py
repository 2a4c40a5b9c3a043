"""Mixing sources to target weights: budgets down a tree of domain, language and source; DataFrame operations only.

The total budget is shared among domains by weight, each domain's share among its languages, and each language's
among its sources. A node takes no more than its documents give in `max_epochs` passes; what it leaves goes to its
siblings by weight, and only what all of them cannot take reaches the parent's siblings: as the capacity of a node
is the sum below it, sharing with capacities from the top down does that. A leaf then takes whole passes over
its documents and, in the seeded order of one more pass, the longest prefix within its budget.

Prefixes need no sorted leaf: documents fall into ranges of a uniform hash, as many as the leaf's size asks for;
ranges are added up in order, and only the one range that crosses the budget is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaflow.llm.common import saved, words

#: Fixed values of the standard mixture: sources of each domain with the domain's weight, and weights of languages.
DOMAINS = {"web": (5, ("src0", "src1", "src2", "src3", "src4")), "books": (3, ("src5", "src6", "src7", "src8", "src9")), "reference": (2, ("src10", "src11", "src12", "src13", "src14"))}
OTHER_DOMAIN = ("other", 1)
LANGUAGES = {"en": 4, "de": 2, "fr": 2, "es": 2}
OTHER_LANGUAGE = 1
#: Weight of every source within its language.
SOURCE_WEIGHT = 1
#: Documents that one hash range of a leaf holds on average.
RANGE_DOCS = 5_000
LEVELS = ("domain", "lang", "source")


def lookup(values: dict[str, object], key: Column, other: object) -> Column:
    if not values:
        return F.lit(other)
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(other))


def token_count(text: Column) -> Column:
    """Tokens of a text as the mixture counts them: its words."""
    return F.size(words(text)).cast("long")


def shares(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Add budget to nodes with columns capacity, weight and parent_budget, sharing within each parent.

    Sorted by capacity per weight, a node is full if the level reached when it is next to be filled covers it; the
    others share what is left by weight. Remainders of the division are not handed out.
    """
    w = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = w.orderBy(F.col("capacity") / F.col("weight"), *LEVELS[: len(parent) + 1])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    left = F.col("parent_budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    open_weight = F.sum("weight").over(w) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = nodes.withColumn("_left", left).withColumn("_open", open_weight)
    ranked = ranked.withColumn("_full", (wide("capacity") * wide("_open") <= wide("_left") * wide("weight")))
    # full nodes come first: once one is not, the level no longer rises
    ranked = ranked.withColumn("_full", F.min("_full").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rest = F.col("parent_budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(w), F.lit(0))
    rest_weight = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(w)
    ranked = ranked.withColumn("_rest", rest).withColumn("_rest_weight", rest_weight)
    split = F.expr("cast((cast(_rest as decimal(30,0)) * weight) div _rest_weight as long)")
    return ranked.withColumn("budget", F.when(F.col("_full"), F.col("capacity")).otherwise(split)).drop("_left", "_open", "_full", "_rest", "_rest_weight", "parent_budget")


def budgets(leaves: DataFrame, total: Column, max_epochs: int) -> DataFrame:
    """Budget of each leaf (domain, lang, source, tokens, docs, and the weights w_domain, w_lang, w_source)."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    above = leaves.groupBy().agg(total.alias("budget"))
    for k, level in enumerate(LEVELS):
        path = list(LEVELS[: k + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.max(f"w_{level}").alias("weight"), F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
        up = above.withColumnRenamed("budget", "parent_budget")
        nodes = nodes.join(F.broadcast(up)) if not k else nodes.join(up, path[:-1])  # the first is one row
        above = shares(nodes, path[:-1]).select(*path, "budget", "tokens", "docs")
        if k < len(LEVELS) - 1:
            above = above.select(*path, "budget")
    return above


def order_of(key: Column, seed: int, epoch: Column) -> Column:
    """Position of a document in the seeded order of an epoch, as 32 hexadecimal digits."""
    return F.md5(F.concat_ws("|", F.lit(seed).cast("string"), epoch.cast("string"), F.coalesce(key, F.lit(""))))


def mixed(
    docs: DataFrame,
    share: tuple[int, int] = (4, 5),
    max_epochs: int = 2,
    seed: int = 17,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    domains: dict[str, tuple[int, tuple[str, ...]]] = DOMAINS,
    languages: dict[str, int] = LANGUAGES,
) -> DataFrame:
    """The chosen documents with all their columns, mix_domain, mix_tokens, mix_copies (times it is taken) and
    mix_budget (its leaf's budget).

    The budget is `share` of all tokens; `domains` (weight and sources) and `languages` (weights) make the tree. Null languages and sources are nodes of their own ('' in the tree), and
    sources of no domain make up another one. Texts without words count no token and are taken in every whole
    pass; a leaf of such texts alone is taken once. Texts may be of any length. Ties of the order (null or repeated keys) are broken by the text. An empty table gives no rows.
    """
    out = ("mix_domain", "mix_tokens", "mix_copies", "mix_budget")
    names = [f"_in{k}" for k in range(len(docs.columns))]
    at = lambda c: F.col(names[docs.columns.index(c)])
    domain_of = {s: d for d, (_, listed) in domains.items() for s in listed}
    domain = lookup(domain_of, at(source), OTHER_DOMAIN[0])
    tagged = docs.toDF(*names).select(
        "*", domain.alias("domain"), F.coalesce(at(lang), F.lit("")).alias("lang"), F.coalesce(at(source), F.lit("")).alias("source"),
        token_count(at(text)).alias("n"),
    )
    leaves = tagged.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = leaves.select(
        "*", lookup({d: w for d, (w, _) in domains.items()}, F.col("domain"), OTHER_DOMAIN[1]).alias("w_domain"),
        lookup(languages, F.col("lang"), OTHER_LANGUAGE).alias("w_lang"), F.lit(SOURCE_WEIGHT).alias("w_source"),
    )
    leaves = saved(leaves, "mixing-leaves")
    total = F.expr(f"cast((cast(sum(tokens) as decimal(30,0)) * {share[0]}) div {share[1]} as long)")
    none = F.col("_tokens") == 0  # a leaf of texts without words is taken once, for it costs nothing
    plan = budgets(leaves, total, max_epochs).withColumnRenamed("tokens", "_tokens").withColumn("tokens", F.greatest("_tokens", F.lit(1)))
    plan = plan.select(
        *[F.col(c).alias(f"_{c}") for c in LEVELS], F.col("budget").alias("_budget"),
        F.when(none, F.lit(1).cast("long")).otherwise(F.least(F.expr("budget div tokens"), F.lit(max_epochs).cast("long"))).alias("_whole"),
        F.expr("budget % tokens").alias("_part"),
        F.expr(f"cast(shiftleft(cast(1 as bigint), cast(ceil(log2(greatest(1, docs / {RANGE_DOCS}))) as int)) as bigint)").alias("_ranges"),
    )
    plan = saved(plan, "mixing-plan")
    if plan.count() <= 10_000:
        plan = F.broadcast(plan)
    same = [F.col(c) == F.col(f"_{c}") for c in LEVELS]
    placed = tagged.join(plan, same).withColumn("_order", order_of(at(key).cast("string"), seed, F.col("_whole") + 1))
    placed = placed.withColumn("_range", F.expr("(cast(conv(substring(_order, 1, 8), 16, 10) as bigint) * _ranges) div 4294967296"))
    ranges = placed.groupBy(*LEVELS, "_range", "_part").agg(F.sum("n").alias("_n"))
    running = Window.partitionBy(*LEVELS).orderBy("_range")
    ranges = ranges.withColumn("_upto", F.sum("_n").over(running))
    # the first range that crosses the budget, and the tokens before it
    cross = saved(
        ranges.filter(F.col("_upto") > F.col("_part")).groupBy(*LEVELS).agg(F.min(F.struct("_range", (F.col("_upto") - F.col("_n")).alias("_before"))).alias("c"))
        .select(*[F.col(x).alias(f"_x_{x}") for x in LEVELS], F.col("c._range").alias("_cross"), F.col("c._before").alias("_before")),
        "mixing-ranges",
    )
    if cross.count() <= 10_000:
        cross = F.broadcast(cross)
    placed = placed.join(cross, [F.col(c) == F.col(f"_x_{c}") for c in LEVELS], "left")
    edge = F.col("_range") == F.col("_cross")
    within = Window.partitionBy(*LEVELS, "_range").orderBy("_order", F.md5(F.coalesce(at(text), F.lit("")))).rowsBetween(Window.unboundedPreceding, 0)
    sorted_ = placed.filter(edge).withColumn("_taken", F.col("_before") + F.sum("n").over(within) <= F.col("_part"))
    plain = placed.filter(F.coalesce(~edge, F.lit(True))).withColumn("_taken", F.coalesce(F.col("_range") < F.col("_cross"), F.col("_part") > 0))
    copies = F.least(F.lit(max_epochs).cast("long"), F.col("_whole") + F.col("_taken").cast("long"))
    kept = [c for c in docs.columns if c not in out]
    result = plain.unionAll(sorted_).withColumn("_copies", copies).filter("_copies > 0")
    return result.select(
        *[at(c).alias(c) for c in kept], F.col("domain").alias("mix_domain"), F.col("n").alias("mix_tokens"),
        F.col("_copies").alias("mix_copies"), F.col("_budget").alias("mix_budget"),
    )


def repeated(chosen: DataFrame, columns: list[str]) -> DataFrame:
    """Each chosen document as often as it is taken, with the given columns."""
    return chosen.select(*[F.col(f"`{c}`") for c in columns], F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies"))).alias("_epoch")).drop("_epoch")
