"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from areaflow.llm import decontaminate, mixing, quality, spelling

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
BASE_FAILED = f"(n_words < {quality.LEAST_WORDS} or 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words)"


def quality_sql() -> str:
    """Counts by windows, quartiles by running sums of rounded values, thresholds by level."""
    w = quality.WINDOW
    measure = {m.name: f"1000 * {m.part} // greatest({m.whole}, 1)" for m in quality.MEASURES}
    long_form = " union all ".join(
        f"select lang, source, '{m.name}' as measure, {m.least_spread} as least, {measure[m.name]} as v from counted where not {BASE_FAILED}"
        for m in quality.MEASURES
    )

    def level(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""{name} as (select {by}measure, q1 - {quality.REACH} * greatest(q3 - q1, least) as low, q3 + {quality.REACH} * greatest(q3 - q1, least) as high, docs
            from (select {by}measure, any_value(least) as least, min(r) filter (4 * upto >= docs) as q1, min(r) filter (4 * upto >= 3 * docs) as q3, max(docs) as docs
                from (select {by}measure, least, r, sum(n) over (partition by {by}measure order by r) as upto, sum(n) over (partition by {by}measure) as docs
                    from (select {by}measure, any_value(least) as least, r, count(*) as n from rounded group by {by}measure, r)) group by {by}measure))"""

    inside = " and ".join(
        f"coalesce({measure[m.name]} <= high_{m.name}, true)" + (f" and coalesce({measure[m.name]} >= low_{m.name}, true)" if m.low else "")
        for m in quality.MEASURES
    )
    limits = ", ".join(f"max({x}) filter (measure = '{m.name}') as {x}_{m.name}" for m in quality.MEASURES for x in ("low", "high"))
    return f"""with split as (select doc_id, lang, source, coalesce(text, '') as text, {WORDS} as words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from documents),
        windows as (select doc_id, i, array_to_string(words[i:i + {w - 1}], ' ') as g
            from (select doc_id, words, unnest(range(1, len(words) - {w - 2})) as i from split)),
        repeated as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) as c from windows) where c > 1),
        covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + {w})) as p from repeated) group by doc_id),
        counted as (select s.doc_id, lang, source, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
            cast(length(text) - length(translate(text, '{quality.SYMBOLS}', '')) as bigint) as n_symbols,
            cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words, cast(len(lines) as bigint) as n_lines
            from split s left join covered c on c.doc_id = s.doc_id),
        valued as ({long_form}),
        rounded as (select lang, source, measure, least, (v >> cast(greatest(length(bin(v)) - 5, 0) as int)) << cast(greatest(length(bin(v)) - 5, 0) as int) as r from valued),
        {level("by_source", "lang, source")}, {level("by_lang", "lang")}, {level("by_all", "")},
        chosen as (select g.lang, g.source, g.measure,
            case when g.docs >= {quality.LEAST_DOCS} then g.low when l.docs >= {quality.LEAST_DOCS} then l.low else a.low end as low,
            case when g.docs >= {quality.LEAST_DOCS} then g.high when l.docs >= {quality.LEAST_DOCS} then l.high else a.high end as high
            from by_source g join by_lang l on l.lang is not distinct from g.lang and l.measure = g.measure join by_all a on a.measure = g.measure),
        limits as (select lang, source, {limits} from chosen group by lang, source)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} as base_failed, not {BASE_FAILED} and {inside} as kept
        from counted c left join limits t on t.lang is not distinct from c.lang and t.source is not distinct from c.source"""


def mixing_sql(share: tuple[int, int] = (4, 5), epochs: int = 2, seed: int = 17) -> str:
    """Budgets level by level from the top, and prefixes of each leaf in its seeded order.

    A node is full if its capacity is within the level at which the nodes of no smaller capacity per weight share what
    those before it leave.
    """
    case = lambda column, values, other: f"case {column} " + " ".join(f"when '{k}' then {v}" for k, v in values.items()) + f" else {other} end"
    domain = case("source", {s: f"'{d}'" for d, (_, listed) in mixing.DOMAINS.items() for s in listed}, f"'{mixing.OTHER_DOMAIN[0]}'")
    weight = {
        "domain": case("domain", {d: w for d, (w, _) in mixing.DOMAINS.items()}, mixing.OTHER_DOMAIN[1]),
        "lang": case("lang", mixing.LANGUAGES, mixing.OTHER_LANGUAGE),
        "source": str(mixing.SOURCE_WEIGHT),
    }
    steps, above = [], "total"
    for k, level in enumerate(mixing.LEVELS):
        path, parent = ", ".join(mixing.LEVELS[: k + 1]), ", ".join(mixing.LEVELS[:k])
        part = f"partition by {parent}" if parent else ""
        using = f"join {above} using ({parent})" if parent else f"cross join {above}"
        steps.append(
            f"""n_{level} as (select {path}, sum(tokens) * {epochs} as cap, max({weight[level]}) as w from leaves group by {path}),
            r_{level} as (select n.*, budget as up, sum(cap) over ({part} order by cap / w, {path}) - cap as before,
                sum(w) over ({part}) - (sum(w) over ({part} order by cap / w, {path}) - w) as open from n_{level} n {using}),
            f_{level} as (select *, min(cap * open <= (up - before) * w) over ({part} order by cap / w, {path}) as full_ from r_{level}),
            b_{level} as (select {path}, cast(case when full_ then cap else ((up - coalesce(sum(cap) filter (full_) over ({part}), 0)) * w)
                // sum(w) filter (not full_) over ({part}) end as bigint) as budget from f_{level})"""
        )
        above = f"b_{level}"
    return f"""with tagged as (select doc_id, text, {domain} as domain, coalesce(lang, '') as lang, coalesce(source, '') as source, lang as lang0, source as source0,
            cast(len({WORDS}) as bigint) as n from documents),
        leaves as (select domain, lang, source, sum(n) as tokens from tagged group by all),
        total as (select cast(sum(tokens) * {share[0]} // {share[1]} as bigint) as budget from leaves),
        {", ".join(steps)},
        placed as (select t.*, budget, least(budget // greatest(tokens, 1), {epochs}) as whole, budget % greatest(tokens, 1) as part
            from tagged t join b_source using (domain, lang, source) join leaves using (domain, lang, source)),
        ordered as (select *, sum(n) over (partition by domain, lang, source
            order by md5(concat_ws('|', '{seed}', cast(cast(whole + 1 as bigint) as varchar), coalesce(cast(doc_id as varchar), ''))), md5(coalesce(text, ''))
            rows unbounded preceding) as upto from placed)
        select doc_id, domain as mix_domain, lang0 as lang, source0 as source, n as mix_tokens, cast(least({epochs}, whole + cast(upto <= part as int)) as bigint) as mix_copies,
            budget as mix_budget from ordered where whole + cast(upto <= part as int) > 0"""


VECTORS_SQL = """with recursive good as (select vec_id, label, cast(embedding as double[]) as v from embeddings where label is not null and embedding is not null
        and list_sum(list_transform(embedding, lambda x: cast(x is null or isnan(x) or isinf(x) as int))) = 0 and list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
    links as (select a.vec_id as a, b.vec_id as b from good a join good b on a.label = b.label and a.vec_id <> b.vec_id
        where list_cosine_similarity(a.v, b.v) >= 0.98),
    reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
    select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(m, vec_id)) as component_id, vec_id <= coalesce(m, vec_id) as kept
    from embeddings left join (select a, count(*) as n from links group by a) x on x.a = vec_id
    left join (select a, min(b) as m from reach group by a) y on y.a = vec_id"""


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def leaks_sql() -> str:
    """Every window of every item joined to every run of as many words of a document, as text."""
    words = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    runs = "array_to_string(w[p:p + n - 1], ' ')"
    return f"""with d as (select row_number() over () as r, doc_id, {words} as w from documents),
        i as (select item_id, w, least(len(w), {decontaminate.WINDOW}) as n from (select item_id, {words} as w from benchmark) where len(w) > 0),
        windows as (select distinct item_id, n, {runs} as s from (select *, unnest(range(1, len(w) - n + 2)) as p from i)),
        there as (select r, p, n, {runs} as s from (select r, w, n, unnest(range(1, len(w) - n + 2)) as p from d join (select distinct n from windows) on len(w) >= n)),
        found as (select distinct r, p, n, item_id from there join windows using (n, s)),
        hit as (select r, count(distinct q) as n_hit from (select r, unnest(range(p, p + n)) as q from found) group by r),
        named as (select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names from (select distinct r, cast(item_id as varchar) as item_id from found) group by r)
        select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
            sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join hit using (r) left join named using (r)"""


def spelling_sql() -> str:
    """crc32 byte by byte; near words share a deletion: at the same place (replaced), or one is the other's (inserted)."""
    step = "case when {0} & 1 = 1 then xor(3988292384, {0} >> 1) else {0} >> 1 end"
    table = "x"
    for _ in range(8):
        table = f"(select list_transform(l, lambda c: {step.format('c')}) from (select {table} as l))"
    entries = table.replace("select x as l", "select list_transform(range(0, 256), lambda c: c) as l")
    run = LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+'))")
    text_bytes = "list_transform(range(1, strlen(t) + 1), lambda k: cast(concat('0x', substr(hex(encode(t)), 2 * k - 1, 2)) as bigint))"
    crc = f"xor(4294967295, list_reduce({text_bytes}, lambda c, b: xor(entries[xor(c & 255, b) + 1], c >> 8), 4294967295))"
    less = spelling.LEAST_LENGTH - 1
    return f"""with recursive crc as materialized (select {entries} as entries),
        runs as (select doc_id, run, count(*) as n from (select doc_id, {run} as run from documents) group by all),
        hashed as (select run, n, {crc} as h from (select run, n, cast(doc_id as varchar) || ':' || run as t from runs where doc_id is not null), crc
            union all select run, n, 1 from runs where doc_id is null),
        counted as (select word, sum(n) as n from (select n, case when h % {spelling.DROPS} = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word from hashed) group by word),
        words as materialized (select word, cast(n as bigint) as n from counted where n >= {spelling.LEAST_COUNT} and length(word) > {less}),
        cut as (select word, n, p, word[:p - 1] || word[p + 1:] as rest from (select word, n, unnest(range(1, length(word) + 1)) as p from words)),
        near as materialized (select distinct * from (
            select a.word, a.n, b.word as other, b.n as other_n from cut a join cut b on a.p = b.p and a.rest = b.rest and a.word <> b.word
            union all select a.word, a.n, b.word, b.n from cut a join words b on a.rest = b.word
            union all select b.word, b.n, a.word, a.n from cut a join words b on a.rest = b.word)),
        best as (select word, any_value(n) as n, count(*) as n_near, arg_min(other, (-other_n, encode(other))) as other, max(other_n) as other_n from near group by word),
        forms as materialized (select words.word, words.n, coalesce(n_near, 0) as n_near, case when other_n >= {spelling.RATIO} * words.n then other end as form, case when other_n >= {spelling.RATIO} * words.n then other_n end as form_n
            from words left join best using (word)),
        ways as (select word, word as at_ from forms union all select ways.word, forms.form from ways join forms on forms.word = ways.at_ where forms.form is not null),
        ends as (select ways.word, at_ as root from ways join forms on forms.word = ways.at_ where forms.form is null)
        select word, form, root, n, cast(n_near as bigint) as n_near, cast(form_n as bigint) as form_n from forms join ends using (word)"""
