"""Exact distinct counts that merge: hours add up to days, and routes to areas, without the facts.

Ids are whole numbers, 64 of them to a word of bits. For each group and word the ids that occur are one long, combined by
bit_or: in the tasks before the shuffle, over the shuffle, and again whenever stored groups are merged. The number of
distinct ids is the number of bits. An id without a number (unknown to its dimension) stands for itself, as text.

Groups here hold tens of ids, in thousands, so words of 8 bytes are used and not bitmaps of 4 KB
(bitmap_construct_agg, whose buffer also forces a sort). Numbers that follow the use of ids (trips by route) put the ids of a
group into few words. Every id column of a row gives one row before the first combination; there is no Expand, and
the measures of a row go with its first id only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: ids of a word, as a power of two.
BITS = 6
#: How a measure combines.
COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Ids:
    """An id to be counted: its number, its text where it has no number, and marks (conditions under which the id is
    also counted on its own)."""

    number: Column | None = None
    text: Column | None = None
    marks: dict[str, Column] = field(default_factory=dict)


def day_word(date: Column) -> Column:
    """The word of a date, by its day number."""
    return F.shiftright(F.unix_date(date).cast("long"), BITS)


def day_bit(date: Column) -> Column:
    return bit_of(F.unix_date(date).cast("long"))


def bit_of(number: Column) -> Column:
    """The bit of a number in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit((1 << BITS) - 1).cast("long")).cast("int"))


def days_and_hours(rows: DataFrame, key: str, date: str, hour: str, measures: dict[str, tuple[str, Column]] | None = None) -> DataFrame:
    """Distinct days and hours by a key, with measures (see COMBINE): hours of a day are one word, days 64 to a word, so that
    every row is read once and two sums of bits are left. Columns: key, days, hours, measures."""
    measures = measures or {}
    first = rows.groupBy(key, day_word(F.col(date)).alias("_word")).agg(
        F.bit_or(day_bit(F.col(date))).alias("_days"),
        F.bit_or(bit_of(F.col(hour).cast("long"))).alias("_hours"),
        *[COMBINE[how](c).alias(name) for name, (how, c) in measures.items()],
    )
    return first.groupBy(key).agg(
        F.coalesce(F.sum(F.bit_count("_days")), F.lit(0)).alias("days"),
        F.coalesce(F.bit_count(F.bit_or("_hours")).cast("bigint"), F.lit(0)).alias("hours"),
        *[COMBINE[how](name).alias(name) for name, (how, _) in measures.items()],
    )


def words(rows: DataFrame, keys: tuple[str, ...], ids: list[Ids], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """Rows (keys, kind, word, other, bits, a bits column per mark, measures), combined; kind is the place of the id in `ids`.

    Null ids have no bits. The measures, with how they combine, are in the rows of the first id.
    """
    kinds = []
    marks = list(dict.fromkeys(m for i in ids for m in i.marks))
    for kind, i in enumerate(ids):
        number = F.lit(None).cast("long") if i.number is None else i.number.cast("long")
        text = F.lit(None).cast("string") if i.text is None else F.when(number.isNull(), i.text)
        bits = F.coalesce(bit_of(number), F.when(text.isNotNull(), F.lit(1).cast("long")))
        marked = [F.when(i.marks.get(m, F.lit(False)), bits).alias(f"{m}_bits") for m in marks]
        values = [(c if kind == 0 else F.when(F.lit(False), c)).alias(name) for name, (_, c) in measures.items()]
        kinds.append(F.struct(F.lit(kind).alias("kind"), F.shiftright(number, BITS).alias("word"), text.alias("other"), bits.alias("bits"), *marked, *values))
    each = rows.select(*keys, F.inline(F.array(*kinds)))
    return merged(each, keys, {name: how for name, (how, _) in measures.items()})


def merged(rows: DataFrame, keys: tuple[str, ...], measures: dict[str, str]) -> DataFrame:
    """Rows of words() combined by coarser keys."""
    bits = [F.bit_or(c).alias(c) for c in rows.columns if c == "bits" or c.endswith("_bits")]
    values = [COMBINE[how](name).alias(name) for name, how in measures.items()]
    return rows.groupBy(*keys, "kind", "word", "other").agg(*bits, *values)


def distinct(kind: int, mark: str | None = None) -> Column:
    """The number of ids of a kind, over rows of merged()."""
    bits = F.col(f"{mark}_bits" if mark else "bits")
    n = F.when(F.col("other").isNotNull(), (bits > 0).cast("int")).otherwise(F.bit_count(bits))
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, n)), F.lit(0))


def totalled(rows: DataFrame, keys: tuple[str, ...], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """The measures of words() by the keys, without the ids."""
    return rows.groupBy(*keys).agg(*[COMBINE[how](c).alias(name) for name, (how, c) in measures.items()])


def with_counts(totals: DataFrame, ids: DataFrame, keys: tuple[str, ...], counts: list[Column]) -> DataFrame:
    """Measures by the keys with counts over ids merged at those keys, where both are kept apart.

    A key has one row of counts, so Catalyst leaves out the join, and with it the ids, where a query shows no count of them.
    The key is a struct: null keys meet.
    """
    found = ids.groupBy(F.struct(*keys).alias("_key")).agg(*counts)
    return totals.withColumn("_key", F.struct(*keys)).join(found, "_key", "left").drop("_key")


def numbered(rows: DataFrame, column: str, output: str) -> DataFrame:
    """Rows with a number for each value of a column, null for null; without gaps where no value repeats, but for those
    between tasks. Numbers hold for rows that are stored: another run may number differently."""
    dealt = rows.repartition(F.col(column)).sortWithinPartitions(column).withColumn(output, F.monotonically_increasing_id())
    first = F.min(output).over(Window.partitionBy(column))
    return dealt.withColumn(output, F.when(F.col(column).isNotNull(), first))
