"""Whole-table percent rank without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaflow.runtime import lookup_join, with_bounds

#: Distinct values of one range on average; the number of ranges follows from the data.
RANGE_VALUES = 4_096


def range_of(value: Column, edges: Column) -> Column:
    """How many of the sorted edges are at most the value, by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(edges) + 1)).cast("int"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        above = (s["lo"] < s["hi"]) & (F.get(edges, middle) <= value)
        lo = F.when(above, middle + 1).otherwise(s["lo"])
        return F.struct(lo.alias("lo"), F.when(above | (s["lo"] >= s["hi"]), s["hi"]).otherwise(middle).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(edges).alias("hi")), halve, lambda s: s["lo"])


def percent_rank_nulls_last(df: DataFrame, column: str, output: str, range_values: int = RANGE_VALUES) -> DataFrame:
    """Add percent_rank() over the whole table, ascending with nulls last, computed in many tasks.

    Equal values share a rank, so ranking works on the distinct values and their counts. These are split into
    ranges at values picked by their hash (an even, repeatable pick of one in `range_values`); each range is ranked
    in its own task and shifted by the count of all lower ranges. Only the list of ranges is seen by one task.
    """
    values = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    present = values.where("_value is not null")
    picked = present.where(F.pmod(F.xxhash64("_value"), F.lit(range_values)) == 0)
    edges = picked.agg(F.sort_array(F.collect_list("_value")).alias("_edges"))
    ranged = with_bounds(present, edges).select("_value", "_n", range_of(F.col("_value"), F.col("_edges")).alias("_range"))
    totals = ranged.groupBy("_range").agg(F.sum("_n").alias("_total"))
    lower = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_range", F.coalesce(F.sum("_total").over(lower), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    below = ranged.withColumn("_within", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(shifts, "_range")
    below = below.select("_value", (F.col("_within") + F.col("_shift")).alias("_below"))
    size = df.agg(F.count(F.lit(1)).alias("_rows"), F.count(column).alias("_present"))
    ranked = lookup_join(df.withColumn("_value", F.col(column)), below, "_value")
    share = F.coalesce(F.col("_below"), F.col("_present")) / F.greatest(F.col("_rows") - 1, F.lit(1))
    return with_bounds(ranked, size).withColumn(output, share).select(*df.columns, output)
