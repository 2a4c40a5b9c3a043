"""Header text files with line breaks in quoted fields, read by many tasks.

A byte range of a file cannot tell whether it begins inside a quoted field. So every line becomes a function of that one
bit: what holds at its end if it begins outside, and if it begins inside a field. Such functions are constant, keep the bit
or turn it round, and they combine: the state before any line is that of the last constant before it, turned as often as lines
have turned it since. Ranges combine their lines, a prefix over the few ranges of a file gives the state at which each
begins, and then lines fall into records: a line that begins outside a field begins a record. Only lines of records
that span several are brought together; all others are records as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fields may be quoted, with doubled quotes and, where text is free, line breaks inside.
CSV_FORM = {"header": True, "quote": '"', "escape": '"'}
#: A quoted rest of a field up to its closing quote (doubled quotes inside), what may follow up to the next
#: comma, and a whole field with its comma, as Java patterns that never step back.
REST = r'[^"]*+(?:""[^"]*+)*+'
AFTER = r'[^,]*+'
FIELD = rf'(?:(?:"{REST}"(?!"){AFTER}|(?!"){AFTER}),)*+'
#: A line that ends inside a quoted field, if it begins outside or inside one.
OPEN_FROM_OUTSIDE = rf'^{FIELD}"{REST}$'
OPEN_FROM_INSIDE = rf'^{REST}(?:"(?!"){AFTER},{FIELD}"{REST})?$'
PLACE = ("file", "range", "line")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: file, byte range (its start) and number, which rises within a range. Spark cuts files into ranges
    (spark.sql.files.maxPartitionBytes) and gives each line to one."""
    text = spark.read.option("lineSep", "\n").text(path)
    where = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"))
    return text.select("value", *where, F.monotonically_increasing_id().alias("line"))


def _steps(rows: DataFrame, order: tuple[str, ...], by: tuple[str, ...], outside: Column, inside: Column) -> DataFrame:
    """Add before: the function (o, i) of everything before a row within its group, for rows that are functions
    (outside, inside) themselves."""
    window = Window.partitionBy(*by).orderBy(*order)
    turns = F.sum((outside & ~inside).cast("long")).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = rows.withColumn("_turned", (turns % 2).cast("int"))
    # the bit of a constant, turned back by all turns so far, so that later turns can be added to it
    constant = F.when(outside == inside, outside.cast("int").bitwiseXOR(F.col("_turned")))
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumn("_constant", F.last(constant, ignorenulls=True).over(earlier)).withColumn("_turns", F.coalesce(F.lag("_turned").over(window), F.lit(0)))
    bit = lambda start: F.coalesce(F.col("_constant"), F.lit(start)).bitwiseXOR(F.col("_turns")) == 1
    return marked.withColumn("before", F.struct(bit(0).alias("o"), bit(1).alias("i"))).drop("_turned", "_constant", "_turns")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Records of text files, line breaks in quoted fields included: place of the first line, and record. Empty ones are
    left out. Where the first line of a file ends with a carriage return, lines of that file do, and it is not part of them
    (in quoted fields either, as Spark's reader of whole files has it)."""
    quoted = F.col("value").contains('"')
    of_line = lines(spark, path).withColumns(
        {"o": F.when(quoted, F.col("value").rlike(OPEN_FROM_OUTSIDE)).otherwise(False), "i": F.when(quoted, F.col("value").rlike(OPEN_FROM_INSIDE)).otherwise(True)}
    )
    within = _steps(of_line, ("line",), ("file", "range"), F.col("o"), F.col("i"))
    after = lambda start, name: F.when(F.col("before")[start], F.col("i")).otherwise(F.col("o")).alias(name)
    ranges = within.select("file", "range", "line", after("o", "o"), after("i", "i"), F.col("value").endswith("\r").alias("returns"))
    ranges = ranges.groupBy("file", "range").agg(F.max_by(F.struct("o", "i"), "line").alias("last"), F.min_by("returns", "line").alias("returns"))
    begun = _steps(ranges.select("file", "range", "returns", "last.*"), ("range",), ("file",), F.col("o"), F.col("i"))
    begun = begun.select("file", "range", F.col("before.o").alias("begun"), F.first("returns").over(Window.partitionBy("file").orderBy("range")).alias("returns"))
    placed = within.join(begun, ["file", "range"])
    inside = F.when(F.col("begun"), F.col("before.i")).otherwise(F.col("before.o"))
    ends_inside = F.when(inside, F.col("i")).otherwise(F.col("o"))
    value = F.when(F.col("returns"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")).alias("value")
    placed = placed.select(value, *PLACE, (~inside).alias("starts"), ends_inside.alias("goes_on"))
    alone = placed.where("starts and not goes_on").select(*PLACE, F.col("value").alias("record"))
    # lines of longer records: the first of each is the last one before them that starts a record
    parts = placed.where("not starts or goes_on")
    in_range = Window.partitionBy("file", "range").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = parts.withColumn("first", F.last(F.when(F.col("starts"), F.struct("range", "line")), ignorenulls=True).over(in_range))
    latest = own.groupBy("file", "range").agg(F.max("first").alias("first"))
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    handed = latest.select("file", "range", F.last("first", ignorenulls=True).over(earlier).alias("handed"))
    joined = own.join(handed, ["file", "range"]).withColumn("first", F.coalesce("first", "handed"))
    pieces = F.array_sort(F.collect_list(F.struct("range", "line", "value")))
    long = joined.groupBy("file", "first").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("record"))
    every = alone.unionByName(long.select("file", "first.*", "record"))
    return every.where("record <> ''")


def scan_quoted(spark: SparkSession, *paths: str) -> DataFrame:
    """scan_all_string() by many tasks a file: header text files as strings, aligned by column name, fields quoted where they
    hold commas, quotes (doubled) or line breaks. Columns are those of the first file of a path, in order; each file's first
    record is its header."""
    def scan(path: str) -> DataFrame:
        columns = spark.read.options(**CSV_FORM, multiLine=True).csv(path).columns
        found = records(spark, path)
        header = found.groupBy("file").agg(F.min(F.struct("range", "line")).alias("header")).select("file", "header.*")
        rows = found.join(header, list(PLACE), "left_anti")
        options = {"quote": CSV_FORM["quote"], "escape": CSV_FORM["escape"], "multiLine": "true"}
        return rows.select(F.from_csv("record", _ddl(columns), options).alias("r")).select("r.*").na.fill("")

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [scan(p) for p in paths])


def _ddl(names: list[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
