"""Data-quality rules. Every rule gives rows (dataset, check, column, severity, affected).

The rules of a dataset are counts over its rows, so any number of them is taken in one aggregate;
only the duplicate-key rule needs a pass of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.contracts import Contract
from areaflow.functions.parsing import to_flag, to_number, to_time
from areaflow.functions.rules import (
    AREA_CODE_MAX_LENGTH,
    outside_delay_range,
    valid_area_code,
    valid_coordinates,
)
from areaflow.operators.standardize import blanks_to_null, missing_required
from areaflow.runtime import with_bounds

# Fixed values of the rules.
DELAY_COLUMNS = (
    "arrival_delay_seconds",
    "departure_delay_seconds",
    "max_arrival_delay_seconds",
    "max_departure_delay_seconds",
)
WARN_AFTER_DAYS, ERROR_AFTER_DAYS = 7, 14


@dataclass(frozen=True)
class Rule:
    """A count over the rows of a dataset and the severity a count above zero has."""

    check: str
    column: str | None
    count: Column
    severity: str

    def level(self, count: Column) -> Column:
        if self.check == "row_count":
            return F.when(count == 0, self.severity).otherwise("passed")
        return F.when(count > 0, self.severity).otherwise("passed")


def _number(df: DataFrame, column: str) -> Column:
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    return to_number(F.col(column)) if is_text else F.col(column).cast("double")


def required_present(df: DataFrame, contract: Contract) -> list[Rule]:
    """A required column that is absent is an error whatever the rows; known from the schema alone."""
    lacking = missing_required(df, contract)
    return [Rule("required_present", c, F.count(F.lit(1)) * 0 + F.lit(int(c in lacking)), "error") for c in contract.required]


def row_count(df: DataFrame, contract: Contract) -> list[Rule]:
    """No rows is an error, or a warning where the contract allows it; affected is the row count."""
    return [Rule("row_count", None, F.count(F.lit(1)), "warning" if contract.allow_empty else "error")]


def _present(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in df.columns]


def all_null(df: DataFrame, contract: Contract) -> list[Rule]:
    """A required column without any value, in a table that has rows."""
    rows = F.count(F.lit(1))
    return [
        Rule("all_null", c, F.when(F.count(c) == 0, rows).otherwise(0), "error")
        for c in _present(df, contract.required)
    ]


def null_counts(df: DataFrame, contract: Contract) -> list[Rule]:
    return [
        Rule("null_count", c, F.count_if(F.col(c).isNull()), "info") for c in _present(df, contract.required)
    ]


def timestamps(df: DataFrame, contract: Contract) -> list[Rule]:
    """Values present that do not parse as a time."""
    rules = []
    for column in _present(df, contract.times):
        value = F.col(column)
        is_text = isinstance(df.schema[column].dataType, T.StringType)
        bad = value.isNotNull() & to_time(value).isNull() if is_text else F.lit(False)
        rules.append(Rule("timestamp_parse", column, F.count_if(bad), "warning"))
    return rules


def coordinates(df: DataFrame, contract: Contract) -> list[Rule]:
    """Coordinates out of range, null or not numeric."""
    if not {"stop_lat", "stop_lon"} <= set(df.columns):
        return []
    bad = ~valid_coordinates(F.col("stop_lat"), F.col("stop_lon"))
    return [Rule("coordinates", "stop_lat", F.count_if(bad), "warning")]


def delay_range(df: DataFrame, contract: Contract) -> list[Rule]:
    if not contract.delay_checked:
        return []
    return [
        Rule("delay_range", c, F.count_if(outside_delay_range(_number(df, c))), "warning")
        for c in _present(df, DELAY_COLUMNS)
    ]


def matched_has_area(df: DataFrame, contract: Contract) -> list[Rule]:
    """Stops flagged as matched without an area code."""
    if contract.name != "stop_area_map" or not {"is_matched", "area_code"} <= set(df.columns):
        return []
    bad = to_flag(F.col("is_matched")) & F.col("area_code").isNull()
    return [Rule("matched_has_area", "area_code", F.count_if(bad), "error")]


def area_index_values(df: DataFrame, contract: Contract) -> list[Rule]:
    """Area codes too long or not nine digits, and scores that are missing or not numeric."""
    if contract.name != "area_index" or "area_code" not in df.columns:
        return []
    code = F.trim("area_code")
    rules = [
        Rule("code_length", "area_code", F.count_if(F.length(code) > AREA_CODE_MAX_LENGTH), "error"),
        Rule("code_format", "area_code", F.count_if(code.isNotNull() & ~valid_area_code(code)), "error"),
    ]
    if "score" in df.columns:
        rules.append(Rule("score_missing", "score", F.count_if(_number(df, "score").isNull()), "error"))
    return rules


COUNT_RULES = (
    required_present,
    row_count,
    all_null,
    timestamps,
    coordinates,
    delay_range,
    matched_has_area,
    area_index_values,
)


def run_rules(df: DataFrame, contract: Contract, *checks) -> DataFrame:
    """Evaluate count rules in one aggregate and give one row per rule."""
    rules = [rule for check in checks for rule in check(df, contract)]
    counts = df.agg(*[F.coalesce(r.count, F.lit(0)).cast("bigint").alias(f"c{i}") for i, r in enumerate(rules)])
    results = [
        F.struct(
            F.lit(contract.name).alias("dataset"),
            F.lit(r.check).alias("check"),
            F.lit(r.column).cast("string").alias("column"),
            r.level(F.col(f"c{i}")).alias("severity"),
            F.col(f"c{i}").alias("affected"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def duplicate_rows(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Number of rows that share a key with another row, every copy counted; null keys equal each other."""
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, contract: Contract) -> DataFrame:
    """Duplicate rule as a result row; a table without its key columns counts as free of duplicates."""
    if set(contract.key) <= set(df.columns):
        found = duplicate_rows(df, contract.key)
    else:
        found = df.limit(1).agg(F.lit(0).cast("bigint").alias("duplicate_rows"))
    return found.select(
        F.lit(contract.name).alias("dataset"),
        F.lit("duplicate_key").alias("check"),
        F.lit(", ".join(contract.key)).alias("column"),
        F.when(F.col("duplicate_rows") > 0, "warning").otherwise("passed").alias("severity"),
        F.col("duplicate_rows").alias("affected"),
    )


def check_dataset(df: DataFrame, contract: Contract, blank_is_null: bool = True) -> DataFrame:
    """All rules of one dataset. With blank_is_null off, blank text counts as a value."""
    rows = df.transform(blanks_to_null) if blank_is_null else df
    return run_rules(rows, contract, *COUNT_RULES).unionByName(duplicate_keys(rows, contract))


def suite(tables: dict[str, tuple[Contract, DataFrame]]) -> DataFrame:
    """All rules over a group of datasets."""
    return reduce(DataFrame.unionByName, [check_dataset(df, contract) for contract, df in tables.values()])


def suite_summary(results: DataFrame) -> DataFrame:
    """Number of passed checks, warnings and errors per dataset."""
    return results.groupBy("dataset").agg(
        F.count_if(F.col("severity") == "passed").alias("passed"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.count_if(F.col("severity") == "error").alias("errors"),
    )


def dataset_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Row count, absent required columns, nulls per required column and duplicate rows of a dataset."""
    columns = _present(df, contract.required)
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.create_map(*[x for c in columns for x in (F.lit(c), F.count_if(F.col(c).isNull()))]).alias("null_counts"),
    )
    report = with_bounds(counts, duplicate_rows(df, contract.key))
    lacking = F.lit(", ".join(missing_required(df, contract)))
    return report.select(
        F.lit(contract.name).alias("dataset"),
        "row_count",
        lacking.alias("missing_required"),
        "null_counts",
        "duplicate_rows",
    )


def failed_not_null(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Rows that break a not-null test, optionally only among rows of a condition."""
    rows = df if where is None else df.where(where)
    return rows.where(F.col(column).isNull())


def failed_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1")


def failed_accepted(df: DataFrame, column: str, values: tuple) -> DataFrame:
    """Values outside the accepted list, with their counts; nulls are accepted."""
    bad = df.where(~F.col(column).isin(*values))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Non-null child keys that no parent row has, with the number of child rows.

    Child rows are counted per key before the join, so a key with very many rows is one row in it.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_key or key).alias(key))
    return keys.join(parents, key, "left_anti")


def failed_score_range(scores: DataFrame, low: float = 0, high: float = 100) -> DataFrame:
    """Rows whose impact score lies outside its documented range."""
    return scores.where((F.col("equity_impact_score") < low) | (F.col("equity_impact_score") > high))


def result_row(failed: DataFrame, test: str, count: Column | None = None) -> DataFrame:
    """Result row of a table test: the number of failures and pass or fail."""
    total = F.coalesce(count if count is not None else F.count(F.lit(1)), F.lit(0)).cast("bigint")
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return failed.agg(total.alias("failures")).select(F.lit(test).alias("test"), "failures", status.alias("status"))


def source_freshness(df: DataFrame, as_of: Column, column: str = "prepared_at") -> DataFrame:
    """Age of the newest load at a given time: pass, warn after 7 days, error after 14 days."""
    newest = df.agg(F.max(column).alias("newest"))
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("newest")) / 86400
    status = (
        F.when(F.col("newest").isNull() | (age > ERROR_AFTER_DAYS), "error")
        .when(age > WARN_AFTER_DAYS, "warn")
        .otherwise("pass")
    )
    return newest.select("newest", age.alias("age_days"), status.alias("status"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile_counts(source: DataFrame, output: DataFrame, names: tuple[str, ...] = ()) -> DataFrame:
    """Compare (dataset, row_count) of sources and outputs; an absent side counts as zero rows. Datasets of `names` are
    listed even where both sides are absent."""
    both = source.withColumnRenamed("row_count", "s").join(
        output.withColumnRenamed("row_count", "o"), "dataset", "full_outer"
    )
    if names:
        listed = source.sparkSession.createDataFrame([(n,) for n in names], "dataset string")
        both = listed.join(both, "dataset", "full_outer")
    source_rows, output_rows = F.coalesce("s", F.lit(0)), F.coalesce("o", F.lit(0))
    # A dataset without any source is reported as empty on both sides and only flagged as missing.
    compared = F.when(F.col("s").isNull(), 0).otherwise(output_rows)
    status = (
        F.when((source_rows == 0) & (compared == 0), "both_empty")
        .when(source_rows != compared, "mismatch")
        .otherwise("match")
    )
    return both.select(
        "dataset",
        source_rows.alias("source_row_count"),
        compared.alias("output_row_count"),
        (compared - source_rows).alias("delta"),
        status.alias("status"),
        F.col("s").isNull().alias("missing_source"),
        (F.col("s").isNotNull() & F.col("o").isNull()).alias("missing_output"),
    )


def reconcile_summary(entries: DataFrame) -> DataFrame:
    """Matches, mismatches and missing sides over all datasets."""
    return entries.agg(
        F.count_if(F.col("status") == "match").alias("matches"),
        F.count_if(F.col("status") == "mismatch").alias("mismatches"),
        F.count_if(F.col("missing_output")).alias("missing_outputs"),
        F.count_if(F.col("missing_source")).alias("missing_sources"),
    )
