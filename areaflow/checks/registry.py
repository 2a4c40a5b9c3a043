"""Registration of named queries and their check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.fixtures import DERIVED, Tables, derived_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}

# Common table expressions of the check SQL: derived tables first, then the models (models.py adds them).
EXPRESSIONS: dict[str, str] = {name: derived_sql(name) for name in DERIVED}


def comparable(df: DataFrame) -> DataFrame:
    """Bring a result to types that compare equal in any engine: doubles at 6 digits, times as text."""

    def column(field: T.StructField):
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def with_expressions(body: str) -> str:
    """Prefix the common table expressions that a query refers to, directly or through another."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in EXPRESSIONS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(EXPRESSIONS[name])
    listed = ",\n".join(f"{name} as ({sql})" for name, sql in EXPRESSIONS.items() if name in needed)
    return f"with {listed}\n{body}" if listed else body


def run_in_utc(build: Callable[[Tables], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build a query with the session zone set to UTC, in which dates and hours are defined."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return comparable(build(Tables(spark, sf_dir)))


def query(name: str, sql: str | None = None):
    """Register a function of the derived tables under a name, with its check SQL."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: run_in_utc(build, spark, sf_dir)
        if sql is not None:
            CHECK_SQL[name] = with_expressions(sql)
        return build

    return register


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in columns)


def text(*columns: str) -> str:
    return ", ".join(f"cast({c} as varchar) as {c}" for c in columns)
