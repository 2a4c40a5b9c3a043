"""Session, scratch storage and join helpers shared by all operators."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def get_session(app: str = "areaflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; cluster sizing stays with spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder of spark.checkpoint.dir, or in the warehouse where that is unset.

    Both are folders that the driver and all executors see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/areaflow/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several later steps read, and return it read back.

    The files live in the shared scratch folder, so a lost executor costs no recomputation of the
    (much larger) facts behind the table.
    """
    return materialize_at(df, scratch_path(df.sparkSession, label))


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    """Write a table to a path, and return it read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def footer_bounds(spark: SparkSession, path: str, measures: dict[str, str]) -> DataFrame:
    """One row with min_<name> and max_<name> of columns of a stored Parquet table, from the statistics in the footers.

    The columns hold numbers without NaN. Spark answers min and max from footers in its newer Parquet source only,
    so that is chosen for this read.
    """
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = spark.read.parquet(path)
        bounds = rows.agg(*[f(F.col(c)).alias(f"{f.__name__}_{name}") for name, c in measures.items() for f in (F.min, F.max)])
        return spark.createDataFrame([bounds.first()], bounds.schema)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def lookup_join(
    fact: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "left", condition: Column | None = None
) -> DataFrame:
    """Join a fact table to a lookup table on equal column names and an optional further condition.

    One plan at every size: adaptive execution broadcasts a lookup whose run-time size allows it, and splits the
    tasks of hot keys. Fact rows with a null key match nothing; in an outer join they spread over as many tasks as
    there are input partitions.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how == "left":
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        fact = fact.withColumn("_spread", F.when(null, F.spark_partition_id() + 1).otherwise(0))
        lookup = lookup.withColumn("_spread", F.lit(0))
        keys.append("_spread")
    if condition is None:
        return fact.join(lookup, keys, how).drop("_spread")
    lookup = lookup.withColumnsRenamed({k: f"_lookup_{k}" for k in keys})
    equal = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_lookup_{k}") for k in keys])
    return fact.join(lookup, equal & condition, how).drop("_spread", *[f"_lookup_{k}" for k in keys])


def with_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Attach the columns of an ungrouped aggregate to every row.

    The one row is a scalar subquery: Spark computes it once and puts it into the expressions as a constant.
    """
    row = bounds.select(F.struct(*bounds.columns)).scalar()
    return df.withColumn("_bounds", row).select(*[F.col(f"`{c}`") for c in df.columns], "_bounds.*")
