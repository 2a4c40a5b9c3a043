"""Join helper and scratch storage."""

from pyspark.sql import functions as F

from areaflow.runtime import lookup_join, materialize, scratch_path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lookup_join_equals_a_plain_join(spark):
    fact = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("k"),
        "id",
    )
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 3), ("x", 4), (None, 5)], "k string, v int")
    for how in ("left", "inner", "left_semi"):
        joined = lookup_join(fact, lookup, "k", how)
        assert joined.columns == ["k", "id"] + ["v"] * (how != "left_semi")
        assert rows(joined) == rows(fact.join(lookup, "k", how))


def test_join_condition_keeps_unmatched_left_rows(spark):
    fact = spark.createDataFrame([(1, 5), (1, 50), (2, 5), (None, 5)], "k int, x int")
    lookup = spark.createDataFrame([(1, 10)], "k int, lim int")
    expected = [(1, 5, 10), (1, 50, None), (2, 5, None), (None, 5, None)]
    joined = lookup_join(fact, lookup, "k", "left", F.col("x") < F.col("lim"))
    assert rows(joined.select("k", "x", "lim")) == sorted(expected, key=str)


def test_materialized_table_reads_back(spark):
    df = spark.range(10).withColumn("d", F.current_date())
    stored = materialize(df, "t")
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert stored.count() == 10


class Session:
    """Stands in for a session of a cluster that names a shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default):
            assert key == "spark.checkpoint.dir"
            return "hdfs:///shared/"


def test_scratch_follows_the_shared_folder():
    first, second = scratch_path(Session, "a"), scratch_path(Session, "a")
    assert first.startswith("hdfs:///shared/areaflow/a-") and first != second
