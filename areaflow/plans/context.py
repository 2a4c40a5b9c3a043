"""Area context: disadvantage weight and network access per area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow.functions.ranking import percent_rank_nulls_last
from areaflow.operators.aggregate import min_max
from areaflow.runtime import lookup_join, with_bounds

NEUTRAL_WEIGHT = 0.5
FLAT_ACCESS_SCORE = 50.0


def disadvantage_weight(index: DataFrame) -> DataFrame:
    """Weight between 0 and 1 from decile, else percentile, else score rank, else neutral.

    The rank runs over every area, also those that get their weight from decile or percentile.
    """
    weight = (
        F.when(F.col("decile").isNotNull(), (11.0 - F.col("decile").cast("double")) / 10.0)
        .when(F.col("percentile").isNotNull(), (100.0 - F.col("percentile").cast("double")) / 100.0)
        .when(F.col("score").isNotNull(), 1.0 - F.col("_rank"))
        .otherwise(NEUTRAL_WEIGHT)
    )
    ranked = percent_rank_nulls_last(index, "score", "_rank")
    return ranked.withColumn("disadvantage_weight", weight).drop("_rank")


def area_context(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Index values, weight, stop and route counts (of area_counts()) and the scaled access proxy per area."""
    columns = ("area_code", "area_name", "score", "decile", "percentile")
    counted = lookup_join(index.select(*columns), counts, "area_code").na.fill(0, ["stop_count", "route_count"])
    access = F.col("route_count") + F.col("stop_count")
    low, high = F.col("min_access"), F.col("max_access")
    proxy = F.when(high == low, FLAT_ACCESS_SCORE).otherwise(
        100.0 * (access - low).cast("double") / F.nullif((high - low).cast("double"), F.lit(0.0))
    )
    scaled = with_bounds(disadvantage_weight(counted), min_max(counted, access=access))
    return scaled.withColumn("transport_access_proxy_score", proxy).select(
        *columns, "disadvantage_weight", "stop_count", "route_count", "transport_access_proxy_score"
    )
