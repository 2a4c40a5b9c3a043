"""Min-max component scores and the final score per area and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.functions.rules import risk_band
from areaflow.operators.aggregate import AREA_HOUR, min_max
from areaflow.plans.context import NEUTRAL_WEIGHT
from areaflow.runtime import footer_bounds, lookup_join, with_bounds

# Fixed values of the score formula.
FORMULA_VERSION = "v1_transparent_weighted_proxy"
AVERAGE_SHARE, LARGEST_SHARE = 0.6, 0.4
FREQUENCY_SHARE, SEVERITY_SHARE, ALERT_SHARE = 0.5, 0.3, 0.2
BASE_SHARE, WEIGHT_SHARE = 0.6, 0.4
DEFAULT_NETWORK_SCORE = 50.0

CONTEXT_COLUMNS = ("score", "decile", "disadvantage_weight", "route_count", "stop_count")


def join_context(exposure: DataFrame, context: DataFrame) -> DataFrame:
    """Exposure with the context of its area; areas outside the index keep null context."""
    columns = context.select("area_code", *CONTEXT_COLUMNS, "transport_access_proxy_score")
    return lookup_join(exposure, columns, "area_code")


def _measures() -> dict[str, Column]:
    zero = F.lit(0.0)
    return {
        "delay_rate": F.coalesce("delay_observation_rate", zero),
        "avg_delay": F.coalesce("avg_arrival_delay_seconds", zero),
        "max_delay": F.coalesce(F.col("max_delay_seconds").cast("double"), zero),
        "alert_count": F.col("disruption_alert_count").cast("double"),
    }


def score_bounds(exposure: DataFrame) -> DataFrame:
    """Smallest and largest value of the four scaled measures over the whole table, as one row."""
    return min_max(exposure, **_measures())


#: Prefix of the columns in which stored exposure keeps the four scaled measures.
SCALED = "scaled_"


def with_scaled(exposure: DataFrame) -> DataFrame:
    """Add the four scaled measures as columns, so that a stored table has their bounds in its file footers."""
    return exposure.withColumns({f"{SCALED}{name}": c for name, c in _measures().items()})


def stored_bounds(spark: SparkSession, path: str) -> DataFrame:
    """score_bounds() of a stored table of with_scaled(), from the footers of its files: no row is read."""
    return footer_bounds(spark, path, {name: f"{SCALED}{name}" for name in _measures()})


def _position(value: Column, name: str) -> Column:
    low, high = F.col(f"min_{name}"), F.col(f"max_{name}")
    return (value - low) / F.nullif(high - low, F.lit(0.0))


def _flat(name: str) -> Column:
    return F.col(f"max_{name}") == F.col(f"min_{name}")


def score_components(exposure: DataFrame, context: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Component, disruption, disadvantage, network and impact scores.

    Scores are relative to the bounds of the loaded rows; bounds of an earlier run can be given so that
    new rows are scored on the same scale. Without bounds the exposure is read twice; of a stored one they can be had
    from stored_bounds(). If only one of the two severity measures is flat, severity is null.
    """
    m = _measures()
    frequency = F.when(_flat("delay_rate"), 0.0).otherwise(100.0 * _position(m["delay_rate"], "delay_rate"))
    severity = F.when(_flat("avg_delay") & _flat("max_delay"), 0.0).otherwise(
        100.0
        * (
            AVERAGE_SHARE * _position(m["avg_delay"], "avg_delay")
            + LARGEST_SHARE * _position(m["max_delay"], "max_delay")
        )
    )
    alerts = F.when(_flat("alert_count"), 0.0).otherwise(100.0 * _position(m["alert_count"], "alert_count"))
    weight = F.coalesce("disadvantage_weight", F.lit(NEUTRAL_WEIGHT))
    rows = with_bounds(join_context(exposure, context), score_bounds(exposure) if bounds is None else bounds)
    return (
        rows.withColumns(
            {
                "delay_frequency_score": frequency,
                "delay_severity_score": severity,
                "alert_exposure_score": alerts,
                "disadvantage_score": weight * 100.0,
                "network_exposure_score": F.coalesce("transport_access_proxy_score", F.lit(DEFAULT_NETWORK_SCORE)),
                "score_formula_version": F.lit(FORMULA_VERSION),
            }
        )
        .withColumn(
            "disruption_score",
            FREQUENCY_SHARE * F.col("delay_frequency_score")
            + SEVERITY_SHARE * F.col("delay_severity_score")
            + ALERT_SHARE * F.col("alert_exposure_score"),
        )
        .withColumn("equity_impact_score", F.col("disruption_score") * (BASE_SHARE + WEIGHT_SHARE * weight))
        .drop(*[f"{side}_{name}" for name in m for side in ("min", "max")])
    )


COMPONENT_COLUMNS = (
    *AREA_HOUR,
    "area_name",
    "observation_count",
    "delayed_observation_count",
    "delay_observation_rate",
    "disruption_alert_count",
    "delay_frequency_score",
    "delay_severity_score",
    "alert_exposure_score",
    "disruption_score",
    "disadvantage_score",
    "network_exposure_score",
    "equity_impact_score",
    "score_formula_version",
)
SCORE_COLUMNS = (
    *AREA_HOUR,
    "area_name",
    "score",
    "decile",
    "disadvantage_weight",
    "route_count",
    "stop_count",
    "observation_count",
    "distinct_trip_count",
    "distinct_stop_count",
    "delayed_observation_count",
    "delay_observation_rate",
    "avg_arrival_delay_seconds",
    "avg_departure_delay_seconds",
    "max_delay_seconds",
    "major_delay_count",
    "service_alert_count",
    "disruption_alert_count",
    "disruption_score",
    "disadvantage_score",
    "network_exposure_score",
    "equity_impact_score",
)


def _final(rows: DataFrame) -> DataFrame:
    return rows.select(
        *SCORE_COLUMNS,
        risk_band(F.col("equity_impact_score")).alias("equity_risk_band"),
        "score_formula_version",
        F.current_timestamp().alias("calculated_at"),
    )


def area_hour_score(exposure: DataFrame, context: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Final score table. Exposure and context columns are carried along instead of joined a second time."""
    return _final(score_components(exposure, context, bounds))


def join_score_exposure(components: DataFrame, exposure: DataFrame, context: DataFrame) -> DataFrame:
    """Final score table from a stored component table: joins exposure on its unique key, then context."""
    carried = ("area_name", "observation_count", "delayed_observation_count", "delay_observation_rate")
    scores = components.select(*COMPONENT_COLUMNS)
    rest = exposure.drop(*carried, "disruption_alert_count")
    joined = scores.join(rest, list(AREA_HOUR), "inner")
    columns = context.select("area_code", *CONTEXT_COLUMNS)
    return _final(lookup_join(joined, columns, "area_code"))
