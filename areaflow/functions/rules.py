"""Predicates, thresholds and bands of the domain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the domain rules.
DELAY_LIMIT_SECONDS = 300
MINOR_LIMIT_SECONDS = 600
MODERATE_LIMIT_SECONDS = 1200
DELAY_RANGE_SECONDS = (-3600, 86400)
DISRUPTION_EFFECTS = (
    "NO_SERVICE",
    "REDUCED_SERVICE",
    "SIGNIFICANT_DELAYS",
    "DETOUR",
    "MODIFIED_SERVICE",
    "STOP_MOVED",
    "OTHER_EFFECT",
)
ALERT_BANDS = (
    ("critical", ("NO_SERVICE",)),
    ("high", ("REDUCED_SERVICE", "SIGNIFICANT_DELAYS")),
    ("moderate", ("DETOUR", "MODIFIED_SERVICE", "STOP_MOVED")),
    ("unknown", ("OTHER_EFFECT",)),
)
RISK_BANDS = (("very_high", 80), ("high", 60), ("moderate", 40), ("low", 20))
HIGH_BANDS = ("high", "very_high")
HIGH_IMPACT_BANDS = ("moderate", "high", "very_high")
HIGH_IMPACT_AVERAGE = 35
PEAK_HOURS = (("morning_peak", 7, 9), ("evening_peak", 16, 18), ("midday", 10, 15))
AREA_CODE_TEXT = r"^\d{9}$"
AREA_CODE_MAX_LENGTH = 32
FOOTER_PHRASES = (
    "commonwealth of australia",
    "australian bureau of statistics",
    "socio-economic indexes for australia",
)


def _first_match(pairs: list[tuple[Column, str]], otherwise: str) -> Column:
    chain = reduce(lambda acc, p: acc.when(p[0], p[1]), pairs[1:], F.when(pairs[0][0], pairs[0][1]))
    return chain.otherwise(otherwise)


def max_delay(arrival: Column, departure: Column) -> Column:
    """The later of both delays; the present one when the other is null."""
    return F.greatest(arrival, departure)


def is_late(delay: Column) -> Column:
    """Strictly more than five minutes; null is not late."""
    return F.coalesce(delay > DELAY_LIMIT_SECONDS, F.lit(False))


def delay_band(delay: Column) -> Column:
    return _first_match(
        [
            (delay.isNull() | (delay <= DELAY_LIMIT_SECONDS), "early_or_on_time"),
            (delay <= MINOR_LIMIT_SECONDS, "minor_delay"),
            (delay <= MODERATE_LIMIT_SECONDS, "moderate_delay"),
        ],
        "major_delay",
    )


def is_disruption(effect: Column) -> Column:
    return F.coalesce(F.upper(effect).isin(*DISRUPTION_EFFECTS), F.lit(False))


def alert_band(effect: Column) -> Column:
    name = F.upper(F.coalesce(effect, F.lit("")))
    return _first_match([(name.isin(*effects), band) for band, effects in ALERT_BANDS], "informational")


def risk_band(score: Column) -> Column:
    """Band of an impact score; a null score is minimal."""
    return _first_match([(score >= limit, band) for band, limit in RISK_BANDS], "minimal")


def peak_period(hour: Column) -> Column:
    return _first_match([(hour.between(lo, hi), name) for name, lo, hi in PEAK_HOURS], "off_peak")


def decile_group(decile: Column) -> Column:
    """Three groups of deciles; rows without a decile must be filtered out before."""
    return _first_match(
        [
            (decile <= 3, "most_disadvantaged_deciles_1_3"),
            (decile <= 7, "middle_deciles_4_7"),
        ],
        "least_disadvantaged_deciles_8_10",
    )


def sufficiency(days: Column) -> Column:
    return _first_match(
        [(days < 1, "insufficient"), (days <= 6, "exploratory"), (days <= 13, "analyst-ready")], "strong"
    )


#: What to do next at each rating.
ACTIONS = {
    "insufficient": "Too few days: keep collecting until a week of quarter-hourly snapshots is there.",
    "exploratory": "Less than two weeks: collect further and mark results as a first look.",
    "analyst-ready": "Enough for a report that states how many days it rests on.",
    "strong": "Enough to compare days and weeks.",
}


def recommended_action(rating: Column) -> Column:
    known = [(rating == name, text) for name, text in ACTIONS.items() if name != "strong"]
    return _first_match(known, ACTIONS["strong"])


def evidence_label(rating: Column) -> Column:
    return _first_match([(rating.isin("analyst-ready", "strong"), "evidence-ready")], "exploratory")


def valid_coordinates(lat: Column, lon: Column) -> Column:
    """Numeric latitude and longitude within range; null or text gives false."""
    inside = lat.try_cast("double").between(-90, 90) & lon.try_cast("double").between(-180, 180)
    return F.coalesce(inside, F.lit(False))


def valid_area_code(code: Column) -> Column:
    return F.coalesce(F.trim(code).rlike(AREA_CODE_TEXT), F.lit(False))


def valid_area_name(name: Column) -> Column:
    """Present, not a copyright line and without a publisher phrase."""
    text = F.lower(F.trim(name))
    phrase = reduce(lambda a, b: a | b, [text.contains(p) for p in FOOTER_PHRASES])
    return F.coalesce((text != "") & ~text.startswith("©") & ~phrase, F.lit(False))


def outside_delay_range(delay: Column) -> Column:
    low, high = DELAY_RANGE_SECONDS
    return F.coalesce((delay < low) | (delay > high), F.lit(False))
