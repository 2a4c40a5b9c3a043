"""Text, number, flag, time and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
TRUE_WORDS = ("true", "1", "yes")
TEXT_SEPARATOR = " | "


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain decimal number gives null."""
    return F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))


def to_whole(text: Column) -> Column:
    """Text to bigint; '12.0' counts as 12, fractions and other text give null."""
    number = to_number(text)
    return F.coalesce(
        F.trim(text).try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint"))
    )


def to_flag(value: Column) -> Column:
    """true, 1 and yes in any case are true; everything else, null included, is false."""
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def to_time(text: Column) -> Column:
    """ISO text (with or without offset) to timestamp in the session zone; bad text gives null."""
    return F.trim(text).try_cast("timestamp")


def blank_to_null(text: Column) -> Column:
    """Empty and blank-only text becomes null; other text is kept as it is."""
    return F.when(F.trim(text) != "", text)


def epoch_to_utc(seconds: Column) -> Column:
    """Epoch seconds to timestamp."""
    return F.timestamp_seconds(seconds)


def joined_texts(translations: Column) -> Column:
    """Non-empty texts of array<struct<text>> joined in order; null when nothing is left."""
    texts = F.filter(translations["text"], lambda t: t.isNotNull() & (t != ""))
    return F.nullif(F.array_join(texts, TEXT_SEPARATOR), F.lit(""))


def path_part(path: Column, name: str, pattern: str = r"\d+") -> Column:
    """Value of a name=value directory in a path, null when the path has none."""
    return F.nullif(F.regexp_extract(path, rf"(?:^|/){name}=({pattern})(?:/|$)", 1), F.lit(""))


def snapshot_time_of(path: Column) -> Column:
    """Snapshot minute encoded in year=/month=/day=/hour=/minute= directories."""
    year, month, day, hour, minute = (
        path_part(path, name, rf"\d{{{digits}}}").cast("int")
        for name, digits in (("year", 4), ("month", 2), ("day", 2), ("hour", 2), ("minute", 2))
    )
    return F.try_make_timestamp(year, month, day, hour, minute, F.lit(0))
