"""Text expressions: absence markers, blanks, decimal comma, fallback labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_filled(value: Column) -> Column:
    """Neither NULL nor the empty string; never NULL itself."""
    return value.isNotNull() & (value != F.lit(""))


def without_marker(value: Column, marker: str) -> Column:
    """NULL where the source spelled absence as ``marker``."""
    return F.nullif(value, F.lit(marker))


def decimal_comma(value: Column) -> Column:
    """``'193,0'`` as DOUBLE; NULL when the text is no number."""
    return F.replace(value, F.lit(","), F.lit(".")).try_cast("double")


def name_or_code(name: Column, text: str, code: Column) -> Column:
    """The registered name, else an explicit text followed by the code; never blank."""
    return F.coalesce(name, F.concat_ws(" ", F.lit(text), code))
