"""Wall-clock expressions.

Schedule and actual instants are local times at two different airports, so they are
TIMESTAMP_NTZ and nothing here may depend on the session time zone.  ``timestampdiff``
and ``date_format`` convert NTZ input through the session zone (a departure at 02:30 on
a night when clocks go forward moves by an hour), hence interval division and
``hour``/``minute`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_instant(text: Column) -> Column:
    """0 to 9 fraction digits or a bare date; NULL for anything else."""
    return text.try_cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated toward zero, as BIGINT.

    Any two instants fit (the years 1 to 9999 are some 5 billion minutes), and so does the
    difference of two results; an absurd instant yields an absurd number, never a NULL.
    """
    return F.call_function("div", end - start, F.expr("INTERVAL '1' MINUTE"))


def clock_text(instant: Column) -> Column:
    """``HH:mm``."""
    def two(part: Column) -> Column:
        return F.lpad(part.cast("string"), 2, "0")

    return F.concat(two(F.hour(instant)), F.lit(":"), two(F.minute(instant)))


def weekday_name(day: Column, names: Sequence[str]) -> Column:
    """Name of the weekday, NULL for a NULL day; ``names`` starts on Sunday.

    The NULL test is needed: over an array without NULLs, ``element_at`` is taken to be
    never NULL even if its index is.
    """
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.dayofweek(day))
    return F.when(day.isNotNull(), name)


def first_of_month(day: Column) -> Column:
    return F.trunc(day, "MM")
