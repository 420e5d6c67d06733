"""Column expressions shared by the layers. All are Spark built-ins (codegen'd).

The session runs with ANSI mode on, where ``to_timestamp('bad')`` or ``x / 0``
raise. Raw API values may be malformed, so every parse and every ratio uses
the ``try_`` form, which yields null instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel labels and the name fragments that select them, in
# order of precedence (the first match wins).
CHANNEL_RULES = (("youtube", "Youtube"), ("facebook", "Facebook"))
UNKNOWN_CHANNEL = "Unknown"

# An ISO-8601 instant is time-zone aware if an explicit offset follows a time of
# day: the "-20" that ends "2024-01-20" is a day, not an offset.
OFFSET_SUFFIX = r"[0-9]:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?\s*(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_instant(c: str | Column) -> Column:
    """ISO-8601 text -> TIMESTAMP (an instant); null when unparseable."""
    return F.try_to_timestamp(col(c))


def parse_day(c: str | Column) -> Column:
    """``YYYY-MM-DD`` text -> DATE; null when unparseable."""
    return F.try_to_date(col(c))


def utc_day(c: str | Column) -> Column:
    """Calendar date of an instant in the session zone (UTC, see ``session.use_utc``)."""
    return F.to_date(col(c))


def is_zone_aware(c: str | Column) -> Column:
    """True when the ISO text has a time of day that ends in ``Z`` or a numeric offset."""
    return col(c).rlike(OFFSET_SUFFIX)


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division that yields null for a zero or null denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def channel_of(name: str | Column) -> Column:
    """Channel from a media name: case-insensitive substring, first rule wins."""
    lowered = F.lower(col(name))
    expr = None
    for fragment, label in CHANNEL_RULES:
        hit = lowered.contains(fragment)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return expr.otherwise(F.lit(UNKNOWN_CHANNEL))


def month_key(date: str | Column) -> Column:
    """DATE -> ``YYYY-MM`` text."""
    return F.date_format(col(date), "yyyy-MM")


def as_percent(c: str | Column) -> Column:
    """Fraction -> percent for display."""
    return col(c) * F.lit(100.0)


def all_not_null(*names: str) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).isNotNull()
    return cond
