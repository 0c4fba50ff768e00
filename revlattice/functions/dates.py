"""Calendar expressions on date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_of(value: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(value), "MM")


def add_months(value: Column | str, n: int) -> Column:
    return F.add_months(_col(value), n)


def months_apart(later: Column | str, earlier: Column | str) -> Column:
    """Whole calendar months between two dates, ignoring the day of the month."""
    later, earlier = _col(later), _col(earlier)
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Signed days from ``earlier`` to ``later``; timestamps count by their date."""
    return F.datediff(_col(later), _col(earlier))


def micros_between(later: Column | str, earlier: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(earlier), _col(later))


MICROS_PER_HOUR = 3_600_000_000
