"""Measures that can be aggregated in two steps.

A measure is one or more partial aggregates, a merge for each, and a closing
expression.  The same measure therefore works over raw rows (``summarise``) or
over rows first reduced to one per join key (``summarise_through``), which keeps
a join from ever moving more than one row per key and group.

Sums stay exact (integer or decimal) until the closing division, so results do
not depend on the order in which partitions are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    partials: tuple[Column, ...]
    merges: tuple[Callable[[Column], Column], ...]
    close: Callable[..., Column]

    def _part_names(self) -> list[str]:
        return [f"{self.name}__{i}" for i in range(len(self.partials))]

    def partial_columns(self) -> list[Column]:
        return [p.alias(n) for p, n in zip(self.partials, self._part_names())]

    def merge_columns(self) -> list[Column]:
        return [merge(F.col(n)).alias(n) for merge, n in zip(self.merges, self._part_names())]

    def closed(self) -> Column:
        return self.close(*(F.col(n) for n in self._part_names())).alias(self.name)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


Condition = Column | str | None


def _only(value: Column, when: Condition) -> Column:
    """``value`` where ``when`` (a column or SQL text) holds."""
    if when is None:
        return value
    return F.when(F.expr(when) if isinstance(when, str) else when, value)


def divide(numerator: Column, denominator: Column) -> Column:
    """Quotient of two exact numbers as a double; NULL when the divisor is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def count(name: str, when: Condition = None, of: Column | str | None = None) -> Measure:
    """Rows, rows meeting ``when``, or non-null values of ``of``."""
    value = F.lit(1) if of is None else _col(of)
    return Measure(name, (F.count(_only(value, when)),), (F.sum,), lambda n: n)


def count_keys(name: str, when: Condition = None) -> Measure:
    """Distinct join keys with a row (meeting ``when``); for ``summarise_through`` only."""
    return Measure(
        name, (F.max(_only(F.lit(1), when)),), (F.sum,), lambda n: F.coalesce(n, F.lit(0)).cast("bigint")
    )


def total(name: str, value: Column | str, when: Condition = None, empty: int | None = None) -> Measure:
    """Sum; NULL over no rows unless ``empty`` gives another value."""
    close = (lambda s: s) if empty is None else (lambda s: F.coalesce(s, F.lit(empty)))
    return Measure(name, (F.sum(_only(_col(value), when)),), (F.sum,), close)


def highest(name: str, value: Column | str, when: Condition = None) -> Measure:
    return Measure(name, (F.max(_only(_col(value), when)),), (F.max,), lambda m: m)


def lowest(name: str, value: Column | str, when: Condition = None) -> Measure:
    return Measure(name, (F.min(_only(_col(value), when)),), (F.min,), lambda m: m)


def mean(name: str, value: Column | str, when: Condition = None, unit: int = 1) -> Measure:
    """Average of the non-null values, in multiples of ``unit``."""
    picked = _only(_col(value), when)
    return Measure(
        name, (F.sum(picked), F.count(picked)), (F.sum, F.sum), lambda s, n: divide(s, n) / F.lit(float(unit))
    )


def combine(name: str, parts: Sequence[Measure], close: Callable[..., Column]) -> Measure:
    """A measure computed from the closed values of others."""
    sizes = [len(p.partials) for p in parts]

    def finish(*columns: Column) -> Column:
        values, at = [], 0
        for part, size in zip(parts, sizes):
            values.append(part.close(*columns[at : at + size]))
            at += size
        return close(*values)

    return Measure(
        name,
        tuple(c for p in parts for c in p.partials),
        tuple(m for p in parts for m in p.merges),
        finish,
    )


def rate(name: str, numerator: Measure, denominator: Measure) -> Measure:
    return combine(name, (numerator, denominator), divide)


def share(name: str, when: Column | str) -> Measure:
    """Rows meeting ``when`` over all rows."""
    return rate(name, count("hits", when), count("rows"))


def summarise(frame: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One row per group; a single aggregation with map-side combine."""
    grouped = frame.groupBy(*by).agg(*(c for m in measures for c in m.partial_columns()))
    return grouped.select(*by, *(m.closed() for m in measures))


def summarise_through(
    frame: DataFrame,
    key: str,
    dimension: DataFrame,
    by: Sequence[str],
    measures: Sequence[Measure],
) -> DataFrame:
    """Join ``dimension`` on its unique ``key`` and aggregate by ``by``.

    Rows are reduced to one per key and own grouping column first, so a key
    that holds a large share of the rows reaches the join as a few rows.
    """
    own = [c for c in by if c in frame.columns]
    borrowed = [c for c in by if c not in own]
    reduced = frame.groupBy(key, *own).agg(*(c for m in measures for c in m.partial_columns()))
    joined = reduced.join(dimension.select(key, *borrowed), key)
    grouped = joined.groupBy(*by).agg(*(c for m in measures for c in m.merge_columns()))
    return grouped.select(*by, *(m.closed() for m in measures))
