"""Operators on effective-dated intervals whose ends are both inclusive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.functions.dates import add_months, month_of


def month_series(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr("interval 1 month"))


def expand_months(
    frame: DataFrame, first: Column | str, last: Column | str, into: str = "month_start"
) -> DataFrame:
    """One row per calendar month the interval touches; reversed intervals give none."""
    start, end = month_of(first), month_of(last)
    # The series is never empty here; the outer form keeps Spark from computing it twice to check.
    return frame.where(start <= end).select(F.explode_outer(month_series(start, end)).alias(into), "*")


#: Expanded rows that one task holds.
TASK_ROWS = 250_000


def dealt(frame: DataFrame, key: str, rows: int) -> DataFrame:
    """``frame`` by ``key`` in as many tasks as its ``rows`` need once they are expanded to months.

    Adaptive execution would merge partitions by what they weigh before that, and a task would then hold rows without bound;
    it leaves a stated number alone.
    """
    return frame.repartition(max(1, -(-rows // TASK_ROWS)), key)


def fill_calendar(
    frame: DataFrame,
    key: str,
    month: str,
    first_month: Column,
    last_month: Column,
    zero: Sequence[str],
    blank: Sequence[str] = (),
) -> DataFrame:
    """Dense key x month grid: each row also stands for the empty months up to the next one.

    ``frame`` has one row per key and month.  Rows of a key stay where they are,
    so no grid is joined; added months carry 0 in ``zero`` and NULL in ``blank``.
    """
    order = Window.partitionBy(key).orderBy(month)
    until = F.coalesce(add_months(F.lead(month).over(order), -1), last_month)
    since = F.when(F.lag(month).over(order).isNull(), first_month).otherwise(F.col(month))
    spread = frame.select("*", month_series(since, until).alias("_months")).select(
        "*", F.explode_outer("_months").alias("_month")
    )
    real = F.col("_month") == F.col(month)
    return spread.select(
        F.col("_month").alias(month),
        key,
        *(F.when(real, F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0)).alias(c) for c in zero),
        *(F.when(real, F.col(c)).alias(c) for c in blank),
    )


def fill_month_gaps(monthly: DataFrame, month: str) -> DataFrame:
    """Add the missing months to a frame with one row per month.

    The frame has one row per calendar month, so the single ordered pass sees a
    few hundred rows however large the source is.
    """
    order = Window.orderBy(month)
    until = F.coalesce(add_months(F.lead(month).over(order), -1), F.col(month))
    others = [c for c in monthly.columns if c != month]
    spread = monthly.select("*", month_series(F.col(month), until).alias("_months")).select(
        "*", F.explode_outer("_months").alias("_month")
    )
    real = F.col("_month") == F.col(month)
    return spread.select(F.col("_month").alias(month), *(F.when(real, F.col(c)).alias(c) for c in others))


def compress_runs(
    monthly: DataFrame, key: str, month: str, state: Sequence[str], first_of: Sequence[str] = ()
) -> DataFrame:
    """Join consecutive months of equal ``state`` into one interval (gaps and islands).

    A missing month ends a run.  ``first_of`` columns keep the value of the first
    month.  A key has at most one row per month, so its window is short.
    """
    order = Window.partitionBy(key).orderBy(month)
    same = F.lag(month).over(order).eqNullSafe(add_months(month, -1))
    for column in state:
        same = same & F.lag(column).over(order).eqNullSafe(F.col(column))
    flagged = monthly.withColumn("_starts", F.when(same, 0).otherwise(1))
    numbered = flagged.withColumn("_run", F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy(key, "_run", *state)
        .agg(
            F.min(month).alias("effective_start"),
            F.last_day(F.max(month)).alias("effective_end"),
            *(F.min_by(c, month).alias(c) for c in first_of),
        )
        .drop("_run")
    )


def overlapping_pairs(
    frame: DataFrame, ident: str, same: Sequence[Column | str], start: str, end: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Pairs of rows with equal ``same`` values whose inclusive intervals overlap; of ``keep`` columns those of the left row.

    Rows move once for each year they cover.  In order of their start, a row overlaps another one of its group and year if
    the next starts before it ends or one before ends after it starts; rows that overlap none stay behind.  In any
    overlapping pair one interval starts inside the other, so each of the rest meets others only in the months it covers:
    the covering side has a row per month up to the last start of its group, the starting side only its first month.  Every
    pair is found once and a large group is spread over its months.
    """
    keys = [value if isinstance(value, str) else f"_same_{i}" for i, value in enumerate(same)]
    others = [c for c in keep if c not in keys]
    base = frame.select(
        F.col(ident).alias("_id"),
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        *others,
        *(value if isinstance(value, str) else value.alias(name) for value, name in zip(same, keys)),
    ).where(" and ".join(["_start <= _end", *(f"`{k}` is not null" for k in keys)]))
    yearly = base.select("*", F.explode_outer(F.sequence(F.year("_start"), F.year("_end"))).alias("_year"))
    # Spark would infer this on one side of the join only; stated here, both sides read the same shuffle.
    yearly = yearly.where("_year is not null")
    group = Window.partitionBy(*keys, "_year")
    order = group.orderBy("_start")
    ended = F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    meets = F.coalesce(ended >= F.col("_start"), F.lit(False)) | F.coalesce(F.lead("_start").over(order) <= F.col("_end"), F.lit(False))
    met = yearly.withColumns({"_meets": meets, "_last": F.max("_start").over(group)}).where("_meets")
    first = F.greatest("_start", F.make_date("_year", F.lit(1), F.lit(1)))
    last = F.least("_end", "_last", F.make_date("_year", F.lit(12), F.lit(31)))
    covering = expand_months(met, first, last, "_month").drop("_year", "_meets", "_last")
    starting = met.where(F.year("_start") == F.col("_year")).select(
        month_of("_start").alias("_month"), *keys, *(F.col(c).alias(f"{c}2") for c in ("_id", "_start", "_end", *others))
    )
    later = (F.col("_start2") > F.col("_start")) | (
        (F.col("_start2") == F.col("_start")) & (F.col("_id2") > F.col("_id"))
    )
    pairs = covering.join(starting, [*keys, "_month"]).where(later & (F.col("_start2") <= F.col("_end")))
    in_order = F.col("_id") < F.col("_id2")
    pick = lambda a, b: F.when(in_order, F.col(a)).otherwise(F.col(b))
    return pairs.select(
        pick("_id", "_id2").alias("left_id"),
        pick("_id2", "_id").alias("right_id"),
        *(pick(c, f"{c}2").alias(c) if c in others else c for c in keep),
        pick("_start", "_start2").alias("left_start"),
        pick("_end", "_end2").alias("left_end"),
        pick("_start2", "_start").alias("right_start"),
        pick("_end2", "_end").alias("right_end"),
    )


#: Blocks of 2^level days: the longest interval between two dates fits into two blocks of the last level.
_LEVELS = 22


def _whole_blocks(first: Column, past: Column, level: Column) -> tuple[Column, Column]:
    """First and past-the-end number of the blocks of a level that lie inside the days [first, past)."""
    size = F.call_function("shiftleft", F.lit(1), level)
    return F.call_function("shiftright", first + size - 1, level), F.call_function("shiftright", past, level)


def in_force(rules: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Disjoint stretches of days (keys, _from, _before) with the one ``_rule`` that is in force on all of their days.

    Of rules that share a day the one that starts last is in force, of those the greatest by its other columns.  Every rule is
    cut into blocks of 2^n days, at most two of a size, and a block keeps its best rule only; a stretch then looks at
    the one block of each size that holds its first day.  Work grows with the number of rules, however many share a key.
    """
    others = [c for c in rules.columns if c not in (*keys, start, end)]
    listed = rules.select(*keys, F.struct(start, end, *others).alias("_rule")).where(f"_rule.{start} <= _rule.{end}")
    bounds = listed.select(*keys, F.explode(F.array(f"_rule.{start}", F.date_add(f"_rule.{end}", 1))).alias("_from"))
    following = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))
    stretches = bounds.distinct().withColumn("_before", following).where("_before is not null")

    first, past, level = F.unix_date(f"_rule.{start}"), F.unix_date(f"_rule.{end}") + 1, F.col("_level")
    longest = F.floor(F.log2(past - first)).cast("int")
    leveled = listed.select("*", F.explode(F.sequence(F.lit(0), longest)).alias("_level"))
    low, high = _whole_blocks(first, past, level)
    above_low, above_high = _whole_blocks(first, past, level + 1)
    # The blocks of a level that no larger block inside the rule covers are the outermost ones.
    edges = F.when(low < high, F.array_distinct(F.array(low, high - 1))).otherwise(F.array().cast("array<int>"))
    spread = leveled.select("*", above_low.alias("_low"), above_high.alias("_high"), F.explode(edges).alias("_block"))
    upper = F.call_function("shiftright", F.col("_block"), F.lit(1))
    outer = spread.where(~upper.between(F.col("_low"), F.col("_high") - 1))
    best = outer.groupBy(*keys, "_level", "_block").agg(F.max("_rule").alias("_rule"))

    asked = stretches.select("*", F.explode(F.sequence(F.lit(0), F.lit(_LEVELS))).alias("_level"))
    asked = asked.withColumn("_block", F.call_function("shiftright", F.unix_date("_from"), level))
    return asked.join(best, [*keys, "_level", "_block"]).groupBy(*keys, "_from", "_before").agg(F.max("_rule").alias("_rule"))


def valid_on(
    facts: DataFrame, rules: DataFrame, keys: Sequence[str], on: str, start: str, end: str, within: tuple[Column, Column] | None = None
) -> DataFrame:
    """Attach the rule row whose interval contains ``facts.on``; facts without one keep NULLs.

    Where intervals of one key share a day, ``in_force`` tells which one counts, so no fact multiplies.  Stretches have a row
    for each month between the two dates of ``within``, outside of which no fact may lie (if not given, they are taken from the
    facts); a fact meets those of its own month only, which are at most as many as the month has days.  ``rules`` is a price list or similar reference table.  Spark
    broadcasts it while its measured size allows and falls back to a sort-merge join beyond.
    """
    others = [c for c in rules.columns if c not in (*keys, start, end)]
    chosen = in_force(rules, keys, start, end)
    if within is None:
        bounds = facts.agg(F.struct(F.min(on).alias("first"), F.max(on).alias("last"))).scalar()
        within = bounds["first"], bounds["last"]
    clipped = chosen.select("*", F.greatest("_from", within[0]).alias("_first"), F.least(F.date_sub("_before", 1), within[1]).alias("_last"))
    monthly = expand_months(clipped.where("_first <= _last"), "_first", "_last", "_month")
    condition = [facts[k] == monthly[k] for k in keys]
    condition += [month_of(facts[on]) == monthly["_month"], facts[on] >= monthly["_from"], facts[on] < monthly["_before"]]
    return facts.join(monthly, condition, "left").select(
        *(facts[c] for c in facts.columns), *(monthly[f"_rule.{c}"].alias(c) for c in (start, end, *others))
    )


def latest_before(
    points: DataFrame, history: DataFrame, key: str, point_month: str, history_month: str, value: str, rows: int | None = None
) -> DataFrame:
    """Last known ``value`` of ``history`` at or before each point, else the first known one (as-of join).

    Both sides share one ordering per key, so no point meets more than its own
    neighbour; a key holds at most one history row per month.  ``rows`` is about how
    many there are on both sides, from which the number of tasks follows.
    """
    extra = [c for c in points.columns if c not in (key, point_month)]
    asked = points.select(
        key, F.col(point_month).alias("_at"), F.lit(1).alias("_asked"), F.struct(*extra).alias("_point")
    ).withColumn(value, F.lit(None).cast(history.schema[value].dataType))
    known = history.select(
        key,
        F.col(history_month).alias("_at"),
        F.lit(0).alias("_asked"),
        F.lit(None).cast(asked.schema["_point"].dataType).alias("_point"),
        F.col(value),
    )
    order = Window.partitionBy(key).orderBy("_at", "_asked")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stacked = known.unionByName(asked)
    merged = (stacked if rows is None else dealt(stacked, key, rows)).withColumn(
        value,
        F.coalesce(F.last(value, ignorenulls=True).over(so_far), F.first(value, ignorenulls=True).over(whole)),
    )
    return merged.where("_asked = 1").select(key, F.col("_at").alias(point_month), "_point.*", value)
