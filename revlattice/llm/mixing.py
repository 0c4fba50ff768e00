"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.llm.common import WORD, written

SWEEPS, TOLERANCE = 12, 1e-4


def _key(column: str) -> Column:
    """The value as text that no other value shares; null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def uniform_draw(doc_id: Column | str) -> Column:
    """A number in [0, 1) that depends on the id only: 52 bits of its MD5."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def tokens(text: Column | str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD)).cast("long")


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares of a margin in proportion to its tokens to ``power``; 0 gives every value the same share."""
    sums = cells.groupBy(margin).agg(F.pow(F.sum("tokens"), F.lit(float(power))).alias("share"))
    return sums.select(F.col(margin).alias("value"), "share")


def cells_of(docs: DataFrame, margins: list[str]) -> DataFrame:
    """Token sums of every combination of margins that has tokens."""
    return docs.groupBy(*margins).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` with ``weight``: the factor on their tokens that meets every margin's target shares.

    ``targets`` maps a margin to (value, share). Values without a target or with a share that is not above 0 get weight 0;
    shares of values without cells are spread over the others. Each step scales one margin to its targets; a sweep is
    written before the next, so the plan does not grow. Sweeps end when no factor of a sweep was off 1 by more than
    ``tolerance``, or after ``sweeps``, as targets that no weights meet would go on for ever: ``residual`` is what the largest
    factor of the last sweep was off. The mean weight of a token is 1. No cells give no rows.
    """
    shares = {}
    for margin, target in targets.items():
        shares[margin] = target.filter("share > 0").groupBy("value").agg(F.sum("share").alias("share"))
        cells = cells.join(shares[margin].select(F.col("value").alias(margin)), margin, "left_semi")
    state = written(cells, "cells")
    total = state.agg(F.sum("tokens")).first()[0] or 1
    state = state.withColumn("weight", F.lit(1.0 / total))
    for margin, share in shares.items():
        present = written(share.join(state.select(F.col(margin).alias("value")).distinct(), "value", "left_semi"), "target")
        whole = present.agg(F.sum("share")).first()[0] or 1.0
        shares[margin] = present.select(F.col("value").alias(margin), (F.col("share") / F.lit(whole)).alias("share"))
    worst = None
    for _ in range(sweeps):
        for margin, share in shares.items():
            mass = state.groupBy(margin).agg(F.sum(F.col("tokens") * F.col("weight")).alias("mass"))
            factor = mass.join(share, margin).select(margin, (F.col("share") / F.col("mass")).alias(f"off_{margin}"))
            state = state.join(factor, margin).withColumn("weight", F.col("weight") * F.col(f"off_{margin}"))
        state = written(state, "sweep")
        off = [F.abs(F.col(f"off_{m}") - 1) for m in shares]
        worst = state.agg(F.max(F.greatest(*off) if len(off) > 1 else off[0])).first()[0]
        state = state.drop(*(f"off_{m}" for m in shares))
        if worst is None or worst <= tolerance:
            break
    return state.withColumn("weight", F.col("weight") * F.lit(float(total))).withColumn("residual", F.lit(worst).cast("double"))


def _scale(weights: DataFrame, share: float | None) -> float:
    """One over the largest weight, or the largest scale (in steps of 5 %) that keeps at most ``share`` of the tokens."""
    top, total = weights.agg(F.max("weight"), F.sum("tokens")).first()
    least = 1.0 / (top or 1.0)
    if not share or not total:
        return least
    scales = [least * 1.05**i for i in range(400)]
    kept = weights.agg(*(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * F.lit(s))) for s in scales)).first()
    return max([s for s, mass in zip(scales, kept, strict=True) if mass <= share * total], default=least)


def mixed(docs: DataFrame, margins: list[str], powers: dict[str, float] | None = None, targets: dict[str, DataFrame] | None = None, share: float | None = None, carried: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, tokens, margins): weight, probability, selected, residual, and the ``carried`` columns.

    Margins are text. Targets come as (value, share) per margin, or from ``powers`` of the margin's own token sums. The
    probability of a document is its cell's weight over the largest weight, so that every one is at most 1 and kept tokens
    meet the targets in expectation. With ``share`` the weights are scaled further until about that share of all tokens is
    kept, cut at 1, so that cells which run out fall short of their target. Selection compares it with a draw
    from the id, so a rerun selects the same rows. Null margin values form a value of their own. Documents without tokens
    (null or empty text) carry no weight: probability 0, not selected. Rows that repeat an id share its draw. ``residual``
    tells how far the margins are still off (see ``rake``), the same for all rows that have a weight.
    """
    keyed = docs.select("doc_id", "tokens", *(_key(m).alias(m) for m in margins), *(carried or ()))
    cells = written(cells_of(keyed, margins), "sums")
    given = {m: targets[m].withColumn("value", _key("value")) if targets and m in targets else tempered(cells, m, (powers or {}).get(m, 1.0)) for m in margins}
    weights = rake(cells, given)
    scale = _scale(weights, share)
    weights = weights.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)))
    same = reduce(lambda a, b: a & b, (F.col(f"d.{m}") == F.col(f"w.{m}") for m in margins)) & (F.col("d.tokens") > 0)
    joined = keyed.alias("d").join(written(weights, "weights").alias("w"), same, "left")
    chance = F.coalesce("w.probability", F.lit(0.0))
    return joined.select("d.doc_id", "d.tokens", F.coalesce("w.weight", F.lit(0.0)).alias("weight"), chance.alias("probability"), (uniform_draw("d.doc_id") < chance).alias("selected"), "w.residual", *(f"d.{c}" for c in carried or ()))
