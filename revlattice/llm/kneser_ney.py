"""Text quality by the perplexity of an interpolated modified Kneser-Ney model.

Character trigrams of trusted texts are counted in shards of the trigram space and joined into probabilities by DataFrame
operations; each chunk's distinct trigrams then fetch theirs. A document whose perplexity is above a quantile of the
trusted texts of its language is rejected.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.llm import chunks
from revlattice.llm.common import written

CHUNK_CHARS = 2_500_000
#: Ids that share a cell differ in so many bits only.
CELL_BITS = 10
QUANTILE, SLACK = 0.99, 1.1
ACCURACY = 10_000
#: A symbol has 21 bits; two numbers past the last code point begin and end a text.
BITS, START, STOP = 21, 0x110000, 0x110001
MASK = (1 << BITS) - 1


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Each text's distinct trigrams, from two starts to one stop, and how often it holds them."""
    sizes = np.fromiter((len(t) + 3 for t in texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(sizes) - sizes
    line = np.empty(int(sizes.sum()), dtype=np.int64)
    for text, begin, size in zip(texts, begins.tolist(), sizes.tolist(), strict=True):
        line[begin : begin + 2], line[begin + size - 1] = START, STOP
        line[begin + 2 : begin + size - 1] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = line[:-2] << BITS
    codes |= line[1:-1]
    codes <<= BITS
    codes |= line[2:]
    del line
    numbers, keys = pd.factorize(codes)
    numbers = numbers.astype(np.int32)
    del codes
    lengths, found, times = np.zeros(len(texts), dtype=np.int64), [], []
    for i, (begin, size) in enumerate(zip(begins.tolist(), sizes.tolist(), strict=True)):
        own, n = np.unique(numbers[begin : begin + size - 2], return_counts=True)
        lengths[i] = len(own)
        found.append(own)
        times.append(n.astype(np.int32))
    # Windows across two texts got numbers as well; they are left out.
    found = np.concatenate(found)
    used = np.zeros(len(keys), dtype=bool)
    used[found] = True
    place = np.cumsum(used, dtype=np.int32) - 1
    return lengths, place[found].astype(np.int32), pa.array(keys[used], pa.int64()), np.concatenate(times)


def _discounts(grams: DataFrame, count: str) -> tuple[float, float, float]:
    """The three discounts of a level from how many of its grams have counts 1 to 4."""
    n1, n2, n3, n4 = (x or 0 for x in grams.agg(*(F.sum((F.col(count) == i).cast("long")) for i in (1, 2, 3, 4))).first())
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    steps = [(1, n1, n2), (2, n2, n3), (3, n3, n4)]
    return tuple(min(i, max(0.05, i - (i + 1) * y * b / a)) if a else 0.5 * i for i, a, b in steps)


def _level(grams: DataFrame, count: str, context: str, level: str) -> tuple[DataFrame, DataFrame]:
    """Discounted shares of a level's grams in their context, and each context's weight for the level below."""
    d1, d2, d3 = _discounts(grams, count)
    off = F.when(F.col(count) == 1, d1).when(F.col(count) == 2, d2).otherwise(d3)
    sums = grams.groupBy(context).agg(F.sum(count).alias("total"), F.sum(off).alias("freed"))
    shares = grams.join(sums, context).select("gram", (F.greatest(F.col(count) - off, F.lit(0.0)) / F.col("total")).alias(f"share{level}"))
    return shares, sums.select(context, (F.col("freed") / F.col("total")).alias(f"rest{level}"))


def _gram(*parts: Column) -> Column:
    return reduce(lambda x, y: F.shiftleft(x, BITS).bitwiseOR(y), parts)


def probabilities(counted: DataFrame) -> DataFrame:
    """(part, gram, score): log10 of the model's probability of every trigram's last symbol in ``counted`` (part, gram, n).

    Rows with n = 0 are trigrams to be scored only. Probabilities of all symbols and of one unknown add up to 1 in every
    context; a context that training lacks uses the level below, and the lowest level is interpolated with a uniform one.
    """
    low = lambda c: F.col(c).bitwiseAND(MASK)
    rows = counted.select(
        "part", "gram", "n", F.shiftright("gram", BITS).alias("before"), F.col("gram").bitwiseAND((1 << 2 * BITS) - 1).alias("pair"), low("gram").alias("last")
    ).withColumn("mid", low("before"))
    seen = rows.filter("n > 0")
    pairs = seen.groupBy("pair", "mid", "last").agg(F.count(F.lit(1)).alias("n"))
    singles = pairs.groupBy("last").agg(F.count(F.lit(1)).alias("n"))
    types = singles.count()
    share3, rest3 = _level(seen.select("gram", "before", "n"), "n", "before", "3")
    share2, rest2 = _level(pairs.select(F.col("pair").alias("gram"), "mid", "n"), "n", "mid", "2")
    share1, rest1 = _level(singles.select(F.col("last").alias("gram"), F.lit(0).alias("all"), "n"), "n", "all", "1")
    freed = (rest1.first() or {"rest1": 1.0})["rest1"]
    value = lambda c, missing: F.coalesce(c, F.lit(missing))
    scored = (
        rows.join(share3, "gram", "left")
        .join(rest3, "before", "left")
        .join(share2.withColumnRenamed("gram", "pair"), "pair", "left")
        .join(rest2, "mid", "left")
        .join(share1.withColumnRenamed("gram", "last"), "last", "left")
    )
    p1 = value("share1", 0.0) + F.lit(freed / (types + 1))
    p2 = value("share2", 0.0) + value("rest2", 1.0) * p1
    p3 = value("share3", 0.0) + value("rest3", 1.0) * p2
    return scored.select("part", "gram", F.log10(p3).alias("score"))


def perplexities(docs: DataFrame, parts: int | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, perplexity) for every row of ``docs`` (doc_id, text, learn): per symbol, the end of the text included.

    Rows with ``learn`` are the trusted texts (null: not). Null and empty texts have only their end. Without trusted rows
    every symbol is equally unlikely. Rows that repeat a doc_id count one by one.
    """
    parts = parts or chunks.part_count(docs)
    pieces = written(chunks.chunked(docs, trigrams, parts, chunk_chars, exchanged=False), "pieces")

    def summary(part: int, tables: list[pa.Table]) -> pa.Table:
        keys, counts, _ = chunks.totals(tables)
        return pa.table({"part": pa.array([part] * len(keys), pa.int32()), "gram": keys, "n": counts})

    counted = written(chunks.summarised(pieces, summary, "part int, gram long, n long", chunks.GRAMS), "grams")
    scores = written(probabilities(counted), "scores")

    def answer(part: int, tables: list[pa.Table], known: pa.Table) -> list[dict]:
        gram, value = known.column("gram").to_numpy(), known.column("score").to_numpy()
        order = np.argsort(gram)
        return [{"score": value[order[np.searchsorted(gram, t.column("key").to_numpy(), sorter=order)]]} for t in tables]

    def finish(documents: pa.Table, found: pa.Table) -> pa.Table:
        score, out = found.column("score").to_numpy(), []
        for sequence, times in zip(chunks.each_document(documents), chunks.each_document(documents, "times"), strict=True):
            out.append(float(10 ** -((score[sequence] * times).sum() / times.sum())))
        return pa.table({"doc_id": chunks.flat(documents.column("doc_id")), "perplexity": pa.array(out, pa.float64())})

    texts = pieces.filter(F.col("part") == chunks.DOCS)
    answers = chunks.answered(pieces, answer, scores, chunks.GRAMS)
    return chunks.reassembled(texts, answers, finish, "doc_id long, perplexity double", {"score": pa.float64()})


def marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, text, learn) of every row; ``trusted`` has distinct ids.

    Texts do not move to meet their flag: every trusted id travels to them, two bytes each in the cell of its neighbours.
    """
    cell, place = F.shiftright("doc_id", CELL_BITS), F.col("doc_id").bitwiseAND((1 << CELL_BITS) - 1).cast("short")
    cells = trusted.groupBy(cell.alias("cell")).agg(F.collect_list(place).alias("places"))
    met = docs.select("doc_id", "text", cell.alias("cell"), place.alias("place")).join(F.broadcast(cells), "cell", "left")
    return met.select("doc_id", "text", F.coalesce(F.array_contains("places", F.col("place")), F.lit(False)).alias("learn"))


def classified(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): perplexity, threshold, score in 0..1, kept.

    ``trusted`` (doc_id) names the trusted texts. The model is fitted on all of them, and so are the thresholds: that of a
    language is ``slack`` times the ``quantile`` of its trusted texts' perplexities; a language without trusted texts, and a
    null one, takes that of all trusted texts. Documents above it are rejected. Without any trusted text there is no
    threshold and all stay. ``score`` falls from 1 with the perplexity and is 0.5 at the threshold. Rows that repeat a doc_id
    are scored one by one, with one language.
    """
    trusted = trusted.dropna().select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("trusted")).distinct()
    texts = marked(docs.withColumn("doc_id", F.col("doc_id").cast("long")), trusted)
    scored = written(perplexities(texts), "perplexities")
    facts = docs.groupBy("doc_id").agg(F.max("lang").alias("lang"))
    joined = scored.alias("s").join(facts.alias("f"), F.col("s.doc_id").eqNullSafe(F.col("f.doc_id"))).select("s.doc_id", "s.perplexity", "f.lang")
    joined = joined.join(trusted, "doc_id", "left")
    at = F.percentile_approx("perplexity", quantile, ACCURACY) * slack
    good = joined.filter("trusted")
    by_lang = good.filter("lang is not null").groupBy("lang").agg(at.alias("own"))
    overall = good.agg(at).first()[0]
    judged = joined.join(by_lang, "lang", "left").withColumn("threshold", F.coalesce("own", F.lit(overall).cast("double")))
    ratio = F.col("perplexity") / F.col("threshold")
    return judged.select("doc_id", "lang", "perplexity", "threshold", F.coalesce(1 / (1 + ratio * ratio), F.lit(1.0)).alias("score"), (F.coalesce(ratio, F.lit(0.0)) <= 1).alias("kept"))
