"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens of labelled documents are labelled by how unevenly their words and word beginnings fall on toxic and clean
documents. The field has two states; a token's features are its word, word beginnings and ending, and its neighbours.
Forward-backward marginals give spans; the sum of their squares, which long clean texts leave near 0, is calibrated to the
document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlattice.llm.common import below_cutoff, hash_cutoffs, small_batches, written
from revlattice.llm.wordhash import Hashed, mixed_bits, segments, words

TOXIC_SAMPLE, CLEAN_SAMPLE, SAMPLE_CHARS = 1500, 4000, 12_000
#: Chains (pieces of sentences) that the field is trained on: all that hold a toxic token, and clean ones up to this number.
FIT_CHAINS = 40_000
SLOTS = 1 << 18
CHAIN = 128
STEPS, RATE, PENALTY = 60, 0.15, 1e-4
THRESHOLD = 0.3
SCHEMA = "doc_id long, score double, predicted int, n_spans int, spans array<struct<start:int,end:int>>"

#: ASCII letters and every byte of a longer code point make words; these marks end a chain.
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?\n\r|")] = True
_FEATURES = 6


@dataclass(frozen=True)
class Tokens:
    """Tokens of one piece: byte ranges, text numbers, features, label keys, a hash of the neighbours, chain numbers and places in the chain."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    features: np.ndarray
    keys: np.ndarray
    around: np.ndarray
    chain: np.ndarray
    place: np.ndarray


def tokenised(data: bytes, numbers: np.ndarray, begins: np.ndarray) -> Tokens:
    raw = np.frombuffer(data, dtype=np.uint8)
    starts, ends = words(raw, _INSIDE)
    hashed = Hashed(raw)
    word = hashed.ranges(starts, ends)
    four = hashed.ranges(starts, np.minimum(ends, starts + 4)) ^ np.uint64(0x5BD1E995)
    five = hashed.ranges(starts, np.minimum(ends, starts + 5)) ^ np.uint64(0x27D4EB2F)
    tail = hashed.ranges(np.maximum(starts, ends - 3), ends) ^ np.uint64(0x165667B1)
    text_row = np.searchsorted(begins, starts, side="right") - 1
    stops = np.concatenate(([0], np.cumsum(_ENDS[raw])))
    group = stops[starts]
    first = np.concatenate(([True], (group[1:] != group[:-1]) | (text_row[1:] != text_row[:-1]))) if len(starts) else np.zeros(0, bool)
    where = np.arange(len(starts))
    begin = np.maximum.accumulate(np.where(first, where, 0)) if len(starts) else where
    first |= (where - begin) % CHAIN == 0
    chain = np.cumsum(first) - 1
    place = where - np.maximum.accumulate(np.where(first, where, 0)) if len(starts) else where
    before = np.where(first, np.uint64(1), np.roll(word, 1))
    after = np.where(np.roll(first, -1), np.uint64(2), np.roll(word, -1))
    columns = (word, four, five, tail, mixed_bits(before ^ np.uint64(0x85EBCA6B)), mixed_bits(after ^ np.uint64(0xC2B2AE35)))
    slots = np.stack([(c % np.uint64(SLOTS)).astype(np.int32) for c in columns]) if len(starts) else np.zeros((_FEATURES, 0), np.int32)
    keys = np.stack((word, four, five)) if len(starts) else np.zeros((3, 0), np.uint64)
    return Tokens(starts, ends, numbers[text_row], slots, keys, before ^ mixed_bits(after), chain, place)


def _log_ratio(r: np.ndarray, from1: float, from0: float, base1: float, base0: float) -> np.ndarray:
    """log((e^(r+from1) + e^from0) / (e^(r+base1) + e^base0))."""
    return np.logaddexp(r + from1, from0) - np.logaddexp(r + base1, base0)


def forward_backward(unary: np.ndarray, chain: np.ndarray, place: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the toxic state from the left (with the token) and from the right (without it).

    ``unary`` is the token's own log odds, ``links[i, j]`` the score of state j after state i. All chains advance together.
    """
    n = len(unary)
    left, right = unary.astype(np.float64), np.zeros(n)
    if not n:
        return left, right
    firsts = np.flatnonzero(place == 0)
    lengths = np.diff(np.append(firsts, n))
    order = np.argsort(-lengths, kind="stable")
    firsts, lengths = firsts[order], lengths[order]
    for step in range(1, int(lengths[0])):
        at = firsts[: np.searchsorted(-lengths, -step, side="left")] + step
        left[at] = unary[at] + _log_ratio(left[at - 1], links[1, 1], links[0, 1], links[1, 0], links[0, 0])
    for step in range(int(lengths[0]) - 2, -1, -1):
        at = firsts[: np.searchsorted(-lengths, -(step + 1), side="left")] + step
        ahead = unary[at + 1] + right[at + 1]
        right[at] = _log_ratio(ahead, links[1, 1], links[1, 0], links[0, 1], links[0, 0])
    return left, right


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass(frozen=True)
class Field:
    """The trained field: a weight per hashed feature, a bias, link scores, and the calibration of document scores."""

    weights: np.ndarray
    bias: float
    links: np.ndarray
    slope: float
    shift: float

    def unary(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(axis=0) + self.bias

    def marginals(self, tokens: Tokens) -> np.ndarray:
        left, right = forward_backward(self.unary(tokens.features), tokens.chain, tokens.place, self.links)
        return _sigmoid(left + right)

    def score(self, expected: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * np.log(expected + 1e-3) + self.shift)


def labelled_tokens(keys: np.ndarray, around: np.ndarray, text: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which tokens of toxic documents are toxic: their word or word beginning falls on toxic documents far more often.

    Different surroundings are counted rather than documents, as copies of a document are no new evidence.
    """
    marked = np.zeros(keys.shape[1], dtype=bool)
    many, few = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    for key in keys:
        values, place = np.unique(key, return_inverse=True)
        t, c = (np.bincount(place[which][np.unique(mixed_bits(key[which]) ^ around[which], return_index=True)[1]], minlength=len(values)) for which in (toxic[text], ~toxic[text]))
        uneven = (t >= max(3, 0.01 * many)) & ((t + 0.5) / many >= 12 * (c + 0.5) / few)
        marked |= uneven[place]
    return marked & toxic[text]


def folded(text: str) -> str:
    """Lower case of as many code points, so that offsets hold in the text itself: a character that grows stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def fit(texts: list[str], toxic: np.ndarray, share: float, fit_chains: int = FIT_CHAINS) -> Field:
    """Trains on a bounded sample; ``share`` is the share of toxic documents among all labelled ones.

    Every chain with a toxic token is used, and so many clean ones, by the hash of their number, that there are
    ``fit_chains`` in all. The calibration uses all texts whole.
    """
    data = [folded(t).encode("utf-8", "surrogatepass") for t in texts]
    pieces = [tokenised(*piece) for piece in segments(data)]
    shifts = np.cumsum([0, *(int(p.chain[-1]) + 1 if len(p.chain) else 0 for p in pieces)])
    text = np.concatenate([p.text for p in pieces])
    features = np.concatenate([p.features for p in pieces], axis=1)
    chain = np.concatenate([p.chain + s for p, s in zip(pieces, shifts, strict=False)])
    place = np.concatenate([p.place for p in pieces])
    label = labelled_tokens(np.concatenate([p.keys for p in pieces], axis=1), np.concatenate([p.around for p in pieces]), text, toxic)
    chosen = np.zeros(int(shifts[-1]) + 1, dtype=bool)
    chosen[chain[label]] = True
    others = np.flatnonzero(~chosen)
    others = others[np.argsort(mixed_bits(others.astype(np.uint64)), kind="stable")][: max(0, fit_chains - int(chosen.sum()))]
    chosen[others] = True
    use = chosen[chain]
    f, y, c, at = features[:, use], label[use].astype(np.float64), chain[use], place[use]
    weights, bias, links = np.zeros(SLOTS), -2.0, np.zeros((2, 2))
    memory = [np.zeros(SLOTS), 0.0, np.zeros((2, 2))]
    linked = np.flatnonzero(at[1:] > 0) if len(at) else np.zeros(0, int)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[linked].astype(int), y[linked + 1].astype(int)), 1)
    for _ in range(STEPS if label.any() else 0):
        unary = weights[f].sum(axis=0) + bias
        left, right = forward_backward(unary, c, at, links)
        error = _sigmoid(left + right) - y
        grad = np.bincount(f.ravel(), np.tile(error, _FEATURES), minlength=SLOTS) + PENALTY * len(y) * weights / 100
        logs = np.stack([i * left[linked] + links[i, j] + j * (unary[linked + 1] + right[linked + 1]) for i in (0, 1) for j in (0, 1)])
        pair = np.exp(logs - logs.max(axis=0, initial=-np.inf)) if len(linked) else np.zeros((4, 0))
        pair /= pair.sum(axis=0)
        grads = [grad, error.sum(), pair.sum(axis=1).reshape(2, 2) - seen]
        values = [weights, bias, links]
        for k, g in enumerate(grads):
            memory[k] = memory[k] + g * g
            values[k] = values[k] - RATE * g / (np.sqrt(memory[k]) + 1e-8) * (4 if k == 0 else 1)
        weights, bias, links = values
    field = Field(weights.astype(np.float32), float(bias), links, 1.0, 0.0)
    marginals = np.concatenate([field.marginals(p) for p in pieces])
    expected = np.bincount(text, marginals**2, minlength=len(texts))
    slope, shift = _calibrated(np.log(expected + 1e-3), toxic, share)
    return Field(field.weights, field.bias, links, slope, shift)


def _calibrated(x: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with classes weighed to their true shares."""
    many = toxic.sum()
    if not many or many == len(toxic):
        return 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    weight = np.where(toxic, share / many, (1 - share) / (len(toxic) - many))
    design = np.stack((x, np.ones_like(x)), axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ at)
        grad = design.T @ (weight * (p - toxic)) + 1e-3 * at * [1, 0]
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        at = at - np.clip(np.linalg.solve(curve, grad), -2, 2)
    return float(at[0]), float(at[1])


def train(docs: DataFrame, labels: DataFrame, toxic_sample: int = TOXIC_SAMPLE, clean_sample: int = CLEAN_SAMPLE, sample_chars: int = SAMPLE_CHARS, fit_chains: int = FIT_CHAINS) -> Field:
    """A field from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0/1).

    The fit is a bounded sample: of labelled documents of at most ``sample_chars`` characters the ``toxic_sample`` toxic and
    the ``clean_sample`` clean ones with the smallest id hash, and ``fit_chains`` chains of them, trained in one task. Ids are
    counted by label first, and only those below a hash that leaves about twice as many are ranked. Rows with a null id,
    text or label teach nothing; without toxic rows every score is close to 0.
    """
    known = docs.filter(F.col("text").isNotNull()).select("doc_id", (F.length("text") <= sample_chars).alias("short"))
    known = known.join(labels.filter(F.col("toxic").isNotNull()).select("doc_id", (F.col("toxic") == 1).alias("toxic")), "doc_id")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(True, 0) / max(1, sum(counts.values()))
    short = known.filter("short").select("doc_id", "toxic").distinct()
    wanted = {True: toxic_sample, False: clean_sample}
    sizes = {r["toxic"]: r["n"] for r in short.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    limit = F.when(F.col("toxic"), toxic_sample).otherwise(clean_sample)
    factor = 2
    while True:
        ranked = short.filter(below_cutoff("toxic", F.xxhash64("doc_id"), hash_cutoffs(sizes, wanted.get, factor)))
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
        chosen = written(ranked.select("doc_id", "toxic"), "sample")
        if chosen.count() >= sum(min(wanted[k], n) for k, n in sizes.items()):
            break
        factor *= 4
    # At most the two sample sizes of ids, so the texts need not move to meet them.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter(F.length("text") <= sample_chars)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])
        field = fit(rows["text"].tolist(), rows["toxic"].to_numpy(dtype=bool), share, fit_chains)
        return pd.DataFrame([(field.weights.tobytes(), field.bias, field.links.ravel().tolist(), field.slope, field.shift)], columns=["weights", "bias", "links", "slope", "shift"])

    row = sample.withColumn("fit", F.lit("all")).groupBy("fit").applyInPandas(run, "weights binary, bias double, links array<double>, slope double, shift double").first()
    if row is None:
        return Field(np.zeros(SLOTS, np.float32), -20.0, np.zeros((2, 2)), 1.0, -20.0)
    return Field(np.frombuffer(row["weights"], dtype=np.float32), row["bias"], np.array(row["links"]).reshape(2, 2), row["slope"], row["shift"])


def _scored(texts: list[str], field: Field) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores and spans of the texts."""
    lowered = [folded(t) for t in texts]
    expected = np.zeros(len(texts))
    spans: list[list[dict]] = [[] for _ in texts]
    passed = np.zeros(len(texts), dtype=np.int64)
    for data, numbers, begins in segments([t.encode("utf-8", "surrogatepass") for t in lowered]):
        tokens = tokenised(data, numbers, begins)
        marginals = field.marginals(tokens)
        expected += np.bincount(tokens.text, marginals**2, minlength=len(texts))
        points = np.concatenate(([0], np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)))
        hot = np.flatnonzero(marginals >= 0.5)
        rows = np.searchsorted(begins, tokens.starts[hot], side="right") - 1
        zero = passed[numbers[rows]] - points[begins[rows]]
        previous = -2
        for token, number, shift in zip(hot.tolist(), numbers[rows].tolist(), zero.tolist(), strict=True):
            start, end = (int(points[x]) + shift for x in (tokens.starts[token], tokens.ends[token]))
            if previous == token - 1 and tokens.place[token] > 0:
                spans[number][-1]["end"] = end
            else:
                spans[number].append({"start": start, "end": end})
            previous = token
        np.add.at(passed, numbers, points[np.append(begins[1:], len(data))] - points[begins] - 1)
    return field.score(expected), spans


def _shared(docs: DataFrame, field: Field) -> Broadcast:
    small_batches(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast((field.weights, field.bias, field.links, field.slope, field.shift))


def tag(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): score in 0..1, predicted (score >= threshold), toxic spans.

    Spans are neighbouring tokens of a chain with a marginal of 0.5 or more, as (start, end) in code points, end exclusive.
    Null and empty texts have no tokens: no spans, and the score of none. Rows that repeat a doc_id are scored one by one.
    """
    shared = _shared(docs, field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*shared.value)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            scores, spans = _scored([t or "" for t in batch.column(1).to_pylist()], field)
            arrays = [batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array([len(s) for s in spans], pa.int32())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(spans, kind)], names=["doc_id", "score", "predicted", "n_spans", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def without_toxic(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (any columns, among them text) that score below ``threshold``."""
    shared = _shared(docs, field)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*shared.value)
        for batch in batches:
            scores, _ = _scored([t or "" for t in batch.column(at).to_pylist()], field)
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
