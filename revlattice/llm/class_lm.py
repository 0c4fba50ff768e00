"""Brown class-based bigram scores.

Words are counted over the corpus. Exchange clustering of the most frequent words and, for all others, of groups of words
with the same ending gives every word a class to start from. Rounds then move each training word by its own neighbours: the
words' counts with the classes to their left and right are gathered in the parts of the key space, where words are exchanged
against the table of all class pairs. A text's score multiplies class transitions and word emissions.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.llm import chunks
from revlattice.llm.common import dropped, shuffles_dropped, written

FREQUENT, ENDINGS, CLASSES, SWEEPS = 1000, 256, 48, 8
#: Characters of a chunk: words go between chunks and parts in every round, and larger chunks repeat fewer of them.
CHUNK_CHARS = 16_000_000
#: Rounds over all words end when one gains less than this many nats a token, or at the number of rounds.
ROUNDS, GAIN = 8, 0.005
#: Most words exchanged against one state of the table, and the counts whose terms are looked up.
BLOCK, FEW = 2048, 8
#: The token that ends a text; no word holds a blank.
END = b" "
TALLIED = "chunk long, part int, digest long, data binary, sums array<long>"
#: What a part answers at first and after a round, and what a chunk tells it: the words' numbers, classes, counts beside
#: themselves, and the classes before and behind them with their counts.
FIRST = {"count": pa.int64(), "number": pa.int32(), "unit": pa.int16()}
PLACED = {"count": pa.int64(), "number": pa.int32(), "class": pa.int16()}
TOLD = {"number": pa.int32(), "class": pa.int16(), "own": pa.int32(), "before": pa.int64(), "before_n": pa.int32(), "after": pa.int64(), "after_n": pa.int32()}
COUNTED = "kind string, key binary, unit int, count long, types long"
SCORED = "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double"


def words(text: str) -> list[bytes]:
    """Words between ASCII white space with A-Z lowered, then the end."""
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


@dataclass(frozen=True)
class Vocabulary:
    """Training tokens and types, the frequent words with their numbers, and tokens and types of every unit."""

    tokens: int
    types: int
    frequent: dict[bytes, int]
    unit_tokens: np.ndarray
    unit_types: np.ndarray


def vocabulary(pieces: DataFrame, frequent: int = FREQUENT) -> Vocabulary:
    """Counts of all words stay in their parts; the driver gets the ``frequent`` words and a sum per ending."""

    def summary(part: int, tables: list[pa.Table]) -> pa.Table:
        keys, counts, _ = chunks.totals(tables)
        known = np.flatnonzero(counts)
        top = known[np.argsort(-counts[known], kind="stable")][: frequent + 1]
        # Equal counts at the border are settled among all parts, by the word.
        border = counts[top[-1]] if len(top) else 0
        top = known[counts[known] >= max(1, border)]
        words = keys.take(pa.array(known)).to_pylist()
        groups = np.array([ending(w) for w in words], dtype=np.int64)
        sums, types = np.bincount(groups, counts[known], ENDINGS).astype(np.int64), np.bincount(groups, minlength=ENDINGS)
        return pa.table(
            {
                "kind": ["word"] * len(top) + ["ending"] * ENDINGS,
                "key": pa.array([*keys.take(pa.array(top)).to_pylist(), *[None] * ENDINGS], pa.binary()),
                "unit": pa.array([*[None] * len(top), *range(ENDINGS)], pa.int32()),
                "count": pa.array([*counts[top].tolist(), *sums.tolist()], pa.int64()),
                "types": pa.array([*[1] * len(top), *types.tolist()], pa.int64()),
            }
        )

    counted = written(chunks.summarised(pieces, summary, COUNTED), "counts")
    top = counted.filter("kind = 'word'").orderBy(F.desc("count"), "key").limit(frequent).collect()
    groups = counted.filter("kind = 'ending'").groupBy("unit").agg(F.sum("count").alias("count"), F.sum("types").alias("types")).collect()
    tokens, types = np.zeros(frequent + ENDINGS, dtype=np.int64), np.zeros(frequent + ENDINGS, dtype=np.int64)
    for row in groups:
        tokens[frequent + row["unit"]], types[frequent + row["unit"]] = row["count"], row["types"]
    every, kinds = int(tokens.sum()), int(types.sum())
    numbers = {bytes(r["key"]): i for i, r in enumerate(top)}
    for i, row in enumerate(top):
        tokens[i], types[i] = row["count"], 1
        tokens[frequent + ending(bytes(row["key"]))] -= row["count"]
        types[frequent + ending(bytes(row["key"]))] -= 1
    return Vocabulary(every, kinds, numbers, tokens, types)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the units whose neighbour counts are ``pairs``: each unit in turn moves where the likelihood gains most."""
    units = len(pairs)
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-weight, kind="stable")
    assigned = np.empty(units, dtype=np.int64)
    assigned[order] = np.arange(units) % classes
    member = np.zeros((units, classes))
    member[np.arange(units), assigned] = 1
    table = member.T @ pairs @ member
    for _ in range(sweeps):
        moved = 0
        for unit in order[weight[order] > 0]:
            old, own = assigned[unit], pairs[unit, unit]
            out = np.bincount(assigned, pairs[unit], classes)
            into = np.bincount(assigned, pairs[:, unit], classes)
            out[old] -= own
            into[old] -= own
            table[old] -= out
            table[:, old] -= into
            table[old, old] -= own
            rows, columns = table + out, table + into[:, None]
            gain = (_xlogx(rows) - _xlogx(table)).sum(axis=1) + (_xlogx(columns) - _xlogx(table)).sum(axis=0)
            corner = np.diag(table)
            gain += _xlogx(corner + out + into + own) - _xlogx(corner + out) - _xlogx(corner + into) + _xlogx(corner)
            left, right = table.sum(axis=1), table.sum(axis=0)
            # The unit's tokens join the class as predecessors and as successors, whichever class it is.
            gain -= _xlogx(left + out.sum() + own) - _xlogx(left) + _xlogx(right + into.sum() + own) - _xlogx(right)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            moved += new != old
            assigned[unit] = new
            table[new] += out
            table[:, new] += into
            table[new, new] += own
        if not moved:
            break
    return assigned


def clusters(pairs: DataFrame, units: int, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the units and transition counts of classes. ``pairs`` (a, b, n) has at most units x units rows."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        matrix = np.zeros((units, units))
        matrix[rows["a"], rows["b"]] = rows["n"]
        assigned = exchange(matrix, classes)
        member = np.eye(classes)[assigned]
        return pd.DataFrame([(assigned.tolist(), (member.T @ matrix @ member).ravel().tolist())], columns=["assigned", "table"])

    row = pairs.withColumn("fit", F.lit("all")).groupBy("fit").applyInPandas(run, "assigned array<long>, table array<double>").first()
    if row is None:
        return np.arange(units) % classes, np.zeros((classes, classes))
    return np.array(row["assigned"]), np.array(row["table"]).reshape(classes, classes)


def likelihood(table: np.ndarray) -> float:
    """The part of the log likelihood of class bigrams that depends on the classes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum() - _xlogx(table.sum(axis=1)).sum())


def _joined(table: np.ndarray, word: np.ndarray, near: np.ndarray, n: np.ndarray, old: np.ndarray, other: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Gains (words x classes) of the rows of ``table`` when a word, taken out of class ``old``, joins each class.

    A word adds ``n`` to column ``near`` of the row; ``other`` are its counts in the columns. Transposed, the same for columns.
    """
    gains = np.zeros(other.shape)
    if not len(word):
        return gains
    looked = np.stack([(_xlogx(table + k) - _xlogx(table)).T for k in range(FEW + 1)])
    home = old[word]
    terms = looked[np.minimum(n, FEW).astype(np.int64), near]
    self_column = near == home
    exact = np.flatnonzero((n > FEW) | self_column)
    base = table.T[near[exact]] - np.where(self_column[exact, None], other[word[exact]], 0)
    base = np.maximum(base, 0)
    terms[exact] = _xlogx(base + n[exact, None]) - _xlogx(base)
    left = np.maximum(table[home, near] - n - np.where(self_column, other[word, home] + own[word], 0), 0)
    terms[np.arange(len(word)), home] = _xlogx(left + n) - _xlogx(left)
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    gains[word[starts]] = np.add.reduceat(terms, starts, axis=0)
    return gains


def exchanged(old: np.ndarray, before: tuple[np.ndarray, np.ndarray, np.ndarray], after: tuple[np.ndarray, np.ndarray, np.ndarray], own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The classes of words after each moved once from class ``old`` to where the likelihood gains most.

    ``before`` and ``after`` are (word, class, n) by word: how often a word follows, and precedes, a class. ``own`` is how
    often it follows itself, which both include. Words go by their count; the table follows the moves block by block.
    """
    words, classes = len(old), len(table)
    table, assigned = table.astype(np.float64), old.copy()
    order = np.argsort(-np.bincount(before[0], before[2], words), kind="stable")
    rank = np.empty(words, dtype=np.int64)
    rank[order] = np.arange(words)
    sides = []
    for word, near, n in (before, after):
        by = np.argsort(rank[word], kind="stable")
        sides.append((rank[word][by], near[by], n[by].astype(np.float64)))
    start = 0
    while start < words:
        end = min(words, start + max(1, min(BLOCK, start // 8)))
        some = order[start:end]
        home, selves, each = assigned[some], own[some].astype(np.float64), np.arange(end - start)
        sparse, dense = [], []
        for word, near, n in sides:
            a, b = np.searchsorted(word, (start, end))
            w, c, k = word[a:b] - start, near[a:b], n[a:b] - np.where(near[a:b] == home[word[a:b] - start], selves[word[a:b] - start], 0)
            some_left = k > 0
            sparse.append((w[some_left], c[some_left], k[some_left]))
            dense.append(np.zeros((end - start, classes)))
            dense[-1][w, c] = k
        into, out = dense
        gain = _joined(table, *sparse[1], home, into, selves) + _joined(table.T, *sparse[0], home, out, selves)
        corner = np.tile(np.diag(table), (end - start, 1))
        corner[each, home] -= out[each, home] + into[each, home] + selves
        corner = np.maximum(corner, 0)
        gain += _xlogx(corner + out + into + selves[:, None]) - _xlogx(corner + out) - _xlogx(corner + into) + _xlogx(corner)
        for sums, more in ((table.sum(axis=1), out.sum(axis=1) + selves), (table.sum(axis=0), into.sum(axis=1) + selves)):
            without = np.tile(sums, (end - start, 1))
            without[each, home] -= more
            without = np.maximum(without, 0)
            gain -= _xlogx(without + more[:, None]) - _xlogx(without)
        new = gain.argmax(axis=1)
        new = np.where(gain[each, new] > gain[each, home] + 1e-9, new, home)
        went = np.flatnonzero(new != home)
        for at, sign in ((home[went], -1), (new[went], 1)):
            np.add.at(table, at, sign * out[went])
            np.add.at(table.T, at, sign * into[went])
            np.add.at(table, (at, at), sign * selves[went])
        assigned[some] = new
        start = end
    return assigned


def _tally(texts: pa.Table, answers: pa.Table, kinds: dict, assigned: np.ndarray, classes: int, send: bool) -> pa.Table:
    """A chunk's class pairs (part -1) and, for every part, its words' numbers, classes and counts with neighbouring classes."""
    chunk = texts.column("chunk")[0].as_py()
    digest = texts.column("digest")[0].as_py()
    docs, parts, tables = chunks.met(texts, answers, kinds)
    together = pa.concat_tables(tables).combine_chunks()
    of, numbers = _classes(together, assigned), together.column("number").to_numpy()
    learned = [k for k, learns in zip(chunks.each_document(docs), docs.column("learn").to_pylist(), strict=True) if learns]
    word = np.concatenate(learned).astype(np.int64) if learned else np.zeros(0, np.int64)
    # Every text closes with the end, which therefore precedes the next one.
    last = np.roll(word, 1)
    pairs = np.bincount(of[last] * classes + of[word], minlength=classes**2).astype(np.int64)
    rows = [(chunk, chunks.DOCS, digest, None, pairs.tolist())]
    if send:
        sides = [np.unique(own * classes + of[near], return_counts=True) for own, near in ((word, last), (last, word))]
        selves = np.bincount(word[word == last], minlength=len(of))
        ends = np.cumsum([len(t) for t in tables])
        for part, start, end in zip(parts, [0, *ends[:-1]], ends, strict=True):
            columns = {"number": numbers[start:end], "class": of[start:end].astype(np.int16), "own": selves[start:end].astype(np.int32)}
            for name, (codes, n) in zip(("before", "after"), sides, strict=True):
                a, b = np.searchsorted(codes, (start * classes, end * classes))
                # Steps between sorted numbers pack better than the numbers.
                columns[name], columns[f"{name}_n"] = np.diff(codes[a:b] - start * classes, prepend=0), n[a:b].astype(np.int32)
            rows.append((chunk, part, digest, chunks.sealed(columns), None))
    types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names=["chunk", "part", "digest", "data", "sums"])


def _classes(found: pa.Table, assigned: np.ndarray) -> np.ndarray:
    """The classes of a chunk's keys: those of their units until a round has placed the words."""
    return found.column("class").to_numpy().astype(np.int64) if "class" in found.column_names else assigned[found.column("unit").to_numpy()]


def _settled(rows: pa.Table, table: np.ndarray) -> pa.Table:
    """A part's words exchanged against ``table``: count, number and class for every chunk, and ``sums``: words by class."""
    classes = len(table)
    told = [chunks.opened(d, TOLD) for d in rows.column("data").to_pylist()]
    flat = lambda t, name: t[name].to_numpy()
    numbers = [flat(t, "number") for t in told]
    words = max(int(x.max()) for x in numbers) + 1
    old, own = np.zeros(words, dtype=np.int64), np.zeros(words, dtype=np.int64)
    for t, number in zip(told, numbers, strict=True):
        old[number] = flat(t, "class")
        own[number] += flat(t, "own")
    sides = []
    for name in ("before", "after"):
        codes = [np.cumsum(flat(t, name)) for t in told]
        codes = np.concatenate([number[c // classes].astype(np.int64) * classes + c % classes for c, number in zip(codes, numbers, strict=True)])
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], np.concatenate([flat(t, f"{name}_n") for t in told])[order]
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        sides.append((codes[starts] // classes, codes[starts] % classes, np.add.reduceat(n, starts, dtype=np.int64) if len(starts) else n))
    counts = np.bincount(sides[0][0], sides[0][2], words).astype(np.int64)
    new = exchanged(old, *sides, own, table)
    # Words that training lacks stay with their ending.
    new = np.where(counts > 0, new, old)
    sums = np.bincount(new[counts > 0], minlength=classes).tolist()
    data = [chunks.sealed({"count": counts[x], "number": x, "class": new[x].astype(np.int16)}) for x in numbers]
    columns = [*(chunks.flat(rows.column(c)) for c in ("chunk", "part", "digest")), pa.array(data, pa.binary())]
    return pa.table([*columns, pa.array([sums] + [None] * (len(data) - 1), pa.list_(pa.int64()))], names=["chunk", "part", "digest", "data", "sums"])


def _tallying(kinds: dict, assigned: np.ndarray, classes: int, send: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        return _tally(texts, answers, kinds, assigned, classes, send)

    return run


def _settling(table: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        return _settled(rows, table)

    return run


def _summed(rows: DataFrame, length: int) -> np.ndarray:
    """The sum of all ``sums``, added up before it reaches the driver."""
    total = np.zeros(length)
    for row in rows.filter("sums is not null").select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect():
        total[row["at"]] = row["n"]
    return total


def placed(texts: DataFrame, answers: DataFrame, assigned: np.ndarray, types: np.ndarray, classes: int, tokens: int, rounds: int) -> tuple[DataFrame, dict, np.ndarray, np.ndarray]:
    """Rounds over all words: the answers with the likeliest classes, their kinds, the table of class pairs and the words by class."""
    best, last, kinds = None, -np.inf, FIRST
    for number in range(rounds + 1):
        send = number < rounds and tokens > 0

        told = texts.groupBy("chunk").cogroup(answers.select("chunk", "part", "digest", "data").groupBy("chunk"))
        told = written(told.applyInArrow(_tallying(kinds, assigned, classes, send), TALLIED), "tallied")
        table = _summed(told, classes**2).reshape(classes, classes)
        found = likelihood(table)
        if best is None or found > best[0]:
            best = (found, answers, kinds, table, types)
        if not send or found - last < GAIN * tokens:
            break
        last = found
        answers = written(told.filter(F.col("part") != chunks.DOCS).groupBy("part").applyInArrow(_settling(table), TALLIED), "placed")
        types, kinds = _summed(answers, classes), PLACED
        dropped(told)
    return best[1].select("chunk", "part", "digest", "data"), *best[2:]


def score(
    docs: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES, parts: int | None = None, chunk_chars: int = CHUNK_CHARS, rounds: int = ROUNDS
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, learn): counts, the unigram base and the class model's score.

    Tokens are the words and one end per text; rows with ``learn`` are counted (null: not). ``base_score`` sums
    log10((c + 1) / (N + V + 1)); ``score`` sums log10 of class transition x word emission. Every training word has the class
    its own neighbours give it in at most ``rounds`` rounds. A word that training lacks belongs to the class of its ending,
    whose emissions keep one count for such words. Null and empty texts are one end.
    Without training rows every count is 0. Rows that repeat a doc_id count one by one.
    """
    parts = parts or chunks.part_count(docs)
    with shuffles_dropped(docs.sparkSession):
        pieces = written(chunks.chunked(docs.select("doc_id", "text", "learn"), chunks.by_token(words), parts, chunk_chars, exchanged=False), "pieces")
        known = vocabulary(pieces, frequent)
    units = frequent + ENDINGS
    shared = docs.sparkSession.sparkContext.broadcast(known.frequent)

    def answer(part: int, tables: list[pa.Table]) -> list[dict]:
        keys, counts, numbers = chunks.totals(tables)
        unit = np.array([shared.value.get(k, -1) for k in keys.to_pylist()], dtype=np.int32)
        rare = np.flatnonzero(unit < 0)
        unit[rare] = [frequent + ending(k) for k in keys.take(pa.array(rare)).to_pylist()]
        return [{"count": counts[n], "number": n.astype(np.int32), "unit": unit[n].astype(np.int16)} for n in numbers]

    with shuffles_dropped(docs.sparkSession):
        answers = written(chunks.answered(pieces, answer), "answers")
    texts = pieces.filter(F.col("part") == chunks.DOCS)

    def neighbours(documents: pa.Table, found: pa.Table) -> pa.Table:
        unit, end = found.column("unit").to_numpy().astype(np.int64), np.int64(known.frequent.get(END, 0))
        codes = [np.zeros(0, np.int64)]
        for sequence, learns in zip(chunks.each_document(documents), documents.column("learn").to_pylist(), strict=True):
            if learns:
                own = unit[sequence]
                codes.append(np.concatenate(([end], own[:-1])) * units + own)
        values, n = np.unique(np.concatenate(codes), return_counts=True)
        return pa.table({"a": (values // units).astype(np.int32), "b": (values % units).astype(np.int32), "n": n.astype(np.int64)})

    with shuffles_dropped(docs.sparkSession):
        pairs = chunks.reassembled(texts, answers, neighbours, "a int, b int, n long", FIRST).groupBy("a", "b").agg(F.sum("n").alias("n"))
        assigned, _ = clusters(pairs, units, classes)
        types = np.bincount(assigned, known.unit_types, classes)
        answers, kinds, table, types = placed(texts, answers, assigned, types, classes, known.tokens, rounds)
    usual = (table.sum(axis=0) + 1) / (table.sum() + classes)
    moves = np.log10((table + classes * usual) / (table.sum(axis=1, keepdims=True) + classes))
    # Every token is the second of one pair.
    room = table.sum(axis=0) + types + 1
    model = docs.sparkSession.sparkContext.broadcast((assigned, moves, np.log10(room)))

    def finish(documents: pa.Table, found: pa.Table) -> pa.Table:
        assigned, moves, rooms = model.value
        count = found.column("count").to_numpy()
        of = _classes(found, assigned)
        base, emits = np.log10((count + 1) / (known.tokens + known.types + 1)), np.log10(count + 1) - rooms[of]
        rows = []
        for sequence in chunks.each_document(documents):
            path = of[sequence]
            before = np.roll(path, 1)
            rows.append((len(sequence), int((count[sequence] > 0).sum()), float(base[sequence].sum()), float(moves[before, path].sum() + emits[sequence].sum())))
        n, seen, bases, scores = zip(*rows, strict=True)
        names = ["doc_id", "learn", "n_tokens", "n_known", "base_score", "score"]
        columns = [chunks.flat(documents.column("doc_id")), chunks.flat(documents.column("learn")), pa.array(n), pa.array(seen), pa.array(bases), pa.array(scores)]
        return pa.table(columns, names=names)

    scored = chunks.reassembled(texts, answers, finish, SCORED, kinds)
    return scored.withColumn("train_tokens", F.lit(known.tokens).cast("long"))
