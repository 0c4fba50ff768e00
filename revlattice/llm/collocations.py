"""Collocations by dynamic itemset counting.

The corpus is cut into shards that are scanned in a cycle. A scan counts lengths side by side: words from the start, a pair from
the scan after both its words reached the least count, a triple from the scan after both its pairs did, each until it has seen
every shard once. Shards hold chunks of documents as numbered words.  A chunk sends its different words, and then its different
pairs of known words, to the parts that count them, as one row for each part; the part answers which ones it knows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.llm import chunks
from revlattice.llm.common import dropped, groups_for, shuffles_dropped, small_batches, written

SHARDS, LEAST = 2, 10
#: Bytes of text in a chunk, and for each part of the words and of the pairs.
CHUNK_BYTES, PART_BYTES = 4_000_000, 8_000_000
#: A shorter candidate inside a longer one with this many hundredths of its count goes.
COVERED = 50
SCALE = 1_000_000
#: Candidates of a language are ranked in so many groups first.
GROUPS = 256
#: An identifier is a part's number and one of so many bits in it.
ID_BITS = 32
#: The part number of a chunk's text, and the chunk number of a part's totals.
TEXT, TOTALS = -1, -1
CELLS = "shard int, chunk long, part int, data binary"
#: ``latest`` is the last scan from which a phrase of the totals is known.
TOLD = "part int, chunk long, data binary, latest int"
PAIRS = "chunk long, part int, data binary"
TRIPLES = "a long, b long, n long"
_LONG, _INT = pa.int64(), pa.int32()
#: The columns of the cells: what a chunk sends of its words and pairs, what a part keeps of them, and what it answers.
SENT_WORDS = {"number": _INT, "key": pa.large_binary(), "n": _LONG}
KEPT_WORDS = {"key": pa.large_binary(), "n": _LONG, "id": _LONG, "since": _INT}
SENT_PAIRS = {"number": _LONG, "a": _LONG, "b": _LONG, "n": _LONG, "start": _INT}
KEPT_PAIRS = {"a": _LONG, "b": _LONG, "n": _LONG, "id": _LONG, "since": _INT}
KNOWN_WORDS = {"number": _INT, "id": _LONG, "since": _INT}
KNOWN_PAIRS = {"number": _LONG, "id": _LONG, "since": _INT}
#: Marks that end a piece, and the mark that stands for all of them; no word holds one.
MARKS, END = b".,;:!?\n\x0b\x0c\r", b"."
_UPPER = bytes(range(65, 91))
_FOLD = bytes.maketrans(MARKS + _UPPER, END * len(MARKS) + _UPPER.lower())


class _Numbers(dict):
    """Numbers for the words of one language, drawn from those of the chunk; the mark between pieces has -1."""

    def __init__(self, keys: list[bytes], lang: str):
        super().__init__({END: -1})
        # No word holds a line break, so the last one in a key is where its word begins.
        self.keys, self.lang = keys, lang.encode("utf-8", "surrogatepass") + b"\n"

    def __missing__(self, word):
        number = self[word] = len(self.keys)
        self.keys.append(self.lang + word)
        return number


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case, and a mark between pieces."""
    # Only blanks and tabs are left of what bytes.split takes for white space.
    return text.translate(_FOLD).replace(END, b" . ").split()


def _cells(rows: pa.Table, kinds: dict[str, pa.DataType]) -> tuple[dict[str, pa.Array], np.ndarray]:
    """The columns of all cells of ``rows``, one cell after another, and how long each is."""
    found = [chunks.opened(d, kinds) for d in rows.column("data").to_pylist()] if len(rows) else []
    whole = {n: pa.concat_arrays([f[n] for f in found]) if found else pa.array([], k) for n, k in kinds.items()}
    return whole, np.array([len(f[next(iter(kinds))]) for f in found], dtype=np.int64)


def _numpy(columns: dict[str, pa.Array], *names: str) -> list[np.ndarray]:
    return [columns[n].to_numpy() for n in names]


def numbered(docs: DataFrame, shards: int, parts: int, chunk_bytes: int) -> DataFrame:
    """``docs`` (text, lang) in chunks: the different words with their counts by part, and the text as a sequence of numbers.

    All chunks of a task are in one shard.  A chunk has a row per part that it has words of, so rows are never more than
    different words per chunk.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        shard, chunk = task % shards, task << 32
        words, known, found, size = [], {}, [], 0

        def rows() -> pa.RecordBatch:
            sequence = np.concatenate(found)
            counts, keys = np.bincount(sequence[sequence >= 0], minlength=len(words)), pa.array(words, pa.large_binary())
            where = chunks.parts_of(keys, parts)
            order = np.argsort(where, kind="stable").astype(np.int32)
            keys, counts, present = keys.take(pa.array(order)), counts[order], np.unique(where)
            borders = np.append(np.searchsorted(where[order], present), len(order))
            cells = [chunks.sealed({"number": order[a:b], "key": keys[a:b], "n": counts[a:b]}) for a, b in zip(borders[:-1], borders[1:], strict=True)]
            columns = [[shard] * (len(cells) + 1), [chunk] * (len(cells) + 1), [TEXT, *present.tolist()], [chunks.sealed({"number": sequence}), *cells]]
            kinds = (_INT, _LONG, _INT, pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "chunk", "part", "data"])

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                some = tokens(text)
                some.append(END)
                if lang not in known:
                    known[lang] = _Numbers(words, lang)
                found.append(np.fromiter(map(known[lang].__getitem__, some), dtype=np.int32, count=len(some)))
                size += len(text) + 20
                if size >= chunk_bytes:
                    yield rows()
                    chunk, words, known, found, size = chunk + 1, [], {}, [], 0
        if found:
            yield rows()

    return docs.mapInArrow(cut, CELLS)


def _labelled(old: np.ndarray, ids: np.ndarray, since: np.ndarray, counts: np.ndarray, part: int, step: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, ids and scans of a part's phrases with the scan's counts; the first ``len(old)`` are those known before."""
    counts[: len(old)] += old
    more = len(counts) - len(old)
    ids, since = np.concatenate((ids, np.full(more, -1, dtype=np.int64))), np.concatenate((since, np.zeros(more, dtype=np.int32)))
    new = np.flatnonzero((counts >= least) & (ids < 0))
    ids[new] = (part << ID_BITS) + (ids >= 0).sum() + np.arange(len(new))
    since[new] = step + 1
    return counts, ids, since


def _answers(rows: pa.Table, sizes: np.ndarray, number: np.ndarray, place: np.ndarray, ids: np.ndarray, since: np.ndarray) -> list[tuple]:
    """For every chunk of ``rows`` that sent a phrase which the part knows: those phrases, their ids and scans."""
    out, ends = [], np.cumsum(sizes)
    for chunk, begin, end in zip(rows.column("chunk").to_pylist(), (ends - sizes).tolist(), ends.tolist(), strict=True):
        own = place[begin:end]
        held = np.flatnonzero(own < len(ids))
        held = held[ids[own[held]] >= 0]
        if len(held):
            out.append((chunk, chunks.sealed({"number": number[begin:end][held], "id": ids[own[held]], "since": since[own[held]]}), None))
    return out


def _told(part: int, rows: list[tuple]) -> pa.Table:
    chunk, data, latest = zip(*rows, strict=True) if rows else ((), (), ())
    columns = [pa.array([part] * len(rows), _INT), pa.array(chunk, _LONG), pa.array(data, pa.binary()), pa.array(latest, _INT)]
    return pa.table(columns, names=["part", "chunk", "data", "latest"])


def _words(step: int, least: int, counting: bool):
    def run(rows: pa.Table, totals: pa.Table) -> pa.Table:
        """A part's totals after the scan, and for every chunk those of its words that were known before it."""
        if not len(rows) and not len(totals):
            return _told(0, [])
        part = (rows if len(rows) else totals).column("part")[0].as_py()
        sent, sizes = _cells(rows, SENT_WORDS)
        kept, _ = _cells(totals, KEPT_WORDS)
        keys = pa.concat_arrays([kept["key"], sent["key"]]).dictionary_encode()
        place = keys.indices.to_numpy()[len(kept["key"]) :]
        old, ids, since = _numpy(kept, "n", "id", "since")
        number, n = _numpy(sent, "number", "n")
        out = _answers(rows, sizes, number, place, ids, since)
        if counting:
            counts = np.bincount(place, n, len(keys.dictionary)).astype(np.int64)
            counts, ids, since = _labelled(old, ids, since, counts, part, step, least)
            out.append((TOTALS, chunks.sealed({"key": keys.dictionary, "n": counts, "id": ids, "since": since}), int(since.max(initial=0))))
        return _told(part, out)

    return run


def _sequence(rows: pa.Table) -> np.ndarray:
    return chunks.opened(rows.column("data")[0].as_py(), {"number": _INT})["number"].to_numpy()


def _codes(sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code for the two words at every place, and whether they are two words of one piece."""
    a, b = sequence[:-1].astype(np.int64), sequence[1:]
    return (a << 32) | b, (a >= 0) & (b >= 0)


def _pairs(parts: int):
    def run(rows: pa.Table, words: pa.Table) -> pa.Table:
        """A chunk's different pairs of known words by part, with their counts and the scan from which they are counted."""
        schema = pa.schema([("chunk", _LONG), ("part", _INT), ("data", pa.binary())])
        if not len(rows) or not len(words):
            return schema.empty_table()
        sequence = _sequence(rows)
        number, found, scan = _numpy(_cells(words, KNOWN_WORDS)[0], "number", "id", "since")
        ids = np.full(max(int(sequence.max(initial=0)), int(number.max())) + 1, -1, dtype=np.int64)
        since = np.zeros(len(ids), dtype=np.int32)
        ids[number], since[number] = found, scan
        codes, inside = _codes(np.where((sequence >= 0) & (ids[sequence] >= 0), sequence, -1))
        codes, n = np.unique(codes[inside], return_counts=True)
        a, b = codes >> 32, codes & 0xFFFFFFFF
        mixed = (ids[a].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (ids[b].view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        where = ((mixed >> np.uint64(29)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(where, kind="stable")
        present = np.unique(where)
        borders = np.append(np.searchsorted(where[order], present), len(order))
        a, b = a[order], b[order]
        whole = {"number": codes[order], "a": ids[a], "b": ids[b], "n": n[order], "start": np.maximum(since[a], since[b])}
        cells = [chunks.sealed({k: v[x:y] for k, v in whole.items()}) for x, y in zip(borders[:-1], borders[1:], strict=True)]
        chunk = np.full(len(present), rows.column("chunk")[0].as_py(), dtype=np.int64)
        return pa.table([chunk, present, pa.array(cells, pa.binary())], schema=schema)

    return run


def _numbered_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of pairs in the order in which they are first met, and those first places."""
    x, y = np.unique(a, return_inverse=True)[1], np.unique(b, return_inverse=True)
    _, first, number = np.unique(x * len(y[0]) + y[1], return_index=True, return_inverse=True)
    order = np.argsort(first, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return place[number], first[order]


def _pair_totals(step: int, shards: int, least: int):
    def run(rows: pa.Table, totals: pa.Table) -> pa.Table:
        """The same as ``_words`` for pairs; only those that are due in this scan are counted."""
        if not len(rows) and not len(totals):
            return _told(0, [])
        part = (rows if len(rows) else totals).column("part")[0].as_py()
        sent, sizes = _cells(rows, SENT_PAIRS)
        kept, _ = _cells(totals, KEPT_PAIRS)
        a, b = (np.concatenate((kept[c].to_numpy(), sent[c].to_numpy())) for c in "ab")
        old, ids, since = _numpy(kept, "n", "id", "since")
        code, n, start = _numpy(sent, "number", "n", "start")
        number, first = _numbered_pairs(a, b)
        place = number[len(old) :]
        out = _answers(rows, sizes, code, place, ids, since)
        if step < 2 * shards:
            due = (start <= step) & (step < start + shards)
            counts = np.bincount(place[due], n[due], len(first)).astype(np.int64)
            counts, ids, since = _labelled(old, ids, since, counts, part, step, least)
            out.append((TOTALS, chunks.sealed({"a": a[first], "b": b[first], "n": counts, "id": ids, "since": since}), int(since.max(initial=0))))
        return _told(part, out)

    return run


def _triples(step: int, shards: int):
    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        """A chunk's different pairs of overlapping pairs that are due in this scan."""
        schema = pa.schema([("a", _LONG), ("b", _LONG), ("n", _LONG)])
        if not len(rows) or not len(known):
            return schema.empty_table()
        code, ids, since = _numpy(_cells(known, KNOWN_PAIRS)[0], "number", "id", "since")
        order = np.argsort(code)
        code, ids, since = code[order], ids[order], since[order]
        codes, inside = _codes(_sequence(rows))
        at = np.minimum(np.searchsorted(code, codes), len(code) - 1)
        hit = inside & (code[at] == codes)
        both = np.flatnonzero(hit[:-1] & hit[1:])
        p, q = at[both], at[both + 1]
        start = np.maximum(since[p], since[q])
        due = (start <= step) & (step < start + shards)
        found, n = np.unique(p[due] * len(code) + q[due], return_counts=True)
        return pa.table([ids[found // len(code)], ids[found % len(code)], n], schema=schema)

    return run


def _latest(told: DataFrame) -> int:
    return told.agg(F.max("latest")).first()[0] or 0


def _totals(told: DataFrame | None, spark) -> DataFrame:
    return spark.createDataFrame([], TOLD) if told is None else told.filter(F.col("chunk") == TOTALS)


def _rows(told: DataFrame, kinds: dict[str, pa.DataType], names: list[str], ddl: str) -> DataFrame:
    """The phrases of all parts' totals, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                held = chunks.opened(data, kinds)
                yield pa.RecordBatch.from_arrays([held[n].cast(pa.binary()) if n == "key" else held[n] for n in names], names=names)

    return told.filter(F.col("chunk") == TOTALS).select("data").mapInArrow(run, ddl)


def counted(
    docs: DataFrame, least: int = LEAST, shards: int = SHARDS, chunk_bytes: int = CHUNK_BYTES, parts: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Totals of words (lang, word, n, id), pairs (a, b: words) and triples (a, b: pairs) of ``docs`` (text, lang).

    Words and pairs that reached ``least`` have an id and their count in all shards; the counts of all words are whole.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    parts = parts or groups_for(texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0], PART_BYTES, 4)
    with shuffles_dropped(spark):
        cells = written(numbered(texts, shards, parts, chunk_bytes), "tokens")
        words = pairs = triples = None
        asked: dict[int, DataFrame] = {}
        step, ends = 0, shards
        while step < ends:
            shard = step % shards
            scanned = cells.filter(F.col("shard") == shard)
            # Two sides of one origin need columns of their own.
            text = scanned.filter(F.col("part") == TEXT).select(F.col("chunk").alias("chunk"), "data")
            if shard not in asked:
                vocabulary = scanned.filter(F.col("part") != TEXT).drop("shard").groupBy("part")
                told = vocabulary.cogroup(_totals(words, spark).groupBy("part")).applyInArrow(_words(step, least, step < shards), TOLD)
                told = written(told, "words")
                known = told.filter(F.col("chunk") != TOTALS)
                asks = written(text.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_pairs(parts), PAIRS), "pairs")
                if step < shards:
                    words = _replaced(words, told)
                else:
                    # Once every shard has been scanned, the words known do not change any more.
                    dropped(told)
                    asked[shard] = asks
            else:
                asks = asked[shard]
            met = asks.groupBy("part").cogroup(_totals(pairs, spark).groupBy("part")).applyInArrow(_pair_totals(step, shards, least), TOLD)
            met = written(met, "met")
            answers = met.filter(F.col("chunk") != TOTALS)
            due = text.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_triples(step, shards), TRIPLES)
            rows = due if triples is None else triples.unionByName(due)
            triples = _replaced(triples, written(rows.groupBy("a", "b").agg(F.sum("n").alias("n")), "triples"))
            if step < 2 * shards:
                pairs = _replaced(pairs, met)
            else:
                dropped(met)
            if step < shards:
                dropped(asks)
            step += 1
            ends = shards + max(_latest(words), _latest(pairs))
        for table in (cells, *asked.values()):
            dropped(table)
    key = F.col("key").cast("string")
    word = F.substring_index(key, "\n", -1)
    lang = F.substring(key, F.lit(1), F.length(key) - F.length(word) - 1)
    named = _rows(words, KEPT_WORDS, ["key", "n", "id"], "key binary, n long, id long").select(lang.alias("lang"), word.alias("word"), "n", "id")
    return named, _rows(pairs, KEPT_PAIRS, ["a", "b", "n", "id"], "a long, b long, n long, id long").filter("id >= 0"), triples


def _replaced(old: DataFrame | None, new: DataFrame) -> DataFrame:
    if old is not None:
        dropped(old)
    return new


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)) in decimals: exact for counts below 10^14."""
    number = lambda c: f"CAST({c} AS DECIMAL(14,0))"
    return F.expr(f"(CAST({SCALE} AS DECIMAL(7,0)) * {number(a)} * {number(a)}) div ({number(left)} * {number(right)})")


def _best(scored: DataFrame, first: int) -> DataFrame:
    """The first ``first`` rows of every lang with their rank: those of bounded groups are found before those of the language."""
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    rank = lambda *key: F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    spread = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(GROUPS)))
    some = spread.withColumn("place", rank("lang", "part")).filter(F.col("place") <= first)
    return some.withColumn("rank", rank("lang").cast("long")).filter(F.col("rank") <= first)


def collocations(
    docs: DataFrame, first: int = 2000, least: int = LEAST, covered: int = COVERED, shards: int = SHARDS, chunk_bytes: int = CHUNK_BYTES, parts: int | None = None
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two or three words in every language.

    ``docs`` is (text, lang); a null text counts as empty, a null lang as ``und``. A phrase is scored at the cut where it scores
    least, the first of equal ones; pairs inside a triple with at least ``covered`` hundredths of their count are left out.
    Words have A-Z in lower case, and are otherwise bytes between blanks, tabs and the marks that end a piece. Documents
    repeat as often as their rows do. No rows, or no phrase that occurs ``least`` times, give no rows.
    """
    words, pairs, triples = counted(docs, least, shards, chunk_bytes, parts)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    named = words.filter("id >= 0").select("id", "lang", "word", F.col("n").alias("f"))
    frequent = pairs.select("id", "a", "b", "n")
    side = lambda c: named.select(F.col("id").alias(c), F.col("word").alias(f"word_{c}"), F.col("f").alias(f"f_{c}"))
    first_word = named.select(F.col("id").alias("a"), F.col("word").alias("word_a"), F.col("f").alias("f_a"), "lang")
    whole = written(frequent.join(first_word, "a").join(side("b"), "b").select("id", "lang", "word_a", "word_b", "f_a", "f_b", "n"), "pairs-named")
    kept = triples.filter(F.col("n") >= least).select("a", "b", F.col("n").alias("m"))
    over = kept.select(F.col("a").alias("id"), "m").unionByName(kept.select(F.col("b").alias("id"), "m")).groupBy("id").agg(F.max("m").alias("longest"))
    two = whole.join(over, "id", "left").filter(F.expr(f"longest IS NULL OR 100 * longest < {covered} * n"))
    two = two.select("lang", F.concat_ws(" ", "word_a", "word_b").alias("phrase"), F.col("n").alias("a"), F.col("f_a").alias("l"), F.col("f_b").alias("r"))
    two = two.withColumn("score", _score("a", "l", "r"))
    left = whole.select(F.col("id").alias("a"), "lang", "word_a", "word_b", "f_a", F.col("n").alias("n_left"))
    right = whole.select(F.col("id").alias("b"), F.col("word_b").alias("word_c"), F.col("f_b").alias("f_c"), F.col("n").alias("n_right"))
    three = kept.join(left, "a").join(right, "b")
    three = three.withColumns({"one": _score("m", "f_a", "n_right"), "other": _score("m", "n_left", "f_c")})
    cut = F.col("one") <= F.col("other")
    three = three.select(
        "lang",
        F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"),
        F.col("m").alias("a"),
        F.when(cut, F.col("f_a")).otherwise(F.col("n_left")).alias("l"),
        F.when(cut, F.col("n_right")).otherwise(F.col("f_c")).alias("r"),
        F.least("one", "other").alias("score"),
    )
    # A few rows per language, at most the first ones, meet one size each.
    return _best(two.unionByName(three), first).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
