"""Long repeats found by run-length indexes over the repetitive part of a corpus.

Every window of ``WIDTH`` bytes has an anchor, its least gram by hash, which the window's bytes alone decide. Windows in a row that
share an anchor are one phrase, so equal windows lie in phrases with equal anchors. Phrases meet by content first, as in the
dictionary of a prefix-free parse: of equal phrases only the earliest goes on, and only where another phrase has its anchor.
These phrases are dealt by anchor into bounded buckets. A bucket builds the run-compressed Burrows-Wheeler transform of its
phrases and keeps samples at the ends of runs only; matching statistics streamed from these samples give every window's longest
match with its lexicographic neighbour, long matches are chained, and all but the earliest window of a chain are marked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlattice.llm import chunks
from revlattice.llm.common import dropped, groups_for, shuffles_dropped, small_batches, written

WIDTH, GRAM = 100, 40
#: A chunk of documents, the windows hashed at once, and the phrases of a bucket.
CHUNK_BYTES, SLICE, BUCKET_PHRASES = 4_000_000, 1 << 15, 10_000
#: Phrases of an index, or a few more as those of one anchor stay together.
INDEXED = 300
#: Anchors with more different phrases than this are compared window by window.
CROWDED = 2_000
#: A place is a chunk's number and an offset of 31 bits in it; a chunk's number is its task's and one of 14 bits.
OFFSET_BITS, CHUNK_BITS = 31, 14
PLACED = "chunk long, data binary"
PHRASES = "anchor long, h1 long, h2 long, place long"
#: The second hash of a phrase holds its number of windows, less one, in its last bits.
WINDOW_BITS = 8
RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


@dataclass(frozen=True)
class Phrases:
    """Runs of windows: first window, number of windows, anchor's hash and two hashes of the content."""

    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    h1: np.ndarray
    h2: np.ndarray


@cache
def _tables(width: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """For two hashes modulo 2**64: a number for each byte, and powers of an odd base and of its inverse."""
    rng = np.random.default_rng(20)
    codes, powers, inverse = [], [], []
    for _ in range(2):
        base = int(rng.integers(0, 1 << 62)) * 2 + 1
        codes.append(rng.integers(0, 1 << 64, 256, dtype=np.uint64))
        for held, b in ((powers, base), (inverse, pow(base, -1, 1 << 64))):
            steps = np.full(SLICE + width + 1, b, dtype=np.uint64)
            steps[0] = 1
            held.append(np.cumprod(steps))
    return codes, powers, inverse


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, odd in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x ^ (x >> np.uint64(32))


def _least(keys: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` keys in a row."""
    width = 1
    while 2 * width <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    return np.minimum(keys[: len(keys) - (span - width)], keys[span - width :])


def phrases(data: np.ndarray, lengths: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> Phrases:
    """The phrases of documents of ``lengths`` bytes that ``data`` (uint8) holds one after another."""
    if not 0 <= width - gram < 1 << WINDOW_BITS:
        raise ValueError("a gram must be at most as long as a window, and not much shorter")
    codes, powers, inverse = _tables(width)
    ends = np.repeat(np.cumsum(lengths), lengths)
    found = []
    for begin in range(0, max(0, len(data) - width + 1), SLICE):
        some = data[begin : begin + SLICE + width - 1]
        sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(c[some] * p[: len(some)]))) for c, p in zip(codes, powers, strict=True)]
        grams = _mixed((sums[0][gram:] - sums[0][:-gram]) * inverse[0][: len(some) - gram + 1])
        # The upper bits of the hash and the place: the first of equal grams is the least.
        keys = (grams & np.uint64(~(2 * SLICE - 1) & (2**64 - 1))) | np.arange(len(grams), dtype=np.uint64)
        least = (_least(keys, width - gram + 1) & np.uint64(2 * SLICE - 1)).astype(np.int64)
        valid = ends[begin : begin + len(least)] - np.arange(begin, begin + len(least)) >= width
        joins = np.zeros(len(least), dtype=bool)
        joins[1:] = valid[1:] & valid[:-1] & (least[1:] == least[:-1])
        starts = np.flatnonzero(valid & ~joins)
        # A phrase ends before the next one or before the first window that is none.
        borders = np.flatnonzero(~joins)
        windows = np.append(borders[1:], len(least))[np.searchsorted(borders, starts)] - starts
        sizes = windows.astype(np.uint64)
        h1, h2 = (_mixed((s[starts + windows + width - 1] - s[starts]) * i[starts] + sizes) for s, i in zip(sums, inverse, strict=True))
        found.append((starts + begin, windows, grams[least[starts]], h1, (h2 << np.uint64(WINDOW_BITS)) | (sizes - np.uint64(1))))
    if not found:
        none = np.zeros(0, dtype=np.uint64)
        return Phrases(none.astype(np.int64), none.astype(np.int64), none, none, none)
    return Phrases(*(np.concatenate(x) for x in zip(*found, strict=True)))


def in_order(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) as chunks whose numbers follow the order of the documents, a written table.

    Rows are ordered by doc_id, null last, then by the MD5 of the text.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("digest"))
    order = [F.col("doc_id").asc_nulls_last(), "digest", "tie"]
    # Equal rows are told apart by their place in the input, so that many of them are spread.
    spread = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << CHUNK_BITS
        chunk, ids, texts, size = first, [], [], 0

        def row() -> pa.RecordBatch:
            if chunk - first >= 1 << CHUNK_BITS:
                raise ValueError("a task holds too many chunks: raise spark.sql.shuffle.partitions")
            held = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_binary())})
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([chunks.packed(held)], pa.binary())], names=["chunk", "data"])

        for batch in batches:
            for doc_id, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(some.encode("utf-8", "surrogatepass"))
                size += len(texts[-1]) + 100
                if size >= chunk_bytes:
                    yield row()
                    chunk, ids, texts, size = chunk + 1, [], [], 0
        if ids:
            yield row()

    return written(spread.select("doc_id", "text").mapInArrow(cut, PLACED), "documents")


def _opened(data: bytes) -> tuple[pa.Array, list[bytes], np.ndarray, np.ndarray]:
    """Ids, texts, their lengths and all their bytes."""
    table = chunks.unpacked(data)
    texts = chunks.flat(table.column("text")).to_pylist()
    return chunks.flat(table.column("doc_id")), texts, np.array([len(t) for t in texts], dtype=np.int64), np.frombuffer(b"".join(texts), dtype=np.uint8)


def _contents(found: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """The first phrase of each content, and for every phrase the number of its content."""
    order = np.argsort(found.h1, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = (found.h1[order][1:] != found.h1[order][:-1]) | (found.h2[order][1:] != found.h2[order][:-1])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def distinct_phrases(placed: DataFrame, width: int, gram: int) -> DataFrame:
    """(anchor, h1, h2, place): every chunk's different phrases, each at its first place in the chunk."""
    schema = pa.schema([("anchor", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, _, lengths, held = _opened(data)
                found = phrases(held, lengths, width, gram)
                kept, _ = _contents(found)
                if len(kept):
                    columns = [*(x[kept].view(np.int64) for x in (found.anchor, found.h1, found.h2)), found.start[kept] + (chunk << OFFSET_BITS)]
                    yield _batch(columns, schema)

    return placed.mapInArrow(run, PHRASES)


def _chunk(place: str = "place"):
    return F.shiftright(place, OFFSET_BITS)


def _texts_of(placed: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(anchor, place, text) of the phrases in ``wanted`` (anchor, place, windows)."""
    schema = pa.schema([("anchor", pa.int64()), ("place", pa.int64()), ("text", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(right):
            return schema.empty_table()
        raw, chunk = _opened(left.column("data")[0].as_py())[3].tobytes(), left.column("chunk")[0].as_py()
        places, windows = right.column("place").to_numpy(), right.column("windows").to_numpy()
        texts = [raw[s : s + n + width - 1] for s, n in zip((places - (chunk << OFFSET_BITS)).tolist(), windows.tolist(), strict=True)]
        return pa.table([chunks.flat(right.column("anchor")), pa.array(places), pa.array(texts, pa.binary())], schema=schema)

    asked = wanted.select(_chunk().alias("chunk"), "anchor", "place", "windows").groupBy("chunk")
    return placed.groupBy("chunk").cogroup(asked).applyInArrow(run, "anchor long, place long, text binary")


def suffixes(symbols: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``symbols`` in the order of what follows up to ``end``, where a 0 stands; equal ones in the order of places."""
    here = np.arange(len(symbols))
    packed, width = np.zeros(len(symbols), dtype=np.int64), 7
    for step in range(width):
        packed = (packed << 9) | symbols[np.minimum(here + step, end)]
    while True:
        order = np.argsort(packed)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(np.diff(packed[order], prepend=packed[order[:1]]) != 0)
        if rank[order[-1]] == len(order) - 1:
            return order
        if width >= depth:
            return np.argsort(rank * len(order) + here)
        packed = rank * len(order) + rank[np.minimum(here + width, end)]
        width *= 2


@dataclass(frozen=True)
class RunIndex:
    """A run-compressed Burrows-Wheeler transform: the symbol of every run, its first row, and the places sampled at both ends."""

    head: np.ndarray
    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    size: int

    @classmethod
    def build(cls, symbols: np.ndarray, end: np.ndarray, depth: int) -> RunIndex:
        order = suffixes(symbols, end, depth)
        before = symbols[order - 1]
        row = np.flatnonzero(np.diff(before, prepend=-1))
        return cls(before[row], row, order[row], order[np.append(row[1:], len(order)) - 1], len(order))

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Sampled places, and the place whose text comes before that of each in the order of suffixes.

        Rows of one run keep their order when their symbol is put in front of them, so only the place before a run's first row
        has a neighbour that the place behind it does not tell: the one before the last row of the run that comes before it in
        the order of symbols. Ends have the least symbol and the order of places, the last one that of the last string.
        """
        order = np.lexsort((self.row, self.head))
        order, above = order[1:], np.where(self.head[order[:-1]] == 0, self.size - 1, self.last[order[:-1]] - 1)
        inner = self.head[order] > 0
        return self.first[order[inner]] - 1, above[inner]


def common(symbols: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the texts at ``a`` and ``b`` share, up to the nearer end."""
    length = np.zeros(len(a), dtype=np.int64)
    room = np.minimum(end[a] - a, end[b] - b)
    open_ = np.flatnonzero(room > 0)
    while len(open_):
        same = symbols[a[open_] + length[open_]] == symbols[b[open_] + length[open_]]
        open_ = open_[same]
        length[open_] += 1
        open_ = open_[length[open_] < room[open_]]
    return length


def statistics(symbols: np.ndarray, end: np.ndarray, index: RunIndex) -> tuple[np.ndarray, np.ndarray]:
    """For every place: its neighbour in the order of suffixes and the length that both share, streamed from the samples.

    From right to left the neighbour moves along, and what is shared grows by one, until a sampled place.
    """
    place, above = index.neighbours()
    # Ends come in the order of places and share nothing.
    stops = np.flatnonzero(symbols == 0)
    sampled = np.full(len(symbols), len(symbols), dtype=np.int64)
    sampled[place], sampled[stops] = place, stops
    sampled = np.minimum.accumulate(sampled[::-1])[::-1]
    near, length = np.full(len(symbols), -1, dtype=np.int64), np.zeros(len(symbols), dtype=np.int64)
    near[place], length[place] = above, common(symbols, end, place, above)
    near[stops], length[stops] = np.concatenate(([-1], stops[:-1])), 0
    step = sampled - np.arange(len(symbols))
    here = np.where(near[sampled] >= 0, near[sampled] - step, -1)
    return here, np.where(here >= 0, length[sampled] + step, 0)


def repeated(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Offsets of the windows in every text that also start earlier, in a text before or in the same one."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    symbols = np.zeros(int(lengths.sum()) + len(texts), dtype=np.int64)
    stops = np.cumsum(lengths + 1) - 1
    body = np.ones(len(symbols), dtype=bool)
    body[stops] = False
    symbols[body] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int64) + 1
    end = np.repeat(stops, lengths + 1)
    index = RunIndex.build(symbols, end, int(lengths.max()) + 1)
    near, shared = statistics(symbols, end, index)
    chain = np.where(shared >= width, near, np.arange(len(symbols)))
    while not np.array_equal(further := chain[chain], chain):
        chain = further
    earliest = np.full(len(symbols), len(symbols), dtype=np.int64)
    np.minimum.at(earliest, chain, np.arange(len(symbols)))
    late = np.flatnonzero(earliest[chain] < np.arange(len(symbols)))
    late = late[end[late] - late >= width]
    text = np.searchsorted(stops, late)
    offsets = late - (stops - lengths)[text]
    return np.split(offsets, np.searchsorted(text, np.arange(1, len(texts))))


def _in_buckets(texts: DataFrame, buckets: int, width: int) -> DataFrame:
    """(place): every window in the phrases of ``texts`` (anchor, place, text) that an earlier phrase of its bucket holds."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("anchor", "ascending"), ("place", "ascending")])
        anchors, places, texts = rows.column("anchor").to_numpy(), rows.column("place").to_numpy(), rows.column("text").to_pylist()
        # Phrases of different anchors share no window: an index over some anchors is as good as one over all, and stays small.
        borders = np.append(np.flatnonzero(np.diff(anchors, prepend=anchors[0] - 1)), len(anchors))
        late, begin = [np.zeros(0, np.int64)], 0
        for end in borders[1:].tolist():
            if end - begin < INDEXED and end < len(anchors):
                continue
            order = np.argsort(places[begin:end]) + begin
            found = repeated([texts[i] for i in order], width)
            late.append(np.repeat(places[order], [len(x) for x in found]) + np.concatenate(found))
            begin = end
        return pa.table({"place": pa.array(np.concatenate(late), pa.int64())})

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")
    return texts.select(bucket, "anchor", "place", "text").groupBy("bucket").applyInArrow(run, "place long")


def _by_window(texts: DataFrame, width: int) -> DataFrame:
    """(place): the same for phrases of crowded anchors, whose windows are compared by their digests, each on its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            rows = [
                (hashlib.blake2b(text[i : i + width], digest_size=16).digest(), place + i)
                for place, text in zip(batch.column("place").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for i in range(len(text) - width + 1)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())], names=["digest", "place"])

    windows = texts.select("place", "text").mapInArrow(cut, "digest binary, place long")
    first = windows.groupBy("digest").agg(F.min("place").alias("place"))
    # As many rows as there are different windows: sorted and merged, never sent to all.
    return windows.join(first.hint("merge"), "place", "left_anti").select("place")


def _spans(marked: np.ndarray, length: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that windows starting at ``marked`` (in order) cover."""
    if not len(marked):
        return marked, marked
    new = np.flatnonzero(np.diff(marked) > width)
    return marked[np.append(0, new + 1)], np.append(marked[new], marked[-1]) + width


def removed(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, crowded: int = CROWDED, chunk_bytes: int = CHUNK_BYTES, bucket_phrases: int = BUCKET_PHRASES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, n_removed, the removed spans (byte offsets) and the kept bytes.

    A byte goes if a string of ``width`` bytes that covers it also starts earlier: in a document with a smaller doc_id, or
    earlier in the same one. Rows without doc_id come last; rows that share one go by the MD5 of their text, so of equal rows
    one keeps its bytes. Null and empty texts have no bytes; matches never cross texts. No rows give no rows. Equality of
    phrases is that of 120 bits of two hashes and their length, and that of windows inside a bucket is exact.
    """
    # The shuffles of a stage go when its table is written, so that the stages take the disk of one.
    with shuffles_dropped(docs.sparkSession):
        placed = in_order(docs, chunk_bytes)
        told = distinct_phrases(placed, width, gram)
        met = told.withColumn("copy", F.col("place") > F.min("place").over(Window.partitionBy("h1", "h2")))
        windows = (F.col("h2").bitwiseAND((1 << WINDOW_BITS) - 1) + 1).cast("int")
        met = met.select("copy", F.when(~F.col("copy"), F.col("anchor")).alias("anchor"), F.when(~F.col("copy"), windows).alias("windows"), "place")
        met = written(met, "phrases")
        single = met.filter("NOT copy").select("anchor", "windows", "place")
        shared = single.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        wanted = written(single.join(shared, "anchor").select("anchor", "place", "windows", (F.col("n") > crowded).alias("crowd")), "wanted")
        buckets = groups_for(wanted.filter("NOT crowd").count(), bucket_phrases)
        texts = written(_texts_of(placed, wanted.filter("NOT crowd"), width), "texts")
        crowds = written(_texts_of(placed, wanted.filter("crowd"), width), "crowds")
        dropped(wanted)
    marks = _in_buckets(texts, buckets, width).unionByName(_by_window(crowds, width))
    with shuffles_dropped(docs.sparkSession):
        marks = written(marks, "marks")
        for table in (texts, crowds):
            dropped(table)
    facts = [f.select(_chunk().alias("chunk"), "place", F.lit(copy).alias("copy")) for f, copy in ((met.filter("copy"), True), (marks, False))]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = left.column("chunk")[0].as_py()
        ids, texts, lengths, held = _opened(left.column("data")[0].as_py())
        found = phrases(held, lengths, width, gram)
        first, number = _contents(found)
        place, copy = right.column("place").to_numpy() - (chunk << OFFSET_BITS), right.column("copy").to_numpy(zero_copy_only=False).astype(bool)
        # A content that an earlier chunk holds is late in all its places, any other in all but its first.
        late = np.ones(len(number), dtype=bool)
        late[first] = False
        seen = np.zeros(len(first), dtype=bool)
        seen[number[np.searchsorted(found.start, place[copy])]] = True
        whole = np.flatnonzero(late | seen[number])
        runs = found.windows[whole]
        begins = np.repeat(found.start[whole] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        late = np.unique(np.concatenate((begins, place[~copy])))
        bases = np.concatenate(([0], np.cumsum(lengths)))
        borders = np.searchsorted(late, bases)
        rows = []
        for i, text in enumerate(texts):
            starts, stops = _spans(late[borders[i] : borders[i + 1]] - bases[i], len(text), width)
            spans = [{"start": a, "end": b} for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
            edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if spans else text
            rows.append((len(text), len(text) - len(kept), spans, kept))
        sizes, gone, spans, kept = zip(*rows, strict=True)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": ids, "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary())})

    return placed.groupBy("chunk").cogroup(facts[0].unionByName(facts[1]).groupBy("chunk")).applyInArrow(finish, RESULT)
