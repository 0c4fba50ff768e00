"""N-gram Jaccard join at a fixed similarity by partitioning the universe of shingles.

A pair of sets that reaches the similarity differs in few elements, so of enough segments of the universe at least one
holds the same elements of both. Segments are hash ranges; their number depends on the size band of the smaller set, so a
set is cut by its own band and by the band below. Each non-empty segment of a set is a signature. Sets with too many empty
segments for the pigeonhole to hold also publish their segments with one element taken away, and in the last resort empty
ones; how many segments a band uses weighs the extra signatures of both kinds. Sets that share a signature are verified
exactly. Equal sets are one node from the start, and buckets are first joined as stars, so that only pairs which the links
found so far do not connect are compared one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.llm.common import groups_for, small_batches, written
from revlattice.llm.components import components
from revlattice.llm.wordhash import Hashed, mixed_bits, segments, words

WORDS = 5
CHUNK_CHARS, CHUNK_TEXTS = 16_000_000, 60_000
PART_CHARS = 20_000_000
SKETCH = 8
GROUP = 512
LOW_BITS = 40
SKETCHES = [f"s{i}" for i in range(SKETCH)]
ROW = "id long, doc_id long, size int, node long, " + ", ".join(f"{s} long" for s in SKETCHES)
PIECES = f"part int, first long, data binary, {ROW}"
FOUND = f"signature long, {ROW}"

_INSIDE = np.ones(256, dtype=bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False
_COUNTS: dict[int, int] = {}
_FACTORS = mixed_bits(np.arange(1, 33, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[str], length: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of every text; fewer words than ``length`` are one shingle, no words none."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for data, numbers, begins in segments([t.encode("utf-8", "surrogatepass").lower() for t in texts]):
        raw = np.frombuffer(data, dtype=np.uint8)
        starts, ends = words(raw, _INSIDE)
        hashes = Hashed(raw).ranges(starts, ends)
        edges = np.searchsorted(starts, np.append(begins, len(raw)))
        for i, number in enumerate(numbers):
            found[number].append(hashes[edges[i] : edges[i + 1]])
    out = []
    for pieces in found:
        word = pieces[0] if len(pieces) == 1 else np.concatenate(pieces)
        if len(word) >= length:
            window = np.lib.stride_tricks.sliding_window_view(word, length)
            out.append(np.unique(mixed_bits((window * _FACTORS[:length]).sum(axis=1))))
        elif len(word):
            out.append(mixed_bits((word * _FACTORS[: len(word)]).sum(keepdims=True) + np.uint64(len(word))))
        else:
            out.append(word)
    return out


def _most_different(sizes: np.ndarray | int, own: bool):
    """How many elements a set of this size may differ in from a partner: at least its size, or (not own) at most."""
    return sizes // 4 if own else 2 * sizes // 9


def band_ends(largest: int) -> tuple[int, ...]:
    """Upper ends (exclusive) of the size bands, each at most 1.25 times the last; sizes below 4 only equal themselves."""
    ends = [4]
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, ends[-1] * 5 // 4))
    return tuple(ends)


def least_filled(end: int) -> int:
    """Smaller segments of a band are not published: of large sets a single element in common says little."""
    return 2 if end > 32 else 1


def segment_count(end: int) -> int:
    """Segments for a band: the number that costs the fewest signatures for its largest sets.

    More segments than differences plus one leave room for those that are not published; the alternative is a one-deletion
    neighbourhood of the whole set, as often as unpublished segments outgrow the room.
    """
    if end in _COUNTS:
        return _COUNTS[end]
    size, least = end - 1, _most_different(end - 1, True) + 1

    def cost(count: int) -> float:
        unfilled = count * (1 - 1 / count) ** size
        if least_filled(end) == 2:
            unfilled += size * (1 - 1 / count) ** (size - 1)
        room = (count - least + 0.5 - unfilled) / math.sqrt(unfilled + 1e-9)
        return count - unfilled + size * 0.5 * math.erfc(room / math.sqrt(2))

    _COUNTS[end] = min(range(least, 2 * least + 8), key=cost)
    return _COUNTS[end]


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, set numbers): two sets that reach the similarity share one, unless they are equal.

    Of a pair that differs in at most d elements, one of any d + 1 segments is equal. So equal segments are enough where a
    set publishes more segments than it may differ in. Otherwise segments that differ in one element are met through their
    one-deletion neighbourhoods, and where these do not suffice either, segments of every size are published. Each tier
    is needed only where both sets lack the ones before, and a set that lacks a tier publishes the next.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out, owners = [], []
    if not len(sets) or sizes.max() < 4:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.array(band_ends(int(sizes.max())), dtype=np.int64)
    # The first end is that of the sizes without a band.
    counts = np.array([0, *(segment_count(int(e)) for e in ends[1:])], dtype=np.int64)
    smallest = np.array([0, *(least_filled(int(e)) for e in ends[1:])], dtype=np.int64)
    band = np.searchsorted(ends, sizes, side="right")
    for own in (True, False):
        use = band - (0 if own else 1)
        chosen = np.flatnonzero((use >= 1) & (sizes > 0))
        if not own:
            chosen = chosen[4 * sizes[chosen] <= 5 * (ends[use[chosen]] - 1)]
        if not len(chosen):
            continue
        elements = np.concatenate([sets[i] for i in chosen])
        each = sizes[chosen]
        count, bands, need = counts[use[chosen]], use[chosen], smallest[use[chosen]]
        set_row = np.repeat(np.arange(len(chosen)), each)
        segment = ((elements >> np.uint64(32)) * count[set_row].astype(np.uint64)) >> np.uint64(32)
        base = np.concatenate(([0], np.cumsum(count)[:-1]))
        cell = base[set_row] + segment.astype(np.int64)
        starts = np.flatnonzero(np.diff(cell, prepend=-1))
        width = np.diff(np.append(starts, len(cell)))
        owner = set_row[starts]
        value = mixed_bits(elements)
        sums = np.add.reduceat(value, starts)
        salt = mixed_bits(segment[starts] + (bands[owner].astype(np.uint64) << np.uint64(32)))
        most = _most_different(each, own)
        filled = np.bincount(owner[width >= need[owner]], minlength=len(chosen))
        more = np.bincount(owner[width > need[owner]], minlength=len(chosen))
        short = filled <= most
        last = short & (filled + more <= most)
        shown = (width >= need[owner]) | last[owner]
        out.append(mixed_bits(sums[shown] ^ salt[shown]))
        owners.append(chosen[owner[shown]])
        if not short.any():
            continue
        cell_row = np.repeat(np.arange(len(starts)), width)
        taken = short[set_row] & (width[cell_row] > 1)
        out.append(mixed_bits((sums[cell_row[taken]] - value[taken]) ^ salt[cell_row[taken]]))
        owners.append(chosen[set_row[taken]])
        for row in np.flatnonzero(last):
            # The sum over no elements, for empty segments and those of one element.
            there = np.ones(count[row], dtype=bool)
            there[segment[starts[(owner == row) & (width > 1)]].astype(np.int64)] = False
            free = np.flatnonzero(there).astype(np.uint64)
            out.append(mixed_bits(mixed_bits(free + (np.uint64(bands[row]) << np.uint64(32)))))
            owners.append(np.full(len(free), chosen[row]))
    return np.concatenate(out), np.concatenate(owners)


def node_of(shingles: np.ndarray) -> int:
    """One number for equal sets."""
    return int(mixed_bits(np.add.reduce(mixed_bits(shingles ^ np.uint64(0xA0761D6478BD642F)), keepdims=True) + np.uint64(len(shingles)))[0].view(np.int64))


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """Parities of the elements in 64 x 8 slots: two sketches differ in no more bits than their sets in elements."""
    odd = np.bincount((shingles & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _pack(values: np.ndarray, owner: np.ndarray) -> bytes:
    """Sorted numbers and 16-bit owners; steps of 32 bits where they suffice."""
    steps = np.diff(values, prepend=np.uint64(0))
    if steps.max() < 1 << 32:
        return b"s" + owner.tobytes() + steps.astype(np.uint32).tobytes()
    return b"v" + owner.tobytes() + values.tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = 4 if data[:1] == b"s" else 8
    count = (len(data) - 1) // (2 + width)
    values = np.frombuffer(data, dtype=np.uint32 if width == 4 else np.uint64, offset=1 + 2 * count)
    return np.cumsum(values, dtype=np.uint64) if width == 4 else values, np.frombuffer(data, dtype=np.uint16, count=count, offset=1)


def _pieces(docs: DataFrame, bits: int, chunk_chars: int) -> DataFrame:
    """Documents (part -1 and below: id, doc_id, size, node, sketch) and the signatures of each chunk, packed by part.

    A row's id is the first id of its chunk plus its place there.
    """
    small_batches(docs.sparkSession)
    names = ["part", "first", "data", "id", "doc_id", "size", "node", *SKETCHES]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * (1 + SKETCH)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        known: set[int] = set()
        place = chars = 0

        def packs() -> Iterator[pa.RecordBatch]:
            values = np.concatenate(held) if held else np.zeros(0, np.uint64)
            if not len(values):
                return
            values >>= np.uint64(64 - LOW_BITS - bits)
            owner = np.concatenate(owners)
            order = np.argsort(values)
            values, owner = values[order], owner[order].astype(np.uint16)
            part = (values >> np.uint64(LOW_BITS)).astype(np.int32)
            low = values & np.uint64((1 << LOW_BITS) - 1)
            at = np.flatnonzero(np.diff(part, prepend=-1))
            data = [_pack(low[s:e], owner[s:e]) for s, e in zip(at, [*at[1:], len(part)], strict=True)]
            columns = [pa.array(part[at]), pa.array(np.full(len(at), first)), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(at), k) for k in kinds[3:])], names=names)

        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            if place + len(texts) > CHUNK_TEXTS or chars > chunk_chars:
                yield from packs()
                first, held, owners, known, place, chars = first + (1 << 16), [], [], set(), 0, 0
            sets = shingle_sets(texts)
            nodes = [node_of(s) if len(s) else None for s in sets]
            fresh = []
            for i, node in enumerate(nodes):
                if node is not None and node not in known:
                    known.add(node)
                    fresh.append(i)
            values, owner = signatures([sets[i] for i in fresh])
            held.append(values)
            owners.append(np.array(fresh, dtype=np.int64)[owner] + place if len(fresh) else owner)
            sketches = np.stack([sketch_of(s) for s in sets])
            spread = -1 - np.arange(place, place + len(texts)) % (1 << bits)
            fixed = [pa.array(spread.astype(np.int32)), pa.array(np.full(len(texts), first)), pa.nulls(len(texts), pa.binary())]
            own = [pa.array(first + np.arange(place, place + len(texts))), ids, pa.array([len(s) for s in sets], pa.int32()), pa.array(nodes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*fixed, *own, *(pa.array(sketches[:, i]) for i in range(SKETCH))], names=names)
            place += len(texts)
            chars += sum(map(len, texts))
        yield from packs()

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def _found(pieces: DataFrame) -> DataFrame:
    """The documents (signature null), and (signature, id) of every signature that occurs more than once."""
    names = ["signature", "id", "doc_id", "size", "node", *SKETCHES]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * (1 + SKETCH)]

    def run(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        if part < 0:
            return pa.table([pa.nulls(len(rows), pa.int64()), *(rows.column(n) for n in names[1:])], names=names)
        values, owners = zip(*map(_unpack, rows.column("data").to_pylist()), strict=True)
        low = np.concatenate(values)
        ids = np.repeat(rows.column("first").to_numpy(), [len(v) for v in values]) + np.concatenate(owners)
        order = np.argsort(low, kind="stable")
        same = low[order][1:] == low[order][:-1]
        keep = order[np.append(same, False) | np.append(False, same)]
        signature = (np.uint64(part) << np.uint64(LOW_BITS)) | low[keep]
        return pa.table([signature.view(np.int64), ids[keep], *(pa.nulls(len(keep), k) for k in kinds[2:])], names=names)

    return pieces.groupBy("part").applyInArrow(run, FOUND)


def _alike(a: str, b: str) -> Column:
    """Sizes and sketches allow the similarity: an exact necessary condition."""
    size_a, size_b = F.col(f"{a}.size"), F.col(f"{b}.size")
    differ = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCHES))
    return (5 * F.least(size_a, size_b) >= 4 * F.greatest(size_a, size_b)) & (9 * differ <= size_a + size_b)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose sets reach the similarity. A hub's partners are split into groups of bounded size."""
    hubs = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("groups"))
    dealt = pairs.join(hubs, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int"))
    left = dealt.join(sets.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "shingles")
    own = hubs.join(sets.withColumnRenamed("node", "a"), "a")
    right = own.select(F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.col("shingles").alias("own"))

    def run(many: pa.Table, one: pa.Table) -> pa.Table:
        found = []
        if len(many):
            hub = np.frombuffer(one.column("own")[0].as_py(), dtype=np.uint64)
            for b, data in zip(many.column("b").to_pylist(), many.column("shingles").to_pylist(), strict=True):
                other = np.frombuffer(data, dtype=np.uint64)
                at = np.minimum(np.searchsorted(hub, other), len(hub) - 1)
                both = int((hub[at] == other).sum())
                if 100 * both >= 80 * (len(hub) + len(other) - both):
                    found.append(b)
        hub_node = many.column("a")[0].as_py() if found else None
        return pa.table({"a": pa.array([hub_node] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return left.groupBy("a", "salt").cogroup(right.groupBy("hub", "part")).applyInArrow(run, "a long, b long")


def linked(docs: DataFrame, part_chars: int = PART_CHARS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_shingles and component_id, the smallest doc_id that links reach.

    Words are split at ASCII white space and A-Z is lowered. Two rows link when their sets of distinct 5-word shingles
    have 100 * intersection >= 80 * union. A text of one to four words has one shingle, its whole sequence. Null and empty
    texts have none, link with nothing and are their own component. Rows that repeat a doc_id count one by one. A null
    doc_id never names a component that has another id. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    total = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    bits = min(24, max(2, (groups_for(total, part_chars) - 1).bit_length()))
    found = written(_found(_pieces(docs, bits, chunk_chars)), "found")
    rows = found.filter("signature is null").drop("signature")
    nodes = written(rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ["size", *SKETCHES])), "nodes")
    shared = found.filter("signature is not null").select("signature", "id").join(rows.select("id", "node"), "id")
    # One exchange by signature serves all three steps.
    hits = shared.select("signature", "node").repartition(F.col("signature")).distinct()
    buckets = hits.groupBy("signature").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    hits = written(hits.join(buckets, "signature"), "hits")
    # The hub of a bucket is its most central member, of copies of one text most likely that text.
    central = written(hits.groupBy("node").agg(F.sum("members").alias("central")), "central")
    hubs = hits.join(central, "node").groupBy("signature").agg(F.max(F.struct("central", "node")).alias("top")).select("signature", F.col("top.node").alias("hub"))

    # Each node meets the hub that it shares most signatures with.
    common = hits.join(hubs, "signature").filter("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n"))
    stars = common.groupBy("node").agg(F.max(F.struct("n", "hub")).alias("best")).select("node", "best.hub")
    met = stars.alias("p").join(nodes.alias("x"), F.col("p.node") == F.col("x.node")).join(nodes.alias("y"), F.col("p.hub") == F.col("y.node"))
    pairs = written(met.filter(_alike("x", "y")).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "pairs")
    # As if all of these were links; whatever that hides lies between nodes of these pairs and is looked for below.
    pairs = written(pairs.unionByName(_unconnected(hits, components(pairs), nodes)).distinct(), "pairs")

    chosen = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "doc_id"), "node")
    sets = written(_sets(docs, chosen), "sets")
    links = written(_verified(pairs, sets), "links")
    roots = components(links)
    hidden = written(_unconnected(hits, roots, nodes).join(pairs, ["a", "b"], "left_anti"), "pairs")
    if not hidden.isEmpty():
        roots = components(links.unionByName(written(_verified(hidden, sets), "links")))
    least = nodes.join(roots, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = nodes.join(roots, "node", "left").join(least, "root", "left").select("node", F.coalesce("component_id", "doc_id").alias("component_id"))
    return rows.join(named, "node", "left").select("doc_id", F.col("size").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(node, shingles) of the ``chosen`` (node, doc_id); shingles are sorted 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            found = {}
            for node, shingles in zip(wanted, shingle_sets([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                # Rows that repeat an id may hold another text.
                if len(shingles) and node_of(shingles) == node:
                    found[node] = shingles.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(found.values(), pa.binary())], names=["node", "shingles"])

    texts = docs.join(chosen.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(chosen["doc_id"])).select("node", "text")
    return texts.mapInArrow(run, "node long, shingles binary")


def _unconnected(hits: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, that share a signature, lie in different components and may reach the similarity."""
    placed = hits.select("signature", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("signature", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("signature").agg(F.max(F.struct("n", "root")).alias("major"), F.count(F.lit(1)).alias("roots"))
    placed = placed.join(mixed.filter("roots > 1").select("signature", F.col("major.root").alias("major")), "signature")
    placed = written(placed.join(nodes.drop("doc_id"), "node"), "mixed")
    minor = placed.filter("root <> major")
    # Every pair of two components has a member outside the bucket's largest one; if both are, the smaller node asks.
    asks = (F.col("x.signature") == F.col("y.signature")) & (F.col("x.root") != F.col("y.root"))
    once = (F.col("y.root") == F.col("y.major")) | (F.col("x.node") < F.col("y.node"))
    met = minor.alias("x").join(placed.alias("y"), asks & once & _alike("x", "y"))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
