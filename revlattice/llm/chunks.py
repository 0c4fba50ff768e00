"""Corpus vocabularies without a row per token.

Documents are read in chunks of bounded size. A chunk numbers its distinct keys (words, n-grams) and holds its documents as
sequences of those numbers, which are their positions. Only the distinct keys of a chunk are shuffled, packed by part of the
key space; every part sees each key of the corpus once, answers it, and the answers return to the chunks, where sequence
and answers meet. A chunk has one row for each part that it has keys of, a few bytes more than the keys: rows are never more
than distinct keys per chunk, however many parts there are.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.llm.common import groups_for, small_batches

CHUNK_CHARS = 9_000_000
#: Characters of the corpus for each part, and the fewest parts.
PART_CHARS, PARTS = 64_000_000, 64
#: ``digest`` tells one reading of a chunk from another: it is that of all its keys in turn.
SCHEMA = "chunk long, part int, digest long, data binary"
KEYS = {"key": pa.large_binary(), "count": pa.int64()}
GRAMS = {"key": pa.int64(), "count": pa.int64()}
#: The part number of a chunk's documents.
DOCS = -1

#: Texts of a chunk to: length of each sequence, all sequences of key numbers, the distinct keys, and how often each number
#: counts (once, if None).
Numbering = Callable[[list[str]], tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray | None]]


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def sealed(columns: Mapping[str, np.ndarray | pa.Array]) -> bytes:
    """Columns as bytes that only a reader who knows their kinds can open: a stream of Arrow tells them anew in every cell.

    A column is numbers, or binary or list values as their lengths and what is in them.
    """
    out = []
    for column in columns.values():
        if isinstance(column, np.ndarray):
            out.append(column)
        else:
            out.append(pa.compute.fill_null(pa.compute.binary_length(column) if not hasattr(column, "flatten") else pa.compute.list_value_length(column), 0).to_numpy().astype(np.uint32))
            out.append(column.flatten().to_numpy() if hasattr(column, "flatten") else np.frombuffer(b"".join(column.to_pylist()), np.uint8))
    raw = b"".join(x.tobytes() for x in out)
    sizes = struct.pack(f"<{len(out) + 1}I", len(raw), *(len(x) for x in out))
    return sizes + pa.compress(raw, codec="zstd", asbytes=True)


def opened(data: bytes, kinds: Mapping[str, pa.DataType]) -> dict[str, pa.Array]:
    """The columns that ``sealed`` packed; they need not have one length."""
    nested = {n: pa.types.is_large_binary(k) or pa.types.is_list(k) for n, k in kinds.items()}
    header = struct.Struct(f"<{1 + len(kinds) + sum(nested.values())}I")
    total, *sizes = header.unpack_from(data)
    raw, at = memoryview(pa.decompress(data[header.size :], total, codec="zstd")), 0
    columns, sizes = [], iter(sizes)

    def take(dtype) -> np.ndarray:
        nonlocal at
        n = next(sizes)
        found = np.frombuffer(raw, dtype, n, at)
        at += found.nbytes
        return found

    for name, kind in kinds.items():
        if not nested[name]:
            columns.append(pa.array(take(kind.to_pandas_dtype())))
            continue
        offsets = np.concatenate(([0], np.cumsum(take(np.uint32), dtype=np.int64)))
        if pa.types.is_list(kind):
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(take(kind.value_type.to_pandas_dtype()))))
        else:
            columns.append(pa.LargeBinaryArray.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(take(np.uint8).tobytes())]))
    return dict(zip(kinds, columns, strict=True))


def flat(column: pa.ChunkedArray) -> pa.Array:
    """One array of a column, also where it has no chunks."""
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


class _Numbers(dict):
    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def by_token(tokens: Callable[[str], list]) -> Numbering:
    """Numbers the tokens (str or bytes) of every text in the order they are met."""

    def number(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array, None]:
        known = _Numbers()
        found, lengths = [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            some = tokens(text)
            lengths[i] = len(some)
            found.append(np.fromiter(map(known.__getitem__, some), dtype=np.int32, count=len(some)))
        keys = [k.encode("utf-8", "surrogatepass") if isinstance(k, str) else k for k in known]
        return lengths, np.concatenate(found) if found else np.zeros(0, np.int32), pa.array(keys, pa.large_binary()), None

    return number


def parts_of(keys: pa.Array, parts: int) -> np.ndarray:
    if pa.types.is_integer(keys.type):
        hashed = keys.to_numpy(zero_copy_only=False).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((hashed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    return np.fromiter((zlib.crc32(k) % parts for k in keys.to_pylist()), dtype=np.int64, count=len(keys))


def part_count(docs: DataFrame, part_chars: int = PART_CHARS) -> int:
    """Parts of the key space: as many as a corpus of some size needs for a part to fit one task, and never few."""
    return groups_for(docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0], part_chars, PARTS)


def _digest(keys: pa.Array) -> int:
    """64 bits of all keys in turn."""
    found = hashlib.blake2b(digest_size=8)
    for key in keys.buffers()[1:]:
        found.update(key or b"")
    return int.from_bytes(found.digest(), "little", signed=True)


def chunked(docs: DataFrame, number: Numbering, parts: int, chunk_chars: int = CHUNK_CHARS, exchanged: bool = True) -> DataFrame:
    """Rows (chunk, part, data): the documents of a chunk under part -1, its distinct keys under their parts.

    ``docs`` is (doc_id, text, learn); a null text counts as empty. Keys carry how often documents with ``learn`` hold them.
    ``exchanged`` deals the rows by chunk, so that readers in one plan share the exchange; a table to be written needs none.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        ids, texts, learn, chars = [], [], [], 0

        def row(part: int, digest: int, data: bytes) -> pa.RecordBatch:
            columns = [pa.array([chunk], pa.int64()), pa.array([part], pa.int32()), pa.array([digest], pa.int64()), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "part", "digest", "data"])

        def rows() -> Iterator[pa.RecordBatch]:
            lengths, sequence, keys, times = number(texts)
            texts.clear()
            where = parts_of(keys, parts)
            order = np.argsort(where, kind="stable")
            place = np.empty(len(order), dtype=np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            sequence = place[sequence]
            learned = np.repeat(np.array(learn, dtype=bool), lengths)
            counts = np.bincount(sequence[learned], None if times is None else times[learned], len(order)).astype(np.int64)
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
            lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(sequence, pa.int32()))
            table = pa.table({"doc_id": pa.array(ids, pa.int64()), "learn": pa.array(learn, pa.bool_()), "keys": lists})
            if times is not None:
                table = table.append_column("times", pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(times, pa.int32())))
            ordered = keys.take(pa.array(order))
            digest = _digest(ordered)
            yield row(DOCS, digest, packed(table.replace_schema_metadata({"keys": str(len(order))})))
            del table, lists, sequence, learned
            starts = np.flatnonzero(np.diff(where[order], prepend=-1))
            for start, end in zip(starts, np.append(starts[1:], len(order)), strict=False):
                some = ordered[start:end] if pa.types.is_large_binary(ordered.type) else ordered[start:end].to_numpy()
                yield row(int(where[order[start]]), digest, sealed({"key": some, "count": counts[start:end]}))

        for batch in batches:
            for doc_id, text, learns in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids.append(doc_id)
                texts.append(text or "")
                learn.append(bool(learns))
                chars += len(texts[-1]) + 100
                if chars >= chunk_chars:
                    yield from rows()
                    chunk += 1
                    ids, texts, learn, chars = [], [], [], 0
        if ids:
            yield from rows()

    cells = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce("learn", F.lit(False)).alias("learn")).mapInArrow(cut, SCHEMA)
    # Every reader takes whole rows, so that all share this exchange and texts are cut once.
    return cells.repartition(F.col("chunk")) if exchanged else cells


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A filter in Spark would be pushed below the exchange of the chunks, which could then not be shared.
    for batch in batches:
        yield batch.filter(pa.compute.not_equal(batch.column(1), DOCS))


def answered(pieces: DataFrame, answer: Callable[..., list[dict]], side: DataFrame | None = None, kinds: Mapping[str, pa.DataType] = KEYS) -> DataFrame:
    """``answer(part, tables)`` of every part's keys, a dict of columns for each table, as rows for the chunks that asked.

    With ``side`` (part and more) the rows of the part are a third argument. ``kinds`` are those of the keys.
    """
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("digest", pa.int64()), ("data", pa.binary())])

    def run(rows: pa.Table, *more: pa.Table) -> pa.Table:
        if not len(rows):
            return schema.empty_table()
        part = rows.column("part")[0].as_py()
        tables = answer(part, [pa.table(opened(d, kinds)) for d in rows.column("data").to_pylist()], *more)
        same = [flat(rows.column(c)) for c in ("chunk", "part", "digest")]
        return pa.table([*same, pa.array([sealed(t) for t in tables], pa.binary())], schema=schema)

    def pair(rows: pa.Table, more: pa.Table) -> pa.Table:
        return run(rows, more)

    def single(rows: pa.Table) -> pa.Table:
        return run(rows)

    keys = pieces.mapInArrow(_keys, SCHEMA).groupBy("part")
    return keys.applyInArrow(single, SCHEMA) if side is None else keys.cogroup(side.groupBy("part")).applyInArrow(pair, SCHEMA)


def summarised(pieces: DataFrame, summary: Callable[[int, list[pa.Table]], pa.Table], schema: str, kinds: Mapping[str, pa.DataType] = KEYS) -> DataFrame:
    """``summary(part, tables)`` of every part's keys."""

    def run(rows: pa.Table) -> pa.Table:
        return summary(rows.column("part")[0].as_py(), [pa.table(opened(d, kinds)) for d in rows.column("data").to_pylist()])

    return pieces.mapInArrow(_keys, SCHEMA).groupBy("part").applyInArrow(run, schema)


def totals(tables: list[pa.Table]) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
    """The distinct keys of a part, their counts in all, and the numbers of each table's keys among them."""
    keys = pa.concat_arrays([flat(t.column("key")) for t in tables]).dictionary_encode()
    numbers = keys.indices.to_numpy()
    counts = np.bincount(numbers, np.concatenate([t.column("count").to_numpy() for t in tables]), len(keys.dictionary)).astype(np.int64)
    ends = np.cumsum([len(t) for t in tables])
    return keys.dictionary, counts, np.split(numbers, ends[:-1])


def met(texts: pa.Table, answers: pa.Table, kinds: Mapping[str, pa.DataType]) -> tuple[pa.Table, list[int], list[pa.Table]]:
    """A chunk's documents, the parts it has keys of, and their answers in the order of its key numbers.

    Raises where the two sides stem from different readings of the chunk.
    """
    place = pa.compute.index(texts.column("part"), DOCS).as_py()
    docs, digest = unpacked(texts.column("data")[place].as_py()), texts.column("digest")[place].as_py()
    answers = answers.sort_by("part")
    tables = [pa.table(opened(d, kinds)) for d in answers.column("data").to_pylist()]
    if sum(map(len, tables)) != int(docs.schema.metadata[b"keys"]) or any(d != digest for d in answers.column("digest").to_pylist()):
        raise ValueError("a chunk was read anew in another order")
    return docs, answers.column("part").to_pylist(), tables


def reassembled(pieces: DataFrame, answers: DataFrame, finish: Callable[[pa.Table, pa.Table], pa.Table], schema: str, kinds: Mapping[str, pa.DataType]) -> DataFrame:
    """``finish(documents, answers)`` of every chunk; answers are in the order of the chunk's key numbers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, _, tables = met(left, right, kinds)
        return finish(docs, pa.concat_tables(tables).combine_chunks() if tables else pa.table({n: pa.array([], k) for n, k in kinds.items()}))

    return pieces.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def each_document(docs: pa.Table, name: str = "keys") -> Iterator[np.ndarray]:
    """The key numbers of every document."""
    column = flat(docs.column(name))
    numbers, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        yield numbers[start:end]
