"""Byte-level BPE: every distinct pre-token of the corpus is encoded once, texts are reassembled by position."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.llm import chunks
from revlattice.llm.common import small_batches


def read_ranks(path: str) -> bytes:
    """A rank file as it is; its size is that of the vocabulary, not of the corpus."""
    with open(path, "rb") as file:
        return file.read()


def token_bytes(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}


def _encoder(ranks: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=token_bytes(ranks), special_tokens={})


def _shared(docs: DataFrame, ranks: bytes) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(ranks)


def encode(docs: DataFrame, ranks: bytes, pattern: str, parts: int | None = None, chunk_chars: int = chunks.CHUNK_CHARS) -> DataFrame:
    """(doc_id, ids) for every row of ``docs`` (doc_id, text): what the rank file's tokenizer gives, no special tokens.

    Null and empty texts give no ids. Each match of ``pattern`` is a word that is encoded separately, and once for all
    its places in the corpus. A null or repeated doc_id is kept row by row. No rows give no rows.
    """
    shared = _shared(docs, ranks)

    def words(text: str) -> list[str]:
        import regex

        return regex.findall(pattern, text)

    def answer(part: int, tables: list[pa.Table]) -> list[dict]:
        encoder = _encoder(shared.value, pattern)
        known: dict[bytes, list[int]] = {}
        out = []
        for table in tables:
            lists = []
            for key in table.column("key").to_pylist():
                if key not in known:
                    known[key] = encoder.encode_ordinary(key.decode("utf-8", "surrogatepass"))
                lists.append(known[key])
            out.append({"ids": pa.array(lists, pa.list_(pa.int32()))})
        return out

    def finish(documents: pa.Table, answers: pa.Table) -> pa.Table:
        lists, words = chunks.flat(answers.column("ids")), chunks.flat(documents.column("keys"))
        ids, starts = lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        sequence, borders = words.values.to_numpy(), words.offsets.to_numpy()
        values, begins = _gathered(ids, starts, sequence)
        return pa.table({"doc_id": chunks.flat(documents.column("doc_id")), "ids": pa.ListArray.from_arrays(pa.array(begins[borders], pa.int32()), pa.array(values))})

    rows = docs.select("doc_id", "text", F.lit(False).alias("learn"))
    pieces = chunks.chunked(rows, chunks.by_token(words), parts or chunks.part_count(docs), chunk_chars)
    return chunks.reassembled(pieces, chunks.answered(pieces, answer), finish, "doc_id long, ids array<int>", {"ids": pa.list_(pa.int32())})


def _gathered(values: np.ndarray, starts: np.ndarray, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``values`` between ``starts`` in the order of ``sequence``, one after another, and where each begins."""
    begins = np.zeros(len(sequence) + 1, dtype=np.int64)
    out, piece = [], 1 << 18
    for at in range(0, len(sequence), piece):
        some = sequence[at : at + piece]
        width = starts[some + 1] - starts[some]
        ends = np.cumsum(width)
        begins[at + 1 : at + 1 + len(some)] = begins[at] + ends
        out.append(values[np.repeat(starts[some] - ends + width, width) + np.arange(ends[-1])])
    return np.concatenate(out) if out else values[:0], begins


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``: the bytes of the ids in turn, by a lookup in the token-byte table.

    The table is shipped whole, as it has one row per vocabulary entry. Null or empty ids give no bytes; an id that the
    table lacks raises.
    """
    small_batches(encoded.sparkSession)
    shared = _shared(encoded, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {rank: token for token, rank in token_bytes(shared.value).items()}
        tokens = [table.get(rank, b"") for rank in range(max(table) + 1)] if table else []
        starts = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
        held, missing = np.frombuffer(b"".join(tokens), dtype=np.uint8), np.array([rank not in table for rank in range(len(tokens))], dtype=bool)
        for batch in batches:
            ids = batch.column(1)
            sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(ids), 0), dtype=np.int64)
            sequence = ids.flatten().to_numpy()
            if len(sequence) and (sequence.min() < 0 or sequence.max() >= len(tokens) or missing[sequence].any()):
                raise ValueError("an id has no entry in the token-byte table")
            values, begins = _gathered(held, starts, sequence)
            offsets = begins[np.concatenate(([0], np.cumsum(sizes)))]
            decoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, decoded.cast(pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
