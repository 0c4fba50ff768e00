"""Exact deduplication against immutable snapshots.

A snapshot is a table of exact buckets (digest, kept row, size) with one static binary-fuse filter per shard of digests. A
batch is grouped by digest on its own, screened by the filters, and only the digests that a filter may know meet the
exact buckets. The texts of every group are then compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.llm.common import BLANKS, groups_for, remainder, written

SHARD_KEYS = 100_000
FILTERS = "shard int, seed long, segment int, cells int, marks binary"


def normalised(text: Column | str) -> Column:
    """White space runs as one blank; a null text counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), BLANKS, " ")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass(frozen=True)
class FuseFilter:
    """8-bit binary-fuse filter: three cells in neighbouring segments xor to the mark of a key."""

    seed: int
    segment: int
    cells: int
    marks: np.ndarray

    @staticmethod
    def places(keys: np.ndarray, seed: int, segment: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
        hashed = _mix(keys ^ _mix(np.array([seed], dtype=np.uint64)))
        starts = np.uint64(cells // segment - 2)
        first = (hashed >> np.uint64(32)) * starts >> np.uint64(32)
        spots = [(first + np.uint64(i)) * np.uint64(segment) + (_mix(hashed + np.uint64(i + 1)) % np.uint64(segment)) for i in range(3)]
        return np.stack(spots).astype(np.int64), (_mix(hashed + np.uint64(9)) & np.uint64(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peels cells that hold one key only, all at once per round, and fills them in reverse."""
        keys = np.unique(keys)
        n = len(keys)
        segment = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
        for seed in range(1, 400):
            factor = 1.15 + 0.05 * (seed // 4) + (0.4 if n < 2000 else 0)
            cells = segment * max(3, int(np.ceil(n * factor / segment)) + 2)
            spots, mark = cls.places(keys, seed, segment, cells)
            count = np.bincount(spots.ravel(), minlength=cells)
            held = np.zeros(cells, dtype=np.int64)
            for row in spots:
                np.add.at(held, row, np.arange(n))
            rounds = []
            while len(single := np.flatnonzero(count == 1)):
                key, first = np.unique(held[single], return_index=True)
                rounds.append((key, single[first]))
                for row in spots[:, key]:
                    np.subtract.at(count, row, 1)
                    np.subtract.at(held, row, key)
            if sum(len(k) for k, _ in rounds) == n:
                marks = np.zeros(cells, dtype=np.uint8)
                for key, cell in reversed(rounds):
                    a, b, c = marks[spots[:, key]]
                    marks[cell] = mark[key] ^ a ^ b ^ c  # the cell itself is still zero
                return cls(seed, segment, cells, marks)
        raise RuntimeError(f"no filter for {n} keys")

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        spots, mark = self.places(keys, self.seed, self.segment, self.cells)
        a, b, c = self.marks[spots]
        return (a ^ b ^ c) == mark


def _sharded(frame: DataFrame, shards: int) -> DataFrame:
    return frame.withColumn("key", F.xxhash64("digest")).withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))


@dataclass(frozen=True)
class Snapshot:
    """Exact buckets (digest, keep_id, members) and one filter for each of ``shards`` shards."""

    buckets: DataFrame
    filters: DataFrame
    shards: int


def by_digest(rows: DataFrame) -> DataFrame:
    """One row per digest of (doc_id, digest): the smallest id and the number of rows."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("members"))


def take_snapshot(rows: DataFrame, shard_keys: int = SHARD_KEYS) -> Snapshot:
    """An immutable snapshot of (doc_id, digest); shards hold about ``shard_keys`` digests however large it is."""
    buckets = written(by_digest(rows), "buckets")
    shards = groups_for(buckets.count(), shard_keys)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(group["key"].to_numpy().view(np.uint64))
        return pd.DataFrame([(group["shard"].iloc[0], made.seed, made.segment, made.cells, made.marks.tobytes())], columns=["shard", "seed", "segment", "cells", "marks"])

    keyed = _sharded(buckets.select("digest"), shards).select("shard", "key")
    return Snapshot(buckets, written(keyed.groupBy("shard").applyInPandas(build, FILTERS), "filters"), shards)


def screened(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """``batch`` (one row per digest) with ``known``: may the snapshot hold the digest? Never false for one it holds."""
    schema = "digest binary, keep_id long, members long, known boolean"
    keyed = _sharded(batch, snapshot.shards)

    def screen(group: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        known = np.zeros(len(group), dtype=bool)
        for f in filters.itertuples():
            known = FuseFilter(f.seed, f.segment, f.cells, np.frombuffer(f.marks, dtype=np.uint8)).may_hold(group["key"].to_numpy().view(np.uint64))
        return group[["digest", "keep_id", "members"]].assign(known=known)

    return keyed.groupBy("shard").cogroup(snapshot.filters.groupBy("shard")).applyInPandas(screen, schema)


def merged(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Buckets of the snapshot and the batch together: digest, keep_id, members."""
    seen = written(screened(by_digest(batch), snapshot), "screened")
    met = seen.filter("known").select("digest", F.col("keep_id").alias("other"), F.col("members").alias("more"))
    joined = snapshot.buckets.join(met, "digest", "left").select(
        "digest", F.least("keep_id", "other").alias("keep_id"), (F.col("members") + F.coalesce("more", F.lit(0))).alias("members")
    )
    false_hits = seen.filter("known").join(snapshot.buckets, "digest", "left_anti")
    new = seen.filter("not known").unionByName(false_hits).select("digest", "keep_id", "members")
    return joined.unionByName(new)


def differing_texts(docs: DataFrame, rows: DataFrame, buckets: DataFrame) -> int:
    """How many digests of several rows stand for texts that differ in a byte."""
    shared = rows.join(buckets.filter("members > 1").select("digest"), "digest", "left_semi").select("doc_id", "digest")
    # By digest too: rows that repeat an id may hold another text.
    known = docs.select("doc_id", normalised("text").alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = known.join(shared.hint("shuffle_hash"), ["doc_id", "digest"]).select("digest", "text")
    return texts.groupBy("digest", "text").agg(F.lit(1).alias("one")).groupBy("digest").count().filter("count > 1").count()


def exact_duplicates(docs: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are equal after white space runs became one blank; a null text equals an empty one.
    Of equal texts the smallest doc_id stays. Half of the rows, chosen by the id's checksum, are the snapshot, the others
    arrive as a batch. Rows that repeat a doc_id count one by one and share the verdict of their id; a null doc_id is
    never kept beside other ids (a group of null ids only has a null keep_id and keeps all). No rows give no rows.
    Raises if two different texts share a SHA-256.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    digest = F.unhex(F.sha2(normalised("text"), 256))
    rows = written(docs.select("doc_id", digest.alias("digest"), (remainder("doc_id", 2) == 0).alias("old")), "digests")
    snapshot = take_snapshot(rows.filter("old").select("doc_id", "digest"), shard_keys)
    buckets = written(merged(rows.filter("not old").select("doc_id", "digest"), snapshot), "merged")
    if differing := differing_texts(docs, rows, buckets):
        raise ValueError(f"{differing} digests stand for different texts")
    return rows.join(buckets, "digest").select(
        "doc_id",
        "keep_id",
        F.col("members").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
