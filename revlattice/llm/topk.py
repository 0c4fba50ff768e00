"""Exact top-k inner products by the threshold algorithm.

Candidates are dealt into cells by their nearest pivot, cells into blocks. A cell is outlined by the least and greatest value of
each dimension and by the distance of its farthest vector from the pivot; both bound the score of a query in it. A query meets
a block of its best-bounded cell first. Its kth score there is a floor for the whole search: the query goes on only to cells
whose bound reaches the floor.

A block keeps one sorted list per dimension and reads all lists in step from both ends (one end serves queries that are positive
in the dimension, the other those that are negative). Vectors met for the first time are scored at once; the frontier of the
lists bounds every vector not met yet, and a query stops as soon as the bound is below its floor or its kth score. Blocks are
merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.llm.common import groups_for, written

BLOCK, QUERY_BLOCK = 8192, 4096
#: At most so many cells, whatever the input; they only steer the search.
PIVOTS = 256
SCHEMA = "query_id long, vec_id long, score long"
NONE = -(1 << 62)


def integers(vector: Column | str, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a double; null where the vector or a component is null or not finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    unfit = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(column.isNotNull() & ~unfit, F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=np.float64)
    for i, row in enumerate(column.to_pylist()):
        out[i, : len(row)] = row
    return out


def _better(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row: higher score first, then smaller id."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def threshold_search(
    queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best vectors for every query, padded with the least integer; none below the query's floor."""
    n, width = vectors.shape
    best = np.full((len(queries), k), NONE, dtype=np.int64)
    best_ids = np.zeros((len(queries), k), dtype=np.int64)
    order = np.argsort(vectors, axis=0, kind="stable")
    lists = np.take_along_axis(vectors, order, 0)
    met = np.zeros(n, dtype=bool)
    active = np.arange(len(queries))
    depth = 0
    while depth < n and len(active):
        reach = min(n, max(64, depth * 4))
        fresh = np.unique(np.concatenate((order[depth:reach].ravel(), order[n - reach : n - depth].ravel())))
        fresh = fresh[~met[fresh]]
        met[fresh] = True
        depth = reach
        if len(fresh):
            for start in range(0, len(active), 256):
                some = active[start : start + 256]
                scores = (queries[some] @ vectors[fresh].T).astype(np.int64)
                scores[query_ids[some, None] == ids[None, fresh]] = NONE
                hit = scores >= np.maximum(best[some, -1], floors[some])[:, None]
                hit &= scores > NONE
                for row in np.flatnonzero(hit.any(axis=1)):
                    at = np.flatnonzero(hit[row])
                    if len(at) > 4 * k:
                        least = np.partition(scores[row, at], len(at) - k)[len(at) - k]
                        at = at[scores[row, at] >= least]
                    pair = np.concatenate((best[some[row]], scores[row, at]))[None], np.concatenate((best_ids[some[row]], ids[fresh[at]]))[None]
                    top, top_ids = _better(*pair, k)
                    best[some[row]], best_ids[some[row]] = top[0], top_ids[0]
        if depth < n:
            low, high = lists[depth - 1], lists[n - depth]
            bound = np.maximum(queries[active] * low, queries[active] * high).sum(axis=1)
            active = active[bound >= np.maximum(best[active, -1], floors[active])]
    return best, best_ids


class Cells(NamedTuple):
    """Outlines of the cells that hold vectors, by place: number, pivot, rows, least and greatest values, farthest distance."""

    number: np.ndarray
    pivot: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    far: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Score that no vector of a cell exceeds, by query and cell: the lesser of the bounds by box and by ball."""
        box = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        length = np.sqrt((queries**2).sum(axis=1))[:, None]
        # Distances are rounded; boxes are whole numbers.
        ball = queries @ self.pivot.T + length * self.far * (1 + 1e-9) + 1
        return np.minimum(box, ball)


def in_cells(vectors: DataFrame, width: int, pivots: int) -> tuple[DataFrame, Cells]:
    """Every vector with the number of its cell, and the cells' outlines: a row for each of at most ``pivots`` cells on the driver."""
    chosen = vectors.orderBy(F.xxhash64("vector", "vec_id"), "vec_id").limit(pivots).select("vector").toArrow()
    heads = np.unique(_matrix(chosen.column("vector"), width), axis=0)
    half = (heads**2).sum(axis=1) / 2

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            near = np.argmin(half - _matrix(rows.column("vector"), width) @ heads.T, axis=1)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(near, pa.int32())], names=["vec_id", "vector", "cell"])

    dealt = written(vectors.select("vec_id", "vector").mapInArrow(assign, "vec_id long, vector array<long>, cell int"), "cells")

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, far = np.zeros(len(heads), dtype=np.int64), np.zeros(len(heads))
        low, high = np.full(heads.shape, np.inf), np.full(heads.shape, -np.inf)
        for batch in batches:
            values, cell = _matrix(batch.column("vector"), width), batch.column("cell").to_numpy()
            np.add.at(rows, cell, 1)
            np.minimum.at(low, cell, values)
            np.maximum.at(high, cell, values)
            np.maximum.at(far, cell, np.sqrt(((values - heads[cell]) ** 2).sum(axis=1)))
        at = np.flatnonzero(rows)
        columns = [pa.array(at, pa.int32()), pa.array(rows[at]), pa.array(list(low[at]), pa.list_(pa.float64())), pa.array(list(high[at]), pa.list_(pa.float64())), pa.array(far[at])]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "rows", "low", "high", "far"])

    def joined(parts: pa.Table) -> pa.Table:
        low, high = (f(np.array(parts.column(c).to_pylist()), axis=0) for f, c in ((np.min, "low"), (np.max, "high")))
        return pa.table(
            [parts.column("cell")[:1], pa.array([pc.sum(parts.column("rows")).as_py()]), pa.array([list(low)]), pa.array([list(high)]), pa.array([pc.max(parts.column("far")).as_py()])],
            names=parts.column_names,
        )

    shape = "cell int, rows long, low array<double>, high array<double>, far double"
    lines = dealt.mapInArrow(outline, shape).groupBy("cell").applyInArrow(joined, shape).toArrow().sort_by("cell")
    number = lines.column("cell").to_numpy()
    low, high = (_matrix(lines.column(c), width) for c in ("low", "high"))
    return dealt, Cells(number, heads[number], lines.column("rows").to_numpy(), low, high, lines.column("far").to_numpy())


def reached(queries: DataFrame, cells: Cells, best_only: bool = False) -> DataFrame:
    """A row per query (vec_id, vector, floor) and cell whose bound reaches the floor; ``best_only``: the best-bounded cell alone."""
    width = cells.pivot.shape[1]

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            bounds = cells.bounds(_matrix(rows.column("vector"), width))
            if best_only:
                query, cell = np.arange(len(bounds)), bounds.argmax(axis=1)
            else:
                query, cell = np.nonzero(bounds >= rows.column("floor").to_numpy()[:, None])
            # A query may go to every cell: some rows at a time.
            for start in range(0, len(query), 4096):
                some = slice(start, start + 4096)
                taken = rows.take(pa.array(query[some]))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells.number[cell[some]], pa.int32())], names=["vec_id", "vector", "floor", "cell"])

    return queries.select("vec_id", "vector", "floor").mapInArrow(reach, "vec_id long, vector array<long>, floor long, cell int")


def _by_cell(numbers: dict[int, int]) -> Column:
    """The number of the row's cell, 0 where it has none; there are at most as many as pivots."""
    table = F.array(*(F.lit(numbers.get(c, 0)).cast("long") for c in range(max(numbers, default=0) + 1)))
    return F.coalesce(F.get(table, F.col("cell")), F.lit(0))


def _searched(dealt: DataFrame, asked: DataFrame, loads: dict[int, int], width: int, k: int, query_block: int) -> DataFrame:
    """The k best of each (block, query) of ``asked``; a block is repeated as its cell's load of queries a block demands."""
    slices = _by_cell({c: groups_for(n, query_block) for c, n in loads.items()})
    vectors = dealt.withColumn("slices", slices).where("slices > 0").select(
        F.lit(False).alias("asks"), "vec_id", "vector", F.lit(NONE).alias("floor"), "cell", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice")
    )
    queries = asked.select(
        F.lit(True).alias("asks"), "vec_id", "vector", "floor", "cell", "block", F.pmod(F.xxhash64("vec_id", F.lit("q")), slices).alias("slice")
    )

    def search(rows: pa.Table) -> pa.Table:
        asks = rows.column("asks")
        left, right = rows.filter(asks), rows.filter(pc.invert(asks))
        found = []
        if len(left) and len(right):
            query_ids = left.column("vec_id").to_numpy()
            sides = _matrix(left.column("vector"), width), query_ids, left.column("floor").to_numpy(), _matrix(right.column("vector"), width)
            scores, ids = threshold_search(*sides, right.column("vec_id").to_numpy(), k)
            there = scores > NONE
            found = [np.repeat(query_ids, there.sum(axis=1)), ids[there], scores[there]]
        return pa.table(found or [[], [], []], schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    return vectors.unionByName(queries).groupBy("cell", "block", "slice").applyInArrow(search, SCHEMA)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _loads(asked: DataFrame) -> dict[int, int]:
    return {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, query_block: int = QUERY_BLOCK, pivots: int = PIVOTS
) -> DataFrame:
    """The ``k`` best vectors of every query: query_id, rank, vec_id, score.

    Both inputs are (vec_id long, vector array<long>); rows with a null id or vector take no part, and a query never
    meets rows of its own id. Ties go to the smaller id, repeated candidates count one by one, queries that share an id are
    one (the least vector), shorter vectors are filled with zeros. An empty side gives no rows. Cells are at most ``pivots``
    and one for every 512 vectors; their number changes the work, never the result.
    """
    vectors = vectors.dropna(subset=["vec_id", "vector"]).select("vec_id", "vector")
    queries = queries.dropna(subset=["vec_id", "vector"]).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    held, widest = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    asked_width = queries.agg(F.max(F.size("vector"))).first()[0]
    if not held or asked_width is None:
        return _ranked(vectors.sparkSession.createDataFrame([], SCHEMA), k)
    width = max(1, widest, asked_width)
    dealt, cells = in_cells(vectors, width, min(pivots, groups_for(held, 512)))
    blocks = {int(c): groups_for(int(n), block) for c, n in zip(cells.number, cells.rows, strict=True)}
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), _by_cell(blocks)))

    at_home = F.pmod(F.xxhash64("vec_id", F.lit("home")), _by_cell(blocks))
    homes = reached(queries.withColumn("floor", F.lit(NONE)), cells, best_only=True).withColumn("block", at_home)
    loads = {c: groups_for(n, blocks[c]) for c, n in _loads(homes).items()}
    first = written(_searched(dealt, homes, loads, width, k, query_block), "first")

    floors = _ranked(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    asked = queries.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(NONE)))
    onward = reached(asked, cells).withColumn("home", at_home)
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), _by_cell(blocks) - 1))
    visited = homes.select("vec_id", F.col("cell").alias("home_cell"))
    rest = (
        onward.join(visited, "vec_id")
        .select("vec_id", "vector", "floor", "cell", "home", "home_cell", everywhere.alias("block"))
        .where((F.col("cell") != F.col("home_cell")) | (F.col("block") != F.col("home")))
    )
    further = _searched(dealt, rest, _loads(onward), width, k, query_block)
    return _ranked(first.unionByName(further), k)
