"""Exact top-k inner products: the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from objsync.llm.common import stored

# Vectors of one block, at most, and queries that travel together.
BLOCK_ROWS = 1 << 17
QUERY_ROWS = 256

MATCH = "query_id long, vec_id long, score long"
EXACT = 2.0**53


def scaled(vector: Column, factor: int = 64) -> Column:
    """floor(factor * component) as whole doubles; null where the vector or a component is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: _floor(x.cast("double") * F.lit(float(factor))))
    return F.when(finite, whole)


def _floor(value: Column) -> Column:
    """floor as a double: beyond 2**53 a double is whole already."""
    return F.when(F.abs(value) < F.lit(EXACT), F.floor(value).cast("double")).otherwise(value)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` candidates of ``vectors`` with the highest inner product for each query.

    Both have ``vec_id`` and ``vector``, an array of whole doubles. Result: ``query_id``,
    ``rank`` (from 1), ``vec_id``, ``score``; equal scores go to the smaller id; a query
    with fewer candidates returns all. Rows with the query's own id are no candidates
    for it. Rows with a null id or vector take no part; a shorter vector counts as
    padded with zeros; a query id that repeats is asked once, with its smallest
    vector; repeated candidates each take a rank. Scores beyond the range of a long
    are cut to it before they are ranked. Empty tables give no rows; other columns are ignored.

    Vectors are dealt by a hash over blocks, about a quarter of the root of their
    number and at most ``BLOCK_ROWS`` each, and every query visits every block in a
    bundle of ``QUERY_ROWS``; no row of either side is held whole anywhere. A block
    keeps a list per dimension, sorted, read from both ends in growing steps. A row
    is scored when it first shows up in a list, and a query leaves the block as soon
    as no unseen row can reach its k-th score: that bound is the inner product with
    the components where the lists stand.
    """
    rows = stored(vectors.filter("vec_id is not null and vector is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), "vector"), "vectors")
    asked = queries.filter("vec_id is not null and vector is not null").groupBy(
        F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("vector").alias("vector"))
    total, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).head()
    blocks = max(1, math.ceil(math.sqrt(total) / 4), -(-total // BLOCK_ROWS))

    def bundle(batches):
        for batch in batches:
            ids, grid = batch.column("vec_id").to_numpy(), _grid(batch.column("vector"), width)
            for at in range(0, len(ids), QUERY_ROWS):
                part = slice(at, at + QUERY_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[part].tobytes()]), pa.array([grid[part].tobytes()])], ["ids", "grid"])

    bundles = asked.mapInArrow(bundle, "ids binary, grid binary").select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
        F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<double>").alias("vector"), "ids", "grid")
    dealt = rows.select(
        F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id",
        "vector", F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("grid"))

    def search(batches):
        block, ids, grids, lists = None, [], [], None
        for batch in batches:
            names, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(names) != 0) | (np.diff(kinds) != 0)) + 1
            for first, last in zip([0, *edges], [*edges, len(names)], strict=True):
                if first == last:
                    continue
                part = batch.slice(first, last - first)
                if names[first] != block:
                    block, ids, grids, lists = names[first], [], [], None
                if kinds[first] == 0:
                    ids.append(part.column("vec_id").to_numpy())
                    grids.append(_grid(part.column("vector"), width))
                    continue
                if not ids:
                    continue
                if lists is None:
                    lists = _Block(np.concatenate(ids), np.concatenate(grids))
                for own, grid in zip(part.column("ids").to_pylist(), part.column("grid").to_pylist(), strict=True):
                    asking = np.frombuffer(own, dtype=np.int64)
                    found = lists.best(asking, np.frombuffer(grid).reshape(len(asking), width), k)
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in found],
                                                     ["query_id", "vec_id", "score"])

    near = dealt.unionByName(bundles).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(search, MATCH)
    turn = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", turn).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _grid(column: pa.Array, width: int) -> np.ndarray:
    """A column of vectors as a matrix, short vectors padded with zeros."""
    values, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    sizes = np.diff(ends)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


class _Block:
    """The sorted lists of a block and its rows in the order in which the lists show them."""

    def __init__(self, ids: np.ndarray, grid: np.ndarray):
        rows, width = grid.shape
        order = np.argsort(grid, axis=0, kind="stable")
        place = np.empty((rows, width), dtype=np.int32)
        np.put_along_axis(place, order, np.arange(rows, dtype=np.int32)[:, None], axis=0)
        # The step at which a row first shows up, read from both ends of every list.
        shown = np.minimum(place, rows - 1 - place).min(axis=1) if width else np.zeros(rows, dtype=np.int32)
        turn = np.argsort(shown, kind="stable")
        self.ids, self.grid, self.shown = ids[turn], grid[turn], shown[turn]
        self.low = np.take_along_axis(grid, order, axis=0)
        self.largest = float(np.abs(grid).max(initial=0))

    def best(self, asking: np.ndarray, grid: np.ndarray, k: int) -> tuple[list, list, list]:
        """Query ids, row ids and scores of the k best rows of the block for each query."""
        rows, width = self.grid.shape
        exact = self.largest * float(np.abs(grid).max(initial=0)) * max(1, width) < EXACT
        product = (lambda a, b: a @ b.T) if exact else _big_product
        up, down = np.maximum(grid, 0), np.minimum(grid, 0)
        active = np.arange(len(asking))
        kept = [(np.empty(0, np.int64), np.empty(0, np.int64 if exact else object)) for _ in asking]
        step, seen = 0, 0
        while len(active) and seen < rows:
            step = step * 2 if step else 4
            upto = int(np.searchsorted(self.shown, step, side="left"))
            scores = product(grid[active], self.grid[seen:upto])
            scores = scores.astype(np.int64) if exact else _in_range(scores)
            for number, line in zip(active, scores, strict=True):
                kept[number] = self._merged(kept[number], line, seen, upto, asking[number], k)
            seen = upto
            if seen < rows:
                # Every unseen row lies between the places where the two ends of each list stand.
                bound = product(up[active], self.low[rows - 1 - step][None, :]) + product(down[active], self.low[step][None, :])
                bound = bound if exact else _in_range(bound)
                kth = [kept[n][1][k - 1] if len(kept[n][1]) >= k else None for n in active]
                stays = [last is None or not limit < last for limit, last in zip(bound[:, 0], kth, strict=True)]
                active = active[np.array(stays, dtype=bool)]
        out = ([], [], [])
        for query, (at, score) in zip(asking.tolist(), kept, strict=True):
            out[0].extend([query] * len(at))
            out[1].extend(self.ids[at].tolist())
            out[2].extend(map(int, score))
        return out

    def _merged(self, held, line, first: int, last: int, own: int, k: int):
        at = np.arange(first, last)
        other = self.ids[first:last] != own
        if len(held[1]) >= k:
            other &= (line >= held[1][k - 1]).astype(bool)
        at, score = np.concatenate([held[0], at[other]]), np.concatenate([held[1], line[other]])
        if len(score) > 4 * k and score.dtype != object:
            # Rows below the k-th score are out; ties with it still stand.
            high = score >= np.partition(score, len(score) - k)[len(score) - k]
            at, score = at[high], score[high]
        order = sorted(range(len(score)), key=lambda i: (-score[i], self.ids[at[i]])) if score.dtype == object else np.lexsort(
            (self.ids[at], -score))
        order = np.asarray(order[:k], dtype=np.int64)
        return at[order], score[order]


def _in_range(scores: np.ndarray) -> np.ndarray:
    """Python integers cut to the range of a long."""
    return np.minimum(np.maximum(scores, -(1 << 63)), (1 << 63) - 1) if scores.size else scores


def _big_product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products as Python integers, for components beyond what a double sums exactly."""
    whole = np.frompyfunc(int, 1, 1)
    return whole(left).dot(whole(right).T) if left.size and right.size else np.zeros((len(left), len(right)), dtype=object)
