"""Approximate nearest neighbours by cosine: stable projections in a kd-tree, and a chi-square test that says when to stop.

Vectors are brought to length one, where the largest cosine is the smallest distance, and projected with a Gaussian
matrix to ``PROJECTED`` dimensions. For a pair at distance ``d`` the squared projected distance over ``d`` squared is
chi-square distributed with that many degrees of freedom. Each block of rows keeps its projections in a kd-tree. A
query takes the leaves of a tree in order of their projected distance and verifies their points on the original
vectors, until a point nearer than the worst of its best k, lying further out in the projection, would have less than
``1 - CONFIDENCE`` of probability.

Blocks and queries are stored and moved as single rows, blocks in the order of their trees. A task reads the rows of a
block, then the queries sent to it one batch after the other, so that it holds one block and one batch at a time, however
many queries or blocks there are.

A coarse kd-tree over the projections, whose cuts come from a sample of at most ``SAMPLE`` rows, deals every row to one of
at most ``CELLS`` cells; a cell holds as many blocks as its rows need, whatever they are, so a vector that fills a cell
with its copies is spread over tasks. A query first searches one block of its own cell, which gives the limit of the
test; then it goes to all blocks of those cells only whose box lies within the limit. Nothing is left out: a query
without a limit, one whose first block holds too few rows, goes everywhere. Ranks follow from the exact cosine in
double precision, ties from the smaller id. Lengths of vectors are few: each has cells of its own.

* null vectors, zero vectors and vectors with a null or non-finite component take no part, nor do rows with a null id;
* vectors of another length: compared only among themselves;
* repeated ids: rows with the id of the query are its own and never its neighbours; repeated rows of other ids count
  as rows; a repeated query row is answered once;
* fewer candidates than k: all of them; empty tables: no rows; other columns: not looked at.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskbook.llm.common import stored

PROJECTED = 12
CONFIDENCE = 0.97
LEAF = 64
LEAVES_AT_ONCE = 8
# Squared projected distances up to this are rounding: exact copies are always verified.
NEARLY_EQUAL = 1e-12
BLOCK = 8192
SAMPLE = 65_536
CELLS = 4096
# Rows of the sample behind each cell, at least.
ROWS_PER_CELL = 16


def chi_square_quantile(p: float, freedom: int) -> float:
    """By bisection of the closed form for an even number of degrees of freedom."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def projection(dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, PROJECTED))


def build_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the points in a kd-tree, leaf by leaf, and where leaves begin and the last one ends."""
    open_, leaves = [np.arange(len(points))], []
    while open_:
        node = open_.pop()
        if len(node) <= LEAF:
            leaves.append(node)
            continue
        axis = int(np.ptp(points[node], axis=0).argmax())
        half = len(node) // 2
        cut = np.argpartition(points[node, axis], half)
        open_ += [node[cut[half:]], node[cut[:half]]]
    return np.concatenate(leaves), np.concatenate([[0], np.cumsum([len(x) for x in leaves])])


def _usable(batch: pa.RecordBatch):
    """Of the rows that take part, by length of the vectors: their places in the batch, ids and vectors."""
    ids, column = batch.column(0), batch.column(1)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    taken = pc.is_valid(ids).to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths[taken & (lengths > 0)]):
        rows = pa.array(np.flatnonzero(taken & (lengths == dim)))
        values = pc.list_flatten(column.take(rows)).to_numpy(zero_copy_only=False)  # a null becomes NaN
        vectors = values.reshape(len(rows), int(dim)).astype(np.float64)
        good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
        rows = rows.filter(pa.array(good))
        yield int(dim), rows, ids.take(rows).to_numpy(), _safe(vectors[good])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of one length, without nulls, as rows of a matrix."""
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def _safe(vectors: np.ndarray) -> np.ndarray:
    """Vectors whose squared length is a normal number: others are scaled, which no cosine notices."""
    with np.errstate(over="ignore"):
        squares = (vectors * vectors).sum(axis=1)
    odd = ~np.isfinite(squares) | (squares < 1e-280)
    if odd.any():
        vectors = vectors.copy()
        vectors[odd] /= np.abs(vectors[odd]).max(axis=1, keepdims=True)
    return vectors


def _projected(vectors: np.ndarray, seed: int) -> np.ndarray:
    return (vectors / _lengths(vectors)[:, None]) @ projection(vectors.shape[1], seed)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def limit_of(score: float, stop: float) -> float:
    """The squared projected distance beyond which a row as near as ``score`` would have too little probability."""
    return max(NEARLY_EQUAL, stop * max(0.0, 2 - 2 * score))


class Cuts:
    """A balanced kd-tree of cuts: node ``n`` has the children ``2n+1`` and ``2n+2``, the last level's are the cells."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.depth = max(0, min(cells, len(sample) // ROWS_PER_CELL) - 1).bit_length()
        inner = (1 << self.depth) - 1
        self.axis, self.at = np.zeros(inner, dtype=np.int64), np.zeros(inner)
        nodes = {0: sample}
        for n in range(inner):
            points = nodes.pop(n)
            if len(points):
                self.axis[n] = np.ptp(points, axis=0).argmax()
                self.at[n] = np.median(points[:, self.axis[n]])
            right = points[:, self.axis[n]] >= self.at[n]
            nodes[2 * n + 1], nodes[2 * n + 2] = points[~right], points[right]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.at[node])
        return node - ((1 << self.depth) - 1)


class Block:
    """Rows with their kd-tree."""

    def __init__(self, ids, vectors, points, leaves):
        self.ids, self.vectors, self.points, self.leaves = ids, vectors, points, leaves
        self.lengths = _lengths(vectors)
        self.low = np.minimum.reduceat(points, leaves[:-1], axis=0)
        self.high = np.maximum.reduceat(points, leaves[:-1], axis=0)

    def nearest(self, id_: int, vector: np.ndarray, point: np.ndarray, k: int, stop: float, limit: float = np.inf):
        """Ids and cosines of the best k rows found for a query, best first. ``limit`` is the squared projected distance
        that is known to be enough from elsewhere."""
        outside = np.maximum(0, np.maximum(self.low - point, point - self.high))
        nearness = (outside * outside).sum(axis=1)
        order = np.argsort(nearness, kind="stable")
        length = _lengths(vector[None, :])[0]
        ids, scores = np.empty(0, dtype=np.int64), np.empty(0)
        for at in range(0, len(order), LEAVES_AT_ONCE):
            # limit: the chi-square test, for a point as near as the worst of the best k.
            if nearness[order[at]] > limit:
                break
            chosen = [np.arange(self.leaves[x], self.leaves[x + 1]) for x in order[at : at + LEAVES_AT_ONCE]]
            rows = np.concatenate(chosen)
            away = self.points[rows] - point
            rows = rows[((away * away).sum(axis=1) <= limit) & (self.ids[rows] != id_)]
            found = (self.vectors[rows] * vector).sum(axis=1) / (self.lengths[rows] * length)
            if len(scores) == k:
                better = found >= scores[-1]
                rows, found = rows[better], found[better]
            ids, scores = np.concatenate([ids, self.ids[rows]]), np.concatenate([scores, found])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(scores) == k:
                limit = min(limit, limit_of(scores[-1], stop))
        return ids, scores


def _cuts(df: DataFrame, rows: int, seed: int) -> dict[int, Cuts]:
    """The cuts of each length of vectors, from the projections of at most ``SAMPLE`` rows."""

    def run(batches):
        for batch in batches:
            for dim, _, ids, vectors in _usable(batch):
                arrays = [pa.array(np.full(len(ids), dim)), pa.array([p.tobytes() for p in _projected(vectors, seed)], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["dim", "point"])

    share = min(1.0, 0.9 * SAMPLE / max(1, rows))
    drawn = df.where(F.pmod(F.xxhash64(*df.columns, F.lit(seed)), F.lit(1 << 40)) < int(share * (1 << 40)))
    found = drawn.mapInArrow(run, "dim long, point binary").limit(SAMPLE).toArrow()
    dims = found["dim"].to_numpy()
    points = np.frombuffer(b"".join(found["point"].to_pylist())).reshape(-1, PROJECTED)
    cells = min(CELLS, -(-rows // BLOCK))
    return {int(dim): Cuts(points[dims == dim], cells) for dim in np.unique(dims)}


def _cells(cuts: dict[int, Cuts], dim: int, points: np.ndarray) -> np.ndarray:
    """A length that the sample did not meet has one cell."""
    return cuts[dim].cells(points) if dim in cuts else np.zeros(len(points), dtype=np.int64)


def _routed(df: DataFrame, cuts: dict[int, Cuts], seed: int) -> DataFrame:
    """The rows that take part, with their cell; vectors as they are given."""

    def run(batches):
        for batch in batches:
            for dim, rows, ids, vectors in _usable(batch):
                cells = _cells(cuts, dim, _projected(vectors, seed))
                arrays = [pa.array(np.full(len(ids), dim)), pa.array(cells), *[c.take(rows) for c in batch.columns]]
                yield pa.RecordBatch.from_arrays(arrays, names=["dim", "cell", "id", "vector"])

    return df.mapInArrow(run, f"dim long, cell long, id long, vector {df.schema['vector'].dataType.simpleString()}")


def build_index(routed: DataFrame, slots: DataFrame, tasks: int, seed: int = 0) -> DataFrame:
    """The rows of a block per slot in the order of its tree, each with its ``leaf`` and its projection, ``point``; vectors
    as they are given."""

    def run(batches):
        held, slot = [], None

        def block():
            ids, vectors = (np.concatenate(x) for x in list(zip(*held))[:2])
            given = pa.concat_arrays([x for _, _, x in held])
            held.clear()
            points = _projected(vectors, seed)
            order, leaves = build_tree(points)
            ends = pa.array(np.arange(0, (len(order) + 1) * PROJECTED, PROJECTED, dtype=np.int32))
            arrays = [
                *[pa.array(np.full(len(order), x)) for x in slot],
                pa.array(np.repeat(np.arange(len(leaves) - 1), np.diff(leaves))),
                pa.array(ids[order]),
                given.take(pa.array(order)),
                pa.ListArray.from_arrays(ends, pa.array(points[order].reshape(-1))),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["slot", "dim", "cell", "leaf", "id", "vector", "point"])

        for batch in batches:
            places = np.stack([batch.column(k).to_numpy() for k in (2, 3, 4)], axis=1)
            starts = np.flatnonzero(np.r_[True, (places[1:, 0] != places[:-1, 0])]) if len(places) else []
            for start, end in zip(starts, [*starts[1:], len(places)]):
                if held and slot[0] != places[start, 0]:
                    yield block()
                slot = [int(x) for x in places[start]]
                part = batch.slice(start, end - start)
                for _, rows, ids, vectors in _usable(part):
                    held.append((ids, vectors, part.column(1).take(rows)))
        if held:
            yield block()

    # Rows of a cell are dealt over its slots by their place in the stored table, so that copies part too.
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("parts"))
    dealt = routed.join(F.broadcast(slots), ["dim", "cell"]).withColumn("slot", (F.col("first") + part).cast("int"))
    rows = dealt.select("id", "vector", "slot", "dim", "cell").repartitionById(tasks, F.col("slot")).sortWithinPartitions("slot")
    kind = routed.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"slot long, dim long, cell long, leaf long, id long, vector {kind}, point array<double>"
    )


def _home(queries: DataFrame, cuts: dict[int, Cuts], first: dict, seed: int) -> DataFrame:
    """Queries with the first slot of their own cell."""

    def run(batches):
        for batch in batches:
            for dim, rows, ids, vectors in _usable(batch):
                cells = _cells(cuts, dim, _projected(vectors, seed))
                own, at = np.unique(cells, return_inverse=True)
                slots = np.array([first[dim, int(cell)][0] for cell in own], dtype=np.int64)[at]
                arrays = [
                    pa.array(slots), pa.array(np.full(len(ids), dim)), pa.array(ids), batch.column(1).take(rows),
                    pa.array(np.full(len(ids), np.inf)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["slot", "dim", "id", "vector", "limit"])

    kind = queries.schema["vector"].dataType.simpleString()
    return queries.mapInArrow(run, f"slot long, dim long, id long, vector {kind}, limit double")


def _met(index: DataFrame, queries: DataFrame, tasks: int, seed: int, k: int, stop: float):
    """The rows of each block and behind them the queries of its slot; what a task does with queries is for ``searched``."""
    nothing = F.lit(None).cast("array<double>")
    blocks = index.select("slot", F.lit(0).alias("turn"), "leaf", "dim", "id", "vector", "point", F.lit(0.0).alias("limit"))
    asking = queries.select(
        "slot", F.lit(1).alias("turn"), F.lit(0).cast("long").alias("leaf"), "dim", "id", "vector", nothing.alias("point"), "limit"
    )
    # Slots are dense numbers, so they go to tasks one by one, not by a hash that puts several in one task.
    met = blocks.union(asking).repartitionById(tasks, F.col("slot").cast("int")).sortWithinPartitions("slot", "turn", "leaf")

    def block_of(held: list[pa.RecordBatch], dim: int) -> Block:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        leaf = rows.column("leaf").to_numpy()
        leaves = np.r_[np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]]), len(leaf)]
        vectors, points = _safe(_matrix(rows.column("vector"), dim)), _matrix(rows.column("point"), PROJECTED)
        return Block(rows.column("id").to_numpy(), vectors, points, leaves)

    def searched(batches):
        """For queries of a batch that go to one block: their rows, vectors and what is found for each."""
        slot, held, block = None, [], None
        for batch in batches:
            places = np.stack([batch.column(c).to_numpy() for c in ("slot", "turn")], axis=1)
            starts = np.flatnonzero(np.r_[True, (places[1:] != places[:-1]).any(axis=1)]) if len(places) else []
            for start, end in zip(starts, [*starts[1:], len(places)]):
                part = batch.slice(start, end - start)
                if slot != places[start, 0]:
                    slot, held, block = places[start, 0], [], None
                if places[start, 1] == 0:
                    held.append(part)
                    continue
                dim = part.column("dim")[0].as_py()
                if block is None:
                    held, block = [], block_of(held, dim)
                vectors = _safe(_matrix(part.column("vector"), dim))
                asked, limits = part.column("id").to_numpy(), part.column("limit").to_numpy()
                found = [
                    block.nearest(*x, k, stop, limit)
                    for *x, limit in zip(asked, vectors, _projected(vectors, seed), limits)
                ]
                yield dim, part, vectors, found

    return met, searched


def _boxes(index: DataFrame) -> dict[int, list]:
    """The box of each cell, by length of the vectors: a row per cell."""
    sides = [side(F.col("point")[i]) for side in (F.min, F.max) for i in range(PROJECTED)]
    out: dict[int, list] = {}
    for row in index.groupBy("dim", "cell").agg(*sides).collect():
        out.setdefault(row[0], []).append((row[1], np.array(row[2 : 2 + PROJECTED]), np.array(row[2 + PROJECTED :])))
    return out


def search(
    df: DataFrame, is_query: Column, k: int, seed: int = 0, vector: str = "embedding", id_col: str = "vec_id"
) -> DataFrame:
    """The ``k`` nearest rows found for each row of ``df`` where ``is_query`` holds: ``query_id``, ``rank`` from 1,
    ``vec_id`` and ``score``, the cosine."""
    spark = df.sparkSession
    slim = [F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector")]
    rows, queries = df.select(*slim), df.where(is_query).select(*slim).dropDuplicates()
    cuts = _cuts(rows, df.count(), seed)
    routed = stored(_routed(rows, cuts, seed), "cells")
    # A row per cell. Slots are numbered one after the other.
    sizes = sorted(map(tuple, routed.groupBy("dim", "cell").count().collect()))
    first, slots = {}, 0
    for dim, cell, count in sizes:
        first[dim, cell] = (slots, -(-count // BLOCK))
        slots += first[dim, cell][1]
    tasks = max(1, min(slots, max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    places = spark.createDataFrame([(*key, *value) for key, value in first.items()], "dim long, cell long, first long, parts long")
    index = stored(build_index(routed, places, tasks, seed), "vectors")
    boxes, stop = _boxes(index), chi_square_quantile(CONFIDENCE, PROJECTED)

    at_home, searched = _met(index, _home(queries, cuts, first, seed), tasks, seed, k, stop)

    def go_on(batches):
        """Queries with the limit found at home, for each cell within it."""
        names = ["first", "parts", "dim", "id", "vector", "limit"]
        for dim, asked, vectors, found in searched(batches):
            limits = np.array([limit_of(scores[-1], stop) if len(scores) == k else np.inf for _, scores in found])
            points = _projected(vectors, seed)
            for cell, low, high in boxes[dim]:
                outside = np.maximum(0, np.maximum(low - points, points - high))
                near = (outside * outside).sum(axis=1) <= limits
                if near.any():
                    rows = pa.array(np.flatnonzero(near))
                    place = [pa.array(np.full(len(rows), x)) for x in (*first[dim, cell], dim)]
                    given = [asked.column(c).take(rows) for c in ("id", "vector")]
                    yield pa.RecordBatch.from_arrays([*place, *given, pa.array(limits[near])], names=names)

    kind = rows.schema["vector"].dataType.simpleString()
    sent = at_home.mapInArrow(go_on, f"first long, parts long, dim long, id long, vector {kind}, limit double")
    sent = sent.withColumn("slot", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)))
    everywhere, searched_on = _met(index, sent, tasks, seed, k, stop)

    def report(batches):
        for _, asked, vectors, found in searched_on(batches):
            held = [len(ids) for ids, _ in found]
            marks = np.array([zlib.crc32(v.tobytes()) for v in vectors], dtype=np.int64)
            arrays = [
                pa.array(np.repeat(asked.column("id").to_numpy(), held)),
                pa.array(np.repeat(marks, held)),
                pa.array(np.concatenate([ids for ids, _ in found])),
                pa.array(np.concatenate([scores for _, scores in found])),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "mark", "vec_id", "score"])

    found = everywhere.mapInArrow(report, "query_id long, mark long, vec_id long, score double")
    # The mark tells two vectors with one query id apart.
    best = W.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
