"""Exact top-k inner products over whole-number vectors.

Vectors are rotated to the axes of their second moments, so that the first few carry most of every product, and read
from long to short. A query's k-th best score so far rules out all vectors too short to reach it, and then those whose
first products, plus the Cauchy-Schwarz bound on the rest, fall short. What remains is multiplied in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetworks.llm.frames import named
from fleetworks.session import scratch_dir, settle

SCALE, TOP = 1024, 10
#: Queries and vectors multiplied at once by a task.
BLOCK, LANES = 1024, 2048
#: Queries of one pass over the vectors: what the driver and a task hold of them.
PASS_BYTES = 16 << 20
#: Rotated axes whose products are added before each test.
STEPS = (8, 24)
#: Vectors that set the first thresholds: the longest ones of each dimension.
LONGEST = 2048


def whole_vectors(table: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v, norm, dims): floor(scale * x) of every component, without vectors that are null, empty or not finite."""
    x = named(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # 2 ** 62 keeps the cast from overflowing; products of such sizes fail instead of being wrong
    return (
        table.where(x.isNotNull() & (F.size(x) > 0) & finite)
        .select(named(key).cast("bigint").alias("id"),
                F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))
        .withColumn("dims", F.size("v"))
    )


def _moments(vectors: DataFrame, dims: int) -> np.ndarray:
    """The dims x dims sum of outer products. Tasks send one matrix each, and Spark adds them cell by cell."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            v = _matrix(batch.column(0), dims).astype(float)
            total += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["cell", "x"])

    cells = vectors.select("v").mapInArrow(add, "cell bigint, x double").groupBy("cell").agg(F.sum("x").alias("x"))
    out = np.zeros(dims * dims)
    for row in cells.collect():  # dims * dims rows
        out[row["cell"]] = row["x"]
    return out.reshape(dims, dims)


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class Piece:
    """Some vectors, rotated when a block first asks for it."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, norm: np.ndarray, axes: np.ndarray):
        self.ids, self.v, self.norm, self.axes = ids, v, norm, axes

    @cached_property
    def turned(self) -> np.ndarray:
        return self.v @ self.axes

    @cached_property
    def rest(self) -> list[np.ndarray]:
        return [np.sqrt((self.turned[:, n:] ** 2).sum(1)) for n in STEPS]


def pieces(ids: np.ndarray, v: np.ndarray, norm: np.ndarray, axes: np.ndarray) -> list[Piece]:
    """The vectors in pieces, longest first."""
    order = np.argsort(-norm, kind="stable")
    picks = [order[at:at + LANES] for at in range(0, len(order), LANES)]
    return [Piece(ids[p], v[p], norm[p], axes) for p in picks]


class Block:
    """Queries of one block with their best rows so far."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, axes: np.ndarray, top: int, floor: np.ndarray | None = None):
        self.ids, self.v, self.top = ids, v, top
        self.turned = v @ axes
        self.norm = np.sqrt((self.turned ** 2).sum(1))
        self.rest = [np.sqrt((self.turned[:, n:] ** 2).sum(1)) for n in STEPS]
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor.astype(float)
        self.best = np.empty((0, 3), np.int64)  # query's place, score, id
        self.limit = float(np.abs(v).max(initial=0)) * v.shape[1]

    def read(self, found: list[Piece]) -> None:
        """Take in vectors, longest first."""
        for piece in found:
            if not (self.norm * piece.norm[0] * (1 + 1e-9) >= self.floor).any():
                return  # all that follow are shorter still
            if self.limit * float(np.abs(piece.v).max(initial=0)) >= 2 ** 62:
                raise OverflowError("a product may not fit 64 bits")
            self._multiply(piece)

    def _multiply(self, piece: Piece) -> None:
        lengths = self.norm[:, None] * piece.norm[None, :]
        floor = self.floor[:, None] - (1e-9 * lengths + 1e-6)  # rounding of the rotation
        near = lengths >= floor
        partial, seen = np.zeros(near.shape), 0
        for step, mine, theirs in zip(STEPS, self.rest, piece.rest):
            partial += self.turned[:, seen:step] @ piece.turned[:, seen:step].T
            seen = step
            near &= partial + mine[:, None] * theirs[None, :] >= floor
        near &= self.ids[:, None] != piece.ids[None, :]
        q, c = np.nonzero(near)
        for at in range(0, len(q), 1 << 16):
            a, b = q[at:at + (1 << 16)], c[at:at + (1 << 16)]
            self.add(a, np.einsum("ij,ij->i", self.v[a], piece.v[b]), piece.ids[b])

    def add(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Keep the ``top`` best of old and new rows, ties to the smaller id, and raise the floors."""
        hit = score >= self.floor[place]
        rows = np.concatenate([self.best, np.stack([place[hit], score[hit], ids[hit]], axis=1)])
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], rows[:, 0])
        rank = np.arange(len(rows)) - first
        self.best = rows[rank < self.top]
        last = rows[rank == self.top - 1]
        self.floor[last[:, 0]] = np.maximum(self.floor[last[:, 0]], last[:, 1])


def _search(vectors: DataFrame, shared, dims: int) -> DataFrame:
    """(query_id, score, id): the best rows of each task for each query of the shared blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, top, asked = shared.value
        blocks = [Block(ids, v, axes, top, floor) for ids, v, floor in asked]
        for batch in batches:
            found = pieces(batch.column(0).to_numpy(), _matrix(batch.column(1), dims), batch.column(2).to_numpy(), axes)
            for block in blocks:
                block.read(found)
        for block in blocks:
            place, score, ids = block.best.T
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (block.ids[place], score, ids)], names=["query_id", "score", "id"])

    return vectors.select("id", "v", "norm").mapInArrow(run, "query_id bigint, score bigint, id bigint")


def _best(found: DataFrame, top: int) -> DataFrame:
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)


def _passes(queries: DataFrame, dims: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Blocks of ids and vectors, as many at a time as ``PASS_BYTES`` hold, one at least."""
    most = max(1, PASS_BYTES // (8 * dims * BLOCK))
    blocks, held = [], []

    def block():
        return np.array([i for i, _ in held]), np.array([x for _, x in held], np.int64)

    for row in queries.select("id", "v").toLocalIterator():
        held.append((row["id"], row["v"]))
        if len(held) == BLOCK:
            blocks.append(block())
            held = []
            if len(blocks) == most:
                yield blocks
                blocks = []
    if held:
        blocks.append(block())
    if blocks:
        yield blocks


def top_products(table: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 top: int = TOP, scale: int = SCALE) -> DataFrame:
    """The ``top`` rows of ``table`` with the largest inner product for each row of ``queries``.

    Returns query_id, rank (from 1), vec_id and score, a whole number: products of floor(scale * x). Ties go to the
    smaller id. A row whose id is the query's is never its answer; a query has fewer rows if there are fewer candidates.
    Vectors that are null, empty or hold null or non-finite components take no part, and vectors of other dimensions
    never meet. Repeated rows are candidates each; a query id given more than once is searched for once, with its
    smallest vector. Queries pass the driver ``PASS_BYTES`` at a time, and every pass is one job over all vectors.
    """
    spark = table.sparkSession
    vectors = settle(
        whole_vectors(table, key, vector, scale).where("id is not null").repartitionByRange(F.desc("norm"), "id"), "vectors")
    asked = whole_vectors(queries, key, vector, scale).where("id is not null").groupBy("id").agg(
        F.min(F.struct("dims", "v")).alias("_q")).select("id", "_q.dims", "_q.v")
    asked = settle(asked, "asked")
    parts = []
    for (dims,) in asked.select("dims").distinct().orderBy("dims").toLocalIterator():
        here = vectors.where(F.col("dims") == dims)
        axes = np.linalg.svd(_moments(here, dims))[0]
        # the longest vectors give every query a first threshold; they are read again with the rest
        long = here.orderBy(F.desc("norm"), "id").limit(LONGEST).select("id", "v", "norm").collect()
        first = pieces(np.array([r[0] for r in long]), np.array([r[1] for r in long], np.int64), np.array([r[2] for r in long]), axes)
        for blocks in _passes(asked.where(F.col("dims") == dims), dims):
            started = []
            for ids, v in blocks:
                start = Block(ids, v, axes, top)
                start.read(first)
                started.append((ids, v, start.floor))
            shared = spark.sparkContext.broadcast((axes, top, started))
            parts.append(scratch_dir(spark, "products"))
            _best(_search(here, shared, dims), top).write.parquet(parts[-1])
            shared.unpersist()
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    found = spark.read.schema("query_id bigint, rank int, id bigint, score bigint").parquet(*parts)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
