"""Nearest neighbours by a block matrix join with quantised tiles.

Vectors are packed into blocks of int8 codes with their scales, norms and rounding errors. Query blocks
meet candidate blocks in tiles; one matrix product of the codes, exact in single precision, gives all inner
products with a bound on their quantisation error. Pairs whose upper bound is below the k-th best lower bound
of their query are dropped, at the end of a task first, then over all tasks; only those that are left fetch their
original vectors and are computed again in double precision. Of the candidates with equal vectors the k + 1 smallest
ids are enough: a list of k without the query's own id names no others.

Only codes travel to the tiles. Query blocks are dealt to as many shares as keep the cores busy, and a task takes a
share through all candidate blocks. While there are fewer query blocks than that, candidate blocks are dealt to
groups as well. So the pairs of a query that leave the tiles do not grow with the table. A stated query set against
all rows in blocks is the method; ``BLOCK_ROWS`` x ``QUERY_ROWS`` bounds a tile.

The search is exact: bounds hold for every pair. Defined cases: vectors that are null, empty, zero, or hold null
or non-finite components take no part, nor do rows without an id. Only vectors of equal length are compared. All
different vectors of a repeated id are candidates, and queries if the id is one; an id is found once per
query, with its best score, and never for itself. Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from parceltide.llm import common

K = 20
QUERY_EVERY = 20
BLOCK_ROWS = 2048
QUERY_ROWS = 512
LEVELS = 127
EXACT_DIMS = (1 << 24) // LEVELS ** 2  # products of so many codes add up exactly in single precision
HELD = 1 << 21  # pairs that a task keeps at most until it has seen all its candidates

_PARTS = ("rows", "ids", "codes", "scale", "error", "norm")
BLOCK_SCHEMA = "dim int, " + ", ".join(f"{name} binary" for name in _PARTS)
_PAIRS = "q_row bigint, query_id bigint, c_row bigint, vec_id bigint, low double, high double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as array of double): usable vectors, each of an id once."""
    values = F.col("embedding").cast("array<double>")
    good = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(
        "embedding", lambda x: x != 0.0)
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), values.alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(good).distinct()
    )


def quantised(rows: list[int], ids: list[int], exact: np.ndarray) -> list[bytes]:
    """The parts of a block, sorted by id: row numbers, ids, int8 codes, scales, norms of the rounding errors and
    of the vectors."""
    order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
    exact = exact[order]
    scale = np.abs(exact).max(axis=1) / LEVELS
    scale[scale == 0] = 1.0  # too small to be divided
    codes = np.rint(exact / scale[:, None])
    error = exact - codes * scale[:, None]
    # A little above the computed norms, so that rounding cannot turn a bound into a non-bound.
    norms = [np.sqrt((x * x).sum(axis=1)) * (1 + 1e-9) for x in (error, exact)]
    return [x.tobytes() for x in (np.array(rows, dtype=np.int64)[order], np.array(ids, dtype=np.int64)[order],
                                  codes.astype(np.int8), scale, *norms)]


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors (row, vec_id, embedding) packed and quantised, ``rows`` to a block at most; blocks do not cross
    partitions."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, int, np.ndarray]]] = defaultdict(list)

        def block(dim: int) -> pa.RecordBatch:
            numbers, ids, taken = zip(*waiting.pop(dim), strict=True)
            parts = quantised(list(numbers), list(ids), np.stack(taken))
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), *(pa.array([x], pa.binary()) for x in parts)], ["dim", *_PARTS])

        for batch in batches:
            lists = batch.column(2)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for i, (row, vec_id) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                vector = flat[ends[i]:ends[i + 1]]
                waiting[len(vector)].append((row, vec_id, vector))
                if len(waiting[len(vector)]) == rows:
                    yield block(len(vector))
        for dim in list(waiting):
            yield block(dim)

    return vectors.select("row", "vec_id", "embedding").mapInArrow(pack, BLOCK_SCHEMA)


class Block:
    """A block read back from its parts."""

    def __init__(self, dim: int, rows: bytes, ids: bytes, codes: bytes, scale: bytes, error: bytes, norm: bytes):
        self.rows, self.ids = (np.frombuffer(x, dtype=np.int64) for x in (rows, ids))
        self.codes = np.frombuffer(codes, dtype=np.int8).reshape(-1, dim)
        self.scale, self.error, self.norm = (np.frombuffer(x, dtype=np.float64) for x in (scale, error, norm))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of int8 codes: single precision adds those of ``EXACT_DIMS`` components exactly."""
    out = np.zeros((len(q), len(c)))
    for at in range(0, q.shape[1], EXACT_DIMS):
        part = slice(at, at + EXACT_DIMS)
        out += q[:, part].astype(np.float32) @ c[:, part].astype(np.float32).T
    return out


def bounds(q: Block, c: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of two blocks."""
    near = products(q.codes, c.codes) * q.scale[:, None] * c.scale[None, :]
    # |<x,y> - <x',y'>| <= |x-x'| |y| + |x'| |y-y'| and |x'| <= |x| + |x-x'|
    apart = q.error[:, None] * c.norm[None, :] + (q.norm + q.error)[:, None] * c.error[None, :]
    apart += 1e-9 * (q.norm[:, None] * c.norm[None, :])
    # Where products overflow nothing is known.
    return np.nan_to_num(near - apart, nan=-np.inf, posinf=-np.inf, neginf=-np.inf), np.nan_to_num(
        near + apart, nan=np.inf, posinf=np.inf, neginf=np.inf)


class Floors:
    """Per query of a block the k best lower bounds of different ids so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.best: list[dict[int, float]] = [{} for _ in range(queries)]
        self.floor = np.full(queries, -np.inf)

    def take(self, low: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The floors after a tile with lower bounds ``low``; equal ids lie next to each other."""
        starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        by_id = low if len(starts) == len(ids) else np.maximum.reduceat(low, starts, axis=1)
        names, k = ids[starts], min(self.k, by_id.shape[1])
        top = np.argpartition(by_id, by_id.shape[1] - k, axis=1)[:, by_id.shape[1] - k:]
        values = np.take_along_axis(by_id, top, axis=1)
        for i in np.flatnonzero(values.max(axis=1) > self.floor).tolist():
            best = self.best[i]
            for vec_id, value in zip(names[top[i]].tolist(), values[i].tolist(), strict=True):
                if value > best.get(vec_id, -np.inf):
                    best[vec_id] = value
            if len(best) >= self.k:
                kept = sorted(best.items(), key=lambda x: -x[1])[:self.k]
                self.best[i], self.floor[i] = dict(kept), kept[-1][1]
        return self.floor


class Kept:
    """The pairs of one query block that may still be among the nearest, see ``_PAIRS``."""

    def __init__(self, queries: int, k: int):
        self.floors = Floors(queries, k)
        self.parts: list[tuple[np.ndarray, list[np.ndarray]]] = []
        self.size = 0

    def take(self, q: Block, c: Block) -> None:
        low, high = bounds(q, c)
        own = q.ids[:, None] == c.ids[None, :]
        low[own], high[own] = -np.inf, -np.inf
        floor = self.floors.take(low, c.ids)
        at, to = np.nonzero((high >= floor[:, None]) & ~own)
        self.parts.append((at, [q.rows[at], q.ids[at], c.rows[to], c.ids[to], low[at, to], high[at, to]]))
        self.size += len(at)

    def prune(self) -> None:
        """Drop what the floors have risen above since it was taken."""
        if self.parts:
            at = np.concatenate([a for a, _ in self.parts])
            pairs = [np.concatenate(x) for x in zip(*(p for _, p in self.parts), strict=True)]
            left = pairs[-1] >= self.floors.floor[at]
            self.parts = [(at[left], [x[left] for x in pairs])]
            self.size = int(left.sum())

    def pop(self) -> pa.RecordBatch:
        self.prune()
        pairs, self.parts, self.size = self.parts[0][1], [], 0
        return pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], [f.split()[0] for f in _PAIRS.split(", ")])


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, Kept] = {}
        for batch in batches:
            for row in batch.to_pylist():
                q = Block(row["dim"], *(row[f"q_{name}"] for name in _PARTS))
                c = Block(row["dim"], *(row[name] for name in _PARTS))
                kept.setdefault(row["q"], Kept(len(q.ids), k)).take(q, c)
            for held in kept.values():
                held.prune()
            if sum(held.size for held in kept.values()) > HELD:  # pairs leave early rather than fill the memory
                yield from (held.pop() for held in kept.values() if held.size)
        yield from (held.pop() for held in kept.values() if held.size)

    return run


def grid(queries: DataFrame, candidates: DataFrame, groups: int, shares: int = 1) -> DataFrame:
    """Every query block next to every candidate block of its length, dealt by share of the query blocks and by
    candidate group. Candidate blocks are the streamed side, so a task goes through them once."""
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    share = F.pmod("part", F.lit(shares)) if "part" in queries.columns else F.lit(0)
    sent = queries.withColumn("q", F.monotonically_increasing_id()).withColumn("share", share).withColumn(
        "g", numbers(groups))
    sent = sent.select("dim", "share", "g", "q", *[F.col(c).alias(f"q_{c}") for c in _PARTS])
    dealt = candidates.withColumn("g", F.pmod(F.xxhash64("rows"), F.lit(groups)).cast("int")).withColumn(
        "share", numbers(shares))
    return dealt.join(sent.hint("merge"), ["dim", "share", "g"])


def smallest_of_equals(rows: DataFrame, n: int) -> DataFrame:
    """Of the rows with one vector the ``n`` smallest ids."""
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    return rows.withColumn("nth", nth).filter(F.col("nth") <= n).drop("nth")


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest candidates per query."""
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(common.ARROW_ROWS))
    rows = common.written(usable(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    candidates = common.written(blocks(smallest_of_equals(rows, k + 1), BLOCK_ROWS), "vector-blocks")
    asked = rows.filter(is_query)
    queries = common.written(blocks(asked.repartition(max(1, -(-asked.count() // QUERY_ROWS))), QUERY_ROWS).withColumn(
        "part", F.spark_partition_id()), "query-blocks")
    # Each candidate group keeps its own k best of a query, so there is more than one only where shares are few.
    tasks = 2 * spark.sparkContext.defaultParallelism
    shares = max(1, min(queries.count(), tasks))
    groups = max(1, min(candidates.count(), -(-tasks // shares)))
    # Each task that sees a part of a group keeps its own k best as well, so groups are not split.
    split = "spark.sql.adaptive.skewJoin.enabled"
    before = spark.conf.get(split)
    spark.conf.set(split, "false")
    try:
        pairs = common.written(grid(queries, candidates, groups, shares).mapInArrow(_tiles(k), _PAIRS), "near-pairs")
    finally:
        spark.conf.set(split, before)
    # Over all tasks: the k-th best lower bound of different ids is a floor for the upper bounds.
    ranked = pairs.groupBy("query_id", "vec_id").agg(F.max("low").alias("low")).withColumn(
        "nth", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low"))))
    floor = ranked.filter(F.col("nth") == k).select("query_id", F.col("low").alias("floor"))
    left = pairs.join(floor, "query_id", "left").filter(F.col("floor").isNull() | (F.col("high") >= F.col("floor")))
    side = lambda n: rows.select(F.col("row").alias(f"{n}_row"), F.col("embedding").alias(f"{n}_vector"))
    exact = left.select("q_row", "query_id", "c_row", "vec_id").join(side("q"), "q_row").join(side("c"), "c_row")
    # Components are added in order, one after the other.
    score = F.aggregate(F.zip_with("q_vector", "c_vector", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    best = exact.select("query_id", "vec_id", score.alias("score")).groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(list_dot_product(q.e, c.e)) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e) GROUP BY ALL)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""
