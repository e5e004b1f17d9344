"""Uniform sharding by a hypergeometric communication matrix.

Rows are dealt to logical partitions by a hash of their content. For each partition and shard the
number of rows that move is drawn from the multivariate hypergeometric law a uniform permutation
would give, so shard sizes are exact before any row moves. Each partition is permuted locally and
cut by its counts, the rows are exchanged, and each shard is permuted again.

Rows are permuted by sorting on seeded hashes. The second permutation is spread over ``cells`` of
the hash range whose sizes become offsets, so no task holds a shard. The driver sees counts only:
one number per partition and per cell.

Nulls: a null text has size 16 and the checksum of the empty text; a null id is an id like any
other. Rows equal in every column that is hashed are interchangeable. An empty table gives no rows.
Input columns named like an output column are not carried over.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from parceltide.llm import common

SHARDS = 40
SEED = 20260
PARTITION_ROWS = 100_000  # aimed rows of a logical partition; the driver keeps `shards` counts for each
LEAST_PARTITIONS = 64
OWN_COLUMNS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows of partition p (axis 0) that go to shard s (axis 1). Column sums differ by at most one."""
    total = int(sum(rows))
    left = np.full(shards, total // shards, dtype=np.int64)
    left[: total % shards] += 1
    rng = np.random.Generator(np.random.PCG64(seed))
    matrix = np.zeros((len(rows), shards), dtype=np.int64)
    for p, n in enumerate(rows):
        matrix[p] = rng.multivariate_hypergeometric(left, n, method="marginals") if n else 0
        left -= matrix[p]
    return matrix


def _key(seed: int, *more: Column) -> Column:
    return F.xxhash64(F.lit(seed), *more)


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
               partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """Every column of ``docs`` with ``shard`` and ``slot``; needs ``doc_id`` and ``text``."""
    spark = docs.sparkSession
    identity = [F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))]
    rows = common.by_position(docs, "doc_id", "text")
    keyed = rows.withColumn("_k1", _key(seed, *identity)).withColumn("_k2", _key(seed + 1, *identity))
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in ("shard", "slot")]
    total = docs.count()
    parts = max(LEAST_PARTITIONS, -(-total // partition_rows))
    cells = max(1, -(-parts // shards))
    keyed = keyed.withColumn("_p", F.pmod(_key(seed + 2, F.col("_k1")), F.lit(parts)).cast("int"))
    counted = {r["_p"]: r["n"] for r in keyed.groupBy("_p").agg(F.count("*").alias("n")).collect()}
    matrix = communication_matrix([counted.get(p, 0) for p in range(parts)], shards, seed)
    ends = np.cumsum(matrix, axis=1)
    plan = spark.createDataFrame(
        [(p, ends[p].tolist()) for p in range(parts)], "_p int, _ends array<bigint>")
    place = F.row_number().over(Window.partitionBy("_p").orderBy("_k1", "_k2", "doc_id"))
    moved = (
        keyed.join(plan, "_p")
        .withColumn("_at", place)
        # Shards whose last place lies before this row: its shard's number.
        .withColumn("shard", F.size(F.filter("_ends", lambda e: e < F.col("_at"))))
        .withColumn("_k3", _key(seed + 3, F.col("_k2"), F.col("shard")))
        .withColumn("_cell", F.pmod(_key(seed + 4, F.col("_k3")), F.lit(cells)).cast("int"))
        .drop("_p", "_ends", "_at", "_k1", "text")
    )
    moved = common.written(moved, "sharding")
    cell = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = moved.groupBy("shard", "_cell").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(cell), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy("shard", "_cell").orderBy("_k3", "_k2", "doc_id"))
    return (
        moved.withColumn("_i", inside).join(offsets, ["shard", "_cell"])
        .withColumn("slot", F.col("_before") + F.col("_i") - 1)
        .select(*[F.col(f"_own_{i}") for i in kept], "shard", "slot").toDF(*[docs.columns[i] for i in kept], "shard", "slot")
    )


def digest(docs: DataFrame) -> DataFrame:
    """The rows without their texts: what the sharding of a table of contents needs."""
    text = common.text_or_empty()
    return docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"),
        F.sha2(text, 256).alias("text"),
    )


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(digest(common.table(spark, sf_dir, "documents")))
    return placed.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
