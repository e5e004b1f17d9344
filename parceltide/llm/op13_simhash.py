"""SimHash near-duplicates by a generalised pigeonhole.

Two fingerprints that differ in at most ``apart`` bits must, for any split of the bits into m parts with
thresholds that sum to apart - m + 1, differ in at most its threshold in one part. Bits that go together are
put into the same part, and the thresholds, -1 (part unused) and up, are chosen by dynamic programming over the
expected cost: index and probe entries plus candidates. How often two fingerprints agree in a part is counted
over all of them, how fast that grows with the threshold follows from the bits' shares. m is the cheapest of 2
to apart + 1.

A fingerprint is indexed in each used part under its own value and probes the values within the threshold. A
bucket is what meets on one value. Small buckets are compared pair by pair. In a large one all are compared with
one hub only; if that leaves several components, the bucket stays open. While open buckets hold many fingerprints
they are split again by the remaining bits into apart + 1 parts, of which a linked pair agrees in one. What few
fingerprints are left are compared in tiles, each of which gives a spanning forest of its links and no more, while
that is less work than their midpoints, else united by midpoints: two are linked if and only if some value is within
half of ``apart`` of both, so all that share one belong together. So a large group of near copies costs its size times
a constant, not its square, and no link between components is lost. Pairs that buckets propose are verified on the
whole fingerprints.

Equal fingerprints are one class throughout. Defined cases: a null or empty text and one without words has the
fingerprint zero, which links like any other; fewer words than a shingle are one shingle; a null doc_id names a
component only if no other id does; repeated rows get repeated results; an empty table gives no rows; columns
other than doc_id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from parceltide.llm import common
from parceltide.llm.components import components

BITS = 64
APART = 4
WORDS = 4
SEED = 42
SLICE = 1 << 16  # shingles hashed at once
PAIR_COST = 0.2  # of comparing two fingerprints, in entries
SMALL = 64  # members of a bucket that is compared pair by pair
TILED = 1 << 15  # open fingerprints up to which all are compared with all
TILE = 1 << 11  # fingerprints of one side of a tile, about
MIDPOINTS = 128  # values around open fingerprints, per fingerprint of the table, up to which they are listed


# --- fingerprints ----------------------------------------------------------------------------


def fingerprint(raw: bytes, words: int = WORDS) -> int:
    """Majority of the bits of all shingles' hashes, repeats included."""
    found = raw.lower().split()  # bytes split at exactly \x20 and \x09-\x0D
    if not found:
        return 0
    text = b" ".join(found)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:max(1, len(found) - words + 1)]
    ends = ends[min(words, len(found)) - 1:]
    ones, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_digest
    for at in range(0, len(starts), SLICE):
        hashes = b"".join([digest(text[a:b], SEED) for a, b in zip(
            starts[at:at + SLICE].tolist(), ends[at:at + SLICE].tolist(), strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, BITS // 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int("".join("1" if 2 * n > len(starts) else "0" for n in ones.tolist()), 2)


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed integer, per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint"), common.text_or_empty().cast("binary").alias("text"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signed(fingerprint(text.as_py(), words)) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return rows.mapInArrow(made, "doc_id bigint, fp bigint")


# --- parts and thresholds --------------------------------------------------------------------


class Part(NamedTuple):
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return mask_of(self.bits)

    def flips(self) -> list[int]:
        """What turns a fingerprint into each value within the threshold, the own one first."""
        return [mask_of(chosen) for r in range(self.threshold + 1) for chosen in combinations(self.bits, r)]


def mask_of(bits) -> int:
    return signed(sum(1 << b for b in bits))


def moments(classes: DataFrame) -> np.ndarray:
    """How many fingerprints have both of two bits, for all pairs of bits; one matrix a task."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(raw), SLICE):
                bits = np.unpackbits(raw[at:at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                having = np.packbits(bits, axis=0).T  # a bit set of fingerprints for each bit
                for b in range(BITS):
                    both[b] += np.bitwise_count(having & having[b]).sum(axis=1, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([both.ravel().tolist()])], ["both"])

    sums = classes.select("fp").mapInArrow(made, "both array<bigint>").select(F.posexplode("both")).groupBy(
        "pos").agg(F.sum("col").alias("n")).collect()  # 64 x 64 numbers
    out = np.zeros(BITS * BITS)  # an empty table has no sums
    for r in sums:
        out[r["pos"]] = r["n"]
    return out.reshape(BITS, BITS)


def correlated_groups(both: np.ndarray, total: int, m: int) -> list[tuple[int, ...]]:
    """m groups of about equal size; each starts with the bit that depends on the others most and takes those
    that go with it best."""
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.clip(share * (1 - share), 1e-12, None))
    tied = np.abs(both / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(tied, 0)
    left, groups = set(range(BITS)), []
    for g in range(m):
        size = -(-len(left) // (m - g))
        rest = sorted(left)
        group = [max(rest, key=lambda b: (tied[b, rest].sum(), -b))]
        while len(group) < size:
            group.append(max((b for b in rest if b not in group), key=lambda b: (tied[b, group].sum(), -b)))
        groups.append(tuple(sorted(group)))
        left -= set(group)
    return groups


def spread_of(group: tuple[int, ...], share: np.ndarray) -> np.ndarray:
    """Chance that two unrelated fingerprints differ in so many bits of the group."""
    out = np.ones(1)
    for b in group:
        q = 2 * share[b] * (1 - share[b])
        out = np.convolve(out, [1 - q, q])
    return out


def allocate(agreeing: list[float], groups: list[tuple[int, ...]], share: np.ndarray, total: int,
             apart: int) -> tuple[float, list[int]]:
    """Cost and thresholds of the cheapest allocation to ``groups``. ``agreeing`` are pairs that agree in a group."""
    options = []
    for pairs, group in zip(agreeing, groups, strict=True):
        near = np.cumsum(spread_of(group, share))
        costs, probes = {-1: 0.0}, 0
        for t in range(min(apart, len(group)) + 1):
            probes += comb(len(group), t)
            candidates = min(pairs * near[t] / max(near[0], 1e-300), total * total / 2)
            costs[t] = total * probes + PAIR_COST * candidates
        options.append(costs)
    best = {0: (0.0, [])}  # by the sum of thresholds + 1 so far
    for costs in options:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, more in costs.items():
                if used + t + 1 <= apart + 1 and (
                        used + t + 1 not in after or cost + more < after[used + t + 1][0]):
                    after[used + t + 1] = (cost + more, [*chosen, t])
        best = after
    return best[apart + 1]  # thresholds of m parts sum to apart - m + 1


def choose_parts(classes: DataFrame, total: int, apart: int = APART) -> list[Part]:
    total = max(total, 1)  # without a fingerprint every choice would cost nothing, the longest list of probes too
    both = moments(classes)
    share = np.diag(both) / max(total, 1)
    splits = {m: correlated_groups(both, total, m) for m in range(2, apart + 2)}
    named = [(m, i, mask_of(g)) for m, groups in splits.items() for i, g in enumerate(groups)]
    values = F.explode(F.array(*(
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(mask)).alias("v"))
        for m, i, mask in named)))
    counts = classes.select(values.alias("x")).groupBy("x.m", "x.i", "x.v").agg(F.count("*").alias("n"))
    pairs = {(r["m"], r["i"]): float(r["pairs"]) for r in counts.groupBy("m", "i").agg(
        F.sum(F.col("n") * (F.col("n") - 1.0) / 2).alias("pairs")).collect()}
    found = {m: allocate([pairs.get((m, i), 0.0) for i in range(m)], groups, share, total, apart)
             for m, groups in splits.items()}
    m = min(found, key=lambda m: found[m][0])
    return [Part(g, t) for g, t in zip(splits[m], found[m][1], strict=True) if t >= 0]


# --- buckets ---------------------------------------------------------------------------------


def first_buckets(classes: DataFrame, parts: list[Part]) -> DataFrame:
    """(bucket, fp, own, rest): ``own`` is false for probes, ``rest`` are the bits outside the part."""
    def entry(number: int, part: Part, k: int, flip: int) -> Column:
        value = F.col("fp").bitwiseXOR(F.lit(flip)).bitwiseAND(F.lit(part.mask))
        return F.struct(F.xxhash64(F.lit(number), value).alias("bucket"), F.lit(k == 0).alias("own"),
                        F.lit(~part.mask).alias("rest"))

    entries = [entry(i, part, k, flip) for i, part in enumerate(parts) for k, flip in enumerate(part.flips())]
    return classes.select("fp", F.explode(F.array(*entries)).alias("e")).select("e.bucket", "fp", "e.own", "e.rest")


def split_buckets(members: DataFrame, apart: int) -> DataFrame:
    """Buckets of ``members`` split by apart + 1 parts of the bits that are left."""
    schema = "bucket bigint, fp bigint, own boolean, rest bigint"

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, fp, rest = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1, 3))
            rests, which = np.unique(rest, return_inverse=True)
            for j in range(apart + 1):
                masks = np.array([sum(1 << b for b in [b for b in range(BITS) if int(r) >> b & 1][j::apart + 1])
                                  for r in rests], dtype=np.uint64)[which]
                with np.errstate(over="ignore"):
                    key = common.mix64(common.mix64(bucket + np.uint64(j + 1)) ^ (fp & masks))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), batch.column(1), batch.column(2),
                     pa.array((rest & ~masks).view(np.int64))], ["bucket", "fp", "own", "rest"])

    return members.select("bucket", "fp", "own", "rest").mapInArrow(made, schema)


def _near(x: str, y: str, apart: int) -> Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= apart


def links_within(sized: DataFrame, apart: int) -> DataFrame:
    """Links (a, b) of a table of buckets with their ``size`` and ``hub``: all of small buckets, those with
    the hub of large ones."""
    large = sized.filter((F.col("size") > SMALL) & (F.col("fp") != F.col("hub")) & _near("fp", "hub", apart))
    small = sized.filter(F.col("size") <= SMALL)
    a = small.filter("own").select("bucket", F.col("fp").alias("a"), F.col("component").alias("component_a"))
    b = small.select("bucket", F.col("fp").alias("b"), F.col("component").alias("component_b"))
    pairs = a.join(b, (a["bucket"] == b["bucket"]) & (F.col("a") != F.col("b"))
                   & (F.col("component_a") != F.col("component_b")) & _near("a", "b", apart))
    return large.select(F.col("hub").alias("a"), F.col("fp").alias("b")).union(pairs.select("a", "b")).distinct()


def forest(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Of the links from ``a`` to ``b`` as many as connect what all of them connect."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for x, y in zip(a, b, strict=True):
        one, other = find(x), find(y)
        if one != other:
            parent[one] = other
            kept.append((x, y))
    return kept


def tiled_links(members: DataFrame, count: int, apart: int) -> DataFrame:
    """Links (a, b) between the components of ``members(fp, component)``, ``count`` rows, that hold fingerprints within
    ``apart``: all are compared with all, and each tile gives no more links than connect its components."""
    sides = max(1, -(-count // TILE))
    side = F.pmod(F.xxhash64("fp"), F.lit(sides)).cast("int")
    dealt = members.select("fp", "component", side.alias("side"), F.explode(
        F.sequence(F.lit(0), F.lit(sides - 1))).alias("other")).select(
        "fp", "component", (F.col("side") <= F.col("other")).alias("low"), (F.col("side") >= F.col("other")).alias("high"),
        F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))

    def made(tile: pa.Table) -> pa.Table:
        fp = tile.column("fp").to_numpy().view(np.uint64)
        component = tile.column("component").to_numpy()
        low, high = (np.flatnonzero(tile.column(name).to_numpy()) for name in ("low", "high"))
        a, b = [], []
        for at in range(0, len(low), 256):
            some = low[at:at + 256]
            near = (np.bitwise_count(fp[some, None] ^ fp[high]) <= apart) & (component[some, None] != component[high])
            x, y = np.nonzero(near)
            found = np.unique(np.stack((component[some[x]], component[high[y]])), axis=1)
            kept = forest([*a, *found[0].tolist()], [*b, *found[1].tolist()])
            a, b = [x for x, _ in kept], [y for _, y in kept]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("i", "j").applyInArrow(made, "a bigint, b bigint").distinct()


def midpoint_links(members: DataFrame, apart: int) -> DataFrame:
    """Links (a, b) between the components of ``members(fp, component)`` that hold fingerprints within ``apart``, which
    is even. A value is within half of that of a bounded number of fingerprints."""
    masks = np.array([sum(1 << b for b in chosen) for r in range(apart // 2 + 1)
                      for chosen in combinations(range(BITS), r)], dtype=np.uint64)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                fp = some.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                middle = (fp[:, None] ^ masks).ravel().view(np.int64)
                component = np.repeat(some.column(1).to_numpy(zero_copy_only=False), len(masks))
                yield pa.RecordBatch.from_arrays([pa.array(middle), pa.array(component)], ["middle", "a"])

    around = members.select("fp", "component").mapInArrow(made, "middle bigint, a bigint")
    chain = Window.partitionBy("middle").orderBy("a")
    return around.withColumn("b", F.lag("a").over(chain)).filter("a <> b").select("a", "b").distinct()


def linked(classes: DataFrame, parts: list[Part], apart: int = APART) -> DataFrame:
    """(node, component) of every fingerprint that has a link."""
    named, total = None, classes.count()
    buckets = first_buckets(classes, parts)
    while True:
        buckets = common.written(buckets, "buckets")
        sizes = buckets.groupBy("bucket").agg(
            F.count("*").alias("size"), F.min(F.when(F.col("own"), F.col("fp"))).alias("hub"),
            F.min("fp").alias("low"), F.max("fp").alias("high")).filter(
            "hub IS NOT NULL AND low <> high").drop("low", "high")
        sized = buckets.join(sizes, "bucket")
        if named is None:
            sized = sized.withColumn("component", F.col("fp"))
        else:
            sized = sized.join(named.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
                "component", F.coalesce("component", "fp"))
        sized = common.written(sized, "sized-buckets")
        links = links_within(sized, apart)
        if named is not None:  # components so far, as stars
            links = links.union(named.filter("node <> component"))
        named = components(common.written(links, "near"))
        large = sized.filter(F.col("size") > SMALL).drop("component").join(
            named.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
            "component", F.coalesce("component", "fp"))
        several = large.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(
            "low <> high").select("bucket")
        open_buckets = common.written(large.join(several, "bucket").select(
            "bucket", "fp", "own", "rest", "component"), "open")
        left = open_buckets.select("fp", "component").distinct()
        count = left.count()
        if not count:
            return named
        if count <= TILED:
            links = tiled_links(left, count, apart).union(named.filter("node <> component"))
            return components(common.written(links, "near"))
        values = sum(comb(BITS, r) for r in range(apart // 2 + 1))
        if apart % 2 == 0 and count * values <= MIDPOINTS * total:
            links = midpoint_links(left, apart).union(named.filter("node <> component"))
            return components(common.written(links, "near"))
        buckets = split_buckets(open_buckets, apart)


def near_components(docs: DataFrame, words: int = WORDS, apart: int = APART) -> DataFrame:
    """doc_id, fingerprint and component_id, the smallest doc_id reachable by links, per row of ``docs``."""
    rows = common.written(fingerprints(docs, words), "fingerprints")
    classes = common.written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    named = linked(classes, choose_parts(classes, classes.count(), apart), apart)
    placed = classes.join(named.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = common.written(placed.join(least, "component").select("fp", "component_id"), "components")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(common.table(spark, sf_dir, "documents"))
