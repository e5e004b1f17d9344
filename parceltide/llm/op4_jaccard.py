"""Exact Jaccard join of shingle sets by partitioning the universe.

A ``Likeness`` states the words of a shingle and the percentage p at which two sets link, that is if
100 * intersection >= p * union. For a pair whose smaller set has s shingles the symmetric difference
then has at most s * (100 - p) / p. All bounds follow from p. The query takes three words and 90.
Sets are banded by size.
A band deals all shingles into segments by a hash; by the pigeonhole principle a linked pair agrees
in one of k + 1 segments, or differs by one shingle in a segment that is also indexed with one
deletion and so counts twice. How many segments get deletions is chosen per band by expected cost.

Below ``SEGMENTS_FROM`` percent the segments would be so small that unrelated sets agree by chance, and
deletions cost an entry per shingle. There each set is indexed by the prefix of its shingles that every
linked set has to meet, n - ceil(n * p / 100) + 1 of n, rare ones first. How rare a shingle is comes
from a sample; any order that all sets share gives the same links.

Each set is indexed in its own band and probes the bands of its possible smaller partners. Sets that
meet in a bucket are candidates; instead of all pairs of a bucket, each set is first compared with
the bucket's smallest one, and then only sets of different components are compared, each pair in one of the
first buckets that it meets in, which loses no component. Candidates are filtered by a parity sketch, whose distance
never exceeds the symmetric difference, and verified on the texts, the nearest partner of a set first.

Equal sets are one class throughout. Defined cases: a null or empty text has no shingles and links
with nothing, a text of fewer words than a shingle is one shingle, a null doc_id never names a component
while another id does, repeated rows get repeated results, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parceltide.llm import common
from parceltide.llm.components import components

SPACES = b" \t\n\x0b\x0c\r"
_IN_WORD = common.byte_mask(SPACES)
BAND_RATIO = 1.5
PARITY_LONGS = 8  # at 90 percent; more for lower thresholds, whose pairs differ more
SHARED = 0.05  # chance that a shingle of one set is in an unrelated one, as boilerplate makes it
PAIR_COST = 4.0  # of a candidate pair, in index entries
SEGMENTS_FROM = 90
SAMPLE_TEXTS = 4000
MOST_FREQUENT = 50_000
_SEEN = 100_000
FIRST_BUCKETS = 4  # of a set's open buckets, those that tell where else a pair meets
RUNTIME_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "8000000",
    "spark.sql.optimizer.runtimeFilter.number.threshold": "1",
}

# Roles of an index entry.
EXACT, OWN = 1, 2


class Likeness(NamedTuple):
    words: int  # of a shingle, one at least
    percent: int  # similarity that links, 1 to 99

    @property
    def least_size(self) -> int:
        """Smaller sets link only if they are equal."""
        return -(-self.percent // (100 - self.percent))

    def most_apart(self, size: int) -> int:
        """Symmetric difference of a linked pair whose smaller set has ``size`` shingles."""
        return size * (100 - self.percent) // self.percent

    @property
    def parity_longs(self) -> int:
        return PARITY_LONGS * -(-19 * (100 - self.percent) // (100 + self.percent))


QUERY = Likeness(3, 90)


class Band(NamedTuple):
    number: int
    low: int
    high: int  # inclusive
    segments: int
    deletions: int  # the last so many segments are also indexed with one deletion


def band_edges(largest: int, like: Likeness = QUERY) -> list[tuple[int, int]]:
    edges, low = [], like.least_size
    while low <= largest:
        high = max(low, int(low * BAND_RATIO) - 1)
        edges.append((low, high))
        low = high + 1
    return edges


def allocate(number: int, low: int, high: int, sets: int, like: Likeness = QUERY) -> Band:
    """The cheapest split of the k + 1 needed agreements over plain and one-deletion segments."""
    need = like.most_apart(high) + 1
    best = None
    for doubled in range(need // 2 + 1):
        segments = need - doubled
        size = low / segments
        chance = (segments - doubled) * SHARED ** size + doubled * (1 + 2 * size) * SHARED ** size
        cost = sets * (segments + doubled * size) + PAIR_COST * sets * sets / 2 * min(1.0, chance)
        if best is None or cost < best[0]:
            best = (cost, Band(number, low, high, segments, doubled))
    return best[1]


def shingles(raw: bytes, like: Likeness = QUERY) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = common.word_hashes(raw.lower(), _IN_WORD)
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        if len(words) < like.words:
            value = np.uint64(len(words))
            for w in words:
                value = common.mix64(np.array([value ^ w], dtype=np.uint64))[0] * np.uint64(3)
            return np.array([value], dtype=np.uint64)
        n = len(words) - like.words + 1
        out = common.mix64(words[:n] + np.uint64(0x9E3779B97F4A7C15))
        for at in range(1, like.words):
            word = words[at:at + n]
            out = common.mix64(out ^ (word * np.uint64(0xD6E8FEB86659FD93)) if at % 2 else
                               out + word * np.uint64(0xBF58476D1CE4E5B9))
        return np.unique(out)


def set_key(found: np.ndarray) -> bytes:
    return blake2b(found.tobytes(), digest_size=16).digest()


def parity(found: np.ndarray, like: Likeness = QUERY) -> np.ndarray:
    n = 64 * like.parity_longs
    bits = np.bincount((found % np.uint64(n)).astype(np.int64), minlength=n) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def short_id(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


# --- index -----------------------------------------------------------------------------------


def entries(found: np.ndarray, bands: list[Band], like: Likeness = QUERY) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and roles of a set: in its own band, and in the bands of smaller partners."""
    size = len(found)
    buckets, roles = [], []
    for band in bands:
        if band.low <= size <= band.high:
            own = OWN
        elif band.high < size and like.percent * size <= 100 * band.high:
            own = 0
        else:
            continue
        seed = np.uint64((band.number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        with np.errstate(over="ignore"):
            dealt = common.mix64(found ^ seed)
            segment = ((dealt >> np.uint64(33)) % np.uint64(band.segments)).astype(np.int64)
            value = common.mix64(dealt + seed)
            sums = np.zeros(band.segments, dtype=np.uint64)
            np.add.at(sums, segment, value)
            name = common.mix64(np.arange(1, band.segments + 1, dtype=np.uint64) * seed)
            buckets.append(common.mix64(sums ^ name))
            roles.append(np.full(band.segments, EXACT | own, dtype=np.int8))
            if band.deletions:
                inside = segment >= band.segments - band.deletions
                cut = common.mix64((sums[segment[inside]] - value[inside]) ^ name[segment[inside]])
                buckets.append(cut)
                roles.append(np.full(len(cut), own, dtype=np.int8))
    if not buckets:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int8)
    return np.concatenate(buckets), np.concatenate(roles)


def prefix_entries(found: np.ndarray, frequent: np.ndarray, counts: np.ndarray, like: Likeness
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and roles of a set by its rarest shingles. ``frequent`` is sorted, ``counts`` goes with it."""
    seen = np.zeros(len(found), dtype=np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        seen = np.where(frequent[at] == found, counts[at], 0)
    taken = len(found) - -(-like.percent * len(found) // 100) + 1
    buckets = found[np.lexsort((found, seen))[:taken]]
    return buckets, np.full(len(buckets), EXACT | OWN, dtype=np.int8)


def frequent_shingles(docs: DataFrame, like: Likeness, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of shingles that several of about ``SAMPLE_TEXTS`` texts have."""
    text = common.text_or_empty()
    sample = docs.select(text.cast("binary").alias("text")).filter(
        F.pmod(F.xxhash64(text), F.lit(max(1, texts // SAMPLE_TEXTS))) == 0).distinct()

    def made(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(x.as_py(), like) for x in batch.column(0)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["shingle"])

    rows = common.per_batch(sample, made, "shingle bigint").groupBy("shingle").agg(F.count("*").alias("n")).filter(
        "n > 2").orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).collect()
    hashes = np.array([r["shingle"] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r["n"] for r in rows], dtype=np.int64)[order]


def _may_link(a: str, b: str) -> Column:
    """One of the two in its own band, and not both with a deletion."""
    either = F.col(a).bitwiseOR(F.col(b))
    return either.bitwiseAND(F.lit(EXACT | OWN)) == (EXACT | OWN)


def sets_of(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, t (hash of the text), n_shingles, key, sid and parity per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(common.text_or_empty()).alias("t"),
                       common.text_or_empty().cast("binary").alias("text"))

    def made(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(x.as_py(), like) for x in batch.column(2)]
        keys = [set_key(x) if len(x) else None for x in found]
        return pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([len(x) for x in found], pa.int64()),
            pa.array(keys, pa.binary()), pa.array([short_id(k) if k else None for k in keys], pa.int64()),
            pa.array([parity(x, like).tolist() if len(x) >= like.least_size else None for x in found], pa.list_(pa.int64())),
        ], ["doc_id", "t", "n_shingles", "key", "sid", "parity"])

    return common.per_batch(
        rows, made, "doc_id bigint, t bigint, n_shingles bigint, key binary, sid bigint, parity array<bigint>")


def index_entries(docs: DataFrame, entries_of: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]],
                  like: Likeness) -> DataFrame:
    """(bucket, sid, role). A task writes the entries of a set once, however many copies it reads."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(common.ARROW_ROWS))
    rows = docs.select(common.text_or_empty().cast("binary").alias("text"))

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            buckets, sids, roles = [], [], []
            for text in batch.column(0):
                found = shingles(text.as_py(), like)
                if len(found) < like.least_size:
                    continue
                sid = short_id(set_key(found))
                if sid in seen:
                    continue
                if len(seen) < _SEEN:  # beyond that copies cost entries, not correctness
                    seen.add(sid)
                bucket, role = entries_of(found)
                buckets.append(bucket.view(np.int64))
                roles.append(role)
                sids.append(np.full(len(bucket), sid, dtype=np.int64))
            if buckets:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(buckets)), pa.array(np.concatenate(sids)),
                     pa.array(np.concatenate(roles))], ["bucket", "sid", "role"])

    return rows.mapInArrow(run, "bucket bigint, sid bigint, role tinyint")


# --- candidates and verification -------------------------------------------------------------


def _sketches_apart(x: str, y: str, longs: int) -> Column:
    return sum((F.bit_count(F.get(f"p_{x}", F.lit(i)).bitwiseXOR(F.get(f"p_{y}", F.lit(i))))
                for i in range(longs)), F.lit(0))


def _folded(like: Likeness) -> Column:
    """The parity sketch laid over itself: a sketch of ``PARITY_LONGS``, whose distance is no larger."""
    return F.array(*[reduce(Column.bitwiseXOR, [F.get("parity", F.lit(i)) for i in range(at, like.parity_longs, PARITY_LONGS)])
                     for at in range(PARITY_LONGS)])


def _close(x: str, y: str, like: Likeness, longs: int) -> Column:
    """What sizes and sketches of so many longs leave possible; columns n_*, p_* of both sides."""
    apart = _sketches_apart(x, y, longs)
    small, large = F.least(f"n_{x}", f"n_{y}"), F.greatest(f"n_{x}", f"n_{y}")
    both = F.col(f"n_{x}") + F.col(f"n_{y}")
    return (small * 100 >= large * like.percent) & (apart * (100 + like.percent) <= both * (100 - like.percent))


def texts_of(near: DataFrame, docs: DataFrame, like: Likeness) -> DataFrame:
    """(key, text) of the classes in ``near``, each from the one row that stands for it.

    Spark's runtime filter drops the other rows before their texts are shuffled. Its Bloom filter has
    a fixed largest size; beyond that it lets more rows through to the join, which decides.
    """
    for name, value in RUNTIME_FILTER.items():
        docs.sparkSession.conf.set(name, value)
    places = common.written(near.select(F.col("key_x").alias("key"), "place_x", "n_x").union(
        near.select("key_y", "place_y", "n_y")).distinct().select(
        "key", F.col("n_x").alias("n"), *_identity(*(F.col(f"place_x.{c}") for c in ("absent", "doc_id", "t")))),
        "close-places")
    doc_id, text = F.col("doc_id").cast("bigint"), common.text_or_empty()
    rows = docs.select(text.alias("text"), *_identity(doc_id.isNull(), doc_id, F.xxhash64(text)))
    places = places.filter(F.col("n") >= like.least_size)
    return rows.join(places, ["h1", "h2"]).select("key", "text").dropDuplicates(["key"])


def close_pairs(pairs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """``pairs(x, y)`` of short ids that sizes and sketches leave possible, with keys, places and the
    distance of the sketches."""
    side = lambda n: classes.select(
        F.col("sid").alias(n), F.col("key").alias(f"key_{n}"), F.col("n_shingles").alias(f"n_{n}"),
        F.col("parity").alias(f"p_{n}"), F.col("place").alias(f"place_{n}"))
    return pairs.join(side("x"), "x").join(side("y"), "y").filter(
        _close("x", "y", like, like.parity_longs)).select(
        "key_x", "key_y", *(c for n in "xy" for c in (f"place_{n}", f"n_{n}")),
        _sketches_apart("x", "y", like.parity_longs).alias("apart"))


def sharp_sketch(found: np.ndarray) -> bytes:
    """A parity sketch of at least two bits a shingle, a power of two long."""
    bits = max(64, 1 << (2 * len(found) - 1).bit_length())
    ones = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(ones.astype(np.uint8)).tobytes()


def sketch_distance(x: bytes, y: bytes) -> int:
    """Of two sketches, the longer one folded to the length of the other: no more than the symmetric difference."""
    a, b = (np.frombuffer(z, dtype=np.uint64) for z in sorted((x, y), key=len))
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def still_close(near: DataFrame, held: DataFrame, like: Likeness) -> DataFrame:
    """(key_x, key_y) of the pairs that sketches in proportion to the sets leave possible. Sketches of fixed length say
    little about large sets, and a text weighs ten times its sketch."""

    def made(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(x.as_py(), like) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) for x in found], pa.int64()),
             pa.array([sharp_sketch(x) for x in found], pa.binary())], ["key", "n", "sketch"])

    sketches = common.written(common.per_batch(
        held.select("key", F.col("text").cast("binary")), made, "key binary, n bigint, sketch binary"), "sharp-sketches")
    side = lambda n: sketches.select(*[F.col(c).alias(f"{c}_{n}") for c in sketches.columns])
    both = near.select("key_x", "key_y").join(side("x"), "key_x").join(side("y"), "key_y")

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)
        mask = pa.array([sketch_distance(x, y) * (100 + like.percent) <= (n + m) * (100 - like.percent)
                         for n, x, m, y in rows], pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(i).filter(mask) for i in (0, 1)], ["key_x", "key_y"])

    return common.per_batch(both.select("key_x", "key_y", "n_x", "sketch_x", "n_y", "sketch_y"), check,
                            "key_x binary, key_y binary")


def verified(near: DataFrame, docs: DataFrame, like: Likeness) -> DataFrame:
    """The linked ones of a written table of close pairs, as links (a, b) of keys. Texts travel for those pairs only that
    sharper sketches leave in doubt."""
    held = common.written(texts_of(near, docs, like), "close-texts")
    doubtful = common.written(still_close(near, held, like), "doubtful-pairs")
    both = doubtful.join(
        held.select(F.col("key").alias("key_x"), F.col("text").cast("binary").alias("text_x")), "key_x").join(
        held.select(F.col("key").alias("key_y"), F.col("text").cast("binary").alias("text_y")), "key_y")

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        linked = [links(x.as_py(), y.as_py(), like) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
        mask = pa.array(linked, pa.bool_())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return common.per_batch(both.select("key_x", "key_y", "text_x", "text_y"), check, "a binary, b binary")


def united(near: DataFrame, named: DataFrame | None, docs: DataFrame, like: Likeness) -> DataFrame | None:
    """(node, component) after the close pairs ``near`` are verified, on top of the components ``named``.

    Each set is first verified against the nearest of its partners only; of the other pairs those are left whose
    sets are still in different components. So a set that is close to very many others ships few texts, and
    no link between components is skipped.
    """
    nearest = near.groupBy("key_y").agg(F.min(F.struct("apart", "key_x")).alias("best")).select(
        "key_y", F.col("best.key_x").alias("key_x"))
    first = common.written(near.join(nearest, ["key_x", "key_y"]), "nearest-pairs")
    if not first.head(1):
        return named
    named = _with_links(named, verified(first, docs, like))
    common.release(docs.sparkSession)
    component = lambda n: named.select(
        F.col("node").alias(f"key_{n}"), F.col("component").alias(f"component_{n}"))
    rest = near.join(first.select("key_x", "key_y"), ["key_x", "key_y"], "left_anti").join(
        component("x"), "key_x", "left").join(component("y"), "key_y", "left").filter(
        F.coalesce("component_x", "key_x") != F.coalesce("component_y", "key_y"))
    rest = common.written(rest.drop("component_x", "component_y"), "other-pairs")
    return _with_links(named, verified(rest, docs, like)) if rest.head(1) else named


def _with_links(named: DataFrame | None, new: DataFrame) -> DataFrame:
    """Components of new links and of what was united before."""
    if named is not None:
        new = new.union(named.filter("node <> component"))
    return components(common.written(new, "links"))


def word_shingles(raw: bytes, like: Likeness = QUERY) -> set[tuple[bytes, ...]]:
    words = raw.lower().split()  # bytes split at exactly the six characters of SPACES
    if not words:
        return set()
    if len(words) < like.words:
        return {tuple(words)}
    return set(zip(*(words[at:] for at in range(like.words)), strict=False))


def links(x: bytes, y: bytes, like: Likeness = QUERY) -> bool:
    a, b = word_shingles(x, like), word_shingles(y, like)
    shared = len(a & b)
    return bool(a and b) and 100 * shared >= like.percent * (len(a) + len(b) - shared)


def allocated(classes: DataFrame, like: Likeness) -> list[Band]:
    largest = classes.agg(F.max("n_shingles")).first()[0] or 0
    edges = band_edges(largest, like)
    band = F.size(F.filter(F.array(*(F.lit(low) for low, _ in edges)) if edges else F.array().cast("array<int>"),
                           lambda low: low <= F.col("n_shingles")))
    counts = {r["band"]: r["n"] for r in classes.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()}
    return [allocate(i, low, high, counts.get(i + 1, 0), like) for i, (low, high) in enumerate(edges)]


def open_pairs(members: DataFrame, classes: DataFrame, named: DataFrame, like: Likeness) -> DataFrame:
    """Pairs (x, y) that may link within buckets whose sets lie in several components: y is outside the hub's
    component, x is in any other. Folded sketches are compared within the join, and a pair that meets in one of the first
    buckets of both sets comes from the smallest of those only."""
    ids = common.written(classes.join(named, F.col("key") == F.col("node"), "left").select(
        "sid", F.xxhash64(F.coalesce("component", "key")).alias("component"), "n_shingles", _folded(like).alias("parity")),
        "set-ids")
    placed = members.join(ids.select("sid", "component"), "sid")
    several = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min(F.when(F.col("sid") == F.col("hub"), F.col("component"))).alias("hub_component")).filter(
        "low <> high").select("bucket", "hub_component")
    still_open = common.written(placed.join(several, "bucket").select(
        "bucket", "sid", "role", "component", (F.col("component") != F.col("hub_component")).alias("stray"),
        (F.col("sid") == F.col("hub")).alias("is_hub")), "open-buckets")
    common.release(members.sparkSession)
    held = still_open.filter(F.col("role") == (EXACT | OWN)).groupBy("sid").agg(
        F.slice(F.sort_array(F.collect_list("bucket")), 1, FIRST_BUCKETS).alias("first"))  # of the entries it made
    sketches = common.written(ids.drop("component").join(held, "sid"), "open-sketches")
    # A set without an entry of both roles has no first buckets; the join below would lose it.
    sketches = sketches.unionByName(ids.drop("component").join(held.select("sid"), "sid", "left_anti").join(
        still_open.select("sid").distinct(), "sid", "left_semi").withColumn("first", F.array().cast("array<bigint>")))
    unsettled = still_open.join(sketches, "sid")
    side = lambda n: [F.col("sid").alias(n), F.col("role").alias(f"role_{n}"), F.col("component").alias(
        f"component_{n}"), F.col("n_shingles").alias(f"n_{n}"), F.col("parity").alias(f"p_{n}"),
        F.col("first").alias(f"first_{n}")]
    strays = unsettled.filter("stray").select(F.col("bucket").alias("bucket_y"), *side("y"))
    others = unsettled.filter(~F.col("is_hub")).select(F.col("bucket").alias("bucket_x"), "stray", *side("x"))
    once = ~F.col("stray") | (F.col("x") < F.col("y"))  # of two strays one is y
    # In both sets' first buckets any two sets may link, so the smallest that they share makes the pair.
    earlier = F.array_min(F.array_intersect("first_x", "first_y")) < F.col("bucket_y")
    return strays.join(
        others, (F.col("bucket_x") == F.col("bucket_y")) & (F.col("component_x") != F.col("component_y")) & once
        & _may_link("role_x", "role_y") & _close("x", "y", like, PARITY_LONGS)
        & ~F.coalesce(earlier, F.lit(False))).select("x", "y").distinct()


def _no_components(classes: DataFrame) -> DataFrame:
    return classes.select(F.col("key").alias("node"), F.col("key").alias("component")).limit(0)


def join_components(docs: DataFrame, like: Likeness = QUERY) -> DataFrame:
    """doc_id, n_shingles, component_id, group (a key of the component) and place (what tells the row)
    per row of ``docs``."""
    sets = common.written(sets_of(docs, like), "shingle-sets")
    classes = common.written(
        sets.filter("key IS NOT NULL").groupBy("key").agg(
            F.first("sid").alias("sid"), F.first("n_shingles").alias("n_shingles"),
            F.first("parity").alias("parity"), F.min("doc_id").alias("least"),
            F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "t")).alias("place")), "classes")
    if like.percent < SEGMENTS_FROM:
        frequent, counts = frequent_shingles(docs, like, classes.count())
        index = index_entries(docs, lambda found: prefix_entries(found, frequent, counts, like), like)
    else:
        bands = allocated(classes, like)
        index = index_entries(docs, lambda found: entries(found, bands, like), like)
    spark = docs.sparkSession
    index = common.written(index, "index")
    shared = common.written(index.groupBy("bucket").agg(F.min("sid").alias("hub"), F.max("sid").alias("last")).filter(
        "hub <> last").select("bucket", "hub"), "shared-buckets")
    common.release(spark)  # before the join shuffles the index again
    members = common.written(
        index.join(shared, "bucket").select("bucket", "hub", "sid", "role").distinct(), "buckets")
    common.removed(index)
    common.release(spark)
    pairs = members.filter("sid <> hub").select(F.col("hub").alias("x"), F.col("sid").alias("y")).distinct()
    near = common.written(close_pairs(pairs, classes, like), "close-pairs")
    common.release(spark)
    first = united(near, None, docs, like)
    if first is None:
        first = _no_components(classes)
    late = common.written(open_pairs(members, classes, first, like), "open-pairs")
    common.removed(members)
    common.release(spark)
    last = united(common.written(close_pairs(late, classes, like), "close-pairs"), first, docs, like)
    common.release(spark)

    named = classes.select("key", "least").join(last, F.col("key") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "key"))
    ids_of = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_key = common.written(named.select("key", "component").join(ids_of, "component").select(
        "key", "component_id", F.col("component").alias("group")), "set-components")
    return sets.select("doc_id", "t", "n_shingles", "key").join(by_key, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "group",
        F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "t").alias("place"))


def _identity(absent: Column, doc_id: Column, t: Column) -> list[Column]:
    return [F.xxhash64(absent, doc_id, t).alias("h1"), F.xxhash64(F.lit(1), absent, doc_id, t).alias("h2")]


def one_of_each(docs: DataFrame, like: Likeness = QUERY) -> DataFrame:
    """One row of ``docs`` per component, that of the smallest doc_id, with all columns. Rows without
    shingles belong to no group and stay."""
    blank = ~F.rlike(common.text_or_empty(), F.lit(r"[^\x20\x09-\x0D]"))
    sets = join_components(docs.filter(~blank), like)
    kept = sets.groupBy(F.col("group")).agg(F.min("place").alias("place")).select(
        *_identity(F.col("place.absent"), F.col("place.doc_id"), F.col("place.t")))
    names = docs.columns
    wide = docs.filter(~blank).toDF(*(f"_{i}" for i in range(len(names))))
    doc_id, text = (F.col(f"_{names.index(c)}") for c in ("doc_id", "text"))
    rows = wide.select("*", *_identity(doc_id.isNull(), doc_id.cast("bigint"),
                                       F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))))
    one = rows.join(kept, ["h1", "h2"]).dropDuplicates(["h1", "h2"]).drop("h1", "h2").toDF(*names)
    return one.union(docs.filter(blank))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(common.table(spark, sf_dir, "documents")).drop("group", "place")
