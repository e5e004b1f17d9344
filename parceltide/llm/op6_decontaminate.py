"""Benchmark decontamination by spaced seeds.

A mask names the positions of a window of words that count; the others may differ. Every window of
the test items is hashed under each mask. The items are taken in blocks of at most about
``BLOCK_WORDS`` words; each block is broadcast and the training texts are scanned once per block,
their windows hashed alike and looked up. Around a hit the text is laid beside the item without
gaps, and the stretch with the best score (match +1, substitution -``PENALTY``) is the overlap. A
text is contaminated by an item if the overlap has ``LEAST_MATCHES`` equal words, or
``LEAST_COVERAGE`` of a shorter item. Of such an item the best stretch may miss words beyond a
changed one, so there all words laid beside it count. Items too short for the masks get their own:
the whole item, and the item without each single word.

Words are lower-cased runs of letters, digits and everything outside ASCII, so changes of case,
punctuation and white space do not matter.

Defined cases: null texts are empty and match nothing; items of fewer than ``LEAST_ITEM`` words
match nothing; repeated rows and repeated items
give their own rows; an empty table on either side gives no pairs. Columns are kept by position in
``clean_documents``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.llm import common

# Positions that count: five of nine, chosen so that no two masks agree in more than three.
MASKS = ((0, 1, 2, 4, 7), (0, 2, 3, 5, 8), (0, 1, 4, 6, 8), (0, 3, 4, 5, 6))
BLOCK_WORDS = 500_000
LEAST_ITEM = 5
LEAST_MATCHES = 10
LEAST_COVERAGE = 0.8
PENALTY = 2
_FILTER_BITS = 20

_IN_WORD = common.byte_mask(b" ")
PAIR_SCHEMA = ("doc_id bigint, item_id bigint, n_hits bigint, n_matches bigint, n_words bigint, "
               "doc_start bigint, item_start bigint, item_words bigint, coverage double")


def words_of(text: str | None) -> np.ndarray:
    data = (text or "").lower().encode("utf-8", "surrogatepass").translate(common.LOWER_WORDS)
    return common.word_hashes(data, _IN_WORD)


def window_hashes(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    n = len(words) - mask[-1]
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, len(mask), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in mask:
            out = (out ^ words[at:at + n]) * np.uint64(0x9DDFEA08EB382D69)
            out ^= out >> np.uint64(29)
    return out


class Block:
    """Test items with the places of their window hashes."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = [(i, np.frombuffer(w, dtype=np.uint64)) for i, w in items]
        short = sorted({len(w) for _, w in self.items if LEAST_ITEM <= len(w) <= MASKS[0][-1] + 1})
        own = [(n, mask) for n in short for mask in (tuple(range(n)), *combinations(range(n), n - 1))]
        self.masks = [*MASKS, *(mask for _, mask in own)]
        lengths = [None] * len(MASKS) + [n for n, _ in own]  # of the items that a mask is for
        self.places: list[dict[int, list[tuple[int, int]]]] = []
        self.filters = []
        for mask, length in zip(self.masks, lengths, strict=True):
            places: dict[int, list[tuple[int, int]]] = {}
            for number, (_, words) in enumerate(self.items):
                if len(words) < LEAST_ITEM or length is not None and len(words) != length:
                    continue
                for offset, value in enumerate(window_hashes(words, mask).tolist()):
                    places.setdefault(value, []).append((number, offset))
            kept = np.zeros(1 << _FILTER_BITS, dtype=bool)
            values = np.array(list(places), dtype=np.uint64)
            kept[values & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.places.append(places)
            self.filters.append(kept)

    def overlaps(self, words: np.ndarray) -> list[tuple]:
        """(item_id, hits, matches, length, start in the text, start in the item, words of the item)
        per item the text overlaps, with the best overlap of the item."""
        diagonals: dict[tuple[int, int], int] = {}
        for mask, places, kept in zip(self.masks, self.places, self.filters, strict=True):
            hashes = window_hashes(words, mask)
            for at in np.flatnonzero(kept[hashes & np.uint64((1 << _FILTER_BITS) - 1)]).tolist():
                for number, offset in places.get(int(hashes[at]), ()):
                    place = (number, at - offset)
                    diagonals[place] = diagonals.get(place, 0) + 1
        best: dict[int, tuple] = {}
        for (number, shift), hits in sorted(diagonals.items()):
            item = self.items[number][1]
            low, high = max(0, -shift), min(len(item), len(words) - shift)
            equal = words[shift + low:shift + high] == item[low:high]
            first, last = best_stretch(equal)
            matches = int(equal[first:last].sum())
            least = min(LEAST_MATCHES, LEAST_COVERAGE * len(item))
            if matches < least < LEAST_MATCHES and equal.sum() >= least:
                first, last = (int(x) for x in np.flatnonzero(equal)[[0, -1]] + (0, 1))
                matches = int(equal.sum())
            if matches >= least:
                found = (matches, -(last - first), hits, -(shift + low + first), -(low + first))
                best[number] = max(best.get(number, found), found)
        return [(self.items[n][0], hits, m, -length, -start, -at, len(self.items[n][1]))
                for n, (m, length, hits, start, at) in sorted(best.items())]


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """The part [first, last) with the largest sum of +1 for equal and -PENALTY for different."""
    if not len(equal):
        return 0, 0
    sums = np.concatenate(([0], np.cumsum(np.where(equal, 1, -PENALTY))))
    lowest = np.minimum.accumulate(sums)
    last = int(np.argmax(sums - lowest))
    return int(np.flatnonzero(sums[:last + 1] == lowest[last])[-1]), last


def item_blocks(items: DataFrame) -> Iterator[Broadcast]:
    """The test items as broadcast blocks of bounded size."""
    spark = items.sparkSession

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [words_of(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([w.tobytes() for w in words], pa.binary()),
             pa.array([len(w) for w in words], pa.int64())], ["item_id", "words", "n"])

    rows = common.written(common.per_batch(
        items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")), hashed,
        "item_id bigint, words binary, n bigint"), "benchmark-words")
    total = rows.agg(F.sum("n")).first()[0] or 0
    count = max(1, -(-2 * total // BLOCK_WORDS))  # by hash, so aimed at half the bound
    number = F.pmod(F.xxhash64("item_id", "words"), F.lit(count))
    for at in range(count):
        found = rows.filter(number == at).orderBy("item_id", "words").collect()
        yield spark.sparkContext.broadcast([(r["item_id"], bytes(r["words"])) for r in found])


_indexed: list[tuple[list, Block]] = []


def _block(shared) -> Block:
    """The block of a broadcast, indexed once per Python worker."""
    if not _indexed or _indexed[0][0] is not shared.value:
        _indexed[:] = [(shared.value, Block(shared.value))]
    return _indexed[0][1]


def contaminated_pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per text and item that overlap."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = None
    for shared in item_blocks(items):

        def match(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch | None:
            block, out = _block(shared), []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for item, hits, matches, length, start, at, n in block.overlaps(words_of(text)):
                    out.append((doc_id, item, hits, matches, length, start, at, n, matches / n))
            if not out:
                return None
            names = [x.split()[0] for x in PAIR_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.float64() if i == 8 else pa.int64())
                 for i, c in enumerate(zip(*out, strict=True))], names)

        part = common.per_batch(rows, match, PAIR_SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows."""
    text = docs.columns.index("text")
    for shared in item_blocks(items):

        def keep(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            block = _block(shared)
            return batch.filter(pa.array([not block.overlaps(words_of(t)) for t in
                                          batch.column(text).to_pylist()], pa.bool_()))

        docs = common.per_batch(docs, keep, docs.schema)
    return docs


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
