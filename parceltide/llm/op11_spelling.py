"""Spelling variants by reduced-alphabet generation.

Letters are dealt to a few symbols, so that all symbols are about equally frequent, and each word is written in
them. If two words are one edit apart, their reduced words are equal or one edit apart. So the full one-edit
neighbourhood of every distinct reduced word is generated, joined with the reduced vocabulary, and the words of
the reduced pairs that meet are verified on their original letters. Of the two ways to meet one pair the one
from the smaller hash is kept. Neighbours are 64-bit hashes built from prefix sums, so a word of any length
costs a number for each neighbour, not a copy of itself; equal hashes only propose.

More symbols mean more neighbours, fewer symbols more chance pairs. The alphabet's size is the cheapest of
``SYMBOLS`` by neighbours and pairs, both taken from the whole vocabulary.

A word's *form* is its most frequent near word if that is ``RATIO`` times as frequent; its *root* is the end of
the chain of forms, found by doubling: frequencies grow by the ratio at each step, so chains are short.

Defined cases: a null or empty text has no words; a null doc_id counts as the empty string where letters are
deleted; repeated rows count again; an empty table gives no rows; columns other than doc_id and text play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parceltide.llm import common

SYMBOLS = (2, 3, 4, 5, 6, 8, 10)
PAIR_COST = 0.2  # of verifying a pair of words, in neighbours
RATIO = 10
SLICE = 1 << 20  # bytes of a text looked at together
HELD = 300_000  # distinct words a task counts before it hands them on
CELLS = 1 << 21  # neighbours generated together
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))

# a-z, and in UTF-8 the first byte of U+00C0 to U+00FF; the second byte is a letter's by its place.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[0xC3] = True


class Noise(NamedTuple):
    """Deletes a letter of every ``one_in``-th word of a document, drawn by a checksum; 0 deletes none."""
    one_in: int = 31


# --- vocabulary ------------------------------------------------------------------------------


def runs(raw: bytes, least: int) -> list[bytes]:
    """Maximal runs of letters of a lower-cased text with ``least`` code points at least."""
    found, start, whole = [], 0, np.frombuffer(raw, dtype=np.uint8)
    while start < len(raw):
        end = min(len(raw), start + SLICE)
        while True:
            part = whole[start:end]
            lead = part == 0xC3
            letter = _LETTER[part]
            letter[1:] |= lead[:-1]
            gaps = np.flatnonzero(~letter)
            if end == len(raw) or len(gaps):
                break
            end = min(len(raw), end + SLICE)  # one run fills the slice
        if end < len(raw):
            stop = int(gaps[-1]) + 1
            letter, lead, end = letter[:stop], lead[:stop], start + stop
        edges = np.diff(np.concatenate(([0], letter.view(np.int8), [0])))
        first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        leads = np.concatenate(([0], np.cumsum(lead)))
        kept = last - first - (leads[last] - leads[first]) >= least
        found += [raw[a:b] for a, b in zip((first[kept] + start).tolist(), (last[kept] + start).tolist(), strict=True)]
        start = end
    return found


def noisy(word: bytes, drawn: int, noise: Noise) -> bytes:
    if not noise.one_in or drawn % noise.one_in:
        return word
    text = word.decode()
    at = drawn % len(text)
    return (text[:at] + text[at + 1:]).encode()


def vocabulary(docs: DataFrame, least_chars: int = 7, least_n: int = 2, noise: Noise = Noise()) -> DataFrame:
    """word and n, its occurrences. Tasks count before they hand on."""
    rows = docs.select(F.col("doc_id").cast("bigint"), common.text_or_empty().cast("binary").alias("text"))

    def batch_of(counts: Counter) -> pa.RecordBatch:
        kept = {w.decode(): n for w, n in counts.items()}
        return pa.RecordBatch.from_arrays(
            [pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())], ["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs(text.as_py().lower(), least_chars)).items():
                    counts[noisy(word, zlib.crc32(word, start), noise)] += n
                if len(counts) > HELD:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    partial = rows.mapInArrow(counted, "word string, n bigint").filter(F.length("word") >= least_chars)
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


# --- the reduced alphabet --------------------------------------------------------------------


def letter_counts(words: DataFrame) -> dict[str, int]:
    """In how many places of the vocabulary each letter stands; at most 90 letters."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(256, dtype=np.int64)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                seen += np.bincount(np.frombuffer(word.encode("latin-1"), dtype=np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(seen)], ["letter", "n"])

    sums = words.select("word").mapInArrow(made, "letter int, n bigint").groupBy("letter").agg(
        F.sum("n").alias("n")).filter("n > 0").collect()
    return {chr(r["letter"]): r["n"] for r in sums}


def alphabet(counts: dict[str, int], symbols: int) -> dict[str, int]:
    """Letters, frequent ones first, each to the symbol that is rarest so far."""
    load, dealt = [0] * symbols, {}
    for letter, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        symbol = min(range(symbols), key=lambda s: (load[s], s))
        dealt[letter] = symbol
        load[symbol] += n
    return dealt


def choose_alphabet(words: DataFrame) -> dict[str, int]:
    """The alphabet with the least expected cost over the whole vocabulary."""
    counts = letter_counts(words)
    if not counts:
        return {}
    options = {k: alphabet(counts, k) for k in SYMBOLS}
    reduced = F.explode(F.array(*(F.struct(
        F.lit(k).alias("k"), F.translate("word", "".join(dealt), "".join(chr(97 + s) for s in dealt.values())).alias("r"))
        for k, dealt in options.items())))
    classes = words.select(reduced.alias("x")).groupBy("x.k", "x.r").agg(F.count("*").cast("double").alias("n"))
    size = F.length("r").alias("size")
    lengths = classes.groupBy("k", size).agg(
        F.sum("n").alias("words"), F.sum(F.col("n") * F.col("n")).alias("equal"), F.count("*").alias("classes"))
    k, length = F.col("k"), F.col("size")
    around = 2 * length * (k - 1) + length + k + 1  # substitutions and insertions, deletions, appended symbols, itself
    chance: Column = F.col("words") * F.col("words") * around / F.pow(k.cast("double"), length)
    cost = F.col("classes") * around + PAIR_COST * (F.col("equal") + chance)
    costs = lengths.groupBy("k").agg(F.sum(cost).alias("cost")).collect()
    return options[min(costs, key=lambda r: (r["cost"], r["k"]))["k"]]


def _matrices(words: list[str], table: np.ndarray, per_word: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and symbols (from 1) of words of equal length, in slices of bounded size."""
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    for length, places in by_length.items():
        step = max(1, CELLS // (length * per_word))
        for at in range(0, len(places), step):
            some = places[at:at + step]
            raw = np.frombuffer("".join(words[i] for i in some).encode("latin-1"), dtype=np.uint8)
            yield np.array(some), table[raw].reshape(len(some), length)


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def reduced_hash(symbols: np.ndarray) -> np.ndarray:
    return common.mix64((symbols * _powers(symbols.shape[1])[:-1]).sum(axis=1, dtype=np.uint64))


def neighbourhood(symbols: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and hashes of all words within one edit of each row, each once."""
    n, length = symbols.shape
    power = _powers(length + 1)
    terms = symbols * power[:length]
    before = np.zeros((n, length + 1), dtype=np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:], dtype=np.uint64)
    whole = before[:, -1:]
    rows, values = [np.arange(n)], [whole[:, 0]]

    def add(value: np.ndarray, kept: np.ndarray) -> None:
        at = np.nonzero(kept)
        rows.append(at[0])
        values.append(value[at])

    deleted = before[:, :-1] + (whole - before[:, 1:]) * _INVERSE
    add(deleted, np.concatenate((np.ones((n, 1), dtype=bool), symbols[:, 1:] != symbols[:, :-1]), axis=1))
    for s in range(1, k + 1):  # where the symbol stands already, an edit gives the word itself or a later edit's
        symbol = np.uint64(s)
        other = symbols != symbol
        add(whole - terms + symbol * power[:length], other)
        inserted = before + symbol * power[:length + 1] + (whole - before) * np.uint64(_BASE)
        add(inserted, np.concatenate((other, np.ones((n, 1), dtype=bool)), axis=1))
    return np.concatenate(rows), common.mix64(np.concatenate(values))


def _table(dealt: dict[str, int]) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint64)
    for letter, symbol in dealt.items():
        table[ord(letter)] = symbol + 1
    return table


def with_reduced(words: DataFrame, dealt: dict[str, int]) -> DataFrame:
    """``words`` with r, the hash of the reduced word."""
    table = _table(dealt)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, dtype=np.uint64)
            for places, symbols in _matrices(batch.column(0).to_pylist(), table, 1):
                out[places] = reduced_hash(symbols)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.view(np.int64))], ["word", "n", "r"])

    return words.select("word", "n").mapInArrow(made, "word string, n bigint, r bigint")


def reduced_neighbours(classes: DataFrame, dealt: dict[str, int]) -> DataFrame:
    """(r, near): each reduced word of ``classes(r, word)`` with its neighbours of no smaller hash, itself too."""
    table, k = _table(dealt), max(dealt.values(), default=0) + 1

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = batch.column(0).to_numpy(zero_copy_only=False)
            for places, symbols in _matrices(batch.column(1).to_pylist(), table, 2 * k):
                rows, near = neighbourhood(symbols, k)
                own, near = r[places][rows], near.view(np.int64)
                kept = near >= own
                yield pa.RecordBatch.from_arrays([pa.array(own[kept]), pa.array(near[kept])], ["r", "near"])

    return classes.select("r", "word").mapInArrow(made, "r bigint, near bigint")


# --- near words ------------------------------------------------------------------------------


def near_words(words: DataFrame) -> DataFrame:
    """(x, n_x, y, n_y): each pair of near words of ``words(word, n)`` once."""
    dealt = choose_alphabet(words)
    placed = common.written(with_reduced(words, dealt), "reduced-words")
    classes = common.written(placed.groupBy("r").agg(F.min("word").alias("word")), "reduced-vocabulary")
    met = common.written(reduced_neighbours(classes, dealt).join(
        classes.select(F.col("r").alias("near")), "near"), "reduced-pairs")
    x = placed.select("r", F.col("word").alias("x"), F.col("n").alias("n_x"))
    y = placed.select(F.col("r").alias("near"), F.col("word").alias("y"), F.col("n").alias("n_y"))
    first = met.join(x, "r")
    return first.join(y, (first["near"] == y["near"]) & ((F.col("r") != first["near"]) | (F.col("x") < F.col("y")))
                      & (F.levenshtein("x", "y", 1) == 1)).select("x", "n_x", "y", "n_y")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of a written table ``words(word, n)``."""
    side = lambda a, b: F.struct(
        F.col(a).alias("word"), F.struct((-F.col(f"n_{b}")).alias("least"), F.col(b).alias("form")).alias("best"))
    both = near_words(words).select(F.explode(F.array(side("x", "y"), side("y", "x"))).alias("e")).select("e.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    is_form = -F.col("best.least") >= ratio * F.col("n")
    found = common.written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.least")).alias("form_n")), "variants")
    roots = common.written(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:  # each round doubles the steps taken
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if not roots.join(on, "root", "left_semi").head(1):
            break
        roots = common.written(roots.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")), "roots")
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(common.written(vocabulary(common.table(spark, sf_dir, "documents")), "vocabulary"))
