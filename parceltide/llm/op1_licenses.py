"""License scan by ordered signature rules.

Texts are reduced to lower-case words once per row. A rule is tried only if all its keywords are
words of the text. Detections are taken by priority, then length, then place; one that lies within
an accepted interval is suppressed. The three base phrases are rules that are never suppressed.

A null text counts as empty and gives zero words, null places and empty labels. The whole text is
scanned, whatever its length. Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.llm import common
from parceltide.llm.license_rules import Rule, build_rules

BASE = [(b"mit", re.compile(rb"(?<![^ ])mit license(?![^ ])"), "mit"),
        (b"apache", re.compile(rb"(?<![^ ])apache license(?![^ ])"), "apache"),
        (b"public", re.compile(rb"(?<![^ ])general public license(?![^ ])"), "gpl")]
_LICENSE = b"license"
SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
          "base_labels string, labels string, score double, detections string")


class Scanner:
    """The rules, indexed by their rarest-looking keyword: the longest one."""

    def __init__(self, rules: list[Rule] | None = None):
        self.by_word: dict[bytes, list[Rule]] = {}
        for rule in build_rules() if rules is None else rules:
            self.by_word.setdefault(max(rule.keywords, key=lambda w: (len(w), w)), []).append(rule)

    def detections(self, text: bytes, vocabulary: set[bytes]) -> list[tuple[int, int, Rule]]:
        found = []
        for word, rules in self.by_word.items():
            if word in vocabulary:
                for rule in rules:
                    if rule.keywords <= vocabulary:
                        found += [(*m.span(), rule) for m in rule.pattern.finditer(text)]
        return suppress(found)

    def scan(self, raw: bytes) -> tuple:
        """n_words, n_base, first and last word, base labels, labels, score, detections."""
        words = raw.translate(common.LOWER_WORDS).split()
        vocabulary = set(words)
        if vocabulary.isdisjoint(self.by_word) and _LICENSE not in vocabulary:
            return len(words), 0, None, None, "", "", 0.0, ""
        text = b" ".join(words)
        starts, base = [], set()
        if _LICENSE in vocabulary:
            for gate, pattern, label in BASE:
                if gate in vocabulary:
                    places = [m.start() for m in pattern.finditer(text)]
                    starts += places
                    base |= {label} if places else set()
        kept = self.detections(text, vocabulary)
        labels = base | {rule.label for _, _, rule in kept}
        score = max([rule.weight for _, _, rule in kept] + [0.8] * bool(base), default=0.0)

        def word_at(offset: int) -> int:
            return text.count(b" ", 0, offset)

        return (len(words), len(starts), word_at(min(starts)) if starts else None,
                word_at(max(starts)) if starts else None, ",".join(sorted(base)),
                ",".join(sorted(labels)), score,
                ",".join(f"{r.label}:{word_at(a)}:{word_at(b) + 1}" for a, b, r in sorted(
                    kept, key=lambda d: (d[0], d[1], d[2].label))))


def suppress(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Drop detections inside an accepted one. Accepted intervals are kept by start, none inside
    another, so the only one that can hold a newcomer is the last that starts at or before it."""
    from bisect import bisect_right, insort

    starts: list[int] = []
    ends: dict[int, int] = {}
    kept = []
    for begin, end, rule in sorted(found, key=lambda d: (
            d[2].priority, d[0] - d[1], d[0], d[2].label)):
        at = bisect_right(starts, begin) - 1
        if at >= 0 and ends[starts[at]] >= end:
            continue
        kept.append((begin, end, rule))
        # An accepted interval takes the place of those it covers.
        while at + 1 < len(starts) and ends[starts[at + 1]] <= end:
            del ends[starts.pop(at + 1)]
        if begin in ends:
            ends[begin] = end
        else:
            insort(starts, begin)
            ends[begin] = end
    return kept


def scan_licenses(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", common.text_or_empty().cast("binary").alias("text"))
    scanner = Scanner()

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(zip(*(scanner.scan(t.as_py()) for t in batch.column(1)), strict=True))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.string()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                 "detections"]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", *names])

    return common.per_batch(rows, scan, SCHEMA)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(common.table(spark, sf_dir, "documents").withColumn(
        "doc_id", F.col("doc_id").cast("bigint")))
