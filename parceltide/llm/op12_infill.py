"""Fill-in-the-middle transformation by secondary sort.

A text is cut into units (lines), its units into prefix, middle and suffix, and those are rearranged
behind markers. No task ever holds a rearranged text: a document becomes *pieces*, chunks of whole units,
keyed by the document and their position in the output. One repartition by document with a sort within
partitions brings the pieces in output order, and a digest takes them one after the other. For the way
back the output's pieces are read in order, each marker says which part follows, and a second sort within
the same partitions, without a shuffle, streams them in source order into the digest of the restored text.

Pieces are dealt by document, text and input partition, and told apart by a row number, so rows that are
repeated very often spread over as many tasks as there are input partitions. A task that runs again deals its
rows alike, whatever order it reads them in.

Defined cases: a null text is empty; an empty text and one that holds a marker stay plain; a null doc_id
counts as the empty string where cuts are drawn; every row gives a row, repeated ones too; lines longer than a
chunk are cut between code points; columns other than doc_id and text play no part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.llm import common

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, MIDDLE, SUFFIX)  # in the order of the text
PLAIN, PSM, SPM = "plain", "psm", "spm"
CHUNK = 1 << 16  # bytes of a piece
FLUSH = 1 << 23  # bytes of pieces handed on at once

_HEAD = "home bigint, row bigint, place bigint, doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
_PIECES = f"{_HEAD}, piece binary"
_PARTS = f"{_HEAD}, output_sha256 string, part int, piece binary"
_DIGESTS = ("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
            "output_sha256 string, restored_sha256 string")
_HEAD_ROW = -1  # the place of the row that describes the document; its pieces follow


class Rule(NamedTuple):
    seed: int = 7
    percent: int = 100  # of documents that are rearranged
    spm_percent: int = 50  # of those, with the suffix first


class Cut(NamedTuple):
    units: int
    form: str
    prefix_end: int  # in bytes
    middle_end: int


def draws(doc_id: int | None, seed: int) -> list[int]:
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(drawn[i:i + 8], 16) for i in range(0, 32, 8)]


def cut(doc_id: int | None, raw: bytes, rule: Rule) -> Cut:
    """Where the text of a document is cut, and the form its output takes."""
    ends = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10) + 1
    if raw and not raw.endswith(b"\n"):
        ends = np.append(ends, len(raw))
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, rule.seed)
    if not raw or any(m in raw for m in MARKERS) or h3 % 100 >= rule.percent:
        return Cut(n, PLAIN, 0, 0)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = lambda units: int(ends[units - 1]) if units else 0
    return Cut(n, SPM if h4 % 100 < rule.spm_percent else PSM, at(low), at(high))


def chunks(raw: bytes, start: int, end: int) -> Iterator[bytes]:
    """Whole units up to ``CHUNK`` bytes; a longer unit is cut between code points."""
    while start < end:
        stop = min(end, start + CHUNK)
        if stop < end:
            stop = raw.rfind(b"\n", start, stop) + 1 or stop
            while raw[stop] & 0xC0 == 0x80:
                stop -= 1
        yield raw[start:stop]
        start = stop


def output_pieces(raw: bytes, found: Cut) -> Iterator[bytes]:
    if found.form == PLAIN:
        yield from chunks(raw, 0, len(raw))
        return
    prefix, middle, suffix = ((PREFIX, 0, found.prefix_end), (MIDDLE, found.prefix_end, found.middle_end),
                              (SUFFIX, found.middle_end, len(raw)))
    for marker, start, end in (prefix, suffix, middle) if found.form == PSM else (suffix, prefix, middle):
        yield marker
        yield from chunks(raw, start, end)


def code_points(raw: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(raw, dtype=np.uint8) & 0xC0 != 0x80))


class _Rows:
    """Rows gathered into record batches of bounded bytes."""

    def __init__(self, schema: str):
        fields = [field.split() for field in schema.split(", ")]
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        self.schema = pa.schema([(name, kinds[kind]) for name, kind in fields])
        self.rows, self.held = [], 0

    def add(self, *row, weight: int = 0) -> bool:
        self.rows.append(row)
        self.held += weight + 100
        return self.held >= FLUSH

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)


def pieces(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The pieces of every row's output. ``row`` tells rows apart, ``place`` orders the pieces of one; the row
    at place -1 describes the document. ``home`` depends on nothing but the row and its input partition."""
    doc_id, text = F.col("doc_id").cast("bigint"), common.text_or_empty()
    rows = docs.select(
        doc_id.alias("doc_id"), text.cast("binary").alias("text"),
        F.xxhash64(doc_id, text, F.spark_partition_id()).alias("home"), F.monotonically_increasing_id().alias("row"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_PIECES)
        for batch in batches:
            ids, homes, numbers = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for doc, text, home, row in zip(ids, batch.column(1), homes, numbers, strict=True):
                raw = text.as_py()
                found = cut(doc, raw, rule)
                chars = (None, None) if found.form == PLAIN else (
                    code_points(raw[:found.prefix_end]), code_points(raw[found.prefix_end:found.middle_end]))
                out.add(home, row, _HEAD_ROW, doc, found.units, found.form, *chars, None)
                for place, piece in enumerate(output_pieces(raw, found)):
                    if out.add(home, row, place, None, None, None, None, None, piece, weight=len(piece)):
                        yield out.batch()
        yield out.batch()

    return rows.mapInArrow(made, _PIECES)


def assembled(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """All outputs as pieces: documents whole within a partition, pieces in output order."""
    return pieces(docs, rule).repartition("home").sortWithinPartitions("row", "place")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from batch.slice(at, 256).to_pylist()


def _output_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest each output and hand its pieces on, each with the part of the text that it belongs to."""
    out, head, digest, part = _Rows(_PARTS), None, None, 0
    described = lambda: out.add(*head, digest.hexdigest(), _HEAD_ROW, None)
    for row in _streamed(batches):
        piece = row.pop("piece")
        if row["place"] == _HEAD_ROW:
            if head:
                described()
            head, digest, part = tuple(row.values()), hashlib.sha256(), 0
            form = row["form"]
            continue
        digest.update(piece)
        if form != PLAIN and piece in MARKERS:  # the text holds none, so a marker is one of ours
            part = MARKERS.index(piece)
        elif out.add(*row.values(), None, part, piece, weight=len(piece)):
            yield out.batch()
    if head:
        described()
    yield out.batch()


def _restored_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, head, digest = _Rows(_DIGESTS), None, None
    for row in _streamed(batches):
        if row["part"] != _HEAD_ROW:
            digest.update(row["piece"])
            continue
        if head and out.add(*head, digest.hexdigest()):
            yield out.batch()
        head = tuple(row[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"))
        digest = hashlib.sha256()
    if head:
        out.add(*head, digest.hexdigest())
    yield out.batch()


def digests(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per row of ``docs``: units, form, code points of prefix and middle, and the digests of the output and of
    the text restored from it."""
    parts = assembled(docs, rule).mapInArrow(_output_digests, _PARTS)
    return parts.sortWithinPartitions("row", "part", "place").mapInArrow(_restored_digests, _DIGESTS)


def transformed(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, form and output, the rearranged text, per row of ``docs``."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head, held = _Rows("doc_id bigint, form string, output string"), None, []
        for row in _streamed(batches):
            if row["place"] != _HEAD_ROW:
                held.append(row["piece"])
                continue
            text = b"".join(held).decode()
            if head and out.add(*head, text, weight=len(text)):
                yield out.batch()
            head, held = (row["doc_id"], row["form"]), []
        if head:
            out.add(*head, b"".join(held).decode())
        yield out.batch()

    return assembled(docs, rule).mapInArrow(joined, "doc_id bigint, form string, output string")


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents"))
