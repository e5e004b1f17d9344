"""Lines repeated on a host are counted over all of its pages."""

from parceltide.llm import op10_extract as op10


def test_every_page_of_a_host_counts(spark):
    """40 pages: a line on 30 of them is repeated, one on 29 is not; two pages are too few."""
    rows = [(n, 1, [100 + n, *([1, 1] if n < 30 else []), *([2] if n < 29 else [])]) for n in range(40)]
    rows += [(50 + n, 2, [3]) for n in range(2)]
    lines = spark.createDataFrame(rows, "partner_key bigint, host bigint, partner array<bigint>")
    assert [tuple(r) for r in op10.repeated_lines(lines).collect()] == [(1, [1])]
