"""Spelling variants, fill-in-the-middle and SimHash groups against brute force and exact round trips."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from parceltide.llm import common, op11_spelling as op11, op12_infill as op12, op13_simhash as op13

CLASHING = "doc_id bigint, text string, row bigint, place bigint, fp bigint, bucket string, word string, n string, r string"


def documents(spark, sf_dir):
    return common.table(spark, sf_dir, "documents").select("doc_id", "text")


@pytest.fixture(scope="module")
def clashing(spark):
    """Rows with columns named like the operators' own."""
    texts = ["Grossartig grossartig grosartig \n" * 6, "Grossartig grossartig grosartig \n" * 6, "a<P>b\nc", None, "", "x\ny"]
    return spark.createDataFrame([(i, t, 7, 8, 9, "b", "w", "n", "r") for i, t in enumerate(texts)], CLASHING)


def pairs_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


# --- 11: spelling variants -------------------------------------------------------------------


def brute_variants(rows, least_chars=7, one_in=31):
    counts = Counter()
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for word in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if one_in and h % one_in == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if n >= 2 and len(w) >= least_chars}
    near, same = defaultdict(set), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            same[w[:i], w[i + 1:]].append(w)
            if w[:i] + w[i + 1:] in words:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for group in same.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    forms = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    forms = {w: f for w, f in forms.items() if words[f] >= 10 * words[w]}

    def root(w):
        while w in forms:
            w = forms[w]
        return w

    return Counter((w, forms.get(w), root(w), n, len(near[w]), words.get(forms.get(w))) for w, n in words.items())


def test_spelling_query(spark, sf_dir):
    want = brute_variants(pairs_of(documents(spark, sf_dir)))
    assert Counter(map(tuple, op11.op11_spelling(spark, sf_dir).collect())) == want


def test_spelling_edges(spark, odd_docs, no_docs, clashing):
    long = "ab" * 1500
    rows = [(1, f"{long}c {long}c"), (2, f"x{long}c {long[:-1]}c {long[:-1]}c x{long}c"), (None, "Été×rie123Été×rie"),
            (3, "ętrangely strangely strangely")]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string")
    for docs in (odd_docs, clashing, odd):
        for least in (1, 7):
            words = common.written(op11.vocabulary(docs, least), "vocabulary")
            got = op11.variants(words).collect()
            assert Counter(map(tuple, got)) == brute_variants(pairs_of(docs), least)
    assert op11.variants(common.written(op11.vocabulary(no_docs), "vocabulary")).count() == 0


def test_chain_of_forms(spark):
    chain = [("abcdefg", 1), ("abcdefgh", 10), ("abcdefghi", 100), ("abcdefghij", 1000), ("abcdefghijk", 10_000),
             ("zbcdefg", 1), ("abcdefx", 9), ("abcdefgf", 10)]
    words = spark.createDataFrame(chain, "word string, n bigint")
    got = {r["word"]: (r["form"], r["root"]) for r in op11.variants(words).collect()}
    assert got["abcdefg"] == ("abcdefgf", "abcdefgf")  # a tie goes to the smaller word
    assert got["abcdefgh"] == ("abcdefghi", "abcdefghijk") and got["abcdefx"] == (None, "abcdefx")


def test_neighbourhood_is_full():
    """Every word within one edit, once, for each alphabet."""
    rng = np.random.default_rng(3)
    for k in (2, 3, 5):
        for length in (1, 2, 5, 8):
            word = rng.integers(1, k + 1, length)
            edits = {tuple(word)}
            for i in range(length + 1):
                edits |= {(*word[:i], s, *word[i:]) for s in range(1, k + 1)}
                if i < length:
                    edits |= {(*word[:i], s, *word[i + 1:]) for s in range(1, k + 1)} | {(*word[:i], *word[i + 1:])}
            _, got = op11.neighbourhood(np.array([word], dtype=np.uint64), k)
            want = {int(op11.reduced_hash(np.array([e], dtype=np.uint64).reshape(1, -1))[0]) for e in edits}
            assert sorted(got.tolist()) == sorted(want)


def test_every_alphabet_gives_the_same_words(spark, sf_dir, monkeypatch):
    words = common.written(op11.vocabulary(documents(spark, sf_dir)), "vocabulary")
    results = []
    for k in (2, 5):
        monkeypatch.setattr(op11, "SYMBOLS", (k,))
        results.append(Counter(map(tuple, op11.variants(words).collect())))
    assert results[0] == results[1]


def test_runs_of_sliced_texts(monkeypatch):
    monkeypatch.setattr(op11, "SLICE", 5)
    text = "ab éééééééé abcdefghijklm ęabc  x"
    assert [r.decode() for r in op11.runs(text.encode(), 2)] == re.findall("[a-zà-ÿ]{2,}", text)


# --- 12: fill in the middle ------------------------------------------------------------------


def brute_infill(doc_id, text, rule=op12.Rule()):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    drawn = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rule.percent:
        return doc_id, len(units), "plain", None, None, text, text
    spm = h[3] % 100 < rule.spm_percent
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), "spm" if spm else "psm", len(prefix), len(middle), output, text


def digested(row):
    return (*row[:5], *(hashlib.sha256(x.encode()).hexdigest() for x in row[5:]))


@pytest.fixture(scope="module")
def long_lines(spark):
    rows = [(i, ("ä€\U0001F600" * 30_000 + "\n" + "short line\n" * 9000 + "end") * (1 + i % 2)) for i in range(4)]
    return spark.createDataFrame([*rows, (9, "\n\n\n"), (10, "no newline"), (11, "\n")] * 2, "doc_id bigint, text string")


def test_infill(spark, sf_dir, odd_docs, no_docs, clashing, long_lines):
    for docs in (documents(spark, sf_dir), odd_docs, clashing, long_lines):
        for rule in (op12.Rule(), op12.Rule(11, 60, 30)):
            rows = [brute_infill(*row, rule) for row in pairs_of(docs)]
            assert Counter(map(tuple, op12.digests(docs, rule).collect())) == Counter(map(digested, rows))
        texts = op12.transformed(docs).collect()
        assert Counter(map(tuple, texts)) == Counter((r[0], r[2], r[5]) for r in map(lambda x: brute_infill(*x), pairs_of(docs)))
    assert op12.digests(no_docs).count() == 0


def test_infill_query(spark, sf_dir):
    want = Counter(digested(brute_infill(*row)) for row in pairs_of(documents(spark, sf_dir)))
    assert Counter(map(tuple, op12.op12_infill(spark, sf_dir).collect())) == want


def test_infill_moves_texts_once(long_lines):
    plan = op12.digests(long_lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2


def test_pieces_are_bounded(long_lines):
    largest = op12.pieces(long_lines).agg(F.max(F.length("piece"))).first()[0]
    assert op12.CHUNK - 4 <= largest <= op12.CHUNK


# --- 13: SimHash -----------------------------------------------------------------------------


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """The index of the group's first member for each of a list of fingerprints."""
    values, parent = np.array(prints, dtype=np.uint64), list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1:]) <= 4):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def brute_simhash(rows):
    prints = [brute_fingerprint(text) for _, text in rows]
    groups, least = brute_groups(prints), {}
    for (doc_id, _), group in zip(rows, groups, strict=True):
        if doc_id is not None:
            least[group] = min(doc_id, least.get(group, doc_id))
    return Counter((doc_id, f"{p:016x}", least.get(g)) for (doc_id, _), p, g in zip(rows, prints, groups, strict=True))


def test_simhash(spark, sf_dir, odd_docs, no_docs, clashing):
    for docs in (documents(spark, sf_dir), odd_docs, clashing):
        assert Counter(map(tuple, op13.near_components(docs).collect())) == brute_simhash(pairs_of(docs))
    assert op13.near_components(no_docs).count() == 0


def test_simhash_query(spark, sf_dir):
    want = brute_simhash(pairs_of(documents(spark, sf_dir)))
    assert Counter(map(tuple, op13.op13_simhash(spark, sf_dir).collect())) == want


def _classes(spark, prints):
    rows = [(op13.signed(p), i) for i, p in enumerate(prints)]
    return common.written(spark.createDataFrame(rows, "fp bigint, least bigint"), "classes")


def _clouds(seed=5):
    """Fingerprints around a few centres, four to nine bits apart, and unrelated ones; some bits go together."""
    rng = np.random.default_rng(seed)
    found = {int(x) for x in rng.integers(0, 1 << 63, 200, dtype=np.uint64)} | {0, (1 << 64) - 1}
    centre = int(rng.integers(0, 1 << 63))
    for shift in (0, 0b11111, 0b111111 << 20):
        for _ in range(150):
            bits = rng.choice(64, rng.integers(0, 6), replace=False)
            found.add(centre ^ shift ^ sum(1 << int(b) for b in bits))
    return sorted(found)


@pytest.mark.parametrize("small,midpoints", [(2, 0), (64, 0), (2, 10_000), (64, 128)])
def test_large_buckets_lose_no_link(spark, monkeypatch, small, midpoints):
    monkeypatch.setattr(op13, "SMALL", small)
    monkeypatch.setattr(op13, "MIDPOINTS", midpoints)
    prints = _clouds()
    classes = _classes(spark, prints)
    parts = op13.choose_parts(classes, len(prints))
    named = {r["node"]: r["component"] for r in op13.linked(classes, parts).collect()}
    groups = defaultdict(set)
    for p in prints:
        groups[named.get(op13.signed(p), op13.signed(p))].add(p)
    want = defaultdict(set)
    for p, g in zip(prints, brute_groups(prints), strict=True):
        want[g].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("small,midpoints", [(2, 0), (64, 0), (2, 10_000), (64, 128)])
def test_large_buckets_lose_no_link_without_tiles(spark, monkeypatch, small, midpoints):
    monkeypatch.setattr(op13, "TILED", 0)
    test_large_buckets_lose_no_link(spark, monkeypatch, small, midpoints)


@pytest.mark.parametrize("tile", [16, 10_000])
def test_tiles_of_open_fingerprints_give_a_forest(spark, monkeypatch, tile):
    """As many links as fingerprints at most, however large a group is, and none is lost."""
    monkeypatch.setattr(op13, "TILE", tile)
    prints = _clouds(7)
    members = spark.createDataFrame([(op13.signed(p), op13.signed(p)) for p in prints], "fp bigint, component bigint")
    links = op13.tiled_links(members, len(prints), 4).collect()
    sides = max(1, -(-len(prints) // tile))
    assert len(links) < len(prints) * (sides + 1)
    group = {op13.signed(p): g for p, g in zip(prints, brute_groups(prints), strict=True)}
    assert all(group[r["a"]] == group[r["b"]] for r in links)
    assert len(op13.forest([r["a"] for r in links], [r["b"] for r in links])) == len(prints) - len(set(group.values()))


def test_an_empty_table_has_few_probes(spark):
    parts = op13.choose_parts(_classes(spark, [1]).filter("false"), 0)
    assert sum(len(part.flips()) for part in parts) < 100


def test_every_allocation_covers_all_pairs(spark):
    """Whatever thresholds are chosen, a pair at the limit meets in a bucket."""
    rng = np.random.default_rng(6)
    pairs = [(x := int(rng.integers(0, 1 << 63)), x ^ sum(1 << int(b) for b in rng.choice(64, 4, replace=False)))
             for _ in range(200)]
    classes = _classes(spark, sorted({x for pair in pairs for x in pair}))
    groups = {m: [tuple(range(64))[i::m] for i in range(m)] for m in range(2, 6)}
    share = np.full(64, 0.5)
    for m, split in groups.items():
        for agreeing in ([1.0] * m, [1e12, *[1.0] * (m - 1)], [1.0] * (m - 1) + [1e9]):
            _, thresholds = op13.allocate(agreeing, split, share, 1000, 4)
            assert sum(thresholds) == 4 - m + 1 and len(thresholds) == m
            parts = [op13.Part(g, t) for g, t in zip(split, thresholds, strict=True) if t >= 0]
            met = defaultdict(lambda: (set(), set()))
            for r in op13.first_buckets(classes, parts).collect():
                met[r["bucket"]][0 if r["own"] else 1].add(r["fp"])
            together = {frozenset((a, b)) for own, probes in met.values() for a in own for b in own | probes}
            assert all(frozenset(map(op13.signed, pair)) in together for pair in pairs)


def test_correlated_bits_share_a_part(spark):
    rng = np.random.default_rng(7)
    prints = set()
    for _ in range(400):
        x = int(rng.integers(0, 1 << 63)) & ~(0xFF << 8)
        prints.add(x | (0xFF << 8 if x & 1 else 0))  # bits 8 to 15 follow bit 0
    both = op13.moments(_classes(spark, sorted(prints)))
    assert both[0, 8] == both[8, 8] == sum(p & 1 for p in prints)
    groups = op13.correlated_groups(both, len(prints), 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({0, *range(8, 16)} <= set(g) for g in groups)


def test_skewed_parts_get_lower_thresholds():
    split = [tuple(range(32)), tuple(range(32, 64))]
    cost, thresholds = op13.allocate([1e15, 10.0], split, np.full(64, 0.5), 10 ** 7, 4)
    assert thresholds[0] < thresholds[1] and sum(thresholds) == 3
