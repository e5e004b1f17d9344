"""Every operator against a brute-force version, SQL, planted cases or held-out accuracy."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import differences, duckdb_views
from pyspark.sql import functions as F

import corpus_pipeline
from parceltide.llm import (
    op1_licenses as op1, op2_secrets as op2, op3_neighbours as op3, op4_jaccard as op4, op5_mixing as op5,
    op6_decontaminate as op6, op7_shards as op7, op8_warc as op8, op9_toxicity as op9, op10_extract as op10,
    common, license_rules as rules_of_licenses, registry)


def documents(spark, sf_dir):
    return common.table(spark, sf_dir, "documents")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, sf_dir, name):
    sql = registry.oracle_sql()[name]
    assert differences(registry.queries()[name](spark, sf_dir), duckdb_views(sf_dir), sql) == []


# --- 1: licenses -----------------------------------------------------------------------------


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"),
                                              ("general public license", "gpl"))
             for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in found]
    return (len(words), len(found), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in found})))


def test_licenses(spark, sf_dir, odd_docs):
    for docs in (documents(spark, sf_dir), odd_docs):
        want = Counter((r["doc_id"], *brute_base(r["text"])) for r in docs.collect())
        got = op1.scan_licenses(docs).collect()
        assert Counter(tuple(r)[:6] for r in got) == want
        assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"]
                   for r in got)
        assert all(0 <= r["score"] <= 1 for r in got)


def test_license_suppression():
    scan = op1.Scanner().scan
    assert scan(b"GNU Lesser General Public License, version 2.1")[5] == "gpl,lgpl-2.1"
    assert scan(b"Licensed under CC BY-NC 4.0.")[5] == "cc-by-nc-4.0"
    assert scan(b"mit Lizenz")[5] == ""


def test_license_gate_loses_no_match():
    rules = rules_of_licenses.build_rules()
    gated = op1.Scanner(rules)
    for text, label in (("without express written consent of the owner", "proprietary"),
                        ("for non commercial use only", "no-commercial"), ("PSF License", "psf-2.0"),
                        ("for noncommercial purposes only", "no-commercial"),
                        ("released under the PSF licence", "psf-2.0")):
        assert gated.scan(text.encode())[5] == label, text
    texts = set()
    for pattern in {r[2] for r in (*rules_of_licenses.TEXTS, *rules_of_licenses.LICENSES)}:
        for form in rules_of_licenses.forms(re._parser.parse(pattern)):
            form = form.replace("\0", "7")
            texts |= {form, f"licensed under the {form}"}
    for rule in rules:  # with the gate off a rule is tried on every text
        for text in texts:
            assert rule.keywords <= set(text.encode().split()) or not rule.pattern.search(text.encode()), (rule, text)
    with pytest.raises(ValueError, match="prior"):
        rules_of_licenses._require("prior written", r"without (?:prior )*written consent")


# --- 2: secrets ------------------------------------------------------------------------------


def brute_secrets(text):
    found = sorted((m.start(), k, m.end()) for k, r in enumerate(op2.RULES)
                   for m in re.finditer(r.pattern, text or "", re.ASCII) if len(m[r.group]) >= r.least)
    join = lambda f: ",".join(f"{op2.RULES[k].kind}:{a}:{b}" for a, k, b in f)
    base = [x for x in found if x[1] < 3]
    return (*(sum(x[1] == k for x in found) for k in range(3)), hashlib.sha256(join(base).encode()).hexdigest(),
            join(found))


def test_secrets(spark, sf_dir, odd_docs, folder):
    odd_docs.write.parquet(f"{folder}/documents.parquet")
    for where in (sf_dir, folder):
        want = Counter((r["doc_id"], *brute_secrets(r["text"])) for r in documents(spark, where).collect())
        assert Counter(map(tuple, op2.op2_secrets(spark, where).collect())) == want


def test_trigram_queries():
    assert op2.trigram_query(r"(?i)(token|api_?key)=") and all(op2.trigram_query(r"(?i)(token|api_?key)="))
    assert not all(op2.trigram_query(r"[0-9a-f]{24,}"))
    for rule in op2.RULES:  # the query never misses a match
        for match in ("token = abcdefgh", "AKIA" + "A" * 16, "sk_live_" + "a1" * 12, "https://bob:pass12@host"):
            if re.search(rule.pattern, match):
                assert any(all(t in match.lower() for t in terms) for terms in op2.trigram_query(rule.pattern))


# --- 3: neighbours ---------------------------------------------------------------------------


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (1, [1.0, 0.0]), (2, [1.0, 0.0]),
            (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [0.5, 0.5]), (7, [1.0, 0.0, 0.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = op3.search(vectors, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1.0), (0, 2, 1.0), (0, 6, 0.5)]
    assert op3.search(vectors.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


def brute_neighbours(rows, k, every=20):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)}
    best = defaultdict(dict)
    for q, x in good:
        for c, y in good:
            if q % every == 0 and c != q and len(x) == len(y):
                score = 0.0
                for a, b in zip(x, y, strict=True):
                    score += a * b
                best[q][c] = max(best[q].get(c, -np.inf), score)
    return {(q, n + 1, c, score) for q, found in best.items()
            for n, (c, score) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k])}


def test_neighbours_of_repeated_ids(spark):
    """All vectors of an id count, and it is found once; a full list of one id's rows hides no other id."""
    rows = [(1, [0.5, 0.5]), (1, [0.9, 0.1]), (0, [1.0, 0.0]), *((7, [0.8 + i / 1000, 0.0]) for i in range(50)), (8, [0.1, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    rows += [(9, [1e300, 1e300]), (20, [1e300, 1e-320]), (30, [1e-320, 0.0])]  # products that overflow or vanish
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for k in (2, 3, 20):
        got = op3.search(vectors, F.col("vec_id") % 20 == 0, k).collect()
        assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == brute_neighbours(rows, k)


def test_neighbours_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(op3, "BLOCK_ROWS", 16)
    monkeypatch.setattr(op3, "QUERY_ROWS", 8)
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 150)), [float(x) for x in rng.normal(size=int(d)) * 10.0 ** rng.integers(-3, 4)])
            for d in rng.choice([1, 3, 5], 260)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    got = op3.search(vectors, F.col("vec_id") % 20 == 0, 7).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == brute_neighbours(rows, 7)


def test_neighbour_tiles_use_codes_only_and_more_tasks_than_query_blocks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(op3, "BLOCK_ROWS", 64)
    rows = common.written(op3.usable(common.table(spark, sf_dir, "embeddings")).withColumn(
        "row", F.monotonically_increasing_id()), "vectors")
    candidates = common.written(op3.blocks(rows, 64), "blocks")
    queries = common.written(op3.blocks(rows.filter("vec_id % 20 = 0").coalesce(1), 1024), "queries")
    grid = op3.grid(queries, candidates, candidates.count())
    assert queries.count() == 1 and grid.select("g").distinct().count() > 1
    assert grid.count() == candidates.count()  # every candidate block meets the query block once
    dim = candidates.first()["dim"]
    assert all(len(r["codes"]) == len(r["ids"]) // 8 * dim for r in candidates.collect())  # a byte a component


def test_pairs_that_leave_the_tiles_do_not_grow_with_copies_or_blocks(spark, folder, monkeypatch):
    monkeypatch.setattr(op3, "BLOCK_ROWS", 16)
    seen = []
    real = common.written
    monkeypatch.setattr(common, "written", lambda df, name: (out := real(df, name), seen.append((name, out)))[0])
    rng = np.random.default_rng(11)
    rows = [(i, [1.0, 0.5, 0.25]) for i in range(400)] + [
        (i, [float(x) for x in rng.normal(size=3)]) for i in range(400, 1200)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(1)
    got = op3.search(vectors, F.col("vec_id") % 20 == 0, 5).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == brute_neighbours(rows, 5)
    pairs = next(df for name, df in seen if name == "near-pairs")
    # Sixty queries, of which twenty have 399 copies, in one share and as many groups as keep eight cores busy.
    assert pairs.count() < 60 * 16 * 2 * 6


def test_products_of_codes_are_exact():
    rng = np.random.default_rng(5)
    for dim in (3, op3.EXACT_DIMS, 3 * op3.EXACT_DIMS + 1):
        q, c = (rng.choice([-127, 127], (4, dim)).astype(np.int8) for _ in range(2))
        q[0] = c[0] = 127
        assert (op3.products(q, c) == q.astype(np.int64) @ c.astype(np.int64).T).all()


# --- 4: Jaccard ------------------------------------------------------------------------------


def brute_components(rows):
    sets = [op4.word_shingles((t or "").encode()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, found in enumerate(sets):
        shared = Counter(j for g in found for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= 90 * (len(found) + len(sets[j]) - n):
                parent[max(find(i), find(j))] = min(find(i), find(j))
        for g in found:
            holders[g].append(i)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return Counter((rows[i][0], len(sets[i]), min((d for d in least[find(i)] if d is not None), default=None))
                   for i in range(len(rows)))


def test_jaccard(spark, sf_dir, odd_docs, no_docs):
    for docs in (documents(spark, sf_dir), odd_docs):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        got = op4.join_components(docs).select("doc_id", "n_shingles", "component_id").collect()
        assert Counter(map(tuple, got)) == brute_components(rows)
    assert op4.join_components(no_docs).count() == 0


def test_sharp_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(11)
    for n in (1, 5, 63, 64, 1000, 3000):
        x = np.unique(rng.integers(1, 1 << 62, n, dtype=np.uint64))
        for m in (0, n // 9, n // 3, 2 * n):
            y = np.unique(np.concatenate((x[m:], rng.integers(1, 1 << 62, m, dtype=np.uint64))))
            if len(y):
                apart = len(np.setxor1d(x, y))
                distance = op4.sketch_distance(op4.sharp_sketch(x), op4.sharp_sketch(y))
                assert distance <= apart and (2 * distance >= apart or apart > n)


def crowded(spark):
    """A large group of near copies, some just out of reach of each other, and a passage that many texts share."""
    rng = np.random.default_rng(9)
    word = lambda: f"w{rng.integers(0, 10 ** 6)}"
    base, passage = [word() for _ in range(90)], [word() for _ in range(25)]
    rows = []
    for n in range(140):
        text = list(base)
        for at in rng.choice(len(base), int(rng.integers(0, 6)), replace=False):
            text[at] = word()
        rows.append((n, " ".join(text)))
    for n in range(80):
        rows.append((200 + n, " ".join([*(word() for _ in range(int(rng.integers(3, 30)))), *passage])))
    return spark.createDataFrame(rows * 2, "doc_id bigint, text string")


@pytest.mark.parametrize("like", [op4.QUERY, op4.Likeness(5, 80)])
@pytest.mark.parametrize("first", [0, 8])
def test_open_buckets_lose_no_link(spark, monkeypatch, like, first):
    monkeypatch.setattr(op4, "FIRST_BUCKETS", max(first, 1))
    docs = crowded(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = [op4.word_shingles(t.encode(), like) for _, t in rows]
    least = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if 100 * shared >= like.percent * (len(a) + len(sets[j]) - shared) and least[i] != least[j]:
                old, new = max(least[i], least[j]), min(least[i], least[j])
                least = [new if x == old else x for x in least]
    want = Counter((doc_id, len(found), rows[g][0]) for (doc_id, _), found, g in zip(rows, sets, least, strict=True))
    assert 5 < len({g for *_, g in want}) < 215  # neither all apart nor all together
    got = op4.join_components(docs, like).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == want


def test_no_linked_pair_misses_a_bucket():
    """The pigeonhole holds for every split: pairs just at the threshold always meet."""
    rng = np.random.default_rng(1)
    for deletions in (0, 1):
        for size in (9, 12, 18, 19, 40, 90, 200):
            for _ in range(20):
                y = np.unique(rng.integers(1, 1 << 62, size, dtype=np.uint64))
                gone = rng.permutation(len(y))[: len(y) // 10]
                x = np.delete(y, gone)
                if 100 * len(x) < 90 * len(y):
                    continue
                bands = [op4.allocate(i, low, high, 10) for i, (low, high) in enumerate(op4.band_edges(400))]
                if deletions:
                    bands = [b._replace(segments=b.segments - 1, deletions=1) if b.segments > 1 else b for b in bands]
                (bx, rx), (by, ry) = op4.entries(x, bands), op4.entries(y, bands)
                met = any((p | q) & 3 == 3 for a, p in zip(bx.tolist(), rx.tolist(), strict=True)
                          for b, q in zip(by.tolist(), ry.tolist(), strict=True) if a == b)
                assert met, (size, deletions)


def test_one_of_each(odd_docs):
    kept = op4.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        [(False, d) for d in (1, 4, 5, 6, 8, 9, -1, 3)] + [(True, 0)]
        if brute_components([(1, _text(odd_docs, 1)), (3, _text(odd_docs, 3))])[(3, 58, 3)] else
        [(False, d) for d in (1, 4, 5, 6, 8, 9, -1)] + [(True, 0)])


def test_one_of_each_takes_a_likeness(spark, sf_dir):
    """Five words and 0.8: near copies that three words and 0.9 do not link."""
    rng = np.random.default_rng(4)
    like = corpus_pipeline.NEAR
    assert like == (5, 80)
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, sf_dir).collect()]
    for at in range(60):
        n = int(rng.integers(4, 400))
        words = [f"p{at}w{i}" for i in range(n)]
        edited = list(words)
        for i in rng.integers(0, n, max(1, n // 50)):
            edited[i] = "other"
        longer = words + [f"p{at}x{i}" for i in range(int(rng.integers(1, n // 3 + 2)))]
        rows += [(10_000 + 3 * at + k, " ".join(w)) for k, w in enumerate((words, edited, longer))]
    rows += [(20_000, " ".join(f"l{i}" for i in range(1000))), (20_001, " ".join(f"l{i}" for i in range(1150)))]
    sets = [op4.word_shingles((t or "").encode(), like) for _, t in rows]
    group, holders = list(range(len(rows))), defaultdict(list)
    for i, found in enumerate(sets):
        for j, n in Counter(j for g in found for j in holders[g]).items():
            if 100 * n >= 80 * (len(found) + len(sets[j]) - n):
                group = [group[i] if g == group[j] else g for g in group]
        for g in found:
            holders[g].append(i)
    want = {min(rows[j][0] for j in range(len(rows)) if group[j] == g) for g in set(group)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()]
    assert sorted(got) == sorted(want) and 20_000 in want and 20_001 not in want
    assert {20_000, 20_001} < {r["doc_id"] for r in op4.one_of_each(docs).collect()}


def test_no_linked_pair_at_a_lower_threshold_misses_a_bucket():
    rng = np.random.default_rng(5)
    like = op4.Likeness(5, 80)
    assert (like.least_size, like.most_apart(100), op4.QUERY.least_size) == (4, 25, 9)
    for sets in (10, 100_000):
        bands = [op4.allocate(i, low, high, sets, like) for i, (low, high) in enumerate(op4.band_edges(400, like))]
        for size in (4, 5, 6, 9, 20, 37, 90, 200):
            for _ in range(20):
                y = np.unique(rng.integers(1, 1 << 62, size, dtype=np.uint64))
                x = np.delete(y, rng.permutation(size)[:size // 5])
                z = np.concatenate((np.delete(y, rng.permutation(size)[:size // 9]),
                                    rng.integers(1, 1 << 62, size // 9, dtype=np.uint64)))
                for other in (x, np.unique(z)):
                    shared = len(np.intersect1d(other, y))
                    if 100 * shared < 80 * (len(other) + len(y) - shared):
                        continue
                    frequent = np.sort(y[::3])
                    met = [op4.prefix_entries(v, frequent, np.arange(len(frequent)), like)[0] for v in (other, y)]
                    assert len(np.intersect1d(*met)), size
                    (bx, rx), (by, ry) = op4.entries(other, bands, like), op4.entries(y, bands, like)
                    assert any((p | q) & 3 == 3 for a, p in zip(bx.tolist(), rx.tolist(), strict=True)
                               for b, q in zip(by.tolist(), ry.tolist(), strict=True) if a == b), (sets, size)


def _text(docs, doc_id):
    return docs.filter(F.col("doc_id") == doc_id).first()["text"]


# --- 5: mixing -------------------------------------------------------------------------------


def test_mixing_edges(odd_docs, no_docs):
    got = op5.mixed_documents(odd_docs)
    assert got.columns == odd_docs.columns
    assert {r["doc_id"] for r in got.collect()}.isdisjoint({4, 5, 6})
    assert op5.mixed(no_docs).count() == 0


def test_mixing_keeps_to_budget(spark, sf_dir):
    mix = op5.Mix()
    total = op5.digest(documents(spark, sf_dir)).agg(F.sum("n_tokens")).first()[0]
    taken = op5.mixed(documents(spark, sf_dir)).agg(F.sum(F.col("n_tokens") * F.col("copies"))).first()[0]
    assert 0 < taken <= total * mix.budget_percent / 100


# --- 6: decontamination ----------------------------------------------------------------------


def test_decontamination(spark, odd_docs, no_docs):
    words = [f"w{i}" for i in range(40)]
    changed = [("x" if i % 6 == 5 else w) for i, w in enumerate(words)]
    docs = odd_docs.union(spark.createDataFrame([
        (101, "before " + " ".join(words).upper() + " after", "", "", 0, "", ""),
        (102, "before " + ",\n".join(changed) + " after", "", "", 0, "", ""),
        (103, " ".join(words[:6]) + " only the start", "", "", 0, "", "")], odd_docs.schema))
    items = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "a b"), (4, "x1 x2 x3 x4 x5 x6")],
                                  "item_id bigint, text string")
    pairs = {(r["doc_id"], r["item_id"]): r["n_matches"] for r in op6.contaminated_pairs(docs, items).collect()}
    assert set(pairs) == {(101, 1), (102, 1)} and pairs[101, 1] == 40 and pairs[102, 1] >= 30
    kept = op6.clean_documents(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert op6.contaminated_pairs(no_docs, items).count() == 0
    assert op6.contaminated_pairs(docs, items.filter("false")).count() == 0


@pytest.mark.parametrize("n", [5, 6, 7, 8, 9])
def test_short_items_with_one_word_changed(n):
    words = [f"w{i}" for i in range(n)]
    block = op6.Block([(1, op6.words_of(" ".join(words)).tobytes())])
    for at in range(n):
        changed = " ".join([*words[:at], "x", *words[at + 1:]])
        for text in (changed, f"before {changed} after"):
            assert [(f[0], f[2], f[6]) for f in block.overlaps(op6.words_of(text))] == [(1, n - 1, n)], (at, text)
    for gone in ((0, 2), (1, 3), (0, 4)):
        two = " ".join("x" if i in gone else w for i, w in enumerate(words))
        assert block.overlaps(op6.words_of(f"before {two} after")) == []


def test_blocks_give_the_same_pairs(spark, sf_dir, monkeypatch):
    tables = [common.table(spark, sf_dir, n) for n in ("documents", "benchmark")]
    whole = Counter(map(tuple, op6.contaminated_pairs(*tables).collect()))
    monkeypatch.setattr(op6, "BLOCK_WORDS", 700)
    assert Counter(map(tuple, op6.contaminated_pairs(*tables).collect())) == whole and whole


# --- 7: shards -------------------------------------------------------------------------------


def test_shards(spark, sf_dir, odd_docs, no_docs):
    for docs in (documents(spark, sf_dir), odd_docs):
        got = op7.shard_rows(docs, partition_rows=50).collect()
        slots = defaultdict(list)
        for r in got:
            slots[int(r["shard"])].append(r["slot"])
        sizes = [len(slots[s]) for s in range(op7.SHARDS)]
        assert sum(sizes) == docs.count() and max(sizes) - min(sizes) <= 1
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert op7.shard_rows(no_docs).count() == 0


OWN_NAMES = ["_k1", "_k2", "_k3", "_p", "_ends", "_at", "_cell", "_i", "_n", "_before", "Domain", "leaf_LANG", "copies",
             "cell", "key", "size", "Text_md5", "_own_0", "SHARD"]


def test_columns_named_like_the_operators_own_keep_their_values(odd_docs):
    names = [*OWN_NAMES, *[c for c in odd_docs.columns if c != "shard"]]
    docs = odd_docs.select(*[F.lit(f"<{c}>").alias(c) for c in OWN_NAMES], *names[len(OWN_NAMES):])
    for got in (op7.shard_rows(docs), op5.mixed_documents(docs), op4.one_of_each(docs)):
        kept = [c for c in OWN_NAMES if c in got.columns]
        assert [c for c in got.columns if c in names] == [c for c in names if c != "SHARD" or c in got.columns]
        rows = got.select(*[F.col(f"`{c}`") for c in kept]).collect()
        assert rows and all(r[c] == f"<{c}>" for r in rows for c in kept)


def test_communication_matrix():
    rows = [7, 0, 100, 13]
    matrix = op7.communication_matrix(rows, 40, 1)
    assert matrix.sum(axis=1).tolist() == rows and set(matrix.sum(axis=0)) == {3}


# --- 8: WARC ---------------------------------------------------------------------------------


def test_warc_revisits(spark, folder):
    rows = [(3, "http://a/x?q", "same"), (1, "http://b/", "same"), (2, None, "same"), (4, "u\r\nv", None), (5, "", ""),
            (6, "http://a", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n"), (6, "http://a", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n"),
            (None, "http://n", "same")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    op8.write_archives(pages, f"{folder}/warc")
    captures = op8.assemble(op8.read_records(spark, f"{folder}/warc"))
    got = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"])
                  for r in op8.captures_digest(captures).collect())
    assert got == Counter([(1, 4, "response", None), (2, 4, "revisit", 1), (3, 4, "revisit", 1), (None, 4, "revisit", 1),
                           (4, 0, "response", None), (5, 0, "revisit", 4), (6, 33, "response", None),
                           (6, 33, "response", None)])
    bodies = {bytes(r["record"]["block"]).partition(b"\r\n\r\n")[2].decode()
              for r in captures.filter("record.kind = 'response'").collect()}
    assert bodies == {"same", "", rows[5][2]}


# --- 9: toxicity -----------------------------------------------------------------------------


def test_grammar():
    scorer = op9.Scorer({"idiot": (20.0, 0.0)}, 0.1, dict(op9.WEIGHTS))
    plain, negated, quoted = (scorer.score(t) for t in ("What an idiot.", "Not an idiot.", "He said what an idiot."))
    assert plain > quoted > negated > op9.FLOOR and plain > 0.9
    assert scorer.score("I will kill you.") > 0.8 and scorer.score("I kill time.") == pytest.approx(op9.FLOOR)
    assert scorer.score("") == op9.FLOOR


def test_toxicity(spark, odd_docs, no_docs):
    where = "/root/testdata/sf0.1"
    labels = common.table(spark, where, "labels")
    rows = op9.op9_toxicity(spark, where).filter("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit / sum(r["toxic"] for r in rows) > 0.85 and hit / sum(r["predicted"] for r in rows) > 0.85
    got = op9.rate_toxicity(odd_docs, labels.filter("false")).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert op9.rate_toxicity(no_docs, labels).count() == 0


# --- 10: extraction --------------------------------------------------------------------------


def test_extraction(spark):
    page = "<html><body><nav><a>Menu</a></nav><div>Welcome to us</div><p>{}</p><p>Bye all</p></body></html>"
    rows = [(1, "http://h/a/1", page.format("First &amp; only<br>text")), (2, "http://h/a/2", page.format("Second\n  text")),
            (3, "http://other/", page.format("Alone")), (4, None, None), (5, "http://h/b", ""),
            (6, "http://h/c", "<header>H</header><article><h1>T</h1><p>A &lt; B<script>x('</p>')</script>"
             "<div class='ad'>buy</div><section id=\"comments\">me too</section></article><footer>F</footer>"),
            (1, "http://h/a/1", page.format("First &amp; only<br>text"))]
    got = op10.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert Counter((r["page_id"], r["text"]) for r in got) == Counter({
        (1, "First & only text"): 2, (2, "Second text"): 1, (3, "Welcome to us Alone Bye all"): 1, (4, ""): 1,
        (5, ""): 1, (6, "T A < B"): 1})
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_shared_lines_decide_inside_articles(spark):
    notice = "<div>We have moved to a new address</div>"
    page = "<nav>Menu</nav><main>" + notice + "<p>{}</p><p>{}</p></main>"
    body = ["one body of some length, number {0}, and no other page has {0}".format(i) for i in range(5)]
    passage = "a passage that two of the articles share, which is their text"
    rows = [(i, f"http://h/a/{i}", page.format(t, passage if i < 2 else f"end {i}")) for i, t in enumerate(body)]
    rows += [(10 + i, f"http://copies/{i}", page.format(body[0], passage)) for i in range(4)]
    rows += [(20 + i, f"http://two/{i}", page.format(body[i], "end")) for i in range(2)]
    got = {r["page_id"]: r["text"] for r in op10.extract(
        spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    want = {i: f"{t} {passage if i < 2 else f'end {i}'}" for i, t in enumerate(body)}
    whole = "We have moved to a new address "
    want |= {10 + i: f"{whole}{body[0]} {passage}" for i in range(4)}  # copies keep their text
    want |= {20 + i: f"{whole}{body[i]} end" for i in range(2)}  # two pages are no evidence
    assert got == want


@pytest.mark.parametrize("wrapper", [
    "div class='content-sidebar-wrap'", "div class='site no-sidebar'", "div class='layout has-sidebar'", "form", "div class='header'"])
def test_articles_inside_named_wrappers_are_text(wrapper):
    def text(html):
        return op10.main_text(op10.page_lines(html), None)

    end = wrapper.split()[0]
    for tag in ("article", "main"):
        body = f"<{tag}><p>The text</p><div class='comments'><article>me too</article></div></{tag}>"
        aside = "<div class='sidebar'>links<article>teaser</article></div><div class='related'><article>other</article></div>"
        for page in (f"<{wrapper}>menu {body}</{end}><nav>x</nav>", f"<{wrapper}><p>lead</p>{body}<nav>x</nav></{end}>"):
            assert text(page) == "The text"
        if end == "div" and "header" not in wrapper:
            assert text(f"<{wrapper}>{body}{aside}</{end}>") == "The text"
    if wrapper != "div class='header'":  # most of a page without articles
        assert text(f"<p>few</p><{wrapper}><p>Most of the page</p><div class='sidebar'>x</div></{end}>") == "few Most of the page"
        assert text(f"<p>Most of the page</p><{wrapper}><p>few</p></{end}>") == "Most of the page"


def test_common_subsequence():
    def plain(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (rng.integers(0, 5, rng.integers(0, 12)).tolist() for _ in range(2))
        found = op10.common_subsequence(a, b)
        assert found == sorted(found) and len(found) == plain(a, b)


# --- the pipeline ----------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.written(stage(spark, docs, sf_dir), name)
        if name != "sharding":
            assert docs.columns == before.columns
        if name != "mixing":
            assert 0 < docs.count() <= before.count()
    assert {"shard", "slot"} <= set(docs.columns)
