"""Exact and near duplicates, and fingerprints, against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from endweave.llm import fingerprints as fp
from endweave.llm import signature_tree
from endweave.llm.components import components
from endweave.llm.exact_dedup import exact_dedup
from endweave.llm.jaccard_join import jaccard_components
from endweave.llm.wordhash import shingle_sets

#: Extra columns with the names of columns inside the operators.
CLASH = ("id", "n", "h", "part", "norm", "node", "token", "fp", "label", "size", "b", "source_size", "words", "rank", "bucket")


def clashing(df):
    return df.withColumns({c: F.lit(7) for c in CLASH if c not in df.columns})


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


ODD = [(1, "a b"), (2, "a  b"), (3, None), (4, ""), (5, "A b"), (None, "a\tb"), (2, "a b"), (6, "é x"), (7, "x" * 50_000), (None, "only")]


def test_exact_dedup(spark):
    random.seed(1)
    rows = ODD + [(i, random.choice(["p q", "p  q", "r s t", f"u{i % 40}"])) for i in range(100, 500)]
    for df in (docs(spark, rows), clashing(docs(spark, rows).repartition(5))):
        got = exact_dedup(df).collect()
        assert len(got) == len(rows)
        groups = {}
        for i, t in rows:
            groups.setdefault(norm(t), []).append(i)
        for r in got:
            key = next(k for k in groups if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
            ids = [i for i in groups[key] if i is not None]
            assert r.group_size == len(groups[key]) and r.keep_id == min(ids, default=None)
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.keep_id == r.doc_id for r in got if r.kept)
    assert exact_dedup(docs(spark, [])).collect() == []


def brute_components(rows, k, percent):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    least = [i for i, _ in rows]
    moved = True
    while moved:
        moved = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and least[b] < least[a]:
                    least[a], moved = least[b], True
    return {i: (len(s), c) for (i, _), s, c in zip(rows, sets, least, strict=True)}


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 70)])
def test_jaccard_join(spark, k, percent):
    rng, rows = random.Random(k), []
    for family in range(25):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 70))]
        for _ in range(rng.randrange(1, 7)):
            w = list(base)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w) if family % 3 else " ".join(w).title()))
    rows += [(900, None), (901, ""), (902, "one"), (903, "ONE"), (904, "one two")]
    want = brute_components(rows, k, percent)
    for df in (docs(spark, rows), clashing(docs(spark, rows)).repartition(7)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, k=k, percent=percent).collect()}
        assert got == want


def test_jaccard_join_odd_rows(spark):
    got = jaccard_components(docs(spark, [(1, None), (None, "a b"), (4, "A  b"), (4, "A  b"), (None, None), (9, "zz")])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 0, 0), (0, 1, 4), (1, 0, 1), (4, 1, 4), (4, 1, 4), (9, 1, 9)]
    assert jaccard_components(docs(spark, [])).collect() == []


def test_jaccard_join_in_small_blocks(spark, monkeypatch):
    """A large neighbourhood is dealt to blocks without losing a link."""
    from endweave.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(spark, rows), k=1, percent=95).collect()}
    assert got == brute_components(rows, 1, 95)


def test_jaccard_join_of_clusters_apart(spark, monkeypatch):
    """Clusters of several blocks that only some members join, and frequent tokens."""
    from endweave.llm import jaccard_join

    for name, value in (("BLOCK_ROWS", 4), ("HOT_SAMPLE", 1), ("HOT_LEAST", 3), ("HOT_SHARE", 10**6)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = []
    for i in range(45):  # a chain: only neighbours link, and here and there a step is missing
        w = [f"w{j}" for j in range(2 * i + 3 * (i > 30), 2 * i + 3 * (i > 30) + 40)]
        rows += [((i * 17) % 45, " ".join(w)), (100 + i, " ".join([*w[:-1], f"x{i}"]))]
    for percent in (88, 90, 95):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(spark, rows), k=1, percent=percent).collect()}
        assert got == brute_components(rows, 1, percent)


def test_jaccard_join_of_long_texts(spark):
    long = [f"w{i * 7919 % 50_021}" for i in range(50_000)]
    rows = [(1, " ".join(long)), (2, " ".join([*long[:49_000], "a", "b"])), (3, " ".join(long[:30_000])), (4, "short")]
    got = {r.doc_id: r.component_id for r in jaccard_components(docs(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_signature_tree_with_shared_bits(monkeypatch):
    rng = np.random.default_rng(2)
    for width in (64, 1 << 16):
        monkeypatch.setattr(signature_tree, "WIDTH", width)
        base = [rng.integers(0, 2**60, n).astype(np.uint64) for n in (5, 40, 90)]
        sets = []
        for _ in range(90):
            b = base[rng.integers(3)].copy()
            b[rng.integers(0, len(b), rng.integers(0, 5))] = rng.integers(0, 2**60)
            sets.append(np.unique(b))
        got = signature_tree.linked(sets, np.zeros(90, dtype=int), 80)
        want = np.arange(90)
        for i in range(90):
            for j in range(i + 1, 90):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    want[want == max(want[i], want[j])] = min(want[i], want[j])
        assert (got == want).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 70), (70, 60), (5, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 60: 60, 70: 60, 100: 60}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_by_stars_and_at_once(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(9, i) for i in range(500, 700)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(7)
    at_once, by_stars = ({r.node: r.label for r in components(df, few=n).collect()} for n in (10**6, 0))
    assert at_once == by_stars
    for u, v in edges:
        assert u == v or at_once[u] == at_once[v] <= min(u, v)


def test_shingles_count_like_regex():
    texts = ["A b C a b c", "", None, " x ", "é ü b\x0bc d\x1ce"]
    got = {i: len(v) for i, v in shingle_sets(pa.array(texts), 2)}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        assert got[i] == (len({tuple(w[j : j + 2]) for j in range(max(1, len(w) - 1))}) if w else 0)


def test_fingerprints(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(rng.randrange(1, 400)))) for i in range(80)]
    rows += [(80, rows[0][1]), (81, None), (82, ""), (83, "é" * 9), (None, "null id")]
    rows += [(2**62, "far away"), (-(2**62), "far below"), (2**62 + 1, "x " * 100_000)]
    want = sorted(((i is not None, i or 0, t or "", i) for i, t in rows))
    for df in (docs(spark, rows), clashing(docs(spark, rows).repartition(6))):
        got = {(r.doc_id, r.edited_sha256): r for r in fp.fingerprint_edits(df).collect()}
        assert len(got) == len(rows)
        for at, (_, _, text, i) in enumerate(want):
            after = want[(at + 1) % len(want)][2]
            half = len(text) // 2
            new = text[: len(text) - half] + after[:half]
            r = got[(i, hashlib.sha256(new.encode()).hexdigest())]
            own, changed = fp.low_bits(pa.array([text])), fp.low_bits(pa.array([new]))
            assert r.n_chars == len(text)
            assert (r.fingerprint, r.edited_fingerprint) == (fp.packed(own[0][0], own[1][0]), fp.packed(changed[0][0], changed[1][0]))
            assert abs(r.near_edited - fp.fingerprint_similarity(r.fingerprint, r.edited_fingerprint)) < 1e-12
    assert fp.fingerprint_edits(docs(spark, [])).collect() == []
    (alone,) = fp.fingerprint_edits(docs(spark, [(1, "a b c")])).collect()
    assert alone.near_next == 1.0


def test_ranges_hold_equal_numbers(spark):
    """A sentinel id, and an id that holds a third of all rows, leave no range with too many rows."""
    rows = [(i, f"t {i}") for i in range(1000)] + [(2**62, "end")] + [(None, f"null {i}") for i in range(500)]
    placed = fp.with_next(docs(spark, rows).repartition(3)).filter("not ahead").groupBy("bucket").count().collect()
    assert sum(r["count"] for r in placed) == len(rows) and max(r["count"] for r in placed) < 4 * len(rows) / len(placed)
    spark_rows = fp.fingerprint_edits(docs(spark, rows)).collect()
    assert len(spark_rows) == len(rows)


def test_fingerprint_by_loops():
    """Bins, densification and packing, value by value, from the shingle hashes alone."""
    texts = ["", "one", "a b c d e f", " ".join(f"w{i % 97}" for i in range(3000)), "é " * 40]
    bits, some = fp.low_bits(pa.array(texts), 5)
    for at, text in enumerate(texts):
        (_, values), = shingle_sets(pa.array([text]), 5)
        bins = {}
        for v in map(int, values):
            bins.setdefault(v >> (64 - 9), []).append(v & ((1 << 55) - 1))
        least = {b: min(vs) for b, vs in bins.items()}
        assert bool(some[at]) == bool(least)
        for b in range(512) if least else []:
            source, attempt = b, 0
            while source not in least:
                attempt += 1
                source = int(fp.mix64(np.array([b * 0x9E3779B97F4A7C15 + attempt & (2**64 - 1)], dtype=np.uint64))[0] >> np.uint64(55))
            assert bits[at][b] == least[source] & 15
        if least:
            raw = fp.unpacked(fp.packed(bits[at], True))
            assert (raw == bits[at]).all()


def test_fingerprint_estimates_jaccard():
    rng, errors = random.Random(4), []
    for share in (0.2, 0.5, 0.8, 0.95):
        for _ in range(20):
            a = [f"w{rng.randrange(10**7)}" for _ in range(400)]
            cut = int(400 * share)
            b = a[:cut] + [f"v{rng.randrange(10**7)}" for _ in range(400 - cut)]
            s = [set(map(tuple, zip(*[x[i:] for i in range(5)], strict=False))) for x in (a, b)]
            bits, some = fp.low_bits(pa.array([" ".join(a), " ".join(b)]))
            errors.append(fp.likeness(bits[:1], some[:1], bits[1:], some[1:])[0] - len(s[0] & s[1]) / len(s[0] | s[1]))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.035
