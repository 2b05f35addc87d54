"""Mixing, sharding, packing, chat formatting and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from endweave.llm import chat
from endweave.llm.mixing import mix, source_targets
from endweave.llm.packing import pack, pack_block
from endweave.llm.sharding import quotas, ring, shard

from .test_duplicates import clashing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def made(n, seed=1, hot=0.4):
    rng = random.Random(seed)
    return [(i, " ".join("w" for _ in range(int(rng.lognormvariate(3, 1)))), "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])) for i in range(n)]


def filled(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while True:
        level = rest / sum(weight[s] for s in free) if free else 0.0
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
            free.discard(s)


def test_targets(spark):
    rng = random.Random(5)
    for _ in range(6):
        sizes = {s: rng.choice([0, 1, 50, 3000]) for s in ["a", "b", "c", "d", "é", None]}
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        want = filled(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes), (sizes, got, want)


def test_mix(spark):
    rows = made(600) + [(900, None, "a"), (901, "", "z"), (None, "w w", "a"), (3, "w w w", "b")]
    df = corpus(spark, rows)
    got = mix(df).collect()
    again = mix(clashing(df.repartition(5))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows) and sorted(r["size"] for r in got) == sorted(len((t or "").split()) for _, t, _ in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source_size, round(r.target, 6)] += r.taken
    for s, target in filled(dict(sizes)).items():
        assert abs(taken[sizes[s], round(target, 6)] - target) <= max(3, 0.01 * target), s
    assert mix(corpus(spark, [])).collect() == []
    (one,) = mix(corpus(spark, [(1, "a b", "s")])).collect()
    assert (one.target, one.taken) == (2.0, 2)


def test_rates_are_tilted_by_size(spark):
    """Within a source the rate is monotone in the size: up above the source's share, down below it."""
    got = mix(corpus(spark, made(400, 2))).collect()
    by = defaultdict(list)
    for r in got:
        if r["size"]:
            by[(r.source_size, r.target)].append((r["size"], r.rate))
    for (size, target), pairs in by.items():
        rates = [x for _, x in sorted(pairs)]
        assert all((b - a) * (target - size) >= -1e-9 for a, b in zip(rates, rates[1:], strict=False))
        assert abs(sum(s * x for s, x in pairs) - target) < 1e-5 * target


def test_quotas_by_walking():
    rng = np.random.default_rng(0)
    _, owner = ring(5, 7)
    for total in (0, 3, 17, 1000):
        counts = rng.multinomial(total, np.ones(len(owner)) / len(owner))
        parts = quotas(counts, owner, 5)
        load = Counter()
        for _, a, b, s, slot in parts:
            assert load[s] == slot
            load[s] += b - a
        assert sum(load.values()) == total and max(load.values(), default=0) - min((load[s] for s in range(5)), default=0) <= 1
        for arc in range(len(owner)):
            spans = sorted((a, b) for x, a, b, _, _ in parts if x == arc)
            assert [a for a, _ in spans] == [0, *[b for _, b in spans]][: len(spans)] and sum(b - a for a, b in spans) == counts[arc]


def test_shards(spark):
    rows = made(333) + [(900, None, "a"), (901, "é", "a"), (None, "x", "b"), (5, "again", "c")]
    got = shard(clashing(corpus(spark, rows))).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(16))
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    text = {i: t or "" for i, t, _ in rows if i != 5}
    for r in got:
        if r.doc_id in text:
            assert (r["size"], r.text_crc32) == (len(text[r.doc_id].encode()) + 1, zlib.crc32(text[r.doc_id].encode()))
    assert sum(r.shard != r.home_shard for r in got) < 0.35 * len(got)
    assert sorted(map(str, shard(corpus(spark, rows).repartition(3)).collect())) == sorted(map(str, got))
    assert shard(corpus(spark, [])).collect() == []


def test_quotas_by_walking_keys():
    """Key by key: in round r, what has no place asks the r-th shard clockwise."""
    rng = np.random.default_rng(3)
    _, owner = ring(4, 5)
    for total in (1, 50, 403):
        counts = rng.multinomial(total, rng.dirichlet(np.full(len(owner), 0.2)))
        room = [total // 4 + (s < total % 4) for s in range(4)]
        waiting = {(arc, i) for arc in range(len(owner)) for i in range(counts[arc])}
        place = {}
        for r in range(4):
            for arc, i in sorted(waiting):
                walk = list(dict.fromkeys(int(owner[(arc + j) % len(owner)]) for j in range(len(owner))))
                if room[walk[r]]:
                    room[walk[r]] -= 1
                    place[arc, i] = walk[r]
            waiting -= set(place)
        got = {(arc, i): s for arc, a, b, s, _ in quotas(counts, owner, 4) for i in range(a, b)}
        assert got == place and not waiting


def test_bounded_ring_moves_little():
    """With bounded loads too, another shard moves few keys between the old ones."""
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 200_000)
    keys.sort()
    at = {}
    for shards in (16, 17):
        positions, owner = ring(shards)
        arc = np.searchsorted(positions, keys) % len(owner)
        out = np.full(len(keys), -1)
        members = {a: np.flatnonzero(arc == a) for a in range(len(owner))}
        for a, first, last, s, _ in quotas(np.bincount(arc, minlength=len(owner)), owner, shards):
            out[members[a][first:last]] = s
        at[shards] = out
    moved = at[16] != at[17]
    assert moved.mean() < 0.1 and (moved & (at[17] != 16)).mean() < 0.035


def test_ring_moves_little():
    """Another shard's virtual nodes take keys only for themselves."""
    (p, o), (q, r) = ring(16), ring(17)
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    before = o[np.searchsorted(p, keys) % len(p)]
    after = r[np.searchsorted(q, keys) % len(q)]
    assert set(after[before != after]) == {16} and (before != after).mean() < 0.12


def naive(rows, capacity, per_source):
    many, bins, out, source_of = Counter(r[2] for r in rows), [], [], {}
    cluster_of = {c: i for i, c in enumerate(c for c, n in many.items() if n > 1)}
    rests = []
    for i, size, cluster, source in rows:
        full, rest = divmod(size, capacity)
        for k in range(full):
            bins.append(None)
            out.append((i, k, k * capacity, capacity, len(bins) - 1, 0))
        if rest:
            rests.append((rest, cluster_of.get(cluster, -1), source_of.setdefault(source, len(source_of)), i, full))
    for rest, c, s, i, full in sorted(rests, key=lambda r: (-r[0], r[1], r[2])):
        fits = [(capacity - b[0], n) for n, b in enumerate(bins) if b and capacity - b[0] >= rest and (c < 0 or c not in b[1]) and b[2][s] < per_source]
        if not fits:
            bins.append([0, set(), Counter()])
        n = min(fits)[1] if fits else len(bins) - 1
        out.append((i, full, full * capacity, rest, n, bins[n][0]))
        bins[n][0] += rest
        bins[n][1].add(c)
        bins[n][2][s] += 1
    return out, len(bins)


def test_best_fit_against_all_bins():
    for seed in range(60):
        rng, size = random.Random(seed), {}
        rows = []
        for i in range(rng.randrange(1, 120)):
            cluster = rng.choice([rng.randrange(5), rng.randrange(1000)])
            rows.append((i, size.setdefault(cluster, rng.choice([rng.randrange(1, 30), rng.randrange(1, 120), 7])), cluster, rng.choice(["h", "h", "a", None])))
        rows.sort(key=lambda r: -r[1])
        assert pack_block(rows, 40, 2) == naive(rows, 40, 2)


def test_pack(spark):
    rows = made(300) + [(900, None, "a"), (901, " ", "b"), (902, "x " * 1000, "c"), (None, "n n", "a"), (903, "same  text", "a"), (904, "same text", "b"), (904, "same text", "b")]
    got = pack(clashing(corpus(spark, rows)), capacity=256, per_source=3).collect()
    words = Counter()
    bins = defaultdict(list)
    for r in got:
        words[r.doc_id] += r.n_words
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    want = Counter()
    for i, t, _ in rows:
        want[i] += len((t or "").split())
    assert words == want
    source = {i: s for i, _, s in rows}
    for pieces in bins.values():
        pieces.sort(key=lambda r: r.bin_offset)
        assert all(a.bin_offset + a.n_words == b.bin_offset for a, b in zip(pieces, pieces[1:], strict=False))
        assert pieces[-1].bin_offset + pieces[-1].n_words <= 256
        assert max(Counter(source[r.doc_id] for r in pieces).values()) <= 3
        assert sum(r.doc_id in (903, 904) for r in pieces) <= 1
    assert {r.doc_id for r in got if r.bin_id is None} == {900, 901} | {i for i, t, _ in rows if t is not None and not t.split()}
    assert pack(corpus(spark, [])).collect() == []


def turns_brute(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, v in by.items():
        v.sort()
        text = "".join(f"{r}\n{x}\n" for _, _, r, x in v)
        loss = "".join(x for _, _, r, x in v if r == "assistant")
        out[c] = (len(v), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat(spark):
    rng = random.Random(6)
    bits = ["<|im_end|>\n", "<|im_start|>", "\\", "<\\|", "<", "|", "\n", "a b c ", "é", "<\\,", "😀", "\\\\"]
    rows = []
    for c in [*range(60), None]:
        for t in range(rng.randrange(1, 20)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "a\nb", "x<\\,"]) if t else rng.choice(["system", "user"])
            rows.append((c, rng.choice([t, t, t, None]), role, rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randrange(50)))])))
    rows += [(5, 1, "user", "x " * 300), *rows[:2], (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    want = turns_brute(rows)
    for budget in (40, 120, 1024):
        got = chat.conversation_digests(df, budget).collect()
        assert {r.conv_id: tuple(r)[1:5] for r in got} == want
        windows = chat.format_windows(df, budget).collect()
        assert Counter(w.conv_id for w in windows).keys() == want.keys()
        long = [w for w in windows if w.tokens > budget]
        assert all(any(len(t.split()) > budget // 10 for t in re.split(r"<\|im_end\|>\n", w.formatted)) for w in long)
        chars = Counter()
        for w in windows:
            chars[w.conv_id] += len(w.formatted)
            assert w.formatted.count(chat.START) == w.formatted.count("<|im_end|>\n") == w.n_turns
        assert {r.conv_id: r.formatted_chars for r in got} == chars
    assert chat.conversation_digests(df.limit(0)).collect() == []


def test_chat_history_and_system(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, "user" if t % 2 else "assistant", f"t{t} " * 5) for t in range(1, 30)]
    windows = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 100).orderBy("window").collect()
    assert len(windows) > 3 and all(w.formatted.startswith("<|im_start|>system\nbe kind<|im_end|>\n") for w in windows)
    assert all(w.tokens <= 100 for w in windows) and all(w.n_repeated > 1 for w in windows[1:])


def test_chat_keeps_answers_with_prompts(spark):
    """Wherever a window can hold an exchange it does, and history is what still fits."""
    rng = random.Random(12)
    said = lambda c, t, n: f"q{c}x{t} " * n
    rows = [(0, 0, "user", said(0, 0, 600)), (0, 1, "assistant", said(0, 1, 2)), (1, 0, "user", said(1, 0, 1200)), (1, 1, "assistant", said(1, 1, 900))]
    for c in range(2, 40):
        rows += [(c, t, "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2], said(c, t, rng.choice([1, 30, 300, 600]))) for t in range(rng.randrange(1, 14))]
    windows = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    home = {}
    for w in windows:
        pieces = w.formatted.split("<|im_end|>\n")[:-1]
        assert len(pieces) == w.n_turns and (w.tokens <= 1024 or w.n_turns - w.formatted.startswith("<|im_start|>system") == 1)
        for piece in pieces[w.n_repeated :]:
            home[tuple(map(int, re.search(r"q(\d+)x(\d+)", piece).groups()))] = (w.conv_id, w.window)
    assert home.keys() == {(c, t) for c, t, _, _ in rows}
    tokens = {(c, t): len(text.split()) + 4 for c, t, _, text in rows}
    for c, t, role, _ in rows:
        system = tokens[c, 0] if c > 1 and c % 3 == 0 else 0
        if role == "user" and (c, t + 1) in tokens and tokens[c, t] + tokens[c, t + 1] + system <= 1024:
            assert home[c, t] == home[c, t + 1]
    repeated = [w for w in windows if w.n_repeated > w.formatted.startswith("<|im_start|>system")]
    assert repeated and all(w.tokens <= 1024 for w in repeated)


def test_long_texts(spark):
    """One text of two million characters among short ones."""
    long = "word " * 400_000
    df = corpus(spark, [(1, long, "a"), (2, "b c", "a"), (3, "d", "b")])
    assert {r.doc_id: r.size for r in mix(df).collect()} == {1: 400_000, 2: 2, 3: 1}
    assert {r.doc_id: r.size for r in shard(df).collect()} == {1: 2_000_001, 2: 4, 3: 2}
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")
    (row,) = chat.conversation_digests(turns).collect()
    assert row.n_turns == 2 and row.loss_sha256 == hashlib.sha256(long.encode()).hexdigest()


def test_copies_close_the_gap(spark):
    """Multipliers by bisection, and no single copy that would bring a source nearer its target."""
    rows = made(900)
    got = mix(corpus(spark, rows)).collect()
    by = {}
    for r, source in [(r, dict((i, s) for i, _, s in rows)[r.doc_id]) for r in got]:
        by.setdefault(source, []).append(r)
    for rs in by.values():
        target, size = rs[0].target, rs[0].source_size
        mean = size / len(rs)
        if size and target < 3 * size:
            lo, hi = -60.0, 60.0
            for _ in range(200):
                lam = (lo + hi) / 2
                total = sum(r.size * min(3.0, math.exp(min(lam * r.size / mean, 700))) for r in rs)
                lo, hi = (lam, hi) if total < target else (lo, lam)
            assert all(abs(r.rate - min(3.0, math.exp(min(lo * r.size / mean, 700)))) < 1e-5 for r in rs if r.size)
        missing = target - sum(r.taken for r in rs)
        assert abs(missing) <= min((r.size for r in rs if r.size), default=0) + 1e-6
        assert all(0 <= r.copies <= 3 for r in rs)


def test_pipeline_of_clashing_columns(spark):
    import corpus_pipeline as cp

    rows = [(i, f"text {i} " * (i + 1), "en", "ab"[i % 2], 5) for i in range(12)] + [(3, "text 3 " * 4, "en", "b", 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    extra = docs.withColumns({c: F.lit(7) for c in ("n", "id", "sha", "stays", "copies", "words", "own_words", "own_sha", "copy", "size", "label", "source_size", "rank")})
    for _, stage in cp.STAGES:
        a, b = stage(spark, docs, ""), stage(spark, extra, "")
        assert a.columns == b.columns and Counter(a.collect()) == Counter(b.collect())


def test_stages_of_odd_documents(spark):
    """What each stage makes of null, empty, blank and very long texts, null ids, repeated rows and no rows."""
    import corpus_pipeline as cp

    rng = random.Random(9)
    long = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(150_000))
    usual = [(i, " ".join("".join(rng.choices("ijklmnop", k=5)) for _ in range(30)), "xx", "ab"[i % 2], 1) for i in range(20, 32)]
    rows = [(1, None, "xx", "a", 1), (2, "", None, "a", 1), (3, " \t", "xx", None, 1), (4, long, "xx", "a", 1), (5, long + " end", None, "b", 1), (None, "no id here", "xx", "a", 1)]
    rows += [usual[0], (None, "no id here", "xx", "a", 1), *usual]
    docs = spark.createDataFrame(rows, SCHEMA)
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=lambda i: (i is None, i))
    own = [r[0] for r in usual]
    stages = dict(cp.STAGES)
    assert ids(stages["language"](spark, docs, "")) == sorted([4, 5, own[0], *own]) + [None, None]
    assert ids(stages["exact_dedup"](spark, docs, "")) == sorted([1, 3, 4, 5, *own]) + [None]
    assert ids(stages["near_dedup"](spark, docs, "")) == sorted([1, 2, 3, 4, own[0], *own]) + [None, None]
    mixed = stages["source_mix"](spark, docs, "").collect()
    assert {1, 2, 3} <= {r.doc_id for r in mixed} and all(r.text == long for r in mixed if r.doc_id == 4)
    pieces = stages["pack"](spark, docs, "")
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in rows}
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0, name


def test_pipeline(spark):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["language", "exact_dedup", "near_dedup", "source_mix", "pack"] and cp.ORACLE_SQL is None
    rng = random.Random(8)
    base = [" ".join(f"w{rng.randrange(999)}" for _ in range(60)) for _ in range(20)]
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate(base)]
    rows += [(100, base[0].replace(" ", "  "), "en", "a", 1), (101, base[1].rsplit(" ", 1)[0], None, "a", 1), (102, "123 456", "en", "a", 7), (103, None, "en", "b", None), (None, "a text without an id", "en", "c", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    seen = []
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = docs.persist()
        seen.append(Counter(r.doc_id for r in docs.collect()))
    assert seen[0] == Counter([*range(20), 100, 101, None])
    assert seen[1] == Counter([*range(20), 101, None])
    assert seen[2] == Counter([*range(20), None])
    assert set(seen[3]) <= set(seen[2]) and max(seen[3].values()) <= 3
    pieces = cp.STAGES[-1][1](spark, docs, "").collect()
    assert sum(r.n_words for r in pieces) == sum(len(r.text.split()) for r in docs.collect())
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, "")
    assert empty.count() == 0
