"""Vector codes against Lloyd rounds in plain loops."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from endweave.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, rounds=4):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = -(-max(len(v) for _, v, _ in kept) // 4) * 4
    full = [[math.floor(1024 * float(np.float32(x))) for x in v] + [0] * (length - len(v)) for _, v, _ in kept]
    step = length // 4
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, [float(np.float32(x)) for x in kept[k][1]]))[:256]
    books = [[full[k][p * step : (p + 1) * step] for k in order] for p in range(4)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            told = {}
            for v in full:
                told.setdefault(near(v[p * step : (p + 1) * step], books[p])[1], []).append(v[p * step : (p + 1) * step])
            books[p] = [[sum(c) // len(told[e]) for c in zip(*told[e], strict=True)] if e in told else old for e, old in enumerate(books[p])]
    out = []
    for (i, _, lab), v in zip(kept, full, strict=True):
        found = [near(v[p * step : (p + 1) * step], books[p]) for p in range(4)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    total = {}
    for _, lab, _, e in out:
        total[lab] = total.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(c) for p in books for e in p for c in e).encode()).hexdigest()
    return sorted(((i, c, e, total[lab], sha) for i, lab, c, e in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(n, length, seed, spread=0.2):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(length)], rng.choice([0, 1, None])) for i in range(n)]


def test_as_loops(spark):
    rows = vectors(420, 8, 1) + [(i, [0.5] * 8, 7) for i in range(420, 480)]  # a frequent vector
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    clashing = df.withColumns({c: F.lit(7) for c in ("block", "ids", "code", "error", "n", "of_", "id_", "part", "entry", "heaps")})
    assert got(vc.vector_codes(df.repartition(3))) == want
    assert got(vc.vector_codes(clashing.repartition(7))) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None, 1.0, 1.0], 1), (3, [nan] * 4, 1), (4, [inf, 0.0, 0.0, 0.0], 2), (5, [0.0, -0.0001, 0.5, 1.0], 1)]
    rows += [(5, [0.0, -0.0001, 0.5, 1.0], 1), (None, [2.0, 2.0, 2.0], None), (7, [], None), (8, [1.0, 2.0, 3.0, 4.0, 5.0], 3)]
    assert got(vc.vector_codes(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert got(vc.vector_codes(spark.createDataFrame(rows[:4], SCHEMA))) == []
    assert vc.vector_codes(spark.createDataFrame([], SCHEMA)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert [(r.code, r.error) for r in vc.vector_codes(spark.createDataFrame([(1, [], 1)], SCHEMA)).collect()] == [("00000000", 0)]
    huge = [(1, [3e38, 0.0, 0.0, 0.0], 1), (2, [-3e38, 0.0, 0.0, 0.0], 1)]
    assert {(r.vec_id, r.error) for r in vc.vector_codes(spark.createDataFrame(huge, SCHEMA)).collect()} == {(1, 0), (2, 0)}


@pytest.mark.parametrize("scale", [1, 1 << 26])
def test_distances_are_exact(scale):
    rng = np.random.default_rng(3)
    rows, book = rng.integers(-3, 4, (50, 6)) * scale, rng.integers(-3, 4, (9, 6)) * scale
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e, strict=True)) for e in book] for r in rows]
    assert [[int(x) for x in r] for r in vc.squared(rows, book)] == want
    entry, _ = vc.nearest(rows, book)
    assert [int(e) for e in entry] == [r.index(min(r)) for r in want]


def test_heaps_leave_what_bounds_hold():
    """Entries that hardly move pop few parts, and what stays is nearest all the same."""
    rng = np.random.default_rng(4)
    books = rng.integers(-2000, 2000, (4, 256, 4))
    x = rng.integers(-2000, 2000, (4, 3000, 4))
    first = vc._advanced(x, None, books, np.zeros((4, 256)))
    moved = books + rng.integers(-3, 4, books.shape)
    steps = np.sqrt(((moved - books) ** 2).sum(axis=2)) * (1 + vc.MARGIN)
    drift = steps + steps.max(axis=1, keepdims=True)
    packed = b"".join(h.pack() for h in first)
    popped = [len(vc.Heaps.unpack(memoryview(h.pack()), 3000)[0].pop(drift[p])[0]) for p, h in enumerate(first)]
    assert 0 < sum(popped) < 0.2 * 4 * 3000
    for p, heap in enumerate(vc._advanced(x, packed, moved, drift)):
        assert sorted(heap.rows) == list(range(3000))
        entry = np.empty(3000, dtype=int)
        entry[heap.rows] = heap.entries()
        assert (entry == vc.squared(x[p], moved[p]).argmin(axis=1)).all()
        for e in range(256):
            run = heap.keys[heap.starts[e] : heap.starts[e + 1]]
            assert (np.diff(run) >= 0).all()
