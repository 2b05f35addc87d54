"""Conversation repair against an exhaustive search, and conversations that ranges and chunks cut."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from endweave.llm import repair as rp

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def facts(rows):
    """(faults, counts) of one conversation's rows in order."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for _, t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return faults, (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal)


def searched(rows):
    """All sequences of edits, at most two inserts in a place."""
    faults, counts = facts(rows)
    best = [None]

    def go(i, initials, cost, audit, said, inserts):
        if best[0] is not None and (cost, audit) > best[0][:2] and cost > best[0][0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials) and (best[0] is None or (cost, audit) < best[0][:2]):
            best[0] = (cost, audit, said)
        if inserts < 2:
            for role in ("user", "assistant"):
                if re.fullmatch("s?(ua)*u?", initials + role[0]):
                    go(i, initials + role[0], cost + 2, audit + "I", [*said, role + ":"], inserts + 1)
        if i < len(rows):
            role, text = rows[i][2:]
            go(i + 1, initials, cost + 3, audit + "D", said, 0)
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                for new, edit, price in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    if re.fullmatch("s?(ua)*u?", initials + new[:1]) and new[:1]:
                        go(i + 1, initials + new[0], cost + price + more, audit + edit, [*said, f"{new}:{text}"], 0)

    go(0, "", 0, "", [], 0)
    cost, audit, said = best[0]
    return (*counts, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def by_conversation(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return {c: sorted(g, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])) for c, g in groups.items()}


def got(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def talk(seed, conversations=60, most=6):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unit"], ["Hi.", "Yes!", "No", "", None, " \t", "é?\n", "a\x0b"]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, most)):
            rows.append((c if c else None, rng.choice([t, t, t, t + 1, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {rng.randint(0, 9)}."))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [2048, 2])
def test_as_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(rp, "CHUNK_ROWS", chunk)
    rows = talk(1) + [(77, 1, "user", None)] * 3 + [(78, t, "user", "Same.") for t in (None, 3, 1, 1)]
    after = by_conversation(damaged(rows))
    want = {c: searched(after[c]) if c in after else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in {r[0] for r in rows}}
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(rp.repair(df.repartition(3))) == want
    clash = df.withColumns({c: F.lit(7) for c in ("times", "of", "since", "repeated", "task", "chunk", "done", "facts", "audit", "cost")})
    assert got(rp.repair(clash)) == want
    assert all(len(a[6]) >= sum(a[1:3]) for a in want.values())


def test_long_conversation(spark, monkeypatch):
    """One conversation of many rows, cut by ranges and chunks, against one pass of the same recursion."""
    rng = random.Random(2)
    rows = [(5, t, rng.choice(["user", "assistant"]), rng.choice(["A.", "B", "C!", f"t {t}."])) for t in range(3000)] + [(5, 7, "user", "x" * 300_000 + ".")]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(6, 40) for t in range(4)]
    after = by_conversation(damaged(rows))[5]
    faults, counts = facts(after)
    layer = rp.closed([(0, ""), None, None, None])
    for r, fault in zip(after, faults, strict=True):
        layer = rp.stepped(layer, r[2][:1], fault)
    cost, audit = min(w for w in (layer[0], layer[3]) if w)
    said = rp.repaired(rp.START, audit, [r[2] for r in after], [r[3] for r in after])
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in said))
    monkeypatch.setattr(rp, "CHUNK_ROWS", 97)
    assert got(rp.repair(spark.createDataFrame(rows, SCHEMA).repartition(5)))[5] == (*counts, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def test_ends(spark):
    assert got(rp.repair(spark.createDataFrame([], SCHEMA))) == {}
    whole = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hi!")]
    assert got(rp.repair(spark.createDataFrame(whole, SCHEMA), damage=False))[1][5:7] == (0, "KKK")
    twice = spark.createDataFrame([(c, *r[1:]) for r in whole for c in ("a", "b")], SCHEMA.replace("conv_id long", "conv_id string"))
    assert {c: v[6] for c, v in got(rp.repair(twice, damage=False)).items()} == {"a": "KKK", "b": "KKK"}
    gone = next(t for t in range(99) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    assert got(rp.repair(spark.createDataFrame([(9, gone, "user", "x.")], SCHEMA))) == {9: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
