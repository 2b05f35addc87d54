"""Repair of conversation structure by dynamic programming.

The rows of a conversation, in order, are edited at least cost into an optional system turn and pairs of
user and assistant turns. Four states are the grammar: at the start, behind the system turn, behind a
user's, behind an assistant's. A forward pass carries for each state the least (cost, audit string); a
row's layer is closed by at most two inserts, since two of them come back to a state and more never pay.

Conversations are not gathered: rows are range-partitioned and sorted, and a task passes over them. What
lies inside a range is finished there. What a border of ranges cuts, or what is longer than a chunk, leaves
for each chunk the best way from every state to every other; these combine in order, in a second pass that
holds one chunk, and for each state the audit so far and the running digest of the repaired text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from endweave.llm.common import columns_of, cut, nearby, partitions

BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: The damage's modulus.
DAMAGES = 20
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where the initial of a role leads from each state, None where it may not stand.
LEADS: dict[str, tuple[int | None, ...]] = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: Where a turn leads that takes the role that the state asks for, and that role.
NEXT, ASKED = (USER, USER, ASSISTANT, USER), ("user", "user", "assistant", "user")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LEGAL = ("su", "ua", "au")
#: Rows and characters of a chunk, and characters of a role and of a text by which ranges are cut.
CHUNK_ROWS, CHUNK_CHARS, LEAD = 2048, 1 << 20, 128

#: For each state the least (cost, audit), None where there is none.
Layer = list[tuple[int, str] | None]


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times) of (conv_id, turn, role, text); a dropped row has times 0.

    Nulls count as one space, but for the turn's and the conversation's own column. By the crc32 of
    "conv_id:turn" modulo 20: 0 drops a row, 1 empties its text, 2 takes out its ``[.!?]``, 3 repeats it,
    4 makes it the user's."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % DAMAGES
    text = F.when(kind == 1, "").when(kind == 2, F.translate(or_space("text"), ENDS, "")).otherwise(or_space("text"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(or_space("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("times"),
    )


def closed(layer: Layer) -> Layer:
    """The layer with up to two inserted turns behind it."""
    for _ in range(2):
        grown = list(layer)
        for state, held in enumerate(layer):
            if held is not None:
                way = (held[0] + INSERT, held[1] + "I")
                at = grown[NEXT[state]]
                if at is None or way < at:
                    grown[NEXT[state]] = way
        layer = grown
    return layer


def stepped(layer: Layer, initial: str, fault: str) -> Layer:
    """The closed layer behind one more row. Paths that meet have consumed as many rows, so that of equal
    costs none is the beginning of another, and the smaller audit stays the smaller one."""
    out: Layer = [None] * 4
    leads, more = LEADS.get(initial), TRUNCATED if fault == "truncated" else 0
    for state, held in enumerate(layer):
        if held is None:
            continue
        cost, audit = held
        ways = [(state, (cost + DELETE, audit + "D"))]
        if fault not in ("blank", "duplicate"):
            ways.append((NEXT[state], (cost + REROLE + more, audit + "R")))
            if leads is not None and leads[state] is not None:
                ways.append((leads[state], (cost + KEEP + more, audit + "K")))
        for to, way in ways:
            at = out[to]
            if at is None or way < at:
                out[to] = way
    return closed(out)


def repaired(state: int, audit: str, roles: list[str], texts: list[str]) -> list[str]:
    """``role:text`` of what the edits leave, from the state on."""
    out, rows = [], iter(zip(roles, texts, strict=True))
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            to = LEADS[role[:1]][state]
        else:
            role, to = ASKED[state], NEXT[state]
        out.append(f"{role}:{text}")
        state = to
    return out


def fault_of(text: str, again: bool) -> str:
    bare = text.rstrip(BLANKS)
    return "blank" if not bare else "duplicate" if again else "" if bare[-1] in ENDS else "truncated"


class Chunk:
    """Consecutive rows of a conversation."""

    def __init__(self):
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.faults: list[str] = []
        self.turns: list[int] = []
        self.chars = 0

    def add(self, turn, role: str, text: str, fault: str) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.chars += len(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def full(self) -> bool:
        return len(self.roles) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS

    def facts(self) -> dict:
        """Counts, and what neighbouring chunks need to count across their border."""
        initials = [r[:1] for r in self.roles]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        kinds = {k: self.faults.count(k) for k in ("blank", "duplicate", "truncated")}
        turns = {"n_turns": len(self.turns), "first_turn": self.turns[0] if self.turns else None, "last_turn": self.turns[-1] if self.turns else None}
        ends = {"first": initials[0] if initials else None, "last": initials[-1] if initials else None}
        return {**kinds, "illegal": illegal, **turns, **ends}

    def ways(self, start: int) -> Layer:
        layer: Layer = [None] * 4
        layer[start] = (0, "")
        layer = closed(layer)
        for role, fault in zip(self.roles, self.faults, strict=True):
            layer = stepped(layer, role[:1], fault)
        return layer


def joined(a: dict, b: dict) -> dict:
    """The facts of two neighbours."""
    if b["first"] is None or a["first"] is None:
        return a if b["first"] is None else b
    across = int(a["last"] + b["first"] not in LEGAL)
    same = int(a["last_turn"] is not None and a["last_turn"] == b["first_turn"])
    return {
        **{k: a[k] + b[k] for k in ("blank", "duplicate", "truncated")},
        "illegal": a["illegal"] + b["illegal"] + across,
        "n_turns": a["n_turns"] + b["n_turns"] - same,
        "first_turn": b["first_turn"] if a["first_turn"] is None else a["first_turn"],
        "last_turn": a["last_turn"] if b["last_turn"] is None else b["last_turn"],
        "first": a["first"],
        "last": b["last"],
    }


def report(facts: dict, cost: int, audit: str, sha: str) -> dict:
    gaps = facts["last_turn"] - facts["first_turn"] + 1 - facts["n_turns"] if facts["n_turns"] else 0
    return {"gaps": gaps, **{k: facts[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit, "repaired_sha256": sha}


def best_end(layer: Layer) -> int:
    """The state in which a conversation may end at least cost."""
    return min((s for s in (START, ASSISTANT) if layer[s] is not None), key=lambda s: layer[s])


RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
FACTS = [("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("n_turns", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("first", pa.string()), ("last", pa.string())]
KEYS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
WAY = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])


def _batches(rows: Iterator[dict], schema: pa.Schema, weight: Callable[[dict], int]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + weight(row)
        if size > 1 << 22:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema=schema)


def _swept(schema: pa.Schema):
    """A range of sorted rows: results of conversations that lie inside it in one chunk, chunks of others."""

    def finished(conv, chunk: Chunk) -> dict:
        layer = chunk.ways(START)
        end = best_end(layer)
        cost, audit = layer[end]
        text = "\n".join(repaired(START, audit, chunk.roles, chunk.texts))
        return {"conv_id": conv, "done": report(chunk.facts(), cost, audit, hashlib.sha256(text.encode()).hexdigest())}

    def left(conv, task: int, number: int, chunk: Chunk) -> dict:
        ways = [{"from": s, "to": t, "cost": w[0], "audit": w[1]} for s in range(4) for t, w in enumerate(chunk.ways(s)) if w is not None]
        return {"conv_id": conv, "task": task, "chunk": number, "facts": chunk.facts(), "ways": ways, "roles": chunk.roles, "texts": chunk.texts}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task, none = TaskContext.get().partitionId(), object()
        conv, chunk, number, first, before = none, Chunk(), 0, True, None
        for batch in batches:
            for r in batch.to_pylist():
                if conv is none or r["conv_id"] != conv:
                    if conv is not none:
                        yield left(conv, task, number, chunk) if first or number else finished(conv, chunk)
                        first = False
                    conv, chunk, number, before = r["conv_id"], Chunk(), 0, None
                own = (r["turn"], r["role"], r["text"])
                for _ in range(r["times"]):
                    again = before == own or (r["repeated"] and r["since"] != r["turn"])
                    if chunk.full():
                        yield left(conv, task, number, chunk)
                        chunk, number = Chunk(), number + 1
                    chunk.add(*own, fault_of(r["text"], again))
                    before = own
        if conv is not none:
            yield left(conv, task, number, chunk)

    weight = lambda row: sum(map(len, row.get("texts") or ())) + 64 * len(row.get("roles") or ())
    return lambda batches: _batches(rows(batches), schema, weight)


def _folded(schema: pa.Schema):
    """Chunks in order: each state's best way so far, with the digest of what it has repaired."""

    def ended(conv, facts: dict, held: list) -> dict:
        end = best_end([h and h[:2] for h in held])
        cost, audit, sha, _ = held[end]
        return {"conv_id": conv, **report(facts, cost, audit, sha.hexdigest())}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        none = object()
        conv, facts, held = none, {}, []
        for batch in batches:
            for r in batch.to_pylist():
                if conv is none or r["conv_id"] != conv:
                    if conv is not none:
                        yield ended(conv, facts, held)
                    conv, facts, held = r["conv_id"], {"first": None}, [(0, "", hashlib.sha256(), False), None, None, None]
                facts = joined(facts, r["facts"]) if facts["first"] is not None else r["facts"]
                best: list = [None] * 4
                for w in r["ways"]:
                    at = held[w["from"]]
                    if at is not None:
                        way = (at[0] + w["cost"], at[1] + w["audit"], w["from"], w["audit"])
                        if best[w["to"]] is None or way[:2] < best[w["to"]][:2]:
                            best[w["to"]] = way
                after: list = [None] * 4
                for to, way in enumerate(best):
                    if way is not None:
                        cost, audit, state, edits = way
                        sha, some = held[state][2].copy(), held[state][3]
                        lines = repaired(state, edits, r["roles"], r["texts"])
                        if lines:
                            sha.update((("\n" if some else "") + "\n".join(lines)).encode())
                        after[to] = (cost, audit, sha, some or bool(lines))
                held = after
        if conv is not none:
            yield ended(conv, facts, held)

    return lambda batches: _batches(rows(batches), schema, lambda row: len(row["audit"]))


def repeats(rows: DataFrame) -> DataFrame:
    """(of, as_role, as_text, since) of the role and text that a conversation has in several rows, with the
    first turn of them, null first; texts by a digest. A row that is damaged to be there twice counts once."""
    said = rows.filter("times > 0")
    first = F.min(F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn")))
    groups = said.groupBy(F.col("conv_id").alias("of"), F.col("role").alias("as_role"), digest("text").alias("as_text"))
    return groups.agg(first["turn"].alias("since"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")


def digest(column: str) -> Column:
    return F.md5(F.col(column).cast("binary"))


def repair(turns: DataFrame, damage: bool = True) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256; with ``damage`` the rows are damaged before.

    Rows go by turn, null first, then by role and text. Audits name the edits in order: K keeps a row, R
    gives it the role that is asked for, D deletes it, I inserts an empty turn. A null role or text counts
    as one space, a null conv_id is a conversation. Repeated rows are duplicates of the first, which is
    kept if it can be. Conversation ids that are neither whole numbers nor strings come back as strings. A
    conversation that lost all its rows has zeros, an empty audit and the digest of
    the empty text; an empty table gives an empty result; other columns are not read.
    """
    spark = turns.sparkSession
    rows = columns_of(turns, "conv_id", "turn", "role", "text").withColumn("turn", F.col("turn").cast("long"))
    if rows.schema["conv_id"].dataType.simpleString() not in KEYS:
        rows = rows.withColumn("conv_id", F.col("conv_id").cast("string"))
    if damage:
        rows = damaged(rows)
    else:
        or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        rows = rows.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"), F.lit(1).cast("long").alias("times"))
    again = nearby(cut(repeats(rows)))
    on = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("as_role")) & (digest("text") == F.col("as_text")) & (F.col("times") > 0)
    told = rows.join(again, on, "left").withColumn("repeated", F.col("as_text").isNotNull())
    # Equal rows are counted before they meet, however many there are; those that no other equals go on as they are.
    counted = told.filter("repeated").groupBy("conv_id", "turn", "role", "text", "since", "repeated").agg(F.sum("times").alias("times"))
    columns = ("conv_id", "turn", "role", "text", "times", "repeated", "since")
    rows = told.filter("not repeated").select(*columns).union(counted.select(*columns))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first()]
    ranges = rows.repartitionByRange(partitions(spark), *order, F.substring("role", 1, LEAD), F.substring("text", 1, LEAD))
    ranges = ranges.sortWithinPartitions(*order, "role", "text")

    key = KEYS[rows.schema["conv_id"].dataType.simpleString()]
    swept = pa.schema(
        [("conv_id", key), ("done", pa.struct(RESULT)), ("task", pa.int32()), ("chunk", pa.int32()), ("facts", pa.struct(FACTS)), ("ways", pa.list_(WAY)), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    )
    kinds = {kind: name for name, kind in KEYS.items()}
    struct = lambda fields: "struct<" + ",".join(f"{n}:{kinds[k]}" for n, k in fields) + ">"
    ddl = f"conv_id {kinds[key]}, done {struct(RESULT)}, task int, chunk int, facts {struct(FACTS)}, ways array<struct<from:int,to:int,cost:long,audit:string>>, roles array<string>, texts array<string>"
    found = cut(ranges.mapInArrow(_swept(swept), ddl))
    result = pa.schema([("conv_id", key), *RESULT])
    parts = found.filter("done is null").drop("done").repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "task", "chunk")
    folded = parts.mapInArrow(_folded(result), ", ".join(f"{n} {kinds[k]}" for n, k in [("conv_id", key), *RESULT]))
    return found.filter("done is not null").select("conv_id", "done.*").union(folded)
