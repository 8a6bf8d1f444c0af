"""Conversation structure repair: cheapest edits to ``(s?(ua)+)?`` by Hirschberg's divide and conquer.

The roles' pattern has four states: nothing yet, after the system row, after a user row, after an
assistant row. A vector holds, for each state, the least cost of reaching it and the place of its
audit among the four (audits up to the same row are never prefixes of one another, as the last
letter of each belongs to that row). Forward and backward vectors meet in the middle of a run of
rows; of the cheapest crossings that with the least audit is taken and both halves are solved
alike, so no table of rows by states is ever held.

Conversations are range-partitioned and sorted, and repaired where they lie. Those that a partition's
border or their size cuts are kept as slices: each slice gets its four-by-four vectors, the slices of a
conversation are crossed by the same division, and every slice is then solved between its two states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from marquee.llm.common import arrow_type, map_batches, partitions, stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SLICE_ROWS, SLICE_BYTES = 2000, 8 << 20  # of a conversation in one piece
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = {START, ASSISTANT}
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
INSERTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 50  # cost of what cannot be reached
BLANKS = " \t\n\x0b\x0c\r"
MEASURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows after their damage by crc32(``conv_id:turn``) % 20.

    0 drops a row (``gone``, without role and text), 1 empties its text, 2 removes its ``.!?``, 3
    repeats it, 4 sets role user. Nulls read as one space, before the damage; a null turn stays null.
    """
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn, role, text)]
    base = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                       F.pmod(F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1])), F.lit(20)).alias("harm"),
                       spaced[2].alias("role"), spaced[3].alias("text"))
    harm = F.col("harm")
    text_now = F.when(harm <= 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role_now = F.when(harm == 0, "").when(harm == 4, "user").otherwise(F.col("role"))
    again = F.explode(F.when(harm == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return base.select("conv_id", "turn", role_now.alias("role"), text_now.alias("text"), (harm == 0).alias("gone"), again.alias("copy")).drop("copy")


# --- rows and their edits ----------------------------------------------------------


def fault(role: str, text: str, seen: bool) -> str:
    """First fault of a row: b(lank), d(uplicate), t(runcated) or '-'."""
    bare = text.rstrip(BLANKS)
    return "b" if not bare else "d" if seen else "-" if bare[-1] in ".!?" else "t"


def kind(role: str, fault: str) -> str:
    """What decides a row's edits: x (must go) or its initial, in capitals if it is truncated.

    An initial other than s, u and a, or none, stands as '?' or '!' (truncated): it can only be
    changed or deleted.
    """
    if fault in "bd":
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else ""
    return (initial.upper() or "!") if fault == "t" else (initial or "?")


@lru_cache(maxsize=None)
def moves(k: str) -> tuple[tuple[int, int, int, str], ...]:
    """(from, to, cost, audit) of every way through a row of this kind, inserts before it included."""
    out = []
    for p in range(4):
        q, cost, audit = p, 0, ""
        for _ in range(3):
            out.append((p, q, cost + DELETE, audit + "D"))
            if k != "x":
                more = cost + TRUNCATED * (k in "SUA!")
                if k.lower() in NEXT[q]:
                    out.append((p, NEXT[q][k.lower()], more + KEEP, audit + "K"))
                to = INSERTED[q]
                out.append((p, to, more + REROLE, audit + "R"))
            q, cost, audit = INSERTED[q], cost + INSERT, audit + "I"
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def forward(vector: tuple, k: str) -> tuple:
    """((cost, rank) of each state) behind a row, and what is taken off all costs."""
    best = [None] * 4
    for p, q, cost, audit in moves(k):
        if vector[p][0] < FAR and (best[q] is None or (vector[p][0] + cost, vector[p][1], audit) < best[q]):
            best[q] = (vector[p][0] + cost, vector[p][1], audit)
    return settled(best)


def settled(best: list) -> tuple:
    """Costs from 0 on and ranks by (rank before, audit); what cannot be reached is far."""
    order = sorted((b[1:], q) for q, b in enumerate(best) if b)
    rank = {q: i for i, (_, q) in enumerate(order)}
    least = min(b[0] for b in best if b)
    return tuple((b[0] - least, rank[q]) if b else (FAR, 9) for q, b in enumerate(best)), least


@lru_cache(maxsize=1 << 16)
def backward(costs: tuple, k: str) -> tuple:
    """Cost of each state before a row, given those behind it, and what is taken off all."""
    best = [FAR] * 4
    for p, q, cost, _ in moves(k):
        best[p] = min(best[p], cost + costs[q])
    least = min(best)
    return tuple(min(b - least, FAR) for b in best), least


def at_state(p: int) -> tuple:
    return tuple((0, 0) if q == p else (FAR, 9) for q in range(4))


def to_state(q: int) -> tuple:
    return tuple(0 if p == q else FAR for p in range(4))


def run_forward(kinds: str, lo: int, hi: int, vector: tuple) -> tuple[tuple, int]:
    total = 0
    for i in range(lo, hi):
        vector, more = forward(vector, kinds[i])
        total += more
    return vector, total


def crossing(vector: tuple, costs: tuple) -> int:
    """Of the cheapest states to cross in, that with the least audit before it."""
    return min((v[0] + c, v[1], q) for q, (v, c) in enumerate(zip(vector, costs)))[2]


def solve(kinds: str, start: int, end: int) -> str:
    """The cheapest, then least audit of the rows between two states."""
    out, todo = [], [(0, len(kinds), start, end)]
    while todo:
        lo, hi, p, q = todo.pop()
        if hi - lo == 1:
            out.append(min((cost, audit) for a, b, cost, audit in moves(kinds[lo]) if (a, b) == (p, q))[1])
        elif hi > lo:
            mid = (lo + hi) // 2
            ahead, _ = run_forward(kinds, lo, mid, at_state(p))
            costs = to_state(q)
            for i in range(hi - 1, mid - 1, -1):
                costs, _ = backward(costs, kinds[i])
            cross = crossing(ahead, costs)
            todo += [(mid, hi, cross, q), (lo, mid, p, cross)]
    return "".join(out)


def ending(q: int) -> tuple[int, str]:
    """(cost, audit) of the inserts that make a state one to end in."""
    audit = ""
    while q not in ENDS:
        q, audit = INSERTED[q], audit + "I"
    return INSERT * len(audit), audit


END_COSTS = tuple(ending(q)[0] for q in range(4))


def edited(start: int, audit: str, roles: list[str], texts: list[str]) -> Iterator[str]:
    """``role:text`` of the rows that an audit leaves."""
    state, i = start, 0
    for letter in audit:
        if letter == "I":
            state = INSERTED[state]
            yield f"{ROLE[state]}:"
            continue
        if letter == "K":
            state = NEXT[state][roles[i][:1]]
            yield f"{roles[i]}:{texts[i]}"
        elif letter == "R":
            state = INSERTED[state]
            yield f"{ROLE[state]}:{texts[i]}"
        i += 1


def illegal(initials: str) -> int:
    return sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def digest(role: str, text: str) -> bytes:
    """Stands for a row's role and text."""
    r = role.encode()
    return hashlib.sha256(b"%d:" % len(r) + r + text.encode()).digest()[:16]


def faults(roles: list[str], texts: list[str], seen: set, repeated: frozenset | None = None) -> str:
    """A letter per row; rows seen before are found in ``seen``, or given by their places."""
    out = []
    for i, (role, text) in enumerate(zip(roles, texts)):
        if repeated is None:
            d = digest(role, text)
            again = d in seen
            seen.add(d)
        else:
            again = i in repeated
        out.append(fault(role, text, again))
    return "".join(out)


def gaps(turns: list[int]) -> int:
    return max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0


# --- whole conversations -------------------------------------------------------------


def repaired(turns: list, roles: list[str], texts: list[str]) -> dict:
    """Measures, audit and repaired text of one conversation in order."""
    found = faults(roles, texts, set())
    kinds = "".join(map(kind, roles, found))
    vector, total = run_forward(kinds, 0, len(kinds), at_state(START))
    last = crossing(vector, END_COSTS)
    audit = solve(kinds, START, last) + ending(last)[1]
    hashed = hashlib.sha256()
    for i, row in enumerate(edited(START, audit, roles, texts)):
        hashed.update(("\n" * (i > 0) + row).encode())
    return {"gaps": gaps([t for t in turns if t is not None]), "blank": found.count("b"), "duplicate": found.count("d"),
            "truncated": found.count("t"), "illegal": illegal_roles(roles), "cost": total + vector[last][0] + END_COSTS[last],
            "audit": audit, "repaired_sha256": hashed.hexdigest()}


def illegal_roles(roles: list[str]) -> int:
    """Neighbours whose initials are not su, ua or au; a row without a role has no initial."""
    return sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")
SLICE = "part int, seq bigint, turns array<bigint>, roles array<string>, texts array<string>"


def with_id(df: DataFrame, ddl: str, first: str = "conv_id") -> StructType:
    from pyspark.sql.types import _parse_datatype_string

    return StructType([StructField(first, df.schema[first].dataType), *_parse_datatype_string(ddl).fields])


def arrow_schema(t: StructType) -> pa.Schema:
    return pa.schema([(f.name, arrow_type(f.dataType)) for f in t.fields])


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256``.

    ``rows`` are (conv_id, turn, role, text, gone), as ``damaged`` gives them. Rows stand by turn, nulls
    first, and with equal turns by role and by the text's digest, so repeated rows are neighbours and
    all but the first are duplicates. A conversation whose rows are all gone, has zeros, an empty audit
    and the digest of nothing. Null ids are one conversation. Other columns are not read; an empty
    table gives no rows. A null role or text counts as one space.
    """
    ordered = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "gone")
    ordered = ordered.withColumn("digest", F.md5("text"))
    by: list[str | Column] = ["conv_id", "turn", "role", "digest", "gone"]
    sorted_rows = ordered.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by).drop("digest")
    staged = stage(_in_place(sorted_rows), "conversations")
    done = staged.where("whole").select("conv_id", *MEASURES)
    return done.unionByName(_cut(staged.where("NOT whole").drop("whole", *MEASURES)))


def _in_place(rows: DataFrame) -> DataFrame:
    """Results of the conversations that lie whole in one piece, slices of all others.

    The first and the last conversation of a partition may go on in another.
    """
    schema = with_id(rows, f"whole boolean, {SLICE}, {RESULT}")
    arrow = arrow_schema(schema)

    def out(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=arrow)

    def run(batches):
        part, seq, first, size = TaskContext.get().partitionId(), 0, True, 0
        turns, roles, texts = [], [], []
        ready, ready_bytes = [], 0
        current, cut, begun = None, False, False

        def slice_of():
            return {"conv_id": current, "whole": False, "part": part, "seq": seq, "turns": turns, "roles": roles, "texts": texts}

        for batch in batches:
            for conv, turn, role, text, gone in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone"))):
                if begun and conv != current:
                    if first or cut:
                        ready.append(slice_of())
                        seq += 1
                    else:
                        ready.append({"conv_id": current, "whole": True} | repaired(turns, roles, texts))
                    ready_bytes += size
                    first, cut, size = False, False, 0
                    turns, roles, texts = [], [], []
                elif len(roles) >= SLICE_ROWS or size > SLICE_BYTES:
                    ready.append(slice_of())
                    seq, cut, ready_bytes, size = seq + 1, True, ready_bytes + size, 0
                    turns, roles, texts = [], [], []
                current, begun = conv, True
                if not gone:
                    turns.append(turn)
                    roles.append(role)
                    texts.append(text)
                    size += len(text) + len(role)
                if ready_bytes > SLICE_BYTES or len(ready) >= SLICE_ROWS:
                    yield out(ready)
                    ready, ready_bytes = [], 0
        if begun:
            yield out([*ready, slice_of()])

    return map_batches(rows, schema, run)


# --- conversations in slices ---------------------------------------------------------


def _cut(slices: DataFrame) -> DataFrame:
    """Results of the conversations that lie in several slices, or may."""
    firsts = _repeated(slices)
    kinds = stage(_kinds(slices.join(firsts, ["part", "seq"], "left")), "slice-kinds")
    plans = stage(_plan(kinds.drop("kinds")), "slice-states")
    pieces = slices.select("part", "seq", "roles", "texts").join(kinds.select("part", "seq", "kinds"), ["part", "seq"]).join(plans, ["part", "seq"])
    return _written(pieces)


def _repeated(slices: DataFrame) -> DataFrame:
    """(part, seq, repeated): places in the slice whose role and text stand earlier in the conversation."""
    schema = with_id(slices, "part int, seq bigint, at int, digest binary")

    def run(batches):
        for batch in batches:
            cols = {n: [] for n in ("conv_id", "part", "seq", "at", "digest")}
            for r in batch.to_pylist():
                n = len(r["roles"])
                for c in ("conv_id", "part", "seq"):
                    cols[c] += [r[c]] * n
                cols["at"] += range(n)
                cols["digest"] += map(digest, r["roles"], r["texts"])
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], arrow_type(f.dataType)) for f in schema.fields], names=list(cols))

    places = stage(map_batches(slices.select("conv_id", "part", "seq", "roles", "texts"), schema, run), "slice-digests")
    place = F.struct("part", "seq", "at")
    first = (places.groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first"))
    later = places.join(first, places["conv_id"].eqNullSafe(first["c"]) & (places["digest"] == first["d"])).where(place > F.col("first"))
    return later.groupBy("part", "seq").agg(F.collect_list("at").alias("repeated"))


def _kinds(slices: DataFrame) -> DataFrame:
    """Per slice its kinds, what it adds to the conversation's counts, and its vectors from each state."""
    schema = with_id(slices, "part int, seq bigint, kinds string, n int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
                             "first_role string, last_role string, least bigint, most bigint, turns bigint, costs array<bigint>, ranks array<int>")
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                roles, texts, turns = r["roles"], r["texts"], [t for t in r["turns"] if t is not None]
                found = faults(roles, texts, set(), frozenset(r["repeated"] or ()))
                kinds = "".join(map(kind, roles, found))
                costs, ranks = [], []
                for p in range(4):
                    vector, total = run_forward(kinds, 0, len(kinds), at_state(p))
                    costs += [min(v + total, FAR) for v, _ in vector]
                    ranks += [rank for _, rank in vector]
                out.append({"conv_id": r["conv_id"], "part": r["part"], "seq": r["seq"], "kinds": kinds, "n": len(roles), "blank": found.count("b"),
                            "duplicate": found.count("d"), "truncated": found.count("t"), "illegal": illegal_roles(roles),
                            "first_role": roles[0][:1] if roles else None, "last_role": roles[-1][:1] if roles else None,
                            "least": min(turns, default=None), "most": max(turns, default=None), "turns": len(set(turns)), "costs": costs, "ranks": ranks})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return map_batches(slices, schema, run)


def cross_slices(costs: list[list[int]], ranks: list[list[int]]) -> tuple[list[int], int]:
    """The states between slices, from the first start to the last end, and the cost: the same division, slices for rows."""

    def ahead(lo, hi, vector):
        total = 0
        for i in range(lo, hi):
            best = [None] * 4
            for p in range(4):
                for q in range(4):
                    cost = vector[p][0] + costs[i][4 * p + q]
                    if cost < FAR and (best[q] is None or (cost, vector[p][1], ranks[i][4 * p + q]) < best[q]):
                        best[q] = (cost, vector[p][1], ranks[i][4 * p + q])
            vector, more = settled(best)
            total += more
        return vector, total

    vector, total = ahead(0, len(costs), at_state(START))
    last = crossing(vector, END_COSTS)
    states, todo = [START] * len(costs) + [last], [(0, len(costs))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        back = to_state(states[hi])
        for i in range(hi - 1, mid - 1, -1):
            back = tuple(min(FAR, min(costs[i][4 * p + q] + back[q] for q in range(4))) for p in range(4))
        states[mid] = crossing(ahead(lo, mid, at_state(states[lo]))[0], back)
        todo += [(lo, mid), (mid, hi)]
    return states, total + vector[last][0] + END_COSTS[last]


def _plan(kinds: DataFrame) -> DataFrame:
    """Per slice the states it lies between, and its conversation's counts; some 300 bytes a slice meet per conversation."""
    totals = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    schema = with_id(kinds, f"part int, seq bigint, start int, stop int, is_last boolean, {totals}")
    arrow = arrow_schema(schema)

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["seq"]))
        states, cost = cross_slices([r["costs"] for r in rows], [r["ranks"] for r in rows])
        full = [r for r in rows if r["n"]]
        out = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")} | {"cost": cost}
        out["illegal"] += sum(a["last_role"] + b["first_role"] not in ("su", "ua", "au") for a, b in zip(full, full[1:]))
        timed = [r for r in rows if r["turns"]]
        same = sum(a["most"] == b["least"] for a, b in zip(timed, timed[1:]))
        out["gaps"] = timed[-1]["most"] - timed[0]["least"] + 1 - (sum(r["turns"] for r in timed) - same) if timed else 0
        return pa.Table.from_pylist([out | {"conv_id": r["conv_id"], "part": r["part"], "seq": r["seq"], "start": states[i], "stop": states[i + 1],
                                            "is_last": i == len(rows) - 1} for i, r in enumerate(rows)], schema=arrow)

    return kinds.groupBy("conv_id").applyInArrow(run, schema)


def _written(pieces: DataFrame) -> DataFrame:
    """The slices' audits and the digest of the repaired text, read in order; a digest is taken by one task, a slice at a time."""
    schema = with_id(pieces, RESULT)
    arrow = arrow_schema(schema)

    def solved(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                audit = solve(r["kinds"], r["start"], r["stop"]) + (ending(r["stop"])[1] if r["is_last"] else "")
                text = "".join("\n" + x for x in edited(r["start"], audit, r["roles"], r["texts"]))
                out.append({c: r[c] for c in middle.names if c in r} | {"audit": audit, "text": text})
            yield pa.RecordBatch.from_pylist(out, schema=middle)

    between = with_id(pieces, "part int, seq bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
                              "audit string, text string, is_last boolean")
    middle = arrow_schema(between)
    texts = map_batches(pieces, between, solved)

    def joined(batches):
        audit, hashed, empty = [], hashlib.sha256(), True
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                audit.append(r["audit"])
                hashed.update(r["text"][empty:].encode() if r["text"] else b"")
                empty = empty and not r["text"]
                if r["is_last"]:
                    out.append({c: r[c] for c in arrow.names if c in r} | {"audit": "".join(audit), "repaired_sha256": hashed.hexdigest()})
                    audit, hashed, empty = [], hashlib.sha256(), True
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return map_batches(texts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq"), schema, joined)


# DuckDB has no crc32: a step for each byte of ``name`` and eight (-1) for its bits
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(name) + 1),
    lambda i: [ascii(name[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"""


def _sql() -> str:
    """The plain dynamic program, a row at a time: per state the least (cost, audit) and its text."""
    def best(options: list[str]) -> str:
        return "list_min([" + ", ".join(options) + "])"

    steps = {q: [] for q in range(4)}
    for p in range(4):
        name, q, cost, audit, text = f"s{p}", p, 0, "", "''"
        for _ in range(2):
            def add(to, more, letter, piece, when):
                value = f"{{'c': {name}.c + {cost + more}, 'a': {name}.a || '{audit}{letter}', 't': {name}.t || {text}{piece}}}"
                steps[to].append(f"CASE WHEN {when} THEN {value} END")

            add(q, DELETE, "D", "", "true")
            for initial, to in NEXT[q].items():
                add(to, 0, "K", " || chr(10) || role || ':' || text", f"NOT gone AND NOT cut AND left(role, 1) = '{initial}'")
                add(to, TRUNCATED, "K", " || chr(10) || role || ':' || text", f"NOT gone AND cut AND left(role, 1) = '{initial}'")
            to = INSERTED[q]
            for cut, more in (("NOT cut", REROLE), ("cut", REROLE + TRUNCATED)):
                add(to, more, "R", f" || chr(10) || '{ROLE[to]}:' || text", f"NOT gone AND {cut}")
            q, cost, audit, text = to, cost + INSERT, audit + "I", f"{text} || chr(10) || '{ROLE[to]}:'"
    far = "{'c': 1000000000, 'a': '', 't': ''}"
    ends = [f"{{'c': s{q}.c + {ending(q)[0]}, 'a': s{q}.a || '{ending(q)[1]}', 't': s{q}.t || {tail}}}" for q, tail in (
        (0, "''"), (1, "chr(10) || 'user:' || chr(10) || 'assistant:'"), (2, "chr(10) || 'assistant:'"), (3, "''"))]
    return rf"""
WITH RECURSIVE h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {CRC32} % 20 AS harm
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations)),
d AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
  CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM h, (VALUES (1), (2)) t(k) WHERE harm <> 0 AND (k = 1 OR harm = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '-' END AS fault, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
r AS (SELECT conv_id, i, role, text, fault IN ('b', 'd') AS gone, fault = 't' AS cut FROM f),
walk AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}} AS s0, {far} AS s1, {far} AS s2, {far} AS s3 FROM r
  UNION ALL SELECT w.conv_id, r.i, {", ".join(f"{best(steps[q]) if steps[q] else far}" for q in range(4))}
  FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1),
last AS (SELECT conv_id, {best(ends)} AS e FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
  count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.t, 2), '')) AS repaired_sha256
FROM ids LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN last ON last.conv_id IS NOT DISTINCT FROM ids.conv_id"""


SQL = _sql()
