"""Repair of conversation structure by a square-root checkpointed dynamic programme.

A conversation's rows, in order, must end up with role initials of the form ``(s?(ua)+)?``. Edits
and their costs: Keep 0, Rerole to user or assistant 1, Delete 2 (required for blank and duplicate
rows), Insert an empty-text user or assistant row anywhere 5; a truncated row that is not deleted
adds 5. The cheapest edits are found with a four-state automaton (start, after s, after u, after a):
a backward pass computes the cost still to pay from every (row, state), and a forward walk takes at
every step the ASCII-least edit initial (``D`` < ``I`` < ``K`` < ``R``, ending first) that keeps the
cost optimal; that gives the ASCII-least audit among the cheapest. Only every ``B``-th cost vector
(``B`` = ceil(sqrt(n))) is stored in the backward pass; the walk recomputes each block of ``B``
vectors from the checkpoint after it, so the programme holds O(sqrt(n)) vectors beside the rows.

Faults of a row, the first counting: blank (no character outside ``[\\x20\\x09-\\x0D]``), duplicate
(role and text seen in an earlier row of the conversation), truncated (last such character not one
of ``.!?``). Rows are ordered by turn (nulls first), then role, then text (code point order), so
equal turns have a defined order; a row's role initial is its first character.

Defined cases: null role or text count as one space; a null conversation id is a conversation of
its own; an empty input gives no rows; a conversation without rows (after damage) gets zero counts,
an empty audit and the hash of the empty string. Rows are dealt by conversation and sorted within each
task, which streams conversations one by one (``mapInArrow``); a conversation's repaired text is hashed
in order, so the rows of one conversation must fit one task.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the dealt contract.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
DAMAGES = 20

_WORD = re.compile(r"[^\x20\x09-\x0D]")
_END = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")
_INF = float("inf")

#: Automaton of ``(s?(ua)+)?``: state -> {initial: next state}; 0 start, 1 after s, 2 after u, 3 after a.
_MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The one role an inserted or rerolled row takes in each state.
_NEEDS = ("user", "user", "assistant", "user")
_ACCEPT = (True, False, False, True)


def faults(rows: list[tuple[str, str]]) -> list[int]:
    """0 none, 1 blank, 2 duplicate, 3 truncated: the first fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        if not _WORD.search(text):
            out.append(1)
        elif (role, text) in seen:
            out.append(2)
        elif not _END.search(text):
            out.append(3)
        else:
            out.append(0)
        seen.add((role, text))
    return out


@functools.lru_cache(maxsize=4096)
def _row_options(state: int, role: str, fault: int) -> tuple:
    """(initial, cost, next state, new role) of edits that consume the row, in ASCII order.
    Roles repeat, so the options are kept per (state, role, fault)."""
    found = [("D", DELETE, state, None)]
    if fault in (1, 2):
        return tuple(found)
    extra = TRUNCATED if fault == 3 else 0
    moved = _MOVES[state].get(role[:1])
    if moved is not None:
        found.append(("K", KEEP + extra, moved, role))
    need = _NEEDS[state]
    if role != need:
        found.append(("R", REROLE + extra, _MOVES[state][need[0]], need))
    return tuple(found)


def _options(i, state, roles, codes, texts):
    """Every edit at (row i, state) in ASCII order of its initial: (initial, cost, next, output row)."""
    consumed = _row_options(state, roles[i], codes[i]) if i < len(roles) else ()
    for initial, cost, nxt, role in consumed[:1]:
        yield initial, cost, nxt, None
    yield "I", INSERT, _insert(state), (_NEEDS[state], "")
    for initial, cost, nxt, role in consumed[1:]:
        yield initial, cost, nxt, (role, texts[i])


def _insert(state: int) -> int:
    return _MOVES[state][_NEEDS[state][0]]


def _vector_before(i: int, after: list[float] | None, roles, codes) -> list[float]:
    """Cost still to pay from each state before row ``i`` (``after``: the vector before row i + 1)."""
    if after is None:  # past the last row
        base = [0.0 if _ACCEPT[s] else _INF for s in range(4)]
    else:
        base = [min(c + after[n] for _, c, n, _ in _row_options(s, roles[i], codes[i])) for s in range(4)]
    g = base[:]
    for _ in range(4):  # inserts move within the same place; four rounds settle four states
        g = [min(base[s], INSERT + g[_insert(s)]) for s in range(4)]
    return g


def repair(roles: list[str], texts: list[str]) -> tuple[float, str, list[tuple[str, str]]]:
    """Cheapest repair: (cost, audit, repaired rows) of one conversation's ordered rows."""
    n = len(roles)
    codes = faults(list(zip(roles, texts)))
    block = max(1, math.ceil(math.sqrt(n)))
    checkpoints: dict[int, list[float]] = {}
    g = _vector_before(n, None, roles, codes)
    checkpoints[n] = g
    for i in range(n - 1, -1, -1):
        g = _vector_before(i, g, roles, codes)
        if i % block == 0:
            checkpoints[i] = g
    audit, out, state = [], [], 0
    for start in range(0, n + 1, block):
        stop = min(start + block, n)
        vectors = {stop: checkpoints[stop]}
        for i in range(stop - 1, start - 1, -1):
            vectors[i] = _vector_before(i, vectors[i + 1], roles, codes)
        i = start
        while True:
            here = vectors[i][state]
            if i == n and _ACCEPT[state] and here == 0:
                break
            step = None
            for initial, cost, nxt, role in _options(i, state, roles, codes, texts):
                target = vectors[i + 1][nxt] if initial != "I" else vectors[i][nxt]
                if cost + target == here:
                    step = (initial, nxt, role, initial != "I")
                    break
            initial, state, row, consumed = step
            audit.append(initial)
            if row is not None:
                out.append(row)
            if consumed:
                i += 1
                if i == stop and stop < n:
                    break
        if stop == n:
            break
        del vectors
    return checkpoints[0][0], "".join(audit), out


def _summary(conv_id, turns: list, roles: list[str], texts: list[str]) -> dict:
    """Result row of one conversation from its rows in order (``turns``: the non-null turns)."""
    codes = faults(list(zip(roles, texts)))
    initials = [r[:1] for r in roles]
    illegal = sum(1 for a, b in zip(initials, initials[1:]) if a + b not in ("su", "ua", "au"))
    distinct = set(turns)
    gaps = max(distinct) - min(distinct) + 1 - len(distinct) if distinct else 0
    cost, audit, out = repair(roles, texts)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode("utf-8")).hexdigest()
    return {
        "conv_id": conv_id, "gaps": gaps, "blank": codes.count(1), "duplicate": codes.count(2),
        "truncated": codes.count(3), "illegal": illegal, "cost": int(cost), "audit": audit,
        "repaired_sha256": digest, "n_rows": len(roles),
    }


def _stream(batches):
    """Rows sorted by conversation and order within a partition -> one result row per conversation.
    Only the conversation at hand is held; it may continue into the next batch."""
    started, current, turns, roles, texts = False, None, [], [], []
    for batch in batches:
        out = []
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "has_turn", "turn_value", "role", "text")]
        for conv_id, has, turn, role, text in zip(*columns):
            if started and conv_id != current:
                out.append(_summary(current, turns, roles, texts))
                turns, roles, texts = [], [], []
            started, current = True, conv_id
            if has:
                turns.append(turn)
            roles.append(role)
            texts.append(text)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
    if started:
        yield pa.RecordBatch.from_pylist([_summary(current, turns, roles, texts)], schema=_ARROW)


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string, n_rows long"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string()), ("n_rows", pa.int64())]
)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the dealt damage, by crc32 of ``conv_id:turn`` modulo 20 (nulls as one space):
    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets role user."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    d = F.pmod(F.crc32(F.encode(key, "utf-8")), F.lit(DAMAGES))
    text = F.coalesce(F.col("text").cast("string"), space)
    role = F.coalesce(F.col("role").cast("string"), space)
    return (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            role.alias("role"), text.alias("text"), d.alias("damage"),
        )
        .where(F.col("damage") != 0)
        .withColumn("role", F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role")))
        .withColumn(
            "text",
            F.when(F.col("damage") == 1, F.lit(""))
            .when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")),
        )
        .withColumn("copy", F.explode(F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("damage", "copy")
        .withColumn("has_turn", F.col("turn").isNotNull())
        .withColumn("turn_value", F.coalesce(F.col("turn"), F.lit(0).cast("long")))
    )


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation id of the input (dropped ones too), from its damaged rows."""
    rows = damaged(conversations)
    # one conversation's rows meet in one task, in order; a task streams its conversations one by one
    ordered = rows.drop("turn").repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "has_turn", "turn_value", "role", "text"
    )
    repaired = ordered.mapInArrow(_stream, RESULT)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    zero = F.lit(0).cast("long")
    return ids.join(repaired, ids["conv_id"].eqNullSafe(repaired["conv_id"]), "left").select(
        ids["conv_id"],
        *(F.coalesce(repaired[c], zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce(repaired["audit"], F.lit("")).alias("audit"),
        F.coalesce(repaired["repaired_sha256"], F.lit(empty)).alias("repaired_sha256"),
        F.coalesce(repaired["n_rows"], zero).alias("n_rows"),
    )
