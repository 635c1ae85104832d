"""Conversation structure repair (operator 11): the cheapest edits to a legal turn order, by Four-Russians blocks.

Rows are damaged by a crc32 rule, then each conversation is read in turn order. Every row has one fault at most (the
first of blank, duplicate, truncated). The repaired conversation must have the role initials ``(s?(ua)+)?``; edits are
Keep (0), Rerole to user or assistant (3), Delete (4, the only edit of a blank or duplicate row) and Insert of an empty
user or assistant row (3); a truncated row that stays costs 3 more. Among the cheapest edit lists, the ASCII-least list
of initials (D < I < K < R) is the audit.

The grammar is an automaton of four states (start, after s, after an open u, after a closed ua); a row is one of nine
symbols (must delete, or its initial among s, u, a, other with or without truncation). The cost still to pay from a
position is a vector over the states; vectors normalised by their least entry form a small finite set. For a block of
``BLOCK`` symbols, the step from the normalised vector at the block's end to the one at its start, with the added least
cost, is a table entry computed once per worker and looked up for every later block with the same symbols and vector
(the Four-Russians speed-up). The vectors are kept at block bounds only; the trace then goes forward and expands each
block anew from its stored end vector, so that at every row the least initial that keeps the optimum can be taken
(equal costs are resolved on exact values, never on a rounded guess).

Spark deals the rows: damage, null handling and the collapse of whole repeated rows run in the JVM; each conversation
is one group, gathered into one array and bounded by its own length, which the audit and the digest of the repaired
text (one sequential sha256) need in order anyway; Arrow batches of such arrays are repaired in one pandas UDF.

Defined cases: nulls in conv_id, turn, role or text read as one space where a text is needed; a null conv_id is a
conversation of its own; rows with one turn are ordered by role, then text (code points), so repeated rows are adjacent
and all but the first are duplicates; a role's initial is its first character (none for an empty role: illegal with
either neighbour, and never kept); a conversation whose rows were all dropped has zeros, an empty audit and the
digest of the empty text; very long texts are hashed whole; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: damage by crc32 % 20, fault patterns, legal neighbours, edit costs.
DAMAGE_MODULUS = 20
DROP, EMPTY, UNPUNCTUATE, REPEAT, USER = 0, 1, 2, 3, 4
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
ENDINGS = ".!?"
LEGAL_PAIRS = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# Parameter of the method: rows a block.
BLOCK = 6

SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()

# States of the grammar automaton and the role an inserted or rerolled row takes in each.
START, AFTER_SYSTEM, OPEN, CLOSED = range(4)
ACCEPTING = (START, CLOSED)
_STEP = {(START, "s"): AFTER_SYSTEM, (START, "u"): OPEN, (AFTER_SYSTEM, "u"): OPEN, (OPEN, "a"): CLOSED, (CLOSED, "u"): OPEN}
_FORCED = {START: "u", AFTER_SYSTEM: "u", OPEN: "a", CLOSED: "u"}
_ROLE = {"u": "user", "a": "assistant"}
_FINAL = (0, 2 * INSERT, INSERT, 0)  # cost from each state at the end: inserts that close the grammar
# Symbols: None for a row that must go, else (initial, truncated).
Symbol = tuple[str, bool] | None


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage: conv_id, turn, role, text, copies (2 for a repeated row, 0 for a dropped one)."""
    role = F.coalesce(F.col("role"), F.lit(" "))
    text = F.coalesce(F.col("text"), F.lit(" "))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % DAMAGE_MODULUS
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).select(
        "conv_id", "turn",
        F.when(F.col("kind") == USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == EMPTY, F.lit("")).when(F.col("kind") == UNPUNCTUATE, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == DROP, 0).when(F.col("kind") == REPEAT, 2).otherwise(1).alias("copies"))


def _consume(after: tuple[int, ...], symbol: Symbol) -> tuple[list[int], list[tuple[str, int, int]]]:
    """Cost from each state before a row, given the costs after it; and per state the moves (initial, cost, next state)."""
    before, moves = [], []
    for q in range(4):
        options = [("D", DELETE, q)]
        if symbol is not None:
            initial, truncated = symbol
            extra = TRUNCATED if truncated else 0
            if (q, initial) in _STEP:
                options.append(("K", KEEP + extra, _STEP[q, initial]))
            options.append(("R", REROLE + extra, _STEP[q, _FORCED[q]]))
        before.append(min(cost + after[nxt] for _, cost, nxt in options))
        moves.append(options)
    # Inserts at this position: open from start or system, close an open pair, open after a closed one.
    closed = min(before[CLOSED], INSERT + before[OPEN])
    opened = min(before[OPEN], INSERT + before[CLOSED])
    return [min(before[START], INSERT + opened), min(before[AFTER_SYSTEM], INSERT + opened), opened, closed], moves


@lru_cache(maxsize=1 << 16)
def _block(after: tuple[int, ...], symbols: tuple[Symbol, ...]) -> tuple[tuple[int, ...], int]:
    """The table entry of a block: normalised vector at its start and the least cost added, from the normalised end vector."""
    vector = list(after)
    for symbol in reversed(symbols):
        vector, _ = _consume(tuple(vector), symbol)
    least = min(vector)
    return tuple(v - least for v in vector), least


def _costs_at_bounds(symbols: list[Symbol]) -> list[tuple[int, ...]]:
    """Absolute cost vectors at every block bound, from the end backward, by table lookups."""
    n = len(symbols)
    bounds = list(range(0, n, BLOCK)) + [n]
    vectors = [None] * len(bounds)
    vectors[-1] = _FINAL
    for b in range(len(bounds) - 2, -1, -1):
        after = vectors[b + 1]
        offset = min(after)
        shape, added = _block(tuple(v - offset for v in after), tuple(symbols[bounds[b] : bounds[b + 1]]))
        vectors[b] = tuple(v + offset + added for v in shape)
    return vectors


def repair_plan(symbols: list[Symbol]) -> tuple[int, str, list[tuple[str, str | None]]]:
    """Least cost, audit, and per edit (initial, role of an inserted or rerolled row, else None)."""
    n = len(symbols)
    bounds = list(range(0, n, BLOCK)) + [n]
    at_bounds = _costs_at_bounds(symbols)
    edits: list[tuple[str, str | None]] = []
    q = START
    for b in range(len(bounds) - 1):
        first, last = bounds[b], bounds[b + 1]
        # Expand the block: exact vectors at every row of it, from its stored end vector.
        inside = [None] * (last - first + 1)
        inside[-1] = list(at_bounds[b + 1])
        moves = [None] * (last - first)
        for k in range(last - first - 1, -1, -1):
            inside[k], moves[k] = _consume(tuple(inside[k + 1]), symbols[first + k])
        for k in range(last - first):
            here, after = inside[k], inside[k + 1]
            while True:  # the options in ASCII order: D, I, K, R; the first that keeps the optimum is taken
                goal = here[q]
                if DELETE + after[q] == goal:
                    edits.append(("D", None))
                    break
                opened = _STEP[q, _FORCED[q]]
                if INSERT + here[opened] == goal:
                    edits.append(("I", _ROLE[_FORCED[q]]))
                    q = opened
                    continue
                initial, _, nxt = min(m for m in moves[k][q] if m[0] != "D" and m[1] + after[m[2]] == goal)
                edits.append((initial, _ROLE[_FORCED[q]] if initial == "R" else None))
                q = nxt
                break
    while q not in ACCEPTING:  # close the grammar at the end
        edits.append(("I", _ROLE[_FORCED[q]]))
        q = _STEP[q, _FORCED[q]]
    return at_bounds[0][START], "".join(e for e, _ in edits), edits


def _symbol(role: str, truncated: bool) -> Symbol:
    initial = role[:1]
    return (initial if initial in ("s", "u", "a") else "o", truncated)


def repaired(rows: list[tuple[object, str, str]]) -> dict:
    """The measures and the repair of one conversation's damaged rows (turn, role, text), in any order."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1], r[2]))
    turns = [t for t, _, _ in ordered if t is not None]
    out = {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": 0, "duplicate": 0, "truncated": 0}
    seen, symbols = set(), []
    for _, role, text in ordered:
        stripped = text.rstrip(" \t\n\x0b\x0c\r")
        if not VISIBLE.search(text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif stripped[-1] not in ENDINGS:
            fault = "truncated"
        else:
            fault = None
        seen.add((role, text))
        if fault:
            out[fault] += 1
        symbols.append(None if fault in ("blank", "duplicate") else _symbol(role, fault == "truncated"))
    initials = [role[:1] for _, role, _ in ordered]
    out["illegal"] = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
    cost, audit, edits = repair_plan(symbols)
    lines, k = [], 0
    for initial, role in edits:
        if initial == "I":
            lines.append(f"{role}:")
            continue
        _, own_role, text = ordered[k]
        k += 1
        if initial != "D":
            lines.append(f"{role or own_role}:{text}")
    digest = hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest() if lines else EMPTY_DIGEST
    return out | {"cost": cost, "audit": audit, "repaired_sha256": digest}


_RESULT = "struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string,repaired_sha256:string>"


def _repair_all(conversations: pd.Series) -> pd.DataFrame:
    """A batch of conversations, each an array of its (turn, role, text, copies) rows."""
    out = []
    for rows in conversations:
        expanded = []
        for row in rows:
            turn = row["turn"]
            expanded += [(None if turn is None or pd.isna(turn) else int(turn), row["role"], row["text"])] * int(row["copies"])
        out.append(repaired(expanded))
    return pd.DataFrame(out, columns=["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of the table: faults of the damaged conversation, least repair cost, audit and digest.

    Whole repeated rows are collapsed, then each conversation's rows are gathered into one array (the group of one
    conversation) and Arrow batches of conversations are repaired in one pandas UDF."""
    rows = damaged(conversations).groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    gathered = rows.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text", "copies")).alias("rows"))
    repaired_rows = F.pandas_udf(_repair_all, _RESULT)("rows")
    return gathered.select("conv_id", repaired_rows.alias("r")).select("conv_id", "r.*")
