"""Conversation repair against all edit lists of small conversations, and the Spark path against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from bourse.llm import dialogue

GRAMMAR = re.compile(r"(s?(ua)+)?")
GAPS = ["", "u", "a", "uu", "ua", "au", "aa"]


def brute(symbols):
    """Least (cost, audit, output initials) over every choice of edits; inserts of up to two rows between any rows."""
    best = None
    choices = [["D"] if s is None else ["D", "K", "Ru", "Ra"] for s in symbols]
    for acts in itertools.product(*choices):
        for gaps in itertools.product(GAPS, repeat=len(symbols) + 1):
            cost, audit, roles = 0, "", ""
            for k in range(len(symbols) + 1):
                cost += 3 * len(gaps[k])
                audit += "I" * len(gaps[k])
                roles += gaps[k]
                if k == len(symbols):
                    break
                act, s = acts[k], symbols[k]
                audit += act[0]
                if act == "D":
                    cost += 4
                    continue
                cost += (0 if act == "K" else 3) + (3 if s[1] else 0)
                roles += s[0] if act == "K" else act[1]
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, roles)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_least_and_ascii_least(seed):
    rng = random.Random(seed)
    alphabet = [None] + [(i, t) for i in "suao" for t in (False, True)]
    for _ in range(25):
        symbols = [rng.choice(alphabet) for _ in range(rng.randint(0, 3))]
        cost, audit, edits = dialogue.repair_plan(symbols)
        want = brute(symbols)
        assert (cost, audit) == want[:2], symbols
        roles, k = "", 0
        for initial, role in edits:
            if initial == "D":
                k += 1
            elif initial == "I" or initial == "R":
                roles += role[0]
                k += initial == "R"
            else:
                roles += symbols[k][0]
                k += 1
        assert roles == want[2]


def test_blocks_equal_row_by_row(monkeypatch):
    rng = random.Random(9)
    alphabet = [None] + [(i, t) for i in "suao" for t in (False, True)]
    for _ in range(20):
        symbols = [rng.choice(alphabet) for _ in range(rng.randint(0, 120))]
        blocked = dialogue.repair_plan(symbols)
        monkeypatch.setattr(dialogue, "BLOCK", 1)
        plain = dialogue.repair_plan(symbols)
        monkeypatch.undo()
        assert blocked == plain


def python_damage(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{conv_id if conv_id is not None else ' '}:{turn if turn is not None else ' '}"
        kind = zlib.crc32(key.encode()) % 20
        out.setdefault(conv_id, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv_id] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def conversation_rows():
    rng = random.Random(11)
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Hello there.", "ok", "  ", "", None, "Why?", "Sure! ", "done.\n", "été 漢字.", "x" * 5000]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 14)):
            rows.append((conv, turn if rng.random() > 0.05 else None, rng.choice(roles), rng.choice(texts)))
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (500, 3, "user", "a."), (500, 3, "user", "a."), (500, 9, None, None)]
    return rows


def test_spark_equals_python(spark, rows):
    table = conversation_rows()
    frame = spark.createDataFrame([(*r, "x", 1) for r in table], "conv_id long, turn long, role string, text string, copies string, kind int")
    got = rows(dialogue.repair(frame))
    want = []
    for conv_id, damaged in python_damage(table).items():
        r = dialogue.repaired(damaged)
        want.append((conv_id, r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]))
    assert got == sorted(want, key=repr)
    assert len({r[0] for r in got}) == len({r[0] for r in table})


def test_measures_of_one_conversation():
    r = dialogue.repaired([(0, "user", "Hi."), (1, "assistant", "ok"), (1, "assistant", "ok"), (4, "user", " "), (None, "tool", "x.")])
    assert (r["gaps"], r["blank"], r["duplicate"], r["truncated"]) == (2, 1, 1, 1)
    assert dialogue.repaired([]) == {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                                     "repaired_sha256": hashlib.sha256(b"").hexdigest()}


def test_empty_table(spark):
    assert dialogue.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
