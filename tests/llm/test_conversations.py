"""Conversation repair against brute force, with nulls, empty texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from sparkledger.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, gone string, fault string, place string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).select("conv_id", "turn", "role", "text", "fault", "place")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def fault_of(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        kept = text.rstrip(" \t\n\x0b\x0c\r")
        found.append(1 if not kept else 2 if (role, text) in seen else 3 if kept[-1] not in ".!?" else 0)
        seen.add((role, text))
    return found


def cheapest(rows, faults):
    """Dijkstra over all edits without any grammar states: whole strings of initials, by cost and audit."""
    pattern, best = re.compile(r"(s?(ua)+)?"), None
    whole = re.compile(r"s?(ua)*u?")  # what can still become right
    now = {("", "", ()): 0}
    for step in range(len(rows) + 1):
        with_inserts = dict(now)
        for _ in range(2):
            for (initials, audit, turns), cost in list(with_inserts.items()):
                for i, role in (("u", "user"), ("a", "assistant")):
                    key = (initials + i, audit + "I", (*turns, (role, "")))
                    if whole.fullmatch(key[0]):
                        with_inserts[key] = min(with_inserts.get(key, 10**9), cost + 2)
        if step == len(rows):
            now = with_inserts
            break
        (_, _, role, text), fault, after = rows[step], faults[step], {}
        for (initials, audit, turns), cost in with_inserts.items():
            options = [("", "D", 3, None)]
            if fault not in (1, 2):
                options += [(role[:1], "K", fault == 3, (role, text))] if role else []
                options += [(i, "R", 2 + (fault == 3), (r, text)) for i, r in (("u", "user"), ("a", "assistant"))]
            for i, letter, more, turn in options:
                if whole.fullmatch(initials + i):
                    key = (initials + i, audit + letter, turns + ((turn,) if turn else ()))
                    after[key] = min(after.get(key, 10**9), cost + more)
        # Of paths that end alike the dearest ones cannot win: another path can do the same for eight more.
        least = min(after.values())
        now = {k: c for k, c in after.items() if c <= least + 8}
    for (initials, audit, turns), cost in now.items():
        if pattern.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, turns)
    return best


def by_hand(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = damaged([r for r in rows if r[0] == conv])
        faults = fault_of(mine)
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, turns = cheapest(mine, faults)
        text = "\n".join(f"{r}:{t}" for r, t in turns)
        out.append((conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_repairs_equal_brute_force(spark):
    r, rows = random.Random(5), []
    for conv in [*range(150), None]:
        for turn in range(r.randrange(1, 7)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"])
            text = r.choice(["a.", "b!", "c", " \t", "", None, f"t{turn}? \n", f"x{turn}. "])
            rows.append((conv, r.choice([turn, turn + 3, None]) if r.random() < 0.3 else turn, role, text))
    rows += rows[:7]
    got = sorted(map(tuple, C.repair(C.damage(table(spark, rows))).collect()), key=str)
    assert got == by_hand(rows)


def test_grammar_with_all_short_sequences():
    for n in range(5):
        for roles in itertools.product(["system", "user", "assistant"], repeat=n):
            rows = [(1, k, role, f"{k}.") for k, role in enumerate(roles)]
            turns = []
            work = C.Repair(lambda role, text: turns.append((role, text)))
            for _, _, role, text in rows:
                work.push(role, text, C.NONE)
            assert (*work.finish(), tuple(turns)) == cheapest(rows, [0] * n)


@pytest.mark.parametrize("block", [1, 2, 64])
def test_settling_letters_early_changes_nothing(monkeypatch, block):
    def run(rows):
        turns = []
        work = C.Repair(lambda role, text: turns.append((role, text)))
        for row in rows:
            work.push(*row)
        return *work.finish(), turns

    r = random.Random(3)
    for n in (0, 1, 5, 63, 64, 65, 400):
        rows = [(r.choice(["user", "assistant", "user", "system"]), f"{k}", r.choice([0, 0, 0, 1, 2, 3])) for k in range(n)]
        monkeypatch.setattr(C, "BLOCK", 10**4)
        whole = run(rows)
        monkeypatch.setattr(C, "BLOCK", block)
        assert run(rows) == whole


def test_long_conversation_is_settled_as_it_comes():
    turns = []
    work = C.Repair(lambda role, text: turns.append(role))
    for k in range(20_000):
        work.push("user" if k % 2 else "assistant", "t.", C.NONE)
        assert len(work.pending) <= 2 * C.BLOCK and work.places <= 16 * C.BLOCK
    cost, audit = work.finish()
    assert cost == 4 and len(turns) == 20_002 and audit == "I" + "K" * 20_000 + "I"


def test_repaired_turns_and_odd_tables(spark):
    rows = [(7, 0, "system", "s."), (7, 1, "user", "q"), (7, 2, "user", "q2?"), (8, 0, "user", "a."), (8, 1, "assistant", "b.")]
    found = C.repair(table(spark, rows), turns=True).orderBy("conv_id", "place").collect()
    assert [tuple(x) for x in found] == [(7, 0, "system", "s."), (7, 1, "user", "q"), (7, 2, "assistant", "q2?"), (8, 0, "user", "a."), (8, 1, "assistant", "b.")]
    assert C.repair(C.damage(table(spark, []))).collect() == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert [tuple(x) for x in C.repair(C.damage(table(spark, [(gone, 0, "user", "a.")]))).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
