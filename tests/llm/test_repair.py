"""Conversation repair against a plain table of rows by states."""

import hashlib
import random
import re
import zlib

import pytest

from adlens.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def space(v):
    return " " if v is None else str(v)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def plain(rows, ids):
    """The contract's columns by a dynamic program over whole conversations
    that carries (cost, audit, repaired rows) for every state."""
    out = []
    for conv in ids:
        own = sorted(((t, space(r), space(x)) for c, t, r, x in rows if c == conv),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in own:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        best = {"": (0, "", ())}        # by the last kept role's initial ("" for none)
        for (_, role, text), fault in zip([*own, (None, None, None)], [*faults, "end"]):
            grown = {}

            def offer(state, cost, audit, kept):
                if state not in grown or (cost, audit) < grown[state][:2]:
                    grown[state] = (cost, audit, kept)

            for state, (cost, audit, kept) in best.items():
                for inserts in range(4):
                    follows = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                    name = {"u": "user", "a": "assistant"}[follows]
                    if fault == "end":
                        if state in ("", "a"):
                            offer("end", cost, audit, kept)
                    else:
                        offer(state, cost + 3, audit + "D", kept)
                        if fault not in ("blank", "duplicate"):
                            more = cost + (fault == "truncated")
                            if role[:1] == follows:
                                offer(follows, more, audit + "K", (*kept, f"{role}:{text}"))
                            if role[:1] == "s" and state == "":
                                offer("s", more, audit + "K", (*kept, f"{role}:{text}"))
                            offer(follows, more + 2, audit + "R", (*kept, f"{name}:{text}"))
                    state, cost, audit, kept = follows, cost + 2, audit + "I", (*kept, f"{name}:")
            best = grown
        cost, audit, kept = best["end"]
        assert GRAMMAR.match("".join(k[0] for k in kept))
        turns = {t for t, _, _ in own if t is not None}
        initials = [r[:1] for _, r, _ in own]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                    faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                    cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def conversations(seed, n, longest=12):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "sage"])
            text = rng.choice(["Yes.", "No", "a b!", " \t", "", None, "Why?\n", "end ,", "x" * rng.randint(1, 9) + "."])
            rows.append((conv if conv % 17 else None, rng.choice([turn, turn, turn + 3, None]), role, text))
    return rows


@pytest.mark.parametrize("block", [1024, 3, 1])
def test_equals_the_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "PIECE", 8 if block == 3 else 1 << 20)
    rows = conversations(block, 60)
    ids = sorted({r[0] for r in rows}, key=str)
    df = table(spark, rows)
    got = repair.repair(repair.damage(df), df.select("conv_id")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(damaged(rows), ids), key=str)
    assert sorted(map(tuple, repair.repair(df).collect()), key=str) == sorted(plain(rows, ids), key=str)


def test_a_long_conversation_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 64)
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"t{t}.", f"t{t}", "again.", ""])) for t in range(1500)]
    rows += [(2, t, "user", "same.") for t in range(700)] + [(3, None, "user", "same.")] * 300
    assert sorted(map(tuple, repair.repair(table(spark, rows)).collect())) == plain(rows, [1, 2, 3])


def test_hirschberg_equals_all_ways():
    costs = repair.Costs()
    rng = random.Random(3)
    for n in range(1, 6):
        for _ in range(60):
            codes = bytes(rng.randrange(16) for _ in range(n))
            for state in range(4):
                ways = [(0, "", state)]
                for c in codes:
                    ways = [(a + cost, x + audit, after) for a, x, s in ways for after, cost, audit in costs.ways[c][s]]
                total, audit, after = min((a + len(repair.TAIL[s]) * 2, x, s) for a, x, s in ways)
                assert costs.solve(codes, state, costs.end) == (after, audit)
                assert costs.backward(costs.end, codes)[state] == total
                for s in range(4):
                    assert costs.forward(state, codes)[s] == min([a for a, _, q in ways if q == s], default=repair.FAR)


def test_odd_tables(spark):
    empty = table(spark, [])
    assert repair.repair(empty).collect() == []
    ids = table(spark, [(5, 0, "user", "x."), (None, 0, "a", "b")]).select("conv_id")
    none = ("", hashlib.sha256(b"").hexdigest())
    assert sorted(map(tuple, repair.repair(empty, ids).collect()), key=str) == sorted([(5, 0, 0, 0, 0, 0, 0, *none), (None, 0, 0, 0, 0, 0, 0, *none)], key=str)
    rows = [(1, None, None, None), (1, None, None, None), (2, 1, "user", "x" * 300_000 + "."), (2, 2, "assistant", "y" * 300_000)]
    df = table(spark, rows).selectExpr("*", "1 as at", "2 as part", "'k' as kind", "3 as conv", "4 as audit")
    assert sorted(map(tuple, repair.repair(df).collect())) == plain(rows, [1, 2])


def test_repaired_rows_follow_the_audit(spark):
    rows = conversations(5, 30)
    df = table(spark, rows)
    edits = {}
    for r in repair.repaired_rows(df).orderBy("conv_id", "block", "place").collect():
        edits.setdefault(r["conv_id"], []).append(r)
    for r in repair.repair(df).collect():
        own = edits[r["conv_id"]]
        assert "".join(e["edit"] for e in own) == r["audit"]
        kept = "\n".join(f"{e['role']}:{e['text']}" for e in own if e["edit"] != "D")
        assert hashlib.sha256(kept.encode()).hexdigest() == r["repaired_sha256"]
