import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from heliotab.llm import turns
from heliotab.llm.registry import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\f\r"


def brute_damage(rows):
    """Live rows of every conversation in order, and all conversations."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out[conv] += [(turn, "user" if harm == 4 else role, text)] * {0: 0, 3: 2}.get(harm, 1)
    for live in out.values():
        live.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def brute_edits(rows):
    """The cheapest edits, ties to the least string, from the last turn backwards over whole strings."""
    good = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        options = [(0, "")] if i == len(rows) and last in ("", "a") else []
        if inserted < 4:
            to = "a" if last == "u" else "u"
            cost, rest = best(i, to, inserted + 1)
            options.append((cost + 2, "I" + rest))
        if i < len(rows):
            initial, fault = rows[i]
            cost, rest = best(i + 1, last, 0)
            options.append((cost + 3, "D" + rest))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if initial in good[last] and initial:
                    cost, rest = best(i + 1, initial, 0)
                    options.append((cost + more, "K" + rest))
                for to in "ua":
                    if to in good[last]:
                        cost, rest = best(i + 1, to, 0)
                        options.append((cost + 2 + more, "R" + rest))
        return min(options) if options else (10**9, "")

    for i in reversed(range(len(rows))):
        for last in good:
            best(i, last, 0)
    return best(0, "", 0)


def brute(rows):
    out = []
    for conv, live in brute_damage(rows).items():
        seen, kinds, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in live:
            end = text.rstrip(SPACE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else None if end[-1] in ".!?" else "truncated"
            seen.add((role, text))
            kinds.append((role[:1], fault))
            if fault:
                n[fault] += 1
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(kinds))
        numbers = [t for t, _, _ in live if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = brute_edits(kinds)
        lines, last, at = [], "", 0
        for e in audit:
            if e == "I":
                last = "a" if last == "u" else "u"
                lines.append({"u": "user:", "a": "assistant:"}[last])
                continue
            _, role, text = live[at]
            at += 1
            if e == "K":
                last = role[0]
                lines.append(f"{role}:{text}")
            elif e == "R":
                last = "a" if last == "u" else "u"
                lines.append({"u": "user:", "a": "assistant:"}[last] + text)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def run(spark, sf, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("clash"), "live": F.lit(False), "fault": F.lit(9)}).repartition(parts)
    return sorted((tuple(r) for r in QUERIES["op12_conversation_repair"](spark, sf(conversations=df)).collect()), key=repr)


def invented(n, seed, roles=("system", "user", "assistant", "user", "assistant", "tool", "", None), longest=9):
    rng = random.Random(seed)
    texts = ["ok.", "yes!", "why?", "cut off", "a. b", "", " \t", None, "é.", "x" * 50 + ".", "ok.  \n", " ", "end.\x0b"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(0, longest)):
            if rng.random() < 0.95:
                rows.append((conv, turn if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts)))
    return rows


def test_equals_brute_force(spark, sf):
    rows = invented(400, 1) + invented(60, 2, ("user", "assistant"), 30)
    assert run(spark, sf, rows) == brute(rows)


def test_every_short_sequence_of_kinds():
    """All sequences of up to four kinds of turns: the carried state finds what whole strings find."""
    kinds = [(i, f) for i in "sua?" for f in (None, "blank", "truncated")]
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            c = turns.Conversation(0)
            for initial, fault in rows:
                code = 4 * "sua?".index(initial) + 2 * (fault == "blank") + (fault == "truncated")
                c.add(0, initial, "", code, 0)
            assert c.edits() == brute_edits(rows), rows
    assert len(turns.TABLE.back) < 10_000


def test_long_random_sequences():
    rng = random.Random(4)
    for _ in range(300):
        rows = [(rng.choice("sua?"), rng.choice((None, None, "blank", "truncated"))) for _ in range(rng.randrange(60))]
        c = turns.Conversation(0)
        for initial, fault in rows:
            c.add(0, initial, "", 4 * "sua?".index(initial) + 2 * (fault == "blank") + (fault == "truncated"), 0)
        assert c.edits() == brute_edits(rows)


def test_defined_results(spark, sf):
    rows = [(None, 1, "user", "hi."), (None, None, "assistant", "yes."), (None, 2, None, None), (5, None, "user", "a."), (5, None, "user", "a.")]
    rows += [(6, 1 << 60, "user", "a."), (6, -(1 << 60), "assistant", "b."), (7, 3, "user", "x"), (7, 3, "user", "x"), (7, 3, "assistant", "a")]
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    rows += [(9, dropped, "user", "gone.")]
    got = run(spark, sf, rows)
    assert got == brute(rows)
    assert next(r for r in got if r[0] == 9) == (9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert run(spark, sf, []) == []


def test_giant_conversation_spills(spark, sf, monkeypatch):
    """One conversation holds nearly all rows; its texts and backpointers go through files in small pieces."""
    rng = random.Random(7)
    rows = [(1, t, rng.choice(("user", "assistant")), rng.choice(("ok.", "so", "w" * 300 + "!")) + str(t) + ".") for t in range(3000)]
    rows += invented(20, 8)
    rows = [(c + 10 if i >= 3000 else c, *r) for i, (c, *r) in enumerate(rows)]
    got = run(spark, sf, rows)
    assert got == brute(rows)
    c = turns.Conversation(1)
    monkeypatch.setattr(turns, "SPILL", 64)
    plain = brute_damage(rows)[1][:500]
    for turn, role, text in plain:
        c.add(turn, role, text, 4 if role == "user" else 8, 0)
    assert c.texts.file and c.numbers.blocks > 5
    cost, audit = c.edits()
    assert (cost, audit) == brute_edits([(r[0], None) for _, r, _ in plain])
    texts = iter(plain)
    assert [t for _, t, e in c.repaired(audit) if e != "I"] == [t for (_, _, t), e in zip(texts, audit.replace("I", "")) if e != "D"]


@pytest.mark.parametrize("roles,audit", [("ua", "KK"), ("u", "KI"), ("a", "IK"), ("uu", "KR"), ("s", "D"), ("sua", "KKK"), ("uua", "KIKK")])
def test_repaired_turns(spark, roles, audit):
    names = {"u": "user", "a": "assistant", "s": "system"}
    df = spark.createDataFrame([(1, i, names[r], f"t{i}.") for i, r in enumerate(roles)], SCHEMA)
    assert turns.reports(df).first().audit == audit
    out = sorted((r.position, r.role, r.text, r.edit) for r in turns.repaired(df).collect())
    assert "".join(r[1][0] for r in out) in ("", "ua", "sua", "uaua")
    assert [r[3] for r in out] == [e for e in audit if e != "D"]
