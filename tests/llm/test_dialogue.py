"""Conversation repair: exhaustive search, a plain programme with whole strings, spilling, odd rows."""

from __future__ import annotations

import glob
import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from hourgrid.llm import dialogue
from hourgrid.llm.common import table
from hourgrid.session import shared_dir

SOUND = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    """The first fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        last = text.strip(SPACE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def options(role, fault):
    yield 2, "D", []
    if fault not in ("blank", "duplicate"):
        more = 5 * (fault == "truncated")
        yield more, "K", [role]
        yield 1 + more, "R", ["user"]
        yield 1 + more, "R", ["assistant"]


def searched(rows):
    """(cost, audit, roles) by trying everything, with at most two turns put in at a place."""
    puts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    found = faults(rows)
    best = None
    for edits in product(*[list(options(r, f)) for (r, _), f in zip(rows, found)]):
        for inserted in product(puts, repeat=len(rows) + 1):
            cost = sum(e[0] for e in edits) + 5 * sum(map(len, inserted))
            if best is not None and cost > best[0]:
                continue
            letters, roles = "", []
            for k, put in enumerate(inserted):
                letters += "I" * len(put)
                roles += put
                if k < len(rows):
                    letters += edits[k][1]
                    roles += edits[k][2]
            if SOUND.fullmatch("".join(r[:1] or "?" for r in roles)):
                best = min(best or (cost, letters, roles), (cost, letters, roles))
    return best


def programmed(rows):
    """(cost, audit, roles) by a programme that carries whole strings."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    new = {0: "user", 1: "user", 2: "assistant", 3: "user"}

    def inserted(states):
        states = dict(states)
        for _ in range(3):
            for s, (cost, letters, roles) in list(states.items()):
                t = after[s][new[s][0]]
                way = (cost + 5, letters + "I", roles + [new[s]])
                states[t] = min(states.get(t, way), way, key=lambda w: w[:2])
        return states

    states = inserted({0: (0, "", [])})
    for (role, _), fault in zip(rows, faults(rows)):
        out = {}
        for s, (cost, letters, roles) in states.items():
            for own, letter, add in options(role, fault):
                t = s if letter == "D" else after[s].get((add[0][:1] or "?"))
                if t is not None:
                    way = (cost + own, letters + letter, roles + add)
                    out[t] = min(out.get(t, way), way, key=lambda w: w[:2])
        states = inserted(out)
    return min((states[s] for s in (0, 3) if s in states), key=lambda w: w[:2])


def plain(conv):
    """The report of (turn, role, text) rows in order."""
    rows = [(r, t) for _, r, t in conv]
    cost, audit, roles = programmed(rows)
    kept, at, out = iter(roles), 0, []
    for letter in audit:
        text = rows[at][1] if letter != "I" else ""
        at += letter != "I"
        if letter != "D":
            out.append(f"{next(kept)}:{text}")
    found = faults(rows)
    turns = sorted({t for t, _, _ in conv if t is not None})
    gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, digest


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def made(seed, count, longest, roles=("system", "user", "user", "assistant", "assistant", "tool", "")):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut", "  ", "", "What? ", "A b.\n", "again.", "é.", "more, "]
    return {
        c: ordered([(rng.choice([k, k, k + 1, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"own {k}.") for k in range(rng.randrange(longest))])
        for c in range(count)
    }


def frame(spark, convs):
    return spark.createDataFrame([(c, *r) for c, rows in convs.items() for r in rows], SCHEMA).repartition(5)


def test_programme_against_search():
    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", " ", "a."])) for _ in range(rng.randrange(4))]
        assert programmed(rows)[:2] == searched(rows)[:2], rows


def test_many_conversations(spark):
    convs = made(1, 400, 14)
    found = got(dialogue.report(frame(spark, convs)))
    assert found == {c: plain(rows) for c, rows in convs.items() if rows}


@pytest.mark.parametrize("held", [1, 3000])
def test_giant_conversations_spill(spark, held):
    """Turns and backpointers go through files of the shared folder, which are gone afterwards."""
    convs = made(2, 4, 3000)
    df = frame(spark, convs).repartition(3)
    found = got(dialogue.report(df, held=held))
    assert found == {c: plain(rows) for c, rows in convs.items()}
    turns = dialogue.repaired(df, held=held).orderBy("conv_id", "place").collect()
    for c, rows in convs.items():
        own = [t for t in turns if t.conv_id == c]
        assert [t.place for t in own] == list(range(len(own)))
        text = "\n".join(f"{t.role}:{t.text}" for t in own)
        assert hashlib.sha256(text.encode()).hexdigest() == found[c][-1]
        assert SOUND.fullmatch("".join(t.role[:1] for t in own))
    assert not glob.glob(f"{shared_dir(spark)}/turns-*/*.arrow")


def test_few_transitions_whatever_the_length():
    """The costs over the cheapest are bounded, so the situations are few."""
    plan = dialogue.Programme()
    rng = random.Random(5)
    number = plan.first
    for _ in range(200_000):
        number, _, _ = plan.step(number, rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]))
    assert len(plan.wholes) < 2000


def test_odd_tables(spark):
    clash = ["key", "said", "numbered", "repeated", "by0", "place", "edit", "audit"]
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (1, None, None, "x"), (1, 2, "user", None), (2, 5, "user", "Hi."),
        (2, 5, "user", "Hi."), (2, 9, "assistant", "Ok."), (3, 1, "User", "A."), (3, 2, "assistant", "日本語。"), (4, 0, "system", "word " * 40_000 + "."),
    ]
    df = spark.createDataFrame([(*r, *["z"] * len(clash)) for r in rows], SCHEMA + "".join(f", {c} string" for c in clash))
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    assert got(dialogue.report(df)) == {c: plain(ordered(v)) for c, v in convs.items()}
    assert dialogue.report(df.limit(0)).count() == dialogue.repaired(df.limit(0)).count() == 0
    named = df.select(F.col("conv_id").cast("string").alias("c"), F.col("turn").alias("t"), F.col("role").alias("r"), F.col("text").alias("x"))
    assert {r.conv_id for r in dialogue.report(named, "c", "t", "r", "x").collect()} == {None, "1", "2", "3", "4"}


def spoilt(rows):
    """Rows after the planted faults, in order."""
    out = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            new = (t, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            out += [(role, text, new)] * (2 if fate == 3 else 1)
    return [n for *_, n in sorted(out, key=lambda x: (x[2][0] is not None, x[2][0] or 0, x[0].encode(), x[1].encode()))]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    convs: dict = {}
    for r in table(spark, sf_dir, "conversations").collect():
        convs.setdefault(r.conv_id, []).append(tuple(r))
    found = got(dialogue.query(spark, sf_dir))
    assert found == {c: plain(spoilt(rows)) for c, rows in convs.items()}
    assert {v[-2] for v in found.values()} != {""}


def test_all_rows_dropped(spark, tmp_path):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = got(dialogue.query(spark, str(tmp_path)))
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(found) == {gone, None}
