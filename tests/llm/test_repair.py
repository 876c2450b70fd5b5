"""Operator 13 against plain dynamic programming, exhaustive search and its SQL."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from tributary.llm import conversation_repair as repair
from tributary.llm.oracles import ORACLES

PATTERN = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, cost string, seq long, audit int"


def broken(rows):
    """Rows after damage by conversation, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if draw:
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            out[conv] += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def faults(own):
    seen, out = set(), []
    for _, role, text in own:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def outcome(own, found, audit):
    """(cost, rows) of an audit, None if it is no repair. The roles follow from the places."""
    rows, cost, i = [], 0, 0
    for letter in audit:
        if letter != "I":
            if i == len(own):
                return None
            turn, role, text = own[i]
            fault, i = found[i], i + 1
        if letter == "D":
            cost += 2
            continue
        if letter != "I" and fault in (1, 2):
            return None
        want = "assistant" if rows and rows[-1][0][:1] == "u" else "user"
        if letter == "K":
            rows.append((role, text))
        else:
            rows.append((want, text if letter == "R" else ""))
        cost += {"K": 0, "R": 1, "I": 5}[letter] + (5 if letter != "I" and fault == 3 else 0)
    if i < len(own) or not PATTERN.match("".join(r[:1] or "-" for r, _ in rows)):
        return None
    return cost, rows


def best(own, found):
    """Least (cost, audit) over states after each row, with one insertion at most before a row and at the end."""
    follows = {"0": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}

    def inserted(states):
        out = dict(states)
        for q, (cost, audit) in states.items():
            for x, t in follows[q].items():
                if x != "s":
                    out[t] = min(out.get(t, (10 ** 9, "")), (cost + 5, audit + "I"))
        return out

    states = {"0": (0, "")}
    for (_, role, _), fault in zip(own, found):
        after = {}
        for q, (cost, audit) in inserted(states).items():
            ways = [(q, 2, "D")]
            if fault not in (1, 2):
                for x, t in follows[q].items():
                    if role[:1] == x:
                        ways.append((t, 5 * (fault == 3), "K"))
                    if x != "s":
                        ways.append((t, 1 + 5 * (fault == 3), "R"))
            for t, more, letter in ways:
                after[t] = min(after.get(t, (10 ** 9, "")), (cost + more, audit + letter))
        states = after
    return min(w for q, w in inserted(states).items() if q in "0A")


def expected(rows):
    out = {}
    after = broken(rows)
    for conv in {r[0] for r in rows}:
        own = after.get(conv, [])
        found = faults(own)
        cost, audit = best(own, found)
        fixed = outcome(own, found, audit)
        assert fixed[0] == cost
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(k) for k in (1, 2, 3)),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed[1]).encode()).hexdigest())
    return out


def talk(seed, conversations=60, longest=12):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            role = ("system" if turn == 0 and rng.random() < 0.3 else ("user", "assistant")[turn % 2])
            if rng.random() < 0.3:
                role = rng.choice(["user", "assistant", "system", "User", "tool", "", None, "sage"])
            text = rng.choice(["Yes.", "No!", "Who?", "cut off", "", None, " \n", "é? ", "a.b", f"t{rng.random()}."])
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), role, text))
    return rows


def awkward():
    rows = talk(1)
    rows += [(None, t, ("user", "assistant")[t % 2], f"n{t}.") for t in range(5)]
    rows += [(900, None, "user", "a."), (900, None, "assistant", "b."), (900, 1, "user", "c."), (901, None, None, None)]
    rows += [(902, 3, "user", "same.")] * 4 + [(903, 7, "user", "x" * 200_000 + "."), (903, 8, "assistant", "y.")]
    rows += [(904, t, "user", "") for t in range(30)] + [(905, 2 ** 40, "assistant", "z."), (905, -5, "user", "q.")]
    rng = random.Random(3)
    rows += [(910, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"w{t}.", "again!", "open"])) for t in range(700)]
    rows += [(911, t, ("user", "assistant")[t % 2], f"v{t}.") for t in range(300)]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "c", 5, 1) for r in rows], SCHEMA).repartition(parts)


def result(got, fixed):
    rows = {(r["no_conv"], r["conv"]): r for r in got.collect()}
    hashes = {(r["no_conv"], r["conv"]): r["repaired_sha256"] for r in repair.digests(fixed).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {None if k[0] else k[1]: (*(r[c] for c in ("gaps", *repair.COUNTS, "cost", "audit")), hashes.get(k, nothing))
            for k, r in rows.items()}


@pytest.mark.parametrize("longest", [256, 3, 1])
def test_repairs(spark, longest):
    rows = awkward()
    want = expected(rows)
    got = result(*repair.repair(repair.damaged(frame(spark, rows)), longest))
    left = broken(rows)
    assert got == {k: v for k, v in want.items() if k in left}


def test_query_and_sql(spark, tmp_path):
    rows = awkward()
    frame(spark, rows, 1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = repair.op13_structure_repair(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == sorted(((k, *v) for k, v in expected(rows).items()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(con.execute(ORACLES["op13_structure_repair"]).fetchall(), key=repr) == got


def test_nothing(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert repair.op13_structure_repair(spark, str(tmp_path)).count() == 0


def test_agenda_finds_the_least_of_all_audits():
    rng = random.Random(5)
    for _ in range(150):
        own = [(t, rng.choice(["system", "user", "assistant", ""]), rng.choice(["a.", "b!", "cut", ""]))
               for t in range(rng.randrange(5))]
        found = faults(own)
        tried = ((outcome(own, found, "".join(a)), "".join(a)) for n in range(len(own) + 3)
                 for a in itertools.product("DIKR", repeat=n))
        least = min((o[0], a) for o, a in tried if o)
        kinds = "".join(repair._kind(r[:1] if r[:1] in ("s", "u", "a") else "-", f) for (_, r, _), f in zip(own, found))
        (cost, audit, _), = repair._repairs(kinds, repair.START, repair.ENDS).values()
        assert (cost, audit) == least == best(own, found)


def test_weights_are_superior():
    """What follows an item never makes it lighter, so popped items are final."""
    for kind in map(chr, range(ord("A"), ord("A") + 12)):
        for state in repair.STATES:
            for taken, _, cost, letters in repair._edits(kind, state):
                assert taken == 1 and cost >= 0 and len(letters) == 1
