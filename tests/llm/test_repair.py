import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from addrflow.llm import repair as R

SCHEMA = "conv_id long, turn int, role string, text string, at long, audit string, code int"
LEGAL = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2], r[3]))


def faults(turns):
    """blank, duplicate, truncated or None of each (role, text)."""
    out, seen = [], set()
    for role, text in turns:
        core = text.rstrip(SPACES)
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def follow(initial, state):
    """The state after a row with this initial, or None."""
    return {("s", ""): "s", ("u", ""): "u", ("u", "s"): "u", ("u", "a"): "u", ("a", "u"): "a"}.get((initial, state))


def cheapest(turns):
    """(cost, audit, repaired rows): forwards over states, the least (cost, audit) of each."""
    marks = faults(turns)
    best = {"": (0, "", [])}

    def insert():
        for _ in range(2):
            for state, (cost, audit, rows) in list(best.items()):
                for role in ("user", "assistant"):
                    to = follow(role[0], state)
                    if to is not None and ((new := (cost + 3, audit + "I"))) < best.get(to, (1 << 60, ""))[:2]:
                        best[to] = (*new, [*rows, (role, "")])

    insert()
    for (role, text), mark in zip(turns, marks, strict=True):
        after: dict = {}
        for state, (cost, audit, rows) in best.items():
            ways = [(state, 4, "D", [])]
            if mark not in ("blank", "duplicate"):
                more = 3 if mark == "truncated" else 0
                ways.append((follow(role[:1], state), more, "K", [(role, text)]))
                ways += [(follow(r[0], state), more + 3, "R", [(r, text)]) for r in ("user", "assistant")]
            for to, c, letter, row in ways:
                if to is not None and (cost + c, audit + letter) < after.get(to, (1 << 60, ""))[:2]:
                    after[to] = (cost + c, audit + letter, rows + row)
        best.clear()
        best.update(after)
        insert()
    return min(best[s] for s in ("", "a") if s in best)


def brute(rows, ids):
    out = []
    for conv in ids:
        own = [r for r in rows if r[0] == conv]
        turns = [(role, text) for _, _, role, text in own]
        marks, known = faults(turns), {t for _, t, _, _ in own if t is not None}
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:], strict=False))
        cost, audit, fixed = cheapest(turns)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out.append((conv, gaps, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"), illegal, cost, audit, sha))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()), key=str)


def talk(seed, convs=60, longest=12):
    rng = random.Random(seed)
    texts = [None, "", " \n", "yes.", "yes. ", "no", "why?", "ok!", "done.\t", "...", "x.y", "é。", "z" * 50 + "."]
    rows = []
    for conv in range(convs):
        turn = rng.randrange(3)
        for k in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "system", "tool", None, "User", "agent", ""]) if rng.random() < 0.4 else ("user", "assistant")[k % 2]
            rows.append((conv, turn if rng.random() < 0.95 else None, role, rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(99)}."))
            turn += rng.choice([0, 1, 1, 1, 1, 3])
    return rows + [(None, 1, "user", "hm."), (None, 2, "assistant", "hm")]


def test_brute_force_agrees_with_all_audits():
    """The stepwise version against a listing of all audits of short conversations."""
    rng = random.Random(3)
    for _ in range(60):
        turns = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", "c?"])) for _ in range(rng.randrange(4))]
        marks = faults(turns)
        found = []
        for length in range(2 * len(turns) + 3):
            for audit in itertools.product("DIKR", repeat=length):
                if len(audit) - audit.count("I") != len(turns):
                    continue
                ways, k, cost = [""], 0, 0
                for letter in audit:
                    if letter == "I":
                        ways, cost = [w + r for w in ways for r in "ua"], cost + 3
                        continue
                    if letter == "D":
                        cost += 4
                    else:
                        cost += 99 if marks[k] in ("blank", "duplicate") else (3 if marks[k] == "truncated" else 0) + (3 if letter == "R" else 0)
                        ways = [w + r for w in ways for r in (turns[k][0][0] if letter == "K" else "ua")]
                    k += 1
                if any(LEGAL.fullmatch(w) for w in ways):
                    found.append((cost, "".join(audit)))
        assert cheapest(turns)[:2] == min(found)


@pytest.mark.parametrize("seed,chunk", [(1, 1024), (2, 3)])
def test_odd_conversations_equal_brute_force(spark, seed, chunk):
    rows = talk(seed)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    found = R.repair(R.damage(df), chunk)
    assert got(R.report_all(df, found.report)) == brute(damaged(rows), {r[0] for r in rows})


def test_one_long_conversation(spark):
    """A conversation of many chunks and partitions, and its repaired rows."""
    rng = random.Random(7)
    rows = [(5, t, rng.choice(["user", "assistant"]), f"t{rng.randrange(2000)}{rng.choice('.!?x')}") for t in range(3000)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    found = R.repair(df, 64)
    own = [(r.role, r.text) for r in found.turns.orderBy("at", "nth").collect()]
    assert got(found.report) == brute(rows, {5})
    assert own == cheapest([(role, text) for _, _, role, text in rows])[2]
    assert LEGAL.fullmatch("".join(r[0] for r, _ in own))


def test_empty_table_and_no_rows_left(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert R.report_all(none, R.repair(R.damage(none)).report).collect() == []
    conv = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(conv, 0, "user", "x.", 1, "x", 2)], SCHEMA)
    assert got(R.report_all(one, R.repair(R.damage(one)).report)) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_products_by_doubling():
    rng = np.random.default_rng(1)
    codes, number = rng.integers(0, 16, 50), np.sort(rng.integers(0, 6, 50))
    m = R.row_matrices(codes)
    whole = R.to_the_end(m, number)
    for i in range(50):
        x = m[i]
        for j in range(i + 1, 50):
            if number[j] == number[i]:
                x = (x[:, :, None] + m[j][None]).min(1)
        assert (np.minimum(x, R.FAR) == whole[i]).all()
