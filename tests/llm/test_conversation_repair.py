"""Conversation repair against a plain shortest path over whole audits, in one task and in many."""

from __future__ import annotations

import hashlib
import random
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forespell.llm import conversation_repair as cr
from forespell.llm import queries

SF_DIR = "/root/testdata/sf0.01"
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = {1: "", 2: text.translate({ord(c): None for c in ".!?"})}.get(fault, text)
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def said(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def best(rows):
    """(cost, audit, lines) by states: the least (cost, audit) of each, row by row."""
    options = {"": (0, "", ())}  # by the last two initials that matter: "", s, u, a
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def insert(states):
        out = dict(states)
        for _ in range(2):
            for state, (cost, audit, lines) in list(out.items()):
                new = after[state]
                made = (cost + 2, audit + "I", (*lines, ("user" if new == "u" else "assistant") + ":"))
                if new not in out or made[:2] < out[new][:2]:
                    out[new] = made
        return out

    for role, text, fault in rows:
        states = {}

        def offer(state, value, states=states):
            if state not in states or value[:2] < states[state][:2]:
                states[state] = value

        for state, (cost, audit, lines) in insert(options).items():
            offer(state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 1 if fault == "truncated" else 0
            new = after[state]
            offer(new, (cost + 2 + more, audit + "R", (*lines, f"{'user' if new == 'u' else 'assistant'}:{text}")))
            if role[:1] == new or (role[:1] == "s" and state == ""):
                offer(role[:1], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
        options = states
    return min(v for s, v in insert(options).items() if s in ("", "a"))


def brute(original, rows):
    convs = {}
    for conv, *rest in rows:
        convs.setdefault(conv, []).append(rest)
    out = {}
    for conv in {r[0] for r in original}:
        mine = sorted(convs.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], said(r[1], r[2])))
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, role, text in mine:
            bare = text.strip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
        cost, audit, lines = best(marked)
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def result(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", b"y") for r in rows], "conv_id long, turn long, role string, text string, part int, live string, said binary")


def repaired(df):
    return result(cr.digest(df, cr.repair(df)))


def test_whole_table(spark):
    rows = [tuple(r) for r in queries.table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.op12_conversation_repair(spark, SF_DIR)) == brute(rows, damaged(rows))


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def random_rows(seed, conv, n):
    draw = random.Random(seed)
    role = lambda: draw.choices(["user", "assistant", "system", "tool", "", None], [6, 6, 1, 1, 0.3, 0.3])[0]
    text = lambda k: draw.choices([f"line {k}.", f"line {draw.randint(0, 5)}", "same!", "", " \t", None, f"é {k}?\n "], [6, 2, 1, 0.5, 0.3, 0.3, 1])[0]
    turn = lambda k: draw.choices([k, k // 2, None], [8, 1, 0.4])[0]
    return [(conv, turn(k), role(), text(k)) for k in range(n)]


def test_long_conversations_over_many_tasks(spark, many_tasks):
    rows = random_rows(1, 7, 1500) + random_rows(2, None, 300) + [(5, 3, "user", "copy.")] * 400
    rows += [(6, k, "assistant", "again.") for k in range(300)]
    rows += [r for c in range(100, 140) for r in random_rows(c, c, c % 7)]
    rows += [(200, k, "user" if k % 2 == 0 else "assistant", f"{k}.") for k in range(401)]
    df = frame(spark, rows).repartition(5)
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    repair = cr.repair(df)
    assert result(cr.digest(df, repair)) == brute(rows, clean)
    assert repair.pieces.filter("conv = '7'").count() > 3  # a long conversation in several tasks


def test_damage(spark):
    rows = random_rows(3, 1, 300) + random_rows(4, None, 60) + [(c, None, "user", "hello.") for c in range(80)]
    got = sorted(cr.damage(frame(spark, rows)).collect(), key=repr)
    assert got == sorted((r for r in spark.createDataFrame(damaged(rows), "conv_id long, turn long, role string, text string").collect()), key=repr)


def test_small_and_empty(spark):
    rows = [(1, 0, "system", "Be kind."), (2, 0, "user", ""), (3, 5, "assistant", "Yes"), (4, None, None, None)]
    clean = [(c, t, r or " ", x or " ") for c, t, r, x in rows]
    clean[1] = (2, 0, "user", "")
    assert repaired(frame(spark, rows)) == brute(rows, clean)
    assert repaired(frame(spark, [])) == {}
    df = frame(spark, rows)
    nothing = result(cr.digest(df, cr.repair(df.filter("false"))))
    assert nothing[3] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) and len(nothing) == 4
    kept = cr.repair(frame(spark, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello!")])).rows.orderBy("seq").collect()
    assert [(r["edit"], r["role"], r["text"]) for r in kept] == [("K", "user", "Hi."), ("K", "assistant", "Hello!")]


def steps(symbols):
    """Rows for ``best`` of some symbols."""
    initials = ["system", "user", "assistant", "tool"]
    return [("x", str(k), "blank") if s == cr.GONE else (initials[s // 2], str(k), "truncated" if s % 2 else "") for k, s in enumerate(symbols)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(1, 9)), min_size=1, max_size=6))
def test_runs_against_rows(runs):
    symbols, counts = [s for s, _ in runs], [n for _, n in runs]
    rows = [s for s, n in runs for _ in range(n)]
    ((_, last, audit),) = cr.plans(symbols, counts, [0], [cr.TO_END])
    assert audit + "I" * (cr.TO_END[last] // 2) == best(steps(rows))[1]


def test_powers_are_repeated_steps():
    for symbol, j in product(range(9), range(4)):
        want = cr.row_costs(symbol)
        for _ in range(2**j - 1):
            want = cr.times(want, cr.row_costs(symbol))
        assert cr.power(symbol, j) == want
