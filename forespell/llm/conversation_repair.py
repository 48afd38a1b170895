"""Conversation repair: the cheapest edits that make the roles of each conversation regular.

Rows are taken by turn (nulls first; equal turns by role, then by the SHA-256 of role and
text). Each row has a first fault at most: *blank* (no character other than ``\\x20`` and
``\\x09-\\x0D``), *duplicate* (role and text seen earlier in the conversation), *truncated*
(the last such character is none of ``.!?``). Edits are Keep (0), Rerole to user or
assistant (2), Delete (3; blank and duplicate rows must go) and Insert an empty user or
assistant row (2); a truncated row that stays adds 1. The result's role initials form
``(s?(ua)+)?``. Of equally cheap edits those are taken whose initials, in order, come first
in ASCII.

How it runs:

* Texts stay behind. What is sorted is one light row for each distinct row (conversation,
  turn, SHA-256) with its number of copies, so copies cost nothing, however many there are.
* Light rows are range-partitioned by conversation and order, so a conversation of any length
  is spread over as many tasks as its rows fill. Each task collapses equal consecutive
  role/fault symbols into runs and sends every conversation's run through the binary powers
  (cached) of its symbol's min-plus transition between four states: nothing yet, after the
  system row, after user, after assistant. The choices are then unrolled front to back,
  in halves of powers of two that are cached as well.
* The first and last conversation of a task may go on in others. For these the task gives
  the cheapest edits for each pair of states at its ends: at most two *open* pieces a task,
  which a fold over the pieces of a conversation (costs back to front, choices front to
  back) joins.
* Kept rows fetch their texts by a join on their names.

Null roles and texts count as one space, so such texts are blank. Null conversation ids are
one conversation; null turns are no gaps. A conversation without rows is not in the result.
Roles other than system, user and assistant go by their initial: ``s``, ``u`` and ``a`` can
be kept, others only reroled or deleted. Extra columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forespell.llm.components import written

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: States: nothing yet, after the system row, after a user row, after an assistant row.
STATES = range(4)
NEVER = 1 << 50
#: Where a user or assistant row leads from each state, and the role it has there.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: What is still to be inserted, by final state.
TO_END = (0, 2 * INSERT, INSERT, 0)
#: Symbols: 2 * initial (s, u, a, other) + truncated; rows that must go are all alike.
INITIALS = ("s", "u", "a")
GONE = 8
LEGAL = {(0, 1), (1, 2), (2, 1)}
SPACE = " \t\n\x0b\x0c\r"

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def kept_state(symbol: int, state: int) -> int | None:
    """The state after keeping a row of this symbol, if it can be kept."""
    initial = symbol // 2
    if initial == 0 and state == 0:
        return 1
    return initial + 1 if initial in (1, 2) and NEXT[state] == initial + 1 else None


@cache
def row_costs(symbol: int) -> Matrix:
    """Cheapest edits from state to state over one row, with inserts before it."""
    row = [[NEVER] * 4 for _ in STATES]
    for s in STATES:
        row[s][s] = DELETE
        if symbol != GONE:
            row[s][NEXT[s]] = min(row[s][NEXT[s]], REROLE + symbol % 2 * CUT)
            t = kept_state(symbol, s)
            if t is not None:
                row[s][t] = KEEP + symbol % 2 * CUT
    out = []
    for s in STATES:
        one, two = NEXT[s], NEXT[NEXT[s]]  # more than two inserts only come back
        out.append(tuple(min(row[s][t], INSERT + row[one][t], 2 * INSERT + row[two][t]) for t in STATES))
    return tuple(out)


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(NEVER, *(a[s][m] + b[m][t] for m in STATES)) for t in STATES) for s in STATES)


@cache
def power(symbol: int, j: int) -> Matrix:
    """Costs over 2**j rows of one symbol."""
    return times(power(symbol, j - 1), power(symbol, j - 1)) if j else row_costs(symbol)


@lru_cache(1 << 16)
def before(symbol: int, j: int, after: Vector) -> Vector:
    """Cost to go before 2**j rows, given the cost to go after them; the least is 0."""
    costs = [min(c + v for c, v in zip(row, after, strict=True)) for row in power(symbol, j)]
    least = min(costs)
    return tuple(c - least if c < NEVER else NEVER for c in costs)


@lru_cache(1 << 16)
def choose(symbol: int, after: Vector, state: int) -> tuple[str, int]:
    """First in ASCII among the cheapest edits of one row and of inserts before it; the state after them."""
    rest = [min(c + v for c, v in zip(row, after, strict=True)) for row in row_costs(symbol)]
    out = ""
    while True:
        t, extra = kept_state(symbol, state), symbol % 2 * CUT
        if DELETE + after[state] == rest[state]:
            return out + "D", state
        if INSERT + rest[NEXT[state]] == rest[state]:
            out, state = out + "I", NEXT[state]
        elif symbol != GONE and t is not None and KEEP + extra + after[t] == rest[state]:
            return out + "K", t
        else:
            return out + "R", NEXT[state]


def halves(symbol: int, j: int, after: Vector, state: int) -> tuple[str, int]:
    """The choices over 2**j rows of one symbol."""
    if j == 0:
        return choose(symbol, after, state)
    walk = _kept_halves if j <= 10 else halves
    first, middle = walk(symbol, j - 1, before(symbol, j - 1, after), state)
    second, last = walk(symbol, j - 1, after, middle)
    return first + second, last


_kept_halves = lru_cache(1 << 12)(halves)


def binary(count: int) -> list[int]:
    return [j for j in range(count.bit_length()) if count >> j & 1]


def plans(symbols: list[int], counts: list[int], entries, ends: list[Vector]) -> Iterator[tuple[int, int, str]]:
    """Entry, exit and audit of the cheapest edits of the runs, for each entry state and each cost to go at the end."""
    for after in ends:
        steps = []
        for symbol, count in zip(reversed(symbols), reversed(counts), strict=True):
            for j in binary(count):
                steps.append((symbol, j, after))
                after = before(symbol, j, after)
        for entry in entries:
            if after[entry] >= NEVER:
                continue
            state, audit = entry, []
            for symbol, j, rest in reversed(steps):
                letters, state = halves(symbol, j, rest, state)
                audit.append(letters)
            yield entry, state, "".join(audit)


def cost_of(audit: str, cut_kept: int) -> int:
    return REROLE * audit.count("R") + DELETE * audit.count("D") + INSERT * audit.count("I") + CUT * cut_kept


class Piece:
    """The rows of one conversation that one task sees, in order."""

    def __init__(self, conv: str) -> None:
        self.conv, self.parts = conv, []

    def add(self, rows: dict[str, np.ndarray], low: int, high: int) -> None:
        self.parts.append({name: values[low:high] for name, values in rows.items()})

    def solved(self, part: int, open_ends: bool) -> dict:
        rows = {name: np.concatenate([p[name] for p in self.parts]) for name in self.parts[0]}
        n, initial, live = rows["n"], rows["initial"], ~rows["blank"] & rows["first"]
        pair = initial[:-1] * 4 + initial[1:]
        legal = np.isin(pair, [a * 4 + b for a, b in LEGAL]).sum()
        # Each row: itself if it can stay, then its copies, which must go.
        symbols = np.stack([2 * initial + rows["cut"], np.full(len(n), GONE)], axis=1).ravel()
        counts = np.stack([live.astype(np.int64), n - live], axis=1).ravel()
        symbols, counts = symbols[counts > 0], counts[counts > 0]
        starts = np.flatnonzero(np.diff(symbols, prepend=-1))
        runs = symbols[starts].tolist(), np.add.reduceat(counts, starts).tolist()
        at = (np.cumsum(n) - n)[live]
        cut = rows["cut"][live]
        ends = [tuple(0 if t == e else NEVER for t in STATES) for e in STATES] if open_ends else [TO_END]
        found = []
        for entry, last, audit in plans(*runs, STATES if open_ends else [0], ends):
            letters = np.frombuffer(audit.encode(), np.uint8)
            stays = letters[letters != ord("I")][at] != ord("D")
            if not open_ends:
                audit += "I" * (TO_END[last] // INSERT)
            found.append({"entry": entry, "exit": last, "cost": cost_of(audit, int(cut[stays].sum())), "audit": audit})
        return {
            "conv": self.conv,
            "part": part,
            "open": open_ends,
            "blank": int(n[rows["blank"]].sum()),
            "duplicate": int((n - rows["first"])[~rows["blank"]].sum()),
            "truncated": int((live & rows["cut"]).sum()),
            "illegal": int(n.sum()) - 1 - int(legal),
            "first_initial": int(initial[0]),
            "last_initial": int(initial[-1]),
            "options": found,
            "live": [{"at": a, "initial": i, "turn": t, "said": s} for a, i, t, s in zip(at.tolist(), initial[live].tolist(), rows["turn"][live], rows["said"][live], strict=True)],
        }


PIECE = (
    "conv string, part int, open boolean, blank long, duplicate long, truncated long, illegal long, first_initial int, last_initial int, "
    "options array<struct<entry int, exit int, cost long, audit string>>, live array<struct<at long, initial int, turn string, said binary>>"
)


def _solve(schema: pa.Schema):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of sorted light rows. The first and the last conversation of the task are open."""
        part = TaskContext.get().partitionId()
        piece, solved, done = None, [], 0
        for batch in batches:
            conv = batch.column("conv").to_pylist()
            rows = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("initial", "n", "blank", "cut", "first", "turn", "said")}
            low = 0
            while low < len(conv):
                high = low + 1
                while high < len(conv) and conv[high] == conv[low]:
                    high += 1
                if piece is None or piece.conv != conv[low]:
                    if piece is not None:
                        solved.append(piece.solved(part, done == 0))
                        done += 1
                    piece = Piece(conv[low])
                piece.add(rows, low, high)
                low = high
            if len(solved) >= 500:
                yield pa.RecordBatch.from_pylist(solved, schema)
                solved = []
        if piece is not None:
            solved.append(piece.solved(part, True))
        if solved:
            yield pa.RecordBatch.from_pylist(solved, schema)

    return solve


def _piece_schema() -> pa.Schema:
    option = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    live = pa.struct([("at", pa.int64()), ("initial", pa.int32()), ("turn", pa.string()), ("said", pa.binary())])
    counts = [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal")]
    ends = [("first_initial", pa.int32()), ("last_initial", pa.int32())]
    return pa.schema([("conv", pa.string()), ("part", pa.int32()), ("open", pa.bool_()), *counts, *ends, ("options", pa.list_(option)), ("live", pa.list_(live))])


def fold(pieces: pd.DataFrame) -> pd.DataFrame:
    """One option for each open piece of a conversation: cheapest together, first in ASCII."""
    pieces = pieces.sort_values("part")
    options = list(pieces["options"])
    togo = [TO_END]
    for found in reversed(options):
        cost = [NEVER] * 4
        for o in found:
            cost[o["entry"]] = min(cost[o["entry"]], o["cost"] + togo[-1][o["exit"]])
        togo.append(tuple(cost))
    togo = togo[::-1]
    state, chosen = 0, []
    for k, found in enumerate(options):
        state_options = [o for o in found if o["entry"] == state and o["cost"] + togo[k + 1][o["exit"]] == togo[k][state]]
        best = min(state_options, key=lambda o: o["audit"])  # none is the start of another: all end in the letter of a row
        chosen.append((state, best["audit"]))
        state = best["exit"]
    chosen[-1] = (chosen[-1][0], chosen[-1][1] + "I" * (TO_END[state] // INSERT))
    initials = list(zip(pieces["last_initial"], pieces["first_initial"].iloc[1:], strict=False))
    return pd.DataFrame(
        {
            "conv": pieces["conv"],
            "part": pieces["part"],
            "entry": [entry for entry, _ in chosen],
            "audit": [audit for _, audit in chosen],
            "cost": [togo[0][0]] + [0] * (len(chosen) - 1),
            "border": [0] + [int((int(a), int(b)) not in LEGAL) for a, b in initials],
        }
    )


def decode(audit: str, entry: int, live: list[dict]) -> Iterator[tuple[str, str | None, dict | None]]:
    """Edit, new role and live row of everything that stays."""
    state, row, rows = entry, 0, iter(live)
    here = next(rows, None)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield letter, ROLE[state], None
            continue
        if here is not None and here["at"] == row:
            if letter == "K":
                state = here["initial"] + 1
                yield letter, None, here
            elif letter == "R":
                state = NEXT[state]
                yield letter, ROLE[state], here
            here = next(rows, None)
        row += 1


def _stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv", "part", "seq", "edit", "new_role", "turn_name", "said"]
    schema = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("edit", pa.string()), ("new_role", pa.string()), ("turn_name", pa.string()), ("said", pa.binary())])
    for batch in batches:
        out: list[tuple] = []
        for piece in range(batch.num_rows):
            conv, part, entry, audit, live = (batch.column(name)[piece].as_py() for name in ("conv", "part", "entry", "audit", "live"))
            for seq, (edit, role, here) in enumerate(decode(audit, entry, live)):
                out.append((conv, part, seq, edit, role, here and here["turn"], here and here["said"]))
        if out:
            yield pa.record_batch(dict(zip(names, (pa.array(v, t) for v, t in zip(zip(*out, strict=True), schema.types, strict=True)), strict=True)), schema=schema)


def _name(column: str) -> Column:
    """A key for a column that may be null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with planted faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's.
    """
    fault = F.crc32(F.concat_ws(":", _name("conv_id"), _name("turn")).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1)))
    return conversations.filter(fault != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _named(conversations: DataFrame) -> DataFrame:
    """conv, turn, turn_name, role, text, said: ``said`` names role and text."""
    rows = conversations.select(
        _name("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), _name("turn").alias("turn_name"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    return rows.withColumn("said", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)))


class Repair(NamedTuple):
    """What was found and done: light rows, pieces, chosen edits, rows of the repaired conversations."""

    light: DataFrame
    pieces: DataFrame
    chosen: DataFrame
    rows: DataFrame


def repair(conversations: DataFrame) -> Repair:
    """Faults, edits and repaired rows of ``conversations`` (conv_id, turn, role, text).

    ``rows`` has conv, part, seq (their order), edit (K, R or I), role and text.
    """
    named = _named(conversations)
    trimmed = F.rtrim("text", F.lit(SPACE))
    initial = F.coalesce(*[F.when(F.left("role", F.lit(1)) == i, k) for k, i in enumerate(INITIALS)], F.lit(3))
    marked = named.select("conv", "turn", "turn_name", "role", "said", (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"), initial.alias("initial"))
    light = written(marked.groupBy("conv", "turn", "turn_name", "role", "said").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("blank", "cut", "initial")]), "light-rows")
    order = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    seen = light.groupBy("conv", "said").agg(F.min(order).alias("earliest"), F.count("*").alias("times")).filter("times > 1").drop("times")
    firsts = light.join(written(seen, "seen"), ["conv", "said"], "left")
    sort = ["conv", "turn", "role", "said"]
    lined = firsts.select("conv", "turn", "role", "said", F.col("turn_name"), "n", "blank", "cut", "initial", F.coalesce(F.col("earliest").eqNullSafe(order) | F.col("earliest").isNull(), F.lit(True)).alias("first"))
    lined = lined.repartitionByRange(*sort).sortWithinPartitions(*sort)
    sent = lined.select("conv", F.col("turn_name").alias("turn"), "said", "n", "blank", "cut", "initial", "first")
    pieces = written(sent.mapInArrow(_solve(_piece_schema()), PIECE), "pieces")

    only = F.col("options")[0]
    closed = pieces.filter("not open").select("conv", "part", F.lit(0).alias("entry"), only["audit"].alias("audit"), only["cost"].alias("cost"), F.lit(0).cast("long").alias("border"), "live")
    ends = pieces.filter("open").select("conv", "part", "first_initial", "last_initial", "options")
    folded = written(ends.groupBy("conv").applyInPandas(fold, "conv string, part int, entry int, audit string, cost long, border long"), "folded")
    opened = folded.join(pieces.filter("open").select("conv", "part", "live"), ["conv", "part"])
    chosen = closed.unionByName(opened)
    stay = chosen.select("conv", "part", "entry", "audit", "live").mapInArrow(_stay, "conv string, part int, seq long, edit string, new_role string, turn_name string, said binary")
    stay = written(stay, "stay")
    texts = named.groupBy("conv", "turn_name", "said").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    kept = stay.filter("said is not null").join(texts, ["conv", "turn_name", "said"]).select("conv", "part", "seq", "edit", F.coalesce("new_role", "role").alias("role"), "text")
    added = stay.filter("said is null").select("conv", "part", "seq", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repair(light, pieces, chosen.drop("live"), kept.unionByName(added))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation; rows come in order, and none is held."""
    conv, state, out = None, None, []
    for batch in batches:
        for name, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if state is not None and name == conv:
                state.update(b"\n")
            else:
                if state is not None:
                    out.append((conv, state.hexdigest()))
                conv, state = name, hashlib.sha256()
            state.update(line.encode())
    if state is not None:
        out.append((conv, state.hexdigest()))
    if out:
        yield pa.record_batch({"conv": pa.array([c for c, _ in out]), "hash": pa.array([h for _, h in out])})


def digest(original: DataFrame, repaired: Repair) -> DataFrame:
    """One row for each conv_id of ``original``: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A hash runs over its whole text from front to back, so the lines that stay of one
    conversation pass through one task, held one batch at a time.
    """
    kind = original.schema["conv_id"].dataType.simpleString()
    lines = repaired.rows.select("conv", "part", "seq", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv").sortWithinPartitions("conv", "part", "seq").select("conv", "line")
    hashes = lines.mapInArrow(_hashes, "conv string, hash string")
    span = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count_distinct("turn").cast("decimal(20,0)")
    gaps = repaired.light.groupBy("conv").agg(span.alias("gaps")).withColumn("gaps", F.expr("try_cast(gaps as bigint)"))
    counts = ["blank", "duplicate", "truncated", "illegal"]
    facts = repaired.pieces.select("conv", *counts)
    edits = repaired.chosen.select("conv", F.col("border").alias("illegal"), "cost", F.struct("part", "audit").alias("step"))
    every = original.select(_name("conv_id").alias("conv")).distinct()
    for more in (gaps, facts, edits, hashes):
        every = every.unionByName(more, allowMissingColumns=True)
    steps = F.array_join(F.transform(F.array_sort(F.collect_list("step")), lambda s: s["audit"]), "")
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", *counts, "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    out = every.groupBy("conv").agg(*sums, steps.alias("audit"), F.coalesce(F.max("hash"), nothing).alias("repaired_sha256"))
    return out.select(F.expr(f"try_cast(conv as {kind})").alias("conv_id"), "gaps", *counts, "cost", "audit", "repaired_sha256")
