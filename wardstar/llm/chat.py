"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system message, then user and assistant in turn, ending with
the assistant. Dynamic programming over this automaton finds the cheapest way to make the turns
of a conversation legal: merge a turn into the message before, relabel it, or put empty messages
in front of it. Every turn keeps its text.

The state after a turn is the role of the last message, so a run of turns acts as a small matrix
of cheapest costs between states. Conversations of up to LONG turns are repaired in one go. Longer
ones are cut into blocks by a global sort: blocks give their matrices, a pass over the matrices of
a conversation picks the states at the cuts, and every block is repaired between its two states.
So no task holds more than LONG turns, and the result is the same as in one go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.operators.joins import lookup_join
from wardstar.session import stage

# States, legal next roles, other names of roles, costs.
STATES = ("start", "system", "user", "assistant")
LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
ALIASES = {
    "system": 1, "developer": 1,
    "user": 2, "human": 2, "prompter": 2,
    "assistant": 3, "bot": 3, "gpt": 3, "model": 3,
}
MERGE, RELABEL, NAME_UNKNOWN, INSERT = 1, 3, 1, 2
INFINITE = 1 << 40
LONG = 2048
OPEN, CLOSE = "<|im_start|>{role}\n", "<|im_end|>\n"


def role_of(name: str | None) -> int:
    """The role as a state, 0 if it is unknown."""
    return ALIASES.get((name or "").strip().lower(), 0)


def _ways(state: int, role: int) -> tuple[int, ...] | None:
    """The fewest empty messages between ``state`` and a new message of ``role``."""
    paths = [((), state)]
    for _ in range(3):
        for empties, at in paths:
            if role in LEGAL[at]:
                return empties
        paths = [((*empties, q), q) for empties, at in paths for q in LEGAL[at]]
    return None


def _step(state: int, given: int, role: int) -> tuple[int, str, tuple[int, ...]] | None:
    """Cost, action and empty messages of taking a turn of role ``given`` as ``role`` in ``state``."""
    cost = 0 if given == role else RELABEL if given else NAME_UNKNOWN
    name = "keep" if given == role else "relabel"
    found = []
    if state == role:
        found.append((cost + MERGE, "merge" if given == role else "relabel+merge", ()))
    empties = _ways(state, role)
    if empties is not None:
        found.append((cost + INSERT * len(empties), name, empties))
    return min(found, key=lambda x: x[0]) if found else None


STEPS = {
    (state, given): [(role, *step) for role in (1, 2, 3) if (step := _step(state, given, role))]
    for state in range(4)
    for given in range(4)
}
ENDINGS: dict[int, tuple[int, ...]] = {0: (), 1: (2, 3), 2: (3,), 3: ()}


def forward(roles: list[int], costs: list[int]) -> tuple[list[int], list[list[tuple[int, str, tuple[int, ...]] | None]]]:
    """Cheapest cost of each state after the turns, and per turn the way that led to each state."""
    trail = []
    for given in roles:
        after, back = [INFINITE] * 4, [None] * 4
        for state, cost in enumerate(costs):
            if cost < INFINITE:
                for role, extra, action, empties in STEPS[state, given]:
                    if cost + extra < after[role]:
                        after[role], back[role] = cost + extra, (state, action, empties)
        costs = after
        trail.append(back)
    return costs, trail


def start_costs(state: int) -> list[int]:
    return [0 if s == state else INFINITE for s in range(4)]


def best_end(costs: list[int]) -> int:
    """The last state of the cheapest legal conversation."""
    return min(range(4), key=lambda s: (costs[s] + INSERT * len(ENDINGS[s]), -s))


def backward(trail: list, state: int) -> list[tuple[int, str, tuple[int, ...]]]:
    """(role, action, empty messages before) of each turn on the way that ends in ``state``."""
    out = []
    for back in reversed(trail):
        before, action, empties = back[state]
        out.append((state, action, empties))
        state = before
    return out[::-1]


def repair(names: list[str | None]) -> tuple[int, list[tuple[int, str, tuple[int, ...]]], tuple[int, ...]]:
    """Cost, way of each turn, and empty messages after the last, of a whole conversation."""
    costs, trail = forward([role_of(n) for n in names], start_costs(0))
    end = best_end(costs)
    return costs[end] + INSERT * len(ENDINGS[end]), backward(trail, end), ENDINGS[end]


def _empty(role: int) -> str:
    return OPEN.format(role=STATES[role]) + CLOSE


def pieces(texts: list[str | None], ways: list, first: bool, after: tuple[int, ...] | None) -> list[str]:
    """What each turn adds to the rendered conversation; pieces in order are the whole of it.

    ``after``: empty messages behind the last turn, None if more turns follow.
    """
    out = []
    for text, (role, action, empties) in zip(texts, ways, strict=True):
        if action.endswith("merge"):
            out.append("\n" + (text or ""))
        else:
            closed = "" if first and not out else CLOSE
            out.append(closed + "".join(map(_empty, empties)) + OPEN.format(role=STATES[role]) + (text or ""))
    if after is not None and out:
        out[-1] += CLOSE + "".join(map(_empty, after))
    return out


OUT_SCHEMA = (
    "conv_id string, turn string, ordinal bigint, given_role string, role string, action string, "
    "inserted_before array<string>, inserted_after array<string>, rendered string"
)


def _result(rows: pd.DataFrame, start: int, ways: list, first: bool, after: tuple[int, ...] | None) -> pd.DataFrame:
    behind: list[list[str]] = [[] for _ in ways]
    if after:
        behind[-1] = [STATES[r] for r in after]
    return pd.DataFrame(
        {
            "conv_id": rows["conv_id"].to_numpy(),
            "turn": rows["turn"].to_numpy(),
            "ordinal": range(start, start + len(rows)),
            "given_role": rows["role"].to_numpy(),
            "role": [STATES[w[0]] for w in ways],
            "action": [w[1] for w in ways],
            "inserted_before": [[STATES[r] for r in w[2]] for w in ways],
            "inserted_after": behind,
            "rendered": pieces(rows["text"].tolist(), ways, first, after),
        }
    )


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repairs every conversation of a partition that is sorted by conversation and turn."""
    held: pd.DataFrame | None = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = rows["conv_id"].iloc[-1]
        same = rows["conv_id"].isna() if last is None else rows["conv_id"].eq(last)
        yield from _repaired(rows[~same])
        held = rows[same]
    if held is not None:
        yield from _repaired(held)


def _repaired(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    found = []
    for _, turns in rows.groupby("conv_id", sort=False, dropna=False):
        _, ways, after = repair(turns["role"].tolist())
        found.append(_result(turns, 0, ways, True, after))
    if found:
        yield pd.concat(found, ignore_index=True)


MATRIX_SCHEMA = "conv_id string, part int, block bigint, n bigint, costs array<bigint>"
KEYS = ["conv_id", "part", "block"]


def _matrix(rows: pd.DataFrame) -> pd.DataFrame:
    roles = [role_of(n) for n in rows.sort_values("pos")["role"]]
    costs = [c for state in range(4) for c in forward(roles, start_costs(state))[0]]
    head = rows.iloc[:1][KEYS].reset_index(drop=True)
    return head.assign(n=len(rows), costs=[costs])


CUT_SCHEMA = "conv_id string, part int, block bigint, start bigint, entry int, leave int, final boolean"


def _cuts(rows: pd.DataFrame) -> pd.DataFrame:
    """The states between the blocks of one conversation on its cheapest way."""
    rows = rows.sort_values(["part", "block"], ignore_index=True)
    costs, trail = start_costs(0), []
    for flat in rows["costs"]:
        after, back = [INFINITE] * 4, [0] * 4
        for state in range(4):
            for to in range(4):
                total = costs[state] + int(flat[4 * state + to])
                if total < after[to]:
                    after[to], back[to] = total, state
        costs = after
        trail.append(back)
    state, states = best_end(costs), []
    for back in reversed(trail):
        states.append((back[state], state))
        state = back[state]
    states.reverse()
    out = rows[KEYS].copy()
    out["start"] = rows["n"].cumsum() - rows["n"]
    out["entry"], out["leave"] = [s[0] for s in states], [s[1] for s in states]
    out["final"] = out.index == len(out) - 1
    return out


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("pos", ignore_index=True)
    head = rows.iloc[0]
    _, trail = forward([role_of(n) for n in rows["role"]], start_costs(int(head["entry"])))
    leave = int(head["leave"])
    after = ENDINGS[leave] if head["final"] else None
    return _result(rows, int(head["start"]), backward(trail, leave), head["start"] == 0, after)


def repaired(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    long: int = LONG,
) -> DataFrame:
    """One row per turn of every conversation: the columns of OUT_SCHEMA.

    ``rendered`` of a conversation's rows in order of ``ordinal``, joined, is the formatted
    conversation. Turns go by number, nulls first, equal ones by role and text. A null
    conversation id is a conversation like any other; null and unknown roles are given the
    cheapest role; null texts are empty. No rows give none.
    """
    number = F.col(f"`{conv_id}`").cast("bigint")
    # numbers go to the tasks as text: pandas would make them inexact beside nulls
    rows = turns.select(
        number.alias("c"),
        F.col(f"`{turn}`").cast("bigint").alias("t"),
        F.col(f"`{role}`").cast("string").alias("role"),
        F.col(f"`{text}`").alias("text"),
        number.cast("string").alias("conv_id"),
        F.col(f"`{turn}`").cast("bigint").cast("string").alias("turn"),
        number.isNull().alias("none"),
        F.coalesce(number, F.lit(0).cast("bigint")).alias("key"),
    )
    sizes = rows.groupBy("none", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > long)
    lengthy = stage(sizes.select("none", "key", F.lit(True).alias("lengthy")), "chat-long")
    told = lookup_join(rows, lengthy, ["none", "key"], "left", spread=["c", "t", "role"])
    order, seen = ["c", "t", "role", "text"], ["conv_id", "turn", "role", "text"]
    short = told.filter("lengthy is null").select(*order, "conv_id", "turn").repartition("c")
    done = short.sortWithinPartitions(*order).select(*seen).mapInPandas(_whole, OUT_SCHEMA)
    if not lengthy.isEmpty():
        done = done.unionByName(_long(told.filter("lengthy").select(*order, "conv_id", "turn"), order, long))
    return done.withColumns({"conv_id": F.col("conv_id").cast("bigint"), "turn": F.col("turn").cast("bigint")})


def _long(rows: DataFrame, order: list[str], long: int) -> DataFrame:
    at = F.monotonically_increasing_id()
    place = [
        F.shiftright(at, 33).cast("int").alias("part"),
        at.bitwiseAND(F.lit((1 << 33) - 1)).alias("pos"),
    ]
    picked = stage(rows, "chat-rows")
    sorted_ = picked.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(sorted_.select("conv_id", "turn", "role", "text", *place), "chat-turns")
    placed = placed.withColumn("block", F.floor(F.col("pos") / long))
    matrices = placed.select(*KEYS, "pos", "role").groupBy(*KEYS).applyInPandas(_matrix, MATRIX_SCHEMA)
    # a row per block, so a hundred million turns of one conversation are some 50,000 rows
    cuts = stage(matrices.groupBy("conv_id").applyInPandas(_cuts, CUT_SCHEMA), "chat-cuts")
    there = cuts.withColumnsRenamed({k: f"c_{k}" for k in KEYS})
    same = F.col("conv_id").eqNullSafe(F.col("c_conv_id")) & (F.col("part") == F.col("c_part"))
    given = placed.join(there, same & (F.col("block") == F.col("c_block"))).drop(*[f"c_{k}" for k in KEYS])
    return given.groupBy(*KEYS).applyInPandas(_block, OUT_SCHEMA)
