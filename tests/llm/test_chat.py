"""Role repair against all sequences of choices, and long conversations against short ones."""

import itertools
import random

import pytest

from wardstar.llm import chat


def brute_cost(names, most_empty=3):
    """The cheapest legal conversation by trying every role and merge of every turn."""
    given = [chat.role_of(n) for n in names]
    best = None
    for roles in itertools.product((1, 2, 3), repeat=len(given)):
        labels = sum(0 if g == r else chat.RELABEL if g else chat.NAME_UNKNOWN for g, r in zip(given, roles))
        for merges in itertools.product((False, True), repeat=len(given)):
            state, cost, good = 0, labels, True
            for role, merge in zip(roles, merges):
                if merge:
                    good = state == role
                    cost += chat.MERGE
                else:
                    gap = empties(state, role, most_empty)
                    good = gap is not None
                    cost += chat.INSERT * (gap or 0)
                if not good:
                    break
                state = role
            if good:
                cost += chat.INSERT * {0: 0, 1: 2, 2: 1, 3: 0}[state]
                best = cost if best is None else min(best, cost)
    return best


def empties(state, role, most):
    reach = {state}
    for n in range(most + 1):
        if any(role in chat.LEGAL[s] for s in reach):
            return n
        reach = {q for s in reach for q in chat.LEGAL[s]}
    return None


def legal(rendered):
    roles = [part.split("\n")[0] for part in rendered.split("<|im_start|>")[1:]]
    assert rendered.count("<|im_start|>") == rendered.count("<|im_end|>")
    if roles and roles[0] == "system":
        roles = roles[1:]
    return len(roles) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(roles))


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_cheapest(length):
    for names in itertools.product(("system", "user", "assistant", None), repeat=length):
        cost, ways, after = chat.repair(list(names))
        assert cost == brute_cost(names), names
        text = "".join(chat.pieces([f"t{i}" for i in range(length)], ways, True, after))
        assert legal(text) and all(f"t{i}" in text for i in range(length)), (names, text)


def collect(df):
    rows = sorted((tuple(r) for r in df.collect()), key=lambda r: (str(r[0]), r[2]))
    return rows


def test_blocks_give_the_same(spark):
    draw = random.Random(5)
    rows = [
        (c, t, draw.choice(["system", "user", "assistant", "tool", None]), f"{c}.{t}")
        for c, n in ((1, 400), (2, 3), (3, 57), (None, 90))
        for t in range(n)
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    whole, cut = collect(chat.repaired(df)), collect(chat.repaired(df, long=16))
    assert len(whole) == len(rows)
    costs = {}
    for name, found in (("whole", whole), ("cut", cut)):
        for conv in (1, 2, 3, None):
            own = [r for r in found if r[0] == conv]
            assert [r[2] for r in own] == list(range(len(own)))
            assert legal("".join(r[8] for r in own))
            costs[name, conv] = sum(
                (chat.MERGE if "merge" in r[5] else 0)
                + (0 if "relabel" not in r[5] else chat.RELABEL if chat.role_of(r[3]) else chat.NAME_UNKNOWN)
                + chat.INSERT * (len(r[6]) + len(r[7]))
                for r in own
            )
            assert costs[name, conv] == costs["whole", conv]
            assert costs[name, conv] == chat.repair([r[3] for r in own])[0]


def test_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, rendered int, c int"
    assert chat.repaired(spark.createDataFrame([], schema)).collect() == []
    rows = [
        (1, None, "Human", None, 1, 1),
        (1, 1, "bot", "", 1, 1),
        (1, 1, "bot", "", 1, 1),
        (2**60 + 1, 0, "user", "x" * 200_000, 1, 1),
    ]
    found = collect(chat.repaired(spark.createDataFrame(rows, schema)))
    assert [(r[0], r[1], r[4], r[5], r[7]) for r in found] == [
        (1, None, "user", "keep", []),
        (1, 1, "assistant", "keep", []),
        (1, 1, "assistant", "merge", []),
        (2**60 + 1, 0, "user", "keep", ["assistant"]),
    ]
    assert "".join(r[8] for r in found[:3]) == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n\n<|im_end|>\n"
