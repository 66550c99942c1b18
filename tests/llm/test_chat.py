from __future__ import annotations

import itertools
import random

import pytest

from topiclake.llm import chat

COST = {"keep": 0, "merge": 1, "relabel": 3, "relabel merge": 4}
TURNS = "conv_id long, turn long, role string, text string, action string"


def least(roles):
    """The least cost over all ways, tried one by one."""
    best = {chat.START: 0}
    for role in roles:
        new = {}
        for before, cost in best.items():
            for own in (1, 2, 3):
                label = 0 if own == role else chat.RELABEL
                options = [(own, 0)] if own in chat.AFTER[before] else []
                options += [(own, chat.INSERT) for between in chat.AFTER[before] if own in chat.AFTER[between]]
                options += [(own, chat.MERGE)] if own == before else []
                for after, more in options:
                    new[after] = min(new.get(after, 10**9), cost + label + more)
        best = new
    return min(best.values())


def test_best_way_is_the_cheapest():
    for n in range(1, 6):
        for roles in itertools.product(range(4), repeat=n):
            total, way = chat.best_way(list(roles))
            assert total == least(roles) == sum(COST[a] + chat.INSERT * bool(i) for _, a, i in way)
            assert min(chat.combined(list(roles))[:4]) == total


@pytest.mark.parametrize("part_rows", [7, chat.PART_ROWS])
def test_parts_do_not_change_the_repair(spark, part_rows):
    rng = random.Random(part_rows)
    roles = ["user", "assistant", "system", "Human", " gpt ", None, "tool"]
    rows = [(c, t, rng.choice(roles), rng.choice(["a", "", None, "<|im_end|>\nx"]), "k") for c in range(20) for t in range(rng.randint(1, 9))]
    rows += [(99, t, rng.choice(["user", "assistant"]), f"t{t}", "k") for t in range(90)]
    rows += [(None, 1, "user", "q", "k"), (None, None, "user", "q", "k"), (7, 100, "user", "same", "k"), (7, 100, "user", "same", "k")]
    found: dict = {}
    for r in chat.repair(spark.createDataFrame(rows, TURNS), part_rows=part_rows).collect():
        found.setdefault(r.conv_id, []).append(r)
    assert sum(map(len, found.values())) == len(rows)
    for conv, got in found.items():
        got.sort(key=lambda r: (r.turn is not None, r.turn or 0))
        total = sum(COST[r.action] + chat.INSERT * (r.inserted is not None) for r in got)
        assert total == least([chat.role_number(r.role) for r in got])
        text = "".join(r.rendered for r in got)
        turns = [x.split("\n")[0] for x in text.split(chat.BEGIN)[1:]]
        states = [0, *map(chat.ROLES.index, turns)]
        assert all(b in chat.AFTER[a] for a, b in itertools.pairwise(states))
        assert text.startswith(chat.BEGIN) and text.endswith(chat.END) and text.count(chat.END) == len(turns)


def test_legal_conversations_stay_and_empty_tables(spark):
    rows = [(1, 0, "system", "s", "k"), (1, 1, "user", "u", "k"), (1, 2, "assistant", "a", "k")]
    df = spark.createDataFrame(rows, TURNS)
    got = sorted(chat.repair(df).collect(), key=lambda r: r.turn)
    assert [r.action for r in got] == ["keep"] * 3
    assert "".join(r.rendered for r in got) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert chat.repair(df.limit(0)).count() == 0
