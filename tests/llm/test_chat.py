"""Role repair against all role sequences."""

import itertools
import random
import re
from collections import defaultdict

from ledgerlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(roles):
    own, best = chat.emission(roles), 1 << 60
    for choice in itertools.product(range(3), repeat=len(roles)):
        cost, state = 0, chat.START
        for i, role in enumerate(choice):
            cost, state = cost + own[i][role] + chat.STEP[state, role], role
        best = min(best, cost + chat.END[state])
    return best


def rendered(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["conv_id"]].append(r)
    for held in by.values():
        held.sort(key=lambda r: r["seq"])
        assert [r["seq"] for r in held] == list(range(len(held)))
        text = "".join(r["fragment"] for r in held)
        turns = re.findall(r"<\|(system|user|assistant)\|>", text)
        assert re.fullmatch("s?(ua)+", "".join(t[0] for t in turns)) and text.count("<|end|>") == len(turns)
    return by


def test_least_cost_and_legal(spark):
    rng = random.Random(5)
    kinds = ["system", "user", "assistant", "user", "assistant", "tool", None, "Human"]
    rows = [(c, t, rng.choice(kinds), f"text {t}") for c in range(150) for t in range(rng.randint(1, 6))]
    by = rendered(chat.repair(spark.createDataFrame(rows, SCHEMA)).collect())
    for c, held in by.items():
        assert sum(r["cost"] for r in held) == brute([r["role"] for r in held]), c


def test_a_conversation_over_many_ranges_is_solved_as_one(spark):
    rng = random.Random(6)
    roles = [rng.choice(["system", "user", "assistant"]) for _ in range(2500)]
    rows = [(1, t, r, "x") for t, r in enumerate(roles)]
    held = rendered(chat.repair(spark.createDataFrame(rows, SCHEMA)).collect())[1]
    after, back = chat.forward(chat.emission(roles), chat.np.array([chat.NEVER] * 3 + [0]))
    ends = after[:3] + chat.END
    assert sum(r["cost"] for r in held) == ends.min()
    chosen, _ = chat.backward(back, int(ends.argmin()))
    assert [r["new_role"] for r in held] == [chat.ROLES[k] for k in chosen]


def test_kept_where_legal(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "u"), (2, 1, "gpt", "a")]
    out = chat.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["action"] for r in out} == {"keep"} and sum(r["cost"] for r in out) == 0
    text = "".join(r["fragment"] for r in sorted((r for r in out if r["conv_id"] == 1), key=lambda r: r["seq"]))
    assert text == "<|system|>\ns<|end|>\n<|user|>\nu<|end|>\n<|assistant|>\na<|end|>\n"


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 0, "user", ""), (3, 1, "assistant", "z"), (3, 1, "assistant", "z"), (3, None, "", "y" * 200000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "2 AS seq", "3 AS entry")
    by = rendered(chat.repair(df).collect())
    assert sum(map(len, by.values())) == len(rows)
    assert chat.repair(df.limit(0)).count() == 0
