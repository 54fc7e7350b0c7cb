"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation, beginning with a user and ending with an assistant.
Each message is kept in its role or relabelled (a cost by role pair); it opens a turn or is merged into an open turn of its role (a cost); an empty
turn may be inserted before it or at the end (a cost). Dynamic programming over the automaton of the open turn's role finds the cheapest
repair; among equally cheap ones the role that comes first in ``ROLES`` wins, from the last message backwards.

A conversation may hold a third of all rows, so no task needs to hold one whole. Messages are dealt by ranges of
(conversation, turn). A conversation that lies in one range is solved there. For one that spans several, each range gives a matrix of least costs
from role to role; these (one row a range) are chained to costs at the range's start, and, backwards, to the role at its end; then each range is solved
with both ends given. Costs are whole numbers, so the result does not depend on where ranges begin.

Output is one row per message, with the text it contributes: the end of the turn before, inserted empty turns, the beginning of its own turn or
the separator of a merged message. Fragments of a conversation in order of ``seq`` are the rendered conversation.

Defined results: an unknown or null role costs the same in every role, null texts are empty, null turns come first, ties of turn go by role, then text; repeated
rows are messages of their own; a null conversation id is one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import row_key, stored, table
from ledgerlens.session import task_count

ROLES = ["system", "user", "assistant"]
#: What roles of other tables are called here.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
KEEP, UNKNOWN, MERGE, INSERT, NEVER = 0, 2, 1, 3, 1 << 40
#: Cost of giving a message of the row's role the column's role.
RELABEL = np.array([[0, 4, 6], [6, 0, 4], [6, 4, 0]], dtype=np.int64)

START = 3  # the state before the first message
# (states before a message) x (role of the message): least cost of getting there, and what is done
_FOLLOWS = {START: [0, 1], 0: [1], 1: [2], 2: [1]}


def _steps() -> tuple[np.ndarray, list[list[tuple[str, ...]]]]:
    cost = np.full((4, 3), NEVER, dtype=np.int64)
    done: list[list[tuple[str, ...]]] = [[()] * 3 for _ in range(4)]
    for state in range(4):
        # turns that may be inserted in between, cheapest first: none, one, two
        reach = {state: (0, ())}
        for n in (1, 2):
            for at, (spent, path) in list(reach.items()):
                for nxt in _FOLLOWS[at]:
                    if nxt != 0 and nxt not in reach and spent == INSERT * (n - 1):
                        reach[nxt] = (INSERT * n, (*path, ROLES[nxt]))
        for role in range(3):
            ways = [(spent, path) for at, (spent, path) in reach.items() if role in _FOLLOWS[at]]
            if ways:
                cost[state, role], done[state][role] = min(ways)
            if state == role and MERGE < cost[state, role]:
                cost[state, role], done[state][role] = MERGE, ("merge",)
    return cost, done


STEP, DONE = _steps()
#: Cost of ending in each state: a user turn, or only a system turn, is followed by empty ones.
END = np.array([2 * INSERT, INSERT, 0], dtype=np.int64)
_AFTER = [("user", "assistant"), ("assistant",), ()]


def emission(roles: list[str | None]) -> np.ndarray:
    """Cost of each role for each message."""
    rows = []
    for role in roles:
        name = (role or "").strip().lower()
        name = ALIASES.get(name, name)
        rows.append(RELABEL[ROLES.index(name)] if name in ROLES else np.full(3, UNKNOWN, dtype=np.int64))
    return np.array(rows, dtype=np.int64).reshape(-1, 3)


def forward(cost: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least costs (4 states) after all messages from costs before them, and for each message and role the state before it."""
    back = np.empty((len(cost), 3), dtype=np.int8)
    for i, own in enumerate(cost):
        ways = entry[:, None] + STEP
        back[i] = ways.argmin(0)
        entry = np.append(np.minimum(ways.min(0) + own, NEVER), NEVER)
    return entry, back


def transfer(cost: np.ndarray) -> np.ndarray:
    """Least cost from each state before the messages to each state after them."""
    return np.array([forward(cost, np.where(np.arange(4) == s, 0, NEVER))[0] for s in range(4)])


def backward(back: np.ndarray, role: int) -> tuple[np.ndarray, int]:
    """Role of each message when the last one has this role, and the state before the first."""
    chosen = np.empty(len(back), dtype=np.int64)
    state = role
    for i in range(len(back) - 1, -1, -1):
        chosen[i] = state
        state = int(back[i, state])
    return chosen, state


def _render(role: str, opens: bool, follows: bool, last: bool, inserted: tuple[str, ...], after: tuple[str, ...], text: str) -> str:
    """What a message adds to the rendered conversation: the end of the turn before, inserted turns, its own beginning and text, and all ends at the last."""
    end = "<|end|>\n"
    if not opens:
        head = "\n"
    else:
        head = (end if follows else "") + "".join(f"<|{r}|>\n{end}" for r in inserted) + f"<|{role}|>\n"
    return head + text + (end + "".join(f"<|{r}|>\n{end}" for r in after) if last else "")


def _ranges(messages: DataFrame) -> DataFrame:
    """Messages with the range they are dealt to; stored, so that a range is the same rows in every later step."""
    rows = messages.select(
        row_key().alias("row"), F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
        F.col("text").cast("string"), F.xxhash64("text").alias("hash"),
    )
    order = [F.col(c) for c in ("conv_id", "turn", "role", "hash", "row")]
    dealt = rows.repartitionByRange(2 * task_count(messages.sparkSession), *order)
    return stored(dealt.withColumn("part", F.spark_partition_id()), "messages")


def _stretches(frame: pa.Table) -> Iterator[tuple[int | None, list[int]]]:
    """(conversation, places of its rows in order) of one range."""
    columns = [frame.column(c).to_pylist() for c in ("conv_id", "turn", "role", "hash", "row")]
    keys = [tuple((v is not None, v if v is not None else "" if k == 2 else 0) for k, v in enumerate(row)) for row in zip(*columns, strict=True)]
    order = sorted(range(len(keys)), key=keys.__getitem__)
    first = 0
    for i in range(1, len(order) + 1):
        if i == len(order) or keys[order[i]][0] != keys[order[first]][0]:
            yield columns[0][order[first]], order[first:i]
            first = i


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table({name: pa.array(list(c), kinds[kind]) for (name, kind), c in zip(fields, columns, strict=True)})


_MATRIX = "part int, conv_id long, n long, costs array<long>"
_ENTRY = "part int, conv_id long, before long, entry array<long>"
_STATES = "part int, conv_id long, states array<long>, ends array<long>"
_EXIT = "part int, conv_id long, exit long, follows long"
_OUT = "conv_id long, seq long, turn long, role string, new_role string, action string, inserted string, cost long, fragment string, row long"


def _matrices(frame: pa.Table) -> pa.Table:
    part, roles = frame.column("part")[0].as_py(), frame.column("role").to_pylist()
    return _table([(part, conv, len(at), transfer(emission([roles[i] for i in at])).reshape(-1).tolist()) for conv, at in _stretches(frame)], _MATRIX)


def _by_part(frame: pa.Table) -> list[dict]:
    return sorted(frame.to_pylist(), key=lambda r: r["part"])


def _entries(frame: pa.Table) -> pa.Table:
    """One conversation's stretches: costs before each and how many messages precede it."""
    found, entry, before = [], np.array([NEVER, NEVER, NEVER, 0], dtype=np.int64), 0
    for r in _by_part(frame):
        found.append((r["part"], r["conv_id"], before, entry.tolist()))
        entry = np.minimum((entry[:, None] + np.array(r["costs"]).reshape(4, 4)).min(0), NEVER)
        before += r["n"]
    return _table(found, _ENTRY)


def _given(frame: pa.Table, *names: str) -> dict:
    """Per conversation of a range, the values that were joined to its messages."""
    return {r["conv_id"]: r for r in frame.select(["conv_id", *names]).to_pylist()}


def _states(frame: pa.Table) -> pa.Table:
    """Of each stretch, costs before it known: for each role of its last message the state before it, and the cost of ending so."""
    part, roles, given = frame.column("part")[0].as_py(), frame.column("role").to_pylist(), _given(frame, "entry")
    found = []
    for conv, at in _stretches(frame):
        after, back = forward(emission([roles[i] for i in at]), np.array(given[conv]["entry"], dtype=np.int64))
        found.append((part, conv, [backward(back, role)[1] for role in range(3)], (after[:3] + END).tolist()))
    return _table(found, _STATES)


def _exits(frame: pa.Table) -> pa.Table:
    """One conversation's stretches: the role of the last message of each, and whether another stretch follows (1) or not (-1)."""
    rows = _by_part(frame)
    role, found, follows = int(np.argmin(rows[-1]["ends"])), [], -1
    for r in reversed(rows):
        found.append((r["part"], r["conv_id"], role, follows))
        role, follows = int(r["states"][role]), 1
    return _table(found[::-1], _EXIT)


def _written(frame: pa.Table) -> pa.Table:
    """Decisions and fragments of one range."""
    roles, texts, turns, rows = (frame.column(c).to_pylist() for c in ("role", "text", "turn", "row"))
    given = _given(frame, "entry", "before", "exit", "follows")
    out = []
    for conv, at in _stretches(frame):
        known, cost = given[conv], emission([roles[i] for i in at])
        _, back = forward(cost, np.array(known["entry"], dtype=np.int64))
        chosen, state = backward(back, known["exit"])
        for k, i in enumerate(at):
            role = int(chosen[k])
            done = DONE[state][role]
            merged, last = done == ("merge",), known["follows"] < 0 and k == len(at) - 1
            between, after = () if merged else done, _AFTER[role] if last else ()
            said = (roles[i] or "").strip().lower()
            action = "merge" if merged else "keep" if ALIASES.get(said, said) == ROLES[role] else "relabel"
            spent = int(STEP[state, role] + cost[k, role]) + (int(END[role]) if last else 0)
            fragment = _render(ROLES[role], not merged, state != START, last, between, after, texts[i] or "")
            out.append((conv, known["before"] + k, turns[i], roles[i], ROLES[role], action, ",".join((*between, *after)), spent, fragment, rows[i]))
            state = role
    return _table(out, _OUT)


def repair(messages: DataFrame) -> DataFrame:
    """Per message of ``conv_id, turn, role, text``: its place ``seq``, role, action, inserted turns, cost and rendered fragment."""
    dealt = _ranges(messages)
    # a number of its own: few bytes make much work here, so ranges must not be joined into few tasks
    parts = 2 * task_count(messages.sparkSession)
    brief = dealt.select("part", "conv_id", "turn", "role", "hash", "row")
    matrices = stored(brief.repartition(parts, "part").groupBy("part").applyInArrow(_matrices, _MATRIX), "stretches")
    entries = stored(matrices.groupBy("conv_id").applyInArrow(_entries, _ENTRY), "entries")

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        own = right.withColumnsRenamed({"part": "_part", "conv_id": "_conv"})
        return left.join(own, (left.part == own._part) & left.conv_id.eqNullSafe(own._conv)).drop("_part", "_conv")

    states = joined(brief, entries.drop("before")).repartition(parts, "part").groupBy("part").applyInArrow(_states, _STATES)
    exits = stored(states.groupBy("conv_id").applyInArrow(_exits, _EXIT), "exits")
    whole = joined(joined(dealt, entries), exits)
    return whole.repartition(parts, "part").groupBy("part").applyInArrow(_written, _OUT)


def op1_chat_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations")).drop("row")
