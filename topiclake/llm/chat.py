"""Chat formatting: the cheapest repair of a conversation's roles, and its rendering.

A legal conversation is a system turn or none, then user and assistant in turn.  Every turn is
kept, merged into the turn before, relabelled, or preceded by an empty turn, each at a
cost; dynamic programming over the roles finds the cheapest way.

The step of a turn is a table of costs from role to role, and steps combine by (min, +), which
is associative.  So turns are sorted by conversation and place over all tasks, whoever
they belong to: a part holds the end of one conversation, whole ones, and the begin of
another.  A part sends the combined steps of its first and its last conversation, one
small table each; combining those says with which role each part begins and ends.
Then every part finds its own way.  A conversation that holds a third of all rows is spread like any.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topiclake.llm.tables import let_workers_import, written

#: turns and bytes of text of a part
PART_ROWS, PART_BYTES = 20_000, 16 << 20
#: costs
MERGE, INSERT, RELABEL = 1, 2, 3

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = [None, "system", "user", "assistant"]
AFTER = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FAR = 1 << 40

# fixed values: other names of roles
NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}

BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def role_number(role: str | None) -> int:
    """The known role that a text names, START (no role) for all others and NULL."""
    name = (role or "").strip().lower()
    name = NAMES.get(name, name)
    return ROLES.index(name) if name in ROLES else START


@lru_cache(maxsize=4)
def steps(role: int) -> tuple[tuple[int, int, int, str, int], ...]:
    """(from, to, cost, action, inserted role) of a turn with this role; the cheapest for each
    pair of roles, of equal ones the first in this order: keep or relabel, insert, merge."""
    best: dict[tuple[int, int], tuple[int, str, int]] = {}

    def offer(before: int, after: int, cost: int, action: str, inserted: int = START) -> None:
        if cost < best.get((before, after), (FAR,))[0]:
            best[before, after] = cost, action, inserted

    for before in range(4):
        for own in (SYSTEM, USER, ASSISTANT):
            label = 0 if own == role else RELABEL
            name = "" if own == role else "relabel"
            if own in AFTER[before]:
                offer(before, own, label, name or "keep")
            for between in AFTER[before]:
                if own in AFTER[between]:
                    offer(before, own, label + INSERT, name or "keep", between)
            if own == before:
                offer(before, own, label + MERGE, f"{name} merge".strip())
    return tuple((b, a, *rest) for (b, a), rest in sorted(best.items()))


def combined(roles: list[int]) -> list[int]:
    """The costs from role to role over several turns, 4 * 4."""
    table = [0 if a == b else FAR for a in range(4) for b in range(4)]
    for role in roles:
        own = steps(role)
        new = [FAR] * 16
        for start in range(0, 16, 4):
            for before, after, cost, _, _ in own:
                total = table[start + before] + cost
                if total < new[start + after]:
                    new[start + after] = total
        table = new
    return table


def best_way(roles: list[int], begin: int = START, end: int | None = None) -> tuple[int, list[tuple[int, str, int]]]:
    """The least cost, and (role, action, inserted role) of each turn; ties go to the lower role."""
    costs = [0 if s == begin else FAR for s in range(4)]
    back: list[list] = []
    for role in roles:
        new, choice = [FAR] * 4, [None] * 4
        for before, after, cost, action, inserted in steps(role):
            if costs[before] + cost < new[after]:
                new[after] = costs[before] + cost
                choice[after] = (before, action, inserted)
        back.append(choice)
        costs = new
    state = end if end is not None else min(range(4), key=lambda s: costs[s])
    total, way = costs[state], []
    for choice in reversed(back):
        before, action, inserted = choice[state]
        way.append((state, action, inserted))
        state = before
    return total, way[::-1]


def _runs(conversations: list) -> Iterator[tuple[int, int]]:
    begin = 0
    for i in range(1, len(conversations) + 1):
        if i == len(conversations) or conversations[i] != conversations[begin]:
            yield begin, i
            begin = i


_EDGE = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("costs", pa.list_(pa.int64()))])


def _edges(part: pa.Table) -> pa.Table:
    """The combined steps of a part's first and last conversation."""
    part = part.sort_by("place")
    ids, roles = part["conv_id"].to_pylist(), [role_number(r) for r in part["role"].to_pylist()]
    runs = list(_runs(ids))
    ends = [runs[0], runs[-1]][: len(runs)]
    rows = [{"part": part["part"][0].as_py(), "conv_id": ids[a], "costs": combined(roles[a:b])} for a, b in ends]
    return pa.Table.from_pylist(rows, schema=_EDGE)


_JOINT = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("begin", pa.int32()), ("end", pa.int32())])


def _joints(edges: pa.Table) -> pa.Table:
    """The roles with which the parts of a conversation begin and end; no end for its last part."""
    rows = edges.sort_by("part").to_pylist()
    costs, before = [0, FAR, FAR, FAR], []
    for row in rows:
        before.append(costs)
        costs = [min(costs[s] + row["costs"][4 * s + e] for s in range(4)) for e in range(4)]
    end = min(range(4), key=lambda s: costs[s])
    found = []
    for i in range(len(rows) - 1, -1, -1):
        begin = min(range(4), key=lambda s: before[i][s] + rows[i]["costs"][4 * s + end])
        found.append({"part": rows[i]["part"], "conv_id": rows[i]["conv_id"], "begin": begin, "end": None if i == len(rows) - 1 else end})
        end = begin
    return pa.Table.from_pylist(found, schema=_JOINT)


_REPAIRED = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("action", pa.string()), ("new_role", pa.string()), ("inserted", pa.string()), ("rendered", pa.string())]
)
_REPAIRED_COLUMNS = "conv_id long, turn long, role string, action string, new_role string, inserted string, rendered string"


def _piece(text: str | None, role: int, action: str, inserted: int, first: bool, last: bool) -> str:
    """What a turn adds to its conversation; marks inside of texts are broken up."""
    own = (text or "").replace("<|", "< |")
    if action.endswith("merge"):
        out = f"\n{own}"
    else:
        between = f"{BEGIN}{ROLES[inserted]}\n{END}" if inserted else ""
        out = f"{'' if first else END}{between}{BEGIN}{ROLES[role]}\n{own}"
    return out + END if last else out


def _repair(part: pa.Table, joints: pa.Table) -> pa.Table:
    if not len(part):
        return _REPAIRED.empty_table()
    part = part.sort_by("place")
    known = {j["conv_id"]: j for j in joints.to_pylist()}
    ids, roles, texts = part["conv_id"].to_pylist(), part["role"].to_pylist(), part["text"].to_pylist()
    numbers = [role_number(r) for r in roles]
    out: dict[str, list] = {"action": [], "new_role": [], "inserted": [], "rendered": []}
    for a, b in _runs(ids):
        joint = known.get(ids[a], {"begin": START, "end": None})
        _, way = best_way(numbers[a:b], joint["begin"], joint["end"])
        for i, (role, action, inserted) in enumerate(way, a):
            first, last = i == a and joint["begin"] == START, i == b - 1 and joint["end"] is None
            out["action"].append(action)
            out["new_role"].append(ROLES[role])
            out["inserted"].append(ROLES[inserted])
            out["rendered"].append(_piece(texts[i], role, action, inserted, first, last))
    return pa.Table.from_arrays(
        [part["conv_id"], part["turn"], part["role"], *[pa.array(out[c], pa.string()) for c in ("action", "new_role", "inserted", "rendered")]],
        schema=_REPAIRED,
    )


def repair(turns: DataFrame, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """``turns`` (conv_id, turn, role, text, any others) -> a row for each turn: conv_id, turn,
    role, action (keep, merge, relabel, relabel merge), new_role, inserted (the role of an empty
    turn before it, else NULL), rendered.  The rendered pieces of a conversation, one after
    the other by turn, are the conversation.

    Turns are ordered by turn (NULL first), role, text; equal rows follow each other in any order.
    Rows with a NULL conv_id are one conversation.  A role that is NULL or unknown is
    relabelled, a NULL text is empty, and an empty table gives an empty result.  Texts of any length are rendered whole.  Other
    columns are not read, whatever their names.
    """
    spark = turns.sparkSession
    let_workers_import(spark)
    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    rows, size = plain.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // part_rows), -(-size // part_bytes), 1)
    # the row's number only parts rows that are equal in everything else
    order = ["conv_id", "turn", "role", "mark", "row"]
    marked = plain.withColumn("mark", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    dealt = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # places rise along a part
    dealt = written(
        dealt.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()).drop("mark", "row"), "turns"
    )
    edges = written(
        dealt.select("part", "place", "conv_id", "role").groupBy("part").applyInArrow(_edges, "part int, conv_id long, costs array<long>"), "edges"
    )
    several = edges.groupBy(F.col("conv_id").alias("id")).agg(F.count("*").alias("n")).where("n > 1")
    cut = edges.join(several, F.col("conv_id").eqNullSafe(F.col("id"))).select("part", "conv_id", "costs")
    joints = cut.groupBy("conv_id").applyInArrow(_joints, "part int, conv_id long, begin int, end int")
    return dealt.groupBy("part").cogroup(joints.groupBy("part")).applyInArrow(_repair, _REPAIRED_COLUMNS)
