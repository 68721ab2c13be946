"""Chat formatting by minimum-cost role repair.

Legal conversations are those of an automaton: an optional system turn, then
user and assistant turns in alternation, the user first. A dynamic program over
its states repairs any other sequence of turns at the least cost: a turn is
kept (0), merged into the turn before of the same role (1), relabelled (2), or
an empty turn of the legal role is inserted before it (3); a relabelled turn can
be merged and can follow an inserted one, at the sum of the costs. Of equal
costs the first choice in ``CHOICES`` order wins. The repaired sequence is
rendered turn by turn: the pieces of a conversation, in order, are its text.

A conversation of any length is split: turns are sorted by range over all
tasks, each task solves its conversations, and of those that cross a border it
gives the least cost from each state to each state (a min-plus matrix). The
matrices of a conversation - one for each task that holds a part of it - fix the
states at the borders; then every task fills in its turns.

Cases: null or unknown roles must be relabelled; null texts are empty; a null
conversation id is one conversation; turns are ordered by turn (null first),
then role, text hash and text, so repeated turns are each a turn. Other columns are
ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.llm.common import stored

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT = 1, 2, 3
OPEN, CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"
INF = float("inf")


def _choices(role: str | None) -> list[list[list[tuple[float, str, int]]]]:
    """[state][next state] -> (cost, action, inserted state or 0)."""
    own = ROLES.index(role) + 1 if role in ROLES else 0
    out: list[list[list[tuple]]] = [[[] for _ in range(4)] for _ in range(4)]
    for s in range(4):
        for t in (SYSTEM, USER, ASSISTANT):
            change = 0 if t == own else RELABEL
            name = "keep" if t == own else "relabel"
            if t in NEXT[s]:
                out[s][t].append((change, name, 0))
            if t == s:
                out[s][t].append((MERGE + change, "merge" if t == own else "relabel+merge", 0))
            for mid in NEXT[s]:
                if t in NEXT[mid]:
                    out[s][t].append((INSERT + change, "insert+" + name, mid))
    return out


CHOICES = {r: _choices(r) for r in (*ROLES, None)}
COSTS = {r: np.array([[min((x[0] for x in c), default=INF) for c in row] for row in CHOICES[r]]) for r in CHOICES}


def least_costs(roles: list[str | None]) -> np.ndarray:
    """Least cost of the turns from each state to each state."""
    total = np.where(np.eye(4) > 0, 0.0, INF)
    for r in roles:
        total = (total[:, :, None] + COSTS[r if r in ROLES else None][None]).min(1)
    return total


def solve(roles: list[str | None], first: int = START, last: int | None = None) -> list[tuple[int, str, int, float]]:
    """(state, action, inserted state or 0, cost) of every turn on the least-cost
    path from state ``first`` to ``last`` (any, if None)."""
    known = [r if r in ROLES else None for r in roles]
    rest = np.full(4, INF)
    if last is None:
        rest[:] = 0
    else:
        rest[last] = 0
    ahead = [rest]
    for r in reversed(known):
        rest = (COSTS[r] + rest[None]).min(1)
        ahead.append(rest)
    ahead.reverse()
    out, s = [], first
    for k, r in enumerate(known):
        cost, action, mid, t = min(((c + ahead[k + 1][t], c, a, m, t) for t in range(1, 4) for c, a, m in CHOICES[r][s][t]),
                                   key=lambda x: x[0])[1:]
        out.append((t, action, mid, cost))
        s = t
    return out


def piece(first: bool, state: int, action: str, inserted: int, text: str, final: bool) -> str:
    """What a turn adds to the rendered conversation."""
    if action.endswith("merge"):
        out = "\n" + text
    else:
        out = "" if first else CLOSE
        if inserted:
            out += OPEN.format(ROLES[inserted - 1]) + CLOSE
        out += OPEN.format(ROLES[state - 1]) + text
    return out + (CLOSE if final else "")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Runs of one conversation within a part, over batches."""
    now: dict | None = None
    for batch in batches:
        for row in batch.to_pylist():
            if now is None or (now["part"], now["conv_id"]) != (row["part"], row["conv_id"]):
                if now is not None:
                    yield now
                now = row | {"rows": []}
            now["rows"].append((row["turn"], row["role"], row["text"]))
    if now is not None:
        yield now


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every part: the matrices of its first and its last conversation,
    which alone can cross a border."""
    ends: dict[int, list[tuple]] = {}
    for seg in _segments(batches):
        mine = (seg["conv_id"], least_costs([r for _, r, _ in seg["rows"]]))
        kept = ends.setdefault(seg["part"], [])
        kept[1:] = [mine] if kept else []
        if not kept:
            kept.append(mine)
    rows = [(part, *x) for part, kept in ends.items() for x in kept]
    yield pa.record_batch([pa.array([f[0] for f in rows], pa.int32()), pa.array([f[1] for f in rows], pa.int64()),
                           pa.array([f[2].ravel().tolist() for f in rows], pa.list_(pa.float64()))],
                          names=["part", "conv_id", "costs"])


def border_states(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(first, last) state of each part of a conversation on a least-cost path."""
    rest = [np.zeros(4)]
    for m in reversed(matrices):
        rest.append((m + rest[-1][None]).min(1))
    rest.reverse()
    out, s = [], START
    for k, m in enumerate(matrices):
        t = int(np.argmin(m[s] + rest[k + 1]))
        out.append((s, t))
        s = t
    return out


def _borders(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    rows = sorted(zip(group.column("part").to_pylist(), group.column("costs").to_pylist(), strict=True))
    states = border_states([np.array(c).reshape(4, 4) for _, c in rows])
    n = len(rows)
    return pa.table({"part": pa.array([p for p, _ in rows], pa.int32()),
                     "conv_id": pa.array([key[0].as_py()] * n, pa.int64()),
                     "first": pa.array([s for s, _ in states], pa.int32()),
                     "last": pa.array([t for _, t in states], pa.int32()),
                     "opens": pa.array([k == 0 for k in range(n)]), "closes": pa.array([k == n - 1 for k in range(n)])})


_OUT = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.int64()), ("role", pa.string()),
                  ("action", pa.string()), ("inserted", pa.string()), ("cost", pa.int64()), ("rendered", pa.string())])


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for seg in _segments(batches):
        whole = seg["first"] is None
        path = solve([r for _, r, _ in seg["rows"]], START if whole else seg["first"], None if whole else seg["last"])
        for k, ((turn, _, text), (state, action, mid, cost)) in enumerate(zip(seg["rows"], path, strict=True)):
            first = k == 0 and (whole or seg["opens"])
            final = k == len(path) - 1 and (whole or seg["closes"])
            text = piece(first, state, action, mid, text or "", final)
            out.append((seg["conv_id"], turn, (seg["part"] << 33) + k, ROLES[state - 1], action, ROLES[mid - 1] if mid else None,
                        int(cost), text))
            size += len(text)
            if size > 1 << 22:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)
                out, size = [], 0
    if out:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)


def repair(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, place (ascending within a conversation),
    role (repaired), action, inserted (role of an empty turn before it), cost, rendered."""
    order = ["conv_id", "turn", "role", "h", "text"]
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    t = t.withColumn("h", F.xxhash64("text"))
    placed = stored(t.repartitionByRange(*order[:4]).withColumn("part", F.spark_partition_id()), "turns")
    by_part = ["part", *order]
    costs = (placed.withColumn("text", F.lit(None).cast("string")).repartition("part").sortWithinPartitions(*by_part)
             .select("part", "conv_id", "turn", "role", "text")
             .mapInArrow(_matrices, "part int, conv_id long, costs array<double>"))
    borders = costs.groupBy("conv_id").applyInArrow(
        _borders, "part int, conv_id long, first int, last int, opens boolean, closes boolean")
    # two rows a part at most: the broadcast grows with the number of tasks, not of turns
    both = (placed.alias("k").join(F.broadcast(borders).alias("b"), (F.col("k.part") == F.col("b.part"))
                                   & F.col("k.conv_id").eqNullSafe(F.col("b.conv_id")), "left")
            .select("k.part", "k.conv_id", "turn", "role", "text", "h", "first", "last", "opens", "closes"))
    return both.repartition("part").sortWithinPartitions(*by_part).mapInArrow(
        _filled, "conv_id long, turn long, place long, role string, action string, inserted string, "
        "cost long, rendered string")
