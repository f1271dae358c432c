"""Chat turns repaired at the least cost, and rendered.

A legal conversation is an optional system turn, then user and assistant in
turn, from a user turn to an assistant turn.  Each turn of the input keeps its
role or gets another (relabel), and is then appended as a turn of its own, after
an empty turn in between where the order needs one (insert), or joined to the
turn before if that has its role (merge).  Dynamic programming over the automaton
finds the cheapest way; missing turns at the end are inserted too.

Conversations are cut into pieces of neighbouring turns.  For each piece a small
matrix holds the least cost from every state before it to every state after it.
The matrices of a conversation are chained, which fixes the states at all
borders, and then each piece is repaired by itself.  So a conversation may have
any number of turns; no task ever holds more than a piece of it, or its matrices.

Turns are ordered by ``turn`` (null last), then role, then text, so ties and
repeated rows have a place.  Null and unknown roles have to be relabelled; role
names are compared without regard to case and white space around them.  A null
text is empty.  Rows of a null conv_id are one conversation.  An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantry.state import materialize

ROLES = ("system", "user", "assistant")
#: States are what the last turn is: nothing yet, or a role.
START, SYSTEM, USER, ASSISTANT = range(4)
RELABEL, MERGE, INSERT = 2.0, 1.0, 3.0
#: Turn numbers of one piece, and turns of one call.
PIECE, TOGETHER = 1024, 5000
#: From each state: the states that may come next.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: A rendered turn begins and ends like this.
OPEN, CLOSE = "<|{role}|>\n", "<|end|>\n"


def _ways() -> dict[tuple[int, int], tuple[float, tuple[int, ...] | None]]:
    """From a state to a role: the cost, and the roles inserted before it; None is a merge."""
    ways: dict[tuple[int, int], tuple[float, tuple[int, ...] | None]] = {}
    for state in range(4):
        for role in (SYSTEM, USER, ASSISTANT):
            if role in NEXT[state]:
                ways[state, role] = (0.0, ())
            elif middle := [m for m in NEXT[state] if role in NEXT[m] and m != SYSTEM]:
                ways[state, role] = (INSERT, (middle[0],))
            if state == role and MERGE < ways.get((state, role), (np.inf,))[0]:
                ways[state, role] = (MERGE, None)
    return ways


WAYS = _ways()
#: What is inserted at the end.
ENDINGS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def relabelled(given: int) -> list[float]:
    """The cost of each role for a turn; ``given`` is 0 for an unknown role."""
    return [np.inf, *(0.0 if role == given else RELABEL for role in (SYSTEM, USER, ASSISTANT))]


def step_matrix(given: int) -> np.ndarray:
    """Least cost from each state to each state by one turn."""
    steps = np.full((4, 4), np.inf)
    own = relabelled(given)
    for (state, role), (cost, _) in WAYS.items():
        steps[state, role] = cost + own[role]
    return steps


_STEPS = [step_matrix(given) for given in range(4)]


def piece_matrix(given: list[int]) -> np.ndarray:
    """Least cost from each state to each state by all the turns."""
    total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    for g in given:
        total = (total[:, :, None] + _STEPS[g][None]).min(axis=1)
    return total


def best_path(given: list[int], first: int, last: int) -> list[int]:
    """The roles of the turns on a cheapest way between two states; of equal ones that with the least roles from the end."""
    costs = [np.where(np.arange(4) == first, 0.0, np.inf)]
    for g in given:
        costs.append((costs[-1][:, None] + _STEPS[g]).min(axis=0))
    state, path = last, []
    for at in range(len(given), 0, -1):
        path.append(state)
        state = int(np.argmin(costs[at - 1] + _STEPS[given[at - 1]][:, state]))
    return path[::-1]


def borders(matrices: np.ndarray) -> list[int]:
    """The states before, between and after the pieces of a conversation, endings counted."""
    ends = np.asarray([INSERT * len(ENDINGS[s]) for s in range(4)])
    costs = [np.where(np.arange(4) == START, 0.0, np.inf)]
    for m in matrices:
        costs.append((costs[-1][:, None] + m).min(axis=0))
    state = int(np.argmin(costs[-1] + ends))
    found = [state]
    for at in range(len(matrices), 0, -1):
        state = int(np.argmin(costs[at - 1] + matrices[at - 1][:, state]))
        found.append(state)
    return found[::-1]


def repaired_turns(given: list[int], texts: list[str], first: int, last: int, final: bool) -> list[tuple]:
    """(input turn or None, action, role, rendered) of a piece, in order; the last piece closes the conversation."""
    out: list[tuple] = []

    def opened(role: int) -> str:
        return OPEN.format(role=ROLES[role - 1])

    state = first
    for at, role in enumerate(best_path(given, first, last)):
        _, inserted = WAYS[state, role]
        closing = "" if state == START else CLOSE
        relabel = "relabel" if given[at] != role else ""
        if inserted is None:
            out.append((at, f"merge {relabel}".strip(), role, "\n" + texts[at]))
        else:
            for empty in inserted:
                out.append((None, "insert", empty, closing + opened(empty)))
                closing = CLOSE
            out.append((at, relabel or "keep", role, closing + opened(role) + texts[at]))
        state = role
    if final:
        for empty in ENDINGS[state]:
            out.append((None, "insert", empty, CLOSE + opened(empty)))
            state = empty
        if state != START:
            at, action, role, text = out[-1]
            out[-1] = (at, action, role, text + CLOSE)
    return out


def _pieces(conversations: DataFrame, piece: int) -> DataFrame:
    role = F.lower(F.trim("role"))
    given = F.coalesce(*[F.when(role == r, F.lit(i + 1)) for i, r in enumerate(ROLES)], F.lit(0))
    # a null turn comes after all others
    number = F.coalesce(F.floor(F.col("turn") / piece), F.lit((1 << 62) - 1)).cast("long")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), number.alias("piece"), F.col("turn").cast("long").alias("turn"), given.cast("int").alias("given"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )


ORDER = [(c, "ascending") for c in ("conv_id", "piece", "turn", "role", "text")]


def _cuts(*columns: pa.ChunkedArray) -> list[tuple[int, int]]:
    """Begin and end of each stretch of rows with the same values; the rows are in order."""
    n = len(columns[0])
    change = np.ones(n, bool)
    if n:
        parts = [c.combine_chunks().fill_null(-(1 << 63)).to_numpy(zero_copy_only=False) for c in columns]
        change[1:] = np.logical_or.reduce([p[1:] != p[:-1] for p in parts])
    heads = np.flatnonzero(change).tolist()
    return list(zip(heads, [*heads[1:], n], strict=True)) if n else []


def repair(conversations: DataFrame, piece: int = PIECE, together: int = TOGETHER) -> DataFrame:
    """conv_id, position, turn (null if inserted), action, role, rendered: concatenated by position, a conversation's
    ``rendered`` are its text.  ``position`` is a piece number and a place in it, so that it only orders."""
    calls = max(1, conversations.count() // together)  # a call gets many pieces, as one alone is not worth it
    turns = _pieces(conversations, piece).withColumn("call", F.pmod(F.xxhash64("conv_id", "piece"), F.lit(calls)))

    def measured(group: pa.Table) -> pa.Table:
        group = group.sort_by(ORDER)
        given = group.column("given").to_pylist()
        cuts = _cuts(group.column("conv_id"), group.column("piece"))
        matrices = [piece_matrix(given[a:b]).ravel().tolist() for a, b in cuts]
        first = group.take(pa.array([a for a, _ in cuts], pa.int64()))
        return pa.table({"conv_id": first.column("conv_id"), "piece": first.column("piece"), "matrix": pa.array(matrices, pa.list_(pa.float64()))})

    keys = turns.withColumn("text", F.lit(""))
    matrices = materialize(keys.groupBy("call").applyInArrow(measured, "conv_id long, piece long, matrix array<double>"), "matrices")

    def chained(group: pa.Table) -> pa.Table:
        group = group.sort_by([("conv_id", "ascending"), ("piece", "ascending")])
        rows = group.column("matrix").to_pylist()
        before, after, final, rank = [], [], [], []
        for a, b in _cuts(group.column("conv_id")):
            found = borders(np.asarray(rows[a:b]).reshape(-1, 4, 4))
            before += found[:-1]
            after += found[1:]
            final += [i == b - 1 for i in range(a, b)]
            rank += range(b - a)
        return pa.table({
            "conv_id": group.column("conv_id"), "piece": group.column("piece"), "before": pa.array(before, pa.int32()),
            "after": pa.array(after, pa.int32()), "final": pa.array(final, pa.bool_()), "rank": pa.array(rank, pa.int64()),
        })

    by_conversation = matrices.groupBy(F.pmod(F.xxhash64("conv_id"), F.lit(calls)).alias("call"))
    states = by_conversation.applyInArrow(chained, "conv_id long, piece long, before int, after int, final boolean, rank long")
    states = states.withColumn("call", F.pmod(F.xxhash64("conv_id", "piece"), F.lit(calls)))

    def rendered(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by(ORDER)
        known = {(r["conv_id"], r["piece"]): r for r in right.to_pylist()}
        given, texts, number = (left.column(c).to_pylist() for c in ("given", "text", "turn"))
        convs, pieces = left.column("conv_id").to_pylist(), left.column("piece").to_pylist()
        out: list[tuple] = []
        for a, b in _cuts(left.column("conv_id"), left.column("piece")):
            state = known[convs[a], pieces[a]]
            rows = repaired_turns(given[a:b], texts[a:b], state["before"], state["after"], state["final"])
            base = state["rank"] << 32
            out += [(convs[a], base + i, None if at is None else number[a + at], action, ROLES[role - 1], text) for i, (at, action, role, text) in enumerate(rows)]
        kinds = {"conv_id": pa.int64(), "position": pa.int64(), "turn": pa.int64(), "action": pa.string(), "role": pa.string(), "rendered": pa.string()}
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        return pa.table({n: pa.array(c, k) for (n, k), c in zip(kinds.items(), columns, strict=True)})

    pairs = turns.groupBy("call").cogroup(states.groupBy("call"))
    return pairs.applyInArrow(rendered, "conv_id long, position long, turn long, action string, role string, rendered string")
