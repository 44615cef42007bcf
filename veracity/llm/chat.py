"""Chat formatting (10): minimum-cost repair of the roles of a conversation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.common import checkpoint

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = ("", "system", "user", "assistant")
#: Legal next turns; a conversation ends after the assistant.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT = 1, 2, 3
INF = 1 << 40


def inserted(a: int, b: int) -> tuple[int, ...] | None:
    """Fewest empty turns that make ``b`` legal after ``a``; None if nothing does."""
    paths: list[tuple[int, ...]] = [(a,)]
    seen = {a} if a != b else set()
    while paths:
        longer = []
        for p in paths:
            for c in NEXT[p[-1]]:
                if c == b:
                    return p[1:]
                if c not in seen:
                    seen.add(c)
                    longer.append((*p, c))
        paths = longer
    return None


def _steps() -> tuple[np.ndarray, list[list[tuple[int, ...] | None]]]:
    """Cost of a turn of role ``b`` after one of role ``a``, and the empty turns before it (None: merged)."""
    cost = np.full((4, 4), INF)
    turns: list[list[tuple[int, ...] | None]] = [[None] * 4 for _ in range(4)]
    for a in range(4):
        for b in (SYSTEM, USER, ASSISTANT):
            between = inserted(a, b)
            if between is not None:
                cost[a, b], turns[a][b] = INSERT * len(between), between
            if a == b and cost[a, b] > MERGE:
                cost[a, b], turns[a][b] = MERGE, None
    return cost, turns


COST, TURNS = _steps()
#: Empty turns after the last turn, and their cost.
TAIL = {a: () if a == ASSISTANT else (*inserted(a, ASSISTANT), ASSISTANT) for a in range(4)}
END = np.array([INSERT * len(TAIL[a]) for a in range(4)])


def step(role: int) -> np.ndarray:
    """Cost matrix of one turn: from the role before to the role it gets."""
    m = COST.copy()
    for b in (SYSTEM, USER, ASSISTANT):
        if b != role:
            m[:, b] += RELABEL
    return np.minimum(m, INF)


STEPS = [step(r) for r in range(4)]


def product(roles: list[int]) -> np.ndarray:
    """(min, +) product of the steps of a run of turns."""
    m = np.where(np.eye(4, dtype=bool), 0, INF)
    for r in roles:
        m = np.minimum((m[:, :, None] + STEPS[r][None]).min(axis=1), INF)
    return m


def best(roles: list[int], enter: int = START, leave: int | None = None) -> list[int]:
    """Roles of a run of turns at least cost, from the role before it to its last role (None: the end
    of the conversation, with its empty turns).  Ties go to the smaller role number."""
    f = [INF] * 4
    f[enter] = 0
    back = []
    for r in roles:
        s = STEPS[r].tolist()
        frm, to = [0] * 4, [INF] * 4
        for b in (SYSTEM, USER, ASSISTANT):
            for a in range(4):
                c = f[a] + s[a][b]
                if c < to[b]:
                    to[b], frm[b] = c, a
        f = to
        back.append(frm)
    last = min(range(4), key=lambda a: (f[a] + int(END[a]), a)) if leave is None else leave
    out = []
    for frm in reversed(back):
        out.append(last)
        last = frm[last]
    return out[::-1]


def borders(segments: list[tuple[int, object, np.ndarray]]) -> dict[tuple[int, object], tuple[int, int]]:
    """Roles before and after each segment of conversations that several partitions share.

    ``segments``: (partition, conversation, product), at most two per partition.
    """
    out = {}
    by: dict[object, list[tuple[int, np.ndarray]]] = {}
    for pid, conv, m in sorted(segments, key=lambda x: x[0]):
        by.setdefault(conv, []).append((pid, m))
    for conv, parts in by.items():
        if len(parts) < 2:
            continue
        f = [np.array([0, INF, INF, INF])]
        for _, m in parts:
            f.append(np.minimum((f[-1][:, None] + m).min(axis=0), INF))
        at = int((f[-1] + END).argmin())
        states = [at]
        for i in range(len(parts) - 1, -1, -1):
            at = int((f[i] + parts[i][1][:, at]).argmin())
            states.append(at)
        states.reverse()
        for i, (pid, _) in enumerate(parts):
            out[pid, conv] = (states[i], states[i + 1] if i + 1 < len(parts) else -1)
    return out


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, object, list[pa.RecordBatch]]]:
    """Conversations of a sorted partition: partition, id, and their rows (pid, conv_id, ...)."""
    held: list[pa.RecordBatch] = []
    key = None
    for b in batches:
        conv = b.column(1).to_pylist()
        lo = 0
        for i in range(1, len(conv) + 1):
            if i == len(conv) or conv[i] != conv[lo]:
                if held and key != conv[lo]:
                    yield held[0].column(0)[0].as_py(), key, held
                    held = []
                key = conv[lo]
                held.append(b.slice(lo, i - lo))
                lo = i
    if held:
        yield held[0].column(0)[0].as_py(), key, held


def roles_of(rows: list[pa.RecordBatch]) -> list[int]:
    return [ROLES.get(r, START) for b in rows for r in b.column(3).to_pylist()]


def mark(role: int) -> str:
    return f"<|{NAMES[role]}|>\n"


CLOSE = "<|end|>\n"


def repair(conversations: DataFrame) -> DataFrame:
    """Per turn: ``conv_id, turn, role, new_role, action, inserted, appended, fragment``.

    A dynamic program over the automaton of legal turns (an optional system turn, then
    user and assistant in turn, the assistant last) finds the cheapest repair: merging a turn
    into the one before (1), relabelling (2), inserting an empty turn (3).  ``action`` is
    keep, relabel, merge or relabel+merge; ``inserted`` are the roles of empty turns
    before the turn, ``appended`` of those after the last.  The fragments of a conversation
    in the order of its turns, put together, are the rendered repaired sequence.

    Turns are dealt out by ranges of (conversation, turn), so a long conversation lies in
    several partitions; each sends the (min, +) product of at most two conversations to the
    driver, which fixes the roles at the borders.  The dealt rows are checkpointed, so
    that the borders stay the same.  Turns of one number (repeated rows too) go by the
    hash of role and text; a null turn is first; a null conversation is one of its own; a
    null or unknown role must be relabelled; a null text is empty; an empty table gives
    an empty result; other columns are dropped.
    """
    c = conversations.select("conv_id", "turn", F.lower(F.trim("role")).alias("r"), "role", "text")
    tie = F.xxhash64("role", "text")
    c = c.withColumn("tie", tie).repartitionByRange("conv_id", "turn", "tie").sortWithinPartitions("conv_id", "turn", "tie")
    c = checkpoint(c.select(F.spark_partition_id().alias("pid"), "conv_id", "turn", "r", "role", "text"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for pid, conv, rows in runs(batches):
            if first is None:
                first = (pid, conv, product(roles_of(rows)))
            else:
                last = (pid, conv, rows)
        out = [x for x in (first, last and (*last[:2], product(roles_of(last[2])))) if x]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2].ravel().tolist() for x in out], pa.list_(pa.int64()))], ["pid", "conv_id", "m"])

    got = c.select("pid", "conv_id", "turn", "r").mapInArrow(ends, "pid int, conv_id long, m array<long>").collect()
    fixed = borders([(r["pid"], r["conv_id"], np.array(r["m"]).reshape(4, 4)) for r in got])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pid, conv, rows in runs(batches):
            enter, leave = fixed.get((pid, conv), (START, -1))
            old = roles_of(rows)
            new = best(old, enter, None if leave < 0 else leave)
            turn, role, text = ([v for b in rows for v in b.column(i).to_pylist()] for i in (2, 4, 5))
            before = [enter, *new[:-1]]
            action, ins, app, frag = [], [], [], []
            for i, (a, b, o) in enumerate(zip(before, new, old, strict=True)):
                between = TURNS[a][b]
                action.append(("relabel" if b != o else "") + ("+" if b != o and between is None else "")
                              + ("merge" if between is None else "") or "keep")
                ins.append([NAMES[x] for x in between or ()])
                tail = TAIL[b] if leave < 0 and i == len(new) - 1 else None
                app.append([NAMES[x] for x in tail or ()])
                start = "\n" if between is None else (CLOSE if a != START else "") + "".join(
                    mark(x) + CLOSE for x in between) + mark(b)
                end = "" if tail is None else CLOSE + "".join(mark(x) + CLOSE for x in tail)
                frag.append(start + (text[i] or "") + end)
            words = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(new), pa.int64()), pa.array(turn, pa.int64()), pa.array(role, pa.string()),
                 pa.array([NAMES[x] for x in new]), pa.array(action), pa.array(ins, words), pa.array(app, words),
                 pa.array(frag, pa.string())],
                ["conv_id", "turn", "role", "new_role", "action", "inserted", "appended", "fragment"])

    return c.mapInArrow(solve, "conv_id long, turn long, role string, new_role string, action string, "
                               "inserted array<string>, appended array<string>, fragment string")
