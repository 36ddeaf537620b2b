"""Role repair of conversations at minimum cost, by dynamic programming over a legal-turn automaton.

A legal conversation is an optional system turn, then user and assistant turns in alternation, a
user turn first. Each source turn may keep its role, take another, or be merged into the turn before; empty turns may be
put in. Costs say what is preferred.

The automaton has four states, so what a stretch of turns costs from any state to any other is a 4 x 4
table, and tables of neighbouring stretches combine. Conversations are cut into chunks of bounded size, so a conversation
of any length spreads over many tasks: first each chunk's table, then a pass over the tables, then each chunk by itself between known states.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.batches import batch, slices
from millrace.session import stored

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
_STATE_OF = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
_LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_NO = 1 << 40
_MARKER = re.compile(r"<(\\*)\|im_(start|end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|im_(start|end)\|>")
_TURN = re.compile(r"<\|im_start\|>(%s)\n(.*?)<\|im_end\|>\n" % "|".join(ROLES), re.S)


@dataclass(frozen=True)
class Costs:
    """``relabel`` a turn, ``merge`` it into the turn before it, put in an empty turn (``insert``); a turn with an unknown role costs ``unknown`` in any role."""

    relabel: int = 3
    merge: int = 1
    insert: int = 2
    unknown: int = 1


# A step is (next state, cost, empty states put in before, whether the turn is merged, its new role's state).
def steps(state: int, role: str | None, costs: Costs) -> list[tuple[int, int, tuple[int, ...], bool]]:
    """What can be done with the next turn, cheapest choices first where costs are equal."""
    own = _STATE_OF.get(role or "")
    as_role = lambda s: costs.unknown if own is None else 0 if s == own else costs.relabel
    out = []
    if state != START and state == own:
        out.append((state, costs.merge, (), True))
    for s in _LEGAL[state]:
        out.append((s, as_role(s), (), False))
        for t in _LEGAL[s]:
            if s != SYSTEM:  # an empty system turn says nothing
                out.append((t, costs.insert + as_role(t), (s,), False))
    return sorted(out, key=lambda x: x[1])


def table(roles: list[str | None], costs: Costs) -> np.ndarray:
    """Least cost from each state to each other over these turns."""
    out = np.full((4, 4), _NO, np.int64)
    for start in range(4):
        best = {start: 0}
        for role in roles:
            after: dict[int, int] = {}
            for state, so_far in best.items():
                for s, cost, _, _ in steps(state, role, costs):
                    after[s] = min(after.get(s, _NO), so_far + cost)
            best = after
        for state, cost in best.items():
            out[start, state] = cost
    return out


def path(roles: list[str | None], start: int, end: int, costs: Costs) -> list[tuple[int, tuple[int, ...], bool]]:
    """The cheapest choices from ``start`` to ``end``; of equal ones the first in the order of ``steps``, from the end backwards."""
    best: list[dict[int, tuple[int, int, tuple[int, ...], bool]]] = [{start: (0, -1, (), False)}]
    for role in roles:
        after: dict[int, tuple[int, int, tuple[int, ...], bool]] = {}
        for state in sorted(best[-1]):
            for s, cost, empty, merged in steps(state, role, costs):
                total = best[-1][state][0] + cost
                if s not in after or total < after[s][0]:
                    after[s] = (total, state, empty, merged)
        best.append(after)
    out, state = [], end
    for at in range(len(roles), 0, -1):
        _, before, empty, merged = best[at][state]
        out.append((state, empty, merged))
        state = before
    return out[::-1]


def escaped(text: str) -> str:
    """The text with a backslash in each turn marker it holds, so that it can neither open nor close a turn."""
    return _MARKER.sub(r"<\\\1|im_\2|>", text)


def turns_of(conversation: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a rendered conversation; the texts as they were before they were escaped, those of merged turns with an empty line between them."""
    return [(role, _ESCAPED.sub(r"<\1|im_\2|>", text)) for role, text in _TURN.findall(conversation)]


def rendered(state: int, empty: tuple[int, ...], merged: bool, first: bool, text: str) -> str:
    """What a turn adds to the rendered conversation: the end of the turn before, empty turns, and its own text, escaped."""
    text = escaped(text)
    if merged:
        return "\n\n" + text
    turns = "".join(f"<|im_start|>{ROLES[s - 1]}\n<|im_end|>\n" for s in empty)
    return ("" if first else "<|im_end|>\n") + turns + f"<|im_start|>{ROLES[state - 1]}\n" + text


_TABLES = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("costs", pa.list_(pa.int64()))])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one chunk at a time; rows come sorted by chunk."""
    held: list[dict] = []
    for part in slices(batches):
        for row in part.to_pylist():
            if held and (held[0]["conv_id"], held[0]["chunk"]) != (row["conv_id"], row["chunk"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def repair_roles(turns: DataFrame, costs: Costs = Costs(), chunk_turns: int = 512) -> DataFrame:
    """One row for each source turn, with what it becomes.

    ``turns`` needs conv_id, turn, role, text. Turns are taken in the order of turn, role, text; a null turn comes first, role case and outer
    spaces do not matter, a null or unknown role may become any. A null text is empty. Turns without a conversation (null id) are left out.
    Columns: conv_id, turn, position (place in the conversation, from 0), role (as it came), new_role, merged (into the turn before),
    empty_before (roles of empty turns put in), rendered. The rendered pieces of a conversation in order
    are the repaired conversation; its last piece ends it.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).where("conv_id IS NOT NULL")
    placed = _positions(rows, chunk_turns)
    clean = placed.withColumn("plain_role", F.lower(F.trim("role")))
    by_chunk = lambda df: df.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "position")

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            costs_here = table([r["plain_role"] for r in run], costs).ravel().tolist()
            yield batch({"conv_id": [run[0]["conv_id"]], "chunk": [run[0]["chunk"]], "costs": [costs_here]}, _TABLES)

    small = by_chunk(clean.select("conv_id", "chunk", "position", "plain_role", F.lit("").alias("text")))
    chunk_tables = small.mapInArrow(tables, "conv_id long, chunk long, costs array<long>")

    ends_schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32()), ("last", pa.bool_())])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of chunk tables, by conversation: the states between chunks on the cheapest way. One row of 16 numbers for each chunk."""

        def solved(rows: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
            best, back = np.full(4, _NO, np.int64), []
            best[START] = 0
            for _, _, flat in rows:
                total = best[:, None] + np.array(flat).reshape(4, 4)
                back.append(total.argmin(axis=0))
                best = np.minimum(total.min(axis=0), _NO)
            state, states = int(best.argmin()), []
            for step in reversed(back):
                states.append((int(step[state]), state))
                state = int(step[state])
            states.reverse()
            n = len(rows)
            return batch(
                {"conv_id": [r[0] for r in rows], "chunk": [r[1] for r in rows], "enter": [a for a, _ in states], "leave": [b for _, b in states], "last": [i == n - 1 for i in range(n)]},
                ends_schema,
            )

        held: list[tuple[int, int, list[int]]] = []
        for part in batches:
            for row in zip(*(part.column(c).to_pylist() for c in ("conv_id", "chunk", "costs"))):
                if held and held[0][0] != row[0]:
                    yield solved(held)
                    held = []
                held.append(row)
        if held:
            yield solved(held)

    ordered = chunk_tables.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    between = stored(ordered.mapInArrow(ends, "conv_id long, chunk long, enter int, leave int, last boolean"), "chat")

    out_schema = pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("new_role", pa.string()), ("merged", pa.bool_()), ("empty_before", pa.list_(pa.string())), ("rendered", pa.string())]
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            chosen = path([r["plain_role"] for r in run], run[0]["enter"], run[0]["leave"], costs)
            pieces = [rendered(s, e, m, r["position"] == 0, r["text"]) for r, (s, e, m) in zip(run, chosen)]
            if run[0]["last"]:
                pieces[-1] += "<|im_end|>\n"
            yield batch(
                {
                    "conv_id": [r["conv_id"] for r in run],
                    "turn": [r["turn"] for r in run],
                    "position": [r["position"] for r in run],
                    "role": [r["role"] for r in run],
                    "new_role": [ROLES[s - 1] for s, _, _ in chosen],
                    "merged": [m for _, _, m in chosen],
                    "empty_before": [[ROLES[x - 1] for x in e] for _, e, _ in chosen],
                    "rendered": pieces,
                },
                out_schema,
            )

    with_ends = clean.join(between.withColumnsRenamed({"conv_id": "c2", "chunk": "k2"}), (F.col("conv_id") == F.col("c2")) & (F.col("chunk") == F.col("k2")))
    return by_chunk(with_ends.drop("c2", "k2")).mapInArrow(
        apply, "conv_id long, turn long, position long, role string, new_role string, merged boolean, empty_before array<string>, rendered string"
    )


def _positions(rows: DataFrame, chunk_turns: int) -> DataFrame:
    """Place of each turn in its conversation and its chunk, without gathering a conversation.

    Rows are range-sorted by conversation and turn, so a long conversation spans several partitions; each knows its place from
    the counts of the partitions before. Stored, so that a task that runs again sees the same places.
    """
    order = ["conv_id", "turn", "role", "text"]
    sorted_rows = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()),
        "turns",
    )
    counts = sorted_rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("begin"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    offsets = counts.select(F.col("conv_id").alias("c1"), F.col("part").alias("p1"), "begin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    joined = sorted_rows.join(offsets, (F.col("conv_id") == F.col("c1")) & (F.col("part") == F.col("p1")))
    position = F.col("at") - F.col("begin") + F.col("offset")
    return joined.select(*order, position.alias("position"), F.floor(position / chunk_turns).cast("long").alias("chunk"))
