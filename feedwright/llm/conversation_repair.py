"""Repair of conversation structure by integer weights.

A conversation is repaired by the cheapest edits that make its roles read system? (user assistant)*.
A path of edits weighs one integer: the cost in its high digits, and below them a digit per edit, the
first edit highest, in the order of the edits' letters, zeros behind the last. The least integer over
the graph of (rows read, inserts made, state) is the cheapest repair, the first in ASCII order of
several, and its digits spell the edits. Long conversations are cut into stretches, whose weights for
every pair of states at their ends are put together by the same minimum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import join_groups, stored

# Edits in ASCII order are digits from 1; zero stands behind the last edit.
EDITS = "DIKR"
DIGIT = {letter: place for place, letter in enumerate(EDITS, 1)}
BITS = 3
SPELL = str.maketrans("1234", EDITS)
# What is read so far: nothing, a system turn, and what ends in a user's or in an assistant's turn.
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
DONE = (NOTHING, ASSISTANT)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# Faults of a row, the first that holds counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
WHITE = " \t\n\x0b\f\r"
# Rows of a block, as bits: stretches of a conversation are what of it lies in one block.
BLOCK_BITS = 12


class Costs(NamedTuple):
    """What edits cost. Keeping is free; `unfinished` is added for every truncated row that stays."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    unfinished: int = 5

    def never_inserts(self) -> bool:
        """No cheapest repair inserts a turn.

        Of a pair of turns with an inserted one the other can be deleted instead, and a system turn
        before it too, if it was the only pair. That saves the insert for at most two deletions.
        """
        return self.insert > 2 * self.delete


class Row(NamedTuple):
    initial: str
    fault: int


Weights = list[int | None]


def _least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def cheapest(rows: list[Row], entry: int = NOTHING, costs: Costs = Costs(), inserts: int = 0) -> Weights:
    """The least weight of a path from `entry` over all rows to each state, with at most so many inserts.

    Weights have len(rows) + inserts digits below the cost; None if there is no path.
    """
    digits = len(rows) + inserts

    def edge(letter: str, cost: int, place: int) -> int:
        return (cost << BITS * digits) + (DIGIT[letter] << BITS * (digits - 1 - place))

    def add(weight: int | None, step: int) -> int | None:
        return None if weight is None else weight + step

    # layer[j][state]: the least weight of what has read the rows so far and made j inserts.
    layer: list[Weights] = [[None] * len(STATES) for _ in range(inserts + 1)]
    layer[0][entry] = 0

    def insert(read: int) -> None:
        for j in range(inserts):
            step = edge("I", costs.insert, read + j)
            nothing, system, user, assistant = layer[j]
            after = layer[j + 1]
            after[USER] = _least(after[USER], add(_least(nothing, system, assistant), step))
            after[ASSISTANT] = _least(after[ASSISTANT], add(user, step))

    insert(0)
    for i, (initial, fault) in enumerate(rows):
        for j, (nothing, system, user, assistant) in enumerate(layer):
            delete = edge("D", costs.delete, i + j)
            after = [add(w, delete) for w in layer[j]]
            if fault in (SOUND, TRUNCATED):
                more = costs.unfinished if fault == TRUNCATED else 0
                keep, rerole = edge("K", more, i + j), edge("R", costs.rerole + more, i + j)
                before_user = _least(nothing, system, assistant)
                if initial == "s":
                    after[SYSTEM] = _least(after[SYSTEM], add(nothing, keep))
                after[USER] = _least(after[USER], add(before_user, keep if initial == "u" else rerole))
                after[ASSISTANT] = _least(after[ASSISTANT], add(user, keep if initial == "a" else rerole))
            layer[j] = after
        insert(i + 1)
    return [_least(*(of[state] for of in layer)) for state in STATES]


def spelled(weight: int, digits: int) -> tuple[int, str]:
    """Cost and edits of a weight."""
    low = weight & ((1 << BITS * digits) - 1)
    return weight >> BITS * digits, format(low, "o").zfill(digits).rstrip("0").translate(SPELL) if digits else ""


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the checksum of `conv_id:turn`, nulls as one space.

    Of twenty remainders 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it
    and 4 makes it the user's.
    """
    names = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(names.cast("binary")) % 20).alias("kind"),
    ).filter("kind <> 0")
    kind = F.col("kind")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


def in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `seq`, which orders all rows by conversation, turn (nulls first), role and text; stored.

    Rows are dealt by range, so a conversation with very many rows is dealt over many tasks.
    """
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    first = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
    # The bounds of the ranges go to the driver, so only the head of a text is in them.
    dealt = rows.repartitionByRange(*first, F.left("text", F.lit(16)).asc())
    return stored(dealt.sortWithinPartitions(*first, F.col("text").asc()).withColumn("seq", F.monotonically_increasing_id()))


def with_faults(ordered: DataFrame) -> DataFrame:
    """conv_id, seq, turn, initial and fault of each row: the first of blank, duplicate and truncated."""
    said = F.rtrim(F.col("text"), F.lit(WHITE))
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    key = F.sha2(F.concat_ws(":", name, F.length("role"), "role", "text").cast("binary"), 256)
    rows = ordered.select(
        "conv_id",
        "seq",
        "turn",
        F.left("role", F.lit(1)).alias("initial"),
        (said == "").alias("blank"),
        (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        key.alias("key"),
        F.col("seq").alias("rid"),
    )
    repeated = rows.groupBy("key").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    told = join_groups(rows, stored(repeated), ["key"], "n", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("seq") > F.col("first"), DUPLICATE).when(F.col("truncated"), TRUNCATED)
    return told.select("conv_id", "seq", "turn", "initial", F.coalesce(fault, F.lit(SOUND)).alias("fault"))


RUNS = pa.schema(
    {
        "run": pa.int64(),
        "rows": pa.int64(),
        "blank": pa.int64(),
        "duplicate": pa.int64(),
        "truncated": pa.int64(),
        "illegal": pa.int64(),
        "first_initial": pa.string(),
        "last_initial": pa.string(),
        "turns": pa.int64(),
        "first_turn": pa.int64(),
        "last_turn": pa.int64(),
        "cost": pa.list_(pa.int64()),
        "place": pa.list_(pa.int64()),
        "edits": pa.list_(pa.string()),
    }
)
LEGAL = {"su", "ua", "au"}


def _stretch(first: int, rows: list[Row], turns: list[int | None], entries: Iterable[int], costs: Costs) -> dict:
    """What is known of the rows of a conversation in one block, for each pair of states at their ends."""
    weights: Weights = [None] * len(STATES) ** 2
    for entry in entries:
        weights[entry * len(STATES) : (entry + 1) * len(STATES)] = cheapest(rows, entry, costs)
    found = [None if w is None else spelled(w, len(rows)) for w in weights]
    order = {edits: place for place, edits in enumerate(sorted({f[1] for f in found if f}))}
    numbered = [t for t in turns if t is not None]
    faults = [r.fault for r in rows]
    initials = [r.initial for r in rows]
    return {
        "run": first,
        "rows": len(rows),
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first_initial": initials[0],
        "last_initial": initials[-1],
        "turns": len(set(numbered)),
        "first_turn": numbered[0] if numbered else None,
        "last_turn": numbered[-1] if numbered else None,
        "cost": [None if f is None else f[0] for f in found],
        "place": [None if f is None else order[f[1]] for f in found],
        "edits": [None if f is None else f[1] for f in found],
    }


def _stretches(costs: Costs):
    def of_block(block: pa.Table) -> pa.Table:
        block = block.sort_by("seq")
        conv, seq, turn = (block[c].to_pylist() for c in ("conv_id", "seq", "turn"))
        rows = [Row(i, f) for i, f in zip(block["initial"].to_pylist(), block["fault"].to_pylist())]
        bounds = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)]
        out = []
        for a, b in zip(bounds, bounds[1:]):
            # What begins inside a block begins a conversation; at its start it may go on with one.
            out.append(_stretch(seq[a], rows[a:b], turn[a:b], (NOTHING,) if a else STATES, costs) | {"conv_id": conv[a]})
        kind = block.schema.field("conv_id").type
        return pa.Table.from_pylist(out, pa.schema([("conv_id", kind), *RUNS]))

    return of_block


DECIDED = "run bigint, chosen int, cost bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"


def _decide(runs: list[dict]) -> list[dict]:
    """For each stretch of a conversation the pair of states that the cheapest repair has at its ends, and the whole's figures.

    Only the costs and the order of the stretches' edits are looked at: among paths to a state the
    edits so far are told by their place in ASCII order, four places at most.
    """
    many = len(STATES) ** 2 + 1
    reached: list[tuple[int, int] | None] = [(0, 0), None, None, None]  # cost, place of the edits so far
    steps: list[list[int | None]] = []
    totals = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    turns, first_turn, last_turn, last_initial = 0, None, None, None
    for run in runs:
        best: list[tuple[int, int] | None] = [None] * len(STATES)
        for exit_ in STATES:
            for entry, so_far in enumerate(reached):
                pair = entry * len(STATES) + exit_
                if so_far and run["cost"][pair] is not None:
                    weight = ((so_far[0] + run["cost"][pair]) * many + so_far[1]) * many + run["place"][pair]
                    best[exit_] = min(best[exit_] or (weight, entry), (weight, entry))
        steps.append([b and b[1] for b in best])
        places = {p: i for i, p in enumerate(sorted({b[0] % many**2 for b in best if b}))}
        reached = [b and (b[0] // many**2, places[b[0] % many**2]) for b in best]
        for name in totals:
            totals[name] += run[name]
        totals["illegal"] += last_initial is not None and last_initial + run["first_initial"] not in LEGAL
        last_initial = run["last_initial"]
        if run["turns"]:
            turns += run["turns"] - (last_turn == run["first_turn"])
            first_turn, last_turn = run["first_turn"] if first_turn is None else first_turn, run["last_turn"]
    (cost, _), state = min((reached[s], s) for s in DONE if reached[s])
    chosen = []
    for step in reversed(steps):
        entry = step[state]
        chosen.append(entry * len(STATES) + state)
        state = entry
    gaps = last_turn - first_turn + 1 - turns if turns else 0
    same = {"cost": cost, "gaps": gaps} | totals
    return [{"run": run["run"], "chosen": c} | same for run, c in zip(runs, reversed(chosen))]


def _decided(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is decided of conversations that follow each other, stretch after stretch."""
    names = [part.split()[0] for part in DECIDED.split(", ")]
    kinds = pa.schema([(n, pa.int32() if n == "chosen" else pa.int64()) for n in names])
    runs: list[dict] = []
    for batch in batches:
        out = []
        for run in batch.to_pylist():
            if runs and run["conv_id"] != runs[0]["conv_id"]:
                out += _decide(runs)
                runs = []
            runs.append(run)
        yield pa.RecordBatch.from_pylist(out, kinds)
    if runs:
        yield pa.RecordBatch.from_pylist(_decide(runs), kinds)


class Repair(NamedTuple):
    """`report`: a row per conversation, its faults, cost and audit. `rows`: every row read, with its edit."""

    report: DataFrame
    rows: DataFrame


def repair(conversations: DataFrame, costs: Costs = Costs(), block_bits: int = BLOCK_BITS) -> Repair:
    """Repair each conversation of (conv_id, turn, role, text) at least cost.

    Faults of a row, of which the first counts: blank (white space only), duplicate (an earlier row of
    the conversation has its role and text), truncated (its last other character ends no sentence).
    Blank and duplicate rows are deleted; others are kept, get another role or are deleted.

    `report` has conv_id, gaps (missing turn numbers), blank, duplicate, truncated, illegal (neighbours
    whose roles' initials are not su, ua or au), cost and audit, the initials of the edits Delete, Keep
    and Rerole in order. `rows` has conv_id, seq (the order), edit, role (after the edit) and text, in
    order, and each conversation wholly in one task; rows deleted have edit D.

    Null roles and texts are one space, a null turn comes first and makes no gap, a null conv_id is one
    conversation. Ties of turn are ordered by role, then text; equal rows are each read. No rows give
    no report. Other columns are ignored. Costs at which inserting a turn could pay are refused, as
    stretches are put together on the ground that nothing is inserted (Costs.never_inserts).

    A conversation may be of any length: it is taken apart by blocks of rows, of each of which a few
    numbers meet in one task; edits and texts go through one task in a stream.
    """
    if not costs.never_inserts():
        raise ValueError("an insert must cost more than two deletions")
    ordered = in_order(conversations)
    kind = ordered.schema["conv_id"].dataType.simpleString()
    fields = ", ".join(f"{f.name} {_ddl(f.type)}" for f in RUNS)
    blocks = with_faults(ordered).withColumn("block", F.shiftright("seq", block_bits))
    runs = stored(blocks.groupBy("block").applyInArrow(_stretches(costs), f"conv_id {kind}, {fields}"))
    decided = runs.drop("edits").repartition("conv_id").sortWithinPartitions("conv_id", "run").mapInArrow(_decided, DECIDED)
    edits = F.get("edits", "chosen").alias("edits")
    pieces = stored(runs.select("run", "conv_id", "edits").join(decided, "run").select("conv_id", *decided.columns, edits))

    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    spelled_out = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("run", "edits"))), lambda p: p["edits"]), "")
    report = pieces.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in figures), spelled_out.alias("audit"))

    nothing = F.lit(None).cast("string")
    said = ordered.select("conv_id", "seq", F.lit(1).alias("kind"), "role", "text")
    told = pieces.select("conv_id", F.col("run").alias("seq"), F.lit(0).alias("kind"), nothing.alias("role"), F.col("edits").alias("text"))
    stream = told.unionByName(said).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "kind")
    rows = stream.mapInArrow(_edited, f"conv_id {kind}, seq bigint, edit string, role string, text string")
    return Repair(report, rows)


def _ddl(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{_ddl(kind.value_type)}>"
    return "string" if pa.types.is_string(kind) else "bigint"


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with its edit: the edits of a stretch come before its rows."""
    edits: Iterator[str] = iter("")
    state, conv = NOTHING, object()
    for batch in batches:
        out = ([], [], [], [], [])
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            id_, seq, kind, role, text = row
            if id_ != conv:
                conv, state = id_, NOTHING
            if kind == 0:
                edits = iter(text)
                continue
            edit = next(edits)
            if edit != "D":
                turn = USER if state != USER else ASSISTANT
                if edit == "R":
                    role = ROLE[turn]
                state = SYSTEM if edit == "K" and role[0] == "s" else turn
            for values, value in zip(out, (id_, seq, edit, role, text)):
                values.append(value)
        arrays = [pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int64()), *(pa.array(v, pa.string()) for v in out[2:])]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "seq", "edit", "role", "text"])


def transcript_digests(rows: DataFrame) -> DataFrame:
    """conv_id and `sha256` of what is left of each conversation: its `role:text`, joined by line ends.

    `rows` as `repair` returns them, in order. Texts go through the hash one by one, so a task holds no conversation.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = hashed = None
        begun = False
        of_id = None
        for batch in batches:
            out = ([], [])
            of_id = batch.schema.field(0).type
            for id_, edit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text"))):
                if hashed is None or id_ != conv:
                    if hashed is not None:
                        out[0].append(conv)
                        out[1].append(hashed.hexdigest())
                    conv, hashed, begun = id_, hashlib.sha256(), False
                if edit != "D":
                    hashed.update(f"\n{role}:{text}".encode() if begun else f"{role}:{text}".encode())
                    begun = True
            yield pa.RecordBatch.from_arrays([pa.array(out[0], of_id), pa.array(out[1], pa.string())], ["conv_id", "sha256"])
        if hashed is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], of_id), pa.array([hashed.hexdigest()], pa.string())], ["conv_id", "sha256"])

    return rows.mapInArrow(digests, f"conv_id {kind}, sha256 string")
