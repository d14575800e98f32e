"""Conversation repair against trying every edit, and the whole query against plain Python."""

import hashlib
import random
import zlib
from itertools import product

import pytest

from feedwright.llm import conversation_repair as repair_
from feedwright.llm.conversation_repair import BLANK, DUPLICATE, SOUND, TRUNCATED, Costs, Row, cheapest, repair, spelled, transcript_digests
from feedwright.llm.queries import op13_conversation_repair

TURNS = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\f\r"


def every_repair(rows, costs, inserts):
    """(cost, audit) of every way to edit the rows into system? (user assistant)*, with at most so many inserts."""
    done = []

    def go(i, state, cost, audit, left):
        if i == len(rows) and state in "-a":
            done.append((cost, audit))
        if left:
            for role, before in (("u", "-sa"), ("a", "u")):
                if state in before:
                    go(i, role, cost + costs.insert, audit + "I", left - 1)
        if i == len(rows):
            return
        initial, fault = rows[i]
        go(i + 1, state, cost + costs.delete, audit + "D", left)
        if fault in (BLANK, DUPLICATE):
            return
        more = costs.unfinished if fault == TRUNCATED else 0
        allowed = {"s": "-", "u": "-sa", "a": "u"}
        if state in allowed.get(initial, ""):
            go(i + 1, initial, cost + more, audit + "K", left)
        for role in "ua":
            if state in allowed[role]:
                go(i + 1, role, cost + more + costs.rerole, audit + "R", left)

    go(0, "-", 0, "", inserts)
    return min(done)


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 2, 1, 5), Costs(3, 2, 2, 1), Costs(1, 1, 1, 1), Costs(0, 0, 0, 0)])
def test_the_least_integer_is_the_cheapest_repair_first_in_ascii_order(costs):
    rng = random.Random(5)
    for _ in range(60):
        rows = [Row(rng.choice("suatx"), rng.choice([SOUND, SOUND, TRUNCATED, BLANK, DUPLICATE])) for _ in range(rng.randint(0, 4))]
        weights = cheapest(rows, costs=costs, inserts=2)
        least = min(weights[s] for s in repair_.DONE if weights[s] is not None)
        assert spelled(least, len(rows) + 2) == every_repair(rows, costs, 2), rows


def test_no_cheapest_repair_inserts_a_turn():
    assert Costs().never_inserts()
    for rows in product([Row(i, f) for i in "sua" for f in (SOUND, TRUNCATED)], repeat=3):
        assert "I" not in every_repair(rows, Costs(), 3)[1]


def test_costs_at_which_inserting_pays_are_refused(spark):
    with pytest.raises(ValueError, match="insert"):
        repair(spark.createDataFrame([], TURNS), Costs(insert=4))


def plain_repair(rows):
    """Figures, audit and transcript of the ordered (turn, role, text) rows of one conversation."""
    seen, judged = set(), []
    for _, role, text in rows:
        said = text.rstrip(WHITE)
        if not said:
            fault = BLANK
        elif (role, text) in seen:
            fault = DUPLICATE
        else:
            fault = SOUND if said[-1] in ".!?" else TRUNCATED
        seen.add((role, text))
        judged.append((role[:1], fault))
    best = {"-": (0, "", ())}
    for (initial, fault), (_, role, text) in zip(judged, rows):
        after = {}

        def offer(state, cost, audit, said):
            after[state] = min(after.get(state, (cost, audit, said)), (cost, audit, said), key=lambda x: x[:2])

        for state, (cost, audit, said) in best.items():
            offer(state, cost + 2, audit + "D", said)
            if fault in (BLANK, DUPLICATE):
                continue
            more = 5 if fault == TRUNCATED else 0
            for to, before in (("s", "-"), ("u", "-sa"), ("a", "u")):
                if state in before:
                    if initial == to:
                        offer(to, cost + more, audit + "K", (*said, f"{role}:{text}"))
                    if to != "s":
                        offer(to, cost + more + 1, audit + "R", (*said, f"{ {'u': 'user', 'a': 'assistant'}[to]}:{text}"))
        best = after
    cost, audit, said = min((best[s] for s in "-a" if s in best), key=lambda x: x[:2])
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults = [f for _, f in judged]
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
    digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
    return (gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal, cost, audit, digest)


def in_turn(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))


def plain_by_conversation(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: plain_repair(in_turn(own)) for conv, own in convs.items()}


def found_by_conversation(found):
    digests = {r["conv_id"]: r["sha256"] for r in transcript_digests(found.rows).collect()}
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {r["conv_id"]: (*(r[n] for n in names), digests[r["conv_id"]]) for r in found.report.collect()}


def awkward_turns(seed=2, convs=30):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "and then", "", " \t", "Ça va?\n", "x", None, "wait…"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in [*range(convs), None]:
        for _ in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([None, *range(12)]), rng.choice(roles[:3] * 3 + roles), rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.random()}."))
    # One conversation holds most rows, over many blocks and tasks; some repeat, and one text is very long.
    rows += [(7, i // 2, rng.choice(roles[:3]), rng.choice([*texts, f"Turn {i}.", f"cut {i}"])) for i in range(700)]
    rows += [(8, 3, "user", "word " * 40_000 + "end."), (9, 1, "user", "Twice."), (9, 1, "user", "Twice.")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [2, 12])
def test_reports_and_transcripts_equal_plain_python(spark, bits):
    rows = awkward_turns()
    clash = "seq string, run string, edits string, block string, key string, rid string, kind string, fault string"
    df = spark.createDataFrame([(*r, *"abcdefgh") for r in rows], f"{TURNS}, {clash}").repartition(5)
    assert found_by_conversation(repair(df, block_bits=bits)) == plain_by_conversation(rows)


def test_rows_carry_their_edit_and_new_role(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello."), (1, 2, "tool", "cut"), (1, 3, "user", "Bye.")]
    found = repair(spark.createDataFrame(rows, TURNS)).rows.orderBy("seq").collect()
    assert [(r["edit"], r["role"], r["text"]) for r in found] == [("D", "user", "Hi."), ("K", "user", "Hello."), ("D", "tool", "cut"), ("R", "assistant", "Bye.")]


def test_no_conversations(spark):
    found = repair(spark.createDataFrame([], TURNS))
    assert found.report.count() == 0 and found.rows.count() == 0 and transcript_digests(found.rows).count() == 0


def plain_damage(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(dict.fromkeys(map(ord, ".!?")))
        if kind == 4:
            role = "user"
        if kind:
            yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def plain_query(rows):
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return dict.fromkeys((r[0] for r in rows), empty) | plain_by_conversation(plain_damage(rows))


def from_query(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = op13_conversation_repair(spark, sf)
    assert found.count() == len({r[0] for r in rows})
    assert from_query(found) == plain_query(rows)


def test_query_with_nulls_and_conversations_that_lose_every_row(spark, tmp_path):
    lost = next(i for i in range(1000, 9999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [*awkward_turns(seed=4, convs=60), (lost, 0, "user", "Gone."), (lost + 1, None, None, None)]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert from_query(op13_conversation_repair(spark, str(tmp_path))) == plain_query(rows)
