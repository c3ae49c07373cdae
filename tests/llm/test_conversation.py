"""Conversation repair against all edit sequences, and the registered query against a plain program."""

import hashlib
import re
import zlib
from itertools import product

import pytest

from tessera.llm import conversation, queries

SCHEMA = "conv_id long, turn long, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?")


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        word = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append(1 if not word else 2 if (role, text) in seen else 3 if word[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, lines) by trying every edit of every row with up to two insertions around each."""
    found = faults(rows)
    choices = [[("D", None)] + ([] if f in (1, 2) else [("K", None), ("R", "user"), ("R", "assistant")]) for f in found]
    added = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    best = None
    for edits in product(*choices):
        for gaps in product(added, repeat=len(rows) + 1):
            cost, audit, lines = 0, "", []
            for i in range(len(rows) + 1):
                for role in gaps[i]:
                    cost, audit = cost + 3, audit + "I"
                    lines.append((role, ""))
                if i < len(rows):
                    edit, given = edits[i]
                    cost += {"K": 0, "R": 3, "D": 4}[edit] + (3 if edit != "D" and found[i] == 3 else 0)
                    audit += edit
                    if edit != "D":
                        lines.append((given or rows[i][1], rows[i][2]))
            if SHAPE.fullmatch("".join(r[:1] or "?" for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in lines))
    return best


def plain(rows):
    """The program backwards over whole strings, rows as (turn, role, text) in order."""
    found, states = faults(rows), {"": ("u", "s"), "s": ("u",), "u": ("a",), "a": ("u",)}
    after = {"": (0, "", ()), "a": (0, "", ())}  # state → cost, audit and lines of the rest

    def closed(rest):
        for _ in range(3):
            for state in states:
                to = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                if to in rest:
                    cost, audit, lines = rest[to]
                    new = (cost + 3, "I" + audit, (({"u": "user", "a": "assistant"}[to], ""), *lines))
                    if state not in rest or new[:2] < rest[state][:2]:
                        rest[state] = new
        return rest

    rest = closed(dict(after))
    for (_, role, text), fault in zip(reversed(rows), reversed(found)):
        now = {}
        for state, nexts in states.items():
            options = []
            if state in rest:
                c, a, lines = rest[state]
                options.append((c + 4, "D" + a, lines))
            if fault not in (1, 2):
                for to in nexts:
                    if to in rest:
                        c, a, lines = rest[to]
                        more = 3 if fault == 3 else 0
                        if role[:1] == to:
                            options.append((c + more, "K" + a, ((role, text), *lines)))
                        elif to != "s":
                            options.append((c + 3 + more, "R" + a, (({"u": "user", "a": "assistant"}[to], text), *lines)))
            if options:
                now[state] = min(options)
        rest = closed(now)
    cost, audit, lines = rest[""]
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)


def expected(rows):
    """PARTS of the rows (turn, role, text) of a conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    found = faults(rows)
    turns = {r[0] for r in rows if r[0] is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, text = plain(rows)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, found.count(1), found.count(2), found.count(3), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


TALKS = [
    [(0, "user", "Hi."), (1, "assistant", "Yes.")],
    [(0, "system", "S."), (1, "user", "Hi"), (2, "user", "Hi.")],
    [(0, "assistant", "A."), (1, "assistant", "B."), (2, "user", "")],
    [(0, "system", "S.")],
    [(0, "user", "a."), (0, "user", "a."), (3, "assistant", "b")],
    [(None, "tool", "x."), (2, "unknown", "y."), (5, "", "z.")],
    [(0, "user", "  "), (1, "user", "\t\n")],
    [(1, "user", "q."), (2, "system", "r."), (3, "assistant", "s!")],
    [(1, "system", "q."), (2, "system", "r."), (3, "system", "t.")],
    [(7, "user", "endé"), (7, "assistant", "end?　")],
]


@pytest.mark.parametrize("talk", TALKS)
def test_program_equals_all_edit_sequences(talk):
    rows = sorted(talk, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert plain(rows) == brute(rows)


def test_report_equals_the_plain_program(spark):
    data = [(i, *r) for i, talk in enumerate(TALKS) for r in talk]
    got = {r[0]: tuple(r[1:]) for r in conversation.repair_report(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {i: expected(talk) for i, talk in enumerate(TALKS)}


def test_query_equals_the_plain_program(spark, sf_dir):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    talks = {r[0]: [] for r in turns}
    for conv, turn, role, text in turns:
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if fault == 1 else re.sub(r"[.!?]", "", text) if fault == 2 else text
        talks[conv] += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {c: expected(rows) if rows else nothing for c, rows in talks.items()}
    got = queries.op12_conversation_repair(spark, sf_dir).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want
    assert len(got) == len(want)


def test_long_conversation_over_many_batches_and_a_spilled_trail(spark, monkeypatch):
    roles = ["user", "assistant", "assistant", "system", "user", "user"]
    rows = [(7, i, roles[i * i % 6], f"t{i % 3001}" + (".", "", "!")[i % 3]) for i in range(25_000)]
    monkeypatch.setattr(conversation, "SPOOL", 64)
    got = conversation.repair_report(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert [tuple(r)[1:] for r in got] == [expected([r[1:] for r in rows])]


def test_nulls_no_rows_and_other_columns(spark):
    rows = [(None, None, None, None, 1), (None, 3, "user", None, 2), (2**60 + 1, 2**60 + 1, "user", "a.", 3)]
    df = spark.createDataFrame(rows, SCHEMA + ", key int")
    got = {r["conv_id"]: tuple(r[1:]) for r in conversation.repair_report(df).collect()}
    assert got == {None: expected([(None, " ", " "), (3, "user", " ")]), 2**60 + 1: expected([(2**60 + 1, "user", "a.")])}
    assert conversation.repair_report(df.limit(0)).count() == 0
    other = spark.createDataFrame([("x:1", 1, "user", "a."), ("", 1, "user", "b.")], "c string, turn int, role string, text string")
    assert {r[0]: r["audit"] for r in conversation.repair_report(other, "c").collect()} == {"x:1": "KI", "": "KI"}


def test_conversations_that_lose_every_row(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns_have_the_reported_digest(spark):
    df = spark.createDataFrame([(i, *r) for i, talk in enumerate(TALKS) for r in talk], SCHEMA)
    report = conversation.repair_report(df)
    lines = {}
    for r in conversation.repaired_turns(df, report).orderBy("conv_id", "place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in report.collect():
        assert hashlib.sha256("\n".join(lines.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]


def test_one_shuffle(spark, sf_dir):
    plan = conversation.repair_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1
