"""Conversation structure repair: the cheapest edits that give a conversation the turns it should have.

The rows of a conversation are dealt to one task, sorted by turn and streamed:
the dynamic program keeps one path for each of four states, with the running
digest of its repaired text, across Arrow batches. Only a byte per row and
state is kept to tell the edits at the end; for giant conversations these
backpointers go to a file that belongs to the task and has no name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FINE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: Bytes of backpointers that a conversation keeps in memory.
SPOOL = 1 << 24
SPACE = r"[\x20\x09-\x0D]"
REPORT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PARTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

# States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn. 0 and 3 may end.
_ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
_ENDS = ((0, 0), (3, 0), (1, 2), (2, 1))


def _inserted(state: int, n: int) -> tuple[int, list[str]]:
    """The state after ``n`` insertions and their lines."""
    lines = []
    for _ in range(n):
        lines.append(f"{_ROLE[state]}:")
        state = _NEXT[state]
    return state, lines


def _moves() -> dict[tuple[str, bool], list[tuple]]:
    """(role initial, must go) → (from, insertions, edit, to, cost, inserted lines, role given or None) of every edit of a row.

    An insertion before a deletion costs as much as one after it and comes
    later in ASCII, and three insertions are never cheaper than one: both are left out.
    """
    out = {}
    for initial in ("s", "u", "a", ""):
        deleted = [(f, 0, "D", f, DELETE, [], None) for f in range(4)]
        kept = []
        for f in range(4):
            for n in range(3):
                at, lines = _inserted(f, n)
                role = _ROLE[at]
                if initial == "s" and at == 0:
                    kept.append((f, n, "K", 1, KEEP + INSERT * n, lines, None))
                if initial == role[0]:
                    kept.append((f, n, "K", _NEXT[at], KEEP + INSERT * n, lines, None))
                else:
                    kept.append((f, n, "R", _NEXT[at], REROLE + INSERT * n, lines, role))
        out[initial, True] = deleted
        out[initial, False] = deleted + kept
    return out


_MOVES = _moves()
_LEGAL = {"su", "ua", "au"}
_CODE, _EDIT = {"D": 0, "K": 1, "R": 2}, "DKR"


class _Conversation:
    """The program's state after some rows of a conversation."""

    def __init__(self) -> None:
        self.cost: list[int | None] = [0, None, None, None]
        self.rank = [0, 0, 0, 0]  # order of the paths' edits, no two of which are equal or begin alike to an end
        self.digest = [hashlib.sha256(), None, None, None]
        self.back = SpooledTemporaryFile(max_size=SPOOL)
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.last: str | None = None
        self.turns = [None, None, 0]  # least, last, different

    def row(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.turns[1]:
            least, _, n = self.turns
            self.turns = [turn if least is None else least, turn, n + 1]
        initial = role[:1]
        if self.last is not None and self.last + initial not in _LEGAL:
            self.illegal += 1
        self.last = initial
        self.faults[fault] += 1
        extra = TRUNCATED if fault == CUT else 0
        best: list[tuple | None] = [None] * 4
        for move in _MOVES[initial if initial in ("s", "u", "a") else "", fault in (BLANK, DUPLICATE)]:
            f, n, edit, to, price = move[:5]
            if self.cost[f] is None:
                continue
            key = (self.cost[f] + price + (0 if edit == "D" else extra), self.rank[f], "I" * n + edit)
            if best[to] is None or key < best[to][0]:
                best[to] = (key, move)
        pointers, digests = bytearray(4), [None] * 4
        for to, found in enumerate(best):
            if found is None:
                continue
            f, n, edit, _, _, lines, given = found[1]
            pointers[to] = f | n << 2 | _CODE[edit] << 4
            digests[to] = self.digest[f]
            if edit != "D":
                said = "\n".join([*lines, f"{role if given is None else given}:{text}"])
                digests[to] = self.digest[f].copy()
                digests[to].update((said if f == 0 else "\n" + said).encode("utf-8", "surrogatepass"))
        self.back.write(pointers)
        self.digest = digests
        self.cost = [None if b is None else b[0][0] for b in best]
        for place, to in enumerate(sorted((t for t in range(4) if best[t]), key=lambda t: best[t][0][1:])):
            self.rank[to] = place

    def report(self) -> tuple:
        """PARTS of the whole conversation."""
        price, _, state, n = min((self.cost[s] + INSERT * n, self.rank[s], s, n) for s, n in _ENDS if self.cost[s] is not None)
        digest = self.digest[state].copy()
        digest.update("".join("\n" + line for line in _inserted(state, n)[1]).encode())
        audit = bytearray(b"I" * n)  # from the end
        end = self.back.tell()
        while end:
            start = max(0, end - (1 << 16))
            self.back.seek(start)
            block = self.back.read(end - start)
            for at in range(len(block) - 4, -1, -4):
                pointer = block[at + state]
                audit.append(ord(_EDIT[pointer >> 4]))
                audit.extend(b"I" * (pointer >> 2 & 3))
                state = pointer & 3
            end = start
        self.back.close()
        audit.reverse()
        least, most, n_turns = self.turns
        gaps = 0 if least is None else most - least + 1 - n_turns
        return (gaps, *self.faults[1:], self.illegal, price, audit.decode(), digest.hexdigest())


def _streamed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, now = None, None
    for frame in frames:
        out = []
        for k, turn, role, text, fault in zip(frame["key"], frame["turn"], frame["role"], frame["text"], frame["fault"]):
            if now is None or k != key:
                if now is not None:
                    out.append((key, *now.report()))
                key, now = k, _Conversation()
            now.row(None if turn is None else int(turn), role, text, fault)
        if out:
            yield pd.DataFrame(out, columns=["key", *PARTS])
    if now is not None:
        yield pd.DataFrame([(key, *now.report())], columns=["key", *PARTS])


def _named(value: Column) -> Column:
    """A value as text that null and every other value differ from."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def ordered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turn, role, text, fault), the rows of a conversation in one partition and in order.

    One shuffle: the search for repeated rows and the order by turn both sort inside the partitions.
    """
    read = lambda c: F.coalesce(turns[f"`{c}`"].cast("string"), F.lit(" "))
    rows = turns.select(_named(turns[f"`{conv}`"]).alias("key"), turns[f"`{turn}`"].cast("long").alias("turn"), read(role).alias("role"), read(text).alias("text"))
    same = Window.partitionBy("key", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    seen = rows.repartition("key").withColumn("seen", F.row_number().over(same))
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("seen") > 1, DUPLICATE)
             .when(~F.col("text").rlike(rf"[.!?]{SPACE}*\z"), CUT).otherwise(FINE))
    return seen.select("key", F.col("turn").cast("string").alias("turn"), "role", "text", fault.alias("fault"), F.col("turn").alias("at"), "seen").sortWithinPartitions(
        "key", F.col("at").asc_nulls_first(), "role", "text", "seen").drop("at", "seen")


def repair_report(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, and the cheapest repair.

    Rows go by turn (nulls first), rows of one turn by role and text. A row's
    first fault counts: blank (no character but white space), duplicate (role
    and text seen earlier), truncated (its last such character is not
    ``.``, ``!`` or ``?``). Edits make the role initials match ``(s?(ua)+)?``:
    Keep (0), Rerole to user or assistant (3), Delete (4; required for blank
    and duplicate rows), Insert an empty user or assistant turn (3); a
    truncated row that stays costs 3 more. ``audit`` has the initials of the
    cheapest edits in order, the ASCII-least of equally cheap ones, and
    ``repaired_sha256`` the digest of the repaired ``role:text`` lines.
    Null roles and texts are read as one space, null turns count for no gap,
    rows without a conversation are one conversation; an empty table has no
    rows; other columns are ignored.
    """
    report = ordered(turns, conv, turn, role, text).mapInPandas(_streamed, REPORT)
    kind = turns.schema[conv].dataType
    back = F.when(F.col("key") != "", F.substr("key", F.lit(2)).cast(kind)).cast(kind)
    return report.select(back.alias(conv), *PARTS)


def _applied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, audit, at, state, place = None, "", 0, 0, 0

    def step(edit: str, role: str, text: str) -> tuple:
        nonlocal state, place
        given = role if edit == "K" else _ROLE[state]
        state = 1 if edit == "K" and given[:1] == "s" else _NEXT[state]
        place += 1
        return (key, place, edit, given, text)

    def inserts() -> Iterator[tuple]:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            at += 1
            yield step("I", "", "")

    for frame in frames:
        out = []
        for k, edits, role, text in zip(frame["key"], frame["audit"], frame["role"], frame["text"]):
            if edits is not None:
                if key is not None:
                    out += inserts()
                key, audit, at, state, place = k, edits, 0, 0, 0
                continue
            out += inserts()
            edit, at = audit[at], at + 1
            if edit != "D":
                out.append(step(edit, role, text))
        yield pd.DataFrame(out, columns=["key", "place", "edit", "role", "text"])
    if key is not None:
        yield pd.DataFrame(list(inserts()), columns=["key", "place", "edit", "role", "text"])


def repaired_turns(turns: DataFrame, report: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, edit, role, text): the turns of every repaired conversation, from 1, by the audits of :func:`repair_report`.

    The rows are streamed once more, each conversation behind its audit. Conversations
    that the report lacks are not in the result; nulls and order as in the report.
    """
    read = lambda c: F.coalesce(turns[f"`{c}`"].cast("string"), F.lit(" "))
    rows = turns.select(_named(turns[f"`{conv}`"]).alias("key"), F.lit(None).cast("string").alias("audit"), turns[f"`{turn}`"].cast("long").alias("turn"),
                        read(role).alias("role"), read(text).alias("text"))
    first = report.select(_named(report[f"`{conv}`"]).alias("key"), "audit", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"))
    both = rows.unionByName(first).repartition("key").sortWithinPartitions("key", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text")
    said = both.mapInPandas(_applied, "key string, place long, edit string, role string, text string")
    kind = turns.schema[conv].dataType
    return said.select(F.when(F.col("key") != "", F.substr("key", F.lit(2)).cast(kind)).cast(kind).alias(conv), "place", "edit", "role", "text")
