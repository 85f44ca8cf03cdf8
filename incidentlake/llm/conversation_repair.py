"""Conversation structure repair by weighted interval parsing (CYK) with a repair grammar in Chomsky normal form.

Roles must read ``(s?(ua)+)?`` by their initials. Nonterminals ``X[p,q]`` stand for spans of rows that lead the automaton of that
language from state p to state q after repair; the grammar is

    X[p,q] -> X[p,r] X[r,q]                      for all states r
    X[p,q] -> row                                kept, given another role, or deleted, at its cost
    X[p,q] -> I[p,r] X[r,s] I[s,q]               insertion closure, I[p,q] being the cheapest insertions from p to q

A cell of a span holds for each X[p,q] the least (cost, audit), audit being the initials of the edits. Cells are combined bottom-up by
span length: 1, 2, 4, ... rows. The nonterminals are pairs of states, so every split of a span derives the same repairs and one is enough:
n - 1 combinations instead of a cubic number. Least pairs of parts make the least pair of the whole: costs are sums that the audit
fixes, so of two audits of a span with equal cost none is the beginning of the other.

At scale rows are dealt out in ranges of (conversation, turn, role, text), so a conversation with a third of all rows is many spans in
many tasks, each of SEGMENT rows at most. A conversation that lies in one span ends there. Cells of the others are combined afterwards, and their
rows stream once more through the hash of the repaired text, which can only be taken in order.
Rows seen earlier are found by a digest (128 bits) of conversation, role and text, counted in the tasks before the shuffle.

Defined cases: null roles and texts are one space, as is a null id or turn in the damage key; null conversation ids are one
conversation; rows without a turn come first; rows of equal turn are taken by role, then text; equal rows stay next to each other; an
empty role has no initial, so its row is not kept as it is; an empty table gives no rows; a
conversation whose rows are all dropped has an empty audit; texts are whole at any length; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.taskcontext import TaskContext

from .common import BROADCAST_KEYS, cut, rename, ship

#: States: nothing yet, after s, after u, after a. Steps of the automaton by role initial.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
STATES = range(len(STEPS))
ROLES = {"u": "user", "a": "assistant"}
#: Rows and characters of a span that a task holds.
SEGMENT, SEGMENT_CHARS = 1024, 4 << 20
BLANKS = " \t\n\r\x0b\x0c"
LEGAL = {"su", "ua", "au"}
Cell = list[list[tuple[int, str] | None]]

_SEGMENT_TYPE = (
    "part int, number bigint, whole boolean, n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
    " first_role string, last_role string, first_turn bigint, last_turn bigint, n_turns bigint, audit string, cost bigint,"
    " repaired_sha256 string, cell array<struct<p:int,q:int,cost:bigint,audit:string>>")
_RESULT_TYPE = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def combined(left: Cell, right: Cell) -> Cell:
    """X[p,q] -> X[p,r] X[r,q], the least of all r."""
    out: Cell = []
    for row in left:
        made: list[tuple[int, str] | None] = [None] * len(STEPS)
        for r, a in enumerate(row):
            if a is None:
                continue
            for q, b in enumerate(right[r]):
                if b is not None and ((best := made[q]) is None or a[0] + b[0] <= best[0]):
                    pair = a[0] + b[0], a[1] + b[1]
                    if best is None or pair < best:
                        made[q] = pair
        out.append(made)
    return out


@cache
def insertions() -> Cell:
    """The cheapest insertions between two states; none is the cell of a span without rows."""
    def one(p: int, q: int) -> tuple[int, str] | None:
        return (0, "") if p == q else (INSERT, "I") if any(STEPS[p].get(x) == q for x in ROLES) else None
    cell = [[one(p, q) for q in STATES] for p in STATES]
    for _ in STATES:
        cell = combined(cell, cell)
    return cell


@cache
def terminal(initial: str, gone: bool, truncated: bool) -> Cell:
    """The cell of one row, closed under insertions around it."""
    def one(p: int, q: int) -> tuple[int, str] | None:
        ways = [(DELETE, "D")] if p == q else []
        if not gone:
            ways += [(TRUNCATED * truncated, "K")] * (STEPS[p].get(initial) == q)
            ways += [(REROLE + TRUNCATED * truncated, "R")] * any(STEPS[p].get(x) == q for x in ROLES)
        return min(ways, default=None)
    return combined(combined(insertions(), [[one(p, q) for q in STATES] for p in STATES]), insertions())


def parsed(cells: list[Cell]) -> Cell:
    """The cell of the whole span from cells of its parts in order."""
    if not cells:
        return insertions()
    while len(cells) > 1:
        cells = [combined(*pair) if len(pair) == 2 else pair[0] for pair in (cells[k:k + 2] for k in range(0, len(cells), 2))]
    return cells[0]


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) from the first state to a final one."""
    return min(x for q in FINAL if (x := cell[0][q]) is not None)


class Repair:
    """Applies an audit to rows in order; gives the lines of the repaired conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.lines = audit, 0, 0, hashlib.sha256(), 0

    def _line(self, role: str, text: str, initial: str) -> None:
        self.digest.update(("\n" * bool(self.lines) + f"{role}:{text}").encode())
        self.lines += 1
        self.state = STEPS[self.state][initial]

    def inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            wanted = "a" if self.state == 2 else "u"
            self._line(ROLES[wanted], "", wanted)

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._line(role, text, role[:1])
        elif edit == "R":
            wanted = "a" if self.state == 2 else "u"
            self._line(ROLES[wanted], text, wanted)

    def sha256(self) -> str:
        self.inserted()
        return self.digest.hexdigest()


class Segment:
    """Consecutive rows of one conversation: counts, and cells until the span is parsed."""

    def __init__(self, key: object):
        self.key, self.rows, self.cells, self.chars, self.audit = key, [], [], 0, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = 0
        self.first_turn = self.last_turn = self.previous = None

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        for copy in range(copies):
            again = copy > 0 or seen
            ended = text.rstrip(BLANKS)[-1:]
            self.blank += not ended
            self.duplicate += bool(ended) and again
            gone = not ended or again
            truncated = not gone and ended not in ".!?"
            self.truncated += truncated
            if self.rows:
                self.illegal += self.rows[-1][0][:1] + role[:1] not in LEGAL
            initial = role[:1]
            self.cells.append(terminal(initial if initial in STEPS[0] or initial in ROLES else "", gone, truncated))
            self.rows.append((role, text))
            self.chars += len(text)
        if copies and turn is not None and turn != self.last_turn:
            self.n_turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def full(self, limit: int) -> bool:
        return len(self.rows) >= limit or self.chars >= SEGMENT_CHARS

    def sent(self, part: int, number: int, whole: bool) -> dict:
        cell = parsed(self.cells)
        out = {
            "part": part, "number": number, "whole": whole, "n": len(self.rows), "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "first_role": self.rows[0][0][:1] if self.rows else None,
            "last_role": self.rows[-1][0][:1] if self.rows else None, "first_turn": self.first_turn, "last_turn": self.last_turn, "n_turns": self.n_turns}
        if whole:
            out["cost"], out["audit"] = cheapest(cell)
            repair = Repair(out["audit"])
            for role, text in self.rows:
                repair.row(role, text)
            out["repaired_sha256"] = repair.sha256()
        else:
            out["cell"] = [{"p": p, "q": q, "cost": x[0], "audit": x[1]} for p, row in enumerate(cell) for q, x in enumerate(row) if x is not None]
        return out


def damage_key(conv: str = "conv", turn: str = "turn", parts: int = 20) -> Column:
    return F.expr(f"crc32(concat(coalesce(cast({conv} as string), ' '), ':', coalesce(cast({turn} as string), ' '))) % {parts}")


def damaged(rows: DataFrame, damage: Column | None = None) -> DataFrame:
    """conv, turn, role, text, copies (0: dropped, 2: repeated) of rows by the kind of their damage (null: none)."""
    kind = F.lit(None).cast("bigint") if damage is None else damage
    kept = rows.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind"))
    return kept.selectExpr(
        "conv", "turn", "if(kind = 4, 'user', role) as role",
        "case when kind = 0 or kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text",
        "case when kind = 0 then 0 when kind = 3 then 2 else 1 end as copies")


def _checked(df: DataFrame) -> DataFrame:
    df = cut(df)
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def _flagged(rows: DataFrame) -> DataFrame:
    """Adds key and first turn of texts that several rows of a conversation have; adjacent equal rows are left to the task."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("-"))
    key = F.unhex(F.md5(F.concat(F.length(conv), F.lit(":"), conv, F.length("role"), F.lit(":"), "role", "text")))
    keyed = rows.filter(r"copies > 0 and text rlike '[^\\x20\\x09-\\x0D]'").select(key.alias("key"), "turn")
    several = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("turn")).alias("first")).filter("n > 1").select("key", "first")
    marked = rows.withColumn("key", key).join(_checked(several), "key", "left")
    return marked.selectExpr("conv", "turn", "role", "text", "copies", "coalesce(struct(turn) > first and copies > 0, false) as seen")


def _segments(rows: DataFrame, conv_type: str, limit: int) -> DataFrame:
    names = [x.split(" ")[0] for x in _SEGMENT_TYPE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        now: Segment | None = None
        began, before, kind = False, None, None  # whether an earlier span of the conversation may exist; the row before
        out: list[dict] = []

        def close(last: bool) -> None:
            nonlocal number
            out.append({"conv": now.key, **now.sent(part, number, not began and not last)})
            number += 1

        def batch_of() -> pa.RecordBatch:
            made = pa.array([{k: row.get(k) for k in ("conv", *names)} for row in out], kind)
            out.clear()
            return pa.RecordBatch.from_struct_array(made)

        first = True
        for batch in batches:
            kind = kind or _arrow_type(batch.schema.field(0).type)
            for conv, turn, role, text, copies, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.key:
                    if now is not None:
                        close(last=False)
                    now, began, before, first = Segment(conv), first, None, False
                elif now.full(limit):
                    close(last=True)
                    now, began = Segment(conv), True
                row = (turn, role, text)
                now.add(turn, role, text, copies, seen or copies > 0 and row == before)
                before = row if copies > 0 else before
                if len(out) >= 256:
                    yield batch_of()
        if now is not None:
            close(last=True)
        if out:
            yield batch_of()

    return rows.mapInArrow(run, f"conv {conv_type}, {_SEGMENT_TYPE}")


def _arrow_type(conv: pa.DataType) -> pa.StructType:
    cell = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    types = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [x.split(" ", 1) for x in _SEGMENT_TYPE.split(", ")]
    return pa.struct([("conv", conv), *[(name, types.get(kind, cell)) for name, kind in fields]])


class Joined:
    """Spans of one conversation in order: their counts added up and their cells parsed."""

    def __init__(self) -> None:
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "n_turns"), 0)
        self.cells: list[Cell] = []
        self.last_role = self.first_turn = self.last_turn = None

    def add(self, row: dict) -> None:
        for k in self.sums:
            self.sums[k] += row[k]
        cell: Cell = [[None for _ in STATES] for _ in STATES]
        for x in row["cell"]:
            cell[x["p"]][x["q"]] = x["cost"], x["audit"]
        self.cells.append(cell)
        if row["n"]:
            self.sums["illegal"] += self.last_role is not None and self.last_role + row["first_role"] not in LEGAL
            self.last_role = row["last_role"]
        if row["n_turns"]:
            self.sums["n_turns"] -= self.last_turn == row["first_turn"]
            self.first_turn = row["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = row["last_turn"]

    def result(self) -> dict:
        cost, audit = cheapest(parsed(self.cells))
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.sums["n_turns"]
        return {**self.sums, "gaps": gaps, "cost": cost, "audit": audit}


def _ended(spans: DataFrame, rows: DataFrame, conv_type: str) -> DataFrame:
    """Results of conversations that lie in several spans."""
    names = [x.split(" ")[0] for x in _RESULT_TYPE.split(", ")]
    nothing = {"turn": "bigint", "role": "string", "text": "string", "copies": "int"}

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if now is None or row["conv"] != key:
                    if now is not None:
                        out.append({"conv": key, "r": now.result()})
                    key, now = row["conv"], Joined()
                now.add(row)
            yield records(out, batch)
        if now is not None:
            yield records([{"conv": key, "r": now.result()}], batch)

    result = pa.struct([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names])

    def records(out: list[dict], batch: pa.RecordBatch) -> pa.RecordBatch:
        kind = pa.struct([("conv", batch.schema.field("conv").type), ("r", result)])
        return pa.RecordBatch.from_struct_array(pa.array(out, kind))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, repair = None, None
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                if x["r"] is not None:  # the result comes before the rows
                    if row is not None:
                        row["r"]["repaired_sha256"] = repair.sha256()
                        out.append(row)
                    row, repair = {"conv": x["conv"], "r": x["r"]}, Repair(x["r"]["audit"])
                else:
                    for _ in range(x["copies"]):
                        repair.row(x["role"], x["text"])
            yield records(out, batch)
        if row is not None:
            row["r"]["repaired_sha256"] = repair.sha256()
            yield records([row], batch)

    schema = f"conv {conv_type}, r struct<{_RESULT_TYPE}>"
    ordered = spans.repartition("conv").sortWithinPartitions("conv", "part", "number")
    heads = ordered.mapInArrow(joined, schema)
    ids = _checked(spans.select(F.col("conv").alias("wanted")).distinct())
    texts = rows.join(ids, rows["conv"].eqNullSafe(ids["wanted"]), "left_semi").select("conv", "turn", "role", "text", "copies", F.lit(None).cast(f"struct<{_RESULT_TYPE}>").alias("r"))
    both = texts.unionByName(heads.select("conv", *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()], "r"))
    stream = both.repartition("conv").sortWithinPartitions("conv", F.col("r").isNull(), "turn", "role", "text")
    return stream.mapInArrow(hashed, schema).select("conv", "r.*")


def repair_conversations(turns: DataFrame, damage: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """Counts, cost, audit and a digest of the repaired text of every conversation.

    ``damage`` is an expression over conv and turn for the kind of a row's damage: 0 drops it, 1 empties its text, 2 removes its
    sentence ends, 3 repeats it, 4 makes it the user's; anything else leaves it. ``segment`` is the number of rows of a span; results do not depend on it.
    """
    ship(turns.sparkSession)
    rows = damaged(rename(turns, conv=conv_col, turn=turn_col, role=role_col, text=text_col).withColumn("turn", F.col("turn").cast("bigint")), damage)
    conv_type = rows.schema["conv"].dataType.simpleString()
    flagged = _flagged(rows).repartitionByRange("conv", "turn", "role", "text").sortWithinPartitions("conv", "turn", "role", "text")
    spans = cut(_segments(flagged, conv_type, segment))
    gaps = F.expr("coalesce(last_turn - first_turn + 1 - n_turns, 0)").alias("gaps")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    done = spans.filter("whole").select("conv", gaps, *counts)
    return done.unionByName(_ended(spans.filter("not whole"), rows, conv_type).select("conv", "gaps", *counts)).withColumnRenamed("conv", conv_col)
