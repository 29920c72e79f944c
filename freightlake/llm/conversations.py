"""Repair of conversations by weighted interval parsing.

A repaired conversation has role initials ``(s?(ua)+)?``. Its grammar, in Chomsky
normal form, has one nonterminal N(x, y) for what leads from state x to state y,
with the rules N(x, y) -> N(x, z) N(z, y) and terminal rules for the edits of one
row. The cell of a span and a nonterminal holds the least (cost, audit), where the
audit is the edits' initials in order and ties go to the least in ASCII. What is
inserted needs no row: the closure of insertions is part of the terminal rules,
before the edit, and is applied once more behind the last row.

Each derivation of a span passes through some state at any place of it, so one
split of a span gives its least cells. Spans are combined bottom-up by length:
rows to spans in the task that holds them, and spans of one conversation across
tasks, ``FAN`` at a time, so that no task need hold a long conversation. Audits of
a cell end with an edit of a row and are as many such edits as the span has rows;
none is the beginning of another, which keeps the order of audits when they are
put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common

# States: nothing yet, after the system's row, after a user's, after a whole pair.
START, SYSTEM, USER, PAIR = range(4)
STATES = range(4)
ENDS = (START, PAIR)
STEPS = {
    "s": ((START, SYSTEM),),
    "u": ((START, USER), (SYSTEM, USER), (PAIR, USER)),
    "a": ((USER, PAIR),),
}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
UNMENDED = 5  # a truncated row that is not deleted

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = ("su", "ua", "au")

# Spans of a conversation that are combined at a time, and rows of text a batch.
FAN = 16

Cells = dict[tuple[int, int], tuple[int, str]]

_BLANKS = " \t\n\x0b\x0c\r"


def combined(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two parts."""
    out: Cells = {}
    for (x, z), (cost, audit) in left.items():
        for y in STATES:
            if (other := right.get((z, y))) is not None:
                found = (cost + other[0], audit + other[1])
                if (x, y) not in out or found < out[x, y]:
                    out[x, y] = found
    return out


def _closure() -> Cells:
    """Cells of an empty span: nothing, or insertions of users and assistants."""
    step = {xy: (COST[INSERT], INSERT) for role in "ua" for xy in STEPS[role]}
    out: Cells = {(x, x): (0, "") for x in STATES}
    for _ in STATES:
        for key, cell in combined(out, step).items():
            out[key] = min(out.get(key, cell), cell)
    return out


CLOSURE = _closure()


def _edits(initial: str, fault: int) -> Cells:
    extra = UNMENDED if fault == TRUNCATED else 0
    out = {(x, x): (COST[DELETE], DELETE) for x in STATES}
    if fault in (BLANK, DUPLICATE):
        return out
    offered = [(role, COST[REROLE], REROLE) for role in "ua"]
    offered.append((initial, COST[KEEP], KEEP))
    for role, cost, name in offered:
        for xy in STEPS.get(role, ()):
            cell = (cost + extra, name)
            out[xy] = min(out.get(xy, cell), cell)
    return out


UNITS = {
    (initial, fault): combined(CLOSURE, _edits(initial, fault))
    for initial in ("s", "u", "a", "")
    for fault in (SOUND, BLANK, DUPLICATE, TRUNCATED)
}


def unit(initial: str, fault: int) -> Cells:
    """Cells of one row; initials other than s, u and a can't be kept."""
    return UNITS[initial if initial in STEPS else "", fault]


def repeated(cells: Cells, times: int) -> Cells:
    out: Cells | None = None
    while times:
        if times & 1:
            out = cells if out is None else combined(out, cells)
        cells = combined(cells, cells) if times > 1 else cells
        times >>= 1
    return out or {(x, x): (0, "") for x in STATES}


def parsed(spans: list[Cells]) -> Cells:
    """Cells of neighbouring spans together, bottom-up by span length."""
    while len(spans) > 1:
        pairs = zip(spans[::2], spans[1::2])
        spans = [combined(a, b) for a, b in pairs] + spans[len(spans) & ~1 :]
    return spans[0] if spans else {(x, x): (0, "") for x in STATES}


def cheapest(cells: Cells) -> tuple[int, str]:
    """Least cost and audit of a whole conversation."""
    whole = combined(cells, CLOSURE)
    return min(whole[START, end] for end in ENDS if (START, end) in whole)


class Span:
    """Neighbouring rows of a conversation: cells, counts, and what is at both ends."""

    FIELDS = ("distinct", "blank", "duplicate", "truncated", "illegal", "rows")

    def __init__(self, cells: Cells, counts: list[int], turns: tuple, roles: tuple) -> None:
        self.cells, self.counts, self.turns, self.roles = cells, counts, turns, roles

    @classmethod
    def of_rows(cls, rows: list[dict]) -> Span:
        """``rows`` that are equal in everything come as one, with their number ``n``."""
        units: list[Cells] = []
        counts = dict.fromkeys(cls.FIELDS, 0)
        turns: list[int] = []
        roles: list[str] = []
        for row in rows:
            if row["turn"] is not None and row["n"] and (not turns or turns[-1] != row["turn"]):
                turns.append(row["turn"])
            initial, fault, n = row["initial"], row["fault"], row["n"]
            if not n:
                continue
            # Of equal rows only the first can be no duplicate.
            rest = BLANK if fault == BLANK else DUPLICATE
            units.append(unit(initial, fault))
            if n > 1:
                units.append(repeated(unit(initial, rest), n - 1))
                counts["illegal"] += (n - 1) * (initial + initial not in LEGAL)
            for name, kind in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)):
                counts[name] += (fault == kind) + (n - 1) * (rest == kind)
            counts["illegal"] += bool(roles) and roles[-1] + initial not in LEGAL
            counts["rows"] += n
            roles.append(initial)
        counts["distinct"] = len(turns)
        return cls(
            parsed(units),
            list(counts.values()),
            (turns[0], turns[-1]) if turns else (None, None),
            (roles[0], roles[-1]) if roles else (None, None),
        )

    @classmethod
    def joined(cls, spans: list[Span]) -> Span:
        out = spans[0]
        for other in spans[1:]:
            counts = [a + b for a, b in zip(out.counts, other.counts)]
            met = out.turns[1] is not None and out.turns[1] == other.turns[0]
            counts[0] -= met
            both = out.roles[1] is not None and other.roles[0] is not None
            counts[4] += both and out.roles[1] + other.roles[0] not in LEGAL
            turns = [t for t in (*out.turns, *other.turns) if t is not None]
            roles = [r for r in (*out.roles, *other.roles) if r is not None]
            ends = [(x[0], x[-1]) if x else (None, None) for x in (turns, roles)]
            out = cls({}, counts, *ends)
        out.cells = parsed([s.cells for s in spans])
        return out

    def row(self) -> dict:
        cells = [{"x": x, "y": y, "cost": c, "audit": a} for (x, y), (c, a) in self.cells.items()]
        return {"cells": cells, "counts": self.counts, "turns": self.turns, "roles": self.roles}

    @classmethod
    def of_row(cls, row: dict) -> Span:
        cells = {(c["x"], c["y"]): (c["cost"], c["audit"]) for c in row["cells"]}
        return cls(cells, row["counts"], tuple(row["turns"]), tuple(row["roles"]))


SPAN = pa.struct(
    [
        (
            "cells",
            pa.list_(
                pa.struct(
                    [("x", pa.int32()), ("y", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]
                )
            ),
        ),
        ("counts", pa.list_(pa.int64())),
        ("turns", pa.list_(pa.int64())),
        ("roles", pa.list_(pa.string())),
    ]
)
SPAN_TYPE = (
    "struct<cells: array<struct<x: int, y: int, cost: bigint, audit: string>>, "
    "counts: array<bigint>, turns: array<bigint>, roles: array<string>>"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n``: rows after damage, ``n`` times each.

    What happens to a row follows from crc32(``conv_id:turn``) modulo 20, where a
    null is a blank: 0 drops it (``n`` is 0), 1 empties its text, 2 removes full
    stops, exclamation and question marks, 3 repeats it, 4 makes it the user's. A
    null role or text is a blank as well.
    """
    one = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), one),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), one),
    )
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", one).alias("role"),
        F.coalesce("text", one).alias("text"),
        (F.crc32(name) % 20).alias("kind"),
    )
    text = (
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("n"),
    )


def _text_fault(text: Column) -> Column:
    """Whether a text is blank or truncated, by its last character that is no blank."""
    last = F.substring(F.rtrim(text, F.lit(_BLANKS)), -1, 1)
    return (
        F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    )


def _elements(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, initial, fault, n``: rows without their texts.

    Equal rows are one, with their number. Whether an earlier row has the same role
    and text follows from the first turn of each, found by a partial aggregate.
    """
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        F.md5("text").alias("digest"),
        _text_fault(F.col("text")).alias("fault"),
        "n",
    )
    keys = ["conv_id", "turn", "role", "digest"]
    single = common.stored_once(
        narrow.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("fault").alias("fault")),
        "elements",
    )
    # A null turn comes before any other.
    order = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    first = (
        single.where("n > 0")
        .groupBy("conv_id", "role", "digest")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("places"))
        .where("places > 1")
        .select(F.struct("conv_id", "role", "digest").alias("what"), "first")
    )
    marked = single.withColumn("what", F.struct("conv_id", "role", "digest")).alias("l").join(
        first.alias("r"), F.col("l.what") == F.col("r.what"), "left"
    )
    again = (F.col("first").isNotNull()) & ~F.col("l.turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(
        (F.col("l.fault") != BLANK) & again, F.lit(DUPLICATE)
    ).otherwise(F.col("l.fault"))
    return marked.select(
        *[f"l.{k}" for k in keys],
        F.substring("l.role", 1, 1).alias("initial"),
        fault.alias("fault"),
        "l.n",
    )


def _spans(elements: DataFrame, parts: int) -> DataFrame:
    """``conv_id, part, span``: one for each conversation and task that has rows of it."""
    order = ["conv_id", "turn", "role", "digest"]
    kind = elements.schema["conv_id"].dataType.simpleString()
    # Sorted over all tasks; a long conversation has several of them.
    dealt = elements.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        type_of = None

        def rows_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([c for c, _ in done], type_of),
                    pa.array([part] * len(done), pa.int32()),
                    pa.array([s.row() for _, s in done], SPAN),
                ],
                ["conv_id", "part", "span"],
            )

        for batch in batches:
            type_of = batch.schema.field("conv_id").type
            for conv, rows in groupby(batch.to_pylist(), key=lambda r: r["conv_id"]):
                span = Span.of_rows(list(rows))
                if held and held[-1][0] == conv:
                    span = Span.joined([held.pop()[1], span])
                held.append((conv, span))
            # The last conversation may go on in the next batch.
            if len(held) > 1:
                yield rows_of(held[:-1])
                held = held[-1:]
        if held:
            yield rows_of(held)

    columns = dealt.select("conv_id", "turn", "initial", "fault", "n")
    return common.map_arrow(columns, run, f"conv_id {kind}, part int, span {SPAN_TYPE}")


def _merged(spans: DataFrame, parts: int) -> DataFrame:
    """``conv_id, span``: spans of each conversation put together, ``FAN`` at a time."""
    kind = spans.schema["conv_id"].dataType.simpleString()

    def join(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        span = Span.joined([Span.of_row(r["span"]) for r in rows])
        return pa.table(
            {
                "conv_id": table.column("conv_id").slice(0, 1),
                "part": pa.array([rows[0]["slot"]], pa.int32()),
                "span": pa.array([span.row()], SPAN),
            }
        )

    while parts > 1:
        parts = -(-parts // FAN)
        slot = F.floor(F.col("part") / FAN).cast("int")
        grouped = spans.withColumn("slot", slot).withColumn("name", F.struct("conv_id", "slot"))
        # Conversations of a single span, nearly all, are left as they are.
        several = grouped.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        several = common.stored_once(several.select("name"), "several")
        alone = grouped.join(several, "name", "left_anti").select(
            "conv_id", F.col("slot").alias("part"), "span"
        )
        crowd = grouped.join(several, "name", "left_semi").drop("name")
        put = crowd.groupBy("conv_id", "slot").applyInArrow(
            join, f"conv_id {kind}, part int, span {SPAN_TYPE}"
        )
        spans = common.stored_once(alone.unionByName(put), "spans")
    return spans.select("conv_id", "span")


REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string"
)


def _reports(spans: DataFrame) -> DataFrame:
    kind = spans.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column("span").to_pylist():
                span = Span.of_row(row)
                distinct, blank, duplicate, truncated, illegal, rows = span.counts
                first, last = span.turns
                gaps = 0 if first is None else last - first + 1 - distinct
                cost, audit = cheapest(span.cells) if rows else (0, "")
                out.append((gaps, blank, duplicate, truncated, illegal, cost, audit))
            columns = list(zip(*out)) or [()] * 7
            kinds = [pa.int64()] * 6 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *map(pa.array, columns, kinds)],
                ["conv_id", *(c.split()[0] for c in REPORT.split(", "))],
            )

    return common.map_arrow(spans, run, f"conv_id {kind}, {REPORT}")


class Mending:
    """The repaired lines of a conversation, from its audit and its rows in turn."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _placed(self, role: str | None) -> str:
        """The role of the next line; without a given one what the pattern asks for."""
        asked = "assistant" if self.state == USER else "user"
        role = asked if role is None else role
        self.state = dict(STEPS[role[:1]])[self.state]
        return role

    def inserted(self) -> list[tuple[str, str]]:
        out = []
        while self.audit[self.at : self.at + 1] == INSERT:
            out.append((self._placed(None), ""))
            self.at += 1
        return out

    def lines(self, role: str, text: str) -> list[tuple[str, str]]:
        """Lines that a row gives: what is inserted before it, and itself unless deleted."""
        out = self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            out.append((self._placed(role), text))
        elif edit == REROLE:
            out.append((self._placed(None), text))
        return out


def _hashed(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Reports with ``repaired_sha256``, from the rows of each conversation in turn.

    A hash of the whole text has to see it in order. Rows pass through one by one,
    so a long conversation takes time in its task, but no memory beyond its audit.
    """
    empty = "CAST(NULL AS {}) AS {}"
    report = [c.split() for c in REPORT.split(", ")]
    order = ["conv_id", "is_row", "turn", "role", "digest"]
    texts = rows.where("n > 0").selectExpr(
        "conv_id", "true AS is_row", "turn", "role", "md5(text) AS digest", "text", "n",
        *[empty.format(kind, name) for name, kind in report],
    )
    heads = reports.selectExpr(
        "conv_id", "false AS is_row", "CAST(NULL AS bigint) AS turn",
        *[empty.format("string", c) for c in ("role", "digest", "text")],
        "CAST(NULL AS bigint) AS n",
        *[name for name, _ in report],
    )
    both = heads.unionByName(texts.withColumn("n", F.col("n").cast("long")))
    streams = both.repartition(F.col("conv_id")).sortWithinPartitions(*order).drop("digest")
    names = [name for name, _ in report]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: dict | None = None
        type_of = None
        done: list[dict] = []

        def close() -> None:
            if head is not None:
                write(mending.inserted())
                done.append(head | {"repaired_sha256": digest.hexdigest()})

        def write(lines: list[tuple[str, str]]) -> None:
            nonlocal written
            for role, text in lines:
                digest.update(f"{chr(10) * written}{role}:{text}".encode())
                written = True

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array([r["conv_id"] for r in done], type_of)]
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            for name, kind in zip([*names, "repaired_sha256"], kinds):
                columns.append(pa.array([r[name] for r in done], kind))
            return pa.RecordBatch.from_arrays(columns, ["conv_id", *names, "repaired_sha256"])

        for part in (p for b in batches for p in common.slices(b, "text", 1 << 21)):
            type_of = part.schema.field("conv_id").type
            for row in part.to_pylist():
                if not row["is_row"]:
                    close()
                    head, mending = row, Mending(row["audit"])
                    digest, written = hashlib.sha256(), False
                    continue
                for _ in range(row["n"]):
                    write(mending.lines(row["role"], row["text"]))
            if done:
                yield batch_of()
                done = []
        close()
        if done:
            yield batch_of()

    kind = rows.schema["conv_id"].dataType.simpleString()
    return common.map_arrow(streams, run, f"conv_id {kind}, {REPORT}, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Faults of every conversation, its cheapest repair, and a hash of the result.

    ``rows`` has ``conv_id, turn, role, text`` and ``n``, how often a row is there;
    roles and texts are not null. A conversation whose rows all have ``n`` 0 has
    zeros, an empty audit and the hash of nothing. Rows go by turn, null ones first,
    and within a turn by role and digest of the text, so equal rows are next to each
    other. A null ``conv_id`` names a conversation like any other.

    The first fault of a row counts: blank, the same role and text as an earlier
    row, or truncated, that is without a full stop, exclamation or question mark at
    its end. Keeping a row costs nothing, another role 1, deletion 2, which blank
    and duplicate rows need, an inserted row 5, and a truncated row that stays 5
    more. A row whose role is empty, or begins with none of s, u and a, can't be kept
    as it is. ``illegal`` counts neighbours whose initials are not su, ua or au, and
    ``gaps`` the turns that are missing between the first and the last one.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    elements = common.stored_once(_elements(rows), "faults")
    spans = common.stored_once(_spans(elements, parts), "spans")
    reports = common.stored_once(_reports(_merged(spans, parts)), "reports")
    return _hashed(rows, reports)
