"""Repairing the role structure of conversations by Knuth's lightest derivation.

A repair is a derivation: an item (i, state) stands for the cheapest way to go on from
row i when the roles written so far end in that state (none, s, u or a), and an edit
derives the item before it.  The axioms are the two ways to end, nothing at all and
after an answer; the goal is row 0 with nothing written.  Derivations are built from
the back, so an edit is put *before* the audit of what follows and cannot change how
two audits compare; every edit costs nothing or more.  Both make the functions
superior, so an agenda popped by (cost, rows taken, edit) finalises each item once, and
the first derivation of the goal is the lightest: least cost, then the ASCII-least
audit.  Rows taken stand before the edit, as keeping a row is free: at equal cost an
item may derive only items that have taken more rows, which are then still to come.

Rows are judged in Spark.  Each row travels to its conversation's task twice, first
without its text: a conversation is planned from its narrow rows, then its texts stream
by and are written as planned.  A task holds about 60 bytes a row of the conversation
it is at, whatever its texts are.  A conversation is one sequence and its digest is
sequential, so it is one task's work; conversations are dealt out by id.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from heapq import heappop, heappush
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
STOPS = [".", "!", "?"]
ROLES = ("system", "user", "assistant")

#: Of a row: nothing wrong, no text, a text without an end.
FINE, BLANK, TRUNCATED = 0, 1, 2

NONE, SYSTEM, USER, ASSISTANT = range(4)
LETTERS = ("", "s", "u", "a")
#: The states that a role may follow, by the state it leads to.
BEFORE = ((), (NONE,), (NONE, SYSTEM, ASSISTANT), (USER,))
#: What keeping, rewriting, deleting and inserting cost, and leaving a text truncated.
KEEP, REROLE, DELETE, INSERT, UNENDED = 0, 3, 4, 3, 3


class Row(NamedTuple):
    """What an edit depends on: the role's initial, and what is wrong with the row."""

    initial: str
    deleted: bool
    unended: bool


def lightest(rows: Sequence[Row]) -> tuple[int, str]:
    """Cost and audit (the edits' initials in order) of the lightest repair of ``rows``
    to roles ``(s?(ua)+)?``.  Rows with ``deleted`` must go; no rows need no edits."""
    n = len(rows)
    edits = bytearray(4 * (n + 1))  # of finalised items; 0: not yet
    costs = array("q", [-1]) * (4 * (n + 1))  # least so far
    agenda: list[tuple[int, int, int, int]] = []

    def derive(i: int, state: int, cost: int, edit: int) -> None:
        item = 4 * i + state
        if not edits[item] and (costs[item] < 0 or cost <= costs[item]):
            costs[item] = cost
            heappush(agenda, (cost, n - i, edit, state))

    for state in (NONE, ASSISTANT):
        derive(n, state, 0, ord("."))
    while not edits[NONE]:
        cost, taken, edit, state = heappop(agenda)
        i = n - taken
        if edits[4 * i + state]:
            continue
        edits[4 * i + state] = edit
        if state in (USER, ASSISTANT):
            for before in BEFORE[state]:
                derive(i, before, cost + INSERT, ord("I"))
        if not i:
            continue
        row = rows[i - 1]
        derive(i - 1, state, cost + DELETE, ord("D"))
        if row.deleted:
            continue
        left = UNENDED if row.unended else 0
        for before in BEFORE[state]:
            if row.initial == LETTERS[state]:
                derive(i - 1, before, cost + KEEP + left, ord("K"))
            if state != SYSTEM:
                derive(i - 1, before, cost + REROLE + left, ord("R"))
    return costs[NONE], _audit(rows, edits)


def _audit(rows: Sequence[Row], edits: bytearray) -> str:
    audit, i, state = bytearray(), 0, NONE
    while (edit := edits[4 * i + state]) != ord("."):
        audit.append(edit)
        if edit != ord("D"):
            state = SYSTEM if edit == ord("K") and rows[i].initial == "s" else ASSISTANT if state == USER else USER
        i += edit != ord("I")
    return audit.decode()


class Plan(NamedTuple):
    """What is wrong with a conversation, and its lightest repair."""

    gaps: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cost: int
    audit: str


def plan(rows: Iterator[tuple[int | None, str, int, bytes]]) -> Plan:
    """``rows`` in order: turn, initial of the role, fault, a digest of role and text."""
    own: list[Row] = []
    seen: set[bytes] = set()
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    illegal, turns, low, high, last = 0, 0, None, None, None
    for turn, initial, fault, key in rows:
        kind = "blank" if fault == BLANK else "duplicate" if key in seen else "truncated" if fault == TRUNCATED else None
        if kind:
            faults[kind] += 1
        seen.add(key)
        if own and own[-1].initial + initial not in ("su", "ua", "au"):
            illegal += 1
        if turn is not None and turn != high:
            low, high, turns = turn if low is None else low, turn, turns + 1
        own.append(_ROWS.setdefault(row := Row(initial, kind in ("blank", "duplicate"), kind == "truncated"), row))
    gaps = 0 if low is None else high - low + 1 - turns
    return Plan(gaps, *faults.values(), illegal, *lightest(own))


#: The few different rows there are, so that a plan holds one reference for each.
_ROWS: dict[Row, Row] = {}


def written(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of each row that the repair leaves; ``rows``: role and text
    of those there were."""
    state = NONE
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = SYSTEM if edit == "K" and role[:1] == "s" else ASSISTANT if state == USER else USER
        yield edit, role if edit == "K" else ROLES[state - 1], text
    for _ in rows:
        raise ValueError("the audit does not fit the rows")


def _digested(own: Plan, rows: Iterator[tuple[str, str]]) -> str:
    digest, glue = hashlib.sha256(), b""
    for _, role, text in written(own.audit, rows):
        digest.update(glue + f"{role}:{text}".encode())
        glue = b"\n"
    return digest.hexdigest()


PLANNED = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
#: Kinds of a row in its conversation's task, in the order they come in.
KNOWN, NARROW, TEXT = 0, 1, 2


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):  # as Python objects only so many
            part = batch.slice(start, 512)
            yield from zip(*(part.column(c).to_pylist() for c in part.schema.names))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Plan, Iterator[tuple[str, str]]]]:
    """Id, plan, and the rows' roles and texts, to be read before the next is asked for."""
    for conv, cells in groupby(_cells(batches), key=lambda cell: cell[0]):
        kinds = groupby(cells, key=lambda cell: cell[1])
        own, texts = None, iter(())
        for kind, rows in kinds:
            if kind == NARROW:
                own = plan((turn, initial, fault, key) for _, _, turn, key, initial, fault, _, _ in rows)
            elif kind == TEXT:
                texts = ((role, text) for *_, role, text in rows)
                break
        yield conv, own or plan(iter(())), texts
        for _ in texts:
            pass


def fault(text: Column) -> Column:
    """BLANK: nothing but white space; TRUNCATED: what comes last is no stop; or FINE."""
    rest = F.rtrim(text, F.lit(SPACES))
    return (
        F.when(rest == "", F.lit(BLANK))
        .when(~F.right(rest, F.lit(1)).isin(STOPS), F.lit(TRUNCATED))
        .otherwise(F.lit(FINE))
    )


def damage(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Rows with faults put in by a hash of conversation and turn: of twenty, one is
    dropped, one loses its text, one its ``.``, ``!`` and ``?``, one is repeated, one
    becomes the user's.  Nulls are one space, in the hash as in role and text."""

    def given(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    at = F.crc32(F.concat(given(conv_col), F.lit(":"), given(turn_col)).cast("binary")) % 20
    role, text = given(role_col), given(text_col)
    return (
        conversations.select(
            F.col(conv_col).alias("conv_id"),
            F.col(turn_col).cast("long").alias("turn"),
            F.when(at == 4, F.lit("user")).otherwise(role).alias("role"),
            F.when(at == 1, F.lit(""))
            .when(at == 2, F.translate(text, "".join(STOPS), ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(at == 0, 0).when(at == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def _dealt(
    rows: DataFrame, known: DataFrame | None, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """Rows in their conversations' tasks: known ids, narrow rows, then texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    base = rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.left(role, F.lit(1)).alias("initial"),
        fault(text).alias("fault"),
        role.alias("role"),
        text.alias("text"),
    )
    kinds = F.array(
        F.struct(F.lit(NARROW).alias("kind"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")),
        F.struct(F.lit(TEXT).alias("kind"), F.col("role"), F.col("text")),
    )
    cells = base.select("conv", "turn", "key", "initial", "fault", F.explode(kinds).alias("k")).select(
        "conv", "k.kind", "turn", "key", "initial", "fault", "k.role", "k.text"
    )
    if known is not None:
        ids = known.select(F.col(conv_col).alias("conv")).distinct()
        cells = ids.withColumn("kind", F.lit(KNOWN)).unionByName(cells, allowMissingColumns=True).select(*cells.columns)
    return cells.repartition("conv").sortWithinPartitions(
        F.asc_nulls_first("conv"), "kind", F.asc_nulls_first("turn"), "key"
    )


def _streamed(
    dealt: DataFrame, schema: str, rows: Callable[[object, Plan, Iterator[tuple[str, str]]], Iterator[tuple]], step: int
) -> DataFrame:
    kind = dealt.schema["conv"].dataType.simpleString()
    schema = f"conv_id {kind}, {schema}"
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"long": pa.int64(), "string": pa.string()}
        own = [pa.string() if kind == "string" else pa.int64() if kind == "bigint" else pa.int32()]
        own += [types[field.split()[1]] for field in schema.split(", ")[1:]]

        def batch(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), own)], names=names)

        held, size = [], 0
        for found in _conversations(batches):
            for row in rows(*found):
                held.append(row)
                size += sum(len(c) for c in row if isinstance(c, str))
                if len(held) >= step or size >= 1 << 22:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    return dealt.mapInArrow(run, schema)


def repair(
    rows: DataFrame,
    known: DataFrame | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: its faults, and the lightest repair.

    ``gaps`` counts turn numbers missing between the first and the last.  Of each row
    the first fault counts: ``blank`` (white space only), ``duplicate`` (role and text
    seen before), ``truncated`` (does not end in ``.``, ``!`` or ``?``).  ``illegal``
    counts neighbours whose roles' initials are not su, ua or au.  ``cost`` and
    ``audit`` are those of ``lightest``; ``repaired_sha256`` digests the repaired rows
    as ``role:text``, joined by newlines.

    Rows are ordered by turn, null first, and rows of one turn by a hash of role and
    text; repeated rows count.  Null role or text is one space, so it is blank or has
    no initial of a role.  A null id is a conversation of its own.  Conversations of
    ``known`` (ids in ``conv_col``) without rows are told of with zeros, an empty audit
    and the empty text's digest.  No rows and no known ids give no rows.
    """
    dealt = _dealt(rows, known, conv_col, turn_col, role_col, text_col)

    def row(conv: object, own: Plan, texts: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        yield (conv, *own, _digested(own, texts))

    found = _streamed(dealt, f"{PLANNED}, repaired_sha256 string", row, 2000)
    return found.withColumnRenamed("conv_id", conv_col)


def repaired(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The repaired conversations themselves: id, ``place`` (from 0), ``edit`` (K kept,
    R given another role, I inserted), ``role`` and ``text``.  Rows as in ``repair``."""
    dealt = _dealt(rows, None, conv_col, turn_col, role_col, text_col)

    def turns(conv: object, own: Plan, texts: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        for place, line in enumerate(written(own.audit, texts)):
            yield (conv, place, *line)

    found = _streamed(dealt, "place long, edit string, role string, text string", turns, 2000)
    return found.withColumnRenamed("conv_id", conv_col)
