"""Conversations repaired by weighted interval parsing.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. Keeping a row costs nothing, a
new role (user or assistant) 2, deleting a row 3, an empty row put in 2; a truncated row that is not
deleted adds 1; blank and repeated rows must be deleted. Sought are the cheapest edits, and of those the
ones whose initials (D, I, K, R) in order come first.

**Grammar.** In Chomsky normal form its symbols are the fragments of good conversations, named by their
first and last role: `E` for nothing, `s`, `uu`, `ua`, `au`, `aa`, `su`, `sa`. Two neighbouring
fragments join where the last role of one may come before the first role of the other. A row
derives the fragments that its edits leave; what can be put in derives fragments over empty spans, and a
cell is closed under joining those (`_closed`).

**Cells.** A cell holds the least (cost, initials) of every fragment over a span. Equally cheap initials of
one fragment over one span are never a beginning of each other, since what follows would cost more; so
least parts give least wholes. Rows are parsed in blocks, shorter spans first; cells of blocks join in
pairs in the same way, then those of the runs into which a long conversation is dealt out. A conversation
may hold any share of the rows: rows are dealt out by ranges of (conversation, turn), and only one cell for
each run moves on. Reading the repaired rows in order (`repaired`, `digests`) streams through a conversation.

**Rows.** Null roles and texts stand for one space. Rows are read by turn, nulls first, ties by role and text;
rows of null conv_id are one conversation. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import product
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from marketlake.llm.shipping import ship
from marketlake.llm.stored import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows parsed together, and how many different blocks a task remembers.
BLOCK = 12
REMEMBERED = 20_000

#: White space of the contract, for trimming.
BLANKS = " \t\n\x0b\x0c\r"
_WIDEST = (1 << 63) - 1

FRAGMENTS = ("E", "s", "uu", "ua", "au", "aa", "su", "sa")
_AT = {name: n for n, name in enumerate(FRAGMENTS)}
#: Roles that may stand beside each other.
FOLLOW = {("s", "u"), ("u", "a"), ("a", "u")}

Cell = list[tuple[int, str] | None]


def _joins() -> list[tuple[int, int, int]]:
    """Every rule of the grammar: left, right, whole."""
    rules = []
    for left, right in product(FRAGMENTS, repeat=2):
        if left == "E" or right == "E":
            rules.append((left, right, right if left == "E" else left))
        elif (left[-1], right[0]) in FOLLOW:
            rules.append((left, right, left[0] + right[-1]))
    return [(_AT[a], _AT[b], _AT[c]) for a, b, c in rules if c in _AT]


JOINS = _joins()


def _best(cell: Cell, at: int, found: tuple[int, str]) -> bool:
    known = cell[at]
    if known is None or found < known:
        cell[at] = found
        return True
    return False


def _join_into(out: Cell, left: Cell, right: Cell) -> bool:
    changed = False
    for a, b, c in JOINS:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            cost = x[0] + y[0]
            known = out[c]
            if known is None or cost <= known[0]:
                changed |= _best(out, c, (cost, x[1] + y[1]))
    return changed


def _cell(**known: tuple[int, str]) -> Cell:
    return [known.get(name) for name in FRAGMENTS]


#: What can be put into an empty span, one symbol at a time.
INSERTED = _cell(uu=(INSERT, "I"), aa=(INSERT, "I"))


def _closed(cell: Cell) -> Cell:
    """The cell with all that joins with rows put in before or after it."""
    changed = True
    while changed:
        now = cell.copy()
        changed = _join_into(cell, now, INSERTED)
        changed |= _join_into(cell, INSERTED, now)
    return cell


EMPTY = _closed(_cell(E=(0, "")))


def _row_cell(code: str) -> Cell:
    """The cell of one row: `-` must go; other letters are the role's initial, upper case when truncated."""
    cell = _cell(E=(DELETE, "D"))
    if code != "-":
        extra, initial = TRUNCATED * code.isupper(), code.lower()
        for role in "ua":
            kept = (KEEP + extra, "K") if initial == role else (REROLE + extra, "R")
            cell[_AT[role * 2]] = kept
        if initial == "s":
            cell[_AT["s"]] = (KEEP + extra, "K")
    return _closed(cell)


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans, both closed."""
    out: Cell = [None] * len(FRAGMENTS)
    _join_into(out, left, right)
    return _closed(out)


def parse(codes: str) -> Cell:
    """The cell over a block of rows: all spans, shorter ones first, each from all its cuts."""
    n = len(codes)
    if not n:
        return EMPTY
    cells = {(i, i + 1): _row_cell(code) for i, code in enumerate(codes)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            out: Cell = [None] * len(FRAGMENTS)
            for k in range(i + 1, i + size):
                _join_into(out, cells[i, k], cells[k, i + size])
            cells[i, i + size] = _closed(out)
    return cells[0, n]


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and initials of the best repair to a good conversation."""
    return min(cell[_AT[name]] for name in ("E", "ua", "sa") if cell[_AT[name]] is not None)


class _Parser:
    """Parses rows as they come: full blocks, then pairs of equally many blocks."""

    def __init__(self) -> None:
        self.known: dict[str, Cell] = {}
        self.reset()

    def reset(self) -> None:
        self.codes: list[str] = []
        self.spans: list[tuple[int, Cell]] = []

    def add(self, code: str) -> None:
        self.codes.append(code)
        if len(self.codes) == BLOCK:
            self._close_block()

    def _close_block(self) -> None:
        codes = "".join(self.codes)
        self.codes = []
        cell = self.known.get(codes)
        if cell is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            cell = self.known[codes] = parse(codes)
        size = 1
        while self.spans and self.spans[-1][0] <= size:
            before, left = self.spans.pop()
            size, cell = size + before, joined(left, cell)
        self.spans.append((size, cell))

    def cell(self) -> Cell:
        if self.codes:
            self._close_block()
        out = EMPTY
        for n, (_, cell) in enumerate(self.spans):
            out = joined(out, cell) if n else cell
        self.reset()
        return out


class _Run(NamedTuple):
    """What is known of neighbouring rows of one conversation; turns leave nulls out."""

    rows: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str
    last: str
    low: int | None
    high: int | None
    turns: int
    cell: Cell

    def join(self, right: _Run) -> _Run:
        illegal = self.illegal + right.illegal + ((self.last, right.first) not in FOLLOW)
        shared = self.high is not None and self.high == right.low
        return _Run(
            self.rows + right.rows,
            self.blank + right.blank,
            self.duplicate + right.duplicate,
            self.truncated + right.truncated,
            illegal,
            self.first,
            right.last,
            self.low if self.low is not None else right.low,
            right.high if right.high is not None else self.high,
            self.turns + right.turns - shared,
            joined(self.cell, right.cell),
        )


_COUNTS = "rows long, blank long, duplicate long, truncated long, illegal long"
_RUN = f"part int, {_COUNTS}, first string, last string, low long, high long, turns long, cell array<struct<cost: long, audit: string>>"
_ANSWER = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _ddl(ddl: str, conv: StructField) -> StructType:
    return StructType([conv, *StructType.fromDDL(ddl).fields])


def _runs(rows: Iterator[tuple], part: int) -> Iterator[tuple]:
    """Sorted (conv, turn, role, digest, initial, fault, repeated) -> one row for each conversation here."""
    parser = _Parser()
    begun, conv, before, last, run = False, None, None, "", [0] * 10

    def finished() -> tuple:
        n, blank, duplicate, truncated, illegal, first, low, high, turns = run
        return (conv, part, n, blank, duplicate, truncated, illegal, first, last, low, high, turns, [e and {"cost": e[0], "audit": e[1]} for e in parser.cell()])

    for key, turn, role, digest, initial, fault, repeated in rows:
        if not begun or key != conv:
            if begun:
                yield finished()
            begun, conv, before = True, key, None
            run = [0, 0, 0, 0, 0, initial, turn, turn, 0]
        elif (last, initial) not in FOLLOW:
            run[4] += 1
        if turn is not None and turn != run[7] or not run[8] and turn is not None:
            run[8] += 1
            run[7] = turn
            run[6] = turn if run[6] is None else run[6]
        again = repeated or before == (turn, role, digest)
        code = initial if initial in FOLLOW_ROLES else "x"
        run[0] += 1
        if fault == "blank":
            run[1] += 1
            code = "-"
        elif again:
            run[2] += 1
            code = "-"
        elif fault == "truncated":
            run[3] += 1
            code = code.upper()
        parser.add(code)
        before, last = (turn, role, digest), initial
    if begun:
        yield finished()


FOLLOW_ROLES = frozenset("sua")


def _answers(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Runs in order -> one row for each conversation."""

    def answer(run: _Run) -> tuple:
        cost, audit = cheapest(run.cell)
        gaps = 0 if run.low is None else min(run.high - run.low + 1 - run.turns, _WIDEST)
        return (conv, gaps, run.blank, run.duplicate, run.truncated, run.illegal, cost, audit)

    conv, whole = None, None
    for key, _, *values, cells in rows:
        run = _Run(*values, [e and (e["cost"], e["audit"]) for e in cells])
        if whole is not None and key == conv:
            whole = whole.join(run)
            continue
        if whole is not None:
            yield answer(whole)
        conv, whole = key, run
    if whole is not None:
        yield answer(whole)


def _prepared(turns: DataFrame) -> DataFrame:
    """Rows with the order they are read in; nulls as one space."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.md5(text)).alias("digest"),
    )


_ORDER = ("turn", "role", "digest")


def repairs(turns: DataFrame) -> DataFrame:
    """For each conversation: gaps, counts of faults, and the cost and initials of its cheapest repair.

    `turns` has conv_id, turn, role and text. Texts stay where they are: a row is its role's initial, its fault and
    a digest of its text. Rows that say what an earlier one said are found by a count with partial sums.
    """
    ship(turns.sparkSession)
    trimmed = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(trimmed == "", "blank").when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
    rows = _prepared(turns).select(
        "conv_id", *_ORDER, F.substring("role", 1, 1).alias("initial"), F.coalesce(fault, F.lit("")).alias("fault")
    )
    said = rows.groupBy("conv_id", "role", "digest").agg(
        F.count(F.lit(1)).alias("times"), F.count("turn").alias("dated"), F.min("turn").alias("low")
    )
    first = F.when(F.col("times") == F.col("dated"), F.col("low"))
    twice = said.where("times > 1").select(
        F.col("conv_id").alias("r_conv"), F.col("role").alias("r_role"), F.col("digest").alias("r_digest"), first.alias("r_turn"), F.lit(True).alias("r_hit")
    )
    same = rows["conv_id"].eqNullSafe(twice["r_conv"]) & (rows["role"] == twice["r_role"]) & (rows["digest"] == twice["r_digest"])
    later = F.col("r_hit").isNotNull() & ~F.col("turn").eqNullSafe(F.col("r_turn"))
    marked = rows.join(twice, same, "left").select(*rows.columns, F.coalesce(later, F.lit(False)).alias("repeated"))

    conv = turns.select("conv_id").schema["conv_id"]
    conv = StructField("conv_id", conv.dataType, True)
    run_schema, answer_schema = _ddl(_RUN, conv), _ddl(_ANSWER, conv)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_runs(_rows_of(batches), TaskContext.get().partitionId()), _arrow(run_schema))

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_answers(_rows_of(batches)), _arrow(answer_schema))

    dealt = marked.repartitionByRange("conv_id", *_ORDER).sortWithinPartitions("conv_id", *_ORDER)
    # Written: what a run holds depends on where the ranges were cut, so a repeated task must not cut anew.
    parts = stored(dealt.mapInArrow(runs, run_schema), "repair_runs")
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(answers, answer_schema)


class _Edit(NamedTuple):
    edit: str
    role: str | None
    text: str | None
    turn: int | None


class _Edits:
    """Applies initials to rows as they come. Roles follow from the places: an odd number of rows begins with
    the kept one of the system, then user and assistant take turns."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.place = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2

    def _role(self) -> str:
        return "assistant" if (self.place + self.odd) % 2 else "user"

    def inserted(self) -> Iterator[_Edit]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield _Edit("I", self._role(), "", None)
            self.at, self.place = self.at + 1, self.place + 1

    def row(self, turn: int | None, role: str, text: str) -> Iterator[_Edit]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            yield _Edit("D", None, None, turn)
            return
        yield _Edit(edit, role if edit == "K" else self._role(), text, turn)
        self.place += 1


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, answer or None, turn, role, text), the answer first -> (conv, answer) and the edits in order, as (conv, edit)."""
    conv, edits = None, None
    for key, answer, turn, role, text in rows:
        if answer is not None:
            if edits is not None:
                for edit in edits.inserted():
                    yield conv, edit
            conv, edits = key, _Edits(answer["audit"])
            yield conv, answer
        else:
            for edit in edits.row(turn, role, text):
                yield conv, edit
    if edits is not None:
        for edit in edits.inserted():
            yield conv, edit


def _streamed(turns: DataFrame, answers: DataFrame) -> DataFrame:
    """Each conversation's answer, then its rows in order, in one partition."""
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    heads = answers.select(
        "conv_id", F.struct(*columns).alias("answer"), F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"), F.lit("").alias("text"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("kind"),
    )
    rows = _prepared(turns).withColumns({"answer": F.lit(None).cast(heads.schema["answer"].dataType), "kind": F.lit(1)})
    both = heads.unionByName(rows).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", *_ORDER).select("conv_id", "answer", "turn", "role", "text")


def repaired(turns: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), edit (I, K or R), role, text, and the turn of rows that were there.

    `answers` is what `repairs` gives for the same rows."""
    answers = stored(repairs(turns), "repairs") if answers is None else answers
    conv = StructField("conv_id", turns.schema["conv_id"].dataType, True)
    schema = _ddl("place long, edit string, role string, text string, turn long", conv)

    def placed(rows: Iterator[tuple]) -> Iterator[tuple]:
        place = 0
        for key, edit in _edited(rows):
            if not isinstance(edit, _Edit):
                place = 0
            elif edit.edit != "D":
                yield key, place, edit.edit, edit.role, edit.text, edit.turn
                place += 1

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(placed(_rows_of(batches)), _arrow(schema))

    return _streamed(turns, answers).mapInArrow(edited, schema)


def repair_digests(turns: DataFrame) -> DataFrame:
    """What `repairs` gives, and the digest of the repaired rows as ``role:text``, joined by line ends.

    The digest of one conversation can only be read from its beginning to its end; memory holds a row at a time."""
    ship(turns.sparkSession)
    answers = stored(repairs(turns), "repairs")
    conv = StructField("conv_id", turns.schema["conv_id"].dataType, True)
    schema = _ddl(f"{_ANSWER}, repaired_sha256 string", conv)

    def digested(rows: Iterator[tuple]) -> Iterator[tuple]:
        head, digest, place = None, None, 0
        for key, edit in _edited(rows):
            if not isinstance(edit, _Edit):
                if head is not None:
                    yield *head, digest.hexdigest()
                head, digest, place = (key, *edit.values()), hashlib.sha256(), 0
            elif edit.edit != "D":
                line = f"{edit.role}:{edit.text}"
                digest.update((("\n" if place else "") + line).encode("utf-8"))
                place += 1
        if head is not None:
            yield *head, digest.hexdigest()

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(digested(_rows_of(batches)), _arrow(schema))

    return _streamed(turns, answers).mapInArrow(edited, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20: 0 goes, 1 loses its text, 2 its ends of sentences, 3 comes
    twice, 4 is given the role of the user. Nulls stand for one space."""
    space = F.lit(" ")

    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("fate != 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")
    ).drop("copy")


def damaged_and_repaired(turns: DataFrame) -> DataFrame:
    """Every conversation of `turns` with the repair of its damaged rows; without rows, zeros and empty texts."""
    ids = turns.select(F.col("conv_id").alias("id")).distinct()
    found = repair_digests(damaged(turns))
    empty = hashlib.sha256(b"").hexdigest()
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    whole = ids.join(found, ids["id"].eqNullSafe(found["conv_id"]), "left")
    return whole.withColumns(
        zero | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(empty)), "conv_id": F.col("id")}
    ).drop("id")
