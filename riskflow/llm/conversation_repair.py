"""Repair of conversations by weighted CYK parsing over intervals of rows.

A conversation is right if the first letters of its roles read `(s?(ua)+)?`. Rows may be kept (cost 0), given the role
user or assistant (1), deleted (2; blank rows and duplicates must be), and rows with an empty text may be inserted (5);
a row that is cut short and stays adds 5. The cheapest edits are looked for, among equally cheap ones the smallest string
of the edits' letters (D, I, K, R) in ASCII order: the audit.

Grammar: the language is regular, so its repair grammar in Chomsky normal form has a symbol <p,q> for each pair of states
of its automaton, "the rows of this span, after edits, lead from p to q", binary rules <p,q> -> <p,r> <r,q>, and for
single rows the cells of `leaf`, closed under insertions on both sides. A cell holds the least (cost, audit) of a
symbol over a span. Spans are combined bottom-up by their length: 1, 2, 4 and so on. One split of a span is enough, because
what <p,q> derives over a span can be divided at every row, with r the state reached there. Cells stay least when combined:
cost follows from the audit and its rows, and of two audits of one span none is the beginning of the other
unless that one has more insertions and costs more.

Rows are ordered by turn (nulls first), then role and text. They are dealt by ranges of that order, so a long conversation
lies in many tasks. A conversation in the midst of a task's rows is whole and repaired there. Of others, each task reduces its
stretch to pieces with the 11 cells of their span; only these meet, and the states between pieces that follow from them are sent back to
the rows of each piece. Rows equal in all
columns are counted before they are dealt.

Nulls in role and text are read as one blank. A null turn is a place before all others, a null conv_id a conversation. A role
without a letter fits nowhere: it is given another or deleted. Repeated rows are duplicates of the first; an empty table has no rows.
Only the four columns conv_id, turn, role and text are read, so other columns can't clash.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from riskflow.llm.common import materialize

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: Rows of a piece at most; a longer stretch makes several.
PIECE_ROWS = 4096
PIECE_CHARS = 1 << 22

# States: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an assistant row.
MOVES = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
NAMES = {"u": "user", "a": "assistant"}
SYMBOLS = [(p, q) for p in range(4) for q in range(4) if (p, q) in {(0, 0), (0, 1), (1, 1)} or q >= 2]
PLACE = {symbol: k for k, symbol in enumerate(SYMBOLS)}
BINARY = [[(PLACE[p, r], PLACE[r, q]) for r in range(4) if (p, r) in PLACE and (r, q) in PLACE] for p, q in SYMBOLS]
FINAL = (PLACE[0, 0], PLACE[0, 3])

Cells = list[tuple[int, str] | None]


def combine(left: Cells, right: Cells) -> Cells:
    """The cells of a span from those of its two parts."""
    out: Cells = []
    for rules in BINARY:
        best = None
        for i, j in rules:
            a, b = left[i], right[j]
            if a is not None and b is not None:
                found = (a[0] + b[0], a[1] + b[1])
                if best is None or found < best:
                    best = found
        out.append(best)
    return out


def _least(cells: Cells, symbol: tuple[int, int], found: tuple[int, str]) -> None:
    k = PLACE[symbol]
    if cells[k] is None or found < cells[k]:
        cells[k] = found


@lru_cache(1)
def insertions() -> Cells:
    """The cells of no row: what insertions alone derive."""
    cells: Cells = [None] * len(SYMBOLS)
    for p in range(4):
        _least(cells, (p, p), (0, ""))
        for (letter, start), end in MOVES.items():
            if letter in NAMES and start == p:
                _least(cells, (p, end), (INSERT, "I"))
    return combine(combine(cells, cells), cells)  # no shortest path visits a state twice


@lru_cache(64)
def leaf(letter: str, fault: int) -> tuple:
    """The cells of one row, closed under insertions before and after it."""
    cells: Cells = [None] * len(SYMBOLS)
    for p in range(4):
        _least(cells, (p, p), (DELETE, "D"))
    if fault not in (BLANK, DUPLICATE):
        more = CUT_SHORT if fault == TRUNCATED else 0
        for (move, p), q in MOVES.items():
            if move == letter:
                _least(cells, (p, q), (KEEP + more, "K"))
            if move in NAMES:
                _least(cells, (p, q), (REROLE + more, "R"))
    return tuple(combine(combine(insertions(), cells), insertions()))


class Span:
    """Cells of a growing span; of its parts, equally long ones are combined at once."""

    def __init__(self) -> None:
        self.parts: list[tuple[int, Cells]] = []

    def push(self, cells: Cells) -> None:
        n = 1
        while self.parts and self.parts[-1][0] == n:
            cells = combine(self.parts.pop()[1], cells)
            n *= 2
        self.parts.append((n, cells))

    def cells(self) -> Cells:
        out = insertions()
        for _, cells in reversed(self.parts):
            out = combine(cells, out)
        return out


def apply_audit(audit: str, rows: list[tuple[str, str]], state: int = 0) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the rows that stay or are inserted, from a state on."""
    out, at = [], iter(rows)
    for edit in audit:
        if edit == "I":
            letter = "a" if state == 2 else "u"
            row = (NAMES[letter], "")
        else:
            row = next(at)
            if edit == "D":
                continue
            letter = row[0][:1] if edit == "K" else ("a" if state == 2 else "u")
            row = row if edit == "K" else (NAMES[letter], row[1])
        out.append((edit, *row))
        state = MOVES[letter, state]
    return out


def legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


# Rows, each distinct one once, with their first fault.


def _faulty_rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies (number of equal rows), first (fault of the first copy), rest (of the others)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    counted = rows.select("conv_id", "turn", text("role"), text("text")).groupBy("conv_id", "turn", "role", "text")
    counted = counted.agg(F.count(F.lit(1)).alias("copies"))
    again = counted.groupBy("conv_id", "role", "text").agg(
        F.min("turn").alias("since"), F.max(F.col("turn").isNull()).alias("unplaced"), F.count(F.lit(1)).alias("turns")
    )
    again = again.where("turns > 1").select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "text")], "since", "unplaced")
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("text") == F.col("_text"))
    marked = counted.join(again, same, "left")
    later = F.col("unplaced").isNotNull() & F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("since")))
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    blank = body == ""
    cut = ~F.right(body, F.lit(1)).isin(".", "!", "?")
    first = F.when(blank, BLANK).when(later, DUPLICATE).when(cut, TRUNCATED).otherwise(0)
    return marked.select("conv_id", "turn", "role", "text", "copies", first.alias("first"), F.when(blank, BLANK).otherwise(DUPLICATE).alias("rest"))


def _cells_type() -> ArrayType:
    return ArrayType(StructType([StructField("cost", LongType()), StructField("audit", StringType())]))


COUNTS = ("blank", "duplicate", "truncated", "illegal")


class _Piece:
    """A stretch of rows of one conversation."""

    def __init__(self, conv_id, begun: bool = True) -> None:
        """`begun`: the piece holds the first rows that this task has of its conversation."""
        self.conv_id, self.begun, self.span, self.rows, self.chars = conv_id, begun, Span(), [], 0
        self.counts = dict.fromkeys(COUNTS, 0)
        self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if self.rows and not legal(self.rows[-1][0][:1] + role[:1]):
            self.counts["illegal"] += 1
        if fault:
            self.counts[COUNTS[fault - 1]] += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.rows.append((role, text))
        self.chars += len(role) + len(text)
        self.span.push(leaf(role[:1], fault))

    def record(self, place: int) -> dict:
        cells = [None if c is None else {"cost": c[0], "audit": c[1]} for c in self.span.cells()]
        return {
            "conv_id": self.conv_id, "piece": place, "alone": False, "cells": cells,
            "first_role": self.rows[0][0][:1], "last_role": self.rows[-1][0][:1],
            "turns": self.turns, "first_turn": self.first_turn, "last_turn": self.last_turn, **self.counts,
            "roles": [r for r, _ in self.rows], "texts": [t for _, t in self.rows],
        }


def _chars(record: dict) -> int:
    return sum(map(len, record.get("texts") or ())) + sum(len(e["text"]) for e in record.get("edits") or ())


def _batches(records: Iterator[dict], schema: pa.Schema, rows: int = 500) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in records:
        held.append(r)
        size += _chars(r)
        if len(held) >= rows or size >= PIECE_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _row_dicts(batches: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield from batch.slice(start, rows).to_pylist()


def _settled(piece: dict) -> dict:
    """A piece that is a whole conversation, repaired."""
    (found,) = _chosen([piece])
    edits = apply_audit(found["part"], list(zip(piece["roles"], piece["texts"], strict=True)))
    return {**found, "alone": True, "edits": [dict(zip(("edit", "role", "text"), e, strict=True)) for e in edits]}


def _pieces(rows: Iterator[dict]) -> Iterator[dict]:
    """Pieces of this task's conversations. One that is neither its first nor its last, and has one piece, is whole and settled here."""
    place = TaskContext.get().partitionId() << 40
    piece: _Piece | None = None
    first = True
    for r in rows:
        for copy in range(r["copies"]):
            if piece is not None and piece.conv_id != r["conv_id"]:
                # Another conversation begins, so the one before ends here.
                record = piece.record(place)
                yield _settled(record) if not first and piece.begun else record
                piece, place, first = None, place + 1, False
            elif piece is not None and (len(piece.rows) >= PIECE_ROWS or piece.chars >= PIECE_CHARS):
                yield piece.record(place)
                piece, place = _Piece(r["conv_id"], begun=False), place + 1
            piece = piece or _Piece(r["conv_id"])
            piece.add(r["turn"], r["role"], r["text"], r["rest"] if copy else r["first"])
    if piece is not None:
        yield piece.record(place)


def _chosen(pieces: list[dict]) -> Iterator[dict]:
    """For each piece of a conversation the state before it and its part of the audit; counts with the first one."""
    best: dict[int, tuple[int, str]] = {0: (0, "")}
    back: list[dict[int, int]] = []
    cells = [[None if c is None else (c["cost"], c["audit"]) for c in p["cells"]] for p in pieces]
    for own in cells:
        after: dict[int, tuple[int, str, int]] = {}
        for (p, q), k in PLACE.items():
            if p in best and own[k] is not None:
                found = (best[p][0] + own[k][0], best[p][1] + own[k][1], p)
                if q not in after or found < after[q]:
                    after[q] = found
        back.append({q: p for q, (_, _, p) in after.items()})
        best = {q: (cost, audit) for q, (cost, audit, _) in after.items()}
    state = min((best[q], q) for q in (0, 3) if q in best)[1]
    total = best[state][0]
    path = [state]
    for b in reversed(back):
        path.append(b[path[-1]])
    path.reverse()
    counts = {c: sum(p[c] for p in pieces) for c in COUNTS}
    turns = sum(p["turns"] for p in pieces)
    low = high = None
    for n, p in enumerate(pieces):
        if n and not legal(pieces[n - 1]["last_role"] + p["first_role"]):
            counts["illegal"] += 1
        if p["first_turn"] is not None:
            turns -= high == p["first_turn"]
            low, high = p["first_turn"] if low is None else low, p["last_turn"]
    gaps = 0 if low is None else high - low + 1 - turns
    for n, p in enumerate(pieces):
        whole = {"gaps": gaps, **counts, "cost": total} if not n else {}
        yield {"conv_id": p["conv_id"], "piece": p["piece"], "state": path[n], "part": cells[n][PLACE[path[n], path[n + 1]]][1], **whole}


def _by_conversation(rows: Iterator[dict]) -> Iterator[list[dict]]:
    held: list[dict] = []
    for r in rows:
        if held and held[0]["conv_id"] != r["conv_id"]:
            yield held
            held = []
        held.append(r)
    if held:
        yield held


def _mapped(rows: DataFrame, schema: StructType, records) -> DataFrame:
    """Rows through a function from an iterator of dicts to one of dicts."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda batches: _batches(records(_row_dicts(batches)), arrow), schema)


def repair(rows: DataFrame) -> DataFrame:
    """Pieces of repaired conversations: conv_id, piece (its order), alone (it is the whole one), part (of the audit), edits (edit, role, text of
    the rows that are left), and with the first piece of a conversation gaps, blank, duplicate, truncated, illegal and cost.

    `repaired_rows` and `repair_report` make rows and a report of them.
    """
    key = StructField("conv_id", rows.schema["conv_id"].dataType)
    long = lambda *names: [StructField(n, LongType()) for n in names]
    text = lambda *names: [StructField(n, StringType()) for n in names]
    faulty = materialize(_faulty_rows(rows), "faulty-rows")
    # Equal beginnings go to one task, so the order by whole texts agrees with the ranges.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = faulty.repartitionByRange(n, "conv_id", "turn", "role", F.left("text", F.lit(64)))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    lists = [StructField("roles", ArrayType(StringType())), StructField("texts", ArrayType(StringType()))]
    light = [key, *long("piece"), StructField("cells", _cells_type()), *text("first_role", "last_role")]
    light += long("turns", "first_turn", "last_turn", *COUNTS)
    edits = StructField("edits", ArrayType(StructType(text("edit", "role", "text"))))
    alone = StructField("alone", BooleanType())
    settled = [*text("part"), *long("gaps", "cost"), edits]
    pieces = materialize(_mapped(dealt, StructType([*light, *lists, alone, *settled]), _pieces), "pieces")
    repaired = StructType([key, *long("piece"), alone, *text("part"), *long("gaps", *COUNTS, "cost"), edits])

    parts = pieces.where("NOT alone").drop(*[f.name for f in settled])
    ordered = parts.drop("roles", "texts", "alone").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    chosen = StructType([key, *long("piece", "state"), *text("part"), *long("gaps", *COUNTS, "cost")])
    states = _mapped(ordered, chosen, lambda found: (c for p in _by_conversation(found) for c in _chosen(p)))
    states = states.withColumnsRenamed({"conv_id": "_conv_id", "piece": "_piece"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("piece") == F.col("_piece"))
    both = parts.select("conv_id", "piece", "alone", "roles", "texts").join(states, same).drop("_conv_id", "_piece")

    def edited(found: Iterator[dict]) -> Iterator[dict]:
        for r in found:
            left = apply_audit(r["part"], list(zip(r["roles"], r["texts"], strict=True)), r["state"])
            yield {**{f.name: r[f.name] for f in repaired.fields[:-1]}, "edits": [dict(zip(("edit", "role", "text"), e, strict=True)) for e in left]}

    return pieces.where("alone").select(*repaired.names).union(_mapped(both, repaired, edited))


def repaired_rows(repaired: DataFrame) -> DataFrame:
    """conv_id, piece, place (in the piece), edit (K, R or I), role, text: the repaired conversations, a row for each turn."""
    return repaired.select("conv_id", "piece", F.posexplode("edits").alias("place", "_row")).select("conv_id", "piece", "place", "_row.*")


def _reported(pieces: Iterator[dict]) -> Iterator[dict]:
    """One row for each conversation; texts are hashed as they come, never joined."""
    whole, digest, audit, empty = {}, hashlib.sha256(), [], True
    for r in pieces:
        if not whole or r["conv_id"] != whole["conv_id"]:
            if whole:
                yield {**whole, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            whole = {c: r[c] for c in ("conv_id", "gaps", *COUNTS, "cost")}
            digest, audit, empty = hashlib.sha256(), [], True
        for e in r["edits"]:
            digest.update((("" if empty else "\n") + f"{e['role']}:{e['text']}").encode())
            empty = False
        audit.append(r["part"])
    if whole:
        yield {**whole, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def repair_report(repaired: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each conversation that has rows.

    The hash is of the repaired `role:text`, joined by line ends. gaps is the last turn less the first one, plus 1, less the number of
    distinct turns, all without nulls; illegal counts neighbours, before the repair, whose roles don't begin with su, ua or au.
    """
    ordered = repaired.where("NOT alone").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    fields = [repaired.schema["conv_id"], *[StructField(n, LongType()) for n in ("gaps", *COUNTS, "cost")]]
    schema = StructType([*fields, StructField("audit", StringType()), StructField("repaired_sha256", StringType())])
    return _mapped(repaired.where("alone"), schema, _reported).union(_mapped(ordered, schema, _reported))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults that a hash of conversation and turn puts in: 0 drops a row, 1 empties its text, 2 removes
    its `.`, `!` and `?`, 3 repeats it, 4 makes its role user, of 20."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    return (
        rows.select("conv_id", "turn", "role", "text", kind.alias("_kind"))
        .where("_kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(part("role")).alias("role"),
            text.alias("text"),
            F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
        )
        .drop("_copy")
    )
