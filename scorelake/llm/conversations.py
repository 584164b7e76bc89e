"""Repair of the turn structure of conversations with the cheapest edits, and an audit of them.

A conversation is well formed if its roles read (system? (user assistant)+)?. An
edit keeps a row, gives it another role, deletes it or inserts an empty row. The
places in that form and the edits' costs are a weighted automaton that reads rows
and has several ways to read each. It is made deterministic as far as rows are
met: a state is the vector of the least costs of all places, less their minimum;
each pair of a state and a kind of row is worked out once and kept in a table. So
the cost of a conversation is the sum of what a scan through the table finds.

From the end of the scan a trace goes back over tight arcs, the ones that a
cheapest repair can use, and marks the places on them; a walk forward over the
marks reads the least of the cheapest audits. Both steps are kept in tables, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import checkpointed, prepare_python

#: Costs of edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: Bytes of a conversation that are held until its edits are known; a longer one is read again.
HELD = 8 << 20
#: Places in the form: nothing yet, behind the system's row, behind a user's, behind an assistant's.
NONE, SYSTEM, USER, ASSISTANT = range(4)
PLACES, FINAL = range(4), (NONE, ASSISTANT)
#: Kinds of roles by initial (s, u, a, any other); a row is twice its role's kind, one more if truncated, or GONE if it must go.
ROLES, GONE = "sua", 8
#: Place behind a row of each kind of role.
_NEXT = {0: {NONE: SYSTEM}, 1: {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}
_TURN = _NEXT[1] | _NEXT[2]
_FAR = 1 << 30
#: Short conversations whose repair is remembered.
REMEMBERED = 100_000


def _arcs(row: int) -> list[tuple[str, int, dict[int, int]]]:
    """Letter, cost and places of each edit of a row, the least letter first."""
    arcs = [("D", DELETE, {q: q for q in PLACES})]
    if row != GONE:
        arcs += [("K", TRUNCATED * (row % 2), _NEXT[row // 2]), ("R", REROLE + TRUNCATED * (row % 2), _TURN)]
    return arcs


ARCS = [_arcs(row) for row in range(GONE + 1)]


class Automaton:
    """The deterministic automaton, as far as it has been needed."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        #: For each state and row: the next state and the cost taken out of it.
        self.table: list[list[tuple[int, int] | None]] = []
        self.back: dict[tuple[int, ...], int] = {}
        self.ahead: dict[tuple[int, ...], tuple[str, int]] = {}
        self.known: dict[bytes, tuple[int, str]] = {}
        self.start, _ = self._state([0, _FAR, _FAR, _FAR])

    def _state(self, costs: list[int]) -> tuple[int, int]:
        """State of a vector of costs, after insertions, and the minimum taken out.

        Where a place costs more than to reach the assistant's and go on from there
        (one deletion more at most from the first place, nothing more from the
        system's), it is on no cheapest way and set aside; so states are few.
        """
        for _ in range(2):
            for p, q in _TURN.items():
                costs[q] = min(costs[q], costs[p] + INSERT)
        if costs[NONE] > costs[ASSISTANT] + DELETE:
            costs[NONE] = _FAR
        if costs[SYSTEM] > costs[ASSISTANT]:
            costs[SYSTEM] = _FAR
        least = min(costs)
        vector = tuple(x - least if x < _FAR else _FAR for x in costs)
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
            self.table.append([None] * (GONE + 1))
        return self.number[vector], least

    def _arc(self, state: int, row: int) -> tuple[int, int]:
        vector, costs = self.vectors[state], [_FAR] * 4
        for _, cost, places in ARCS[row]:
            for p, q in places.items():
                costs[q] = min(costs[q], vector[p] + cost)
        self.table[state][row] = self._state(costs)
        return self.table[state][row]

    def _inserted(self, state: int, marks: int) -> int:
        """Marks, and the places from which a tight insertion leads to one."""
        vector = self.vectors[state]
        for _ in range(2):
            for p, q in _TURN.items():
                if marks >> q & 1 and vector[p] + INSERT == vector[q]:
                    marks |= 1 << p
        return marks

    def _behind(self, state: int, row: int, marks: int) -> int:
        """Places before a row from which a tight arc leads to a marked place behind it."""
        after, least = self.table[state][row]
        vector, ahead, found = self.vectors[state], self.vectors[after], 0
        for _, cost, places in ARCS[row]:
            for p, q in places.items():
                if marks >> q & 1 and vector[p] < _FAR and vector[p] + cost == ahead[q] + least:
                    found |= 1 << p
        return self._inserted(state, found)

    def _forward(self, state: int, row: int, places: int, marks: int, ahead: int) -> tuple[str, int]:
        """Least letters from one of the places over tight arcs up to the edit of a row, and the places behind it."""
        after, least = self.table[state][row]
        vector, beyond, letters = self.vectors[state], self.vectors[after], ""
        while True:
            for letter, cost, moves in [ARCS[row][0], ("I", INSERT, _TURN), *ARCS[row][1:]]:
                inside = letter == "I"
                values, less, allowed = (vector, 0, marks) if inside else (beyond, least, ahead)
                to = sum({1 << q for p, q in moves.items() if places >> p & 1 and allowed >> q & 1 and vector[p] + cost == values[q] + less})
                if to:
                    break
            letters, places = letters + letter, to
            if not inside:
                return letters, places

    def repair(self, rows: bytes) -> tuple[int, str]:
        """Least cost of rows, and the least of the audits with that cost."""
        if rows in self.known:
            return self.known[rows]
        table, state, cost = self.table, self.start, 0
        states = np.empty(len(rows) + 1, np.int32)
        states[0] = state
        for i, row in enumerate(rows, 1):
            state, least = table[state][row] or self._arc(state, row)
            states[i] = state
            cost += least
        last = self.vectors[state]
        least = min(last[q] for q in FINAL)
        ends = sum(1 << q for q in FINAL if last[q] == least)
        marks = np.empty(len(rows) + 1, np.uint8)
        marks[-1] = at = self._inserted(state, ends)
        for i in range(len(rows) - 1, -1, -1):
            key = (int(states[i]), rows[i], at)
            if key not in self.back:
                self.back[key] = self._behind(*key)
            marks[i] = at = self.back[key]
        letters, places = [], 1 << NONE
        for i, row in enumerate(rows):
            key = (int(states[i]), row, places, int(marks[i]), int(marks[i + 1]))
            if key not in self.ahead:
                self.ahead[key] = self._forward(*key)
            letter, places = self.ahead[key]
            letters.append(letter)
        while not places & ends:
            places = sum({1 << q for p, q in _TURN.items() if places >> p & 1 and int(marks[-1]) >> q & 1 and last[p] + INSERT == last[q]})
            letters.append("I")
        out = cost + least, "".join(letters)
        if len(rows) <= 64:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[rows] = out
        return out


class Edits:
    """Applies an audit to rows that come one by one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.count, self.turns = audit, 0, 0, 0

    def _turn(self) -> str:
        self.turns += 1
        return "user" if self.turns % 2 else "assistant"

    def _insertions(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield "insert", self._turn(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of what stands for the next row, insertions before it included."""
        yield from self._insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            if role[:1] != "s":
                self.turns += 1
            yield "keep", role, text
        elif letter == "R":
            yield "rerole", self._turn(), text

    def rest(self) -> Iterator[tuple[str, str, str]]:
        yield from self._insertions()


class _Conversation:
    """What is known of a conversation so far: some 20 bytes a row, and its rows as long as they are few."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.roles, self.digests, self.signs, self.illegal = bytearray(), bytearray(), bytearray(), 0
        self.rows: list[tuple[str, str]] | None = []
        self.size = self.turns = 0
        self.low = self.high = None

    def add(self, turn: int | None, role: int, sign: int, digest: bytes, name: str, text: str, held: int) -> None:
        if self.roles and (self.roles[-1], role) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.roles.append(role)
        self.signs.append(sign)
        self.digests += digest
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.rows is not None:
            self.size += len(name) + len(text) + 100
            self.rows.append((name, text))
            if self.size > held:
                self.rows = None

    def finished(self, automaton: Automaton) -> tuple:
        roles, signs = np.frombuffer(self.roles, np.uint8), np.frombuffer(self.signs, np.uint8)
        first = np.zeros(len(roles), bool)
        if len(roles):
            first[np.unique(np.frombuffer(self.digests, "S16"), return_index=True)[1]] = True
        blank = signs == 2
        repeated = ~blank & ~first
        cut = ~blank & first & (signs == 1)
        cost, audit = automaton.repair(np.where(blank | repeated, GONE, 2 * roles + cut).astype(np.uint8).tobytes())
        gaps = self.high - self.low + 1 - self.turns if self.high is not None else 0
        digest = None
        if self.rows is not None:
            edits, lines = Edits(audit), []
            for row in self.rows:
                lines += edits.row(*row)
            digest = hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in [*lines, *edits.rest()]).encode("utf-8", "replace")).hexdigest()
        return self.conv_id, gaps, int(blank.sum()), int(repeated.sum()), int(cut.sum()), self.illegal, cost, audit, digest


_automaton: list[Automaton] = []
_PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [x.split()[0] for x in _PLAN.split(", ")]


def _plans(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _automaton:
            _automaton.append(Automaton())
        one = id_type = None
        for batch in batches:
            id_type, done = batch.schema.field("conv_id").type, []
            for conv_id, lost, turn, role, sign, digest, name, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "lost", "turn", "kind", "sign", "digest", "role", "text")), strict=True):
                if one is None or one.conv_id != conv_id:
                    done += [one.finished(_automaton[0])] if one else []
                    one = _Conversation(conv_id)
                if not lost:
                    one.add(turn, role, sign, digest, name, text, held)
            if done:
                yield _batch(done, id_type)
        if one:
            yield _batch([one.finished(_automaton[0])], id_type)

    return run


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type] + [pa.int64() if " long" in x else pa.string() for x in _PLAN.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["conv_id", *_NAMES])


def _ordered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and lost of rows, with a space in place of null roles and texts."""
    lost = F.coalesce(F.col("lost").cast("boolean"), F.lit(False)) if "lost" in rows.columns else F.lit(False)
    space = lambda name: F.coalesce(F.col(name), F.lit(" ")).alias(name)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"), lost.alias("lost"))


def plans(rows: DataFrame, *, held: int = HELD) -> DataFrame:
    """Faults and cheapest edits of each conversation of rows (conv_id, turn, role, text).

    Returns conv_id, gaps (turns missing between the first and the last), blank,
    duplicate, truncated (rows by their first fault), illegal (neighbours whose
    roles don't follow one another), cost, audit (a letter per edit: Keep, Rerole,
    Delete, Insert) and repaired_sha256 (of the repaired `role:text` rows).

    Rows are ordered by turn, null turns first, and by role and text where turns
    are equal. A null role or text counts as one space. Rows with a true column
    lost take no part, but their conversations are returned. A conversation
    without rows has zeros, an empty audit and the digest of the empty text. A null
    conv_id is a conversation like others; repeated rows are duplicates; an empty
    table gives an empty result; other columns are ignored.

    One shuffle by conversation. A task reads its conversations row by row, so it
    holds some 20 bytes for each row of one of them, and no more than `held` bytes
    of its texts: the rows of a longer one are read a second time, as a stream.
    """
    prepare_python(rows.sparkSession)
    white = " \t\n\x0b\x0c\r"
    ends = F.rtrim("text", F.lit(white))
    kind = F.instr(F.lit(ROLES), F.left("role", F.lit(1))) - 1
    told = _ordered(rows).select(
        "conv_id", "lost", "turn",
        F.when((F.length("role") > 0) & (kind >= 0), kind).otherwise(3).alias("kind"),
        F.when(ends == "", 2).when(F.right(ends, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1).alias("sign"),
        F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))).alias("digest"),
        "role", "text",
    )
    sort = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"]
    id_type = rows.schema["conv_id"].dataType.simpleString()
    found = told.repartition("conv_id").sortWithinPartitions(*sort).mapInArrow(textops.released(_plans(held)), f"conv_id {id_type}, {_PLAN}")
    found = checkpointed(found)
    long = found.filter("repaired_sha256 IS NULL")
    if long.isEmpty():
        return found
    return found.filter("repaired_sha256 IS NOT NULL").unionByName(_streamed(rows, long, f"conv_id {id_type}, {_PLAN}", _digests))


def _streamed(rows: DataFrame, found: DataFrame, schema: str, apply) -> DataFrame:
    """Rows behind the plan of their conversation, in order, given to apply."""
    heads = found.select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("long").alias("turn"), *[F.lit(None).cast("string").alias(k) for k in ("role", "text")], F.struct(*_NAMES).alias("plan"))
    nothing = F.lit(None).cast(heads.schema["plan"].dataType)
    body = _ordered(rows).filter("NOT lost").alias("r").join(found.select(F.col("conv_id").alias("wanted")), F.col("conv_id").eqNullSafe(F.col("wanted")), "left_semi")
    both = heads.unionByName(body.select("conv_id", F.lit(1).alias("place"), "turn", "role", "text", nothing.alias("plan")))
    sort = [F.asc_nulls_first("conv_id"), "place", F.asc_nulls_first("turn"), "role", "text"]
    return both.repartition("conv_id").sortWithinPartitions(*sort).drop("place", "turn").mapInArrow(textops.released(apply), schema)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """For each conversation its id and plan and a null line, then its lines one by one; before each batch None and the type of the ids."""
    head = edits = None
    for batch in batches:
        yield None, batch.schema.field("conv_id").type
        for conv_id, plan, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "plan", "role", "text")), strict=True):
            if plan:
                if edits:
                    yield from ((head, line) for line in edits.rest())
                head, edits = (conv_id, plan), Edits(plan["audit"] or "")
                yield head, None
            else:
                yield from ((head, line) for line in edits.row(role, text))
    if edits:
        yield from ((head, line) for line in edits.rest())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = digest = id_type = None
    told = lambda: _batch([(now[0], *(now[1][k] for k in _NAMES[:-1]), digest.hexdigest())], id_type)
    for head, line in _edited(batches):
        if head is None:
            id_type = line
        elif line is None:
            if now:
                yield told()
            now, digest, mark = head, hashlib.sha256(), b""
        else:
            digest.update(mark + f"{line[1]}:{line[2]}".encode("utf-8", "replace"))
            mark = b"\n"
    if now:
        yield told()


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def told() -> pa.RecordBatch:
        types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["conv_id", "position", "edit", "role", "text"])

    rows, position, id_type = [], 0, None
    for head, line in _edited(batches):
        if head is None:
            id_type = line
            if rows:
                yield told()
            rows = []
        elif line is None:
            position = 0
        else:
            rows.append((head[0], position, *line))
            position += 1
    if rows:
        yield told()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations by the edits that plans() has found: conv_id, position from 0, edit (keep, rerole or insert), role, text."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    prepare_python(rows.sparkSession)
    return _streamed(rows, found, f"conv_id {id_type}, position long, edit string, role string, text string", _lines)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations (conv_id, turn, role, text) with faults that depend on conversation and turn alone.

    Of twenty rows one is lost (its column lost is true), one loses its text, one
    its stops, one is there twice and one gets the role user. Null roles and texts
    become one space; a null conversation or turn counts as one in the draw.
    """
    word = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(word("role"))
    drawn = rows.select("conv_id", "turn", "role", "text", kind.alias("_kind"))
    times = F.explode(F.array_repeat(F.col("_kind") == 0, F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("lost")
    return drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), times)
