"""Damage to conversations, and its cheapest repair.

A conversation is right if its roles read: at most one system message, then user and assistant in
turn, an assistant last.  Rows may be kept, given another role or deleted, and empty messages may
be inserted; the cheapest edits are a Viterbi path over four states of that pattern.  The rows of
a conversation are read in order, once.  Survivors of the states are leaves of a tree of
backpointers that count their children: a branch without survivors is freed, and what all
survivors share is put out, so only the stretch on which they still disagree is in memory.  Paths
of equal cost are compared by their whole open stretches.

Survivors that can no longer win are dropped, or the path that deletes everything would keep the
tree open for ever: state q can do whatever state p may still do for ``_BEHIND[q][p]`` more, so p
is hopeless once it costs more than q and that.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# What the edits cost, and which pairs of roles may follow each other.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
# The white space, and the ends of a whole sentence.
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"

# States: nothing yet, after system, after user, after assistant; the last of these and the first may end.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
# The message that may follow by insertion or by a new role, and the state after it.
_NEXT = {_NONE: ("user", _USER), _SYSTEM: ("user", _USER), _USER: ("assistant", _ASSISTANT), _ASSISTANT: ("user", _USER)}
_BEHIND = (
    # none, system, user, assistant: at most what a survivor in the row's state pays to follow one in the column's
    (0, 0, INSERT, 0),
    (2 * INSERT, 0, INSERT, 2 * INSERT),
    (INSERT + DELETE, INSERT, 0, INSERT),
    (DELETE, 0, INSERT, 0),
)


class _Node:
    """The edits of one row on a survivor's path: an insertion before it, perhaps, and the row's own."""

    __slots__ = ("parent", "edits", "letters", "children")

    def __init__(self, parent: _Node | None, edits: tuple):
        self.parent, self.edits, self.children = parent, edits, []
        self.letters = "".join(e[0] for e in edits)


class Repair:
    """Cheapest edits of one conversation, fed row by row.

    ``push`` and ``finish`` give the edits that are settled, in order: initial (K, R, D or I), role
    and text after the edit (None for D), and the row's own tag (None for I).  Of edits of equal
    cost those with the least initials are taken.  ``cost`` is set at the end; ``open`` is the
    number of rows that are not settled.
    """

    def __init__(self):
        self.root = _Node(None, ())
        self.best: dict[int, tuple[int, _Node]] = {_NONE: (0, self.root)}
        self.cost = 0
        self.open = 0
        self.rows: deque = deque()

    def _less(self, a: tuple, b: tuple) -> bool:
        """Whether candidate a = (cost, parent, edits, letters) beats b."""
        if a[0] != b[0]:
            return a[0] < b[0]
        x, y = [a[3]], [b[3]]
        p, q = a[1], b[1]
        # both paths have one node per row, so they meet at the same time
        while p is not q:
            x.append(p.letters)
            y.append(q.letters)
            p, q = p.parent, q.parent
        return "".join(reversed(x)) < "".join(reversed(y))

    def _offer(self, found: dict, state: int, candidate: tuple) -> None:
        if state not in found or self._less(candidate, found[state]):
            found[state] = candidate

    def push(self, role: str, text: str, must_delete: bool, truncated: bool, tag=None) -> Iterator[tuple]:
        found: dict[int, tuple] = {}
        extra = TRUNCATED if truncated else 0
        initial = role[:1]
        for state, (cost, node) in self.best.items():
            # more than one insertion between two rows is never cheapest
            for inserted in (False, True):
                at, paid, before = state, cost, ()
                if inserted:
                    name, at = _NEXT[state]
                    paid, before = cost + INSERT, (("I", name),)
                start = "I" if inserted else ""
                self._offer(found, at, (paid + DELETE, node, (*before, ("D", None)), start + "D"))
                if must_delete:
                    continue
                name, after = _NEXT[at]
                if initial == name[0]:
                    self._offer(found, after, (paid + KEEP + extra, node, (*before, ("K", role)), start + "K"))
                if initial == "s" and at == _NONE:
                    self._offer(found, _SYSTEM, (paid + KEEP + extra, node, (*before, ("K", role)), start + "K"))
                self._offer(found, after, (paid + REROLE + extra, node, (*before, ("R", name)), start + "R"))
        least = {
            q: c for q, c in found.items() if not any(o[0] + _BEHIND[r][q] < c[0] for r, o in found.items() if r != q)
        }
        old = [node for _, node in self.best.values()]
        self.best = {}
        for state, (cost, parent, edits, _) in least.items():
            node = _Node(parent, edits)
            parent.children.append(node)
            self.best[state] = (cost, node)
        self.rows.append((text, tag))
        self.open += 1
        for node in old:
            self._release(node)
        return self._settled()

    def _release(self, node: _Node) -> None:
        """Free a branch without survivors."""
        while not node.children and node is not self.root:
            node.parent.children.remove(node)
            node = node.parent

    def _settled(self) -> Iterator[tuple]:
        """Move the root down to the survivors' last common ancestor."""
        while len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            yield from self._told(self.root.edits)

    def _told(self, edits: tuple) -> Iterator[tuple]:
        for letter, role in edits:
            if letter == "I":
                yield letter, role, "", None
            else:
                text, tag = self.rows.popleft()
                self.open -= 1
                yield letter, role, None if letter == "D" else text, tag

    def finish(self) -> Iterator[tuple]:
        found: dict[int, tuple] = {}
        for state, (cost, node) in self.best.items():
            edits = []
            while state not in (_NONE, _ASSISTANT):
                name, state = _NEXT[state]
                edits.append(("I", name))
            self._offer(found, 0, (cost + INSERT * len(edits), node, tuple(edits), "I" * len(edits)))
        self.cost, node, last, _ = found[0]
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            yield from self._told(node.edits)
        yield from self._told(last)


# -- rows --------------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by the checksum of ``conv_id:turn`` modulo 20; nulls count as one space.

    0 drops the row (``present`` is false), 1 empties its text, 2 takes out its sentence ends, 3
    repeats it, 4 makes its role user.  All rows of one conversation and turn share their fault.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(F.encode(key, "UTF-8")) % 20).alias("_fault")
    )
    fault = F.col("_fault")
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", f"[{ENDS}]", "")).otherwise(F.col("text")).alias("text"),
        (fault != 0).alias("present"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order, with ``seen``: role and text stood in an earlier row.

    One exchange by conversation serves the look-back, which passes over rows and holds none, and
    the order.  Rows of equal turns are ordered by role and text; nulls come first.
    """
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    plain = rows.select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], F.coalesce(present, F.lit(False)).alias("present")
    ).repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "role", "text", "present").orderBy("turn")
    flagged = plain.withColumn("seen", F.row_number().over(earlier) > 1)
    return flagged.sortWithinPartitions("conv_id", "turn", "role", "text", "seen")


class _Conversation:
    """Counts and repair of one conversation, row by row."""

    def __init__(self):
        self.repair = Repair()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.last, self.first_turn, self.last_turn, self.turns = None, None, None, 0

    def push(self, turn, role: str, text: str, seen: bool) -> Iterator[tuple]:
        stripped = text.strip(SPACE)
        fault = "blank" if not stripped else "duplicate" if seen else "truncated" if stripped[-1] not in ENDS else None
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        return self.repair.push(role, text, fault in ("blank", "duplicate"), fault == "truncated", (turn, fault))

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


def _stream(batches: Iterator[pa.RecordBatch], begin, row, end) -> Iterator[list]:
    """Fold sorted rows by conversation: ``begin`` makes a state, ``row`` and ``end`` yield result rows."""
    state, now = None, None
    for batch in batches:
        out = []
        for conv, *values in zip(*[c.to_pylist() for c in batch.columns]):
            if state is None or conv != now:
                if state is not None:
                    out.extend(end(now, state))
                state, now = begin(), conv
            out.extend(row(now, state, *values))
        yield out
    if state is not None:
        yield list(end(now, state))


def _mapped(rows: DataFrame, begin, row, end, columns: str) -> DataFrame:
    schema = rows.select("conv_id").schema
    for field in rows.sparkSession.createDataFrame([], columns).schema:
        schema = schema.add(field)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for out in _stream(batches, begin, row, end):
            values = list(zip(*out)) if out else [()] * len(target)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, target)], schema=target)

    return _in_order(rows).select("conv_id", "turn", "role", "text", "present", "seen").mapInArrow(apply, schema)


class _Numbered(_Conversation):
    place = 0


def repair_edits(rows: DataFrame) -> DataFrame:
    """The edits of every conversation: ``conv_id``, ``place``, ``edit``, ``fault``, ``turn``, ``role``, ``text``.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and perhaps ``present``; rows that are
    not present are left out.  ``place`` numbers a conversation's edits from 0; ``edit`` is K, R,
    D or I; ``role`` and ``text`` are those after the edit, null for deletions.  The repaired
    conversation is the rows other than D in order of ``place``.
    """

    def told(conv, state, edits):
        for letter, role, text, tag in edits:
            turn, fault = tag or (None, None)
            yield conv, state.place, letter, fault, turn, role, text
            state.place += 1

    def row(conv, state, turn, role, text, present, seen):
        return told(conv, state, state.push(turn, role, text, seen)) if present else ()

    def end(conv, state):
        return told(conv, state, state.repair.finish())

    turn = rows.schema["turn"].dataType.simpleString()
    return _mapped(rows, _Numbered, row, end, f"place long, edit string, fault string, turn {turn}, role string, text string")


class _Digested(_Conversation):
    """Takes in settled edits as they come: initials, and the digest of the repaired messages."""

    def __init__(self):
        super().__init__()
        self.letters, self.digest, self.messages = [], hashlib.sha256(), 0

    def take(self, edits) -> None:
        for letter, role, text, _ in edits:
            self.letters.append(letter)
            if letter != "D":
                self.digest.update((b"\n" if self.messages else b"") + f"{role}:{text}".encode())
                self.messages += 1


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``rows``: faults, cost, the edits' initials and the digest of the repaired text.

    Columns: ``gaps`` (turns missing between the first and the last, nulls left out), ``blank``,
    ``duplicate``, ``truncated`` (rows by their first fault), ``illegal`` (neighbours whose role
    initials may not follow each other), ``cost``, ``audit``, ``repaired_sha256``.  A conversation
    without present rows has zeros, no edits and the digest of nothing; a null ``conv_id`` is one
    conversation; null roles and texts are one space; repeated rows are duplicates.
    """

    def row(conv, state, turn, role, text, present, seen):
        if present:
            state.take(state.push(turn, role, text, seen))
        return ()

    def end(conv, state):
        state.take(state.repair.finish())
        counts = state.counts
        yield (
            conv, state.gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"],
            state.repair.cost, "".join(state.letters), state.digest.hexdigest(),
        )

    longs = ", ".join(f"{c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return _mapped(rows, _Digested, row, end, f"{longs}, audit string, repaired_sha256 string")
