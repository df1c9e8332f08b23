"""Conversation structure repair: the cheapest edits that give every conversation the roles ``(s?(ua)+)?``.

``s``, ``u`` and ``a`` are the initials of system, user and assistant. Edits are Keep (0), Rerole to user or assistant (3), Delete
(4; a blank or duplicate row must go) and Insert of an empty user or assistant row anywhere (3); a truncated row that stays
adds 3. Of equally cheap repairs, the one whose edits' initials are least in ASCII wins.

Rows of a conversation come to one task in order of turn and pass it as a stream (``Repair``): a Viterbi step for each
row over the four places of the pattern, whose survivors are leaves of one tree of edits. A survivor that another one, with a
detour, undercuts whatever comes is none. Nodes that no survivor descends from are dropped by their reference counts, and edits leave the tree, with their rows, once all survivors share them. So a task holds the rows whose edits are undecided, however long the conversation is. What is sent is bounded too: blank rows and
duplicates travel without their text. One conversation is one task's stream, as its edits are decided and its lines hashed in order.

Nulls: role and text count as one blank, so a null text is a blank row; a null turn comes first; a null conv_id is a
conversation of its own. Rows of equal turn are ordered by role, then blank ones and those of which an earlier turn has a copy, then text. Repeated rows are duplicates from the second on.
Long texts are whole. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from graphloom.llm.shared import text_batches

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
CHANGE_COST, DELETE_COST, TRUNCATED_COST = 3, 4, 3
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Places in the pattern: before it, after a system row, after a user row, after an assistant row. It may end at the first or last.
START, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Where a row of the fitting role of user and assistant leads; at each place only one of them fits.
_NEXT, _ROLE = (USER, USER, ASSISTANT, USER), {USER: "user", ASSISTANT: "assistant"}
#: What it costs at most to go on from one place as from another, by inserts or by deleting a kept system row: [from][as].
_DETOUR = ((0, 0, 3, 0), (6, 0, 3, 6), (7, 3, 0, 3), (4, 0, 3, 0))
_SPACE = " \t\n\x0b\x0c\r"


class _Node:
    """One row's edits (inserts before it and its own) after those of ``parent``; it lives while a survivor descends from it."""

    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent: _Node | None, edits: str):
        self.parent, self.edits, self.children = parent, edits, []


class Repair:
    """Takes a conversation's rows one by one and gives back (edits, row) as soon as they are decided."""

    def __init__(self):
        self.root = _Node(None, "")
        #: (place, cost, node), in the ASCII order of their whole edits. No survivor's edits begin another's, as all end with
        #: an edit of the last row; so this order decides ties as comparing the complete undecided suffixes would.
        self.live = [(START, 0, self.root)]
        self.rows: deque = deque()
        self.cost = 0

    def push(self, initial: str, fault: int, row) -> Iterator[tuple[str, object]]:
        stays = fault not in (BLANK, DUPLICATE)
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        best: dict[int, tuple] = {}
        for rank, (place, cost, node) in enumerate(self.live):
            for inserts in range(3):  # two lead back or to where one of them is not needed
                lead = INSERT * inserts
                ends = [(place, cost + DELETE_COST, DELETE)]
                if stays:
                    ends.append((_NEXT[place], cost + CHANGE_COST + extra, REROLE))
                    if (place, initial) in _KEPT:
                        ends.append((_KEPT[place, initial], cost + extra, KEEP))
                for end, total, edit in ends:
                    key = (total, rank, lead + edit)
                    if end not in best or key < best[end][0]:
                        best[end] = (key, node)
                place, cost = _NEXT[place], cost + CHANGE_COST
        for end in [x for x in best if any(best[y][0][0] + _DETOUR[y][x] < best[x][0][0] for y in best)]:
            del best[end]  # cheaper from another place, whatever comes
        before = [node for _, _, node in self.live]
        self.live = []
        for end, ((total, _, edits), node) in sorted(best.items(), key=lambda x: x[1][0][1:]):
            node.children.append(child := _Node(node, edits))
            self.live.append((end, total, child))
        for node in before:  # those that nothing came from, and what only they needed
            while not node.children and node is not self.root:
                node.parent.children.remove(node)
                node = node.parent
        self.rows.append(row)
        while len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            yield self.root.edits, self.rows.popleft()

    def finish(self) -> Iterator[tuple[str, object]]:
        """The rest, with the inserts after the last row (their row is None)."""
        ends = []
        for rank, (place, cost, node) in enumerate(self.live):
            for inserts in range(3):
                if place in (START, ASSISTANT):
                    ends.append((cost, rank, INSERT * inserts, node))
                place, cost = _NEXT[place], cost + CHANGE_COST
        self.cost, _, last, node = min(ends, key=lambda x: x[:3])
        rest = []
        while node is not self.root:
            rest.append(node.edits)
            node = node.parent
        for edits in reversed(rest):
            yield edits, self.rows.popleft()
        if last:
            yield last, None


def mark_faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with nulls of role and text as one blank, and ``fault``: blank, duplicate, truncated or
    none, by its number. Of several copies in the first turn that has them, all still count as first: they are neighbours, and
    the stream tells them apart. The text of rows that must go is null."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("digest", F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # Map-side sums bring each text's first turn, so copies don't meet; the turn in the join's key spreads them too.
    firsts = rows.where(~blank).groupBy("conv_id", "digest").agg(F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("turn"))
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), F.when(~F.col("untimed"), F.col("turn")).alias("_turn"), F.lit(True).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("digest") == F.col("_digest"))
    cut = ~F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1)).isin(".", "!", "?")
    fault = F.when(blank, BLANK).when(F.col("_first").isNull(), DUPLICATE).when(cut, TRUNCATED).otherwise(NONE)
    marked = rows.join(firsts, same, "left").select("conv_id", "turn", "role", "text", fault.alias("fault"))
    return marked.withColumn("text", F.when(F.col("fault").isin(NONE, TRUNCATED), F.col("text")))


def _streamed(rows: DataFrame, every: DataFrame | None) -> DataFrame:
    """Marked rows and a marker for each conversation, those of one conversation in one partition and in order."""
    marked = mark_faults(rows).select("*", F.lit(False).alias("marker"))
    ids = (rows if every is None else every).select("conv_id").distinct()
    none = {"turn": marked.schema["turn"].dataType, "role": "string", "text": "string", "fault": "int"}
    markers = ids.select("conv_id", *[F.lit(None).cast(t).alias(c) for c, t in none.items()], F.lit(True).alias("marker"))
    return marked.unionByName(markers).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("marker"), "turn", "role", "text")  # null texts, of rows that must go, come first


def _repaired(batches, put) -> Iterator[dict | None]:
    """A summary of each conversation, and None after each batch; ``put`` gets every repaired row: (conv_id, seq, edit, turn, role, text)."""
    talk = None
    for batch in batches:
        for conv, turn, role, text, fault, marker in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if marker:
                if talk is not None:
                    yield talk.end()
                talk = _Talk(conv, put)
            else:
                talk.add(turn, role, text, fault)
        yield None
    if talk is not None:
        yield talk.end()


class _Talk:
    """One conversation: counts of its faults, and its repair."""

    def __init__(self, conv, put):
        self.conv, self.put, self.repair = conv, put, Repair()
        self.place, self.audit, self.hash, self.seq = START, [], hashlib.sha256(), 0
        self.count = [0, 0, 0, 0]
        self.first = self.turn = self.last = self.initial = None
        self.turns = self.illegal = 0

    def add(self, turn, role, text, fault):
        if fault in (NONE, TRUNCATED) and self.last == (turn, role, text):
            fault = DUPLICATE
        elif text is not None:
            self.last = (turn, role, text)
        self.count[fault] += 1
        if turn is not None and turn != self.turn:
            self.first, self.turn, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        for decided in self.repair.push(role[:1], fault, (turn, role, text)):
            self.apply(*decided)

    def apply(self, edits: str, row):
        self.audit.append(edits)
        for edit in edits:
            if edit == KEEP:
                self.place = _KEPT[self.place, row[1][:1]]
                self.write(edit, *row)
            elif edit != DELETE:
                self.place = _NEXT[self.place]
                self.write(edit, *((None, _ROLE[self.place], "") if edit == INSERT else (row[0], _ROLE[self.place], row[2])))

    def write(self, edit, turn, role, text):
        self.hash.update(f"{chr(10) if self.seq else ''}{role}:{text}".encode())
        if self.put:
            self.put((self.conv, self.seq, edit, turn, role, text))
        self.seq += 1

    def end(self) -> dict:
        for decided in self.repair.finish():
            self.apply(*decided)
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return {
            "conv_id": self.conv, "gaps": gaps, "blank": self.count[BLANK], "duplicate": self.count[DUPLICATE], "truncated": self.count[TRUNCATED],
            "illegal": self.illegal, "cost": self.repair.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest(),
        }


_COLUMNS = ("conv_id", "turn", "role", "text", "fault", "marker")
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _mapped(rows: DataFrame, every: DataFrame | None, schema: str, whole_rows: bool) -> DataFrame:
    """The stream of rows to records of ``schema``: repaired rows or summaries, passed on after each batch."""
    text_batches(rows.sparkSession)
    names = [x.split()[0] for x in schema.split(", ")]

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        out = []
        for x in _repaired(batches, out.append if whole_rows else None):
            if x is not None and not whole_rows:
                out.append(tuple(x[c] for c in names))
            if out and x is None:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], target)
                out.clear()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], target)

    return _streamed(rows, every).select(*_COLUMNS).mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, seq (from 0), edit, turn (null where inserted), role, text. Conversations of which nothing is left have none."""
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return _mapped(rows, None, f"conv_id {kind['conv_id']}, seq long, edit string, turn {kind['turn']}, role string, text string", True)


def summaries(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Of each conversation in ``every`` (by default, in ``rows``): gaps in the turns, rows by first fault, illegal neighbours, the
    repair's cost, its edits' initials, and the SHA-256 of the repaired ``role:text`` lines."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _mapped(rows, every, f"conv_id {kind}, {', '.join(c + ' long' for c in _COUNTS)}, audit string, repaired_sha256 string", False)
