"""Cheapest repair of a conversation's order of roles, by a Viterbi search.

A sound conversation is empty or alternates user and assistant, each user
answered, after at most one system message. Rows may be kept, given the other
role, or deleted, and empty messages inserted; of the cheapest lists of edits
the least in ASCII order is wanted.

The search keeps one survivor for each state of that pattern. Survivors are
leaves of a tree of edits with reference counts: a branch that no survivor
needs is freed, and once all survivors share an ancestor, the edits up to it
are final and leave the tree. A survivor that can no longer become the best is
dropped, as that which has deleted all rows would else keep all open. Two paths of one cost are compared by all edits
below their common ancestor, so what has been given out never matters again
and memory holds only what is still open.

Rows are light for the search: a number, a role's initial and a fault. They are
numbered along conversations and cut into segments of ``SEGMENT_ROWS``. A
conversation inside a segment is solved there. One that goes on is solved for
every state in which it may enter the segment, and a second, small step joins
these results in order, again giving out what all survivors share. So no task
holds a conversation, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from textstyle.operators.ordering import number_rows
from textstyle.session import write_through

SEGMENT_ROWS = 4096
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
BLANK, DUPLICATE, TRUNCATED = "b", "d", "t"
#: States: nothing yet, after the system message, after a user's, after an answer.
START, SYSTEM, USER, ANSWER = "E", "S", "U", "A"
SOUND = (START, ANSWER)
#: The state that each initial of a role leads to.
FOLLOWS = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ANSWER},
    ANSWER: {"u": USER},
}
#: Initial and state of the message that may be made up in a state.
MADE = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ANSWER), ANSWER: ("u", USER)}
#: What a path may cost more than one that ends with an answer. Whatever follows
#: it may follow the answer as well, but for one system message to delete.
HOPELESS = {START: COST[DELETE], SYSTEM: 0}
#: Pairs of neighbouring initials that are in order.
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
#: Unicode letters differ from these ASCII ones, so patterns name them all.
INK, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


# --- The search -------------------------------------------------------------------


class Node:
    """An edit; ``refs`` counts its children and the survivors that end here."""

    __slots__ = ("parent", "edit", "depth", "refs", "kids")

    def __init__(self, parent: Node | None, edit: str):
        self.parent, self.edit, self.refs, self.kids = parent, edit, 0, []
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.refs += 1
            parent.kids.append(self)


def _before(a: Node, edit_a: str, b: Node, edit_b: str) -> bool:
    """Whether the path to ``a`` and then ``edit_a`` is less than the other."""
    left, right = [edit_a], [edit_b]
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.parent
        else:
            right.append(b.edit)
            b = b.parent
    return left[::-1] < right[::-1]


class Search:
    """The survivors from one entry state on; edits are ``letter + initial``.

    The initial is that of a message made up or given a new role, else ``-``.
    It follows from the letters before it, so comparing edits compares letters.
    """

    def __init__(self, entry: str = START):
        self.root = Node(None, "")
        self.root.refs = 1
        self.paths: dict[str, tuple[int, Node]] = {entry: (0, self.root)}
        self.final: list[str] = []

    def row(self, initial: str, fault: str) -> None:
        """Decides about one more row."""
        self.insertions()
        offers: dict[str, tuple[int, Node, str]] = {}
        for state, (cost, node) in self.paths.items():
            self._offer(offers, state, cost + COST[DELETE], node, DELETE + "-")
            if fault in (BLANK, DUPLICATE):
                continue
            cost += TRUNCATED_COST if fault == TRUNCATED else 0
            if initial in FOLLOWS[state]:
                self._offer(offers, FOLLOWS[state][initial], cost, node, KEEP + "-")
            made, after = MADE[state]
            self._offer(offers, after, cost + COST[REROLE], node, REROLE + made)
        if ANSWER in offers:
            answered = offers[ANSWER][0]
            for state, most in HOPELESS.items():
                if state in offers and offers[state][0] > answered + most:
                    del offers[state]
        self._replace({s: (cost, Node(node, edit)) for s, (cost, node, edit) in offers.items()})
        self._give_out()

    def insertions(self) -> None:
        """Lets each survivor put in messages, where that is the best way."""
        settled: dict[str, tuple[int, Node]] = {}
        offers = {s: (cost, node, "") for s, (cost, node) in self.paths.items()}
        while offers:
            state = min(offers, key=lambda s: offers[s][0])
            cost, node, edit = offers.pop(state)
            settled[state] = (cost, Node(node, edit) if edit else node)
            made, after = MADE[state]
            if after not in settled:
                self._offer(offers, after, cost + COST[INSERT], settled[state][1], INSERT + made)
        self._replace(settled)

    def ends(self) -> dict[str, tuple[int, str]]:
        """Cost and the edits not given out yet, for each state."""
        return {s: (cost, "".join(self._open(node))) for s, (cost, node) in self.paths.items()}

    def _open(self, node: Node) -> list[str]:
        edits = []
        while node is not self.root:
            edits.append(node.edit)
            node = node.parent
        return edits[::-1]

    @staticmethod
    def _offer(offers: dict, state: str, cost: int, node: Node, edit: str) -> None:
        old = offers.get(state)
        if old is not None and old[0] <= cost:
            if old[0] < cost:
                return
            # An offer without an edit is the node itself.
            known, last = (old[1], old[2]) if old[2] else (old[1].parent, old[1].edit)
            if known is None or not _before(node, edit, known, last):
                return
        offers[state] = (cost, node, edit)

    def _replace(self, paths: dict[str, tuple[int, Node]]) -> None:
        """New survivors; edits that only older ones needed are freed."""
        for _, node in paths.values():
            node.refs += 1
        for _, node in self.paths.values():
            node.refs -= 1
            while node.refs == 0 and node.parent is not None:
                parent = node.parent
                parent.kids.remove(node)
                parent.refs -= 1
                node.parent = None
                node = parent
        self.paths = paths

    def _give_out(self) -> None:
        """Moves the root down to the survivors' last common edit."""
        while self.root.refs == 1 and self.root.kids:
            self.root = self.root.kids[0]
            self.root.parent = None
            self.final.append(self.root.edit)

    def taken(self) -> str:
        """The edits given out since this was last asked."""
        edits, self.final = "".join(self.final), []
        return edits


class Joined:
    """Survivors over segments whose results are known for every entry."""

    def __init__(self):
        self.paths: dict[str, tuple[int, str]] = {START: (0, "")}

    def segment(self, results: dict[str, tuple[str, dict[str, tuple[int, str]]]]) -> str:
        """One more segment, ``entry: (edits, ends)``; the edits now final."""
        best: dict[str, tuple[int, str]] = {}
        for entry, (cost, edits) in self.paths.items():
            first, ends = results[entry]
            for state, (more, last) in ends.items():
                offer = (cost + more, edits + first + last)
                best[state] = min(best.get(state, offer), offer)
        shared = commonprefix([edits for _, edits in best.values()])
        shared = shared[: len(shared) // 2 * 2]
        self.paths = {s: (cost, edits[len(shared) :]) for s, (cost, edits) in best.items()}
        return shared

    def end(self) -> tuple[int, str]:
        """The cost of the best sound end, and its open edits."""
        offers = dict(self.paths)
        for _ in FOLLOWS:  # a chain of insertions passes three states at most
            for s, (cost, edits) in list(offers.items()):
                made, after = MADE[s]
                offer = (cost + COST[INSERT], edits + INSERT + made)
                offers[after] = min(offers.get(after, offer), offer)
        return min(offers[s] for s in SOUND if s in offers)


def solve(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Cost and edits of a whole conversation of ``(initial, fault)``."""
    search = Search()
    for initial, fault in rows:
        search.row(initial, fault)
    joined = Joined()
    given = joined.segment({START: (search.taken(), search.ends())})
    cost, rest = joined.end()
    return cost, given + rest


# --- Faults -----------------------------------------------------------------------


@dataclass(frozen=True)
class Columns:
    conv: str = "conv_id"
    turn: str = "turn"
    role: str = "role"
    text: str = "text"


def _clean(rows: DataFrame, names: Columns) -> DataFrame:
    """``conv, turn, role, text, mark``; a null role or text is one blank.

    ``mark`` is the digest of conversation, role and text.
    """
    conv = F.col(names.conv).cast("string")
    conv = F.coalesce(F.concat(F.lit("="), conv), F.lit(""))
    return rows.select(
        F.col(names.conv).alias("conv"),
        F.col(names.turn).alias("turn"),
        F.coalesce(F.col(names.role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(names.text), F.lit(" ")).alias("text"),
        conv.alias("_key"),
    ).select(
        "conv", "turn", "role", "text",
        F.unhex(F.sha2(F.concat_ws(
            ":", F.length("_key"), "_key", F.length("role"), "role", "text"), 256)).alias("mark"),
    )


def _along(conv: Column, turn: Column) -> Column:
    """A number that never falls along ``slot, turn``, to balance ranges."""
    size = F.log2(1 + F.abs(turn.cast("double"))) * F.signum(turn.cast("double"))
    return F.col("slot") + F.coalesce(0.5 + size / 256, F.lit(0.0))


def faults(rows: DataFrame, names: Columns = Columns()) -> DataFrame:
    """``pos, conv, turn, mark, initial, fault``: every row, numbered.

    Numbers run from 0 along conversations, there by turn (nulls first), role
    and digest of the text. A row is blank, or repeats the role and text of a
    row before it, or ends without a mark, in this order; else ``fault`` is
    empty. Rows equal in all columns are counted before they are shuffled.
    """
    text = F.col("text")
    kinds = _clean(rows, names).select(
        "conv", "turn", "role", "mark",
        F.substring("role", 1, 1).alias("initial"),
        F.when(~text.rlike(INK), BLANK).when(~text.rlike(ENDED), TRUNCATED)
        .otherwise("").alias("kind"),
    )
    # Conversations lie in the order of a hash, which any key type has.
    slot = F.pmod(F.xxhash64("conv"), F.lit(1 << 20))
    light = kinds.groupBy(*kinds.columns).agg(F.count("*").alias("copies"))
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")
    light = write_through(light.select(slot.alias("slot"), *kinds.columns, copy), "turns")
    order = ["slot", "conv", "turn", "role", "mark", "copy"]
    numbered = number_rows(light, order, _along(F.col("conv"), F.col("turn")), "pos")
    numbered = numbered.withColumn("pos", F.col("pos").cast("bigint") - 1)
    numbered = write_through(numbered.drop("slot", "role", "copy"), "numbered-turns")
    first = numbered.groupBy("mark").agg(F.min("pos").alias("first"))
    repeated = (F.col("kind") != BLANK) & (F.col("pos") > F.col("first"))
    fault = F.when(repeated, DUPLICATE).otherwise(F.col("kind")).alias("fault")
    found = numbered.join(first, "mark").select("pos", "conv", "turn", "mark", "initial", fault)
    return write_through(found, "faults")


# --- Edits ------------------------------------------------------------------------

EDIT = "struct<step: bigint, pos: bigint, edit: string, initial: string>"
_ENDS = "array<struct<state: string, cost: bigint, edits: string>>"
_PIECE = (
    "seg bigint, first bigint, head string, tail string, illegal bigint, cost bigint, "
    f"given string, results array<struct<entry: string, edits: string, ends: {_ENDS}>>"
)
_PART = f"cost bigint, illegal bigint, step bigint, edits array<{EDIT}>"


class _Piece:
    """The rows of a conversation in one segment, and the searches over them."""

    def __init__(self, conv, pos: int, size: int):
        self.conv, self.first, self.size = conv, pos, size
        # Only at the start of a segment may rows before it be elsewhere.
        entries = FOLLOWS if pos % size == 0 else [START]
        self.searches = {entry: Search(entry) for entry in entries}
        self.head = self.tail = None
        self.illegal = 0
        self.given = {entry: [] for entry in self.searches}

    def row(self, initial: str, fault: str) -> None:
        if self.head is None:
            self.head = initial
        elif self.tail + initial not in LEGAL:
            self.illegal += 1
        self.tail = initial
        for search in self.searches.values():
            search.row(initial, fault)

    def result(self, last: int) -> tuple:
        """A row of ``_PIECE``; ``last`` is the number of the last row here."""
        results = {e: (s.taken(), s.ends()) for e, s in self.searches.items()}
        cost = given = None
        if self.first % self.size and (last + 1) % self.size:  # all of it is here
            joined = Joined()
            given = joined.segment(results)
            cost, rest = joined.end()
            given, results = given + rest, {}
        listed = [
            {"entry": e, "edits": edits,
             "ends": [{"state": s, "cost": c, "edits": x} for s, (c, x) in ends.items()]}
            for e, (edits, ends) in results.items()
        ]
        return (self.conv, self.first // self.size, self.first, self.head, self.tail,
                self.illegal, cost, given, listed)


def _numbered_edits(given: str, step: int, pos: int) -> tuple[list[dict], int, int]:
    """Edits as rows of ``EDIT``, and the step and row that come next."""
    edits = []
    for k in range(0, len(given), 2):
        inserted = given[k] == INSERT
        edits.append({"step": step, "pos": None if inserted else pos, "edit": given[k],
                      "initial": given[k + 1]})
        step, pos = step + 1, pos + (not inserted)
    return edits, step, pos


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 512):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _record(held, schema)
            held = []
    if held:
        yield _record(held, schema)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def edits(found: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``conv, cost, illegal, step, edits`` of rows from :func:`faults`.

    One row holds some consecutive edits of a conversation, from edit number
    ``step`` on; its cost and its pairs out of order are sums over these rows.
    An edit has the number of its row, none if inserted, and the initial of
    a role that it gives.
    """
    conv = StructField("conv", found.schema["conv"].dataType)
    piece = StructType([conv, *StructType.fromDDL(_PIECE).fields])
    part = StructType([conv, *StructType.fromDDL(_PART).fields])
    piece_arrow, part_arrow = to_arrow_schema(piece), to_arrow_schema(part)

    def pieces(batches) -> Iterator[tuple]:
        own, last = None, -1
        for pos, conv, initial, fault in _rows(batches):
            apart = pos != last + 1 or pos % segment_rows == 0
            if own is None or apart or conv != own.conv:
                if own is not None:
                    yield own.result(last)
                own = _Piece(conv, pos, segment_rows)
            own.row(initial, fault)
            last = pos
        if own is not None:
            yield own.result(last)

    def parts(batches) -> Iterator[tuple]:
        joined, key, step, pos, tail = None, None, 0, 0, ""
        for conv, _, first, head, tail_, illegal, _, _, results in _rows(batches):
            if joined is not None and conv != key:
                cost, rest = joined.end()
                yield key, cost, 0, step, _numbered_edits(rest, step, pos)[0]
                joined = None
            if joined is None:
                joined, key, step, pos = Joined(), conv, 0, first
            elif tail + head not in LEGAL:
                illegal += 1
            tail = tail_
            given = joined.segment({
                r["entry"]: (r["edits"], {e["state"]: (e["cost"], e["edits"]) for e in r["ends"]})
                for r in results
            })
            listed, after, pos = _numbered_edits(given, step, pos)
            yield conv, 0, illegal, step, listed
            step = after
        if joined is not None:
            cost, rest = joined.end()
            yield key, cost, 0, step, _numbered_edits(rest, step, pos)[0]

    def whole(batches) -> Iterator[tuple]:
        for conv, _, first, _, _, illegal, cost, given, _ in _rows(batches):
            yield conv, cost, illegal, 0, _numbered_edits(given, 0, first)[0]

    segment = F.floor(F.col("pos") / segment_rows)
    dealt = found.withColumn("_seg", segment).repartition("_seg").sortWithinPartitions("pos")
    light = dealt.select("pos", "conv", "initial", "fault")
    solved = write_through(
        light.mapInArrow(lambda b: _batched(pieces(b), piece_arrow), piece), "pieces"
    )
    done = solved.where("cost is not null")
    done = done.mapInArrow(lambda b: _batched(whole(b), part_arrow), part)
    open_ = solved.where("cost is null").repartition("conv").sortWithinPartitions("conv", "seg")
    open_ = open_.mapInArrow(lambda b: _batched(parts(b), part_arrow), part)
    return write_through(done.unionByName(open_), "edits")


@dataclass(frozen=True)
class Repaired:
    """What was found and done: see :func:`faults` and :func:`edits`."""

    found: DataFrame
    parts: DataFrame
    rows: DataFrame
    names: Columns

    def edits(self) -> DataFrame:
        """``conv, step, pos, edit, initial``: every edit."""
        return self.parts.select("conv", F.explode("edits").alias("e")).select("conv", "e.*")

    def messages(self) -> DataFrame:
        """``conv, step, role, text``: the repaired conversations.

        A kept row repeats no other of its conversation, so its digest finds
        its text, whatever copies there are.
        """
        left = self.edits().where(F.col("edit") != DELETE)
        role = F.when(F.col("initial") == "u", ROLES["u"]).when(
            F.col("initial") == "a", ROLES["a"]
        )
        made = left.where(F.col("edit") == INSERT).select(
            "conv", "step", role.alias("role"), F.lit("").alias("text")
        )
        kept = left.where(F.col("edit") != INSERT).select("step", "pos", role.alias("new"))
        kept = kept.join(self.found.select("pos", "mark"), "pos")
        texts = _clean(self.rows, self.names).drop("turn").dropDuplicates(["mark"])
        kept = texts.join(kept, "mark").select(
            "conv", "step", F.coalesce("new", "role").alias("role"), "text"
        )
        return made.unionByName(kept)

    def summary(self) -> DataFrame:
        """A row for each conversation with rows: its faults, cost and audit.

        ``gaps`` counts turns missing between the first and the last.
        """
        by_turn = self.found.groupBy("conv", "turn").agg(
            *(F.count(F.when(F.col("fault") == f, 1)).alias(name) for f, name in
              ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated")))
        )
        # Each turn is one row now; null turns count for nothing.
        span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
        counts = by_turn.groupBy("conv").agg(
            F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"),
            *(F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")),
        )
        letters = F.array_join(F.transform("edits", lambda e: e["edit"]), "")
        ordered = F.array_sort(F.collect_list(F.struct("step", letters.alias("letters"))))
        audits = self.parts.groupBy(F.col("conv").alias("_conv")).agg(
            F.sum("illegal").alias("illegal"),
            F.sum("cost").alias("cost"),
            F.array_join(F.transform(ordered, lambda p: p["letters"]), "").alias("audit"),
        )
        return counts.join(audits, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")


def repair(
    rows: DataFrame, names: Columns = Columns(), segment_rows: int = SEGMENT_ROWS
) -> Repaired:
    """Finds faults and the cheapest edits that put every conversation right.

    Rows of one turn follow each other by role, then by their texts' digests.
    A null role or text counts as one blank; null turns come first; rows
    without id are a conversation of their own. Blank rows and repeated ones
    must go. Only the four named columns are read. An empty table gives
    empty results; a conversation that sound edits empty has no messages.
    """
    found = faults(rows, names)
    return Repaired(found, edits(found, segment_rows), rows, names)
