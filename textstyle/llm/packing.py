"""Best-fit-decreasing packing of token pieces into sequences of equal capacity.

Pieces of one length are interchangeable, so the plan is made from the number
of pieces of each length, a table of at most ``capacity`` rows whatever the
corpus holds. It places lengths from the longest down; a segment tree over
remaining capacities gives the tightest open sequence in logarithmic time, and
sequences with equal room are filled together, as many as the length needs.
The result is that of placing piece by piece. Pieces then find their place by
their rank within their length, which Spark counts in slices.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from textstyle.llm.encoding import ID_BYTES, encode_all
from textstyle.session import write_through

CAPACITY = 2048
#: Pieces that are ranked in one slice.
SLICE_ROWS = 20_000


# --- The plan ---------------------------------------------------------------------


class RoomTree:
    """Which remaining capacities have open sequences, as a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, room: int, sequences: int) -> None:
        node = room + self.leaves
        while node:
            self.open[node] += sequences
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest room of at least ``length`` with an open sequence."""
        node = length + self.leaves
        if self.open[node]:
            return length
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


@dataclass
class Plan:
    """Runs of pieces: from ``rank`` on, ``each`` pieces to a sequence.

    The number of runs depends on how many lengths and rooms occur, both at
    most the capacity, not on how many pieces there are.
    """

    capacity: int
    sequences: int = 0
    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)

    def add(self, length, rank, each, sequence, offset) -> None:
        for column, value in zip(
            (self.length, self.rank, self.each, self.sequence, self.offset),
            (length, rank, each, sequence, offset),
        ):
            column.append(value)


def best_fit_plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> Plan:
    """Places ``counts[length]`` pieces of each length, longest first."""
    plan, tree = Plan(capacity), RoomTree(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}

    def put(room: int, sequence: int, n: int) -> None:
        tree.add(room, n)
        open_.setdefault(room, []).append((sequence, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        while left:
            room = tree.tightest(length)
            if room is None:
                room, n = capacity, -(-left // (capacity // length))
                sequence, plan.sequences = plan.sequences, plan.sequences + n
            else:
                sequence, n = open_[room].pop()
                tree.add(room, -n)
            each = room // length
            full = min(n, left // each)
            if full:
                plan.add(length, rank, each, sequence, capacity - room)
                put(room - each * length, sequence, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # fewer than fill one sequence
                plan.add(length, rank, left, sequence + full, capacity - room)
                put(room - left * length, sequence + full, 1)
                full, left = full + 1, 0
            if full < n:
                put(room, sequence + full, n - full)
    return plan


# --- The pieces -------------------------------------------------------------------


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of a document's pieces; the first may be shorter."""
    start = 0
    while start < n:
        length = (n - start) % capacity or capacity
        yield start, length
        start += length


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """Every document's ids, then ``end_id``, cut into pieces; no shuffle.

    A null or empty text is the end id alone. ``ids`` are little-endian
    unsigned 32-bit integers, kept on request.
    """
    kind = StructField(id_col, docs.schema[id_col].dataType)
    made = "piece int, start bigint, length bigint, ids_crc32 bigint"
    made += ", ids binary" if keep_ids else ""
    schema = StructType([kind] + StructType.fromDDL(made).fields)
    arrow = to_arrow_schema(schema)
    end = end_id.to_bytes(ID_BYTES, "little")

    def run(batches):
        for batch in batches:
            out = [[] for _ in schema]
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for key, ids in zip(keys, encode_all(tokenizer, texts)):
                ids += end
                for k, (start, n) in enumerate(cut(len(ids) // ID_BYTES, capacity)):
                    own = ids[start * ID_BYTES : (start + n) * ID_BYTES]
                    row = (key, k, start, n, zlib.crc32(own), own)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """Places every piece of every document: adds ``sequence_id, offset``.

    Repeated rows are packed as often as they come; ties in length fall by id,
    piece and content, and rows that tie there too are interchangeable. An
    empty table gives no rows. Only the id and the text are read, so further
    columns do not matter; a null id is kept.
    """
    pieces = write_through(
        token_pieces(
            docs, tokenizer, id_col=id_col, text_col=text_col, end_id=end_id,
            capacity=capacity, keep_ids=keep_ids,
        ),
        "pieces",
    )
    lengths = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    counts = {r["length"]: r["n"] for r in lengths}  # at most capacity rows
    plan = best_fit_plan(counts, capacity)
    return place(_ranked(pieces, id_col, sum(counts.values())), plan)


def _ranked(pieces: DataFrame, id_col: str, n: int) -> DataFrame:
    """Adds ``_rank``: numbers from 0 within each length, counted in slices."""
    slices = max(1, n // SLICE_ROWS)
    cut_ = F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(slices)).cast("int")
    pieces = pieces.withColumn("_slice", cut_)
    group = Window.partitionBy("length", "_slice")
    local = F.row_number().over(group.orderBy(id_col, "piece", "ids_crc32")) - 1
    along = Window.partitionBy("length").orderBy("_slice")
    before = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1))
    sizes = pieces.groupBy("length", "_slice").agg(F.count("*").alias("_n"))
    starts = sizes.select("length", "_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    ranked = pieces.withColumn("_local", local).join(starts, ["length", "_slice"])
    return ranked.withColumn("_rank", F.col("_before") + F.col("_local")).drop(
        "_slice", "_local", "_before"
    )


def place(ranked: DataFrame, plan: Plan) -> DataFrame:
    """Looks each piece's run up by length and rank."""
    kept = [f for f in ranked.schema if f.name != "_rank"]
    made = StructType.fromDDL("sequence_id bigint, offset bigint")
    schema = StructType(kept + made.fields)
    columns = [np.array(c, np.int64) for c in
               (plan.length, plan.rank, plan.each, plan.sequence, plan.offset)]
    order = np.lexsort((columns[1], columns[0]))
    sent = ranked.sparkSession.sparkContext.broadcast([c[order] for c in columns])

    def run(frames):
        length, rank, each, sequence, offset = sent.value
        lengths, first = np.unique(length, return_index=True)
        last = np.append(first[1:], len(length))
        for frame in frames:
            own, r = frame["length"].to_numpy(np.int64), frame.pop("_rank").to_numpy(np.int64)
            at = np.empty(len(frame), np.int64)
            for value in np.unique(own):
                k = np.searchsorted(lengths, value)
                here = own == value
                runs = rank[first[k] : last[k]]
                at[here] = first[k] + np.searchsorted(runs, r[here], "right") - 1
            into = r - rank[at]
            frame["sequence_id"] = sequence[at] + into // each[at]
            frame["offset"] = offset[at] + into % each[at] * own
            yield frame

    return ranked.select(*[f.name for f in kept], "_rank").mapInPandas(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the packed ids of each sequence.

    ``packed`` must have kept its ids; a sequence has at most ``capacity``.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), joined.alias("ids")
    )


def ids_of(binary: bytes) -> pd.Series:
    return pd.Series(np.frombuffer(binary, "<u4"))
