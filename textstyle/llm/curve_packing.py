"""Packing neighbours: documents in the order of a space-filling curve.

A document's token ids are hashed into a vector of signed, damped counts,
projected to a few directions and numbered along a Hilbert curve. Spark sorts
light rows (place, id, number of tokens) by ranges of the curve, so that every
document learns how many tokens lie before it. The stream of all tokens in
that order is cut every ``capacity`` tokens: a sequence holds documents that
are neighbours on the curve, a document is cut only where a sequence ends, and
no sequence needs padding. What is left at the end, shorter than a sequence,
is cut into lengths that are powers of two, which need none either.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType
from tokenizers import Tokenizer

from textstyle.llm.encoding import ID_BYTES, encode_all
from textstyle.llm.neighbours import hilbert
from textstyle.operators.ordering import range_count, range_cuts, range_slot
from textstyle.session import shared_folder

CAPACITY = 2048
#: Buckets of the hashed vector, directions it is projected to, bits of each.
BUCKETS, DIMENSIONS, BITS = 256, 4, 8
#: Documents of one place on the curve are spread over so many bits.
TIE_BITS = 20
#: Tokens whose vectors are counted at a time.
COUNTED_TOKENS = 1 << 20
#: Token numbers below this are kept in two bytes.
SHORT_IDS = 1 << 16


# --- The curve --------------------------------------------------------------------


def _hashed(ids: np.ndarray) -> np.ndarray:
    """Each id's bucket and sign in one number, by multiplication."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    buckets = (mixed >> np.uint64(40)) % np.uint64(BUCKETS)
    return (2 * buckets + (mixed >> np.uint64(63))).astype(np.int64)


@cache
def _short_cells() -> np.ndarray:
    """:func:`_hashed` of all short ids, made once a worker."""
    return _hashed(np.arange(SHORT_IDS))


@cache
def _basis() -> np.ndarray:
    """The directions that vectors are projected to."""
    rng = np.random.default_rng(BUCKETS)
    return np.linalg.qr(rng.normal(size=(BUCKETS, BUCKETS)))[0][:, :DIMENSIONS]


def vectors(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A unit vector for each of the documents whose ids follow each other.

    Signed counts of hashed ids, damped by a logarithm; a document whose
    counts cancel out, or without ids, has the zero vector.
    """
    short = not len(ids) or ids.max() < SHORT_IDS
    cells = _short_cells()[ids] if short else _hashed(ids)
    counts, first = np.empty((len(lengths), BUCKETS)), 0
    for row, n in zip(counts, lengths.tolist()):
        found = np.bincount(cells[first : first + n], minlength=2 * BUCKETS)
        np.subtract(found[1::2], found[::2], out=row)
        first += n
    damped = np.sign(counts) * np.log1p(np.abs(counts))
    norms = np.linalg.norm(damped, axis=1, keepdims=True)
    return damped / np.where(norms > 0, norms, 1.0)


def curve_keys(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of documents along the curve, ``DIMENSIONS * BITS`` bits each."""
    cells, reach = 1 << BITS, 4 / math.sqrt(BUCKETS)
    at = (vectors(ids, lengths) @ _basis() / (2 * reach) + 0.5) * cells
    return hilbert(np.clip(at, 0, cells - 1).astype(np.int64), BITS)


def _groups(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive documents of some ``COUNTED_TOKENS`` together."""
    first, held = 0, 0
    for i, n in enumerate(lengths):
        held += n
        if held >= COUNTED_TOKENS:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(lengths):
        yield first, len(lengths)


# --- Cutting ----------------------------------------------------------------------


def sequence_edges(tokens: int, capacity: int) -> list[int]:
    """Where the sequences behind the last full one start, and the end.

    The rest is cut by its binary digits, the longest first.
    """
    edges = [tokens - tokens % capacity]
    for bit in reversed(range(capacity.bit_length())):
        if tokens % capacity >> bit & 1:
            edges.append(edges[-1] + (1 << bit))
    return edges


def cut(
    start: int, length: int, edges: list[int], capacity: int
) -> Iterator[tuple[int, int, int, int]]:
    """``start, length, sequence, offset`` of the pieces of one document.

    ``start`` is the place of the document in the stream, that of a piece is
    its place in the document.
    """
    at, end, full = start, start + length, edges[0] // capacity
    while at < end:
        if at < edges[0]:
            sequence = at // capacity
            first, last = sequence * capacity, (sequence + 1) * capacity
        else:
            k = bisect_right(edges, at)
            sequence, first, last = full + k - 1, edges[k - 1], edges[k]
        stop = min(end, last)
        yield at - start, stop - at, sequence, at - first
        at = stop


# --- The job ----------------------------------------------------------------------


def encoded(
    docs: DataFrame, tokenizer: str, *, id_col: str, text_col: str, end_id: int
) -> DataFrame:
    """``row, id, key, n, ids``: a document's ids and its place on the curve.

    Ids take two bytes each where the tokenizer has no larger ones.
    """
    size = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    kind = "<u2" if size <= SHORT_IDS else "<u4"
    made = StructType.fromDDL("key bigint, n bigint, ids binary").fields
    id_field = StructField("id", docs.schema[id_col].dataType)
    schema = StructType([*StructType.fromDDL("row bigint").fields, id_field, *made])
    arrow = to_arrow_schema(schema)
    end = end_id.to_bytes(ID_BYTES, "little")

    def run(batches):
        for batch in batches:
            row, key, text = batch.columns
            ids = [np.frombuffer(x + end, "<u4") for x in encode_all(tokenizer, text)]
            lengths = np.array([len(x) for x in ids], np.int64)
            keys = np.zeros(len(ids), np.int64)
            for first, last in _groups(lengths):
                keys[first:last] = curve_keys(
                    np.concatenate(ids[first:last]), lengths[first:last]
                )
            kept = pa.array([x.astype(kind).tobytes() for x in ids], pa.binary())
            columns = [row, key, pa.array(keys), pa.array(lengths), kept]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(run, schema)


def starts(light: DataFrame) -> tuple[DataFrame, int]:
    """``row, start`` along the curve, and the number of all tokens.

    ``light`` has ``row, id, key, n``. Places are told apart within one key by
    a hash, so that copies of one document fall into many ranges; cut points
    from approximate quantiles only balance the work.
    """
    spread = F.pmod(F.xxhash64("id", "row"), F.lit(1 << TIE_BITS))
    placed = light.withColumn("place", F.col("key") * (1 << TIE_BITS) + spread)
    cuts = range_cuts(placed, "place", range_count(light.count()))
    placed = placed.withColumn("_range", range_slot(F.col("place").cast("double"), cuts))
    sizes = placed.groupBy("_range").agg(F.sum("n").alias("_n")).collect()  # a row a range
    total = sum(r["_n"] for r in sizes)
    shift, before = {}, 0
    for r in sorted(sizes, key=lambda r: r["_range"]):
        shift[r["_range"]], before = before, before + r["_n"]
    shifts = light.sparkSession.createDataFrame(list(shift.items()), "_range int, _shift bigint")
    order = Window.partitionBy("_range").orderBy("place", "id", "row")
    within = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = placed.withColumn("_within", F.coalesce(within, F.lit(0)))
    numbered = numbered.join(F.broadcast(shifts), "_range")
    return numbered.select("row", (F.col("_within") + F.col("_shift")).alias("start")), total


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """Every piece of every document: its place in the document and the pack.

    Returns ``id_col, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and on request ``ids`` (little-endian unsigned 32-bit integers).
    ``capacity`` must be a power of two. A null or empty text is the end id
    alone. Repeated rows, and rows without id, are packed as often as they
    come; rows of one place on the curve follow each other in the order of a
    hash. An empty table gives no rows. Only the id and the text are read, so
    further columns, whatever their names, do not matter.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"a capacity of {capacity} is no power of two")
    spark = docs.sparkSession
    path = shared_folder(spark, "encoded")
    held = encoded(docs, tokenizer, id_col=id_col, text_col=text_col, end_id=end_id)
    held.write.option("compression", "zstd").parquet(path)
    held = spark.read.schema(held.schema).parquet(path)
    placed, tokens = starts(held.select("row", "id", "key", "n"))
    edges = sequence_edges(tokens, capacity)

    size = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    kind = "<u2" if size <= SHORT_IDS else "<u4"
    made = (
        "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    ) + (", ids binary" if keep_ids else "")
    id_field = StructField(id_col, docs.schema[id_col].dataType)
    schema = StructType([id_field, *StructType.fromDDL(made).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = [[] for _ in schema]
            for key, begin, ids in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, kind).astype("<u4")
                for start, n, sequence, offset in cut(begin, len(ids), edges, capacity):
                    own = ids[start : start + n].tobytes()
                    row = (key, start, n, zlib.crc32(own), len(ids), sequence, offset, own)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow
            )

    return held.select("row", "id", "ids").join(placed, "row").select(
        "id", "start", "ids"
    ).mapInArrow(run, schema)
