"""Approximate nearest neighbours along several Hilbert curves.

Vectors are projected to a few random directions, a set of them for each
curve, shifted by a random amount and numbered along a Hilbert curve. Spark
deals every curve's order by ranges of the key; a query is compared with the
rows within ``window`` places of its own key on each curve, and what the
curves find is merged and ranked by the inner product of the original vectors.

The largest inner product becomes the smallest distance by one more dimension
that brings all rows to one norm and is zero for queries.

How far a neighbour lies along its best curve depends on the data, so
``window`` is measured: a bounded number of queries is compared with all rows,
and the window is the smallest that reaches the wanted recall for them.

Equal vectors are one index entry that carries its smallest ids, as many as a
result can show: copies neither fill a window nor hide smaller ids.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textstyle.session import write_through

NEAREST = 20
CURVES, DIMENSIONS, BITS = 8, 6, 8
#: Recall that the measured window is to reach, and queries it is measured on.
RECALL, MEASURED = 0.95, 128
#: Least and most entries in one block of a curve, and the least window.
BLOCK, MOST_BLOCK, LEAST_WINDOW = 2048, 32_768, 256
#: Queries of a block that are multiplied at once, and pairs ranked at once.
CHUNK, PAIRS = 128, 65_536
#: Lists of found rows that are merged in one group, and their schema.
MERGED_LISTS = 32_768
FOUND = "entry bigint, score array<double>, id array<bigint>"
#: Entries of one range partition of a curve.
RANGE_ROWS = 100_000


# --- The curve --------------------------------------------------------------------


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of grid points, ``rows x dimensions``.

    From coordinates to the transposed index by the bitwise rotations and
    exchanges of Skilling (2004), then the bits of all dimensions in turn.
    """
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        low = q - one
        for i in range(n):
            flip = (x[i] & q) > 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        turn ^= np.where((x[n - 1] & q) > 0, q - one, np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.astype(np.int64)


def _directions(curve: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A curve's orthonormal directions and its shift in cells, from its number."""
    rng = np.random.default_rng([curve, width])
    basis = np.linalg.qr(rng.normal(size=(width, width)))[0][:, : min(DIMENSIONS, width)]
    return basis, rng.random(basis.shape[1])


def keys(vectors: np.ndarray, curve: int, norm: float) -> np.ndarray:
    """Places of vectors of one norm along a curve.

    A projection of a unit vector of ``width`` dimensions mostly lies within
    four times ``1 / sqrt(width)``; what lies beyond is moved to the border.
    """
    basis, shift = _directions(curve, vectors.shape[1])
    reach = norm * min(1.0, 4 / math.sqrt(vectors.shape[1]))
    cells = 1 << BITS
    at = (vectors @ basis / (2 * reach) + 0.5) * (cells - 2) + shift
    return hilbert(np.clip(at, 0, cells - 1).astype(np.int64), BITS)


# --- Preparation ------------------------------------------------------------------


def _usable(vector: Column) -> Column:
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of one width as a matrix in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _by_width(batch: pa.RecordBatch, name: str = "vector"):
    """``(rows, matrix)`` for each width of vector in a batch."""
    lengths = np.asarray(batch.column(name).value_lengths())
    for width in np.unique(lengths):
        rows = np.flatnonzero(lengths == width)
        yield rows, _vectors(batch.column(name).take(pa.array(rows)))


def entries(rows: DataFrame, is_query: Column, nearest: int) -> DataFrame:
    """One row for each distinct vector: ``entry, vector, ids, asked``.

    ``ids`` are its smallest ids, one more than a result shows, as a query
    leaves its own out; ``asked`` says that a query has this vector. A vector
    with very many rows is cut down in every partition before the shuffle.
    """
    rows = rows.select("id", "vector", is_query.alias("asked"), F.xxhash64("vector").alias("entry"))
    group = Window.partitionBy("entry", "vector").orderBy("id")
    first = rows.withColumn("_n", F.row_number().over(group)).where(F.col("_n") <= nearest + 1)
    asked = rows.where("asked").groupBy("entry", "vector").agg(F.lit(True).alias("asked"))
    held = first.groupBy("entry", "vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    held = held.join(asked, ["entry", "vector"], "left")
    return held.withColumn("asked", F.coalesce("asked", F.lit(False)))


# --- The search -------------------------------------------------------------------


def search(
    rows: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    nearest: int = NEAREST,
    window: int | None = None,
    recall: float = RECALL,
) -> DataFrame:
    """``query_id, rank, id, score``: each query's nearest rows but itself.

    Queries are the rows where ``is_query`` holds. Nearness is the inner
    product in double precision, ties go to the smaller id. Rows with a null
    id or whose vector is null, zero, or holds a null or non-finite value take
    no part, as query or candidate. Vectors are compared with those of their
    own width. Rows that repeat an id and vector count once; an id with
    several vectors is a row, and if asked a query, for each. Without a given
    ``window`` it is measured for ``recall``. An empty table gives no rows.
    """
    vector = F.col(vector_col)
    if rows.schema[vector_col].dataType.elementType.typeName() not in ("float", "double"):
        vector = vector.cast("array<double>")
    rows = rows.select(
        F.col(id_col).alias("id"),
        F.transform(vector, lambda x: x + F.lit(0).cast("float")).alias("vector"),  # no -0.0
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    ).where(F.col("id").isNotNull() & _usable(F.col("vector")))
    rows = rows.distinct()
    held = write_through(entries(rows, F.col("asked"), nearest), "entries")
    norms = held.agg(
        F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("m"),
        F.count("*").alias("n"),
        F.count_if("asked").alias("asked"),
    ).first()
    norm, n = math.sqrt(norms["m"] or 0.0), norms["n"]
    placed = _placed(held, norm, n)
    if window is None:
        window = measured_window(held, placed, nearest, recall)
    size = min(max(window, BLOCK), MOST_BLOCK)
    lists = norms["asked"] * CURVES * min(2 * window // size + 2, -(-n // size))
    found = _compared(placed, held, window, nearest, size)
    found = _merged(found, nearest, max(1, -(-lists // MERGED_LISTS)))
    asking = rows.where("asked").select(F.col("id").alias("query_id"), F.xxhash64("vector").alias("entry"))
    results = asking.join(found, "entry")
    others = F.filter("found", lambda x: x["id"] != F.col("query_id"))
    return results.select(
        "query_id", F.posexplode(F.slice(others, 1, nearest)).alias("rank", "x")
    ).select(
        "query_id", (F.col("rank") + 1).alias("rank"),
        F.col("x.id").alias(id_col), F.col("x.score").alias("score"),
    )


def _placed(held: DataFrame, norm: float, n: int) -> DataFrame:
    """``curve, place, asked, entry``: every entry's place on every curve.

    Index entries (``asked`` false) are numbered from 0 along each curve, by
    ranges of the key and the number of entries in each range; a query has the
    number of entries before its own key.
    """
    schema = "curve int, key bigint, asked boolean, entry bigint"

    def key_rows(batches):
        for batch in batches:
            for at, x in _by_width(batch):
                square = np.maximum(norm**2 - (x * x).sum(1), 0)
                lifted = np.hstack([x, np.sqrt(square)[:, None]])
                asked = np.asarray(batch.column("asked").take(pa.array(at)).to_numpy(zero_copy_only=False), bool)
                entry = batch.column("entry").take(pa.array(at)).to_numpy()
                length = np.sqrt((x[asked] ** 2).sum(1))[:, None]
                query = np.hstack([x[asked] / length * norm, np.zeros((asked.sum(), 1))])
                for curve in range(CURVES):
                    # Vectors of different widths never meet on a curve.
                    number = x.shape[1] * CURVES + curve
                    for points, who, flag in ((lifted, entry, False), (query, entry[asked], True)):
                        if len(who):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(who), number, np.int32)), pa.array(keys(points, curve, norm)),
                                 pa.array(np.full(len(who), flag)), pa.array(who)],
                                ["curve", "key", "asked", "entry"],
                            )

    order = ["curve", "key", "asked", "entry"]
    keyed = held.select("entry", "vector", "asked").mapInArrow(key_rows, schema)
    ranges = max(1, n * CURVES // RANGE_ROWS)
    dealt = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def count_rows(batches):
        task, before, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            curve = batch.column("curve").to_numpy()
            item = ~batch.column("asked").to_numpy(zero_copy_only=False)
            place = np.empty(len(curve), np.int64)
            for c in np.unique(curve):
                at = curve == c
                base = before if c == last else 0
                total = np.cumsum(item[at])
                place[at] = base + total - item[at]
                before, last = base + int(total[-1]), c
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(curve), task, np.int32)), batch.column("curve"), pa.array(place),
                 batch.column("asked"), batch.column("entry")],
                ["range", "curve", "place", "asked", "entry"],
            )

    counted = write_through(
        dealt.mapInArrow(count_rows, "range int, curve int, place bigint, asked boolean, entry bigint"),
        "curve-places",
    )
    sizes = counted.where("NOT asked").groupBy("curve", "range").agg(F.count("*").alias("k"))
    along = Window.partitionBy("curve").orderBy("range")
    # A range that holds queries only has all entries of earlier ranges before it.
    every = counted.select("curve", "range").distinct().join(sizes, ["curve", "range"], "left")
    ahead = F.sum(F.coalesce("k", F.lit(0))).over(along.rowsBetween(Window.unboundedPreceding, -1))
    bases = every.select("curve", "range", F.coalesce(ahead, F.lit(0)).alias("base"))
    return counted.join(bases, ["curve", "range"]).select(
        "curve", (F.col("place") + F.col("base")).alias("place"), "asked", "entry"
    )


def measured_window(held: DataFrame, placed: DataFrame, nearest: int, recall: float) -> int:
    """The least window that finds ``recall`` of the true neighbours.

    ``MEASURED`` queries, the first by hash, are compared with all entries; a
    true neighbour is found by a window as wide as its distance in places on
    the curve where it is closest.
    """
    asking = held.where("asked").orderBy("entry").limit(MEASURED).select("entry", "vector")
    sample = [(r["entry"], r["vector"]) for r in asking.collect()]
    if not sample:
        return LEAST_WINDOW
    sent = held.sparkSession.sparkContext.broadcast(sample)
    schema = "query bigint, entry bigint, score double"

    def run(batches):
        for batch in batches:
            for at, x in _by_width(batch):
                own = [(e, v) for e, v in sent.value if len(v) == x.shape[1]]
                if not own:
                    continue
                entry = batch.column("entry").take(pa.array(at)).to_numpy()
                scores = np.array([v for _, v in own], np.float64) @ x.T
                keep = min(len(x), nearest + 1)
                top = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
                for (query, _), t, s in zip(own, top, scores):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(t), query)), pa.array(entry[t]), pa.array(s[t])],
                        ["query", "entry", "score"],
                    )

    # The own vector is near on every curve and would flatter the measure.
    found = held.select("entry", "vector").mapInArrow(run, schema).where("entry <> query")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    true = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= nearest)
    true = F.broadcast(true.select("query", "entry"))  # MEASURED x nearest rows
    at = placed.where("NOT asked").select("curve", "entry", F.col("place").alias("there"))
    here = placed.where("asked").select("curve", F.col("entry").alias("query"), "place")
    there = at.join(true, "entry")
    gaps = here.join(F.broadcast(there), ["curve", "query"])
    gaps = gaps.groupBy("query", "entry").agg(
        F.min(F.abs(F.col("place") - F.col("there"))).alias("gap")
    )
    gap = gaps.agg(F.percentile("gap", recall).alias("g")).first()["g"]
    return max(LEAST_WINDOW, math.ceil(gap or 0) + 1)


def _compared(
    placed: DataFrame, held: DataFrame, window: int, nearest: int, size: int
) -> DataFrame:
    """``entry, score, id``: what each query finds in each block that its window meets.

    A block holds at most ``size`` entries of a curve and the queries near it.
    """
    block = F.floor(F.col("place") / size)
    first = F.floor(F.greatest(F.col("place") - window, F.lit(0)) / size)
    last = F.floor((F.col("place") + window) / size)
    item = placed.where("NOT asked").select(
        "curve", block.alias("block"), "place", "asked", "entry"
    )
    query = placed.where("asked").select(
        "curve", F.explode(F.sequence(first, last)).alias("block"), "place", "asked", "entry"
    )
    rows = item.unionByName(query).join(held.select("entry", "vector", "ids"), "entry")
    ids = F.when(~F.col("asked"), F.col("ids"))
    rows = rows.select("curve", "block", "place", "asked", "entry", "vector", ids.alias("ids"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asked = table.column("asked").to_numpy()
        items, queries = (table.filter(pa.array(mask)).sort_by("place") for mask in (~asked, asked))
        out = [pa.table({"entry": pa.array([], pa.int64()), **_lists(*[np.empty(0, int)] * 3)})]
        if items.num_rows and queries.num_rows:
            x, q = (_matrix(k.column("vector").combine_chunks()) for k in (items, queries))
            held_ids = items.column("ids").combine_chunks()
            starts, counts = held_ids.offsets.to_numpy(), held_ids.value_lengths().to_numpy()
            values = held_ids.values.to_numpy()
            near, at = items.column("place").to_numpy(), queries.column("place").to_numpy()
            entry = queries.column("entry").to_numpy()
            for row, t, scores in _near(near, x, at, q, window, nearest + 1):
                # An item stands for each of its ids.
                each = np.repeat(np.arange(len(t)), counts[t])
                nth = np.arange(len(each)) - np.repeat(np.cumsum(counts[t]) - counts[t], counts[t])
                row, scores, own = row[each], scores[each], values[starts[t[each]] + nth]
                row, scores, own = _best(row, scores, own, nearest + 1)
                out.append(pa.table({"entry": entry[np.unique(row)], **_lists(row, scores, own)}))
        return pa.concat_tables(out)

    return rows.groupBy("curve", "block").applyInArrow(run, FOUND)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one width as a matrix in their own precision."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _near(near: np.ndarray, x: np.ndarray, at: np.ndarray, q: np.ndarray, window: int, keep: int):
    """Yields ``(query, item, score)``: pairs with each query's ``keep`` best items in its window.

    Places ``near`` of items and ``at`` of queries rise. Neighbouring queries
    meet nearly the same items, so they are multiplied together, scaled and in
    single precision; only pairs that may be among the best by the bound of the
    rounding errors are compared in double precision. A query's pairs come
    together, at times with more than ``keep`` items.
    """
    scaled = x / np.abs(x).max()
    norms = np.sqrt(np.einsum("ij,ij->i", scaled, scaled, dtype=np.float64))
    # Short items beside long ones would all lie within the error of these.
    kind = np.float32 if norms.max() <= 1000 * norms.min() else np.float64
    scaled = (scaled / norms.max()).astype(kind)
    error = 2 * (x.shape[1] + 8) * np.finfo(kind).eps
    lows, highs = np.searchsorted(near, at - window, "left"), np.searchsorted(near, at + window, "right")
    for c in range(0, len(q), CHUNK):
        low, high = lows[c : c + CHUNK], highs[c : c + CHUNK]
        start, end = low[0], high[-1]
        if end <= start:
            continue
        v = q[c : c + CHUNK].astype(np.float64)
        unit = v / np.abs(v).max(axis=1, keepdims=True)
        unit = (unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))).astype(kind)
        scores = unit @ scaled[start:end].T
        for s, a, b in zip(scores, low - start, high - start):
            s[:a] = s[b:] = -np.inf
        # The best of ``keep`` groups of columns are as many scores that count.
        width = scores.shape[1] // 32
        if width >= keep:
            tops = scores[:, : 32 * width].reshape(len(scores), 32, width).max(axis=1)
        else:
            tops = scores
        k = max(0, tops.shape[1] - keep)
        floor = np.partition(tops, k, axis=1)[:, k] - kind(error)
        floor = np.maximum(floor, np.finfo(kind).min)  # nothing from outside the window
        row, item = np.divmod(np.flatnonzero(scores >= floor[:, None]), scores.shape[1])
        exact = np.empty(len(row))
        for p in range(0, len(row), PAIRS):
            r, t = row[p : p + PAIRS], start + item[p : p + PAIRS]
            # Row sums go in one order, so equal vectors score alike in all blocks.
            exact[p : p + PAIRS] = (x[t].astype(np.float64) * v[r]).sum(axis=1)
        if len(row):
            yield c + row, start + item, exact


def _best(group: np.ndarray, scores: np.ndarray, ids: np.ndarray, keep: int):
    """The ``keep`` best distinct rows of every group, by group, falling score and rising id."""
    order = np.lexsort((ids, -scores, group))
    group, scores, ids = group[order], scores[order], ids[order]
    same = (group[1:] == group[:-1]) & (scores[1:] == scores[:-1]) & (ids[1:] == ids[:-1])
    if same.any():
        group, scores, ids = (a[np.r_[True, ~same]] for a in (group, scores, ids))
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    rank = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
    kept = rank < keep
    return group[kept], scores[kept], ids[kept]


def _lists(group: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> dict[str, pa.Array]:
    """Columns ``score`` and ``id`` with one list for each run of a group."""
    ends = np.flatnonzero(np.r_[group[1:] != group[:-1], True]) + 1 if len(group) else []
    offsets = pa.array(np.r_[0, ends].astype(np.int32))
    return {
        "score": pa.ListArray.from_arrays(offsets, pa.array(scores, pa.float64())),
        "id": pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int64())),
    }


def _merged(found: DataFrame, nearest: int, groups: int) -> DataFrame:
    """``entry, found``: the best over all curves and blocks, one more than shown.

    A query has a list for each block that its window meets; those of one
    query are merged in the same of ``groups`` groups.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        scores, ids = (table.column(c).combine_chunks() for c in ("score", "id"))
        entry = np.repeat(table.column("entry").to_numpy(), scores.value_lengths().to_numpy())
        entry, scores, ids = _best(
            entry, scores.flatten().to_numpy(), ids.flatten().to_numpy(), nearest + 1
        )
        return pa.table({"entry": pa.array(np.unique(entry)), **_lists(entry, scores, ids)})

    grouped = found.groupBy(F.pmod("entry", F.lit(groups)).alias("_group"))
    return grouped.applyInArrow(run, FOUND).select("entry", F.arrays_zip("id", "score").alias("found"))
