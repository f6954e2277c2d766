"""N-gram Jaccard join: classes of documents whose shingle sets overlap enough.

1. Every document becomes a set of hashed shingles; equal sets are one class.
2. Candidates: two sets that reach the threshold differ in at most ``d``
   shingles. Shingles are dealt by hash to ``d + 1 + s`` parts, so at least
   ``s + 1`` parts are equal; the content of a part is one signature, and a set
   leaves out the ``s`` parts with the fewest rare shingles, of these the
   smallest. Sets that share a signature are joined to one cluster, by a star a
   signature. Common lines seldom join clusters, as a part of their shingles
   alone is left out; sets that consist mostly of common passages may.
3. T-occurrence search in each cluster by DivideSkip: an inverted index, the
   shortest lists merged with a heap, the long ones probed by binary search, and
   the sets kept that reach the overlap their sizes require. Links between sets that
   are connected already need no test.
4. A cluster beyond ``BLOCK_SETS`` or ``BLOCK_SHINGLES`` is searched in blocks
   that all hold the same pivots. What joins the largest component there needs
   no further search; every other set asks the other blocks. Sets that link
   share one of the rarest shingles of both (the prefix filter) and have
   similar sizes. Blocks hold sets of a band of sizes, and a set asks only
   those of its own and the next bands that hold a set with one of its
   rarest shingles.

No step drops or caps anything: blocks bound memory, not results. Shingles and
sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from textstyle.llm.components import components
from textstyle.llm.tables import in_slices, raw_texts
from textstyle.session import delete_folders, write_through

SHINGLE_WORDS = 3
#: Links need ``100 * shared >= PERCENT * union``.
PERCENT = 90
#: Sets and shingles in one block of the search.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1 << 21
PIVOTS = 8
#: Blocks of one band of sizes are numbered from a multiple of this.
BAND_BLOCKS = 1 << 32
#: Shingles are counted by slots of a hash, to tell rare ones from common ones.
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
#: Slots whose counts travel together.
SLOT_BLOCK = 1 << 12
#: Deviations of an even spread over the slots from which a slot is common.
COMMON_SIGMAS = 5
#: Bytes of sets, and sets, that a task passes on at a time.
SENT_BYTES, SENT_SETS = 4 << 20, 512
#: Members are sent to the scan of the documents up to this size.
BROADCAST_BYTES = 64 << 20
#: Hashes of sets that a task remembers; only speed depends on it.
MET_SETS = 100_000
#: Words in each of a worker's two hash tables; only speed depends on it.
CACHED_WORDS = 100_000

_A, _B, _C = (np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SHIFT = np.uint64(29)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _SHIFT)) * _B
    return (x ^ (x >> _SHIFT)) * _C


class _Words(dict):
    """Word -> 64-bit hash; full tables are set aside, and met words move back."""

    old: dict = {}

    def __missing__(self, word: bytes) -> int:
        value = self.old.get(word)
        if value is None:
            value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def trim(self) -> None:
        if len(self) > CACHED_WORDS:
            self.old = dict(self)
            self.clear()


_WORDS = _Words()


def shingles(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct shingles of a text, as hashes.

    A-Z count as lower case, words are separated by white space; fewer words
    than ``size`` are one shingle as a whole, none give an empty set.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    _WORDS.trim()
    hashed = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mix(out * _A + hashed[k : len(words) - size + 1 + k])
    return np.unique(out)


# --- Signatures --------------------------------------------------------------------


def required(a, b, percent: int = PERCENT):
    """The least overlap of sets of sizes ``a`` and ``b`` that link."""
    return -(-percent * (a + b) // (100 + percent))


def _band(n: int, percent: int) -> tuple[int, int]:
    """Number and largest size of the band of sizes that holds ``n``.

    Sizes that may link are in one band or in neighbouring ones.
    """
    number, top = 0, 1
    while top < n:
        number, top = number + 1, max(top + 1, 100 * (top + 1) // percent)
    return number, top


def signatures(
    found: np.ndarray, percent: int = PERCENT, common: np.ndarray | None = None
) -> np.ndarray:
    """Signatures of a set: of the parts of its own band and of the next.

    ``common`` tells for every slot whether its shingles count as common. Any
    table serves, if all sets have the same.
    """
    n = len(found)
    if n == 0 or required(n, n + 1, percent) > n and required(n - 1, n, percent) > n - 1:
        return np.empty(0, np.uint64)  # only an equal set can link
    number, top = _band(n, percent)
    rare = np.ones(n, bool) if common is None else ~common[_slots(found)]
    dealt, mixed, out = _mix(found) >> np.uint64(8), _mix(found ^ _A), []
    for band, limit in ((number, top), (number + 1, max(top + 1, 100 * (top + 1) // percent))):
        # No linked pair of sizes up to ``limit`` differs by more.
        most = 2 * limit * (100 - percent) // (100 + percent)
        spare = most // 3 + 1
        parts = most + 1 + spare
        part = (dealt % np.uint64(parts)).astype(np.int64)
        # Numbers of 16 bits are sorted faster.
        order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
        size, kept = (np.bincount(x, minlength=parts) for x in (part, part[rare]))
        filled = np.flatnonzero(size)
        starts = (np.cumsum(size) - size)[filled]
        content = np.zeros(parts, np.uint64)
        content[filled] = np.add.reduceat(mixed[order], starts)
        # Linked sets have spare + 1 equal parts. Both sets order those alike,
        # so neither drops the last of them with its ``spare`` first parts.
        own = np.lexsort((size, kept))[spare:]
        content, own = content[own], own.astype(np.uint64)
        out.append(_mix(content + _mix(own + np.uint64(band << 32))))
    return np.concatenate(out)


# --- DivideSkip --------------------------------------------------------------------


class SkipIndex:
    """Inverted lists of a block of sets."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.percent, self.sizes = percent, np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.lists = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.tokens, self.starts = np.unique(tokens[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(tokens))

    def search(self, query: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """The allowed sets that link with ``query``."""
        n, percent = len(query), self.percent
        at = np.searchsorted(self.tokens, query)
        inside = at < len(self.tokens)
        at = at[inside][self.tokens[at[inside]] == query[inside]]
        smallest = -(-percent * n // 100)
        least = int(required(n, smallest, percent))
        if len(at) < least:
            return np.empty(0, np.int64)
        lengths = self.ends[at] - self.starts[at]
        at = at[np.argsort(lengths, kind="stable")]
        # The number of long lists that balances merging against probing.
        n_long = int(least / (0.0085 * np.log2(max(2, lengths.max())) + 1))
        n_long = max(0, min(n_long, least - 1))
        short, long = at[: len(at) - n_long], at[len(at) - n_long :]
        lists = [self.lists[self.starts[k] : self.ends[k]] for k in short]
        found, counts = _merged([x[allowed[x]].tolist() for x in lists], least - n_long)
        need = required(n, self.sizes[found], percent)
        for left, k in zip(range(len(long), 0, -1), long):
            alive = counts + left >= need
            if not alive.all():
                found, counts, need = found[alive], counts[alive], need[alive]
            if not len(found):
                break
            inverted = self.lists[self.starts[k] : self.ends[k]]
            place = np.searchsorted(inverted, found)
            counts = counts + (inverted[np.minimum(place, len(inverted) - 1)] == found)
        return found[counts >= need]


def _merged(lists: list[list[int]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets on at least ``least`` of some ascending lists, and on how many.

    A heap holds the head of each list, so equal numbers come out together.
    """
    runs = ((x, sum(1 for _ in same)) for x, same in groupby(heapq.merge(*lists)))
    kept = [(x, n) for x, n in runs if n >= least]
    return np.array([x for x, _ in kept], np.int64), np.array([n for _, n in kept], np.int64)


def forest(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple]:
    """Links ``(i, j)`` that connect what all links connect."""
    index, group = SkipIndex(sets, percent), np.arange(len(sets))
    links = []
    for i in range(len(sets)):
        # Sets already in one component with the query need no test.
        for j in index.search(sets[i], group != group[i]):
            if group[j] != group[i]:
                links.append((int(i), int(j)))
                group[group == group[j]] = group[i]
    return links


def forest_across(sets, roots, others, other_roots, percent: int = PERCENT) -> list[tuple]:
    """Links ``(i, j)`` from ``sets`` to ``others`` that connect what all such
    links connect, beyond what equal roots say."""
    index = SkipIndex(others, percent)
    group = np.unique([*roots, *other_roots], return_inverse=True)[1]
    n, links = len(sets), []
    for i in range(n):
        for j in index.search(sets[i], group[n:] != group[i]):
            if group[n + j] != group[i]:
                links.append((i, int(j)))
                group[group == group[n + j]] = group[i]
    return links


# --- The join ----------------------------------------------------------------------


def near_classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    block_sets: int = BLOCK_SETS,
    paths: list[str] | None = None,
) -> DataFrame:
    """``id, n_shingles, component_id`` of every row of ``docs``.

    ``component_id`` is the least id that a chain of links reaches, the row's
    own included. A text that is null or has no words has no shingles and no
    links. Rows with one id and different texts are each judged by their own
    text; a row without id takes part and may have the id of others. Columns
    besides id and text are not read. An empty table gives no rows.

    The folders of the tables that the result reads are added to ``paths``,
    for callers that delete them; all others are deleted here.
    """
    spark, paths, scratch = docs.sparkSession, [] if paths is None else paths, []
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    common = _common_slots(docs, words)
    signed = write_through(_sets(docs, words, percent, common), "signatures", scratch)
    sets = write_through(signed.select("id", "n", "h"), "shingle-sets", paths)
    classes = sets.where("n > 0").groupBy("h").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    classes = write_through(classes, "shingle-classes", paths)
    clusters: list[str] = []
    clustered = components(_stars(signed), paths=clusters)
    delete_folders(spark, scratch)
    links = _links(docs, classes, clustered, words, percent, block_sets, scratch)
    roots = components(links, paths=paths)
    delete_folders(spark, clusters + scratch)
    named = roots.join(classes.select(F.col("h").alias("node"), "id"), "node")
    least = named.groupBy("root").agg(F.min("id").alias("least"))
    of_root = roots.join(least, "root").select(F.col("node").alias("h"), "least")
    of_class = classes.join(of_root, "h", "left").select(
        "h", F.coalesce("least", "id").alias("component_id")
    )
    out = sets.select("id", "n", "h").join(of_class, "h", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def _common_slots(docs: DataFrame, words: int) -> np.ndarray:
    """Which slots hold shingles of many more rows than an even spread gives.

    Each task counts its rows in blocks of slots, which are then added up. The
    table only says which parts tell sets apart best; links do not hang on it.
    """

    def count(batches):
        total = np.zeros(SLOTS, np.uint32)
        for batch in in_slices(batches):
            sets = [shingles(text, words) for text in raw_texts(batch.column(0))]
            if sets:
                slots = _slots(np.concatenate(sets))
                total += np.bincount(slots, minlength=SLOTS).astype(np.uint32)
        blocks = total.reshape(-1, SLOT_BLOCK)
        held = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array([blocks[k].tobytes() for k in held], pa.binary())],
            ["block", "counts"],
        )

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros(SLOT_BLOCK, np.int64)
        for chunk in rows["counts"].chunks:
            for counts in chunk:
                total += np.frombuffer(counts.as_buffer(), np.uint32)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": [total.tobytes()]})

    made = "block int, counts binary"
    counted = docs.select("text").mapInArrow(count, made)
    added = counted.groupBy("block").applyInArrow(add, made).toArrow()  # SLOTS numbers at most
    total = np.zeros((SLOTS // SLOT_BLOCK, SLOT_BLOCK), np.int64)
    for block, counts in zip(added["block"].to_pylist(), added["counts"].to_pylist()):
        total[block] = np.frombuffer(counts, np.int64)
    usual = np.median(total)
    return (total > usual + COMMON_SIGMAS * math.sqrt(usual) + 2).ravel()


def _sets(
    docs: DataFrame, words: int, percent: int, common: np.ndarray | None = None
) -> DataFrame:
    """``id, n, h, signatures``: size and hash of each row's set."""
    sent = docs.sparkSession.sparkContext.broadcast(common)
    made = "n bigint, h bigint, signatures array<bigint>"
    schema = StructType([StructField("id", docs.schema["id"].dataType)])
    schema = StructType(schema.fields + StructType.fromDDL(made).fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        seen = set()
        for batch in in_slices(batches):
            n, h, parts = [], [], []
            if len(seen) > MET_SETS:
                seen.clear()
            for text in raw_texts(batch.column(1)):
                found = shingles(text, words)
                n.append(len(found))
                h.append(_set_hash(found))
                # Equal sets of a task send their signatures once, if the first is still known.
                parts.append(None if h[-1] in seen else signatures(found, percent, sent.value).view(np.int64))
                seen.add(h[-1])
            columns = [batch.column(0).cast(arrow.field(0).type), n, h, parts]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)],
                schema=arrow,
            )

    return docs.mapInArrow(run, schema)


def _set_hash(found: np.ndarray) -> int | None:
    if not len(found):
        return None
    total = np.add.reduce(_mix(found)) + np.uint64(len(found))
    return int(_mix(np.array([total]))[0].view(np.int64))


def _stars(sets: DataFrame) -> DataFrame:
    """Links from the first set with a signature to each other one with it."""
    rows = sets.where("n > 0").select("h", F.explode("signatures").alias("s"))
    # A signature stays in one partition, and sorting may spill.
    dealt = rows.repartition("s").sortWithinPartitions("s", "h")

    def run(batches):
        first, first_of, last = None, None, None
        for batch in batches:
            h, s = (batch.column(k).to_numpy() for k in range(2))
            if not len(h):
                continue
            new = np.ones(len(s), bool)
            new[1:] = s[1:] != s[:-1]
            new[0] = first_of is None or s[0] != first_of
            starts = np.flatnonzero(new)
            run_of = np.searchsorted(starts, np.arange(len(s)), "right") - 1
            heads = h[starts]
            centre = np.where(run_of >= 0, heads[np.maximum(run_of, 0)] if len(heads) else 0, first or 0)
            keep = h != centre
            same = np.zeros(len(h), bool)
            same[1:] = (h[1:] == h[:-1]) & ~new[1:]
            same[0] = not new[0] and h[0] == last
            keep &= ~same
            first = int(centre[-1])
            first_of, last = s[-1], h[-1]
            u, v = np.unique(np.stack([h[keep], centre[keep]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return dealt.mapInArrow(run, "u bigint, v bigint")


def _links(docs, classes, clusters, words, percent, block_sets, paths) -> DataFrame:
    """Tested links, as many as connect what is connected: ``u, v``."""
    members = clusters.select(F.col("node").alias("h"), F.col("root").alias("cluster"))
    members = members.join(classes, "h")

    def parts(*of: str) -> DataFrame:
        counted = members.groupBy(*of).agg(F.count("*").alias("k"), F.sum("n").alias("w"))
        need = F.greatest(F.ceil(F.col("k") / block_sets), F.ceil(F.col("w") / BLOCK_SHINGLES))
        return counted.select(*of, need.cast("int").alias("blocks"))

    # Sets that may link lie in one band of sizes or in neighbouring ones.
    width = 1.001 * math.log(100 / percent) if percent < 100 else 1.0
    members = members.withColumn("band", F.floor(F.log("n") / width).cast("int"))
    in_band = parts("cluster", "band").withColumnRenamed("blocks", "parts")
    members = members.join(parts("cluster"), "cluster").join(in_band, ["cluster", "band"])
    block = F.col("band") * BAND_BLOCKS + F.pmod(F.xxhash64("h"), F.col("parts"))
    block = F.when(F.col("blocks") > 1, block).otherwise(F.lit(0)).cast("bigint").alias("block")
    members = write_through(
        members.select("id", "h", "cluster", block, "blocks"), "members", paths
    )
    n = members.count()
    sent = F.broadcast(members) if n * 48 <= BROADCAST_BYTES else members
    found = _member_sets(docs.join(sent, "id"), words)
    # Sets that only rows without id have are found by their hash.
    nameless = sent.where("id IS NULL").drop("id")
    found = found.unionByName(
        _hashed_sets(docs.where("id IS NULL"), words).join(nameless, "h").select(found.columns)
    )
    tokens = write_through(found, "member-sets", paths)
    order = Window.partitionBy("cluster").orderBy("h")
    large = members.where("blocks > 1")
    pivots = large.withColumn("r", F.row_number().over(order)).where(F.col("r") <= PIVOTS)
    every = large.select("cluster", F.col("block").alias("to")).distinct()
    pivots = pivots.select("h", "cluster").join(every, "cluster").select("h", "to")
    own = tokens.select("cluster", "block", "h", "tokens")
    shared = tokens.join(pivots, "h").select("cluster", F.col("to").alias("block"), "h", "tokens")
    inside = write_through(_search(own.unionByName(shared), percent), "links", paths)
    if large.limit(1).count() == 0:
        return inside
    # In large clusters, all but the largest component ask other blocks.
    roots = components(inside, paths=paths).select(F.col("node").alias("h"), "root")
    placed = large.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    most = placed.groupBy("cluster", "root").agg(F.count("*").alias("k"))
    core = most.groupBy("cluster").agg(F.max_by("root", F.struct("k", "root")).alias("core"))
    placed = placed.join(core, "cluster").select(
        "h", "cluster", "block", "root", (F.col("root") != F.col("core")).alias("ask")
    )
    placed = write_through(placed, "placed", paths)
    held = tokens.where("blocks > 1").select("h", "tokens").join(placed, "h")
    held = write_through(held, "held-sets", paths)
    across = _search_across(held, _asked_blocks(held, percent, paths), block_sets, percent)
    return write_through(inside.unionByName(across), "links", paths)


def _asked_blocks(held: DataFrame, percent: int, paths: list[str]) -> DataFrame:
    """``cluster, h, to``: the blocks that may hold a link of an asking set.

    Shingles are ordered by how many sets of large clusters hold their slot,
    then by value. Of two sets that link, each has a shingle of the other among
    its first ones, as many as may be missing and one more: were there none,
    the set whose last such shingle comes first would miss all of its own.
    Any one order serves; rare first keeps common passages out.
    """
    slots = held.select("tokens").mapInArrow(_slot_counts, "slot int, k bigint")
    counts = slots.groupBy("slot").agg(F.sum("k").alias("k")).toArrow()  # at most SLOTS rows
    table = np.zeros(SLOTS, np.int64)
    table[counts["slot"].to_numpy()] = counts["k"].to_numpy()
    sent = held.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, SENT_SETS):
                part = batch.slice(k, SENT_SETS)
                keys = [
                    prefix(np.frombuffer(row, np.uint64), sent.value, percent).view(np.int64)
                    for row in part.column(0).to_pylist()
                ]
                at = pa.array(np.repeat(np.arange(len(keys)), [len(x) for x in keys]))
                columns = [c.take(at) for c in part.columns[1:]] + [pa.array(np.concatenate(keys))]
                yield pa.RecordBatch.from_arrays(columns, ["h", "cluster", "block", "ask", "token"])

    rows = held.select("tokens", "h", "cluster", "block", "ask").mapInArrow(
        run, "h bigint, cluster bigint, block bigint, ask boolean, token bigint"
    )
    rows = write_through(rows, "prefixes", paths)
    there = rows.select("cluster", "token", F.col("block").alias("to")).distinct()
    asking = rows.where("ask").select("cluster", "token", "h", "block")
    apart = F.floor(F.col("to") / BAND_BLOCKS) - F.floor(F.col("block") / BAND_BLOCKS)
    near = (F.abs(apart) <= 1) & (F.col("to") != F.col("block"))
    return asking.join(there, ["cluster", "token"]).where(near).select(
        "cluster", "h", "to"
    ).distinct()


def _slot_counts(batches):
    """How many sets of a partition hold each slot of shingles."""
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for row in batch.column(0).to_pylist():
            np.add.at(total, _slots(np.frombuffer(row, np.uint64)), 1)
    slot = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(slot, pa.int32()), pa.array(total[slot])], ["slot", "k"]
    )


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (_mix(tokens ^ _B) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def prefix(tokens: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, of which a link must share one."""
    n = len(tokens)
    most_missing = n - -(-percent * n // 100)
    order = np.lexsort((tokens, counts[_slots(tokens)]))
    return tokens[order[: most_missing + 1]]


def _search_across(held: DataFrame, asked: DataFrame, block_sets: int, percent: int) -> DataFrame:
    """Links of asking sets to the sets of the blocks they ask.

    The sets of a block are sent once for every ``block_sets`` that ask it, so
    a task holds two blocks at most.
    """
    n = asked.groupBy("cluster", "to").agg(F.count("*").alias("n"))
    n = n.select("cluster", "to", F.ceil(F.col("n") / block_sets).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("h", F.lit(1)), F.col("parts")).cast("int").alias("part")
    asking = asked.join(n, ["cluster", "to"]).select("h", "to", part)
    asking = held.join(asking, "h").select(
        "cluster", "to", "part", "h", "tokens", "root", F.lit(True).alias("first")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    there = held.withColumnRenamed("block", "to").join(n, ["cluster", "to"])
    there = there.select("cluster", "to", "h", "tokens", "root", every, F.lit(False).alias("first"))
    rows = asking.unionByName(there)

    def run(table: pa.Table) -> pa.Table:
        sides: tuple[dict, dict] = {}, {}
        for h, tokens, root, first in zip(
            *(table.column(c).to_pylist() for c in ("h", "tokens", "root", "first"))
        ):
            sides[first][h] = (np.frombuffer(tokens, np.uint64), root)
        links = []
        if all(sides):
            keys = [sorted(side) for side in sides]
            there, own = ([side[h] for h in k] for side, k in zip(sides, keys))
            pairs = forest_across(*zip(*own), *zip(*there), percent)
            links = [(keys[1][i], keys[0][j]) for i, j in pairs]
        u, v = ([link[k] for link in links] for k in (0, 1))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.groupBy("cluster", "to", "part").applyInArrow(run, "u bigint, v bigint")


def _member_sets(rows: DataFrame, words: int) -> DataFrame:
    """``h, cluster, block, blocks, tokens`` of rows whose set is a member's."""
    schema = StructType.fromDDL(
        "h bigint, cluster bigint, block bigint, blocks int, tokens binary"
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        seen = set()
        for batch in in_slices(batches):
            out, held = [], 0
            if len(seen) > MET_SETS:
                seen.clear()
            keys = [batch.column(k).to_pylist() for k in range(1, 5)]
            for text, h, *place in zip(raw_texts(batch.column(0)), *keys):
                found = shingles(text, words)
                if h not in seen and _set_hash(found) == h:
                    seen.add(h)
                    out.append((h, *place, found.tobytes()))
                    held += found.nbytes
                if held > SENT_BYTES:
                    yield record(out)
                    out, held = [], 0
            yield record(out)

    def record(rows):
        columns = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
        )

    return rows.select("text", "h", "cluster", "block", "blocks").mapInArrow(run, schema)


def _hashed_sets(rows: DataFrame, words: int) -> DataFrame:
    """``h, tokens`` of all rows with shingles; equal sets of a slice come once."""

    def run(batches):
        for batch in in_slices(batches):
            sets = (shingles(text, words) for text in raw_texts(batch.column(0)))
            out = {_set_hash(found): found.tobytes() for found in sets if len(found)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(out.keys(), pa.int64()), pa.array(out.values(), pa.binary())], ["h", "tokens"]
            )

    return rows.select("text").mapInArrow(run, "h bigint, tokens binary")


def _search(rows: DataFrame, percent: int) -> DataFrame:
    """Searches each block for links between its sets."""

    def run(table: pa.Table) -> pa.Table:
        best = {h: t for h, t in zip(*(table.column(c).to_pylist() for c in ("h", "tokens")))}
        keys = sorted(best)
        sets = [np.frombuffer(best[h], np.uint64) for h in keys]
        links = forest(sets, percent) if len(keys) > 1 else []
        u, v = ([keys[link[k]] for link in links] for k in (0, 1))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.groupBy("cluster", "block").applyInArrow(run, "u bigint, v bigint")
