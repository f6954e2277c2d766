"""Language-model scoring with a probabilistic suffix tree over words.

States are contexts of 0 to ``depth`` words. A context is kept where a test of
divergence says that what follows it differs from what follows its suffix;
next-word distributions are smoothed towards those of the suffix; every word
is scored from its longest kept context.

The corpus is never gathered anywhere. Documents are packed into blocks of
bounded size that hold word hashes; each level of the tree is one exchange:

* blocks count their own (context, next word) pairs and send them, packed, to
  the buckets that their contexts hash to;
* a bucket adds the counts of all blocks, tests its contexts, and answers each
  block for the pairs that this block sent;
* a block, joined with its answers, then knows all counts that its documents
  need, and no others. Level 0 does the same for single words.

Answers say which pairs no other block has. A longer context that starts with
such a pair is counted and tested in its block, and a pair that ends with one
needs no name in a message: its own count is the corpus's. A context with more
than ``hot`` occurrences, which every block knows from the level before, is
dealt to several buckets by its next words. They report how many next words
have each count and each suffix's share, which is all that the test needs, and
Spark adds that up: no task ever holds all pairs of a frequent word.

Words are told apart by 64-bit hashes, contexts by 56 bits. A next word goes
by its number, which level 0 gives out by frequency within a bucket, so that
frequent words have small numbers.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructField, StructType

from textstyle.llm.tables import raw_texts
from textstyle.session import delete_folders, shared_folder, write_through

DEPTH = 2
#: Training occurrences that a context of one word, and a longer one, needs.
MIN_COUNT, MIN_COUNT_LONG = 2, 4
#: Log-likelihood in nats that a kept context must gain over its suffix.
MIN_GAIN = 5.0
#: Discount of every seen pair; what it frees goes to the suffix.
DISCOUNT = 0.75
#: Bytes of text in a block (a longer document is one alone), tokens to a bucket.
BLOCK_BYTES, BUCKET_TOKENS = 12 << 20, 2 << 20
#: Occurrences of a context that one bucket takes; one with more has several.
HOT = 1 << 18
#: Files of the table of blocks, at most; more blocks share them.
MAX_BUCKETS = 50_000
CACHED_WORDS = 200_000

_END = np.uint64(0x632BE59BD9B4E019)  # stands for the end of a document
_ALONE = np.uint64(1 << 40)  # above a next word's number: no other block has the pair
_KEY_BITS = 56
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_STEP = 8  # parts of one bit in which a suffix's probability is sent


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MULTIPLY
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    """Word -> 64-bit hash; full tables are set aside, and met words move back."""

    old: dict = {}

    def __missing__(self, word: bytes) -> int:
        value = self.old.get(word)
        self[word] = value = xxhash.xxh3_64_intdigest(word) if value is None else value
        return value

    def trim(self) -> None:
        if len(self) > CACHED_WORDS:
            self.old = dict(self)
            self.clear()


_WORDS = _Words()


def tokens(text: bytes) -> np.ndarray:
    """Hashes of the words, A-Z as lower case, and of the end."""
    _WORDS.trim()
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    out[-1] = _END
    return out


# --- Packing ----------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed."""
    planes = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes.append((a.dtype.str, len(a), a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()))
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(planes))


def _unpack(data: bytes) -> list[np.ndarray]:
    out = []
    for kind, n, planes in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
        dtype = np.dtype(kind)
        raw = np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T
        out.append(np.ascontiguousarray(raw).view(dtype).reshape(n))
    return out


def _steps(values: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Ascending numbers of 40 bits as byte planes of their steps, anew at each ``first``."""
    steps = values.copy()
    steps[1:] -= values[:-1]
    steps[first] = values[first]
    return [(steps >> np.uint64(8 * k)).astype(np.uint8) for k in range(5)]


def _from_steps(planes: list[np.ndarray], first: np.ndarray) -> np.ndarray:
    steps = np.zeros(len(planes[0]), np.uint64)
    for k, plane in enumerate(planes):
        steps |= plane.astype(np.uint64) << np.uint64(8 * k)
    total = np.cumsum(steps, dtype=np.uint64)
    size = np.diff(np.r_[first, len(steps)])
    return total - np.repeat(total[first] - steps[first], size)


def _small(counts: np.ndarray) -> np.ndarray:
    wide = len(counts) and counts.max() >= 1 << 32
    return counts.astype(np.uint64 if wide else np.uint32)


# --- Blocks -----------------------------------------------------------------------


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Documents ``id, text, held_out`` packed: a row to a block.

    A block has its documents' ids and lengths, its vocabulary with the counts
    in its training documents, and its text as places in that vocabulary.
    """
    id_type = docs.schema["id"].dataType
    schema = StructType.fromDDL(
        "block bigint, lengths array<int>, held array<boolean>, n_train bigint, data binary"
    )
    schema = StructType([StructField("ids", ArrayType(id_type))] + schema.fields)
    arrow_ids = pa.list_(to_arrow_type(id_type))

    def pack(number: int, held: list[tuple]) -> pa.RecordBatch:
        ids, parts, kept = zip(*held)
        lengths = np.array([len(p) for p in parts], np.int32)
        stream = np.concatenate(parts)
        vocabulary, place = np.unique(stream, return_inverse=True)
        trained = np.repeat(~np.array(kept, bool), lengths)
        counts = np.bincount(place[trained], minlength=len(vocabulary))
        # Frequent words first, so that places are mostly small numbers.
        order = np.argsort(-np.bincount(place), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        data = _pack(vocabulary[order], _small(counts[order]), rank[place])
        row = [[list(ids)], [number], [lengths.tolist()], [list(kept)], [int(counts.sum())], [data]]
        types = [arrow_ids, pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, types)], schema.names
        )

    def run(batches: Iterator[pa.RecordBatch]):
        task, made, waiting, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            columns = batch.column(0).to_pylist(), raw_texts(batch.column(1)), batch.column(2).to_pylist()
            for key, text, out in zip(*columns):
                if waiting and size + len(text) > block_bytes:
                    yield pack((task << 24) + made, waiting)
                    waiting, size, made = [], 0, made + 1
                waiting.append((key, tokens(text), bool(out)))
                size += len(text) + 16
        if waiting:
            yield pack((task << 24) + made, waiting)

    return docs.mapInArrow(run, schema)


class _Tables:
    """Tables bucketed by block: joining them moves no rows. They are dropped at the end."""

    def __init__(self, spark, buckets: int):
        # Buckets are files of their own, so there are not more than Spark allows.
        self.spark, self.buckets = spark, min(max(1, buckets), MAX_BUCKETS)
        self.names: list[str] = []
        self.paths: list[str] = []

    def keep(self, rows: DataFrame) -> DataFrame:
        path = shared_folder(self.spark, "suffix-tree")
        name = "suffix_tree_" + path.rsplit("-", 1)[-1]
        self.paths.append(path)
        self.names.append(name)
        rows.write.bucketBy(self.buckets, "block").option("path", path).saveAsTable(name)
        return self.spark.table(name)

    def keep_answers(self, answers: DataFrame, level: int) -> DataFrame:
        """``block, told_…, fresh``: a row to a block, moved there once."""
        rows = answers.repartition(self.buckets, "block").groupBy("block")
        told = F.collect_list(F.struct("bucket", "data")).alias(f"told_{level}")
        return self.keep(rows.agg(told, F.sum("fresh").alias("fresh")))

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE {name}")
        delete_folders(self.spark, self.paths)


class Block:
    """One block of documents, and what it has been told so far."""

    def __init__(self, lengths, held, data: bytes, hot: int = HOT):
        self.hot = hot
        self.vocabulary, self.own, self.place = _unpack(data)
        self.lengths = np.asarray(lengths, np.int64)
        self.train = np.repeat(~np.asarray(held, bool), self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        n = len(self.place)
        before = np.arange(n, dtype=np.int32) - np.repeat(starts.astype(np.int32), self.lengths)
        self.since = before  # words of the document before a place
        self.p = np.empty(0)

    def learn_words(self, answers: dict[int, bytes], buckets: int, n: int, v: int) -> None:
        """Level 0: corpus counts of the block's words."""
        total = np.zeros(len(self.vocabulary), np.int64)
        alone = np.zeros(len(total), bool)
        self.number = np.zeros(len(total), np.uint64)
        order = np.argsort(self.vocabulary)
        for bucket, own in _ranges(self.vocabulary[order], 64, buckets):
            only, rank, steps = _unpack(answers[bucket])
            alone[order[own]] = only = _flags(only, own)
            shared = order[own][~only]
            self.number[shared] = rank.astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket)
            total[shared[np.argsort(rank)]] = np.cumsum(steps, dtype=np.int64)[::-1]
        total[alone] = self.own[alone]
        self.counts = total
        self.share = (total + 0.1) / (n + 0.1 * (v + 1))
        self.p = self.share[self.place]
        self.depth = np.zeros(len(self.p), np.int8)
        self._extend(self.place.astype(np.int32), _mix(self.vocabulary + np.uint64(1)), total, alone, MIN_COUNT)

    def _extend(self, at: np.ndarray, key, total, alone, least: int) -> None:
        """The contexts that the next level may use: ``at`` is the one that ends at a place."""
        self.context, self.key, self.total, self.alone = at, key, total, alone
        self.eligible = total >= least

    def pairs(self, level: int) -> tuple:
        """The distinct pairs of a level, by context.

        Their contexts, next words, own counts and suffix's share; whether no
        other block has them; the places of all, and the pair of each place.
        """
        before = self.context[:-1]
        usable = (before >= 0) & (self.since[1:] >= level)
        usable[usable] = self.eligible[before[usable]]
        at = np.flatnonzero(usable).astype(np.int32) + np.int32(1)
        del usable
        code = (before[at - 1].astype(np.uint64) << np.uint64(32)) | self.place[at].astype(np.uint64)
        order = np.argsort(code)
        code, at = code[order], at[order]
        del order, before
        new = np.ones(len(code), bool)
        new[1:] = code[1:] != code[:-1]
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(self.train[at].astype(np.int64), starts) if len(starts) else starts
        share = np.clip(np.round(-np.log2(self.p[at[starts]]) * _STEP), 0, 255).astype(np.uint8)
        context = (code[starts] >> np.uint64(32)).astype(np.int64)
        word = (code[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # Where no other block has the suffix's pair, none has the longer one.
        alone = self.alone[context] | self.alone[self.context[at[starts]]]
        return context, word, counts, share, alone, at, np.cumsum(new, dtype=np.int32) - np.int32(1)

    def routed(self, pairs: tuple) -> tuple:
        """Pairs whose contexts other blocks have too, in the order they are sent.

        Their places among the pairs, the keys they go by, the next words'
        numbers with the mark of a pair that is alone, and the parts of their contexts.
        """
        context, word, _, _, alone, _, _ = pairs
        where = np.flatnonzero(~self.alone[context])
        own, following = context[where], word[where]
        size, key = self.total[own], self.key[own]
        hot = np.flatnonzero(size > self.hot)
        parts = np.zeros(len(own), np.int64)
        parts[hot] = -(-size[hot] // self.hot)
        key[hot] = _mix(
            key[hot] + np.uint64(1) + _mix(self.vocabulary[following[hot]]) % parts[hot].astype(np.uint64)
        )
        key >>= np.uint64(64 - _KEY_BITS)
        low = self.number[following]
        low[alone[where]] |= _ALONE
        order = _order(np.unique(key, return_inverse=True)[1], low)
        return where[order], key[order], low[order], parts[order]

    def learn_pairs(self, level: int, answers: dict[int, bytes], buckets: int) -> None:
        """Scores from the kept contexts of a level; what the next may extend."""
        pairs = self.pairs(level)
        context, word, counts, share, alone, at, pair_of = pairs
        total, only = counts.astype(np.int64), alone.copy()
        where, key, low, parts = self.routed(pairs)
        # Contexts of this block alone; all others are told.
        mine = np.flatnonzero(self.alone[context])
        types, kept = tested(context[mine], counts[mine], share[mine], self.total)
        for bucket, own in _ranges(key, _KEY_BITS, buckets):
            named = own[low[own] < _ALONE]
            first = own[_firsts(key[own])]
            told, single, known, kinds = _unpack(answers[bucket])
            total[where[named]] = told
            if len(single):
                single = where[named[_flags(single, named)]]
                only[single], total[single] = True, counts[single]
            kept[context[where[first]]] = known
            types[context[where[first]]] = kinds
        if _WHOLE in answers:
            whole, kinds, known = _unpack(answers[_WHOLE])
            hot = np.unique(context[where[parts > 0]])
            place = np.searchsorted(whole, self.key[hot])
            kept[hot], types[hot] = known[place], kinds[place]
        state = kept[context[pair_of]]
        scored, pair = at[state], pair_of[state]
        size = self.total[context[pair]]
        self.p[scored] = smoothed(total[pair], size, types[context[pair]], self.p[scored])
        self.depth[scored] = level
        ends = np.full(len(self.place), -1, np.int32)
        ends[at] = pair_of
        self._extend(ends, _mix(self.key[context] + self.vocabulary[word]), total, only, MIN_COUNT_LONG)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Totals by document; every document has its end at least."""
        return np.add.reduceat(values, np.cumsum(self.lengths) - self.lengths)


def smoothed(count, size, types, suffix):
    """Absolute discounting: what is taken off goes to the suffix's distribution."""
    return (np.maximum(count - DISCOUNT, 0) + DISCOUNT * types * suffix) / size


def gain(count: np.ndarray, size: np.ndarray, types: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """What each pair gains over the suffix, itself left out of its context.

    A next word seen once is then unseen, so a context whose next words never
    come again gains nothing however many it has.
    """
    left = np.maximum(size - 1, 1)
    types = types - (count == 1)
    p = (np.maximum(count - 1 - DISCOUNT, 0) + DISCOUNT * types * suffix) / left
    never = (count == 1) & (types == 0)  # nothing left to smooth with
    return np.where(never, np.log(DISCOUNT / 2), np.log(np.maximum(p, 1e-300) / suffix)) * count


def tested(context, count, share, size) -> tuple[np.ndarray, np.ndarray]:
    """``types, kept`` of contexts 0, 1, … with occurrences ``size``, from all their pairs."""
    seen = count > 0
    context, count, share = context[seen], count[seen], share[seen]
    types = np.bincount(context, minlength=len(size))
    worth = gain(count, size[context], types[context], np.exp2(-share.astype(float) / _STEP))
    worth = np.bincount(context, weights=worth, minlength=len(size))
    return types, (worth > MIN_GAIN) & (size >= MIN_COUNT)


def _order(rank: np.ndarray, low: np.ndarray) -> np.ndarray:
    """By ``rank``, then by ``low``, which has 41 bits."""
    if len(rank) and int(rank.max()) >= 1 << 23:
        return np.lexsort((low, rank))
    return np.argsort((rank.astype(np.uint64) << np.uint64(41)) | low)


def _firsts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])


def _flags(packed: np.ndarray, like: np.ndarray) -> np.ndarray:
    return np.unpackbits(packed, count=len(like)).astype(bool)


def _ranges(keys: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket's places among ascending keys: a range of the keys' first 30 bits."""
    bucket = ((keys >> np.uint64(bits - 30)) * np.uint64(buckets)) >> np.uint64(30)
    starts = _firsts(bucket) if len(keys) else np.empty(0, np.int64)
    for start, end in zip(starts, np.r_[starts[1:], len(keys)]):
        yield int(bucket[start]), np.arange(start, end)


# --- Exchanges --------------------------------------------------------------------


def _ask(blocks: DataFrame, ask: Callable, informed: bool) -> DataFrame:
    """``bucket, block, data``: what each block sends to each bucket."""
    schema = "bucket int, block bigint, data binary"

    def rows(block: int, sent: Iterator[tuple[int, bytes]]) -> pa.Table:
        got = list(sent)
        return pa.table(
            [pa.array([b for b, _ in got], pa.int32()), pa.array([block] * len(got), pa.int64()),
             pa.array([d for _, d in got], pa.binary())],
            names=["bucket", "block", "data"],
        )

    if not informed:

        def run(batches):
            for batch in batches:
                for block, data in zip(*(batch.column(k).to_pylist() for k in range(2))):
                    yield from rows(block, ask(data)).to_batches()

        return blocks.select("block", "data").mapInArrow(run, schema)

    def run_told(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        return rows(row["block"], ask(row))

    return blocks.groupBy("block").applyInArrow(run_told, schema)


def _answer(asked: DataFrame, level: int, merge: Callable) -> DataFrame:
    """``level, bucket, block, fresh, data``: a bucket's answers to the blocks."""
    schema = "level int, bucket int, block bigint, fresh bigint, data binary"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        bucket, blocks = table.column("bucket")[0].as_py(), table.column("block").to_pylist()
        fresh, answers, hot, asking = merge([_unpack(d) for d in table.column("data").to_pylist()])
        rows = [(level, bucket, block, 0, data) for block, data in zip(blocks, answers)]
        rows[0] = (level, bucket, blocks[0], fresh, answers[0])
        if hot is not None:
            rows.append((level, _PARTS, blocks[bucket % len(blocks)], 0, hot))
            rows += [(level, _ASKING, b, 0, _pack(a)) for b, a in zip(blocks, asking) if len(a)]
        return pa.Table.from_pylist(
            [dict(zip(_ANSWER.names, row)) for row in rows], schema=_ANSWER
        )

    return asked.groupBy("bucket").applyInArrow(run, schema)


_WHOLE, _PARTS, _ASKING = -1, -2, -3  # in place of a bucket
_ANSWER = pa.schema(
    [("level", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()),
     ("fresh", pa.int64()), ("data", pa.binary())]
)


def _wholes(answers: DataFrame, level: int, tables: _Tables) -> DataFrame | None:
    """``block, whole_…``: sums of contexts that have parts in several buckets."""
    told = answers.select("block", F.explode(f"told_{level}").alias("a")).select("block", "a.*")
    if told.where(f"bucket = {_PARTS}").isEmpty():
        return None

    def parts(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                key, count, share, n = _unpack(data)
                columns = key.view(np.int64), count.astype(np.int64), share.astype(np.int64), n.astype(np.int64)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "count", "share", "n"])

    def worth(batches):
        for batch in batches:
            key, count, share, n, types, size = (c.to_numpy() for c in batch.columns)
            gained = n * gain(count, size, types, np.exp2(-share / _STEP))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gained)], ["key", "worth"])

    def asking(batches):
        for batch in batches:
            for block, data in zip(*(c.to_pylist() for c in batch.columns)):
                key = _unpack(data)[0].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), block)), pa.array(key)], ["block", "key"]
                )

    pairs = told.where(f"bucket = {_PARTS}").select("data")
    pairs = pairs.mapInArrow(parts, "key bigint, count bigint, share bigint, n bigint")
    pairs = pairs.groupBy("key", "count", "share").agg(F.sum("n").alias("n"))
    pairs = write_through(pairs, "pair-counts", tables.paths)
    wholes = pairs.groupBy("key").agg(
        F.sum("n").alias("types"), F.sum(F.col("count") * F.col("n")).alias("size")
    )
    gains = pairs.join(wholes, "key").mapInArrow(worth, "key bigint, worth double")
    kept = gains.groupBy("key").agg((F.sum("worth") > MIN_GAIN).alias("kept"))
    sums = wholes.drop("size").join(kept, "key")
    ask = told.where(f"bucket = {_ASKING}").select("block", "data")
    rows = ask.mapInArrow(asking, "block bigint, key bigint").distinct().join(sums, "key")

    def pack(table: pa.Table) -> pa.Table:
        key = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        types = table.column("types").to_numpy()[order]
        kept = table.column("kept").to_numpy().astype(np.uint8)[order]
        return pa.table(
            [table.column("block")[:1], pa.array([_pack(key[order], types, kept)], pa.binary())],
            names=["block", f"whole_{level}"],
        )

    rows = rows.repartition(tables.buckets, "block").groupBy("block")
    return tables.keep(rows.applyInArrow(pack, f"block bigint, whole_{level} binary"))


def _merge_words(sent: list[list[np.ndarray]]) -> tuple:
    """Adds the counts of all blocks; ``fresh`` is the number of trained words.

    A block is told which of its words no other block has, and of the others
    the rank by count and the counts, as steps in the order of ranks.
    """
    words = np.concatenate([np.cumsum(s[0], dtype=np.uint64) for s in sent])
    counts = np.concatenate([s[1] for s in sent])
    known, place, blocks = np.unique(words, return_inverse=True, return_counts=True)
    total = np.bincount(place, weights=counts, minlength=len(known)).astype(np.int64)
    ends = np.cumsum([len(s[0]) for s in sent])[:-1]
    shared, answers = np.flatnonzero(blocks > 1), []
    rank = np.full(len(known), -1)
    rank[shared[np.argsort(-total[shared], kind="stable")]] = np.arange(len(shared))
    for mine in np.split(place, ends):
        own = mine[rank[mine] >= 0]
        ascending = total[own[np.argsort(-rank[own])]]
        steps = np.diff(ascending, prepend=0)
        answers.append(_pack(np.packbits(rank[mine] < 0), _small(rank[own]), _small(steps)))
    return int((total > 0).sum()), answers, None, []


def _merge_pairs(sent: list[list[np.ndarray]], last: bool) -> tuple:
    """Adds the counts of all blocks and tests the contexts.

    A block sends its contexts' keys; of each the number of pairs with a name
    and of those that no other block has; the names; counts and suffix's
    probability, which all blocks know alike, of both kinds; and the number of
    parts of a context that has several, and its own key.
    Of a context that is not kept it is told only the pairs that are frequent
    enough to be contexts of the next level, if there is one.
    """
    keys = [np.cumsum(s[0], dtype=np.uint64) for s in sent]
    ends = np.cumsum([len(k) for k in keys])[:-1]
    known, place = np.unique(np.concatenate(keys), return_inverse=True)
    places = np.split(place.astype(np.int32), ends)
    whole, hot = np.zeros(len(known), np.uint64), np.zeros(len(known), bool)
    for s, mine in zip(sent, places):
        divided = mine[s[10] > 0]
        hot[divided], whole[divided] = True, s[11]
    named, single, names, rows = [], [], [], []
    for s, mine in zip(sent, places):
        n = s[1].astype(np.int64)
        names.append(_from_steps(s[3:8], (np.cumsum(n) - n)[n > 0]))
        named.append(np.repeat(mine, n))
        single.append(np.repeat(mine, s[2]))
        kinds = np.stack([s[1], s[2]], 1).ravel()
        rows.append(np.repeat(np.arange(len(kinds)) % 2 == 0, kinds))
    with_name = np.concatenate(rows)
    counts, share = (np.concatenate([s[k] for s in sent]) for k in (8, 9))
    counts = counts.astype(np.int64)
    context, following = np.concatenate(named), np.concatenate(names)
    order = _order(context, following)
    own = context[order]
    new = np.ones(len(order), bool)
    new[1:] = (own[1:] != own[:-1]) | (following[order][1:] != following[order][:-1])
    starts = np.flatnonzero(new)
    total = np.add.reduceat(counts[with_name][order], starts) if len(starts) else starts
    blocks = np.diff(np.r_[starts, len(order)])
    every = np.concatenate([own[starts], *single])
    count = np.concatenate([total, counts[~with_name]])
    # A block that has a pair in no training document does not say its share.
    shares = np.maximum.reduceat(share[with_name][order], starts) if len(starts) else share[:0]
    shares = np.concatenate([shares, share[~with_name]])
    size = np.bincount(every, weights=count, minlength=len(known)).astype(np.int64)
    types, kept = tested(every, count, shares, size)
    kept |= hot  # a whole is tested later
    pair = np.empty(len(order), np.int64)
    pair[order] = np.cumsum(new) - 1
    answers = []
    for mine, own, p in zip(places, named, np.split(pair, np.cumsum([len(x) for x in named])[:-1])):
        useful, only = kept[own], np.empty(0, np.uint8)
        if not last:  # the own count of a pair that no other block has is known
            useful = (useful | (total[p] >= MIN_COUNT_LONG)) & (blocks[p] > 1)
            only = np.packbits(blocks[p] == 1)
        answers.append(
            _pack(_small(total[p] * useful), only, kept[mine].astype(np.uint8), _small(types[mine] * kept[mine]))
        )
    if not hot.any():
        return int(kept.sum()), answers, None, []
    # What follows once gains alike whatever the suffix says.
    seen = np.flatnonzero(hot[every] & (count > 0))
    alike = np.stack([every[seen], count[seen], np.where(count[seen] > 1, shares[seen], 0)], 1)
    alike, n = np.unique(alike, axis=0, return_counts=True)
    reported = _pack(whole[alike[:, 0]], alike[:, 1], alike[:, 2].astype(np.uint8), n)
    return int(kept.sum()), answers, reported, [np.unique(s[11]) for s in sent]


def _sent_pairs(block: Block, level: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    pairs = block.pairs(level)
    where, key, low, parts = block.routed(pairs)
    context, counts, share = pairs[0][where], pairs[2][where], pairs[3][where]
    # What comes once in all gains alike whatever its share, what never comes nothing.
    share[(counts == 0) | ((counts == 1) & (low >= _ALONE))] = 0
    for bucket, own in _ranges(key, _KEY_BITS, buckets):
        first = _firsts(key[own])
        steps = np.diff(key[own][first], prepend=np.uint64(0))
        single = low[own] >= _ALONE
        n_single = np.add.reduceat(single.astype(np.int64), first)
        n = np.diff(np.r_[first, len(own)]) - n_single
        names = _steps(low[own][~single], (np.cumsum(n) - n)[n > 0])
        divided = parts[own][first]
        whole = context[own][first][divided > 0]
        yield bucket, _pack(
            steps, _small(n), _small(n_single), *names, _small(counts[own]), share[own],
            _small(divided), block.key[whole],
        )


# --- The operator -----------------------------------------------------------------


def score(
    docs: DataFrame,
    *,
    held_out,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    block_bytes: int = BLOCK_BYTES,
    bucket_tokens: int = BUCKET_TOKENS,
    hot: int = HOT,
) -> DataFrame:
    """Scores every row; the tree is learned from the rows that are not held out.

    ``held_out`` is a boolean column expression over ``docs``, null meaning
    false. Returns the id, ``held_out, n_tokens, n_known, train_tokens,
    base_score, score`` and ``mean_depth``, the mean length of the contexts
    used. Scores are log10 probabilities of the whole text and its end; base
    is the root state alone. A null or empty text has its end only; repeated
    rows count and are scored as often as they come. Without training rows
    every word is equally unlikely. An empty table gives no rows. Columns
    besides id and text are read only by ``held_out``. The sizes of blocks and
    buckets, and the count from which a context is divided, bound what a task
    holds. The scores are written, and all other tables deleted.
    """
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held)
    size = rows.agg(F.sum(F.octet_length("text")).alias("s")).first()["s"] or 0
    tables = _Tables(docs.sparkSession, 2 * size // block_bytes)
    blocks = tables.keep(_blocks(rows, block_bytes))
    totals = blocks.agg(
        F.sum("n_train").alias("n"),
        F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("all"),
    ).first()
    n, buckets = totals["n"] or 0, max(8, -(-(totals["all"] or 0) // bucket_tokens))

    def ask_words(data):
        vocabulary, counts, _ = _unpack(data)
        order = np.argsort(vocabulary)
        for bucket, own in _ranges(vocabulary[order], 64, buckets):
            steps = np.diff(vocabulary[order[own]], prepend=np.uint64(0))
            yield bucket, _pack(steps, counts[order[own]])

    answers = _answer(_ask(blocks, ask_words, False), 0, _merge_words)
    told = tables.keep_answers(answers, 0)
    v = told.agg(F.sum("fresh").alias("v")).first()["v"] or 0
    blocks = blocks.join(told.drop("fresh"), "block", "left")

    def informed(row: dict, levels: int) -> Block:
        block = Block(row["lengths"], row["held"], row["data"], hot)
        for level in range(levels):
            own = {a["bucket"]: a["data"] for a in row[f"told_{level}"] or ()}
            if row.get(f"whole_{level}"):
                own[_WHOLE] = row[f"whole_{level}"]
            if level == 0:
                block.learn_words(own, buckets, n, v)
            else:
                block.learn_pairs(level, own, buckets)
        return block

    for level in range(1, depth + 1):

        def ask_pairs(row, level=level):
            return _sent_pairs(informed(row, level), level, buckets)

        asked = _ask(blocks.drop("ids"), ask_pairs, True)

        def merge(sent, last=level == depth):
            return _merge_pairs(sent, last)

        told = tables.keep_answers(_answer(asked, level, merge), level)
        whole = _wholes(told, level, tables)
        blocks = blocks.join(told.drop("fresh"), "block", "left")
        if whole is not None:
            blocks = blocks.join(whole, "block", "left")

    made = StructType.fromDDL(
        "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, mean_depth double"
    )
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType)] + made.fields)
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def run(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        block = informed(row, depth + 1)
        known = block.counts[block.place] > 0
        columns = [
            pa.array(row["ids"], id_type),
            pa.array(row["held"], pa.bool_()),
            pa.array(block.lengths),
            pa.array(block.sums(known.astype(np.int64))),
            pa.array(np.full(len(block.lengths), n, np.int64)),
            pa.array(block.sums(np.log(block.share)[block.place]) / math.log(10)),
            pa.array(block.sums(np.log(block.p)) / math.log(10)),
            pa.array(block.sums(block.depth.astype(float)) / block.lengths),
        ]
        return pa.table(columns, names=schema.names)

    scores = write_through(blocks.groupBy("block").applyInArrow(run, schema), "suffix-scores")
    tables.drop()
    return scores
