"""Periodic runs of words, found by exact convolution of blocks.

A run is a stretch of words with smallest period ``q`` that is long enough
and cannot be extended. At every scale ``L = 1, 2, 4, …`` a text is cut into
blocks of ``L`` words. A run of four periods ``q`` in ``[L, 2 L)`` holds a whole
block together with the same words ``q`` further on, so each block is looked
for in the window that begins ``L`` words later. The sum of squared differences
between block and window at every shift comes from number-theoretic transforms
modulo primes whose product exceeds any such sum: it is zero exactly where the
block occurs. Every zero is a seed, a place and a distance, that is extended
word by word to both sides and kept where the stretch is a run.

The texts of a batch lie behind each other, with a word of its own between
two, so that the transforms of all of them are made together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from textstyle.llm.tables import raw_texts

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words of texts that are searched together, and numbers in one transform.
BATCH_WORDS, TRANSFORM_NUMBERS = 1 << 17, 1 << 18
#: Words compared at a time while a seed is extended.
STEP_CELLS = 1 << 18
#: Primes with roots of unity of order 2 ** 25 and more, and a
#: generator of each.
PRIMES = ((2013265921, 31), (1811939329, 13), (2113929217, 5))


# --- Transforms -------------------------------------------------------------------


@cache
def _roots(prime: int, generator: int, half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order ``2 * half``."""
    root = pow(generator, (prime - 1) // (2 * half), prime)
    root = pow(root, prime - 2, prime) if inverse else root
    powers = np.ones(half, np.uint64)
    filled = 1
    while filled < half:  # the powers known so far, times the next one
        step = np.uint64(pow(root, filled, prime))
        powers[filled : 2 * filled] = powers[:filled] * step % np.uint64(prime)
        filled *= 2
    return powers


def transform(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transforms each row, a power of two long; the result's order is mixed."""
    p, half = np.uint64(prime), rows.shape[1] // 2
    rows = rows.copy()
    while half:
        pairs = rows.reshape(len(rows), -1, 2, half)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0] = (low + high) % p
        pairs[:, :, 1] = (low + (p - high)) * _roots(prime, generator, half, False) % p
        half //= 2
    return rows


def restore(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """The rows whose transforms, in their mixed order, are given."""
    p, n, half = np.uint64(prime), rows.shape[1], 1
    rows = rows.copy()
    while half < n:
        pairs = rows.reshape(len(rows), -1, 2, half)
        low = pairs[:, :, 0].copy()
        high = pairs[:, :, 1] * _roots(prime, generator, half, True) % p
        pairs[:, :, 0] = (low + high) % p
        pairs[:, :, 1] = (low + (p - high)) % p
        half *= 2
    return rows * np.uint64(pow(n, prime - 2, prime)) % p


def occurrences(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Whether each block occurs in its window: ``blocks x size`` shifts.

    Block ``b`` are the ``size`` words from ``starts[b]`` on; shift ``d`` compares
    them with those from ``starts[b] + size + d``. Words are numbers from 0 on;
    ``words`` must reach ``3 * size - 1`` beyond each start.
    """
    zero = np.ones((len(starts), size), bool)
    blocks = words[starts[:, None] + np.arange(size)]
    windows = words[starts[:, None] + np.arange(size, 3 * size - 1)]
    most, bound = size * int(words.max(initial=0)) ** 2, 1
    for prime, generator in PRIMES:
        p = np.uint64(prime)
        # Reversed, so that the product of transforms is a correlation.
        left = np.zeros((len(starts), 2 * size), np.uint64)
        left[:, :size] = blocks[:, ::-1] % prime
        right = np.zeros_like(left)
        right[:, : 2 * size - 1] = windows % prime
        both = transform(left, prime, generator) * transform(right, prime, generator) % p
        products = restore(both, prime, generator)[:, size - 1 : 2 * size - 1]
        own = (left * left % p).sum(axis=1, keepdims=True) % p
        running = np.zeros((len(starts), 2 * size), np.uint64)
        np.cumsum(right[:, : 2 * size - 1] ** 2 % p, axis=1, out=running[:, 1:])
        there = (running[:, size:] - running[:, :size]) % p
        zero &= (own + there + 2 * (p - products)) % p == 0
        bound *= prime
        if bound > most:
            return zero
    raise ValueError("a block is too long for exact sums")


# --- Runs of a batch --------------------------------------------------------------


class Batch:
    """The words of some texts behind each other, each followed by its own end."""

    def __init__(self, texts: list[np.ndarray], distinct: int):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        ends = distinct + np.arange(len(texts))
        parts = [x for t, end in zip(texts, ends) for x in (t, [end])]
        self.words = np.concatenate(parts).astype(np.int64)
        self.first = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.end = np.repeat(self.first + self.lengths, self.lengths + 1)
        order = np.argsort(self.words, kind="stable")
        self.width = np.int64(len(self.words))
        self.sorted = self.words[order] * self.width + order

    def recurs(self, at: np.ndarray, size: int) -> np.ndarray:
        """Whether the words at some places come again ``size`` to ``2 size`` on."""
        word = self.words[at] * self.width
        found = np.searchsorted(self.sorted, word + at + size)
        place = self.sorted[np.minimum(found, len(self.sorted) - 1)]
        return (found < len(self.sorted)) & (place < word + at + 2 * size)

    def runs(self) -> np.ndarray:
        """All runs as rows ``start, end, period``, by start, then period."""
        found = np.empty((0, 3), np.int64)
        size, longest = 1, int(self.lengths.max(initial=0))
        # A run of period q >= size has at least this many words.
        while max(LEAST_WORDS, LEAST_PERIODS * size) <= longest:
            seeds = self.seeds(size, found)
            found = np.concatenate([found, self.extended(seeds, size, found)])
            size *= 2
        return found[np.lexsort((found[:, 2], found[:, 0]))]

    def seeds(self, size: int, known: np.ndarray) -> np.ndarray:
        """``place, distance`` of blocks of ``size`` words that occur again.

        Blocks are left out where one of a few of their words does not come
        again in the window, and where the block and its window lie in a run
        of a smaller period: all that can be found there is that run.
        """
        long_enough = self.lengths >= max(LEAST_WORDS, LEAST_PERIODS * size)
        n_blocks = np.where(long_enough, self.lengths // size, 0)
        text = np.repeat(np.arange(len(self.lengths)), n_blocks)
        number = np.arange(len(text)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        at = self.first[text] + number * size
        for offset in sorted({0, size - 1, size // 2, size // 4}):
            at = at[self.recurs(at + offset, size)]
        at = at[~_inside(at, at + 3 * size, known)]
        padded = np.concatenate([self.words, np.full(3 * size, self.words.max(initial=0) + 1)])
        rows = max(1, TRANSFORM_NUMBERS // (2 * size))
        found = [np.empty((0, 2), np.int64)]
        for k in range(0, len(at), rows):
            own = at[k : k + rows]
            block, shift = np.nonzero(occurrences(padded, own, size))
            found.append(np.stack([own[block], size + shift], axis=1))
        seeds = np.concatenate(found)
        return seeds[seeds.sum(axis=1) + size <= self.end[seeds[:, 0]]]

    def extended(self, seeds: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
        """The runs among the longest stretches that seeds lie in."""
        if not len(seeds):
            return np.empty((0, 3), np.int64)
        # Of blocks beside each other with one distance, the first is enough.
        at, distance = seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))].T
        chained = (distance[1:] == distance[:-1]) & (at[1:] == at[:-1] + size)
        heads = np.append(True, ~chained)
        at, distance = at[heads], distance[heads]
        text = np.searchsorted(self.first, at, "right") - 1
        low, high = self.first[text], self.first[text] + self.lengths[text]
        right = at + self.matching(at, distance, high - distance, 1)
        left = at - self.matching(at - 1, distance, low - 1, -1)
        stretches = np.stack([left, right + distance, distance], axis=1)
        length = stretches[:, 1] - stretches[:, 0]
        good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * distance)
        return _primitive(np.unique(stretches[good], axis=0), known)

    def matching(
        self, at: np.ndarray, distance: np.ndarray, stop: np.ndarray, step: int
    ) -> np.ndarray:
        """How many words from ``at`` on, in steps, equal those at ``distance``.

        Steps end before ``stop``. All seeds are compared at once, the longer
        the fewer are left.
        """
        count = np.zeros(len(at), np.int64)
        left = np.flatnonzero((stop - at) * step > 0)
        width = 4
        while len(left):
            next_ = []
            for k in range(0, len(left), max(1, STEP_CELLS // width)):
                own = left[k : k + max(1, STEP_CELLS // width)]
                place = (at[own] + step * count[own])[:, None] + step * np.arange(width)
                inside = (stop[own][:, None] - place) * step > 0
                place = np.where(inside, place, 0)
                other = np.where(inside, place + distance[own][:, None], 0)
                same = inside & (self.words[place] == self.words[other])
                whole = same.all(axis=1)
                count[own] += np.where(whole, width, np.argmin(same, axis=1))
                next_.append(own[whole])
            left = np.concatenate(next_)
            width = min(2 * width, STEP_CELLS)
        return count


def _inside(low: np.ndarray, high: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether each stretch lies within one of ``runs``, which may overlap."""
    if not len(runs):
        return np.zeros(len(low), bool)
    order = np.argsort(runs[:, 0], kind="stable")
    starts, reach = runs[order, 0], np.maximum.accumulate(runs[order, 1])
    k = np.searchsorted(starts, low, "right") - 1
    return (k >= 0) & (reach[np.maximum(k, 0)] >= high)


def _primitive(stretches: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Stretches whose period is the smallest.

    Four periods long, a stretch with a smaller period has one that divides
    its own, and then is, as a whole, a run of that smaller period.
    """
    smaller = {(s, e): q for s, e, q in known[np.argsort(-known[:, 2], kind="stable")].tolist()}
    kept = [q <= smaller.get((s, e), q) for s, e, q in stretches.tolist()]
    return stretches[np.array(kept, bool)]


# --- The job ----------------------------------------------------------------------

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _batches(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    """The words of texts, some ``BATCH_WORDS`` together."""
    held, n = [], 0
    for text in texts:
        words = text.split()  # bytes are split at ASCII white space only
        held.append(words)
        n += len(words) + 1
        if n >= BATCH_WORDS:
            yield held
            held, n = [], 0
    if held:
        yield held


def _searched(texts: list[list[bytes]]) -> Iterator[tuple[int, list[dict], str]]:
    """``n_words, runs, collapsed`` of each text of a batch."""
    numbers: dict[bytes, int] = {}
    numbered = [
        np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
        for words in texts
    ]
    batch = Batch(numbered, len(numbers))
    found = batch.runs()
    owner = np.searchsorted(batch.first, found[:, 0], "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, words in enumerate(texts):
        own = found[cuts[i] : cuts[i + 1]] - [[batch.first[i], batch.first[i], 0]]
        kept = words
        if len(own):
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, own[:, 0] + own[:, 2], 1)
            np.add.at(change, own[:, 1], -1)
            kept = [words[k] for k in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
        runs = [{"start": s, "length": e - s, "period": q} for s, e, q in own.tolist()]
        yield len(words), runs, b" ".join(kept).decode()


def find(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (by default all but the text), ``n_words, runs, collapsed``.

    Words are what ASCII white space divides, numbered from 0. ``runs`` are
    all stretches with smallest period ``period`` and at least ``LEAST_WORDS``
    words and ``LEAST_PERIODS`` periods that no word beside them extends, by
    start, then period. ``collapsed`` joins by one blank the words outside
    every run, and those of each run's first period that no other run drops.

    Whole texts are searched, each in one task and no two rows together, so
    repeated and very long texts need no care. Null and empty texts have no
    words, no runs and an empty ``collapsed``. An empty table gives no rows.
    An input column that bears the name of a result raises ``ValueError``
    unless ``keep`` leaves it out.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    clash = sorted({"n_words", "runs", "collapsed"} & set(keep))
    if clash:
        raise ValueError(f"input columns would hide results: {clash}")
    kept = docs.select(*keep).schema.fields
    made = StructType.fromDDL(f"n_words bigint, runs array<{RUN}>, collapsed string").fields
    schema = StructType([*kept, *made])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            done = 0
            for texts in _batches(raw_texts(batch.column(len(keep)))):
                columns = [c.slice(done, len(texts)) for c in batch.columns[:-1]]
                results = zip(*_searched(texts))
                columns += [pa.array(list(c), arrow.field(len(keep) + k).type)
                            for k, c in enumerate(results)]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
                )
                done += len(texts)

    return docs.select(*keep, text_col).mapInArrow(run, schema)
