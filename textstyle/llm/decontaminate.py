"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the windows of the benchmark items: runs of ``window``
consecutive words, or a shorter item as a whole. A machine for each window
length m looks at the block of two words that ends at a position: a shift
table says how far no window can end, a bucket by the window's last block
gives the windows to compare word by word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from textstyle.llm.tables import check_names, raw_texts
from textstyle.session import delete_folders, write_through

#: Words in one pattern.
WINDOW = 10
#: Bytes of distinct windows that one pass over the documents carries.
PASS_BYTES = 16 << 20

MADE = ["n_words", "n_hit", "items", "spans"]
MADE_TYPES = (
    "n_words bigint, n_hit bigint, items array<string>, "
    "spans array<struct<start: bigint, end: bigint>>"
)

# A-Z to lower case; every other ASCII character but digits and a-z to a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of digits, a-z and non-ASCII characters."""
    return text.translate(_WORD_BYTES).split()


def windows_of(words: Sequence[bytes], size: int) -> list[tuple[bytes, ...]]:
    """All runs of ``size`` words; fewer words, but not none, are one window."""
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class WuManber:
    """Finds every occurrence of many word windows in a list of words."""

    def __init__(self, patterns: Iterable[tuple[tuple[bytes, ...], Sequence[str]]]):
        by_length = defaultdict(dict)
        for window, payload in patterns:
            by_length[len(window)].setdefault(window, set()).update(payload)
        self.machines = [self._machine(m, p) for m, p in sorted(by_length.items())]

    @staticmethod
    def _machine(m: int, patterns: dict) -> tuple:
        block = min(2, m)
        shifts: dict[tuple, int] = {}
        buckets: dict[tuple, list] = defaultdict(list)
        for window, payload in patterns.items():
            for end in range(block, m + 1):
                at = window[end - block : end]
                shifts[at] = min(m - end, shifts.get(at, m))
            buckets[window[m - block :]].append((list(window), sorted(payload)))
        return m, block, shifts, dict(buckets)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """``(start, end, payload)`` of every occurrence."""
        for m, block, shifts, buckets in self.machines:
            shift_of, far, n = shifts.get, m - block + 1, len(words)
            end = m
            while end <= n:
                at = tuple(words[end - block : end])
                shift = shift_of(at, far)
                if shift:
                    end += shift
                    continue
                for window, payload in buckets[at]:
                    if words[end - m : end] == window:
                        yield end - m, end, payload
                end += 1


def scan(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with what each whole text shares with the benchmark items.

    Adds ``n_words``; ``n_hit``, the words inside occurrences; ``items``, the
    ids (as text, sorted) of the items with occurring windows; and ``spans``,
    the hit runs of words as ``(start, end)``. No shuffle of documents: the
    windows are sent along, at most ``pass_bytes`` of them to a pass, and a
    larger benchmark takes as many passes, each adding to the hits of the last,
    which are written in between.

    A null or empty text has no words. An item without words has no windows;
    one without an id marks words but is not listed; repeated items count
    once. Without items nothing is hit. An input column named like a result
    is refused.
    """
    check_names(docs, MADE)
    spark = docs.sparkSession
    windows = _windows(items, item_id_col, item_text_col, window)
    size = windows.agg(F.sum(F.length("window") + 24).alias("b")).first()["b"] or 0
    passes = max(1, -(-size // pass_bytes))
    out = docs.withColumn("_spans", F.lit(None).cast("array<bigint>"))
    out = out.withColumn("_items", F.lit(None).cast("array<string>"))
    written: list[str] = []
    for k in range(passes):
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(passes)) == k)
        patterns = [
            (tuple(bytes(r["window"]).split()), [] if r["item"] is None else [r["item"]])
            for r in part.toLocalIterator()
        ]
        sent = spark.sparkContext.broadcast(WuManber(patterns))
        out = _pass(out, sent, text_col, last=k == passes - 1, keep_text=keep_text)
        if k < passes - 1:
            # Written, so that a worker holds the windows of one pass only.
            before, written = written, []
            out = write_through(out, "hits", written)
            delete_folders(spark, before)
            sent.destroy()
    return out


def _windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct ``(item, window)``; a window is its words joined by blanks."""
    schema = StructType.fromDDL("item string, window binary")

    def cut(batches):
        for batch in batches:
            rows = [
                (i, b" ".join(w))
                for i, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)))
                for w in set(windows_of(words_of(text), size))
            ]
            columns = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary())],
                ["item", "window"],
            )

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("t"))
    return rows.mapInArrow(cut, schema).distinct()


def _pass(docs: DataFrame, sent, text_col: str, last: bool, keep_text: bool) -> DataFrame:
    kept = [c for c in docs.columns if c not in ("_spans", "_items")]
    if last and not keep_text:
        kept.remove(text_col)
    base = StructType([docs.schema[c] for c in kept])
    made = "_spans array<bigint>, _items array<string>"
    schema = StructType(base.fields + StructType.fromDDL(MADE_TYPES if last else made).fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        machine = sent.value
        for batch in batches:
            columns = {c: batch.column(c).cast(arrow.field(c).type) for c in kept}
            olds = zip(batch.column("_spans").to_pylist(), batch.column("_items").to_pylist())
            rows = []
            for text, (spans, found) in zip(raw_texts(batch.column(text_col)), olds):
                words = words_of(text)
                mask, found = bytearray(len(words)), set(found or ())
                for start, end in zip((spans or ())[::2], (spans or ())[1::2]):
                    mask[start:end] = b"\1" * (end - start)
                for start, end, ids in machine.find(words):
                    mask[start:end] = b"\1" * (end - start)
                    found.update(ids)
                rows.append((len(words), mask.count(1), sorted(found), _runs(mask)))
            if last:
                values = {
                    "n_words": [r[0] for r in rows],
                    "n_hit": [r[1] for r in rows],
                    "items": [r[2] for r in rows],
                    "spans": [[{"start": a, "end": b} for a, b in r[3]] for r in rows],
                }
            else:
                values = {
                    "_spans": [[x for run in r[3] for x in run] for r in rows],
                    "_items": [r[2] for r in rows],
                }
            columns |= {c: pa.array(v, arrow.field(c).type) for c, v in values.items()}
            yield pa.RecordBatch.from_arrays([columns[c] for c in schema.names], schema=arrow)

    return docs.mapInArrow(run, schema)


def _runs(mask: bytearray) -> list[tuple[int, int]]:
    """Runs of ones."""
    out, end = [], 0
    while (start := mask.find(1, end)) >= 0:
        end = mask.find(0, start)
        end = len(mask) if end < 0 else end
        out.append((start, end))
    return out


def items_digest(items: str = "items") -> Column:
    """SHA-256 of the sorted item ids, comma-joined."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)
