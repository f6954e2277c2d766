"""Term frequencies, n-gram tables, vocabulary, TF-IDF and stem dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textstyle.functions import text as T
from textstyle.functions.stemming import stem_tokens
from textstyle.operators.ordering import top_per_group
from textstyle.operators.reshape import explode_tokens
from textstyle.session import write_through

#: Largest table, in bytes, that is sent to every executor.
BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all of ``df``, measured as rows of text, is within ``limit``."""
    row_bytes = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns),
        F.lit(16 * len(df.columns)),
    )
    total = df.agg(F.sum(row_bytes).alias("bytes")).first()["bytes"]
    return (total or 0) <= limit


# --- frequencies ----------------------------------------------------------------


def term_counts(df: DataFrame, tokens: Column, *keep: str) -> DataFrame:
    """``(keep…, term, tf)``: how often each row's tokens occur in that row.

    Counting happens inside the row: tokens are sorted, and each run of equal
    tokens gives one term. No shuffle is needed to count per document.

    The outer explode is on purpose. A plain one makes the optimiser filter on
    the array's size and move that filter below the sort, which would then run
    again for every element; rows without tokens are dropped afterwards.
    """
    runs = df.select(*keep, F.sort_array(tokens).alias("_sorted"))
    here = "_sorted"
    positions = F.when(
        F.size(here) > 0, F.sequence(F.lit(0), F.size(here) - 1)
    ).otherwise(F.array().cast("array<int>"))
    starts = F.filter(
        positions, lambda i: ~F.get(here, i).eqNullSafe(F.get(here, i - 1))
    )
    runs = runs.withColumn("_starts", starts)
    runs = runs.select(*keep, here, "_starts", F.posexplode_outer("_starts").alias("_k", "_i"))
    runs = runs.filter(F.col("_i").isNotNull())
    after = F.coalesce(F.get("_starts", F.col("_k") + 1), F.size(here))
    return runs.select(
        *keep,
        F.get(here, F.col("_i")).alias("term"),
        (after - F.col("_i")).cast("bigint").alias("tf"),
    )


def term_frequency(df: DataFrame, tokens: Column, alias: str, *by: str) -> DataFrame:
    """Occurrences of each token (or n-gram), per group when ``by`` is given."""
    return (
        explode_tokens(df, tokens, alias, *by)
        .groupBy(*by, alias)
        .agg(F.count(F.lit(1)).alias("count"))
    )


#: Slots that items are counted in, and slots counted item by item.
TOP_SLOTS, FIRST_SLOTS = 1 << 16, 1 << 10
#: Share of the rows that names the slots to count item by item.
GUESS_SHARE = 0.01


def top_items(
    df: DataFrame,
    items: Column,
    alias: str,
    k: int,
    by: Sequence[str] = (),
    slots: int = TOP_SLOTS,
    first_slots: int = FIRST_SLOTS,
) -> DataFrame:
    """``(by…, alias, count)``: at least each group's ``k`` most frequent items.

    Exact, and without a shuffle of all distinct items. An item's hash names
    its slot, and a slot's count bounds that of every item in it. A few rows
    tell which slots of a group are the fullest. One pass over all rows then
    counts the items of these slots and, for all others, the slot alone. The
    ``k``-th count so found is one that no item of the result can miss; where
    another slot has reached it, that slot's items are counted too. So the few
    rows decide about the work and not about the result, which holds every
    item that is, or ties with, one of the ``k``.
    """
    by = list(by)

    def slotted(rows: DataFrame) -> DataFrame:
        slot = F.pmod(F.xxhash64(alias), F.lit(slots)).cast("int")
        return explode_tokens(rows, items, alias, *by).withColumn("_slot", slot)

    def same(side: DataFrame, *columns: str) -> tuple[DataFrame, Column]:
        """``side`` with names of its own, and the condition that joins it."""
        other = {c: f"_other_{c}" for c in columns}
        equal = F.lit(True)
        for c in columns:
            equal = equal & F.col(c).eqNullSafe(F.col(other[c]))
        return side.withColumnsRenamed(other), equal

    group = Window.partitionBy(*by, *([] if by else [F.lit(0)]))
    few = slotted(df.sample(GUESS_SHARE, seed=0)).groupBy(*by, "_slot").count()
    full = F.row_number().over(group.orderBy(F.desc("count"), "_slot"))  # of ``slots`` rows
    guess = few.withColumn("_rank", full).filter(F.col("_rank") <= first_slots)
    guess = write_through(guess.select(*by, "_slot"), "slots")
    if not fits_broadcast(guess):  # too many groups to send their slots
        return term_frequency(df, items, alias, *by)
    chosen, equal = same(guess.withColumn("_listed", F.lit(True)), *by, "_slot")
    pairs = slotted(df).join(F.broadcast(chosen), equal, "left")
    counts = pairs.groupBy(*by, "_slot", F.when(F.col("_listed"), F.col(alias)).alias(alias))
    counts = write_through(counts.agg(F.count(F.lit(1)).alias("count")), "top-items")
    found = counts.filter(F.col(alias).isNotNull()).drop("_slot")

    place = F.row_number().over(group.orderBy(F.desc("count")))
    last = _sliced_top(found, by, k).withColumn("_place", place).filter(F.col("_place") == k)
    last, equal = same(last.select(*by, F.col("count").alias("_least")), *by)
    # A group without so many items yet has no row in ``last``, hence no bound.
    others = counts.filter(F.col(alias).isNull()).join(F.broadcast(last), equal, "left")
    reached = F.col("_least").isNull() | (F.col("count") >= F.col("_least"))
    others = write_through(others.filter(reached).select(*by, "_slot"), "more-slots")
    if others.isEmpty():
        return found
    more, equal = same(F.broadcast(others) if fits_broadcast(others) else others, *by, "_slot")
    rest = slotted(df).join(more, equal, "left_semi").groupBy(*by, alias)
    return found.unionByName(rest.agg(F.count(F.lit(1)).alias("count")))


def _sliced_top(counts: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """The ``k`` highest counts of each group, ties as they fall."""
    if not by:
        return counts.select("count").orderBy(F.desc("count")).limit(k)
    spread = F.monotonically_increasing_id()
    return top_per_group(counts.select(*by, "count"), list(by), [F.desc("count")], k, spread=spread).drop("rank")


def top_ngrams(df: DataFrame, tokens: Column, n: int = 2, k: int = 10) -> DataFrame:
    counts = top_items(df, T.ngrams(tokens, n), "ngram", k)
    return counts.orderBy(F.desc("count"), F.asc("ngram")).limit(k)


def top_words_per_class(
    df: DataFrame, tokens: Column, k: int = 100, label_col: str = "label"
) -> DataFrame:
    """The ``k`` most frequent words of each class, counted over all rows."""
    counts = top_items(df, tokens, "word", k, [label_col])
    order = [F.desc("count"), F.asc("word")]
    return top_per_group(counts, [label_col], order, k, spread=F.col("word"))


# --- vocabulary and TF-IDF ---------------------------------------------------------


def term_statistics(df: DataFrame, tokens: Column, min_df: int = 2) -> DataFrame:
    """``(term, count, df)`` of every term in at least ``min_df`` documents."""
    return (
        term_counts(df, tokens)
        .groupBy("term")
        .agg(F.sum("tf").alias("count"), F.count(F.lit(1)).alias("df"))
        .filter(F.col("df") >= min_df)
    )


def vocabulary(df: DataFrame, tokens: Column, vocab_size: int, min_df: int = 2) -> DataFrame:
    """``(rank, term, count, df)``: most frequent terms first, ties by term.

    For vectors, whose length is ``vocab_size``: the result has at most so
    many rows, and ranking it is one small task. All terms are in
    :func:`term_statistics`.
    """
    order = [F.desc("count"), F.asc("term")]
    top = term_statistics(df, tokens, min_df).orderBy(*order).limit(vocab_size)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return top.select(rank.alias("rank"), "term", "count", "df")


def with_idf(vocab: DataFrame, n_docs: Column) -> DataFrame:
    """Smoothed inverse document frequency, ``ln((m + 1) / (df + 1))``."""
    return vocab.withColumn("idf", F.log((n_docs + 1) / (F.col("df") + 1)))


def tfidf_long(
    df: DataFrame,
    id_col: str,
    tokens: Column,
    vocab_size: int | None = None,
    min_df: int = 2,
) -> DataFrame:
    """``(id, term, tf, df, idf, tfidf)`` for all terms, or for a vocabulary.

    Statistics come first: written once, and their measured size decides how
    they meet the documents (see :func:`join_small`).
    """
    if vocab_size is None:
        vocab = term_statistics(df, tokens, min_df).select("term", "df")
    else:
        vocab = vocabulary(df, tokens, vocab_size, min_df).select("term", "df")
    weights = with_idf(write_through(vocab, "vocabulary"), F.lit(df.count()))
    terms = term_counts(df, tokens, id_col)
    joined = join_small(terms, weights, "term")
    return joined.select(
        id_col, "term", "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )


def join_small(
    big: DataFrame,
    table: DataFrame,
    key: str,
    *,
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``table``, unique by ``key``, to ``big`` whose keys may be skewed.

    A table measured within ``limit`` bytes is broadcast. A larger one is
    sorted and merged; adaptive execution then splits the partitions of hot
    keys by their measured size, however many rows they have.
    """
    if fits_broadcast(table, limit):
        return big.join(F.broadcast(table), key, how)
    return big.join(table.hint("merge"), key, how)


# --- stem dictionaries -----------------------------------------------------------------


def stem_with_dictionary(
    df: DataFrame,
    tokens_col: str,
    dictionary: DataFrame,
    out_col: str,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace tokens by the stems of a ``(token, stem)`` table.

    Tokens that are not listed stay as they are; order and repeats are kept,
    and NULL tokens give an empty array. A token listed with several stems
    takes the least. A dictionary measured within ``limit`` bytes is looked up
    inside each row by an Arrow function, with no shuffle. Of a larger one the
    entries that occur in ``df`` are taken first, which often fit; if not, the
    most frequent of them that do are looked up so. Tokens that a bitmap says
    may be among the others are joined, under a row key of this function's
    own. The result is the same. Beyond the limit ``df`` must be finite, not a
    stream.
    """
    known = dictionary.filter("token IS NOT NULL AND stem IS NOT NULL").groupBy("token")
    known = known.agg(F.min("stem").alias("stem")).filter("stem <> token")  # others change nothing
    known = write_through(known, "dictionary")
    if fits_broadcast(known, limit):
        return df.withColumn(out_col, _dictionary_lookup(df, known)(F.col(tokens_col)))
    head, tail = known.limit(0), known
    if limit > 0:
        counts = explode_tokens(df, F.array_distinct(tokens_col), "token").groupBy("token").count()
        known = write_through(known.join(counts, "token"), "dictionary")
        if fits_broadcast(known.drop("count"), limit):
            return df.withColumn(out_col, _dictionary_lookup(df, known)(F.col(tokens_col)))
        head, tail = _split_by_count(known, limit)
    # Written once: a row key made anew after a lost task would not fit.
    rows = write_through(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    at = _may_be_listed(tail)(F.col(tokens_col))
    pairs = F.transform(at, lambda i: F.struct(i.alias("pos"), F.get(tokens_col, i).alias("token")))
    found = explode_tokens(rows, pairs, "_pair", "_row").select("_row", "_pair.*")
    found = found.join(tail.hint("merge"), "token").groupBy("_row").agg(
        F.collect_list(F.struct("pos", "stem")).alias("_found")
    )
    replaced = _dictionary_lookup(df, head)
    stems = replaced(F.col(tokens_col), F.col("_found.pos"), F.col("_found.stem"))
    return rows.join(found, "_row", "left").withColumn(out_col, stems).drop("_row", "_found")


def _split_by_count(known: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The most frequent entries of ``(token, stem, count)`` that fit, and the others.

    Cut at a power of two, by the bytes of the entries below each.
    """
    power = F.floor(F.log2("count")).cast("int")
    size = F.octet_length("token") + F.octet_length("stem") + F.lit(32)
    sizes = known.groupBy(power.alias("power")).agg(F.sum(size).alias("bytes")).collect()
    least, total = 64, 0
    for row in sorted(sizes, reverse=True):  # a row a power
        total += row["bytes"]
        if total > limit:
            break
        least = row["power"]
    entries = known.select("token", "stem")
    return entries.filter(power >= least), entries.filter(power < least)


#: Bits for each entry, slots of a block, and most slots of a bitmap (32 MB).
BITS_EACH, BLOCK_SLOTS, MOST_SLOTS = 16, 1 << 16, 1 << 28


def _may_be_listed(entries: DataFrame, most: int = MOST_SLOTS):
    """An Arrow function giving the places of tokens that may be in ``entries``.

    Each token's hash sets one bit. Blocks of the bitmap are made by tasks of
    their own; a token that is listed is never missed.
    """
    blocks = max(1, min(most, BITS_EACH * entries.count()) // BLOCK_SLOTS)
    slots = blocks * BLOCK_SLOTS

    @F.arrow_udf("bigint")
    def slot(tokens: pa.Array) -> pa.Array:
        return pa.array((_hashes(tokens, BITMAP_SALT) % slots).astype(np.int64))

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        bits = np.zeros(BLOCK_SLOTS, dtype=bool)
        bits[rows["slot"].to_numpy() % BLOCK_SLOTS] = True
        return pa.table({"block": [key[0].as_py()], "bits": [np.packbits(bits).tobytes()]})

    placed = entries.select(slot("token").alias("slot"))
    placed = placed.withColumn("block", F.floor(F.col("slot") / BLOCK_SLOTS))
    made = placed.groupBy("block").applyInArrow(packed, "block bigint, bits binary").collect()
    bitmap = np.zeros((blocks, BLOCK_SLOTS // 8), dtype=np.uint8)
    for row in made:  # at most 4,096 blocks of 8 KB
        bitmap[row["block"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    shared = entries.sparkSession.sparkContext.broadcast(bitmap.ravel())

    @F.arrow_udf("array<int>")
    def places(lists: pa.Array) -> pa.Array:
        offsets, encoded = _encoded(lists)
        at = _hashes(encoded.dictionary, BITMAP_SALT) % slots
        hit = (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        hits = pc.fill_null(pa.array(hit.astype(bool)).take(encoded.indices), False)
        flat = np.flatnonzero(hits.to_numpy(zero_copy_only=False))
        ends = np.searchsorted(flat, offsets)
        own = flat - np.repeat(offsets[:-1], np.diff(ends))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(own.astype(np.int32)))

    return places


BITMAP_SALT = "bitmap".rjust(16, "0")


def _encoded(lists: pa.ListArray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Where each list starts and ends, a null one being empty, and all tokens."""
    lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy()
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return offsets, pc.cast(lists.flatten(), pa.string()).dictionary_encode()


def _hashes(tokens: pa.Array, salt: str) -> np.ndarray:
    # The hash ends at a zero character, so that is written in another way.
    tokens = pc.replace_substring(tokens, "\x01", "\x01\x01")
    tokens = pc.replace_substring(tokens, "\x00", "\x01\x02")
    return hash_array(tokens.to_numpy(zero_copy_only=False).astype(object), hash_key=salt)


class SortedDictionary:
    """Tokens sorted by hash beside their stems, as Arrow arrays.

    Both travel and stay as they are, in the bytes of their text, and are
    searched for all distinct tokens of a batch at once.
    """

    def __init__(self, tokens: pa.Array, stems: pa.Array):
        for attempt in range(100):
            self.salt = f"{attempt:016d}"
            hashes = _hashes(tokens, self.salt)
            order = np.argsort(hashes)
            self.hashes = hashes[order]
            if not (self.hashes[1:] == self.hashes[:-1]).any():
                break
        else:
            raise ValueError("tokens repeat, or no hash tells them apart")
        self.tokens, self.stems = tokens.take(pa.array(order)), stems.take(pa.array(order))

    def stemmed(
        self,
        lists: pa.ListArray,
        places: pa.ListArray | None = None,
        stems: pa.ListArray | None = None,
    ) -> pa.ListArray:
        """The lists with listed tokens replaced; a null list becomes empty.

        Where ``places`` of a list are given, ``stems`` are put there.
        """
        offsets, encoded = _encoded(lists)
        words = encoded.dictionary
        if len(self.hashes) and len(words):
            place = np.searchsorted(self.hashes, _hashes(words, self.salt))
            place = pa.array(np.minimum(place, len(self.hashes) - 1))
            listed = pc.equal(self.tokens.take(place), words)
            words = pc.if_else(listed, self.stems.take(place), words)
        taken = encoded.indices
        if places is not None:
            flat = places.flatten().to_numpy()
            starts = np.repeat(offsets[:-1], pc.fill_null(places.value_lengths(), 0).to_numpy())
            missing = taken.is_null().to_numpy(zero_copy_only=False)
            index = pc.fill_null(taken, 0).to_numpy().astype(np.int64)
            index[starts + flat] = len(words) + np.arange(len(flat))
            taken = pa.array(index, mask=missing)
            words = pa.concat_arrays([words, pc.cast(stems.flatten(), pa.string())])
        return pa.ListArray.from_arrays(pa.array(offsets), words.take(taken))


def _dictionary_lookup(df: DataFrame, dictionary: DataFrame):
    """An Arrow function mapping token arrays through a broadcast dictionary."""
    table = dictionary.toArrow()
    columns = [table[c].combine_chunks().cast(pa.string()) for c in ("token", "stem")]
    shared = df.sparkSession.sparkContext.broadcast(SortedDictionary(*columns))

    @F.arrow_udf("array<string>")
    def lookup(lists: pa.Array, *found: pa.Array) -> pa.Array:
        return shared.value.stemmed(lists, *found)

    return lookup


def distinct_tokens(df: DataFrame, tokens: Column) -> DataFrame:
    """Every token once: the left side of a stem dictionary."""
    return explode_tokens(df, F.array_distinct(tokens), "token").distinct()


def rule_dictionary(df: DataFrame, tokens: Column, depth: str = "root") -> DataFrame:
    """``(token, stem)`` by rule, each distinct token stemmed once.

    A start for a dictionary that is to be corrected by hand or extended.
    """
    stem = F.get(stem_tokens(F.array("token"), depth=depth), F.lit(0))
    return distinct_tokens(df, tokens).withColumn("stem", stem)


def vocabulary_sample(statistics: DataFrame, n: int = 20) -> DataFrame:
    """The number of all terms beside the ``n`` most frequent, ranked."""
    size = statistics.agg(F.count(F.lit(1))).scalar()
    order = [F.desc("count"), F.asc("term")]
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    top = statistics.orderBy(*order).limit(n)
    return top.select(rank.alias("rank"), "term", "count", "df").withColumn("vocab_size", size)
