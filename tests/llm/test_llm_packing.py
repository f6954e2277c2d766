from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from itertools import product
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textstyle.llm import encoding, packing, token_files
from textstyle.llm.encoding import Encoder

FILES = {k: public_tokenizers.path(k) for k in ("byte_bpe_50k.json", "word_bpe_49k.json")}
ODD = [
    "", " ", "a  b", "a   b", " a", "a\n\nb", "a \n b", "x's they're", "É. é.é", "Iİ.", "a\tb", "don't.",
    "\n", "a\n", "ab.\n", "ﬁ. ǆ", "é. x", "a\x1cb c\x85d", "12. 3", "<|endoftext|> x", "Foo.\nBar, baz!",
    "漢字 かな。", "😀 ok. 😀😀", "a b", "ÀÉ.\nÇa", "x\r\ny",
]
ENCODERS = {name: Encoder(path) for name, path in FILES.items()}


@pytest.mark.parametrize("name", FILES)
def test_word_by_word_is_whole(name, spark, sf_dir):
    encoder = ENCODERS[name]
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert encoder.kind
    for text in ODD + texts[:60] + ODD:
        assert encoder.encode(text) == encoder.whole(text)


@pytest.mark.parametrize("name", FILES)
def test_default_is_the_plain_library(name):
    plain = Tokenizer.from_file(FILES[name])
    literal = Encoder(FILES[name], special_as_text=True)
    odd = [*ODD, "a <|endoftext|> b", "a<|endoftext|><|startoftext|>b c", "<|ENDOFTEXT|> <|endoftext|>"]
    for text in odd:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert ENCODERS[name].encode(text) == np.array(ids, "<u4").tobytes()
    end = plain.get_vocab_size() - 1
    assert end not in np.frombuffer(literal.encode("a <|endoftext|> b"), "<u4")
    assert end in np.frombuffer(ENCODERS[name].encode("a <|endoftext|> b"), "<u4")


@given(st.text(alphabet="aBé \n\t.,'1 ", max_size=30))
@settings(max_examples=300, deadline=None)
def test_any_text_is_whole(text):
    for encoder in ENCODERS.values():
        assert encoder.encode(text) == encoder.whole(text)


@given(
    st.lists(st.none() | st.text(alphabet="aÝÀ®ª°­…’s\n .,'\"|<", max_size=12), max_size=12),
    st.integers(0, 40),
)
@settings(max_examples=200, deadline=None)
def test_column_is_whole(texts, held):
    """However texts fall into slices and pieces into tables and calls."""
    small = {"HELD_BYTES": held, "CACHED_PIECES": 5, "JOINED_PIECES": 3}
    column = pa.array(["dropped", *texts], pa.string())[1:]
    with pytest.MonkeyPatch.context() as patch:
        for name, value in small.items():
            patch.setattr(encoding, name, value)
        for encoder in ENCODERS.values():
            got = list(encoder.encode_all(column))
            assert got == [encoder.whole(text or "") for text in texts]
            assert list(encoder.encode_all(column.cast(pa.large_string()))) == got


def test_new_words_share_calls_of_the_model():
    encoder, calls = Encoder(FILES["byte_bpe_50k.json"]), []
    model = encoder.model
    encoder.model = SimpleNamespace(tokenize=lambda x: calls.append(x) or model.tokenize(x))
    parts = product("QXJz", "kvwÿ", "é", "ghjq", ["", ",", "!?", "%%%"])
    words = ["".join(x) for x in parts]
    texts = [" ".join(words[k : k + 8]) + f"\n{words[k]}" for k in range(0, len(words), 8)]
    got = list(encoder.encode_all(pa.array(texts)))
    assert got == [encoder.whole(text) for text in texts]
    assert 0 < len(calls) <= 2 + len(words) // encoding.JOINED_PIECES


@pytest.mark.parametrize(
    "changed", [{"vocab": {"e.": 1}}, {"vocab": {"aĠ": 1}}, {"vocab": {"Ċa": 1}},
                {"ignore_merges": True}, {"end_of_word_suffix": "</w>"}]
)
def test_pieces_are_not_joined_where_tokens_reach_over(changed):
    model = {"vocab": {"Ġ": 0, "Ċ": 1, "a": 2, "âĢ¦.": 3, "Ġa": 4}}
    assert encoding._starts({"model": model}).tolist() == [True, True, False, False, True]
    assert encoding._starts({"model": model | changed}) is None


@given(st.lists(st.integers(1, 32), max_size=60))
@settings(max_examples=300, deadline=None)
def test_plan_is_best_fit_decreasing(lengths):
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else 32
        insort(rooms, room - n)
    counts = Counter(lengths)
    plan = packing.best_fit_plan(counts, 32)
    assert plan.sequences == len(rooms)
    # Replay the runs: every piece once, sequences gapless.
    placed, filled = Counter(), {}
    runs = sorted(zip(plan.length, plan.rank, plan.each, plan.sequence, plan.offset))
    for k, (n, rank, each, sequence, offset) in enumerate(runs):
        last = k + 1 == len(runs) or runs[k + 1][0] != n
        upto = counts[n] if last else runs[k + 1][1]
        for r in range(rank, upto):
            s, o = sequence + (r - rank) // each, offset + (r - rank) % each * n
            filled.setdefault(s, []).append((o, n))
            placed[n] += 1
    assert placed == counts
    for parts in filled.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 32


def test_pieces_and_sequences(spark):
    tokenizer = Tokenizer.from_file(FILES["byte_bpe_50k.json"])
    rows = [(1, "word " * 50, "x"), (1, "word " * 50, "x"), (2, None, "x"), (3, "", None), (None, "one two", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    packed = packing.pack(docs, FILES["byte_bpe_50k.json"], capacity=16, keep_ids=True).cache()
    own = {}
    for r in sorted(packed.collect(), key=lambda r: (r["doc_id"] or 0, r["piece"])):
        assert r["length"] <= 16 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        assert r["piece"] == 0 or r["length"] == 16
        own.setdefault((r["doc_id"], r["piece"]), []).append(r)
    ids = tokenizer.encode("word " * 50, add_special_tokens=False).ids + [0]
    pieces = [own[(1, k)][0]["ids"] for k in range(-(-len(ids) // 16))]
    assert b"".join(pieces) == np.array(ids, "<u4").tobytes()
    assert all(len(v) == (2 if k[0] == 1 else 1) for k, v in own.items())
    assert [own[(k, 0)][0]["length"] for k in (2, 3)] == [1, 1]
    sequences = packing.sequences(packed).collect()
    assert sum(r["length"] for r in sequences) == 2 * len(ids) + 2 + 3
    assert all(len(r["ids"]) == 4 * r["length"] for r in sequences)
    assert packing.pack(docs.limit(0), FILES["byte_bpe_50k.json"]).count() == 0


def test_files_round_trip(spark):
    path = FILES["word_bpe_49k.json"]
    rows = [(k, " ".join(["some words", "more"] * (k % 7)), "x") for k in range(40)]
    rows += [(None, "no id", "x"), (5, None, "x"), (5, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string").repartition(5)
    manifest = token_files.write(docs, path, end_id=2, length=8, shards=3)
    got = token_files.read_documents(manifest, docs.schema["doc_id"]).collect()
    encoder, want, at = ENCODERS["word_bpe_49k.json"], Counter(), 0
    keyed = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0]))
    starts = {}
    for key, text, _ in keyed:
        ids = encoder.whole(text or "") + (2).to_bytes(4, "little")
        want[(key, len(ids) // 4, zlib.crc32(ids))] += 1
        starts.setdefault(key, at)
        at += len(ids) // 4
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    for r in got:
        if r["doc_id"] != 5:
            assert r["start"] == starts[r["doc_id"]]
    first = manifest.orderBy("shard").first()
    ids, mask = token_files.Shard(f"{first['file']}.arrow").sequence(0)
    assert len(ids) == len(mask) == 8 and not ids.flags.owndata
    last = -(-first["n_tokens"] // 8) - 1
    mask = token_files.Shard(f"{first['file']}.arrow").sequence(last)[1].to_pylist()
    assert sum(mask) == first["n_tokens"] - 8 * last
    assert token_files.write(docs.limit(0), path, end_id=2).count() == 0
