"""Whole texts to token ids with a public tokenizer file, word by word.

Two kinds of file are known: byte-level ones that keep white space, and ones
that lower-case words and drop it. Both split a text before merging, and a
blank between two words is always such a split. So texts are cut at blanks
(and, where the file allows it, at line ends) by Arrow, some of them at a time,
and every distinct piece is encoded once by the tokenizers library; two bounded
tables keep the ids of recent pieces as little-endian 32-bit bytes. Arrow looks
the pieces up and joins their ids. Texts with a run of white space that a blank
may not cut, and all texts under a file of another kind, are encoded whole.

Pieces not met before are given to the library's model many at a time, if they
are Latin letters with marks behind them and no token of the file reaches over
a border between letters, marks and pieces.
"""

from __future__ import annotations

import codecs
import json
import re
import string
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

ID_BYTES = 4
#: Pieces in each of a worker's two tables; only speed depends on it.
CACHED_PIECES = 300_000
#: Bytes of text that are split at a time; a longer text is split alone.
HELD_BYTES = 8 << 20
#: New pieces that the model gets in one call.
JOINED_PIECES = 128
#: Below it, letters, lower case and composition are the same in every Unicode.
LATIN_END = "İ"


def _byte_letters() -> list[str]:
    """The letter that byte-level files write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


_LETTERS = _byte_letters()
_BYTE_TABLE = "".join(_LETTERS)
_BLANK, _LINE_END = _LETTERS[32], _LETTERS[10]

#: Pieces that may be joined: letters whose bytes are no others' than letters'.
_WIDE = "".join(c for c in map(chr, range(0xC0, ord(LATIN_END))) if c.isalpha())
_MARKS = re.escape(string.punctuation)
_plain = re.compile(f"\n?[A-Za-z{_WIDE}]+[{_MARKS}]*").fullmatch


def _over_borders() -> re.Pattern:
    """Tokens that plain pieces next to each other may hold over a border."""
    bytes_ = sorted({b for c in _WIDE for b in c.encode()})
    letters = "A-Za-z" + "".join([_LETTERS[b] for b in bytes_])
    starts, any_ = _BLANK + _LINE_END, f"[{_BLANK}{_LINE_END}{letters}{_MARKS}]*"
    borders = f"[{letters}{_MARKS}][{starts}]|{_LINE_END}[{letters}]|[{letters}][{_MARKS}]"
    return re.compile(f"{any_}(?:{borders}){any_}")


@lru_cache(64)
def _packer(n: int):
    return struct.Struct(f"<{n}I").pack


def _packed(ids: list[int]) -> bytes:
    """As little-endian unsigned 32-bit integers."""
    return _packer(len(ids))(*ids)


class Encoder:
    """Encodes whole texts as the library does without added special tokens.

    A special token's string in a text becomes its id, as the file says; with
    ``special_as_text`` it is ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [] if special_as_text else [token.content for token in added]
        self.model = self.tokenizer.model
        file = json.loads(self.tokenizer.to_str())
        self.kind = _kind(file)
        self.starts = _starts(file) if self.kind == "blanks" else None
        self.pieces = _Pieces(self)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return _packed(ids)

    def word(self, word: str, before: str = "") -> bytes:
        """The ids of one word of Latin letters, which no split divides."""
        letters = word if word.isascii() else "".join([_LETTERS[b] for b in word.encode()])
        return _packed([t.id for t in self.model.tokenize(before + letters)])

    def plain(self, pieces: list[str]) -> list[bytes]:
        """The ids of plain pieces, from one call of the model."""
        text = "".join([p if p[0] == "\n" else " " + p for p in pieces])
        letters = codecs.charmap_decode(text.encode(), "strict", _BYTE_TABLE)[0]
        ids = np.array([t.id for t in self.model.tokenize(letters)], "<u4")
        cuts = [*(np.flatnonzero(self.starts[ids]) * ID_BYTES).tolist(), ids.nbytes]
        data = ids.tobytes()
        return [data[i:j] for i, j in zip(cuts, cuts[1:])]

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        return next(self.encode_all(pa.array([text], pa.string())))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """:meth:`encode` of each text; null as empty."""
        for some in _slices(texts):
            alone = self._alone(some)
            rest = iter(self._from_pieces(some.filter(pa.array(~alone))))
            for k, whole in enumerate(alone.tolist()):
                ids = None if whole else next(rest)
                yield self.whole(some[k].as_py()) if ids is None else ids

    def _alone(self, texts: pa.Array) -> np.ndarray:
        """Whether a text need not be split, as it has to be encoded whole anyway."""
        alone = np.full(len(texts), self.kind is None)
        for part in self.special + [" \n"] * (self.kind == "blanks"):
            alone |= pc.match_substring(texts, part).to_numpy(zero_copy_only=False)
        return alone

    def _from_pieces(self, texts: pa.Array) -> list[bytes | None]:
        """Each text's ids, None where it has to be encoded whole."""
        if not len(texts):
            return []
        blanks = self.kind == "blanks"
        cut = pc.replace_substring(texts, "\n", " \n" if blanks else " ")
        cut = pc.split_pattern(cut, " ")
        coded = cut.values.dictionary_encode()
        found = self.pieces.of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        places, offsets = coded.indices.to_numpy(), cut.offsets.to_numpy()
        if blanks:  # a text's first piece has no blank before it
            first = offsets[:-1]
            places = places.copy()
            places[first] = np.arange(len(found), len(found) + len(texts))
            found += map(self.whole, cut.values.take(pa.array(first)).to_pylist())
        ids = pa.array(found, pa.large_binary()).take(pa.array(places))
        whole = np.logical_or.reduceat(ids.is_null().to_numpy(zero_copy_only=False), offsets[:-1])
        ends = np.frombuffer(ids.buffers()[1], np.int64)[offsets].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        spans = zip(ends, ends[1:], whole.tolist())
        return [None if alone else bytes(data[i:j]) for i, j, alone in spans]


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive texts of some ``HELD_BYTES`` together, null as empty."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    first = 0
    while first < len(texts):
        reach = HELD_BYTES + (ends[first - 1] if first else 0)
        last = max(first + 1, int(np.searchsorted(ends, reach, "right")))
        yield pc.fill_null(texts.slice(first, last - first), "")
        first = last


def _starts(file: dict) -> np.ndarray | None:
    """Whether a token, by its id, starts a piece; None if pieces may not be joined."""
    model = file["model"]
    changed = ("ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")
    crosses = _over_borders().fullmatch
    if any(model.get(k) for k in changed) or any(map(crosses, model["vocab"])):
        return None
    starts = np.zeros(max(model["vocab"].values()) + 1, bool)
    starts[[k for t, k in model["vocab"].items() if t[:1] in (_BLANK, _LINE_END)]] = True
    return starts


def _kind(file: dict) -> str | None:
    """``blanks`` or ``words``, by how a file splits; None for any other."""
    model, split = file["model"], file["pre_tokenizer"] or {}
    if model["type"] != "BPE" or model.get("dropout"):
        return None
    steps = split.get("pretokenizers", [split])
    if [s.get("type") for s in steps] == ["ByteLevel"]:
        plain = steps[0]["use_regex"] and not steps[0]["add_prefix_space"]
        return "blanks" if plain and file["normalizer"] is None else None
    if [s.get("type") for s in steps] == ["Split", "ByteLevel"]:
        steps_before = [n["type"] for n in (file["normalizer"] or {}).get("normalizers", [])]
        drops = steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        return "words" if drops and steps_before == ["NFC", "Replace", "Lowercase"] else None
    return None


class _Pieces(dict):
    """Piece -> ids as bytes; None where the text has to be encoded whole.

    When the table is full it becomes the old one and an empty one starts;
    pieces met again are moved over, so frequent ones stay.
    """

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.old, self.marks = encoder, {}, {}

    def trim(self, more: int) -> None:
        """Makes room for ``more`` pieces."""
        if len(self) + more > CACHED_PIECES:
            self.old = dict(self)
            self.clear()

    def of(self, pieces: list[str]) -> list[bytes | None]:
        """The ids of distinct pieces."""
        found = list(map(self.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        self.trim(len(missing))
        if self.encoder.starts is not None:
            self._join([pieces[i] for i in missing])
        for i in missing:
            found[i] = self[pieces[i]]
        return found

    def _join(self, pieces: list[str]) -> None:
        """Adds those of the pieces that are new and plain."""
        new = [piece for piece in pieces if piece not in self.old and _plain(piece)]
        for k in range(0, len(new), JOINED_PIECES):
            some = new[k : k + JOINED_PIECES]
            self.update(zip(some, self.encoder.plain(some), strict=True))

    def __missing__(self, piece: str) -> bytes | None:
        ids = self.old.get(piece)
        if ids is None:
            ids = self._made(piece)
        self[piece] = ids
        return ids

    def _made(self, piece: str) -> bytes | None:
        encoder = self.encoder
        if _simple(piece):
            if encoder.kind == "blanks":
                return encoder.word(piece, _BLANK)
            lower = piece.lower()
            return encoder.word(piece) if lower == piece else self[lower]
        if piece[-1:] and piece[-1] in ".,!?;:" and _simple(piece[:-1]):
            return self[piece[:-1]] + self._mark(piece[-1])  # a mark is always cut off
        if encoder.kind == "words":
            return encoder.whole(piece)
        if piece[:1] == "\n":
            if _simple(piece[1:]):  # a single line end is always a piece of its own
                return self._mark("\n") + encoder.word(piece[1:])
            return None if not piece[1:] or piece[1].isspace() else encoder.whole(piece)
        return None if not piece or piece[0].isspace() else encoder.whole(" " + piece)

    def _mark(self, mark: str) -> bytes:
        if mark not in self.marks:
            self.marks[mark] = self.encoder.whole(mark)
        return self.marks[mark]


def _simple(piece: str) -> bool:
    return piece.isalpha() and (piece.isascii() or max(piece) < LATIN_END)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; its tables live as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_all(path: str, texts: pa.Array | Iterable[str | None]) -> Iterator[bytes]:
    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.string())
    return encoder(path).encode_all(texts)
