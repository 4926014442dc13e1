"""Token ids of whole texts, with every distinct piece of a batch encoded once.

Both public tokenizers here cut a text at spaces before they merge, so a text
is the sequence of its space-separated pieces and a piece's ids depend on the
piece alone.  Arrow finds the distinct pieces of a batch of texts.  Pieces of
Latin letters and common marks are cut into pre-tokens at sight, others by the
library's own normalizer and pre-tokenizer.  The library's model meets the
distinct pre-tokens of all pieces in one call, and the ids of the texts are
gathered from those of the pieces.  Where a cut at spaces is not safe (white space
beside a space, for the byte-level kind) the library encodes the whole text.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ID = np.dtype("<u4")
if sys.byteorder != "little":
    raise ImportError("token ids are kept as little-endian 32-bit numbers")
# bytes of text that are encoded together, and pre-tokens that the model meets in one call
BATCH_BYTES = 6 << 20
CALL_UNITS = 30_000
# words of Latin letters with a mark behind some, and line ends between them
_WORD = "[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?"
PLAIN = f"^{_WORD}(?:\n{_WORD})*$"
# what separates pieces, and pre-tokens of a piece: the model's alphabet has no white space
BETWEEN, INSIDE = "\n", " "


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies.

    Bytes that print in Latin-1 stand for themselves, the others for the
    code points from 256 on, in order.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def _gathered(ids: np.ndarray, first: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of ``ids`` picked by ``codes``, end to end, and how long each is (32-bit numbers where they do)."""
    small = np.int32 if len(ids) < 1 << 31 else np.int64
    each = size.astype(small)[codes]
    n = int(each.sum(dtype=np.int64))
    small = small if n < 1 << 31 else np.int64
    at = first.astype(small)[codes]
    at -= np.cumsum(each, dtype=small)
    at += each
    at = np.repeat(at, each)
    at += np.arange(n, dtype=small)
    return ids[at], each


class Encoder:
    """Encodes texts to 32-bit ids, without special tokens (their strings are plain text)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.norm, self.pre = self.tok.normalizer, self.tok.pre_tokenizer
        # a byte-level vocabulary joins a word with the space before it
        self.spaced = "Ġthe" in self.tok.get_vocab()
        alphabet = byte_alphabet()
        # of a piece's bytes in UTF-8, bytes 0 and 1 standing for the separators
        self.points = np.array([ord(alphabet[b]) for b in range(256)], dtype="<u4")
        self.points[0], self.points[1] = ord(BETWEEN), ord(INSIDE)
        self.model = Tokenizer(self.tok.model)
        self.model.pre_tokenizer = pre_tokenizers.Split(INSIDE, "removed")
        # characters of a pre-token that each id stands for
        vocab, suffix = self.tok.get_vocab(), getattr(self.tok.model, "end_of_word_suffix", None) or ""
        self.lengths = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.lengths[i] = len(token) - len(suffix) * token.endswith(suffix)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=ID)

    def _plain(self, pieces: pa.Array, space: str) -> str:
        """Pre-tokens of pieces of letters and marks, in the model's alphabet."""
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(pieces)], pieces), "\0" + space)[0].as_py()
        if not self.spaced:
            joined = joined.lower()
        raw = (space + joined).encode().replace(b".", b"\1.").replace(b",", b"\1,")
        raw = raw.replace(b"\n", b"\1\n\1" if self.spaced else b"\1")
        return self.points[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-32-le")

    def _other(self, piece: str, space: str) -> str:
        if self.norm is not None:
            piece = self.norm.normalize_str(piece)
        return INSIDE.join([u for u, _ in self.pre.pre_tokenize_str(space + piece)])

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pre-tokens, and where those of each end."""
        lots = np.append(np.arange(0, len(units), CALL_UNITS), len(units)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(lots), units), INSIDE)
        ids = np.concatenate([np.array(self.model.encode_batch_fast([x], add_special_tokens=False)[0].ids, dtype=ID)
                              for x in joined.to_pylist()])
        ends, stops = np.cumsum(self.lengths[ids]), np.cumsum(pc.utf8_length(units).to_numpy())
        at = np.searchsorted(ends, stops, side="right")
        if (np.append(0, ends)[at] == stops).all():
            return ids, at
        # characters without an id: the lengths tell nothing, one by one
        each = [x.ids for x in self.model.encode_batch_fast(units.to_pylist(), add_special_tokens=False)]
        return np.array([i for x in each for i in x], dtype=ID), np.cumsum([len(x) for x in each])

    def _pieces(self, pieces: pa.Array, space: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of pieces: all ids, each piece's first one and their number, and which pieces may not be cut off."""
        n = len(pieces)
        space = space if self.spaced else ""
        plain = pc.match_substring_regex(pieces, PLAIN).to_numpy(zero_copy_only=False)
        uncut, texts = np.zeros(n, dtype=bool), []
        if plain.any():
            texts.append(self._plain(pieces.filter(pa.array(plain)), space))
        rest = np.flatnonzero(~plain)
        for i, piece in zip(rest.tolist(), pieces.take(pa.array(rest)).to_pylist()):
            uncut[i] = self.spaced and (not piece or piece[-1].isspace())
            texts.append("" if uncut[i] else self._other(piece, space))
        rows = pc.split_pattern(pa.array([BETWEEN.join(texts)]), BETWEEN).flatten()
        lists = pc.split_pattern(rows, INSIDE)
        coded = lists.flatten().dictionary_encode()
        ids, stops = self._units(coded.dictionary)
        size = np.diff(stops, prepend=0)
        ids, each = _gathered(ids, stops - size, size, coded.indices.to_numpy())
        count = np.empty(n, np.int64)
        order = np.concatenate([np.flatnonzero(plain), rest])
        by_row = np.add.reduceat(each, lists.offsets.to_numpy()[:-1], dtype=np.int64)
        first = np.empty(n, np.int64)
        count[order], first[order] = by_row, np.cumsum(by_row) - by_row
        return ids, first, count, uncut

    def many(self, texts: pa.Array, after_space: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts end to end, and how many each has (null: none).

        ``after_space`` puts a space before each text, for a byte-level
        vocabulary.  Callers bound the texts by :data:`BATCH_BYTES`.
        """
        texts, n = pc.fill_null(texts, ""), len(texts)
        before = " " if after_space else ""
        if not n:
            return np.zeros(0, ID), np.zeros(0, np.int64)
        lists = pc.split_pattern(texts, " ")
        ends = lists.offsets.to_numpy().astype(np.int64)
        begin, coded = ends[:-1], lists.flatten().dictionary_encode()
        # the pieces one by one are not kept while their ids are made
        del lists
        codes, distinct = coded.indices.to_numpy().copy(), coded.dictionary
        del coded
        ids, first, size, uncut = self._pieces(distinct, " ")
        if self.spaced and not after_space:
            # no space before a text's first piece
            parts = self._pieces(distinct.take(pa.array(codes[begin])), "")
            codes[begin] = len(size) + np.arange(n)
            first = np.concatenate([first, parts[1] + len(ids)])
            ids, size, uncut = (np.concatenate(x) for x in ((ids, parts[0]), (size, parts[2]), (uncut, parts[3])))
        whole = np.flatnonzero(np.logical_or.reduceat(uncut[codes], begin)) if uncut.any() else begin[:0]
        if len(whole):
            # texts with a piece that may not be cut off: one piece, and no ids for the others
            of = np.repeat(np.arange(n), np.diff(ends))
            codes[np.isin(of, whole)] = len(size)
            codes[begin[whole]] = len(size) + 1 + np.arange(len(whole))
            parts = [self._whole(before + texts[r].as_py()) for r in whole.tolist()]
            own = np.array([0, *map(len, parts)])
            first = np.concatenate([first, len(ids) + np.cumsum(own) - own])
            size, ids = np.concatenate([size, own]), np.concatenate([ids, *parts])
        out, each = _gathered(ids, first, size, codes)
        return out, np.add.reduceat(each, begin, dtype=np.int64)

    def __call__(self, text: str | None) -> bytes:
        """Little-endian ids of one text (null: none)."""
        return self.many(pa.array([text], pa.string()))[0].tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts end to end with ``end_id`` behind each, and where each ends now."""
    return np.insert(ids, np.cumsum(counts), end_id), np.cumsum(counts + 1)


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
