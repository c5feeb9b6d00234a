"""Encoding whole texts with a byte-level BPE of the tokenizers library.

A byte-level BPE cuts a text into pre-tokens and encodes each on its own.  A
plain space between two characters that are not white space always starts a
pre-token, and a line feed between two such characters is one.  No pre-token
holds two of these: a Latin letter, an ASCII digit, an ASCII mark other than
the apostrophe.  So a text cut there into chunks encodes to the chunks' ids one
after the other.  The cuts of a whole slice of texts are found on its bytes by
numpy (next to bytes that may belong to other white space no cut is made),
Arrow tells the distinct chunks, only chunks not met before go to the
tokenizer (those of one kind, which are one pre-token, without its regular
expression), and the ids of all texts are gathered from those of the distinct
chunks by offsets.  Chunks met are kept in two generations of bounded size.

Special tokens in a text (as ``<|endoftext|>``) become their ids, as the
library does by default; they hold no white space, and where the kind changes
within one no cut is made, so none goes through one.
"""

from __future__ import annotations

import os
import string
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 500_000                 # chunks of a generation; a worker keeps two
SLICE = 1 << 22                 # bytes of text cut into chunks at a time
END_ID = 0


def _flags(*values: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


#: ASCII bytes that are white space, and first bytes of the
#: UTF-8 forms of all other white space.
ASCII_SPACE = _flags(*range(0x09, 0x0E), *range(0x1C, 0x21))
SPACE_LEAD = _flags(0xC2, 0xE1, 0xE2, 0xE3)
CUTTERS = _flags(0x0A, 0x20)


def _kinds() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for kind, values in ((1, string.ascii_letters), (2, string.digits), (3, string.punctuation.replace("'", ""))):
        table[list(values.encode())] = kind
    return table


#: 1: letters, 2: digits, 3: marks, all ASCII; 0: others.  Letters are also the
#: two bytes of the UTF-8 forms U+00C0 to U+00FF but the signs U+00D7, U+00F7.
KINDS = _kinds()
LETTER, LATIN_LEAD = 1, 0xC3
LATIN_SIGN = _flags(0x97, 0xB7)


def _alphabet() -> dict[int, str]:
    """The byte alphabet of byte-level tokenizers: printable Latin-1 bytes
    stand for themselves, the others, in order, for U+0100 and following."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (chr(0x100 + i) for i in range(256))
    return {b: chr(b) if b in own else next(others) for b in range(256)}


ALPHABET = _alphabet()


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def kinds(raw: np.ndarray) -> np.ndarray:
    """Kind of each byte."""
    kind = KINDS[raw]
    at = np.flatnonzero(raw[:-1] == LATIN_LEAD)
    at = at[~LATIN_SIGN[raw[at + 1]]]
    kind[at] = kind[at + 1] = LETTER
    return kind


def pairs_within(special: list[str]) -> np.ndarray:
    """Flags of 256 * (a byte) + (the next one), as they stand in special tokens."""
    out = np.zeros(1 << 16, bool)
    for t in map(str.encode, special):
        out[[256 * a + b for a, b in zip(t, t[1:])]] = True
    return out


def chunk_starts(raw: np.ndarray, starts: np.ndarray, kind: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets where a chunk starts: those of the texts (``starts``), the
    spaces and line feeds that surely stand between other characters, what
    follows such a line feed, and changes of the kind; and whether each chunk
    is of one kind but for a space ahead."""
    at = np.flatnonzero(CUTTERS[raw])
    at = at[(at > 0) & (at < len(raw) - 1)]
    last, after = raw[at - 1], raw[at + 1]
    ok = ~(ASCII_SPACE[last] | ASCII_SPACE[after] | SPACE_LEAD[after])
    at, last = at[ok], last[ok]
    # the character before: its lead is one to three bytes further ahead
    wide = np.flatnonzero(last >= 0x80)
    two, three = raw[np.maximum(at[wide] - 2, 0)], raw[np.maximum(at[wide] - 3, 0)]
    unsure = SPACE_LEAD[two] | ((two >= 0x80) & (two < 0xC0) & SPACE_LEAD[three])
    at = np.delete(at, wide[unsure])
    change = 1 + np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0))
    kept = within[raw[change - 1].astype(np.uint16) << 8 | raw[change]]
    # (before a space that ends its text a cut is right as well)
    inner = np.zeros(len(raw), bool)
    inner[at] = True
    inner[at[raw[at] == 0x0A] + 1] = True
    inner[change[~kept]] = True
    inner[starts] = True
    first = np.flatnonzero(inner)
    other = kind == 0
    other[first[raw[first] == 0x20]] = False
    other[change[kept]] = True
    return first, ~np.logical_or.reduceat(other, first) if len(first) else np.zeros(0, bool)


class Table:
    """What is kept of the chunks met (``value`` of their encoding), in two
    generations of bounded size."""

    def __init__(self, tok, bare, value: Callable):
        self.tok, self.bare, self.value = tok, bare, value
        self.known: dict[bytes, object] = {}
        self.older: dict[bytes, object] = {}

    def look_up(self, chunks: list[bytes], plain: np.ndarray) -> list:
        """Values of distinct chunks; ``plain`` ones are of one kind."""
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known         # what is not met again goes
        known, older = self.known, self.older
        out = list(map(known.get, chunks))
        new = [i for i, v in enumerate(out) if v is None]
        for i in new:
            out[i] = older.get(chunks[i])
        known.update([(chunks[i], out[i]) for i in new if out[i] is not None])
        new = np.array([i for i in new if out[i] is None], np.int64)
        words, mixed = new[plain[new]].tolist(), new[~plain[new]].tolist()
        texts = b"\n".join([chunks[i] for i in words]).decode("latin-1").translate(ALPHABET).split(ALPHABET[0x0A])
        for at, tok, asked in ((words, self.bare, texts),
                               (mixed, self.tok, [chunks[i].decode("utf-8", "replace") for i in mixed])):
            if at:
                got = map(self.value, tok.encode_batch_fast(asked, add_special_tokens=False))
                for i, v in zip(at, got, strict=True):
                    known[chunks[i]] = out[i] = v
        return out


class Encoder:
    """Ids of texts; equal to encoding each whole text by the tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        if any(c.isspace() for t in special for c in t):
            raise ValueError("a special token with white space could be cut")
        self.within = pairs_within(special)
        # for chunks of one kind, which are one pre-token, in the byte alphabet
        bare = Tokenizer.from_file(path)
        bare.pre_tokenizer = None
        self.size = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        code = "H" if self.dtype.itemsize == 2 else "I"
        self.ids = Table(self.tok, bare, lambda e: array(code, e.ids).tobytes())
        self.counts = Table(self.tok, bare, len)

    def _slices(self, texts: pa.Array) -> Iterator[pa.Array]:
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(texts):
            before = int(ends[first - 1]) if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, before + SLICE, "right")))
            yield texts.slice(first, stop - first)
            first = stop

    def _chunks(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """(the distinct chunks, which are of one kind, all chunks by number,
        first chunk of each text and their count at the end)."""
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
        body = texts.buffers()[2]
        raw = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body else np.zeros(0, np.uint8)
        offsets -= offsets[0]
        starts = np.unique(offsets[:-1][offsets[:-1] < len(raw)])
        starts, plain = chunk_starts(raw, starts, kinds(raw), self.within)
        bounds = pa.py_buffer(np.append(starts, len(raw)).astype(np.int32))
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(raw)])
        coded = chunks.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        of_one_kind = np.zeros(len(coded.dictionary), bool)
        of_one_kind[codes] = plain
        return coded.dictionary.to_pylist(), of_one_kind, codes, np.searchsorted(starts, offsets)

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text of a binary array (no nulls)."""
        out = [np.zeros(0, np.int64)]
        for part in self._slices(texts):
            chunks, plain, codes, first = self._chunks(part)
            n = np.fromiter(self.counts.look_up(chunks, plain), np.int64, len(chunks))
            total = np.concatenate([[0], np.cumsum(n[codes])])
            out.append(np.diff(total[first]))
        return np.concatenate(out)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids of some texts one after the other, ends of the texts in them)
        for all texts of a binary array (no nulls), slice by slice."""
        for part in self._slices(texts):
            chunks, plain, codes, first = self._chunks(part)
            ids = self.ids.look_up(chunks, plain)
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
            flat = np.frombuffer(b"".join(ids), self.dtype)
            of = n[codes]
            total = np.concatenate([[0], np.cumsum(of)])
            place = np.repeat((np.cumsum(n) - n)[codes] - total[:-1], of) + np.arange(int(total[-1]))
            yield flat[place], total[first[1:]]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
