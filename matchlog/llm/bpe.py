"""Byte-level BPE by distinct words, vectorised over many texts.

A byte-level BPE first splits a text into words and then merges within each
word, so a word's ids do not depend on its neighbours.  ``split`` finds the
words of a list of texts with numpy; each distinct word is encoded once and
the ids are gathered back by position.

The words are those of the vocabulary's published pattern::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

and the special string ``<|endoftext|>`` is a word of its own.
"""

from __future__ import annotations

import functools
import itertools
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import ragged

SPECIAL = "<|endoftext|>"
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# A worker keeps the ids of about so many words, the first that it sees; all
# others are merged anew in every step.
CACHE_WORDS = 300_000


@functools.cache
def char_classes() -> np.ndarray:
    """Class of every code point, from the pattern's own character classes."""
    import regex

    points = np.concatenate([np.arange(0xD800, dtype=np.uint32), np.arange(0xE000, 0x110000, dtype=np.uint32)])
    every = points.tobytes().decode("utf-32-le")
    table = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, every):
            table[points[m.start()] : points[m.end() - 1] + 1] = kind
    return table


@dataclass
class Words:
    """Words of some texts: ``codes`` index ``distinct``; text i has the words
    ``bounds[i] .. bounds[i + 1] - 1``.  ``char_starts`` are the words' places in
    the concatenated texts (with one more entry for the end)."""

    distinct: pa.Array
    codes: np.ndarray
    bounds: np.ndarray
    char_starts: np.ndarray
    text_starts: np.ndarray


def code_points(joined: str) -> np.ndarray:
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32)


def byte_starts(points: np.ndarray) -> np.ndarray:
    """UTF-8 offset of every code point, and the end."""
    out = np.zeros(len(points) + 1, np.int64)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    np.cumsum(width, out=out[1:])
    return out


def word_starts(points: np.ndarray, cuts: np.ndarray, specials: np.ndarray) -> np.ndarray:
    """Whether a word starts at each code point.  ``cuts``: places where a text
    starts; ``specials``: places of the special string."""
    n = len(points)
    kind = char_classes()[points]
    first = np.zeros(n + 1, bool)
    first[cuts] = True
    first[specials] = True
    first[specials + len(SPECIAL)] = True
    text_start = first[:n].copy()
    starts = text_start.copy()
    starts[1:] |= kind[1:] != kind[:-1]
    # The last white-space character before another kind stands alone, and a
    # plain space joins the word that follows.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~text_start[1:])
    starts[last] = True
    joins = last[points[last] == 32]
    starts[joins + 1] = False
    # Contractions.
    quote = np.flatnonzero((points == 39) & starts)
    if len(quote):
        same = np.cumsum(text_start)
        at = lambda k: np.where(
            (quote + k < n) & (same[np.minimum(quote + k, n - 1)] == same[quote]), points[np.minimum(quote + k, n - 1)], 0
        )
        one, two = at(1), at(2)
        length = np.zeros(len(quote), np.int64)
        length[np.isin(one, [ord(c) for c in "stmd"])] = 2
        for pair in ("re", "ve", "ll"):
            length[(one == ord(pair[0])) & (two == ord(pair[1]))] = 3
        quote, length = quote[length > 0], length[length > 0]
        starts[quote + 1] = False
        after = quote + length
        starts[after[after < n]] = True
    for k in range(1, len(SPECIAL)):
        starts[specials + k] = False
    return starts


def split(texts: list[str]) -> Words:
    whole = "".join(texts)
    points = code_points(whole)
    text_starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=text_starts[1:])
    specials = []
    if SPECIAL in whole:
        for t, at in zip(texts, text_starts):
            k = t.find(SPECIAL)
            while k >= 0:
                specials.append(at + k)
                k = t.find(SPECIAL, k + len(SPECIAL))
    cuts = text_starts[:-1]
    if len(points):
        starts = np.flatnonzero(word_starts(points, cuts[cuts < len(points)], np.array(specials, np.int64)))
    else:
        starts = np.empty(0, np.int64)
    ends = np.append(starts, len(points))
    data = whole.encode("utf-8")
    offsets = ends if len(data) == len(points) else byte_starts(points)[ends]
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.searchsorted(starts, text_starts, side="left")
    return Words(coded.dictionary, codes, bounds, ends, text_starts)


@dataclass
class Ids:
    """Ids of some words: word i has ``flat[first[i] : first[i] + length[i]]``."""

    flat: np.ndarray
    first: np.ndarray
    length: np.ndarray


def joined(words: pa.Array) -> str:
    """The concatenation of the words."""
    data = words.buffers()[2]
    if data is None or not len(words):
        return ""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    return data.to_pybytes()[offsets[0] : offsets[-1]].decode()


class Encoder:
    """Distinct words to ids."""

    def __init__(self, vocabulary: str):
        import tiktoken

        from public_tokenizers import PATTERN

        self.pieces = load_pieces(vocabulary)
        ranks = {p: i for i, p in enumerate(self.pieces) if p != SPECIAL.encode()}
        self.bpe = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = self.pieces.index(SPECIAL.encode())
        self.piece_bytes = np.array([len(p) for p in self.pieces], np.int64)
        self.leads = np.array([p[:1] == b" " for p in self.pieces])
        self.known = pa.array([], pa.string())
        self.cache = Ids(np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64))

    def each(self, words: pa.Array) -> "Ids":
        """Ids of every distinct word, from the cache or merged now."""
        at = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        fresh = words.take(pa.array(new))
        ids = self.merged(fresh)
        old = self.cache
        flat = np.concatenate([old.flat, ids.flat])
        first, length = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        hit = at >= 0
        first[hit], length[hit] = old.first[at[hit]], old.length[at[hit]]
        first[new], length[new] = ids.first + len(old.flat), ids.length
        if len(self.known) < CACHE_WORDS:
            self.known = pa.concat_arrays([self.known, fresh])
            self.cache = Ids(flat, np.append(old.first, first[new]), np.append(old.length, ids.length))
        return Ids(flat, first, length)

    def merged(self, words: pa.Array) -> "Ids":
        """Words of one space and letters, nearly all words of prose, are
        encoded in one call over their concatenation: the pattern splits it
        back into the same words, and only a word's first token starts with a
        space.  The others are encoded one by one."""
        n = len(words)
        points = code_points(joined(words))
        sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.cumsum(sizes) - sizes
        kind = char_classes()
        spaced = np.zeros(n, bool)
        long = np.flatnonzero(sizes > 1)
        spaced[long] = (points[at[long]] == 32) & (kind[points[at[long] + 1]] == LETTER)
        run = joined(words.filter(pa.array(spaced)))
        flat = self.bpe.encode_to_numpy(run, disallowed_special=()) if run else np.empty(0, np.uint32)
        heads = np.flatnonzero(self.leads[flat])
        first, length = np.zeros(n, np.int64), np.zeros(n, np.int64)
        first[spaced], length[spaced] = heads, np.diff(np.append(heads, len(flat)))
        rest = [
            [self.special] if w == SPECIAL else self.bpe.encode_ordinary(w)
            for w in words.filter(pa.array(~spaced)).to_pylist()
        ]
        each = np.fromiter(map(len, rest), np.int64, len(rest))
        more = np.fromiter(itertools.chain.from_iterable(rest), np.uint32, int(each.sum()))
        first[~spaced], length[~spaced] = len(flat) + np.cumsum(each) - each, each
        return Ids(np.concatenate([flat, more]).astype(np.uint32), first, length)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text starts."""
        words = split(texts)
        return gather(words, self.each(words.distinct))


def gather(words: Words, ids: Ids) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words of each text, joined back by position."""
    length = ids.length[words.codes]
    ends = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=ends[1:])
    return ids.flat[ragged(ids.first[words.codes], length)], ends[words.bounds]


def load_pieces(vocabulary: str) -> list[bytes]:
    """Bytes of every id, from a byte-level vocabulary file (JSON)."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    shown.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))})
    vocab = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pieces = [b""] * (1 + max([*vocab.values(), *special.values()]))
    for piece, i in vocab.items():
        if piece not in special:
            pieces[i] = bytes(shown[c] for c in piece)
    for piece, i in special.items():
        pieces[i] = piece.encode()
    return pieces


@functools.cache
def encoder(vocabulary: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    return Encoder(vocabulary)
