"""Token ids of whole texts, from a public tokenizer file.

A byte-level tokenizer of this kind first cuts a text into pieces by its published pattern and then encodes each piece
by itself. Pieces repeat a lot, so tasks cut whole blocks of texts with array operations, and give only pieces they have
not met to the tokenizers library. Texts with letters beyond the Latin blocks go to the library whole.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Sequence
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from advertlake.llm.kernels import U64, mix, prefix_hash, span_hash

# A task has one core; threads of the library would take those of other tasks.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Characters below this one have the same class in every Unicode version of the last decades.
LATIN_END = 0x250
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3

# A piece is looked for at the slot of its hash's first bits, and in a sorted list if another one has the slot.
SLOT_BITS = 22

# Text encoded at a time: what is held per character then stays in a core's cache.
ENCODE_BYTES = 1 << 17

# Pieces a task remembers; with more it starts afresh, which costs time and changes nothing.
MOST_PIECES = 1_500_000


def _class(c: int) -> int:
    kind = unicodedata.category(chr(c))[0]
    if kind in "LN":
        return LETTER if kind == "L" else NUMBER
    return SPACE if chr(c).isspace() and not 0x1C <= c <= 0x1F else OTHER


CLASSES = np.array([_class(c) for c in range(LATIN_END)], np.uint8)
CONTRACTED = ("s", "t", "re", "ve", "m", "ll", "d")  # fixed values: what may follow an apostrophe as one piece


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bounds(chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pieces of texts that stand one behind the other, as code points; ``offsets`` of texts included.

    The pattern: a contraction; an optional blank with letters, numbers or other signs; white space, of which the last
    character stays with what follows.
    """
    n = len(chars)
    kinds = CLASSES[chars]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    run = first[:n].copy()
    run[1:] |= kinds[1:] != kinds[:-1]
    cut = run.copy()
    # The last of a run of white space before something else in the same text is a piece of its own, or, if it is a
    # blank, the beginning of the next piece.
    goes_on = np.flatnonzero((kinds == SPACE)[:-1] & (kinds[1:] != SPACE) & ~first[1:n]) if n > 1 else np.zeros(0, int)
    cut[goes_on] = True
    blank = goes_on[chars[goes_on] == 32]
    cut[blank + 1] = False
    # Contractions: a lone apostrophe that begins a piece, with letters behind it.
    quote = np.flatnonzero((chars[:-1] == 39) & cut[:-1] & (kinds[1:] == LETTER) & ~first[1:n]) if n > 1 else []
    for at in quote:
        end = at + 1
        while end < n and kinds[end] == LETTER and not first[end] and end - at <= 2:
            end += 1
        text = "".join(map(chr, chars[at + 1 : end]))
        for tail in CONTRACTED:
            if text.startswith(tail):
                cut[at + 1] = False
                after = at + 1 + len(tail)
                if after < n:
                    cut[after] = True
                break
    starts = np.flatnonzero(cut)
    return starts


def _room(values: np.ndarray, n: int) -> np.ndarray:
    """The same array, or a longer one that begins like it, with room for ``n`` values."""
    if n <= len(values):
        return values
    out = np.zeros(max(n, 2 * len(values)), values.dtype)
    out[: len(values)] = values
    return out


class Encoder:
    """Ids of texts as the library gives them without special tokens, one per process and file."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)  # a byte-level token has a letter per byte
        self.bytes_of[list(vocab.values())] = list(map(len, vocab))
        self._forget()

    def _forget(self) -> None:
        self.pieces = 0
        self.named = np.zeros(1, np.uint64)  # hashes of pieces, in the order they were met
        self.first = np.zeros(2, np.int64)  # where a piece's ids begin, and where the last one's end
        self.ids = np.zeros(1, np.uint32)
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)  # piece by slot
        self.known = np.zeros(0, np.uint64)  # sorted hashes of those whose slot another piece has
        self.place = np.zeros(0, np.int32)  # which pieces they are

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one behind the other, and the number of ids of each.

        The library takes all pieces as one text that is already cut, which spares it an answer per piece. Ids stand for
        bytes, so a piece's ids end where its bytes do; if they do not, the pieces are asked for one by one.
        """
        asked = self.tokenizer.encode_batch_fast([texts], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(asked[0].ids, np.uint32)
        stops = np.cumsum(self.bytes_of[ids])
        wanted = np.cumsum(np.fromiter(map(len, map(str.encode, texts)), np.int64, len(texts)))
        ends = np.searchsorted(stops, wanted) + 1
        if len(ids) and ends[-1] == len(ids) and np.array_equal(stops[ends - 1], wanted):
            return ids, np.diff(ends, prepend=0)
        alone = self._plain(texts)
        sizes = np.fromiter(map(len, alone), np.int64, len(alone))
        return np.fromiter(chain.from_iterable(alone), np.uint32, int(sizes.sum())), sizes

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """Remember pieces that are not known, in ascending order of their hashes."""
        ids, sizes = self._split(texts)
        old, self.pieces = self.pieces, self.pieces + len(texts)
        end = int(self.first[old])
        self.named, self.first = _room(self.named, self.pieces), _room(self.first, self.pieces + 1)
        self.ids = _room(self.ids, end + len(ids))
        self.named[old : self.pieces] = hashes
        self.first[old + 1 : self.pieces + 1] = end + np.cumsum(sizes)
        self.ids[end : end + len(ids)] = ids
        # A slot belongs to the piece that was first there; no entry and piece 0 are the same number.
        index, slot = np.arange(old, self.pieces, dtype=np.int32), self._slot(hashes)
        own = np.append(True, slot[1:] != slot[:-1])
        if old:
            own &= (self.slots[slot] == 0) & (slot != self._slot(self.named[0]))
        self.slots[slot[own]] = index[own]
        at = np.searchsorted(self.known, hashes[~own])
        self.known, self.place = np.insert(self.known, at, hashes[~own]), np.insert(self.place, at, index[~own])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces by their hashes, and the places of those that are not known."""
        index = self.slots[self._slot(hashes)].astype(np.int64)
        if not self.pieces:
            return index, np.arange(len(hashes))
        rest = np.flatnonzero(self.named[index] != hashes)
        if not len(self.known):
            return index, rest
        at = np.searchsorted(self.known, hashes[rest])
        at[at == len(self.known)] = 0
        there = self.known[at] == hashes[rest]
        index[rest[there]] = self.place[at[there]]
        return index, rest[~there]

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> U64(64 - SLOT_BITS)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and the number of ids of each."""
        counts = np.zeros(len(texts), np.int64)
        whole: dict[int, list[int]] = {}
        fast = []
        for i, t in enumerate(texts):
            if not t:
                continue
            wide = not t.isascii() and bool((np.frombuffer(t.encode("utf-32-le"), np.uint32) >= LATIN_END).any())
            if wide or any(s in t for s in self.special):
                whole[i] = self._plain([t])[0]
                counts[i] = len(whole[i])
            else:
                fast.append(i)
        if not fast:
            out = [np.array(whole[i], np.uint32) for i in sorted(whole)]
            return (np.concatenate(out) if out else np.zeros(0, np.uint32)), counts

        joined = "".join([texts[i] for i in fast])
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.concatenate(([0], np.cumsum([len(texts[i]) for i in fast])))
        starts = piece_bounds(chars, offsets)
        ends = np.append(starts[1:], len(chars))
        low, high = prefix_hash(chars & 0xFF), None
        hashes = span_hash(low, starts, ends)
        if chars.max() > 0xFF:
            high = span_hash(prefix_hash(chars >> 8), starts, ends)
            hashes = mix(hashes + high * U64(0x9E3779B97F4A7C15))

        if self.pieces > MOST_PIECES:
            self._forget()
        index, new = self._find(hashes)
        if len(new):
            kinds, where, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            of = new[where]
            index[new] = self.pieces + back
            self._learn(kinds, [joined[a:b] for a, b in zip(starts[of].tolist(), ends[of].tolist())])
        begin = self.first[index]
        size = self.first[index + 1] - begin
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(begin - (stop - size), size) + np.arange(int(stop[-1]))]
        per = np.concatenate(([0], stop))[np.searchsorted(starts, offsets)]
        fast_counts = np.diff(per)
        counts[fast] = fast_counts
        if not whole:
            return ids, counts
        out = np.empty(int(counts.sum()), np.uint32)
        base = np.concatenate(([0], np.cumsum(counts)))
        for k, i in enumerate(fast):
            out[base[i] : base[i + 1]] = ids[per[k] : per[k + 1]]
        for i, own in whole.items():
            out[base[i] : base[i + 1]] = own
        return out, counts


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder for a file that every executor has at the same place."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
