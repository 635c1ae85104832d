"""Byte-level encoding of many texts with the tokenizers library, each distinct word once.

The library's pre-tokenizer never joins a character with a single space behind it, never a single line feed with what is
beside it, and never a letter or digit with a sign behind it, but for the apostrophe. Texts are cut there, so a segment is mostly a word with its space, and its ids don't depend on its
neighbours. Distinct segments of a chunk, unless met before by the same worker, are joined by line feeds and encoded in
one call; the line feeds' own id separates the results. Segments with other white space are encoded one by one, and
texts with white space beyond ASCII whole. Tests compare the ids with those of whole texts.

An added token of the vocabulary that stands in a text, such as ``<|endoftext|>``, has its own id, as with the library's
default; texts that hold one are encoded whole. ``Encoder(path)`` alone reads such a token as plain text.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from bourse.llm.text import CHUNK_BYTES, SPACE, Batch, U

# Segments a worker remembers; then it forgets all and goes on.
REMEMBERED = 1 << 21
# Words a call of the library takes: it holds many times a text's size while it works.
CALL_WORDS = 4096


class Encoder:
    """A vocabulary and the segments met so far."""

    def __init__(self, path: str, added_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = added_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        # The flag makes text of special tokens only; the library finds the others in any case.
        self.added = [t.content.encode() for t in added if t.content and not (added_as_text and t.special)]
        # Normalised tokens are found in the text as the normaliser leaves it.
        self.normalised = any(t.normalized for t in added) and self.tokenizer.normalizer is not None
        self.largest = self.tokenizer.get_vocab_size() - 1
        feed = self._whole(["\n"])[0]
        pair = self._whole(["ab\n cd\nef"])[0]
        parts = self._whole(["ab", " cd", "ef"])
        self.feed = int(feed[0]) if len(feed) == 1 and [*parts[0], feed[0], *parts[1], feed[0], *parts[2]] == [*pair] else None
        self.forget()

    def forget(self) -> None:
        self.known = _Index(REMEMBERED)
        self.starts = np.zeros(1024, np.int64)
        self.sizes = np.zeros(1024, np.int64)
        self.ids = np.zeros(8192, np.uint32)
        self.used = 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        if self.feed is None or self.normalised:
            return self._whole(texts)
        out: list[np.ndarray] = []
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = text.encode()
            if held and size + len(raw) > CHUNK_BYTES:
                out += self._chunk(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw)
        return out + self._chunk(held) if held else out

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        batch = Batch(texts)
        raw = batch.data.tobytes() if self.added else b""
        wide = _wide_space(batch)
        for token in self.added:
            if token in raw:
                wide |= np.fromiter((token in t for t in texts), bool, len(texts))
        starts, ends, owner = segments(batch)
        cut = ~wide[owner]
        starts, ends, owner = starts[cut], ends[cut], owner[cut]
        keys = np.maximum(batch.span_hash(starts, ends), U(1))
        slot = self.known.find(keys)
        new = np.flatnonzero(slot < 0)
        if len(new):
            fresh, first = np.unique(keys[new], return_index=True)
            if self.known.count + len(fresh) > REMEMBERED:
                self.forget()
                new = np.arange(len(keys))
                fresh, first = np.unique(keys, return_index=True)
            self._learn(batch, starts[new[first]], ends[new[first]], fresh)
            slot[new] = self.known.find(keys[new])
        sizes = self.sizes[slot]
        places = np.repeat(self.starts[slot] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        flat = self.ids[places]
        bounds = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(owner, np.arange(batch.size + 1))]
        out = [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i in np.flatnonzero(wide).tolist():
            out[i] = self._whole([texts[i].decode()])[0]
        return out

    def _learn(self, batch: Batch, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        space = np.zeros(len(batch.data) + 1, np.int64)
        np.cumsum(batch.space, out=space[1:])
        lead = batch.data[starts] == 32
        plain = (space[ends] - space[starts] == lead) & (ends - starts > lead)
        raw = batch.data.tobytes()
        chosen, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        parts: list[np.ndarray] = []
        sizes = np.zeros(len(keys), np.int64)
        for at in range(0, len(chosen), CALL_WORDS):
            some = chosen[at : at + CALL_WORDS]
            words = b"\n".join([raw[s:e] for s, e in zip(starts[some].tolist(), ends[some].tolist(), strict=True)])
            joined = self._whole([words.decode()])[0]
            cuts = np.flatnonzero(joined == self.feed)
            if len(cuts) != len(some) - 1:
                raise ValueError("a line feed did not separate two words")
            sizes[some] = np.diff(np.concatenate([[-1], cuts, [len(joined)]])) - 1
            parts.append(joined[joined != self.feed])
        for i, ids in zip(others.tolist(), self._whole([raw[starts[i] : ends[i]].decode() for i in others.tolist()]), strict=True):
            sizes[i] = len(ids)
            parts.append(ids)
        order = np.concatenate([chosen, others])
        base, sizes = self.known.count, sizes[order]
        total = int(sizes.sum())
        self.ids = _room(self.ids, self.used + total)
        self.starts, self.sizes = _room(self.starts, base + len(keys)), _room(self.sizes, base + len(keys))
        self.ids[self.used : self.used + total] = np.concatenate(parts)
        self.starts[base : base + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[base : base + len(keys)] = sizes
        self.used += total
        self.known.add(keys[order])


class _Index:
    """Numbers of 64-bit keys other than 0, in the order of their adding: an open hash table in two arrays."""

    def __init__(self, most: int):
        self.bits = max(4, (4 * most - 1).bit_length())
        self.keys = np.zeros((1 << self.bits) + 4096, np.uint64)
        self.numbers = np.full(len(self.keys), -1, np.int32)
        self.count = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for unknown ones."""
        at = (keys >> U(64 - self.bits)).astype(np.int64)
        held = self.keys[at]
        out = np.where(held == keys, self.numbers[at], -1)
        left = np.flatnonzero((held != keys) & (held != 0))
        while len(left):
            at[left] += 1
            held = self.keys[at[left]]
            hit = held == keys[left]
            out[left[hit]] = self.numbers[at[left[hit]]]
            left = left[~hit & (held != 0)]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Number distinct unknown keys."""
        at = (keys >> U(64 - self.bits)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.numbers[at[put]] = keys[put], self.count + put
            left = left[self.keys[at[left]] != keys[left]]
            at[left] += 1
        self.count += len(keys)


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    out = np.zeros(max(size, 2 * len(values)), values.dtype)
    out[: len(values)] = values
    return out


_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
# Second bytes of the Latin letters U+00C0 to U+00FF, without the two signs among them.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def segments(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the segments: cut before single spaces and signs, and around single line feeds."""
    data, space = batch.data, SPACE[batch.data]
    alone = np.zeros(len(data) + 1, bool)
    alone[1 : len(data) - 1] = space[1:-1] & ~space[:-2] & ~space[2:]
    alone[batch.bounds - 1] = False  # the line feeds between texts
    cut = alone.copy()
    cut[: len(data)] &= (data == 32) | (data == 10)
    feed = np.flatnonzero(cut[: len(data)] & (data == 10))
    cut[feed + 1] = True
    word = _PLAIN[data]
    word[1:] |= (data[:-1] == 0xC3) & _LATIN[data[1:]]
    cut[1 : len(data)] |= _SIGNS[data[1:]] & word[:-1]
    cut[batch.bounds] = True
    starts = np.flatnonzero(cut)
    starts = starts[starts < len(data)]
    owner = np.searchsorted(batch.bounds, starts, "right") - 1
    keep = (owner < batch.size) & (starts < batch.bounds[np.minimum(owner + 1, batch.size)] - 1)
    starts, owner = starts[keep], owner[keep]
    ends = np.minimum(np.append(starts[1:], len(data)), batch.bounds[owner + 1] - 1)
    return starts, ends, owner


def _wide_space(batch: Batch) -> np.ndarray:
    """Which texts hold white space beyond ASCII."""
    d = batch.data
    hit = np.zeros(len(d), bool)
    a, b, c = d[:-2], d[1:-1], d[2:]
    hit[:-2] = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    hit[:-2] |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    hit[:-2] |= (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    hit[:-2] |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return batch.per_doc(hit) > 0


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path, added_as_text=False)
