"""Piece encoding and decoding (operator 10): N-best segmentation by forward Viterbi and backward A* search.

A text is the pieces of one path through the lattice of all vocabulary pieces that occur in it. Forward Viterbi gives
the best score up to every position. These scores are exact heuristics for a search from the end backwards: the A* queue
pops complete paths in order of score and expands nothing that is not on one of them. Equal totals go on where least is
left, and a position is popped at most N times, since further paths through it are no better than those N: a long run of
one character, with its very many equal segmentations, keeps the queue within N times the pieces of the lattice.

No piece holds a space mark behind another character, and none holds a line feed, so every path passes the cuts before
spaces and around line feeds: the lattice is a chain of segments, mostly words. Distinct segments of a chunk are solved
together in NumPy: a vectorised trie finds the pieces, forward and backward Viterbi run position by position over all
segments of similar length, and the best path that leaves the best one tells how little a segment's second choice loses.
The N best paths of a text can only differ from the best one in its N - 1 least costly segments, so only these are
searched by A*, and their choices are merged by one more best-first search.

The vocabulary file is a parameter. A merge vocabulary has ranks, no probabilities; a piece of rank r scores
-ln(r + 2.7), the Zipf-Mandelbrot frequency of that rank. A character that is no piece is its bytes, each scoring 10
less than the worst piece.

Defined cases: null and empty text have no pieces, one empty path and score 0; texts are encoded whole; equal scores are
ordered by the search, the same on every run; the space mark U+2581 in a text decodes as a space (``round_trip`` is then
false); repeated rows are equal; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bourse.llm.text import Batch, chunks, encoded

N_BEST = 3
MARK = "▁".encode()
_WIDTHS = (12, 16, 24, 32, 64)
NONE = np.float32(-1e30)


class Vocabulary:
    """Pieces, scores and a trie in flat arrays of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        ranked = sorted(plain, key=lambda i: (-model.get_score(i), i))
        self.ids = {model.id_to_piece(i).encode(): i for i in plain}
        self.score = np.full(size, NONE, np.float32)
        for rank, i in enumerate(ranked):
            self.score[i] = -math.log(rank + 2.7)
        self.fallback = float(self.score[plain].min()) - 10.0
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(size):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.byte_ids[value] = i
                self.score[i] = self.fallback
        self.text = [model.id_to_piece(i).encode() for i in range(size)]
        for value, i in enumerate(self.byte_ids.tolist()):
            self.text[i] = bytes([value])
        self.longest = max(map(len, self.ids))
        if any(b"\n" in p or MARK in _after_marks(p) for p in self.ids):
            raise ValueError("a piece crosses a cut of the lattice")
        self._trie()

    def _trie(self) -> None:
        nodes: dict[int, int] = {}
        self.value = [-1]
        for piece, i in self.ids.items():
            node = 0
            for byte in piece:
                key = node * 256 + byte
                if key not in nodes:
                    nodes[key] = len(self.value)
                    self.value.append(-1)
                node = nodes[key]
            self.value[node] = i
        self.value = np.array(self.value, np.int32)
        self.bits = max(12, (8 * len(nodes)).bit_length())
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.child = np.zeros(len(self.keys), np.int32)
        for key, node in nodes.items():
            slot = int(self._slot(np.array([key], np.int64))[0])
            while self.keys[slot] != -1:
                slot += 1
            self.keys[slot], self.child[slot] = key, node

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The trie nodes reached by one byte; 0 if there is none."""
        keys = nodes.astype(np.int64) * 256 + data
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.child[slots], 0)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots[open_] += 1
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.child[slots[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


def _after_marks(piece: bytes) -> bytes:
    while piece.startswith(MARK):
        piece = piece[len(MARK):]
    return piece


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def ending_at(segment: bytes, end: int, vocab: Vocabulary) -> list[tuple[int, int, float]]:
    """The pieces (start, id, score) that end at a position."""
    out = []
    for start in range(max(0, end - vocab.longest), end):
        if segment[start] & 0xC0 != 0x80:
            i = vocab.ids.get(segment[start:end])
            if i is not None:
                out.append((start, i, float(vocab.score[i])))
    lead = end - 1  # the byte of a character that is no piece
    while lead > 0 and segment[lead] & 0xC0 == 0x80:
        lead -= 1
    width = next((w for w in range(1, 4) if lead + w >= len(segment) or segment[lead + w] & 0xC0 != 0x80), 4)
    if end <= lead + width and segment[lead : lead + width] not in vocab.ids:
        out.append((end - 1, int(vocab.byte_ids[segment[end - 1]]), vocab.fallback))
    return out


def edges_of(segment: bytes, vocab: Vocabulary) -> list[list[tuple[int, int, float]]]:
    """For every end position the pieces (start, id, score) that end there."""
    return [ending_at(segment, end, vocab) for end in range(len(segment) + 1)]


def n_best(segment: bytes, n: int, vocab: Vocabulary) -> list[tuple[float, list[int]]]:
    """The n best paths (score, piece ids) of a segment, best first."""
    size = len(segment)
    # Of a long segment the pieces are looked up where they are needed instead of held.
    ends = edges_of(segment, vocab).__getitem__ if size <= _WIDTHS[-1] else lambda end: ending_at(segment, end, vocab)
    forward = [0.0] + [-math.inf] * size
    for end in range(1, size + 1):
        for start, _, score in ends(end):
            forward[end] = max(forward[end], forward[start] + score)
    out: list[tuple[float, list[int]]] = []
    # An entry: what the whole path scores at best, position, a running number, score behind it, pieces as a chain.
    queue: list[tuple] = [(-forward[size], size, 0, 0.0, None)]
    made = 1
    popped = [0] * (size + 1)
    while queue and len(out) < n:
        _, at, _, behind, chain = heapq.heappop(queue)
        if popped[at] == n:
            continue
        popped[at] += 1
        if at == 0:
            path = []
            while chain:
                path.append(chain[0])
                chain = chain[1]
            out.append((behind, path))
            continue
        for start, i, score in ends(at):
            if popped[start] < n:
                heapq.heappush(queue, (-(forward[start] + score + behind), start, made, behind + score, (i, chain)))
                made += 1
    return out


def _solve(segments: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Best score, loss of the second best path, and best path of each segment (all at most the largest width)."""
    count = len(segments)
    lengths = np.fromiter(map(len, segments), np.int64, count)
    width = int(lengths.max())
    data = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in segments), np.uint8).reshape(count, width).T.copy()
    longest = min(vocab.longest, width)
    scores = np.full((longest + 1, width, count), NONE, np.float32)
    ids = np.zeros((longest + 1, width, count), np.int32)
    inside = np.arange(width)[:, None] < lengths
    lead = inside & ((data & 0xC0) != 0x80)
    position, column = np.nonzero(lead)
    nodes = np.zeros(len(position), np.int32)
    char_piece = np.zeros((width, count), bool)
    char_width = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
    for size in range(1, longest + 1):
        live = position + size <= lengths[column]
        position, column, nodes = position[live], column[live], nodes[live]
        nodes = vocab.step(nodes, data[position + size - 1, column])
        live = nodes > 0
        position, column, nodes = position[live], column[live], nodes[live]
        if not len(nodes):
            break
        value = vocab.value[nodes]
        ends = value >= 0
        p, c, v = position[ends], column[ends], value[ends]
        scores[size, p, c], ids[size, p, c] = vocab.score[v], v
        char_piece[p, c] |= char_width[p, c] == size
    missing = lead & ~char_piece
    for k in range(4):  # the bytes of characters that are no piece
        p, c = np.nonzero(missing & (char_width > k))
        p = p + k
        ok = p < lengths[c]
        p, c = p[ok], c[ok]
        scores[1, p, c], ids[1, p, c] = vocab.fallback, vocab.byte_ids[data[p, c]]
    sizes = [k for k in range(1, longest + 1) if (scores[k] > NONE).any()]
    forward = np.full((width + 1, count), NONE, np.float32)
    forward[0] = 0
    back = np.zeros((width + 1, count), np.int16)
    for t in range(1, width + 1):
        for k in sizes:
            if k > t:
                break
            tried = forward[t - k] + scores[k, t - k]
            better = tried > forward[t]
            back[t][better] = k
            np.maximum(forward[t], tried, out=forward[t])
    behind = np.full((width + 1, count), NONE, np.float32)
    behind[lengths, np.arange(count)] = 0
    for t in range(width - 1, -1, -1):
        for k in sizes:
            if t + k <= width:
                np.maximum(behind[t], scores[k, t] + behind[t + k], out=behind[t])
    best = forward[lengths, np.arange(count)].copy()
    at = lengths.copy()
    live = np.arange(count)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while len(live):
        k = back[at[live], live]
        at[live] -= k
        steps.append((live, ids[k, at[live], live]))
        scores[k, at[live], live] = NONE  # what remains leaves the best path somewhere
        live = live[at[live] > 0]
    second = np.full(count, NONE, np.float32)
    for k in sizes:
        for t in range(width - k + 1):
            np.maximum(second, forward[t] + scores[k, t] + behind[t + k], out=second)
    owner = np.concatenate([s[0] for s in steps])
    piece = np.concatenate([s[1] for s in steps])
    order = np.lexsort((-np.arange(len(owner)), owner))  # the steps ran backwards
    paths = np.split(piece[order], np.cumsum(np.bincount(owner, minlength=count))[:-1])
    return best.astype(float), (best - second).astype(float), paths


def solve(segments: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """As `_solve`, for segments of any length: short ones together by width, long ones one by one."""
    best, loss = np.zeros(len(segments)), np.zeros(len(segments))
    paths: list[np.ndarray] = [None] * len(segments)
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    low = 0
    for width in _WIDTHS:
        chosen = np.flatnonzero((lengths > low) & (lengths <= width))
        low = width
        block = max(64, (1 << 22) // (width * min(vocab.longest, width)))
        for start in range(0, len(chosen), block):
            part = chosen[start : start + block]
            b, g, p = _solve([segments[i] for i in part], vocab)
            best[part], loss[part] = b, g
            for i, path in zip(part.tolist(), p, strict=True):
                paths[i] = path
    for i in np.flatnonzero(lengths > low).tolist():
        two = n_best(segments[i], 2, vocab)
        best[i] = two[0][0]
        loss[i] = two[0][0] - two[1][0] if len(two) > 1 else -float(NONE)
        paths[i] = np.array(two[0][1], np.int32)
    return best, loss, paths


def merge(choices: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n cheapest ways (loss, choice of each segment) to take one of the ascending losses of every segment."""
    first = (0,) * len(choices)
    queue, seen, out = [(0.0, first)], {first}, []
    while queue and len(out) < n:
        loss, chosen = heapq.heappop(queue)
        out.append((loss, chosen))
        for s, c in enumerate(chosen):
            if c + 1 < len(choices[s]):
                then = (*chosen[:s], c + 1, *chosen[s + 1 :])
                if then not in seen:
                    seen.add(then)
                    heapq.heappush(queue, (loss + choices[s][c + 1] - choices[s][c], then))
    return out


def cuts(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the segments."""
    data = batch.data
    mark = np.zeros(len(data) + 3, bool)
    mark[3 : len(data) + 1] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
    start = np.zeros(len(data) + 1, bool)
    start[: len(data)] |= mark[3:] & ~mark[: len(data)]
    feed = data == 10
    start[: len(data)] |= feed
    start[1:] |= feed
    at = np.flatnonzero(start)
    starts, ends = at[:-1], at[1:]
    own = np.ones(len(data) + 1, bool)
    own[batch.bounds - 1] = False  # the line feeds between texts
    keep = own[starts]
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(batch.bounds, starts, "right") - 1


def decode(ids: list[int], vocab: Vocabulary) -> bytes:
    """The text of some pieces."""
    return b"".join(map(vocab.text.__getitem__, ids)).replace(MARK, b" ")[1:]


def encode(texts: list[bytes], vocab: Vocabulary, n: int = N_BEST) -> Iterator[tuple[np.ndarray, list[tuple[float, list]]]]:
    """Best piece ids of each text, and its n best paths as (score, changed segments with their ids)."""
    batch = Batch([MARK + t.replace(b" ", MARK) if t else b"" for t in texts])
    starts, ends, owner = cuts(batch)
    _, first, which = np.unique(batch.span_hash(starts, ends), return_index=True, return_inverse=True)
    raw = batch.data.tobytes()
    segments = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    best, loss, paths = solve(segments, vocab)
    sizes = np.fromiter(map(len, paths), np.int64, len(paths))
    flat = np.concatenate(paths) if paths else np.zeros(0, np.int32)
    offsets = np.cumsum(sizes) - sizes
    each = sizes[which]
    at = np.repeat(offsets[which] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    ids = flat[at].astype("<u4")
    bounds = np.searchsorted(owner, np.arange(batch.size + 1))
    piece_bounds = np.concatenate([[0], np.cumsum(each)])[bounds]
    total = np.bincount(owner, weights=best[which], minlength=batch.size)
    searched: dict[int, list[tuple[float, list[int]]]] = {}
    for k in range(batch.size):
        lo, hi = bounds[k], bounds[k + 1]
        losses = loss[which[lo:hi]]
        if n - 1 < hi - lo:
            near = np.argpartition(losses, n - 2)[: n - 1] if n > 1 else np.zeros(0, int)
            near = near[np.lexsort((near, losses[near]))]
        else:
            near = np.arange(hi - lo)
        options = []
        for s in near.tolist():
            w = int(which[lo + s])
            if w not in searched:
                searched[w] = n_best(segments[w], n, vocab)
            options.append(searched[w])
        merged = merge([[o[0][0] - c[0] for c in o] for o in options], n)
        found = [(float(total[k]) - lost, [(int(s), options[j][c][1]) for j, (s, c) in enumerate(zip(near, chosen, strict=True)) if c])
                 for lost, chosen in merged]
        yield ids[piece_bounds[k] : piece_bounds[k + 1]], found


SCHEMA = "doc_id long, n_pieces long, ids_crc32 long, score double, scores array<double>, round_trip boolean"


def encoded_documents(docs: DataFrame, vocabulary_path: str, n: int = N_BEST, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: their number, the unsigned CRC-32 of the ids as little-endian 32-bit integers, the best
    score, the n best scores, and whether decoding gives the text back. ``with_ids`` adds the ids themselves."""
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocabulary_path)
        for part in chunks(batches):
            texts = encoded(part.column("text"))
            rows, all_ids = [], []
            for text, (ids, paths) in zip(texts, encode(texts, vocab, n), strict=True):
                scores = [round(score, 4) for score, _ in paths]
                rows.append((len(ids), zlib.crc32(ids.tobytes()), scores[0], scores, decode(ids.tolist(), vocab) == text))
                all_ids.append(ids.astype(np.int32) if with_ids else None)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.bool_()]
            columns = [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))]
            names = ["doc_id", "n_pieces", "ids_crc32", "score", "scores", "round_trip"]
            if with_ids:
                columns, names = [*columns, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
