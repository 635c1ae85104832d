"""Suffix-array dedup (operator 7): bytes inside a 50-byte string that also starts in an earlier document go.

Sorting every suffix of a corpus moves each byte fifty times. The array here is sparse but loses no match: every 50-byte
window elects the 24-byte gram with the least hash in it, equal windows elect the same one, and the windows of a text
that elect one occurrence form a run. Only suffixes that begin at such grams are arranged, each with the few bytes
before it that its run needs, and only if the gram occurs in another text too, which `shared_flags` counts first.

Texts are written once, compressed, in units of about 16 MB, and never shuffled: a unit's documents, grams, runs and spans
are dealt by the unit's number, and the table of units is in hash buckets of it. What travels is, of a unit, each distinct
gram of its texts (four bytes, packed ascending), one bit a gram back, the runs of shared grams, and the found spans.
Nothing of it is held a document, so more and finer parts make no more of it. Of equal texts only the first takes part.

Splitters sampled from the grams of a bounded sample of documents cut the suffixes into ranges by their leading 24
bytes. A bucket sorts its windows by multikey quicksort, eight bytes a key character, and windows that stay equal to the
last character are one group: the later documents lose it. Splitters cut between different leading bytes, so suffixes
that agree on them are never apart and the comparison across a bucket's boundary can't find a match; a test does it.

Equal runs are met before they travel: within a task, only the earliest document's run goes to the bucket and the others
are marked at once, so a passage in a third of all documents sends one row a task. Exact copies never take part: all
but the first are removed whole.

A phrase shorter than a match makes a different run in every document that holds it, and all with one gram. Grams that
`HOT_DOCUMENTS` of the sampled documents hold are dealt finer: each window goes by a hash of its 50 bytes, so only equal
windows meet, again the earliest document's of each task. Equal windows elect one gram, so none is in both ways.

Defined cases: null and empty text has no bytes, and texts under 50 bytes lose none; a null doc_id is before all others;
rows with equal ids don't remove each other's bytes; repeated rows are judged alike; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.ordering import LOWEST
from bourse.llm.sharing import Sets, byte_planes, from_planes, packed_ascending, shared_flags
from bourse.llm.tables import bucketed, keys_of_bucket, spread, stored
from bourse.llm.text import CHUNK_BYTES, Batch, U, chunks, encoded, mix

MATCH, GRAM = 50, 24
WINDOW = MATCH - GRAM + 1
SAMPLE_DOCUMENTS = 2000
HOT_DOCUMENTS = 8
FLUSH_RUNS = 1 << 18
UNIT_BYTES = 1 << 24
EMPTY_SHA = hashlib.sha256(b"").digest()
_RUN = np.dtype([("doc", "<u4"), ("start", "<u4"), ("anchor", "u1"), ("length", "u1")])
_WINDOW = np.dtype([("key", "<u8"), ("doc", "<u4"), ("start", "<u4")])
_DOC = np.dtype([("rank", "<i8"), ("unit", "<i8"), ("at", "<i8")])
_HEAD = np.dtype([("rank", "<i8"), ("node", "<i8"), ("n_bytes", "<i8"), ("sha", "V32")])
_SPAN = np.dtype([("at", "<u4"), ("start", "<u4"), ("length", "<u4")])


def runs_of(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owners, gram hashes, gram positions, first and last window of every run of windows with one elected gram."""
    size = len(batch.data)
    none = np.zeros(0, np.int64)
    if size < MATCH:
        return none, none.astype(np.uint64), none, none, none
    at = np.arange(size - GRAM + 1)
    hashes = batch.span_hash(at, at + GRAM)
    bits = U(size.bit_length())
    least = (hashes >> bits << bits) | at.astype(np.uint64)  # ties by place, which equal windows share
    reach = 1
    while reach * 2 <= WINDOW:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < WINDOW:
        least = np.minimum(least[: len(least) - (WINDOW - reach)], least[WINDOW - reach :])
    edge = np.zeros(size + 1, np.int8)
    long = np.flatnonzero(batch.lengths >= MATCH)
    edge[batch.bounds[long]] += 1
    edge[batch.bounds[long + 1] - MATCH] -= 1
    windows = np.flatnonzero(np.cumsum(edge[: len(least)]) > 0)
    if not len(windows):
        return none, none.astype(np.uint64), none, none, none
    elected = (least[windows] & ((U(1) << bits) - U(1))).astype(np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (elected[1:] != elected[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    place = elected[first]
    return np.searchsorted(batch.bounds, windows[first], "right") - 1, hashes[place], place, windows[first], windows[last]


def nodes_of(batch: Batch) -> np.ndarray:
    """A digest of each whole text."""
    return mix(batch.span_hash(batch.bounds[:-1], batch.bounds[1:] - 1) + batch.lengths.astype(np.uint64))


def gram_sets(texts: list[bytes]) -> Sets:
    batch = Batch(texts)
    owner, grams, _, _, _ = runs_of(batch)
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
    return nodes_of(batch), np.zeros(len(texts), np.int64), owner[new], grams[new]


def multikey_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of key characters, and the number of each ordered row's group of equal rows.

    Rows are arranged by their first character; only groups of equal rows go on to the next one."""
    order = np.argsort(keys[:, 0], kind="stable")
    split = np.ones(len(order), bool)
    split[1:] = keys[order[1:], 0] != keys[order[:-1], 0]
    for column in range(1, keys.shape[1]):
        group = np.cumsum(split) - 1
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        rows = order[tied]
        inner = np.lexsort((keys[rows, column], group[tied]))
        order[tied] = rows[inner]
        value, of = keys[order[tied], column], group[tied]
        split[tied[1:]] |= (value[1:] != value[:-1]) & (of[1:] == of[:-1])
    return order, np.cumsum(split) - 1


def _gather(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    # A window view: indexes of every byte would take eight times the bytes.
    return np.lib.stride_tricks.sliding_window_view(data, size)[starts] if len(starts) else np.zeros((0, size), np.uint8)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint spans that cover the same positions; touching ones are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    return starts[new], reach[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]


def packed_spans(at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Spans of a unit's documents (by their places in it), merged."""
    at, starts, ends = _merged_at(at, starts, ends)
    spans = np.zeros(len(at), _SPAN)
    spans["at"], spans["start"], spans["length"] = np.diff(at, prepend=0), starts, ends - starts
    return len(spans).to_bytes(4, "little") + pa.compress(byte_planes(spans), "zstd", asbytes=True)


def opened_spans(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, starts and ends of the merged spans of several blobs, ascending."""
    at, starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for blob in blobs:
        raw = pa.decompress(blob[4:], int.from_bytes(blob[:4], "little") * _SPAN.itemsize, "zstd", asbytes=True)
        spans = from_planes(raw, _SPAN)
        at.append(np.cumsum(spans["at"].astype(np.int64)))
        starts.append(spans["start"].astype(np.int64))
        ends.append(starts[-1] + spans["length"])
    return _merged_at(np.concatenate(at), np.concatenate(starts), np.concatenate(ends))


def _merged_at(at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(at):
        return at, starts, ends
    # A text has fewer than 2**32 bytes, so spans of different texts don't touch.
    base = at.astype(np.int64) << 32
    a, b = merged(base + starts, base + ends)
    return a >> 32, a & 0xFFFFFFFF, b - (a >> 32 << 32)


def _span_rows(docs: np.ndarray, doc: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, bytes]]:
    """(unit, spans) of each unit."""
    if not len(doc):
        return []
    unit = docs["unit"][doc]
    order = np.argsort(unit, kind="stable")
    cuts = np.flatnonzero(np.diff(unit[order])) + 1
    return [(int(unit[own[0]]), packed_spans(docs["at"][doc[own]], starts[own], ends[own])) for own in np.split(order, cuts)]


def _by_rank(keys: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, then rank, and which of the ordered rows come after the first rank of their key."""
    order = np.lexsort((rank, keys))
    new = np.ones(len(order), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    group = np.cumsum(new) - 1
    return order, rank[order] > rank[order[np.flatnonzero(new)]][group]


def _packed(kind: bytes, docs: np.ndarray, part: np.ndarray, text: bytes = b"") -> bytes:
    """A blob of runs or windows with the documents they are from."""
    used, own = np.unique(part["doc"], return_inverse=True)
    part = part.copy()
    part["doc"] = own
    blob = b"".join([len(used).to_bytes(4, "little"), len(part).to_bytes(4, "little"), byte_planes(docs[used]), byte_planes(part), text])
    return kind + len(blob).to_bytes(8, "little") + pa.compress(blob, "zstd", asbytes=True)


class _Scatter:
    """Runs of a task on their way to the buckets, and the windows of runs with hot grams."""

    def __init__(self, splitters: np.ndarray, hot: np.ndarray, unit: int = 0):
        self.splitters, self.hot, self.unit = splitters, hot, unit
        self.clear()

    def clear(self) -> None:
        self.docs: list[tuple[int, int, int]] = []
        self.runs, self.text, self.grams, self.keys, self.windows = [], [], [], [], []
        self.count = 0

    def put(self, rank: list[int], at: np.ndarray, batch: Batch, owner, grams, place, first, last) -> None:
        offset = len(self.docs)
        self.docs += zip(rank, [self.unit] * len(rank), at.view(np.int64).tolist(), strict=True)
        hot = np.isin(grams, self.hot)
        if hot.any():
            size = last[hot] - first[hot] + 1
            of = np.repeat(owner[hot], size)
            at = np.arange(size.sum()) + np.repeat(first[hot] - (np.cumsum(size) - size), size)
            window = np.zeros(len(at), _WINDOW)
            window["key"], window["doc"], window["start"] = batch.span_hash(at, at + MATCH), of + offset, at - batch.bounds[of]
            self.windows.append(window)
            self.count += len(window) // 4  # a run takes about the room of four windows
            owner, place, first, last = owner[~hot], place[~hot], first[~hot], last[~hot]
        run = np.zeros(len(owner), _RUN)
        run["doc"], run["start"] = owner + offset, first - batch.bounds[owner]
        run["anchor"], run["length"] = place - first, last - first + MATCH
        self.runs.append(run)
        self.keys.append(batch.span_hash(first, last + MATCH))
        self.grams.append(np.ascontiguousarray(_gather(batch.data, place, GRAM)).view(f"S{GRAM}").ravel())
        longest = MATCH + WINDOW
        padded = np.concatenate([batch.data, np.zeros(longest, np.uint8)])
        self.text.append(_gather(padded, first, longest))
        self.count += len(owner)

    def flush(self) -> Iterator[pa.RecordBatch]:
        docs = np.array(self.docs, _DOC)
        if self.windows:
            window = np.concatenate(self.windows)
            order, late = _by_rank(window["key"], docs["rank"][window["doc"]])
            gone = window[order[late]]
            yield from self._known(docs, gone["doc"], gone["start"].astype(np.int64), np.int64(MATCH))
            window = window[np.sort(order[~late])]
            parts = len(self.splitters) + 1
            bucket = (window["key"] % U(parts)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            yield from self._sent(bucket[by] + parts, lambda lo, hi: _packed(b"w", docs, window[by[lo:hi]]))
        if self.runs and sum(map(len, self.runs)):
            run, text, grams, keys = (np.concatenate(x) for x in (self.runs, self.text, self.grams, self.keys))
            # Of equal runs only those of the earliest document travel.
            order, late = _by_rank(keys, docs["rank"][run["doc"]])
            gone = run[order[late]]
            yield from self._known(docs, gone["doc"], gone["start"].astype(np.int64), gone["length"])
            order = np.sort(order[~late])
            bucket = np.searchsorted(self.splitters, grams[order], "right")
            by = np.argsort(bucket, kind="stable")
            order = order[by]

            def pack(lo: int, hi: int) -> bytes:
                part, rows = run[order[lo:hi]], text[order[lo:hi]]
                return _packed(b"r", docs, part, rows[np.arange(rows.shape[1]) < part["length"][:, None]].tobytes())

            yield from self._sent(bucket[by], pack)
        self.clear()

    def _known(self, docs: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> Iterator[pa.RecordBatch]:
        for unit, spans in _span_rows(docs, doc.astype(np.int64), start, start + length):
            yield _row(unit % (len(self.splitters) + 1), None, unit, spans)

    def _sent(self, bucket: np.ndarray, pack: Callable[[int, int], bytes]) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True):
            yield _row(int(bucket[lo]), pack(lo, hi), None, None)


_SENT = pa.schema([("bucket", pa.int32()), ("blob", pa.binary()), ("unit", pa.int64()), ("spans", pa.binary())])


def _row(bucket: int, blob: bytes | None, unit: int | None, spans: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((bucket, blob, unit, spans), _SENT, strict=True)], schema=_SENT)


def _open(blobs: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, runs, text, offset = [], [], [], 0
    for packed in blobs:
        blob = pa.decompress(memoryview(packed)[9:], int.from_bytes(packed[1:9], "little"), "zstd", asbytes=True)
        n, m = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:8], "little")
        begin = 8 + n * _DOC.itemsize
        end = begin + m * kind.itemsize
        docs.append(from_planes(blob[8:begin], _DOC))
        run = from_planes(blob[begin:end], kind).copy()
        run["doc"] += offset
        offset += n
        runs.append(run)
        text.append(np.frombuffer(blob, np.uint8, -1, end))
    return np.concatenate(docs), np.concatenate(runs), np.concatenate(text)


def _run_hashes(text: np.ndarray, run: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of whole runs and of their grams, a megabyte of text at a time."""
    keys, grams = np.zeros(len(run), np.uint64), np.zeros(len(run), np.uint64)
    cuts = [0, *(np.flatnonzero(np.diff(starts // CHUNK_BYTES)) + 1).tolist(), len(run)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        if hi > lo:
            batch = Batch([text[starts[lo] : ends[hi - 1]].tobytes()])
            begin = starts[lo:hi] - starts[lo] + 1
            anchor = begin + run["anchor"][lo:hi]
            keys[lo:hi], grams[lo:hi] = batch.span_hash(begin, begin + run["length"][lo:hi]), batch.span_hash(anchor, anchor + GRAM)
    return keys, grams


def _bucket(table: pa.Table) -> pa.Table:
    """Spans of a bucket's documents that an earlier document holds as well, with the spans already known."""
    known = table.filter(pc.is_null(table.column("blob"))).select(["unit", "spans"])
    table = table.filter(pc.is_valid(table.column("blob")))
    if not len(table):
        return known
    blobs = table.column("blob").to_pylist()
    if blobs[0][:1] == b"w":
        docs, window, _ = _open(blobs, _WINDOW)
        order, late = _by_rank(window["key"], docs["rank"][window["doc"]])
        gone = window[order[late]]
        start = gone["start"].astype(np.int64)
        return _with_found(known, _span_rows(docs, gone["doc"].astype(np.int64), start, start + MATCH))
    docs, run, text = _open(blobs, _RUN)
    ends = np.cumsum(run["length"].astype(np.int64))
    starts = ends - run["length"]
    rank = docs["rank"][run["doc"]]
    keys, grams = _run_hashes(text, run, starts, ends)
    order = np.lexsort((rank, keys))
    new = np.ones(len(order), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    head = order[np.flatnonzero(new)]
    group = np.cumsum(new) - 1
    first_rank = rank[head]
    late = rank[order] > first_rank[group]
    out_run = [order[late]]
    out_from, out_to = [np.zeros(int(late.sum()), np.int64)], [run["length"][order[late]].astype(np.int64)]
    # Different runs with one gram: their windows are sorted.
    _, which, size = np.unique(grams[head], return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(size[which] > 1)
    mixed = mixed[np.argsort(which[mixed], kind="stable")]
    windows = run["length"][head[mixed]].astype(np.int64) - MATCH + 1
    for lo, hi in _slices(which[mixed], windows):
        some, count = mixed[lo:hi], windows[lo:hi]
        of = np.repeat(np.arange(len(some)), count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        rows = np.zeros((len(of), -(-MATCH // 8) * 8), np.uint8)
        rows[:, :MATCH] = _gather(text, starts[head[some]][of] + offset, MATCH)
        sorted_rows, equal = multikey_order(rows.view(">u8").astype(np.uint64))
        window_rank = first_rank[some][of][sorted_rows]
        least = np.full(int(equal[-1]) + 1 if len(equal) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, equal, window_rank)
        hit = np.zeros(len(of), bool)
        hit[sorted_rows[window_rank > least[equal]]] = True
        edge = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1] & (of[1:] == of[:-1])]))
        last = np.flatnonzero(hit & ~np.concatenate([hit[1:] & (of[1:] == of[:-1]), [False]]))
        # A run stands for all its occurrences in the earliest document.
        for e, l in zip(edge.tolist(), last.tolist(), strict=True):
            g = some[of[e]]
            low, high = np.searchsorted(group, [g, g + 1])
            own = order[low:high][~late[low:high]]
            out_run.append(own)
            out_from.append(np.full(len(own), offset[e]))
            out_to.append(np.full(len(own), offset[l] + MATCH))
    chosen = np.concatenate(out_run)
    begin = run["start"][chosen].astype(np.int64)
    return _with_found(known, _span_rows(docs, run["doc"][chosen].astype(np.int64), begin + np.concatenate(out_from), begin + np.concatenate(out_to)))


def _with_found(known: pa.Table, rows: list[tuple[int, bytes]]) -> pa.Table:
    units, spans = zip(*rows, strict=True) if rows else ((), ())
    found = pa.table({"unit": pa.array(units, pa.int64()), "spans": pa.array(spans, pa.binary())})
    return pa.concat_tables([known, found.cast(known.schema)])


def _slices(gram: np.ndarray, windows: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of runs, ordered by gram, of about ``most`` windows that keep the runs of one gram together."""
    if not len(gram):
        return
    total = np.cumsum(windows)
    begin = 0
    ends = np.append(np.flatnonzero(np.diff(gram)) + 1, len(gram))
    for end in ends.tolist():
        if total[end - 1] - (total[begin - 1] if begin else 0) >= most or end == len(gram):
            yield begin, end
            begin = end


def _splitters(some: DataFrame, count: int) -> np.ndarray:
    """Leading bytes that cut the grams of the sampled documents into equal parts."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            batch = Batch(encoded(part.column("text")))
            _, hashes, place, _, _ = runs_of(batch)
            place = place[hashes % U(16) == 0]
            grams = _gather(batch.data, place, GRAM)
            yield pa.RecordBatch.from_arrays([pa.array([g.tobytes() for g in grams], pa.binary())], ["gram"])

    grams = np.sort(np.array(some.mapInArrow(sample, "gram binary").toArrow().column("gram").to_pylist() or [b""], f"S{GRAM}"))
    return np.unique(grams[np.arange(1, count) * len(grams) // count]) if count > 1 else grams[:0]


def _hot_grams(some: DataFrame) -> np.ndarray:
    """Hashes of the grams that many of the sampled documents hold; copies count once."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            _, _, _, grams = gram_sets(encoded(part.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], ["gram"])

    counted = some.dropDuplicates(["text"]).mapInArrow(held, "gram long").groupBy("gram").count()
    return np.sort(counted.where(F.col("count") >= HOT_DOCUMENTS).select("gram").toArrow().column("gram").to_numpy().view(np.uint64))


def _units(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (unit, base, heads, text): some documents of a unit from place ``base`` on, their `_HEAD` and their texts."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = keys_of_bucket(TaskContext.get().partitionId(), buckets)
        unit, base, size = next(units), 0, 0
        for part in chunks(batches):
            texts = encoded(part.column("text"))
            batch = Batch(texts)
            heads = np.zeros(len(texts), _HEAD)
            heads["rank"], heads["node"], heads["n_bytes"] = part.column("rank").to_numpy(), nodes_of(batch).view(np.int64), batch.lengths
            heads["sha"] = np.frombuffer(b"".join(hashlib.sha256(t).digest() for t in texts), "V32")
            yield pa.RecordBatch.from_arrays(
                [pa.array([unit], pa.int64()), pa.array([base], pa.int64()), pa.array([heads.tobytes()], pa.binary()),
                 pa.array([pa.compress(b"".join(texts), "zstd", asbytes=True)], pa.binary())], ["unit", "base", "heads", "text"])
            base, size = base + len(texts), size + int(batch.lengths.sum()) + heads.nbytes
            if size >= UNIT_BYTES:
                unit, base, size = next(units), 0, 0

    return docs.mapInArrow(pack, "unit long, base long, heads binary, text binary")


def _cut_texts(heads: np.ndarray, text: bytes, some: np.ndarray) -> list[bytes]:
    """The texts of some documents of a row of units."""
    raw = pa.decompress(text, int(heads["n_bytes"].sum()), "zstd", asbytes=True)
    ends = np.cumsum(heads["n_bytes"])[some].tolist()
    return [raw[b - n : b] for b, n in zip(ends, heads["n_bytes"][some].tolist(), strict=True)]


def _long_documents(units: DataFrame) -> DataFrame:
    """(unit, at, rank, node) of the documents that hold a match at all."""

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, base, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                heads = np.frombuffer(blob, _HEAD)
                at = np.flatnonzero(heads["n_bytes"] >= MATCH)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), unit, np.int64)), pa.array(at + base), pa.array(heads["rank"][at]), pa.array(heads["node"][at])],
                    ["unit", "at", "rank", "node"])

    return units.select("unit", "base", "heads").mapInArrow(long, "unit long, at long, rank long, node long")


def _repeats(documents: DataFrame) -> DataFrame:
    """(unit, at, more): -1 for texts that an earlier document has, 0 for all but one of the repeated rows of the first
    document, and how many such rows there are for that one."""
    first = documents.groupBy("node").agg(F.min(F.struct("rank", "unit", "at")).alias("first"), F.count("*").alias("rows"))
    first = stored(first.where("rows > 1"), "suffix-first")
    again = documents.join(first, "node").where("unit != first.unit or at != first.at")
    again = stored(again.selectExpr("unit", "at", "rank > first.rank late", "first.unit first_unit", "first.at first_at"), "suffix-repeats")
    more = again.where("not late").groupBy("first_unit", "first_at").agg(F.count("*").alias("more"))
    return again.selectExpr("unit", "at", "if(late, -1L, 0L) more").union(more)


def _sample(units: DataFrame, share: float) -> DataFrame:
    """Texts of about that share of the documents that hold a match."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, base, blob, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                heads = np.frombuffer(blob, _HEAD)
                draw = mix(np.arange(base, base + len(heads), dtype=np.uint64) ^ mix(np.array([unit], np.int64).view(np.uint64))) >> U(11)
                own = np.flatnonzero((heads["n_bytes"] >= MATCH) & (draw.astype(np.float64) < share * 2.0**53))
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array([t.decode() for t in _cut_texts(heads, text, own)], pa.string())], ["text"])

    return units.select("unit", "base", "heads", "text").mapInArrow(some, "text string")


def _documents_of(unit: pa.Table, away: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Places, ranks and texts, a row of units at a time, of the documents that hold a match, without those away."""
    unit = unit.sort_by("base")
    for base, blob, text in zip(*(unit.column(c).to_pylist() for c in ("base", "heads", "text")), strict=True):
        heads = np.frombuffer(blob, _HEAD)
        own = np.flatnonzero((heads["n_bytes"] >= MATCH) & ~np.isin(np.arange(base, base + len(heads)), away))
        if len(own):
            yield own + base, heads["rank"][own], _cut_texts(heads, text, own)


def _away(said: pa.Table) -> np.ndarray:
    return said.filter(pc.less_equal(said.column("more"), 0)).column("at").to_numpy()


def _grams_of(unit: pa.Table, away: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, ...]]]:
    """Distinct grams of a unit (part, then 32 bits of the hash), which of them several of its documents have, the
    number of each run's gram, and the runs by rows of units."""
    runs, keys, docs = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, _, texts in _documents_of(unit, away):
        owner, grams, place, first, last = runs_of(Batch(texts))
        runs.append((owner.astype(np.int32), grams, *(x.astype(np.int32) for x in (place, first, last))))
        keys.append((grams >> U(48)) % U(parts) << U(32) | grams & U(0xFFFFFFFF))
        docs.append(at[owner])
    key, doc = np.concatenate(keys), np.concatenate(docs)
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return key[first], doc[first] != doc[np.append(first[1:], len(key)) - 1] if len(key) else new, which, runs


def spans_to_remove(units: DataFrame, repeats: DataFrame, some: DataFrame) -> DataFrame:
    """(unit, spans) of the first document of each text. ``some`` are sampled texts."""
    parts = spread(units.sparkSession)
    splitters, hot = _splitters(some, 2 * parts), _hot_grams(some)

    def ask(unit: pa.Table, said: pa.Table) -> pa.Table:
        keys, _, _, _ = _grams_of(unit, _away(said), parts)
        part = (keys >> U(32)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        blobs = [packed_ascending(x.astype(np.uint32)) for x in np.split(keys, cuts[1:])] if len(keys) else []
        number = [unit.column("unit")[0].as_py()] * len(blobs) if blobs else []
        return pa.table({"part": pa.array(part[cuts], pa.int32()), "unit": pa.array(number, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    asked = units.groupBy("unit").cogroup(repeats.withColumnRenamed("unit", "of").groupBy("of")).applyInArrow(ask, "part int, unit long, blob binary")
    flags = stored(shared_flags(asked), "suffix-grams")

    def scatter(unit: pa.Table, said: pa.Table) -> pa.Table:
        away = _away(said)
        keys, several, which, runs = _grams_of(unit, away, parts)
        answers = said.filter(pc.is_valid(said.column("part"))).sort_by("part")
        size = np.bincount((keys >> U(32)).astype(np.int64), minlength=parts)
        bits = [np.unpackbits(np.frombuffer(f, np.uint8), count=size[p])
                for p, f in zip(answers.column("part").to_pylist(), answers.column("flags").to_pylist(), strict=True)]
        shared = several | np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool)
        out = _Scatter(splitters, hot, unit.column("unit")[0].as_py() if len(unit) else 0)
        sent, begin = [], 0
        for (at, rank, texts), (owner, grams, place, first, last) in zip(_documents_of(unit, away), runs, strict=True):
            hit = shared[which[begin : begin + len(owner)]]
            begin += len(owner)
            out.put(rank.tolist(), at, Batch(texts), *(x[hit].astype(np.int64) if x is not grams else x[hit] for x in (owner, grams, place, first, last)))
            if out.count >= FLUSH_RUNS:
                sent += out.flush()
        return pa.Table.from_batches([*sent, *out.flush()], _SENT)

    said = flags.selectExpr("unit of", "part", "flags", "null at", "null more").unionByName(
        repeats.selectExpr("unit of", "cast(null as int) part", "cast(null as binary) flags", "at", "more"))
    sent = units.groupBy("unit").cogroup(said.groupBy("of")).applyInArrow(scatter, "bucket int, blob binary, unit long, spans binary")
    return sent.groupBy("bucket").applyInArrow(_bucket, "unit long, spans binary")


def _described(unit: pa.Table, said: pa.Table) -> pa.Table:
    """The result's rows of a unit's documents."""
    at, starts, ends = opened_spans(said.column("spans").drop_null().to_pylist())
    repeats = said.filter(pc.is_valid(said.column("at")))
    place, more = repeats.column("at").to_numpy(), repeats.column("more").to_numpy()
    out = []
    for base, blob, text in zip(*(unit.column(c).to_pylist() for c in ("base", "heads", "text")), strict=True):
        heads = np.frombuffer(blob, _HEAD)
        n = len(heads)
        removed, spans, times, sha = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, np.int64), heads["sha"].tolist()
        lo, hi = np.searchsorted(at, [base, base + n])
        own = np.unique(at[lo:hi]) - base
        bounds = np.searchsorted(at, np.append(own, n) + base).tolist()
        for k, kept, a, b in zip(own.tolist(), _cut_texts(heads, text, own) if len(own) else [], bounds[:-1], bounds[1:], strict=True):
            digest = hashlib.sha256()
            for x, y in zip([0, *ends[a:b].tolist()], [*starts[a:b].tolist(), len(kept)], strict=True):
                digest.update(kept[x:y])
            removed[k], spans[k], sha[k] = (ends[a:b] - starts[a:b]).sum(), b - a, digest.digest()
        here = (place >= base) & (place < base + n)
        for k, extra in zip((place[here] - base).tolist(), more[here].tolist(), strict=True):
            if extra < 0:
                removed[k], spans[k], sha[k] = heads["n_bytes"][k], 1, EMPTY_SHA
            else:
                times[k] = extra + 1 if extra else 0
        of = np.repeat(np.arange(n), times)
        out.append(pa.table({"rank": pa.array(heads["rank"][of]), "n_bytes": pa.array(heads["n_bytes"][of]), "n_removed": pa.array(removed[of]),
                             "n_spans": pa.array(spans[of]), "sha": pa.array([bytes(sha[k]) for k in of.tolist()], pa.binary())}))
    return pa.concat_tables(out) if out else _RESULT.empty_table()


_RESULT = pa.schema([("rank", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("sha", pa.binary())])


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("rank"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = spread(docs.sparkSession)
    with bucketed(_units(docs, buckets), "suffix-units", "unit", buckets) as units:
        documents = _long_documents(units)
        repeats = stored(_repeats(documents), "suffix-repeats")
        some = stored(_sample(units, SAMPLE_DOCUMENTS / max(SAMPLE_DOCUMENTS, documents.count())), "suffix-sample")
        said = spans_to_remove(units, repeats, some).selectExpr("unit of", "spans", "cast(null as long) at", "cast(null as long) more").unionByName(
            repeats.selectExpr("unit of", "cast(null as binary) spans", "at", "more"))
        done = units.groupBy("unit").cogroup(said.groupBy("of")).applyInArrow(
            _described, "rank long, n_bytes long, n_removed long, n_spans long, sha binary")
        done = stored(done, "suffix-result")
    return done.select(
        F.when(F.col("rank") != LOWEST, F.col("rank")).alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        F.lower(F.hex("sha")).alias("kept_sha256"))
