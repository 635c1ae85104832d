"""Which elements of each node's set also belong to another node: the counting step of joins over element hashes.

Elements travel packed. A task groups the hashes of about two million elements by part, and a row of the shuffle is one
such group: the nodes, how many elements each has there, and six bytes an element. A part counts the distinct nodes of
each element, forgets the elements of one node (most of them) and sends the rest back by node. Nodes met twice in a task
are packed once, so copies cost one set a task. A node is a 64-bit digest of its content; equal contents are one node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bourse.llm.tables import spread
from bourse.llm.text import U, chunks, encoded

PACK_ELEMENTS = 1 << 21
Sets = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
_HEAD = np.dtype([("node", "<u8"), ("size", "<u4"), ("count", "<u4")])


def six_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_six(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _pack(nodes: np.ndarray, sizes: np.ndarray, owner: np.ndarray, elements: np.ndarray, part: np.ndarray,
          extra: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
    """One blob a part; ``owner`` (into nodes) must be ascending."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(order)], strict=True):
        if hi == lo:
            continue
        own = owner[order[lo:hi]]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        head = np.zeros(len(first), _HEAD)
        head["node"], head["size"] = nodes[own[first]], sizes[own[first]]
        head["count"] = np.diff(first, append=hi - lo)
        blob = len(head).to_bytes(8, "little") + head.tobytes() + six_bytes(elements[order[lo:hi]])
        if extra is not None:
            blob += extra[order[lo:hi]].tobytes()
        yield int(part[order[lo]]), blob


def _unpack(blobs: list[bytes], extra: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Heads, owners (into heads), elements and extra bytes of all blobs."""
    heads, elements, extras = [], [], []
    for blob in blobs:
        n = int.from_bytes(blob[:8], "little")
        at = 8 + n * _HEAD.itemsize
        heads.append(np.frombuffer(blob[8:at], _HEAD))
        m = int(heads[-1]["count"].sum())
        elements.append(from_six(blob[at : at + 6 * m]))
        if extra:
            extras.append(np.frombuffer(blob[at + 6 * m :], np.uint8))
    head = np.concatenate(heads)
    return (head, np.repeat(np.arange(len(head)), head["count"]), np.concatenate(elements),
            np.concatenate(extras) if extra else np.zeros(0, np.uint8))


def _rows(pairs: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for part, blob in pairs:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([blob], pa.binary())], ["part", "blob"])


def shared_elements(docs: DataFrame, extract: Callable[[list[bytes]], Sets], least_share: float = 0.0) -> DataFrame:
    """Rows (node, size, elements) of the elements that at least two nodes have, rarest first (by powers of two, then
    by hash), for nodes with at least ``least_share`` of their elements shared, and one at least.

    ``extract`` gives for some texts: nodes, set sizes, owners (ascending, into nodes) and elements, distinct for each
    owner. Elements are compared by 48 bits and their part, so by more than 48 bits.
    """
    parts = spread(docs.sparkSession)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Sets] = []
        seen: set[int] = set()
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            offsets = np.cumsum([0, *(len(s[0]) for s in held)])
            nodes, sizes, _, elements = (np.concatenate([s[i] for s in held]) for i in range(4))
            owner = np.concatenate([s[2] + o for s, o in zip(held, offsets, strict=False)])
            part = ((elements >> U(48)) % U(parts)).astype(np.int32)
            yield from _rows(_pack(nodes, sizes, owner, elements, part))

        for chunk in chunks(batches):
            nodes, sizes, owner, elements = extract(encoded(chunk.column("text")))
            fresh = np.zeros(len(nodes), bool)
            for i, node in enumerate(nodes.tolist()):
                fresh[i] = node not in seen
                seen.add(node)
            take = fresh[owner]
            held.append((nodes, sizes, owner[take], elements[take]))
            count += int(take.sum())
            if count >= PACK_ELEMENTS:
                yield from flush()
                held, seen, count = [], set(), 0
        if count:
            yield from flush()

    def count_nodes(table: pa.Table) -> pa.Table:
        head, owner, elements, _ = _unpack(table.column("blob").to_pylist())
        nodes, at = np.unique(head["node"], return_index=True)
        owner = np.searchsorted(nodes, head["node"])[owner]
        order = np.argsort(elements)
        elements, owner = elements[order], owner[order]
        twin = np.zeros(len(elements), bool)
        twin[1:] = elements[1:] == elements[:-1]
        twin[:-1] |= twin[1:]
        elements, owner = elements[twin], owner[twin]
        order = np.lexsort((owner, elements))
        elements, owner = elements[order], owner[order]
        new = np.ones(len(elements), bool)
        new[1:] = (elements[1:] != elements[:-1]) | (owner[1:] != owner[:-1])
        elements, owner = elements[new], owner[new]
        first = np.flatnonzero(np.diff(elements, prepend=U(1 << 63)))
        runs = np.diff(first, append=len(elements))
        frequency = np.repeat(runs, runs)
        keep = frequency > 1
        elements, owner, frequency = elements[keep], owner[keep], frequency[keep]
        # From here on the part takes the upper 16 bits, so that elements of different parts stay apart.
        elements = elements | (U(table.column("part")[0].as_py()) << U(48))
        order = np.argsort(owner, kind="stable")
        elements, owner = elements[order], owner[order]
        level = np.floor(np.log2(frequency[order])).astype(np.uint8) if len(order) else np.zeros(0, np.uint8)
        to = (nodes % U(parts)).astype(np.int32)[owner]
        tops = (elements >> U(48)).astype("<u2")
        packed = list(_pack(nodes, head["size"][at], owner, elements, to, np.stack([level, tops & 255, tops >> 8], 1).astype(np.uint8)))
        return pa.table({"part": pa.array([p for p, _ in packed], pa.int32()), "blob": pa.array([b for _, b in packed], pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        head, owner, elements, extra = _unpack(table.column("blob").to_pylist(), extra=True)
        extra = extra.reshape(-1, 3).astype(np.uint64)
        elements = elements | (extra[:, 1] << U(48)) | (extra[:, 2] << U(56))
        nodes, at = np.unique(head["node"], return_index=True)
        owner = np.searchsorted(nodes, head["node"])[owner]
        order = np.lexsort((elements, extra[:, 0], owner))
        elements = elements[order]
        count = np.bincount(owner, minlength=len(nodes))
        ends = np.cumsum(count)
        size = head["size"][at].astype(np.int64)
        keep = np.flatnonzero((count > 0) & (count >= np.ceil(least_share * size - 1e-9)))
        blobs = [elements[ends[i] - count[i] : ends[i]].tobytes() for i in keep]
        return pa.table({"node": pa.array(nodes[keep].view(np.int64)), "size": pa.array(size[keep]),
                         "elements": pa.array(blobs, pa.binary())})

    packed = docs.select("text").mapInArrow(scatter, "part int, blob binary")
    counted = packed.groupBy("part").applyInArrow(count_nodes, "part int, blob binary")
    return counted.groupBy("part").applyInArrow(gather, "node long, size long, elements binary")


def packed_ascending(values: np.ndarray) -> bytes:
    """Ascending 32-bit values: their differences, compressed by planes of bytes."""
    steps = np.diff(values.astype("<u4"), prepend=np.zeros(1, "<u4"))
    return len(steps).to_bytes(4, "little") + pa.compress(byte_planes(steps), "zstd", asbytes=True)


def from_ascending(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    return np.cumsum(from_planes(pa.decompress(blob[4:], 4 * n, "zstd", asbytes=True), np.dtype("<u4")), dtype=np.uint32)


def byte_planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then second bytes, and so on."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T).tobytes()


def from_planes(data: bytes, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def shared_flags(asked: DataFrame) -> DataFrame:
    """Rows (unit, part, flags) for rows (unit, part, blob) of packed ascending distinct elements of a unit: one bit an
    element, in the order asked, set if another unit has it too.

    The answer costs a bit an element, and neither way carries who in the unit has it: a unit knows its own texts.
    Elements are compared by 32 bits and their part, so a few more may be flagged than are shared, never fewer.
    """

    def count_units(table: pa.Table) -> pa.Table:
        sets = [from_ascending(blob) for blob in table.column("blob").to_pylist()]
        elements = np.concatenate(sets)
        order = np.argsort(elements, kind="stable")
        equal = elements[order[1:]] == elements[order[:-1]]
        twin = np.zeros(len(elements), bool)
        twin[order[1:][equal]] = True
        twin[order[:-1][equal]] = True
        flags = [np.packbits(f).tobytes() for f in np.split(twin, np.cumsum([len(s) for s in sets])[:-1])]
        return pa.table({"unit": table.column("unit"), "part": table.column("part"), "flags": pa.array(flags, pa.binary())})

    return asked.groupBy("part").applyInArrow(count_units, "unit long, part int, flags binary")
