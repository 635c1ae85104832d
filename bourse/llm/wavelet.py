"""Token files (operator 1): a wavelet matrix per shard, one file each.

Documents are encoded in ascending doc_id order and cut into shards of about a million tokens, at document ends. A shard
is stored as bit planes, from the highest bit of the ids to the lowest: each plane holds that bit of all tokens in the
order in which the planes above have sorted them, zeros before ones, stably. With counts of ones at every 512th bit,
rank takes one table look-up and a few bytes, and so do, per plane, access to a token, the count of a token before a
position, and, downwards and up again, the position of its k-th occurrence, all from the planes without decoding.

File of a shard, little-endian: magic ``WMX1``, planes (u32), documents (u64), tokens (u64), doc_ids (i64 each),
document lengths (u32 each); per plane: number of zeros (u64), ones before every 512 bits (u32 each), the bits. Spark
writes each shard as a Parquet file of one row (zstd), with the commit protocol that survives lost executors.

Defined cases: null and empty text is the end id alone; a null doc_id sorts first; rows with equal ids are ordered by
text; an empty table gives no file and an empty result; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourse.llm.ordering import LOWEST, blocks, in_order
from bourse.llm.tables import stored
from bourse.llm.tokens import encoder
from bourse.session import shared_folder

END_ID = 2
SHARD_TOKENS = 1 << 20
STEP = 512
_HEAD = struct.Struct("<4sIQQ")


class WaveletMatrix:
    """Bit planes of a token sequence with rank and select."""

    def __init__(self, size: int, zeros: list[int], ones: list[np.ndarray], bits: list[np.ndarray]):
        self.size, self.zeros, self.ones, self.bits = size, zeros, ones, bits
        self.planes = len(zeros)

    @classmethod
    def build(cls, tokens: np.ndarray, planes: int) -> WaveletMatrix:
        zeros, ones, bits = [], [], []
        current = tokens.astype(np.uint16 if planes <= 16 else np.uint32)
        for plane in range(planes - 1, -1, -1):
            bit = (current & current.dtype.type(1 << plane)) != 0
            packed = np.packbits(bit, bitorder="little")
            blocks = len(bit) // STEP
            counts = np.zeros(blocks + 1, np.uint32)
            words = packed[: blocks * STEP // 8].view("<u8").reshape(blocks, STEP // 64)
            np.cumsum(np.bitwise_count(words).sum(1, dtype=np.uint32), out=counts[1:])
            low = np.compress(~bit, current)
            zeros.append(len(low))
            ones.append(counts)
            bits.append(packed)
            current = np.concatenate([low, np.compress(bit, current)])
        return cls(len(tokens), zeros, ones, bits)

    def to_bytes(self) -> bytes:
        parts = []
        for zeros, ones, bits in zip(self.zeros, self.ones, self.bits, strict=True):
            parts += [struct.pack("<Q", zeros), ones.astype("<u4").tobytes(), bits.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: memoryview, size: int, planes: int) -> WaveletMatrix:
        zeros, ones, bits, at = [], [], [], 0
        for _ in range(planes):
            zeros.append(struct.unpack_from("<Q", data, at)[0])
            at += 8
            ones.append(np.frombuffer(data, "<u4", size // STEP + 1, at))
            at += 4 * (size // STEP + 1)
            bits.append(np.frombuffer(data, np.uint8, (size + 7) // 8, at))
            at += (size + 7) // 8
        return cls(size, zeros, ones, bits)

    def _rank(self, plane: int, at: int) -> int:
        """Ones before a position."""
        block = at // STEP
        rest = np.unpackbits(self.bits[plane][block * STEP // 8 : (at + 7) // 8], bitorder="little")[: at - block * STEP]
        return int(self.ones[plane][block]) + int(rest.sum())

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit: binary search over ranks, then inside a block."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            ones = self._rank(plane, middle + 1)
            if (ones if bit else middle + 1 - ones) > k:
                high = middle
            else:
                low = middle + 1
        return low

    def access(self, at: int) -> int:
        token = 0
        for plane in range(self.planes):
            bit = int(self.bits[plane][at // 8] >> (at % 8)) & 1
            ones = self._rank(plane, at)
            at = self.zeros[plane] + ones if bit else at - ones
            token = token * 2 + bit
        return token

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for plane in range(self.planes):
            bit = token >> (self.planes - 1 - plane) & 1
            a, b = self._rank(plane, start), self._rank(plane, end)
            start, end = (self.zeros[plane] + a, self.zeros[plane] + b) if bit else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token between two positions."""
        if token >> self.planes:
            return 0
        low, high = self._range(token, start, self.size if end is None else end)
        return high - low

    def find(self, token: int, k: int) -> int | None:
        """Position of the k-th (from 0) occurrence of a token."""
        if k < 0 or k >= self.count(token):
            return None
        at = self._range(token, 0, self.size)[0] + k
        for plane in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - plane) & 1
            at = self._select(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All tokens: the planes undone from the lowest bit up."""
        values = np.zeros(self.size, np.uint16 if self.planes <= 16 else np.uint32)
        for plane in range(self.planes - 1, -1, -1):
            bit = np.unpackbits(self.bits[plane], count=self.size, bitorder="little").view(bool)
            here = np.empty_like(values)
            # By positions: random bits make boolean masks several times slower.
            here[np.flatnonzero(~bit)] = values[: self.zeros[plane]]
            here[np.flatnonzero(bit)] = values[self.zeros[plane] :] | values.dtype.type(1 << (self.planes - 1 - plane))
            values = here
        return values.astype(np.uint32)


def shard_bytes(ids: list[int | None], lengths: list[int], tokens: np.ndarray, planes: int) -> bytes:
    known = np.array([LOWEST if i is None else i for i in ids], "<i8")
    head = _HEAD.pack(b"WMX1", planes, len(ids), len(tokens))
    return head + known.tobytes() + np.array(lengths, "<u4").tobytes() + WaveletMatrix.build(tokens, planes).to_bytes()


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """doc_ids, document lengths and the matrix of a shard file."""
    magic, planes, n_docs, n_tokens = _HEAD.unpack_from(data)
    if magic != b"WMX1":
        raise ValueError("no wavelet shard")
    at = _HEAD.size
    ids = np.frombuffer(data, "<i8", n_docs, at)
    lengths = np.frombuffer(data, "<u4", n_docs, at + 8 * n_docs)
    matrix = WaveletMatrix.from_bytes(memoryview(data)[at + 12 * n_docs :], n_tokens, planes)
    return [None if i == LOWEST else i for i in ids.tolist()], lengths, matrix


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every document and write the shard files under ``folder``."""

    def encode(table: pa.Table) -> pa.Table:
        table = in_order(table)
        words = encoder(vocabulary)
        planes = max(words.largest, end_id, 1).bit_length()
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        block = table.column("block")[0].as_py()
        rows: list[tuple] = []
        held: list[np.ndarray] = []
        first, size = 0, 0
        end = np.array([end_id], np.uint32)
        for found in words.encode(texts):
            held.append(np.concatenate([found, end]))
            size += len(held[-1])
            if size >= shard_tokens:
                rows.append((block, len(rows), size, shard_bytes(ids[first : first + len(held)], list(map(len, held)), np.concatenate(held), planes)))
                first, size, held = first + len(held), 0, []
        if held:
            rows.append((block, len(rows), size, shard_bytes(ids[first:], list(map(len, held)), np.concatenate(held), planes)))
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)],
                                    ["block", "shard", "n_tokens", "data"])

    shards = blocks(docs).groupBy("block").applyInArrow(encode, "block int, shard int, n_tokens long, data binary")
    shards.write.options(compression="zstd", maxRecordsPerFile="1").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("block int, shard int, n_tokens long, data binary").parquet(folder)


def documents_of(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the shard files."""
    per_shard = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_block = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("block", "shard", "n_tokens")
    before = sizes.groupBy("block").agg(F.sum("n_tokens").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(per_block), F.lit(0)).alias("blocks_before"))
    offsets = sizes.join(before, "block").select(
        "block", "shard", (F.col("blocks_before") + F.coalesce(F.sum("n_tokens").over(per_shard), F.lit(0))).alias("offset"))
    offsets = stored(offsets, "shard-offsets")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, shard, data in zip(*(batch.column(c) for c in ("block", "shard", "data")), strict=True):
                ids, lengths, matrix = open_shard(data.as_py())
                tokens = matrix.decode().astype("<u4")
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths
                raw = memoryview(tokens).cast("B")
                sums = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()] * n, pa.int32()), pa.array([shard.as_py()] * n, pa.int32()), pa.array(ids, pa.int64()),
                     pa.array(starts), pa.array(lengths.astype(np.int64)), pa.array(sums, pa.int64())],
                    ["block", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = shards.select("block", "shard", "data").mapInArrow(read, "block int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(offsets, ["block", "shard"]).select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def encoded_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the token files of all documents into a new shared folder and describe every document from them."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-shards")
    write_shards(docs, folder, vocabulary)
    return documents_of(read_shards(spark, folder))
