"""Documents in ascending doc_id order, in blocks of bounded size, with the first document of the next block at hand.

Approximate quantiles of doc_id (as many as there are blocks) are the only thing that passes the driver. The texts are
shuffled once. Rows with a null doc_id come first; rows with equal ids are ordered by text and share a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.tables import spread

LOWEST = -(1 << 63)
# Blocks a shuffle partition: enough to even them out.
BLOCKS = 4


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(batch.column("doc_id"), LOWEST).to_numpy(zero_copy_only=False)


def blocks(docs: DataFrame, heads: bool = False) -> DataFrame:
    """(block, head, doc_id, text): every document in its block, and with ``heads`` also, marked, the first document
    of each block in the block before it (that of the first block in the last one)."""
    ids = docs.selectExpr("cast(doc_id as long) doc_id")
    count = spread(docs.sparkSession, BLOCKS)
    marks = [k / count for k in range(1, count)] or [0.5]
    cuts = ids.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(LOWEST)), marks, 20 * count)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))
    before: dict[int, int] = {}
    if heads:

        def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, int] = {}
            for batch in batches:
                values = np.sort(_ids(batch))
                block = np.searchsorted(cuts, values, "right")
                first = np.flatnonzero(np.diff(block, prepend=-1))
                for b, v in zip(block[first].tolist(), values[first].tolist(), strict=True):
                    found[b] = min(v, found.get(b, v))
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(found), pa.int32()), "doc_id": pa.array(list(found.values()), pa.int64())})

        rows = ids.mapInArrow(least, "block int, doc_id long").groupBy("block").agg(F.min("doc_id").alias("first")).collect()
        firsts = sorted((r["block"], r["first"]) for r in rows)
        before = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array(sorted(before), np.int64)
        for batch in batches:
            values = _ids(batch)
            block = np.searchsorted(cuts, values, "right").astype(np.int32)
            out = [pa.array(block), pa.array(np.zeros(len(block), bool)), batch.column("doc_id"), batch.column("text")]
            yield pa.RecordBatch.from_arrays(out, ["block", "head", "doc_id", "text"])
            chosen = np.flatnonzero(np.isin(values, known)) if len(known) else []
            if len(chosen):
                some = batch.take(pa.array(chosen))
                to = pa.array([before[v] for v in values[chosen].tolist()], pa.int32())
                yield pa.RecordBatch.from_arrays([to, pa.array(np.ones(len(chosen), bool)), some.column("doc_id"), some.column("text")],
                                                 ["block", "head", "doc_id", "text"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(deal, "block int, head boolean, doc_id long, text string")


def in_order(table: pa.Table) -> pa.Table:
    """The documents of a block by doc_id and text, heads last, with null texts as empty."""
    table = table.set_column(table.schema.get_field_index("text"), "text", pc.fill_null(table.column("text").combine_chunks(), ""))
    rank = pc.fill_null(table.column("doc_id"), LOWEST)
    table = table.append_column("rank", rank)
    return table.sort_by([("head", "ascending"), ("rank", "ascending"), ("text", "ascending")])
