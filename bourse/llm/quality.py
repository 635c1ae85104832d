"""Quality rules (operator 9): repetition coverage of n-grams and lines by rolling hashes.

Every text is one array of word hashes; an n-gram hash rolls over it, equal hashes are found by sorting, and the words
inside n-grams seen earlier in the same text are marked. The characters of marked words over all word characters are
the coverage of that length; the characters of lines equal to an earlier line give the line coverage. The first
occurrence is not redundant and does not count, so one line said twice in a short text is no ground to reject it.

Defined cases: null or empty text and text without words have zero counts, fail the base rule and are not kept; texts
shorter than n words have coverage 0 for n; rows are judged alone, so ties and repeated rows get equal verdicts; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bourse.llm.text import Batch, U, chunks, encoded, inside, mix, ngram_hash

# Highest share of a text's word characters that may lie inside n-grams seen before, by n, and inside lines seen before;
# highest number of symbols a word.
# Falling with n as in published corpus filters.
NGRAM_LIMITS = {5: 0.20, 7: 0.18, 9: 0.16}
LINE_LIMIT = 0.30
SYMBOL_LIMIT = 0.25

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, repeat_share_5 double, repeat_share_7 double, repeat_share_9 double, "
    "dup_line_share double"
)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def _repeated(keys: np.ndarray, later_only: bool = False) -> np.ndarray:
    """Which keys occur more than once; ``later_only`` leaves out the first of each."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    if not later_only:
        out[order[:-1][same]] = True
    return out


def _covered(batch: Batch, words: np.ndarray, n: int, later_only: bool = False) -> np.ndarray:
    """Which words lie in an n-gram found twice or more in their text, or, with ``later_only``, found before."""
    starts = np.flatnonzero(inside(batch.word_doc, n))
    keys = ngram_hash(words, n)[starts] ^ mix(batch.word_doc[starts].astype(np.uint64) + U(1))
    depth = np.zeros(len(words) + n + 1, np.int32)
    hit = starts[_repeated(keys, later_only)]
    depth[hit] += 1
    depth[hit + n] -= 1
    return np.cumsum(depth)[: len(words)] > 0


def measure(texts: list[bytes], ngram_limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT,
            symbol_limit: float = SYMBOL_LIMIT) -> dict[str, np.ndarray]:
    """All counts, shares and verdicts of some texts."""
    batch = Batch(texts)
    n_words = batch.n_words
    chars = (~batch.space) & ((batch.data & 0xC0) != 0x80)
    word_chars = batch.per_doc(chars)
    n_symbols = batch.per_doc(_SYMBOLS[batch.data])
    char_sums = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(chars, out=char_sums[1:])

    starts, ends, owner = batch.lines()
    full = char_sums[ends] > char_sums[starts]
    starts, ends, owner = starts[full], ends[full], owner[full]
    again = _repeated(batch.span_hash(starts, ends) ^ mix(owner.astype(np.uint64) + U(1)), later_only=True)
    n_dup_lines = np.bincount(owner[again], minlength=batch.size)
    dup_chars = np.bincount(owner[again], weights=(char_sums[ends] - char_sums[starts])[again], minlength=batch.size)

    words = batch.word_hash()
    size_of_word = char_sums[batch.ends] - char_sums[batch.starts]
    at_least = np.maximum(word_chars, 1)
    n_repeat = np.bincount(batch.word_doc[_covered(batch, words, 3)], minlength=batch.size)
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
           "n_repeat_words": n_repeat, "base_failed": (n_words < 50) | (100 * n_repeat > 50 * n_words)}
    bad = dup_chars > line_limit * at_least
    bad |= n_symbols > symbol_limit * n_words
    for n, limit in ngram_limits.items():
        mark = _covered(batch, words, n, later_only=True)
        share = np.bincount(batch.word_doc[mark], weights=size_of_word[mark], minlength=batch.size) / at_least
        out[f"repeat_share_{n}"] = share
        bad |= share > limit
    out["dup_line_share"] = dup_chars / at_least
    out["kept"] = ~out["base_failed"] & ~bad
    return out


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    for part in chunks(batches):
        found = measure(encoded(part.column("text")))
        columns = [part.column("doc_id"), *(pa.array(found[name]) for name in names[1:])]
        yield pa.RecordBatch.from_arrays(columns, names)


def judge(docs: DataFrame) -> DataFrame:
    """Counts, repetition shares and the verdict ``kept`` of every document; one pass, no shuffle."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_judge, SCHEMA)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents with verdict ``kept``, unchanged, in one pass."""
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            yield part.filter(pa.array(measure(encoded(part.column("text")))["kept"]))

    return docs.mapInArrow(keep, schema)
