"""Toxicity (operator 8): noisy-channel deobfuscation, then a linear score of the restored text.

Disguised words are read as the output of a noisy channel: a letter may have been written as a look-alike digit or sign,
with a separator behind it, or several times over. The possible letters of a disguised stretch form a lattice, and
Viterbi decoding under a character trigram model finds the likeliest word; it takes the stretch's place in the text.
A word that has only one reading is left as it is, so only words that mix letters with look-alikes or separators or hold
a letter three times in a row are decoded, and stretches of three and more single letters or look-alikes with separators
between, whatever follows: look-alikes, spacing and repetition are one lattice. Signs at the ends of a word may be
letters or punctuation (`PUNCTUATION`), so the lattice offers their readings and nothing.

The trigram model counts the letters of all documents. The score is a logistic regression over the restored words and
their beginnings (4 to 8 bytes): per selected feature its logarithmic count and its rate. Labels are learned from at
most `TRAINING_ROWS` labelled rows, chosen by hash, whose crc32(doc_id) mod 5 is not 0; nothing else of a row than its text
is an input. Features are selected by how much more often they occur in toxic than in other training documents.

Defined cases: null and empty text score the prior; no labels at all gives one low score for all; rows with a null label
or doc_id are not learned from, a null doc_id is not held out; repeated rows get equal scores; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.tables import stored
from bourse.llm.text import LOWER, Batch, U, chunks, encoded

TRAINING_ROWS = 20_000
FEATURES = 512
BUCKET_BITS = 20
PREFIXES = (4, 5, 6, 7, 8)
_SLICE = 4096

# What a sign may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "{": "c", "<": "c",
}
SEPARATORS = ".-_*~^ "
# Logarithmic probability that a sign at the start or end of a word is punctuation.
PUNCTUATION = ({"(": -0.1, "{": -0.1, "<": -0.1, "+": -2.0, "@": -3.0, "!": -7.0, "|": -7.0, "$": -7.0},
               {"(": -0.1, "{": -0.1, "<": -0.1, "+": -0.1, "|": -0.1, "!": -0.1, "@": -3.0, "$": -5.0})

# Letters a-z, one class for all bytes of other letters, one for everything else.
OTHER, EDGE, CLASSES = 26, 27, 28
_CLASS = np.full(256, EDGE, np.int64)
_CLASS[97:123] = np.arange(26)
_CLASS[65:91] = np.arange(26)
_CLASS[128:] = OTHER
_LETTER = _CLASS < EDGE
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOK_ALIKES]] = True
_JOINT = np.zeros(256, bool)
_JOINT[[ord(c) for c in SEPARATORS.strip()]] = True
_ONE = rb"(?:[a-z0-9@$!|+({<]|[\xc3-\xdf][\x80-\xbf])"
_SPELLED = re.compile(rb"(?<![a-z0-9@$!|+\x80-\xff])(?:" + _ONE + rb"[ .\-_*~^]+){2,}" + _ONE + rb"(?![a-z0-9\x80-\xff])")
_KEPT = 64  # longer readings are not remembered


def trigram_counts(data: np.ndarray) -> np.ndarray:
    c = _CLASS[data]
    return np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)


def letter_model(docs: DataFrame) -> np.ndarray:
    """Logarithmic trigram probabilities, flat, from the letters of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for part in chunks(batches):
            total += trigram_counts(Batch(encoded(part.column("text"))).data)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["trigram", "n"])

    rows = docs.select("text").mapInArrow(count, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CLASSES**3)
    counts[rows.column("trigram").to_numpy()] = rows.column("n").to_numpy()
    counts = counts.reshape(CLASSES, CLASSES, CLASSES)
    pairs = counts.sum(0)
    single = (pairs.sum(0) + 1) / (pairs.sum() + CLASSES)
    double = (pairs + 20 * single) / (pairs.sum(1, keepdims=True) + 20)
    triple = (counts + 20 * double[None]) / (counts.sum(2, keepdims=True) + 20)
    return np.log(triple).ravel()


def lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """The readings (letters, logarithmic channel probability) of each run of one character."""
    out: list[list[tuple[str, float]]] = []
    joined = [c for c in stretch if c not in SEPARATORS] if any(c in SEPARATORS for c in stretch) else list(stretch)
    at = 0
    while at < len(joined):
        c, size = joined[at], 1
        while at + size < len(joined) and joined[at + size] == c:
            size += 1
        at += size
        signs = LOOK_ALIKES.get(c)
        side = 0 if at == size else 1 if at == len(joined) else None
        options = [(s, -math.log(len(signs)) - 0.5) for s in signs] if signs else [(c, 0.0)]
        copies = (size,) if size < 3 and not signs else (1, 2) if size > 1 else (1,)
        out.append([(letter * k, p - 0.7 * (k != size)) for letter, p in options for k in copies])
        if side is not None and c in PUNCTUATION[side]:
            out[-1].append(("", PUNCTUATION[side][c]))
    return out


def decode(stretch: str, model: np.ndarray) -> str:
    """The likeliest reading of a stretch, by Viterbi over the last two letters."""
    table = model
    best: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}
    for options in lattice(stretch):
        then: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (x, y), (score, chain) in best.items():
            for letters, p in options:
                a, b, total = x, y, score + p
                for letter in letters:
                    code = ord(letter) - 97 if "a" <= letter <= "z" else OTHER
                    total += table[(a * CLASSES + b) * CLASSES + code]
                    a, b = b, code
                if (a, b) not in then or then[a, b][0] < total:
                    then[a, b] = (total, (chain, letters))
        best = then
    ends = [(score + table[(x * CLASSES + y) * CLASSES + EDGE], chain) for (x, y), (score, chain) in best.items()]
    chain, parts = max(ends, key=lambda e: e[0])[1], []
    while chain:
        chain, letters = chain
        parts.append(letters)
    return "".join(reversed(parts))


class Restorer:
    """Finds and decodes the disguised stretches of texts; readings are remembered within a task."""

    def __init__(self, model: np.ndarray):
        table = model
        self.read = lru_cache(maxsize=1 << 16)(lambda stretch: decode(stretch, table))

    def restore(self, texts: list[bytes]) -> list[bytes]:
        """The lower-cased texts with every disguised stretch replaced by its reading."""
        texts = [_SPELLED.sub(self._spelled, t.lower()) for t in texts]
        batch = Batch(texts)
        data = batch.data
        letter, sign, joint = _LETTER[data], _SIGN[data], _JOINT[data]
        triple = np.zeros(len(data), bool)
        triple[2:] = letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] < 128)
        # A separator between letters; look-alikes count wherever they stand.
        between = np.zeros(len(data), bool)
        between[1:-1] = joint[1:-1] & letter[2:] & letter[:-2]

        def holds(mask: np.ndarray) -> np.ndarray:
            sums = np.zeros(len(data) + 1, np.int32)
            np.cumsum(mask, out=sums[1:])
            return sums[batch.ends] > sums[batch.starts]

        odd = np.flatnonzero(holds(triple | between) | (holds(letter) & holds(sign)))
        if not len(odd):
            return texts
        raw, pieces, at = data.tobytes(), [], 0
        for start, end in zip(batch.starts[odd].tolist(), batch.ends[odd].tolist(), strict=True):
            pieces += [raw[at:start], self._word(raw[start:end])]
            at = end
        raw_new = b"".join([*pieces, raw[at:]])
        # Readings hold no line feed, so the line feeds between texts are found again by number.
        feeds = np.cumsum([1 + t.count(b"\n") for t in texts])
        lines = raw_new[1:].split(b"\n")
        return [b"\n".join(lines[a:b]) for a, b in zip([0, *feeds[:-1].tolist()], feeds.tolist(), strict=True)]

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "ignore")
        core = text.strip(".,;:?\"')[]}#*%&>~^-_")
        if not any(c.isalpha() for c in core):
            return word
        return self._read(core)

    def _spelled(self, match: re.Match) -> bytes:
        text = match[0].decode("utf-8", "ignore")
        return self._read(text) if any(c.isalpha() for c in text) else match[0]

    def _read(self, stretch: str) -> bytes:
        return (self.read if len(stretch) <= _KEPT else self.read.__wrapped__)(stretch).encode()


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owners and buckets of all words and beginnings of words, and the number of words of each text."""
    batch = Batch(texts)
    letter = _LETTER[batch.data]
    # A word from its first to its last letter.
    before = np.zeros(len(letter) + 1, np.int64)
    np.cumsum(letter, out=before[1:])
    positions = np.flatnonzero(letter)
    some = before[batch.ends] > before[batch.starts]
    starts, ends = batch.starts[some], batch.ends[some]
    first, last = positions[before[starts]], positions[before[ends] - 1] + 1
    owner = batch.word_doc[some]
    keys, owners = [batch.span_hash(first, last)], [owner]
    for size in PREFIXES:
        longer = last - first > size
        keys.append(batch.span_hash(first[longer], first[longer] + size) + U(size))
        owners.append(owner[longer])
    return np.concatenate(owners), (np.concatenate(keys) >> U(64 - BUCKET_BITS)).astype(np.int64), batch.n_words


@dataclass
class Scorer:
    """Trigram model, selected buckets, and weights of logarithmic count, rate and prior."""

    letters: np.ndarray
    buckets: np.ndarray
    count_weights: np.ndarray
    rate_weights: np.ndarray
    prior: float

    def index(self) -> np.ndarray:
        out = np.full(1 << BUCKET_BITS, -1, np.int32)
        out[self.buckets] = np.arange(len(self.buckets))
        return out

    def inputs(self, texts: list[bytes], restorer: Restorer, index: np.ndarray) -> tuple[np.ndarray, ...]:
        """Owners, features, logarithmic counts and rates of the selected features."""
        owner, bucket, n_words = features(restorer.restore(texts))
        at = index[bucket]
        pair, n = np.unique(owner[at >= 0] * len(self.buckets) + at[at >= 0], return_counts=True)
        owner, at = pair // max(1, len(self.buckets)), pair % max(1, len(self.buckets))
        return owner, at, np.log1p(n), 20 * n / np.maximum(n_words[owner], 20)

    def scores(self, texts: list[bytes], restorer: Restorer, index: np.ndarray) -> np.ndarray:
        owner, at, count, rate = self.inputs(texts, restorer, index)
        margin = np.bincount(owner, weights=self.count_weights[at] * count + self.rate_weights[at] * rate, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(margin + self.prior, -500, 500)))


def _fit(rows: np.ndarray, at: np.ndarray, values: np.ndarray, labels: np.ndarray, width: int, steps: int = 400,
         ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse inputs by accelerated gradient steps, each input scaled by its root mean square."""
    n = max(1, len(labels))
    scale = np.sqrt(np.bincount(at, weights=values**2, minlength=width) / n) + 1e-6
    scaled = values / scale[at]
    start = math.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 1.5))
    weights, prior = np.zeros(width), start
    ahead, ahead_prior, momentum = weights.copy(), prior, 1.0
    largest = np.bincount(rows, weights=scaled**2, minlength=n).mean() if len(rows) else 1.0
    rate = 4.0 / (1 + largest)
    for _ in range(steps if len(rows) else 0):
        margin = np.bincount(rows, weights=ahead[at] * scaled, minlength=n) + ahead_prior
        error = 1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels
        gradient = np.bincount(at, weights=error[rows] * scaled, minlength=width) / n + ridge * ahead
        new, new_prior = ahead - rate * gradient, ahead_prior - rate * error.mean()
        then = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead, ahead_prior = new + (momentum - 1) / then * (new - weights), new_prior + (momentum - 1) / then * (new_prior - prior)
        weights, prior, momentum = new, new_prior, then
    return weights / scale, prior


def _held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Fit on labelled rows that are not held out. Only bounded tables reach the driver: trigrams, selected features, and
    the selected inputs of at most `TRAINING_ROWS` rows."""
    letters = letter_model(docs)
    chosen = labels.where("toxic is not null and doc_id is not null").where(~_held_out()).select(
        F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = stored(chosen.orderBy(F.xxhash64("labelled_id")).limit(TRAINING_ROWS), "toxicity-rows")
    training = stored(docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")).select("text", "toxic"), "toxicity-training")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, total = Restorer(letters), np.zeros((1 << BUCKET_BITS, 2), np.int32)
        seen = False
        for part in chunks(batches):
            owner, bucket, _ = features(restorer.restore(encoded(part.column("text"))))
            pair = np.unique((owner << BUCKET_BITS) | bucket)
            toxic = part.column("toxic").to_numpy()[pair >> BUCKET_BITS]
            bucket = pair & ((1 << BUCKET_BITS) - 1)
            for kind in (0, 1):
                total[:, kind] += np.bincount(bucket[toxic == kind], minlength=1 << BUCKET_BITS).astype(np.int32)
            seen = True
        if seen:
            cut = total.reshape(-1, _SLICE, 2)
            some = [i for i in range(len(cut)) if cut[i].any()]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([cut[i].tobytes() for i in some], pa.binary())], ["slice", "counts"])

    n_toxic, n_clean = (training.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first() or (0, 0))
    n_toxic, n_clean = n_toxic or 0, n_clean or 0

    def select(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int32).reshape(-1, 2).astype(np.int64) for c in table.column("counts").to_pylist())
        clean, toxic = total[:, 0], total[:, 1]
        # Root of the evidence that a feature is commoner in toxic documents.
        p, q = toxic / max(1, n_toxic), clean / max(1, n_clean)
        both = (toxic + clean) / max(1, n_toxic + n_clean)
        z = (p - q) / np.sqrt(both * (1 - both) * (1 / max(1, n_toxic) + 1 / max(1, n_clean)) + 1e-9)
        best = np.argsort(-z)[:FEATURES]
        best = best[(z[best] > 2) & (toxic[best] > 1)]
        first = table.column("slice")[0].as_py() * _SLICE
        return pa.table({"bucket": pa.array((best + first).astype(np.int64)), "z": pa.array(z[best])})

    counted = training.mapInArrow(tally, "slice int, counts binary").groupBy("slice").applyInArrow(select, "bucket long, z double")
    best = counted.orderBy(F.desc("z"), "bucket").limit(FEATURES).toArrow()
    buckets = np.sort(best.column("bucket").to_numpy())
    scorer = Scorer(letters, buckets, np.zeros(len(buckets)), np.zeros(len(buckets)), 0.0)

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, index = Restorer(letters), scorer.index()
        for part in chunks(batches):
            owner, at, count, rate = scorer.inputs(encoded(part.column("text")), restorer, index)
            bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
            rows = [np.concatenate([at[a:b], count[a:b], rate[a:b]]).astype("<f4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(rows, pa.binary())], ["toxic", "inputs"])

    collected = training.mapInArrow(inputs, "toxic int, inputs binary").toArrow()
    blobs = [np.frombuffer(b, "<f4").reshape(3, -1) for b in collected.column("inputs").to_pylist()]
    labelled = collected.column("toxic").to_numpy().astype(float)
    rows = np.repeat(np.arange(len(blobs)), [b.shape[1] for b in blobs]) if blobs else np.zeros(0, int)
    flat = np.concatenate(blobs, 1) if blobs else np.zeros((3, 0))
    at, k = flat[0].astype(np.int64), len(buckets)
    weights, prior = _fit(np.concatenate([rows, rows]), np.concatenate([at, at + k]), np.concatenate([flat[1], flat[2]]).astype(float), labelled, 2 * k)
    return Scorer(letters, buckets, weights[:k], weights[k:], prior)


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, index = Restorer(scorer.letters), scorer.index()
        for part in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scorer.scores(encoded(part.column("text")), restorer, index))], ["doc_id", "score"])

    scored = docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled documents and score all."""
    return score(docs, train(docs, labels))
