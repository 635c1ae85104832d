"""SimHash near-dedup (operator 13): 64-bit SimHash fingerprints, joined by Golay-code fuzzy keys.

A fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of a text's 4-word shingles, repeats included,
counted per text in an Arrow-batched pandas UDF (in the JVM, a lambda per shingle cost ten times as much). Two
fingerprints link when at most ``MOST_BITS`` = 4 bits differ.

Candidates come from the perfect binary Golay code [23, 12, 7]: the 64 bits are cut into three segments of 23, 23 and
18 bits (the last padded with zeros). If two fingerprints differ in at most 4 bits, one segment differs in at most one
(pigeonhole: three segments with two or more would be six). Every 23-bit word lies within distance 3 of exactly one
codeword, its decoding; a word one bit away lies within distance 4 of that codeword. So each fingerprint probes with
the decoded codeword of each segment (three keys) and is found under every codeword within distance 4 of each of its
segments (a handful of keys, from a table of all error patterns of weight 4 or less by syndrome: 10,903 rows, fixed by
the code and not by the data). The equi-join on (segment, codeword) gives candidates; ``bit_count`` of the XOR verifies
them exactly. All of it stays in the JVM: syndromes are parities of masked bits, the decoding is a broadcast join with
the constant pattern table.

Equal texts have one fingerprint, and documents with one fingerprint are one node before the join, so a group of exact
copies costs one row in it, whatever its size. Components of the links come from the shared large/small-star helper;
each document's component_id is the smallest doc_id of the component of its fingerprint.

Defined cases: a null text is an empty text; a text without words has no shingles and fingerprint zero, and links like
any other fingerprint (with every other text of few set bits); fewer than four words make one shingle of all of them;
repeated rows and ties share a fingerprint and a component; a null doc_id gets the component of its fingerprint but
never names one (a component of null ids alone has a null component_id); very long texts are one array of hashes in one
row; an empty table gives an empty result; columns other than doc_id and text are not read, so clashing names do not
matter.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from bourse.llm.components import components
from bourse.llm.tables import stored

# Fixed values of the operator: word pattern, shingle size, hash seed (below), linking distance.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 4
MOST_BITS = 4
# The Golay code [23, 12, 7]: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY_POLY = 0b110001110101
CODE_BITS, CHECK_BITS = 23, 11
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # (first bit, width) of the three segments of a fingerprint

SEED = 42
_WORD = re.compile(WORD.encode())  # on UTF-8 bytes: the separators are ASCII, so words are the same
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BATCH = 1 << 16  # shingles hashed at a time: a very long text is counted in bounded pieces


def _syndrome(word: int) -> int:
    """The remainder of a 23-bit word divided by the generator polynomial."""
    for bit in range(CODE_BITS - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GOLAY_POLY << (bit - CHECK_BITS)
    return word


def error_patterns(most_weight: int = MOST_BITS) -> list[tuple[int, int, int]]:
    """(syndrome, error pattern, weight) of every 23-bit pattern of weight ``most_weight`` or less."""
    out = []
    for weight in range(most_weight + 1):
        for bits in itertools.combinations(range(CODE_BITS), weight):
            error = sum(1 << b for b in bits)
            out.append((_syndrome(error), error, weight))
    return out


def decode(word: int) -> int:
    """The one codeword within distance 3 of a 23-bit word (brute force, for tests)."""
    leader = {s: e for s, e, w in error_patterns(3)}
    return word ^ leader[_syndrome(word)]


# Bit j of the syndrome is the parity of the word's bits whose own syndrome has bit j set.
_CHECK_MASKS = [sum(1 << i for i in range(CODE_BITS) if _syndrome(1 << i) >> j & 1) for j in range(CHECK_BITS)]


def _syndrome_column(segment: Column) -> Column:
    return sum((F.bit_count(segment.bitwiseAND(F.lit(mask))) % 2).cast("long") * (1 << j) for j, mask in enumerate(_CHECK_MASKS))


def fingerprint(text: str | None) -> int:
    """The signed 64-bit fingerprint of one text.

    The words are joined by single spaces once; a shingle is then a slice of that buffer, from its first word's start
    to its last word's end."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    ends = [e - 1 for e in ends]
    if len(words) >= SHINGLE:
        spans = zip(starts, ends[SHINGLE - 1 :])
    else:
        spans = iter([(0, len(joined))] if words else [])
    counts, n = np.zeros(64, np.int64), 0
    while batch := list(itertools.islice(spans, _BATCH)):
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in batch), np.uint64, len(batch))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(batch)
    bits = np.flatnonzero(2 * counts > n)
    return int(sum(1 << int(b) for b in bits)) - ((1 << 64) if 63 in bits else 0)


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint long) of every row: the majority of each bit over its shingles' hashes."""
    return docs.select("doc_id", F.pandas_udf(_fingerprints, LongType())("text").alias("fingerprint"))


def links(fingerprints: DataFrame) -> DataFrame:
    """(a, b) of distinct fingerprints at most ``MOST_BITS`` apart, found by Golay keys and verified."""
    spark = fingerprints.sparkSession
    patterns = F.broadcast(spark.createDataFrame(error_patterns(), "syndrome long, error long, weight int"))
    fp = F.col("fingerprint")
    segments = fingerprints.select(fp, F.explode(F.array(*[
        F.struct(F.lit(k).alias("segment"), F.shiftrightunsigned(fp, first).bitwiseAND((1 << width) - 1).alias("word"))
        for k, (first, width) in enumerate(SEGMENTS)])).alias("s")).select(fp, "s.segment", "s.word")
    keyed = segments.withColumn("syndrome", _syndrome_column(F.col("word"))).join(patterns, "syndrome").select(
        fp, "segment", F.col("word").bitwiseXOR(F.col("error")).alias("codeword"), "weight")
    probes = keyed.where(F.col("weight") <= 3).select(F.col("fingerprint").alias("a"), "segment", "codeword")
    found = keyed.select(F.col("fingerprint").alias("b"), "segment", "codeword")
    pairs = probes.join(found, ["segment", "codeword"]).where(
        (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id for every row of ``docs``."""
    # Written once: the fingerprints feed the nodes, the components and the result, and are computed only here.
    prints = stored(docs.select("doc_id", "text").transform(fingerprinted), "simhash-fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fingerprint")))
    rooted = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
