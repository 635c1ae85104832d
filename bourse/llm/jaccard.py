"""N-gram Jaccard join (operator 2): a size-aware heavy-light set join and its connected components.

Sets are the distinct w-word shingles of a text; equal sets are one node. Two nodes link when 100 * intersection >=
100 * t * union. Such nodes share at least t of the larger set, so a node of which less than t is shared with anybody
has no link, and `shared_elements` finds the rest in one pass over all elements.

Small nodes (size up to a boundary) enumerate fixed-size subsets: nodes of sizes n and m link when they share
ceil(t (n + m) / (1 + t)) elements, so every subset of that size is a key, and all nodes under a key link. Large nodes
scan inverted lists of their rarest elements: with overlap o needed, linked nodes share one of their size - o + 1 rarest.
The boundary is where the number of subsets exceeds the cost of the lists, from the sizes of all nodes.

Lists do not emit all pairs. First every node of a list is checked against the list's least node, then, where a list
still spans components, against one of its nodes that differs from list to list; this connects groups of near copies at
a cost in proportion to their entries. Only pairs of different components are left to check, and only where the first
element in common leaves room for the overlap needed. All links between different components are found, so the
components are exact.

Defined cases: null or empty text and text without words has an empty set, which links with nothing; fewer words than w
make one shingle; repeated rows and ties share a node; an empty table gives an empty result; other columns are not read.
Rows with a null doc_id keep null, take part by their text and never lend their id to a component (one of only such
rows has a null id).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.components import components
from bourse.llm.sharing import Sets, shared_elements
from bourse.llm.tables import stored
from bourse.llm.text import Batch, U, chunks, encoded, inside, mix, ngram_hash

WORDS, PERCENT = 5, 75
# Subsets of nodes beyond this size are never cheaper than lists.
LARGEST_SMALL = 16
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 32


def shingle_sets(texts: list[bytes], n: int = WORDS) -> Sets:
    """Nodes, set sizes, owners and distinct shingle hashes of some texts; an empty set is node 0."""
    batch = Batch(texts, lower=True)
    words = batch.word_hash()
    full = inside(batch.word_doc, n)
    elements, owner = ngram_hash(words, n)[full], batch.word_doc[: len(full)][full]
    short = np.flatnonzero((batch.n_words > 0) & (batch.n_words < n))
    if len(short):
        whole = np.array([_sequence(words[batch.first_word[i] : batch.first_word[i + 1]]) for i in short], np.uint64)
        elements, owner = np.concatenate([elements, whole]), np.concatenate([owner, short])
    order = np.lexsort((elements, owner))
    elements, owner = elements[order], owner[order]
    new = np.ones(len(elements), bool)
    new[1:] = (elements[1:] != elements[:-1]) | (owner[1:] != owner[:-1])
    elements, owner = elements[new], owner[new]
    sizes = np.bincount(owner, minlength=len(texts))
    sums = np.zeros(len(elements) + 1, np.uint64)
    np.cumsum(mix(elements ^ U(0x5DEECE66D)), out=sums[1:])
    ends = np.cumsum(sizes)
    nodes = mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64))
    return np.where(sizes > 0, nodes, U(0)), sizes, owner, elements


def _sequence(words: np.ndarray) -> int:
    out = len(words)
    for word in words.tolist():
        out = (out * 0x9E3779B97F4A7C15 + word) % (1 << 64)
    return out


def nodes_of(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_key, node, size) of every document; text_key is Spark's hash of the text as it stands."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            nodes, sizes, _, _ = shingle_sets(encoded(chunk.column("text")), words)
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("text_key"), pa.array(nodes.view(np.int64)), pa.array(sizes)],
                                             ["doc_id", "text_key", "node", "size"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text", "xxhash64(text) text_key")
    return rows.mapInArrow(find, "doc_id long, text_key long, node long, size long")


def overlap_needed(n: int, m: int, percent: int) -> int:
    """Least intersection of linked sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


def _partner_sizes(n: int, percent: int, boundary: int) -> list[int]:
    return [m for m in range(1, boundary + 1) if percent * max(n, m) <= 100 * min(n, m)]


def _subsets(n: int, percent: int, boundary: int) -> int:
    return sum(math.comb(n, o) for m in _partner_sizes(n, percent, boundary) if (o := overlap_needed(n, m, percent)) <= n)


def boundary_by_cost(sizes: dict[int, int], percent: int) -> int:
    """The largest set size whose subsets, over all nodes up to it, are no more than the list entries they save.

    An entry of a list costs about as much as a subset key, and each entry is met by the nodes of similar size."""
    best, best_cost = 0, None
    for boundary in range(LARGEST_SMALL + 1):
        keys = sum(c * _subsets(n, percent, boundary) for n, c in sizes.items() if n <= boundary)
        lists = sum(c * (n - -(-percent * n // 100) + 1) * (1 + math.log2(1 + c))
                    for n, c in sizes.items() if 100 * n > percent * boundary)
        if best_cost is None or keys + lists < best_cost:
            best, best_cost = boundary, keys + lists
    return best


def _size_ok(percent: int, a: str = "size", b: str = "other_size") -> F.Column:
    return percent * F.greatest(a, b) <= 100 * F.least(a, b)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by the intersection of their shared elements."""
    right = sets.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("elements").alias("right"))
    left = sets.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("elements").alias("left"))
    joined = pairs.join(right, "b").join(left, "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, n, y, m in zip(batch.column("left").to_pylist(), batch.column("size_a").to_pylist(),
                                  batch.column("right").to_pylist(), batch.column("size_b").to_pylist(), strict=True):
                both = np.sort(np.concatenate([np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (n + m - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(check, "a long, b long")


def connections_of(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of nodes that connect each component: links, or nodes and the roots that links gave them."""
    sets = stored(shared_elements(docs, lambda texts: shingle_sets(texts, words), percent / 100), "join-sets")
    counts = {r["size"]: r["count"] for r in sets.where(F.col("size") <= 2 * LARGEST_SMALL).groupBy("size").count().collect()}
    boundary = boundary_by_cost(counts, percent)

    def subset_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for node, n, blob in zip(*(batch.column(c).to_pylist() for c in ("node", "size", "elements")), strict=True):
                elements = sorted(np.frombuffer(blob, "<u8").tolist())
                for m in _partner_sizes(n, percent, boundary):
                    for chosen in combinations(elements, overlap_needed(n, m, percent)):
                        key = _sequence(np.array([min(n, m), max(n, m), *chosen], np.uint64))
                        out.append((key - (1 << 63), node, n, m))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else
                                             [pa.array([], pa.int64())] * 4, ["key", "node", "size", "with"])

    def list_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, blob in zip(*(batch.column(c).to_pylist() for c in ("node", "size", "elements")), strict=True):
                elements = np.frombuffer(blob, "<u8")
                prefix = n + 1 - -(-percent * n // 100) - (n - len(elements))  # elements of this node alone come first
                if prefix > 0:
                    rare = elements[:prefix]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rare.view(np.int64)), pa.array(np.full(len(rare), node)), pa.array(np.full(len(rare), n)),
                         pa.array(len(elements) - np.arange(len(rare)))], ["key", "node", "size", "room"])

    checked = []
    if boundary and any(n <= boundary for n in counts):
        small = stored(sets.where(F.col("size") <= boundary).mapInArrow(subset_keys, "key long, node long, size long, with long"), "join-subsets")
        ends = small.groupBy("key").agg(F.min(F.when(F.col("size") <= F.col("with"), F.col("node"))).alias("low"),
                                        F.min(F.when(F.col("size") >= F.col("with"), F.col("node"))).alias("high"))
        ends = stored(ends.where("low is not null and high is not null"), "join-subset-ends")
        met = small.join(ends, "key").select(
            "node", F.when(F.col("size") < F.col("with"), F.col("high")).otherwise(F.col("low")).alias("other"))
        checked.append(met)

    large = F.col("size") * 100 > percent * boundary
    # room: the elements from this one on, which bound the overlap of two sets from their first common element.
    lists = stored(sets.where(large).mapInArrow(list_entries, "key long, node long, size long, room long"), "join-lists")
    shared = lists.groupBy("key").count().where("count > 1").select("key")
    over = F.greatest("size", "other_size") > boundary

    def starred(entries: DataFrame, order: F.Column) -> DataFrame:
        """Each node of a list with the list's first node by some order."""
        first = stored(entries.groupBy("key").agg(F.min(F.struct(order.alias("o"), "node", "size")).alias("p")), "join-pivots")
        first = first.select("key", F.col("p.node").alias("other"), F.col("p.size").alias("other_size"))
        return entries.join(first, "key").where((F.col("node") != F.col("other")) & _size_ok(percent) & over)

    def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
        """The roots after some more links, as (node, root) of the nodes that have one."""
        both = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)
        return stored(components(both), "join-roots")

    def open_entries(roots: DataFrame) -> DataFrame:
        """Entries of the lists that hold more than one component, with their roots."""
        labelled = stored(lists.join(roots, "node", "left").select("key", "node", "size", "room", F.coalesce("root", "node").alias("root")), "join-labelled")
        mixed = stored(labelled.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key"), "join-mixed")
        return stored(labelled.join(mixed, "key", "left_semi"), "join-open")

    def pairs_of(met: DataFrame) -> DataFrame:
        return met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).where("a < b").distinct()

    lists = stored(lists.join(stored(shared, "join-shared"), "key", "left_semi"), "join-lists")
    checked.append(starred(lists, F.col("node")).select("node", "other"))
    met = checked[0] if len(checked) == 1 else checked[0].union(checked[1])
    links = stored(_verified(pairs_of(met), sets, percent), "join-links")
    roots = stored(components(links), "join-roots")
    more = stored(_verified(pairs_of(starred(open_entries(roots), F.xxhash64("node", "key"))), sets, percent), "join-links")
    roots = merged(roots, more)
    entries = open_entries(roots)
    other = entries.select("key", *(F.col(c).alias("other" + {"node": ""}.get(c, "_" + c)) for c in ("node", "size", "room", "root")))
    fits = (100 + percent) * F.least("room", "other_room") >= percent * (F.col("size") + F.col("other_size"))
    rest = entries.join(other, "key").where(
        (F.col("node") < F.col("other")) & (F.col("root") != F.col("other_root")) & fits & _size_ok(percent) & over)
    last = stored(_verified(pairs_of(rest), sets, percent), "join-links")
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(last)


def join_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of every document.

    class_id is the smallest doc_id with the same set, component_id the smallest one reachable by links."""
    return _components(docs, words, percent).select("doc_id", "n_shingles", "component_id", "class_id")


def _components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """As `join_components`, with text_key and the root node of the component (null for an empty set)."""
    found = stored(nodes_of(docs, words), "join-nodes")
    roots = components(connections_of(docs, words, percent))
    classes = found.where("size > 0").groupBy("node").agg(F.min("doc_id").alias("class_id"))
    classes = stored(classes.join(roots, "node", "left").select("node", "class_id", F.coalesce("root", "node").alias("root")), "join-classes")
    ids = stored(classes.groupBy("root").agg(F.min("class_id").alias("component_id")), "join-component-ids")
    named = stored(classes.join(ids, "root").select("node", "class_id", "component_id", "root"), "join-named")
    own = F.col("size") == 0
    return found.join(named, "node", "left").select(
        "doc_id", "text_key", "root", F.col("size").alias("n_shingles"),
        F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def first_of_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, unchanged: that with the smallest doc_id (null last), then by text hash. Documents
    with an empty set all stay.

    What goes is a list of (doc_id, text hash); it is broadcast up to `BROADCAST_BYTES` by its count, so that the texts
    stay where they are, and shuffled beyond."""
    found = stored(_components(docs, words, percent).where("n_shingles > 0"), "join-found")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = stored(found.groupBy("root").agg(F.min(place).alias("first")), "join-first")
    placed = found.join(first, "root").select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), place.alias("place"), "first")
    gone = stored(placed.where("place <> first").select("gone_id", "gone_key").distinct(), "join-gone")
    again = stored(placed.where("place = first").groupBy("gone_id", "gone_key").count().where("count > 1"), "join-again")
    side = F.broadcast(gone) if gone.count() * ROW_BYTES <= BROADCAST_BYTES else gone
    key = F.xxhash64("text")
    kept = docs.join(side, F.equal_null(docs["doc_id"].cast("long"), F.col("gone_id")) & (key == F.col("gone_key")), "left_anti")
    if not again.limit(1).count():
        return kept
    # Rows that repeat both id and text of a first document: one of each stays.
    same = F.equal_null(kept["doc_id"].cast("long"), F.col("gone_id")) & (key == F.col("gone_key"))
    return kept.join(again, same, "left_anti").union(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
