"""Hard-negative mining (operator 12): a cover tree over norm-augmented vectors, searched best first within a window.

The vectors become integers (floor of 256 x) and a row's score is its inner product with the anchor. Candidates are
dealt into shards of at most ``SHARD_ROWS`` rows and anchors into blocks of at most ``ANCHOR_BLOCK`` rows; each
(shard, block) meets once in a cogroup, so the work is the stated query set against all rows, in blocks, and no group
grows with the table.

In a task, the shard's vectors are augmented by one coordinate sqrt(M^2 - |x|^2) (M the largest norm of the shard), so
that all lie on one sphere and Euclidean nearness means a large inner product (the usual reduction of inner-product
search to nearest neighbours). A cover tree is built over them: every node has a centre among its points and a covering
radius r, the largest distance of its points from the centre; its children are led by the parent's centre and by the
points farthest from the centres so far, until these lie within half the radius or there are ``FANOUT`` (in 64
dimensions halving alone makes nearly every point a child of its own). For an anchor q (augmented by 0), every point x under a node with centre p satisfies
|q.x - q.p| <= |q| r, which bounds the scores of the whole node. The search pops nodes by their upper bound, skips nodes
whose bounds lie wholly outside the asked score window, stops when k rows are found and no node can beat or tie the
k-th, and scores the points of leaves exactly. Many queries go down the tree together: each scores its ``FIRST`` most
promising leaves, then every leaf is scored once, in one matrix product, for the queries whose bounds still reach it. It
is exact: no node that could hold a qualifying row is skipped, and scores too large for exact doubles (2^53) are summed
in 64-bit integers, those too large for these in Python's integers, one query at a time.

Two passes: the first finds each anchor's five best other rows of its label (positives) in every shard and keeps the
five best over shards; the second asks every shard, for each anchor and positive, for the three best rows of another
label inside 50 * positive <= 100 * negative <= 95 * positive, and keeps the three best over shards. A positive with a
score below zero has an empty window and comes after all others, so the first pass asks for scores from zero only. Between
the passes scores travel as decimal digits, because a score that takes part in the order need not fit a long.

Defined cases: rows with a null vec_id, label or vector, or a null or non-finite component, take no part; rows repeated
whole count once; rows that share a vec_id and differ otherwise are anchors and positives of their own; an anchor never is
its own positive (nor is any row with its vec_id); ties are ordered by the smaller vec_id; components may be any finite
number; a returned score that does not fit a long fails the query; an anchor without positives, a positive without
negatives and an empty table give no rows; vectors of different lengths are scored over their common leading components;
other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.tables import stored

# Fixed values of the contract: relabelled ids, integer scale, anchors, positives, negatives a pair, window in percent.
RELABEL_EVERY, SCALE, ANCHOR_EVERY = 7, 256, 50
POSITIVES, NEGATIVES = 5, 3
LEAST_PERCENT, MOST_PERCENT = 50, 95
# Parameters of the blocks and the tree: rows a shard, anchors a block, points a leaf.
SHARD_ROWS = 20_000
ANCHOR_BLOCK = 2_000
LEAF = 256  # points a leaf, scored by one matrix product; in many dimensions bounds prune little inside small nodes
FANOUT = 16  # children a node at most
TOGETHER = 512  # queries that go down the tree together
FIRST = 4  # leaves a query scores before all leaves are gone through once
CELLS = 500_000  # scores held at a time

SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FOUND = ("anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score string, "
          "row long, vec_id long, score string")
# Sums of integers are exact in doubles, and fit 64-bit integers, while the norms' product stays below these.
_EXACT_DOUBLE, _EXACT_LONG = 2.0**52, 2.0**62
_LARGEST_LONG = 2**63 - 1


def cleaned(embeddings: DataFrame) -> DataFrame:
    """vec_id, label (relabelled), vector (whole numbers as doubles) of the rows that take part, each whole row once."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (given + 1) % 10).otherwise(given)

    def scaled(x: Column) -> Column:
        y = SCALE * x.cast("double")
        return F.when(F.abs(y) < _EXACT_DOUBLE, F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole numbers

    return (embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
            .select("vec_id", label.alias("label"), F.transform("embedding", scaled).alias("vector")).dropDuplicates())


class CoverTree:
    """A cover tree over the rows of ``points`` (integers), augmented onto one sphere."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        norms = np.einsum("ij,ij->i", self.points, self.points)
        self.norms = np.sqrt(norms)
        lift = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))
        self.lifted = np.hstack([self.points, lift[:, None]])
        self.centre, self.radius, self.children, self.members = [], [], [], []
        if len(points):
            self._node(np.arange(len(points)), 0)
        self.centre, self.radius = np.asarray(self.centre, dtype=np.int64), np.asarray(self.radius)
        # Per unit of the query's norm: the radius, and the relative rounding of the computed product and distances.
        rounding = (self.points.shape[1] + 4) * 2.0**-52
        self.slack = self.radius * (1 + 4 * rounding) + self.norms[self.centre] * rounding
        self.farthest = float(self.norms.max(initial=0.0))

    def _node(self, rows: np.ndarray, centre: int) -> int:
        at = len(self.centre)
        distance = np.linalg.norm(self.lifted[rows] - self.lifted[centre], axis=1)
        radius = float(distance.max())
        self.centre.append(centre)
        self.radius.append(radius)
        self.children.append(None)
        self.members.append(None)
        if len(rows) <= LEAF or radius == 0.0:
            self.members[at] = rows
            return at
        # Children: the parent's centre, then the points farthest from the centres so far, FANOUT at most; each point goes
        # to its nearest centre, and a child's radius is the real largest distance, so the bounds stay exact.
        leads, nearest = [centre], distance.copy()
        while len(leads) < FANOUT and nearest.max() > radius / 2:
            leads.append(int(rows[np.argmax(nearest)]))
            nearest = np.minimum(nearest, np.linalg.norm(self.lifted[rows] - self.lifted[leads[-1]], axis=1))
        owner = np.argmin(np.stack([np.linalg.norm(self.lifted[rows] - self.lifted[c], axis=1) for c in leads]), axis=0)
        groups = [(rows[owner == k], lead) for k, lead in enumerate(leads) if (owner == k).any()]
        if len(groups) == 1:  # equal points: no split is possible
            self.members[at] = rows
            return at
        self.children[at] = np.array([self._node(members, lead) for members, lead in groups])
        return at

    def _scores(self, rows: np.ndarray, q: np.ndarray, size: float) -> np.ndarray:
        """Exact inner products: doubles that hold them, 64-bit integers, or Python's where these could overflow."""
        points = self.points[rows]
        if size * self.farthest < _EXACT_DOUBLE:
            return np.rint(points @ q)
        reach = size * self.norms[rows]  # no partial sum is larger
        # A component of q beyond the limit meets only zeros in rows within it.
        whole = np.where(np.abs(q) < _EXACT_LONG, q, 0.0).astype(np.int64)
        if reach.max(initial=0.0) < _EXACT_LONG:
            return points.astype(np.int64) @ whole
        scores, fits = np.empty(len(rows), dtype=object), reach < _EXACT_LONG
        scores[fits] = points[fits].astype(np.int64) @ whole
        integers = [int(x) for x in q]
        for k in np.flatnonzero(~fits):
            scores[k] = sum(int(x) * y for x, y in zip(points[k], integers, strict=True) if y)
        return scores

    def search(self, query: np.ndarray, k: int, allowed: np.ndarray, least: float = -math.inf, most: float = math.inf):
        """The k best (score, row) of allowed rows with least <= score <= most, by score down and row up."""
        if not len(self.centre) or least > most:
            return []
        q = query.astype(np.float64)
        size = float(np.linalg.norm(q))
        found: list[tuple[float, int]] = []

        def bounds(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            middle = self.points[self.centre[nodes]] @ q
            slack = size * self.slack[nodes] + 1.0  # scores are integers; one more absorbs rounding
            return middle - slack, middle + slack

        low, high = bounds(np.array([0]))
        queue = [(-float(high[0]), 0, float(low[0]))]
        while queue:
            negative_high, node, low = heapq.heappop(queue)
            if len(found) == k and -negative_high < -found[-1][0]:
                break
            if low > most or -negative_high < least:
                continue  # the node's scores lie wholly outside the window
            children = self.children[node]
            if children is not None:
                lows, highs = bounds(children)
                for child, lo, hi in zip(children.tolist(), lows.tolist(), highs.tolist(), strict=True):
                    if lo <= most and hi >= least:
                        heapq.heappush(queue, (-hi, child, lo))
                continue
            rows = self.members[node]
            rows = rows[allowed[rows]]
            scores = self._scores(rows, q, size)
            inside = ((scores >= least) & (scores <= most)).astype(bool)
            scores, rows = scores[inside], rows[inside]
            if scores.dtype != object:
                best = np.lexsort((rows, -scores))[:k]  # the leaf's k best by score down, row up, before any Python tuple
                scores, rows = scores[best], rows[best]
            found = sorted(found + list(zip((-scores).tolist(), rows.tolist(), strict=True)))[:k]
        return [(int(-s), r) for s, r in found]

    def search_all(self, queries: np.ndarray, k: int, admits, least: list, most: list) -> list[list[tuple[int, int]]]:
        """``search`` for every query; ``admits(columns, rows)`` says which rows are allowed (queries down, rows across)."""
        out: list[list[tuple[int, int]]] = [[] for _ in queries]
        if not len(self.centre):
            return out
        exact = np.linalg.norm(queries, axis=1) * self.farthest < _EXACT_DOUBLE
        for j in np.flatnonzero(~exact).tolist():
            allowed = admits(np.array([j]), np.arange(len(self.points)))[0]
            out[j] = self.search(queries[j], k, allowed, least[j], most[j])
        low, high = np.array(least, dtype=np.float64), np.array(most, dtype=np.float64)
        usual = np.flatnonzero(exact & (low <= high))
        for start in range(0, len(usual), TOGETHER):
            columns = usual[start : start + TOGETHER]
            scores, rows = self._together(queries[columns], k, lambda at, r, c=columns: admits(c[at], r), low[columns], high[columns])
            for j, s, r in zip(columns.tolist(), scores.tolist(), rows.tolist(), strict=True):
                out[j] = [(int(x), y) for x, y in zip(s, r, strict=True) if x != -math.inf]
        return out

    def _leaves(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Leaves that a query's window reaches, and their upper bounds by query (-inf: not reached)."""
        size = np.linalg.norm(q, axis=1)
        leaves, bounds = [], []
        nodes, reached = np.array([0]), np.ones((1, len(q)), dtype=bool)
        while len(nodes):
            middle = self.points[self.centre[nodes]] @ q.T
            slack = np.outer(self.slack[nodes], size) + 1.0
            reached = reached & (middle - slack <= high) & (middle + slack >= low)
            below, passed = [], []
            for k in np.flatnonzero(reached.any(axis=1)).tolist():
                children = self.children[nodes[k]]
                if children is None:
                    leaves.append(int(nodes[k]))
                    bounds.append(np.where(reached[k], middle[k] + slack[k], -math.inf))
                else:
                    below.append(children)
                    passed.append(np.broadcast_to(reached[k], (len(children), len(q))))
            nodes, reached = (np.concatenate(below), np.concatenate(passed)) if below else (np.array([], dtype=np.int64), reached)
        return leaves, np.array(bounds).reshape(len(leaves), len(q))

    def _together(self, q: np.ndarray, k: int, admits, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores (-inf: none) and rows of the k best of each query, whose scores are exact in doubles."""
        best, held = np.full((len(q), k), -math.inf), np.zeros((len(q), k), dtype=np.int64)
        leaves, bounds = self._leaves(q, low, high)

        def score(leaf: int, wanted: np.ndarray) -> None:
            rows = self.members[leaves[leaf]]  # ascending: argmax takes the smaller row of a tie
            points, step = self.points[rows].T, max(1, CELLS // len(rows))
            for start in range(0, len(wanted), step):
                at = wanted[start : start + step]
                each = np.arange(len(at))
                scores = np.rint(q[at] @ points)
                scores[~(admits(at, rows) & (scores >= low[at, None]) & (scores <= high[at, None]))] = -math.inf
                found, where = [best[at]], [held[at]]
                for _ in range(min(k, len(rows))):
                    top = scores.argmax(axis=1)
                    found.append(scores[each, top][:, None])
                    where.append(rows[top][:, None])
                    scores[each, top] = -math.inf
                found, where = np.hstack(found), np.hstack(where)
                order = np.lexsort((where, -found), axis=1)[:, :k]
                best[at], held[at] = np.take_along_axis(found, order, 1), np.take_along_axis(where, order, 1)
            bounds[leaf, wanted] = -math.inf

        def reaching(reach: np.ndarray, at: np.ndarray) -> np.ndarray:
            return at[(reach > -math.inf) & (reach >= best[at, k - 1])]

        everyone = np.arange(len(q))
        for choice in np.argsort(-bounds, axis=0)[:FIRST]:
            for leaf in np.unique(choice).tolist():
                at = everyone[choice == leaf]
                if len(at := reaching(bounds[leaf, at], at)):
                    score(leaf, at)
        for leaf in np.argsort(-bounds.max(axis=1, initial=-math.inf)).tolist():
            if len(at := reaching(bounds[leaf], everyone)):
                score(leaf, at)
        return best, held


def _matrix(vectors: pd.Series) -> np.ndarray:
    """The vectors as rows of one matrix, shorter ones padded with zeros (which add nothing to a score)."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _searches(shard: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
    """Per anchor of the block: positives found in the shard (pass 1), or negatives per positive (pass 2)."""
    out = []
    if len(shard) and len(anchors):
        shard = shard.sort_values("vec_id", kind="stable")  # rows in vec_id order: ties of a score go to the smaller id
        ids, numbers = shard["vec_id"].to_numpy(), shard["row"].to_numpy()
        labels = shard["label"].to_numpy()
        tree = CoverTree(_matrix(shard["vector"]))
        width = tree.points.shape[1]
        # One query an anchor (positives not yet known), or one an anchor and positive.
        asked, queries, least, most = [], [], [], []
        first = bool(anchors["positives"].isna().all())
        for anchor, anchor_id, label, vector, positives in zip(
                anchors["anchor_row"], anchors["anchor_id"], anchors["anchor_label"], anchors["anchor_vector"],
                anchors["positives"], strict=True):
            query = np.zeros(width)
            given = np.asarray(vector[:width], dtype=np.float64)
            query[: len(given)] = given  # components beyond the shard's width meet zeros
            for positive in [None] if first else positives:
                asked.append((anchor, anchor_id, label, positive))
                queries.append(query)
                score = None if first else int(positive["positive_score"])
                least.append(0 if first else -((-LEAST_PERCENT * score) // 100))
                most.append(math.inf if first else (MOST_PERCENT * score) // 100)
        anchor_ids, anchor_labels = np.array([x[1] for x in asked]), np.array([x[2] for x in asked])

        def admits(columns: np.ndarray, rows: np.ndarray) -> np.ndarray:
            same = labels[rows] == anchor_labels[columns, None]
            return same & (ids[rows] != anchor_ids[columns, None]) if first else ~same

        results = tree.search_all(np.array(queries), POSITIVES if first else NEGATIVES, admits, least, most)
        for (anchor, anchor_id, _, positive), found in zip(asked, results, strict=True):
            if first:
                positive = {"positive_row": None, "positive_id": None, "positive_score": None}
            elif found and int(positive["positive_score"]) > _LARGEST_LONG:
                raise OverflowError(f"the score {positive['positive_score']} of anchor {anchor_id} and a positive with "
                                    "negatives does not fit a long")
            for score, row in found:
                out.append((anchor, anchor_id, positive["positive_row"], positive["positive_id"], positive["positive_score"],
                            numbers[row], ids[row], str(score)))
    return pd.DataFrame(out, columns=["anchor_row", "anchor_id", "positive_row", "positive_id", "positive_score",
                                      "row", "vec_id", "score"])


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k by score (digits of a number from zero: more digits first), then by vec_id."""
    order = Window.partitionBy(*by).orderBy(F.length("score").desc(), F.col("score").desc(), F.col("vec_id"), F.col("row"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(embeddings: DataFrame) -> DataFrame:
    """For each anchor and each of its positives, up to three hard negatives with their ranks and scores."""
    # Numbered as written: rows that share a vec_id stay apart.
    clean = stored(cleaned(embeddings).withColumn("row", F.monotonically_increasing_id()), "negatives-clean")
    shards = max(1, math.ceil(clean.count() / SHARD_ROWS))
    # Own names on the anchors' side: both sides of the cogroup come from one table, and shared names get confused.
    anchors = clean.where(F.col("vec_id") % ANCHOR_EVERY == 0).select(
        F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"),
        F.col("vector").alias("anchor_vector"))
    blocks = max(1, math.ceil(anchors.count() / ANCHOR_BLOCK))
    # Keys are integers on both sides: an int and a long of one value hash apart, and a cogroup does not cast its keys.
    candidates = clean.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
                              F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "row", "vec_id", "label", "vector")

    def asked(table: DataFrame) -> DataFrame:
        return table.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                            F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int").alias("block"), "*")

    def searched(table: DataFrame) -> DataFrame:
        return candidates.groupBy("shard", "block").cogroup(asked(table).groupBy("shard", "block")).applyInPandas(_searches, _FOUND)

    unasked = F.lit(None).cast("array<struct<positive_row:long,positive_id:long,positive_score:string>>")
    positives = stored(_best(searched(anchors.withColumn("positives", unasked)), ["anchor_row"], POSITIVES).select(
        "anchor_row", F.col("row").alias("positive_row"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "negatives-positives")
    listed = positives.groupBy("anchor_row").agg(
        F.collect_list(F.struct("positive_row", "positive_id", "positive_score")).alias("positives"))
    negatives = _best(searched(anchors.join(listed, "anchor_row")), ["anchor_row", "positive_row"], NEGATIVES)
    return negatives.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                            F.col("positive_score").cast("long"), F.col("score").cast("long").alias("negative_score"))


ORACLE = rf"""
WITH clean AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         CAST(list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS DOUBLE[]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM (SELECT * FROM clean WHERE vec_id % {ANCHOR_EVERY} = 0) a JOIN clean c ON c.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM scored WHERE label = anchor_label)
  WHERE k <= {POSITIVES}
), negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS k
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
   AND {LEAST_PERCENT} * p.positive_score <= 100 * s.score AND 100 * s.score <= {MOST_PERCENT} * p.positive_score
)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE k <= {NEGATIVES}
"""
