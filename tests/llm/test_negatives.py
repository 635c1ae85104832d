"""Hard negatives against scores of all pairs, and the cover tree against plain sorting."""

import math
import random

import duckdb
import numpy as np
import pytest

from bourse.llm import negatives


def brute(rows):
    clean = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        clean[(vec_id, label, tuple(math.floor(256 * float(x)) for x in vector))] = None
    table = list(clean)
    out = []
    for a_id, a_label, a in table:
        if a_id % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), vec_id, label) for vec_id, label, v in table if vec_id != a_id]
        for p_score, p_id, _ in sorted(s for s in scored if s[2] == a_label)[:5]:
            p = -p_score
            hits = sorted(s for s in scored if s[2] != a_label and 50 * p <= -100 * s[0] <= 95 * p)[:3]
            out += [(a_id, p_id, k + 1, n_id, p, -n_score) for k, (n_score, n_id, _) in enumerate(hits)]
    return sorted(out)


def table_rows(n=700, width=8, seed=12):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(4)]
    rows = [(k, [c + rng.gauss(0, 0.05) for c in centres[k % 4]], rng.randrange(3)) for k in range(n)]
    rows += [(700, [0.1] * width, 1), (750, [0.1] * width, 1), (800, [0.1] * width, 2), (850, [0.1] * width, 1)]  # ties
    rows += [(900, None, 1), (950, [0.2] * (width - 1) + [None], 1), (1000, [float("nan")] * width, 1), (1050, [0.3] * width, None)]
    rows += [(1100, [float("inf")] + [0.0] * (width - 1), 0), (None, [0.1] * width, 1), (1150, [0.0] * width, 0), (1150, [0.0] * width, 0)]
    rows += [(1200, [-0.4] * width, 2), (1250, [0.4] * width, 2), rows[50], rows[100]]
    return rows


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, anchor_id string, rank string, vector string, shard int, block int"
    return spark.createDataFrame([(*r, "x", "x", "x", 1, 1) for r in rows], schema)


def test_against_all_pairs(spark, rows):
    data = table_rows()
    found = rows(negatives.mine(frame(spark, data)), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in data]
    assert sorted(tuple(r) for r in found) == brute(floats)
    assert found


def test_sql(spark, tmp_path):
    data = [r for r in table_rows(300) if r[1] is not None and r[0] is not None]
    frame(spark, data).select("vec_id", "embedding", "label").write.parquet(str(tmp_path / "e"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path / 'e'}/*.parquet'")
    expected = sorted(db.execute(negatives.ORACLE).fetchall())
    got = sorted(tuple(r) for r in negatives.mine(spark.read.parquet(str(tmp_path / "e"))).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == expected and got


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tree_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    points = np.floor(256 * rng.normal(0, 0.3, (900, 16)))
    points[100:300] = points[100]  # one very common vector
    tree = negatives.CoverTree(points)
    allowed = rng.random(900) < 0.6
    for _ in range(20):
        q = np.floor(256 * rng.normal(0, 0.3, 16))
        scores = points @ q
        least, most = sorted(rng.choice(scores, 2))
        want = sorted((-s, r) for r, s in enumerate(scores) if allowed[r] and least <= s <= most)[:3]
        assert tree.search(q, 3, allowed, least, most) == [(int(-s), r) for s, r in want]
        top = sorted((-s, r) for r, s in enumerate(scores) if allowed[r])[:5]
        assert tree.search(q, 5, allowed) == [(int(-s), r) for s, r in top]


def test_queries_together_are_exact(monkeypatch):
    for name, value in (("LEAF", 16), ("TOGETHER", 7), ("CELLS", 100)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(4)
    points = np.floor(6 * rng.normal(0, 0.3, (900, 5)))  # many ties
    points[100:300] = points[100]
    queries = np.floor(6 * rng.normal(0, 0.3, (40, 5)))
    queries[5], queries[6] = 0, 2.0**50  # the last one's scores are not exact in doubles
    labels = rng.integers(0, 3, 900)
    least = [int(x) for x in rng.integers(-20, 10, 40)]
    most = [x + int(y) for x, y in zip(least, rng.integers(-1, 40, 40), strict=True)]
    least[6], most[6] = 2**48, math.inf
    found = negatives.CoverTree(points).search_all(queries, 3, lambda at, rows: labels[rows] == (at % 3)[:, None], least, most)
    for j, q in enumerate(queries):
        scores = [sum(int(x) * int(y) for x, y in zip(q, p, strict=True)) for p in points]
        want = sorted((-s, r) for r, s in enumerate(scores) if labels[r] == j % 3 and least[j] <= s <= most[j])[:3]
        assert found[j] == [(-s, r) for s, r in want]


def test_empty(spark):
    assert negatives.mine(frame(spark, [])).count() == 0


def mined(spark, rows, data):
    return sorted(tuple(r) for r in rows(
        negatives.mine(frame(spark, data)), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


@pytest.mark.parametrize("shard_rows, anchor_block", [(250, 2_000), (20_000, 5), (60, 5)])
def test_shards_and_blocks_all_meet(spark, rows, shard_rows, anchor_block, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", anchor_block)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # no coalescing: keys that hash apart stay apart
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        data = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label)
                for i, v, label in table_rows()]
        assert mined(spark, rows, data) == brute(data)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def large_rows(scale, n=200, width=8, seed=7):
    rng = random.Random(seed)
    return [(k, [float(np.float32(rng.gauss(0, 1) * scale(rng))) for _ in range(width)], rng.randrange(3)) for k in range(n)]


@pytest.mark.parametrize("scale", [lambda rng: 2e6, lambda rng: 10 ** rng.choice([-3, 0, 3, 6])])
def test_scores_beyond_exact_doubles(spark, rows, scale, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD_ROWS", 70)
    data = large_rows(scale)
    expected = brute(data)
    assert max(r[4] for r in expected) > 2**53
    assert mined(spark, rows, data) == expected


def test_huge_components_in_rows_that_are_not_returned(spark, rows):
    data = large_rows(lambda rng: 0.3)
    data[17] = (17, [1e30] * 4 + [-1e30] * 4, 901)
    data[33] = (33, [3e38, -2e25] + [0.0] * 6, 901)
    data[34] = (34, [0.0] * 8, 2**31 - 1)
    data[35] = (35, [0.1] * 8, 2**31 - 1)  # relabelled
    data += [(200, [0.0] * 7 + [1e30], 900), (250, [0.0] * 7 + [3e30], 900)]
    data = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in data]
    expected = brute(data)
    assert expected and max(r[4] for r in expected) < 2**63
    assert mined(spark, rows, data) == expected


def test_a_returned_score_that_does_not_fit_fails(spark):
    data = [(200, [1e30], 900), (201, [3e30], 900), (204, [2e30], 901)]
    with pytest.raises(Exception, match="does not fit a long"):
        negatives.mine(frame(spark, data)).collect()


def test_rows_that_share_an_id_are_anchors_and_positives_of_their_own(spark, rows):
    data = [(k // 2 * 10, v, label) for k, v, label in large_rows(lambda rng: 0.3, 120)]
    table = [(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)) for i, v, label in data]
    expected = []
    for a_id, a_label, a in (r for r in table if r[0] % 50 == 0):
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, label) for i, label, v in table)
        for p, p_id, _ in [s for s in scored if s[2] == a_label and s[1] != a_id][:5]:
            hits = [s for s in scored if s[2] != a_label and -50 * p <= -100 * s[0] <= -95 * p][:3]
            expected += [(a_id, p_id, k + 1, n_id, -p, -n) for k, (n, n_id, _) in enumerate(hits)]
    assert mined(spark, rows, data) == sorted(expected)
