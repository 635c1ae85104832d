"""The mix against plain resharing, and its promises on what is taken."""

import random
from collections import defaultdict

from bourse.llm import mixing


def targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight; who is above the limit stops there, and the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left, share = total - sum(full.values()), sum(w for s, w in weight.items() if s not in full)
        above = [s for s in names if s not in full and left * weight[s] / share > most * sizes[s]]
        if not above:
            return {s: full.get(s, left * weight[s] / share if share else 0) for s in names}
        full |= {s: most * sizes[s] for s in above}


def table_of(documents, seed, n=3000):
    rng = random.Random(seed)
    rows = [(k, " ".join("w" * rng.choice([1, 1, 1, 5, 40, 300, 2]) for _ in range(1)) and "w " * rng.choice([0, 1, 3, 20, 20, 50, 400]),
             rng.choice(["a", "a", "a", "b", "c", "dd", "é", None, "tiny"] if k % 50 else ["tiny"])) for k in range(n)]
    return rows, documents(rows)


def test_targets_and_taken(documents):
    for seed in (1, 2):
        rows, table = table_of(documents, seed)
        found = mixing.mix(table).collect()
        sizes = defaultdict(int)
        for _, text, source in rows:
            sizes[source] += len(text.split())
        expected = targets(sizes)
        source = {k: s for k, _, s in rows}
        taken, largest = defaultdict(int), defaultdict(int)
        for r in found:
            s = source[r["doc_id"]]
            assert r["source_size"] == sizes[s] and abs(r["target"] - expected[s]) <= 1e-9 * max(1, expected[s])
            assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
            taken[s] += r["taken"]
            largest[s] = max(largest[s], r["size"])
        for s, target in expected.items():
            assert abs(taken[s] - target) <= largest[s] / 2 + 1e-6, s
        assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, mixing.mix(table).collect()), key=repr)


def test_small_and_large_buckets_cut_alike(documents, monkeypatch, rows):
    _, table = table_of(documents, 3)
    once = rows(mixing.mix(table))
    monkeypatch.setattr(mixing, "BUCKET", 7)
    assert rows(mixing.mix(table)) == once
    monkeypatch.setattr(mixing, "BUCKET", 10**9)
    assert rows(mixing.mix(table)) == once


def test_larger_documents_are_likelier(documents):
    rows = [(k, "w " * (10 if k % 2 else 100), "a" if k < 4000 else "b") for k in range(6000)]
    found = {r["doc_id"]: r["taken"] / r["size"] for r in mixing.mix(documents(rows)).collect()}
    small, large = ([found[k] % 1 or found[k] for k in range(4000) if k % 2 == parity] for parity in (1, 0))
    assert sum(large) / len(large) > 2 * sum(small) / len(small)


def test_edge_cases(documents, edge_rows, rows):
    found = mixing.mix(documents(edge_rows)).collect()
    assert len(found) == len(edge_rows)
    assert all(r["taken"] == 0 for r in found if r["size"] == 0)
    assert rows(mixing.mix(documents([]))) == []
    assert rows(mixing.mix(documents([(1, None, None), (2, "", "a")])), "doc_id", "size", "target", "taken") == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_copies_are_written(documents):
    rows_, table = table_of(documents, 4, 600)
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(table).where("taken > 0").collect()}
    mixed = mixing.mixed_documents(table)
    assert mixed.columns == table.columns
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies
