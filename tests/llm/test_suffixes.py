"""Removed bytes against all 50-byte strings."""

import glob
import hashlib
import itertools
import os
import random

import numpy as np
import pytest

from bourse.llm import sharing, suffixes, tables
from bourse.llm.text import Batch


def brute(rows, match=50):
    first = {}
    for i, text, _ in rows:
        rank, raw = -1 << 63 if i is None else i, (text or "").encode()
        for s in range(len(raw) - match + 1):
            w = raw[s : s + match]
            first[w] = min(rank, first.get(w, rank))
    out = []
    for i, text, _ in rows:
        rank, raw = -1 << 63 if i is None else i, (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - match + 1):
            if first[raw[s : s + match]] < rank:
                gone[s : s + match] = True
        spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_edge_cases(documents, edge_rows, rows):
    assert rows(suffixes.deduplicated(documents(edge_rows))) == brute(edge_rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_passages(documents, rows, seed, monkeypatch):
    rng = random.Random(seed)
    if seed > 1:
        monkeypatch.setattr(suffixes, "FLUSH_RUNS", 300)
    alphabet = ["ab", "the ", "é", "x", "\n", "data ", "q", "zz", " "] if seed < 3 else ["a", "b"]
    prose = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passages = [prose(rng.randint(20, 120)) for _ in range(8)]
    table = []
    for k in range(120):
        parts = [prose(rng.randint(0, 60)) if rng.random() < 0.5 else rng.choice(passages)[rng.randint(0, 10):] for _ in range(rng.randint(0, 6))]
        table.append((rng.randint(0, 150), "".join(parts), "s"))
    table += [(200 + k, passages[0] * 3 + prose(5), "s") for k in range(10)]
    assert rows(suffixes.deduplicated(documents(table))) == brute(table)


def test_equal_windows_elect_one_gram():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdef ") for _ in range(400)).encode()
    batch = Batch([b"?" * 7 + text[100:300], text, text[100:300] + b"!!"])
    owner, grams, place, first, last = suffixes.runs_of(batch)
    covered = [set() for _ in range(3)]
    for o, p, a, b in zip(owner, place, first, last, strict=True):
        assert a <= p and p + suffixes.GRAM <= a + suffixes.MATCH and b <= p <= b + suffixes.WINDOW - 1
        covered[o] |= set(range(a - batch.bounds[o], b - batch.bounds[o] + 1))
    assert covered == [set(range(len(t) - 49)) for t in (b"?" * 7 + text[100:300], text, text[100:300] + b"!!")]
    elected = lambda k, shift: {(w - batch.bounds[k] - shift): p - w for o, p, a, b in zip(owner, place, first, last, strict=True) if o == k for w in range(a, b + 1)}
    a, b, c = elected(0, 7), elected(1, 100), elected(2, 0)
    assert all(a[w] == b[w] == c[w] for w in range(151))


def test_multikey_order():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 3, (500, 5)).astype(np.uint64)
    order, group = suffixes.multikey_order(keys)
    rows = [tuple(r) for r in keys[order].tolist()]
    assert rows == sorted(rows)
    assert all((group[i] == group[i + 1]) == (rows[i] == rows[i + 1]) for i in range(499))


def test_no_match_crosses_a_bucket_boundary():
    grams = np.array([b"aaa", b"ccc", b"ccd"], f"S{suffixes.GRAM}")
    keys = np.array([b"aaa", b"aaaz", b"ccc", b"ccczz", b"ccd", b"zzz"], f"S{suffixes.GRAM}")
    buckets = np.searchsorted(grams, keys, "right")
    assert all(keys[i] != keys[j] for i in range(6) for j in range(i) if buckets[i] != buckets[j]) and list(buckets) == sorted(buckets)


def test_empty_table(documents, rows):
    assert rows(suffixes.deduplicated(documents([]))) == []


def test_a_hot_gram_is_dealt_by_whole_windows(documents, rows, monkeypatch):
    """A phrase shorter than a match with other text around it in every document: no bucket gets all its runs."""
    rng = random.Random(6)
    other = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    phrase, passage = "(c) all rights reserved by the owner of it", other(30)
    table = [(k, other(60) + phrase + other(60), "s") for k in range(300)]
    table += [(300 + k, other(20) + passage + phrase + other(3) + "x" * (k % 2) + other(30), "s") for k in range(30)]
    loads = []
    pack = suffixes._packed
    docs = documents(table).selectExpr("doc_id rank", "text")
    batch = Batch([t.encode() for _, t, _ in table])
    owner, grams, place, first, last = suffixes.runs_of(batch)
    hot = suffixes._hot_grams(docs.select("text"))
    assert len(hot) and np.isin(hot, grams).all()
    out = suffixes._Scatter(np.sort(np.array([b"b", b"f", b"m"], f"S{suffixes.GRAM}")), hot)
    monkeypatch.setattr(suffixes, "_packed", lambda kind, d, part, text=b"": loads.append((kind, len(part))) or pack(kind, d, part, text))
    some = np.isin(grams, hot)
    out.put([i for i, _, _ in table], suffixes.nodes_of(batch), batch, owner[some], grams[some], place[some], first[some], last[some])
    list(out.flush())
    assert [kind for kind, _ in loads] == [b"w"] * 4 and max(n for _, n in loads) < 0.3 * sum(n for _, n in loads)
    monkeypatch.undo()
    found = rows(suffixes.deduplicated(documents(table)))
    assert found == brute(table) and sum(r[2] for r in found) > 1000


def test_texts_are_never_shuffled(documents, rows, edge_rows, monkeypatch):
    """No exchange of any stored step carries the texts, nor does any row of the sample's order."""
    carried = []

    def names(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()
        if plan.nodeName() in ("Exchange", "TakeOrderedAndProject"):
            output = plan.child().output()
            carried.append({output.apply(i).name() for i in range(output.size())})
        for i in range(plan.children().size()):
            names(plan.children().apply(i))

    store = suffixes.stored

    def stored(df, *args, **options):
        names(df._jdf.queryExecution().executedPlan())
        return store(df, *args, **options)

    monkeypatch.setattr(suffixes, "stored", stored)
    found = suffixes.deduplicated(documents(edge_rows))
    names(found._jdf.queryExecution().executedPlan())
    assert rows(found) == brute(edge_rows)
    assert carried and not any("text" in columns for columns in carried)


@pytest.mark.parametrize("parts", [4, 64])
def test_disk_does_not_grow_with_the_partitions(spark, documents, rows, monkeypatch, parts):
    """Shuffle files of all steps together, even if none is freed meanwhile."""
    monkeypatch.setattr(suffixes, "SAMPLE_DOCUMENTS", 50)
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz "
    prose = lambda n: "".join(rng.choices(letters, k=n))
    passages = [prose(200) for _ in range(400)]
    table = [(k, prose(1600) + rng.choice(passages) + prose(100), "s") for k in range(1200)]
    folders = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    sizes = lambda: {f: os.path.getsize(f) for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before, was = sizes(), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = rows(suffixes.deduplicated(documents(table)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    written = sum(n for f, n in sizes().items() if f not in before)
    assert sum(r[2] for r in found) > 150_000
    assert written < 0.8 * sum(len(t) for _, t, _ in table)


def test_units_of_few_documents(spark, documents, rows, monkeypatch):
    """Copies, repeated rows and equal ids that meet across many units; rows of a unit come in order of their places."""
    monkeypatch.setattr(suffixes, "UNIT_BYTES", 1500)
    monkeypatch.setattr("bourse.llm.text.chunks.__defaults__", (400,))
    rng = random.Random(9)
    prose = lambda n: "".join(rng.choice(["ab", "the ", "é", "data ", "q", "漢", " "]) for _ in range(n))
    passages = [prose(60) for _ in range(5)]
    texts = [prose(rng.randint(0, 60)) + rng.choice(passages) + prose(rng.randint(0, 30)) for _ in range(60)]
    table = [(rng.randint(0, 40), rng.choice(texts), "s") for _ in range(150)] + [(None, texts[0], "s"), (50, None, "s"), (51, "", "s")]
    table += table[:25] + [table[3]] * 6
    assert rows(suffixes.deduplicated(documents(table).repartition(7))) == brute(table)


def test_the_table_of_units_goes(spark, documents, edge_rows):
    suffixes.deduplicated(documents(edge_rows)).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("suffix")]


def test_keys_fall_into_their_bucket(spark):
    values = np.array([0, 1, -1, 42, 1 << 40, -(1 << 63), (1 << 63) - 1])
    ours = spark.createDataFrame([(int(v),) for v in values], "v long").selectExpr("hash(v)").collect()
    assert tables.long_hashes(values).tolist() == [r[0] for r in ours]
    for task, buckets in ((0, 1), (5, 4), (70, 51)):
        keys = list(itertools.islice(tables.keys_of_bucket(task, buckets), 40))
        assert len(set(keys)) == 40 and all(k >> 32 == task for k in keys)
        assert (tables.long_hashes(np.array(keys)) % buckets == task % buckets).all()


def test_flags_of_shared_elements(spark):
    rng = random.Random(10)
    sets = {(unit, part): sorted(rng.sample(range(1 << 32), 30) + rng.sample(range(100), 20)) for unit in range(4) for part in range(3)}
    sets[(9, 0)] = [0, 1 << 31, (1 << 32) - 1]
    asked = [(part, unit, bytearray(sharing.packed_ascending(np.array(s, np.uint32)))) for (unit, part), s in sets.items()]
    for r in sharing.shared_flags(spark.createDataFrame(asked, "part int, unit long, blob binary")).collect():
        own = sets[r.unit, r.part]
        others = set().union(*(s for (unit, part), s in sets.items() if part == r.part and unit != r.unit))
        flags = np.unpackbits(np.frombuffer(bytes(r.flags), np.uint8), count=len(own)).astype(bool).tolist()
        assert flags == [v in others for v in own]
