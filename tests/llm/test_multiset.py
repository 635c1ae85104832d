"""Fingerprints: order, insertion, deletion, the edited text and likeness."""

import hashlib

import numpy as np

from bourse.llm import multiset


def test_sums_have_no_order():
    a, b = multiset.vectors([b"one line here\nand another one\n\nthird", b"third\nand another one\none line here"])[0]
    assert (a == b).all()
    texts = multiset.as_text(multiset.vectors([b"x y\nz", b"z\nx y", b"z\nz\nx y", b"z\nx  y"]))
    assert texts[0] == texts[1] and len({*texts}) == 3


def test_insert_and_delete():
    whole, part, rest = ((v[0][k : k + 1], v[1][k : k + 1]) for v in [multiset.vectors([b"a b c d\ne\nf g h", b"e\na b c d", b"f g h"])] for k in range(3))
    for x, y in zip(multiset.add(part, rest), whole, strict=True):
        assert (x == y).all()
    for x, y in zip(multiset.add(whole, rest, -1), part, strict=True):
        assert (x == y).all()


def test_likeness_follows_shared_runs():
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in rng.integers(0, 10**6, 2000)]
    text = " ".join(words).encode()
    for share in (0.25, 0.5, 0.75):
        kept = int(2000 * share)
        other = " ".join(words[:kept] + [f"v{k}" for k in rng.integers(0, 10**6, 2000 - kept)]).encode()
        v = multiset.vectors([text, other])
        found = multiset.likeness((v[0][:1], v[1][:1]), (v[0][1:], v[1][1:]))[0]
        assert abs(found - share / (2 - share)) < 0.2


def test_documents(documents, edge_rows):
    table = documents(edge_rows)
    found = multiset.fingerprints(table).collect()
    order = sorted(((-1 << 63 if i is None else i, t or "") for i, t, _ in edge_rows), key=lambda r: (r[0], r[1].encode()))
    expected = []
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        prints = multiset.as_text(multiset.vectors([text.encode(), new.encode()]))
        expected.append((None if i == -1 << 63 else i, len(text), hashlib.sha256(new.encode()).hexdigest(), *prints))
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(expected, key=repr)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    assert all(r["near_edited"] == 1 for r in found if r["fingerprint"] == r["edited_fingerprint"])
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[6]["near_next"] == 1.0  # an exact copy follows


def test_one_and_no_document(documents, rows):
    (only,) = multiset.fingerprints(documents([(5, "abcdef", "s")])).collect()
    assert only["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and only["near_next"] == 1.0
    assert rows(multiset.fingerprints(documents([]))) == []
