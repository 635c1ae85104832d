"""The shingle join against sets of all pairs."""

import math
import random

from bourse.llm import jaccard

def groups_of(rows, words, n=5, percent=75):
    """Sets of all rows, and the rows of each component."""
    sets = {}
    for k, (doc_id, text, _) in enumerate(rows):
        w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(k)
    return sets, list(groups.values())


def brute(rows, words, n=5, percent=75):
    sets, groups = groups_of(rows, words, n, percent)
    out = []
    for members in groups:
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        out += [(rows[k][0], len(sets[k]), min(ids, default=None)) for k in members]
    return sorted(out, key=repr)


def test_components_of_edge_cases(documents, edge_rows, words, rows):
    assert rows(jaccard.join_components(documents(edge_rows)), "doc_id", "n_shingles", "component_id") == brute(edge_rows, words)


def test_components_of_chains_and_short_texts(documents, words, rows):
    rng = random.Random(3)
    table, at = [], 0
    for length in (5, 6, 8, 9, 12, 16, 20, 40, 90):
        text = [f"w{rng.randint(0, 40)}" for _ in range(length)]
        for _ in range(14):  # each an edit of the one before: chains whose ends are far apart
            table.append((at, " ".join(text), "s"))
            at += 1
            text = list(text)
            text[rng.randrange(len(text))] = f"w{rng.randint(0, 40)}"
            if rng.random() < 0.4:
                text.append(f"w{rng.randint(0, 40)}")
    table += [(at + k, "the same line of words for all of them today\n" + " ".join(f"v{rng.randint(0, 99)}" for _ in range(rng.randint(1, 9))), "s") for k in range(60)]
    assert rows(jaccard.join_components(documents(table)), "doc_id", "n_shingles", "component_id") == brute(table, words)


def test_empty_table(documents, rows):
    assert rows(jaccard.join_components(documents([]))) == []


def test_one_document_of_each_group_stays(documents, edge_rows, words):
    line = "a line of many words that no other row has " * 3
    table = edge_rows + [(None, line, "a"), (None, line, "b"), (None, line + "end", "c"), (None, "another text without an id " * 4, "a")]
    sets, groups = groups_of(table, words)
    kept = [(r["doc_id"], r["text"]) for r in jaccard.first_of_components(documents(table)).collect()]
    assert len(kept) == len(groups)
    for members in groups:
        first = min((table[k][0] is None, table[k][0] or 0) for k in members)
        assert sum((i, t) in [table[k][:2] for k in members] and (i is None, i or 0) == first for i, t in set(kept)) >= 1


def test_subsets_are_chosen_by_cost():
    assert jaccard.boundary_by_cost({}, 75) == 0
    few = jaccard.boundary_by_cost({8: 10**6, 9: 10**6}, 75)
    assert 0 <= few <= jaccard.LARGEST_SMALL
    assert jaccard.boundary_by_cost({4: 1000}, 75) >= 4  # few subsets, long lists
    assert jaccard.boundary_by_cost({16: 1000}, 75) == 0  # C(16, 12) subsets a set


def test_needed_overlap():
    for n in range(1, 30):
        for m in range(1, 30):
            need = jaccard.overlap_needed(n, m, 75)
            holds = [o for o in range(min(n, m) + 1) if 100 * o >= 75 * (n + m - o)]
            assert need == min(holds, default=need) and (holds or need > min(n, m))
    assert math.comb(8, 6) == 28
