"""Repetition measures against plain counting."""

from collections import Counter

from bourse.llm import quality


def brute(text, words):
    w = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    share = {}
    for n in quality.NGRAM_LIMITS:
        seen, mark = set(), set()
        for i in range(len(w) - n + 1):
            gram = tuple(w[i : i + n])
            mark |= set(range(i, i + n)) if gram in seen else set()
            seen.add(gram)
        share[n] = sum(len(w[i]) for i in mark) / max(1, sum(map(len, w)))
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w)}, share


def test_measures(documents, edge_rows, words):
    found = sorted(quality.judge(documents(edge_rows)).collect(), key=lambda r: (repr(r["doc_id"]), r["n_words"]))
    table = sorted(edge_rows, key=lambda r: (repr(r[0]), len(words(r[1]))))
    assert len(found) == len(table)
    for row, (_, text, _) in zip(found, table, strict=True):
        counts, share = brute(text, words)
        assert {k: row[k] for k in counts} == counts
        for n, value in share.items():
            assert abs(row[f"repeat_share_{n}"] - value) < 1e-12
        clean = not counts["base_failed"] and row["dup_line_share"] <= quality.LINE_LIMIT and counts["n_symbols"] <= quality.SYMBOL_LIMIT * counts["n_words"]
        assert row["kept"] == (clean and all(share[n] <= limit for n, limit in quality.NGRAM_LIMITS.items()))


def test_repeated_passages_go_and_prose_stays(documents, rows):
    prose = " ".join(f"word{k}" for k in range(200))
    repeated = prose + "\n" + "\n".join(f"{k} this passage of a page comes again and again all over" for k in range(40))
    table = documents([(1, prose, "a"), (2, repeated, "a"), (3, prose + "\n" + prose[:80], "a"), (4, "# " * 200 + prose, "a")])
    assert rows(quality.judge(table), "doc_id", "kept") == [(1, True), (2, False), (3, True), (4, False)]
    assert rows(quality.kept_documents(table), "doc_id") == [(1,), (3,)]
    assert quality.kept_documents(table).columns == table.columns


def test_empty_table(documents, rows):
    assert rows(quality.judge(documents([]))) == []
