"""Piece lattices against all paths and against the library's round trip."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from bourse.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return pieces.vocabulary(PATH)


def all_paths(segment, vocab):
    """Scores of every path, best first, by trying everything."""
    ends = pieces.edges_of(segment, vocab)

    def back(at):
        if at == 0:
            return [(0.0, [])]
        return [(s + score, [*p, i]) for start, i, score in ends[at] for s, p in back(start)]

    return sorted(back(len(segment)), key=lambda r: -r[0])


SEGMENTS = ["▁the", "▁Häuser", "▁x漢y", "▁▁▁a", "\n", "▁aaaaaaaa", "▁tion", "▁naïve", "🙂", "▁ét"]


def test_search_finds_the_best_paths(vocab):
    for segment in SEGMENTS:
        raw = segment.encode()
        every = all_paths(raw, vocab)
        found = pieces.n_best(raw, 5, vocab)
        assert [round(s, 6) for s, _ in found] == [round(s, 6) for s, _ in every[: len(found)]]
        assert len({tuple(p) for _, p in found}) == len(found) == min(5, len(every))
        assert all(b"".join(vocab.text[i] for i in p) == raw for _, p in found)


def test_batch_agrees_with_search(vocab):
    rng = random.Random(2)
    segments = {("▁" + "".join(rng.choice("etaoinshr漢é") for _ in range(rng.randint(1, 30)))).encode() for _ in range(300)}
    segments = [*segments, *(s.encode() for s in SEGMENTS), ("▁" + "ab" * 200).encode()]
    best, loss, paths = pieces.solve(segments, vocab)
    for k, segment in enumerate(segments):
        two = pieces.n_best(segment, 2, vocab)
        assert math.isclose(best[k], two[0][0], rel_tol=1e-5)
        assert math.isclose(sum(vocab.score[paths[k]]), best[k], rel_tol=1e-4)
        assert b"".join(vocab.text[i] for i in paths[k].tolist()) == segment
        if len(two) > 1:
            assert abs(loss[k] - (two[0][0] - two[1][0])) < 1e-2
        else:
            assert loss[k] > 1e20


def test_merge():
    assert [round(c, 6) for c, _ in pieces.merge([[0, 1, 5], [0, 2], [0, 0.5]], 6)] == [0, 0.5, 1, 1.5, 2, 2.5]
    assert pieces.merge([], 3) == [(0.0, ())]


def test_text_paths(vocab):
    """The n best of a text are the n best combinations over all of its segments."""
    text = "a tion the\nHaus of data"
    (_, found), = pieces.encode([text.encode()], vocab, 5)
    whole = ("▁" + text.replace(" ", "▁")).encode()
    assert np.allclose([s for s, _ in found], [s for s, _ in pieces.n_best(whole, 5, vocab)], atol=1e-3)


def test_documents(documents, edge_rows, vocab):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    extra = [(900, "  two  spaces\tand\r\ntabs ", "a"), (901, "▁marked", "a"), (902, "x" * 3000, "a"), (903, "\n\n", "a")]
    table = edge_rows + extra
    found = pieces.encoded_documents(documents(table), PATH, with_ids=True).collect()
    assert len(found) == len(table)
    texts = {(i, t or "") for i, t, _ in table}
    for row in found:
        text = library.decode(list(row["ids"]))
        marked = row["doc_id"] == 901
        assert (row["doc_id"], "▁marked" if marked else text) in texts
        assert row["round_trip"] == (not marked) and row["n_pieces"] == len(row["ids"])
        assert list(row["scores"]) == sorted(row["scores"], reverse=True)
        assert math.isclose(row["scores"][0], sum(float(vocab.score[i]) for i in row["ids"]), rel_tol=1e-4, abs_tol=1e-3)


def test_empty_table(documents, rows):
    assert rows(pieces.encoded_documents(documents([]), PATH)) == []


@pytest.mark.parametrize("char", ["x", "=", "-", "漢"])
def test_a_long_run_of_one_character_is_searched_in_bounds(vocab, char, monkeypatch):
    raw = (char * 3001).encode()
    pushed = []
    push = pieces.heapq.heappush

    def counted(queue, entry):
        pushed.append(len(queue))
        assert len(pushed) <= bound, "the queue grows beyond n times the pieces"
        push(queue, entry)

    bound = 3 * sum(map(len, pieces.edges_of(raw, vocab)))
    monkeypatch.setattr(pieces.heapq, "heappush", counted)
    found = pieces.n_best(raw, 3, vocab)
    best = [[0.0]]  # the three best scores up to every position
    for ends in pieces.edges_of(raw, vocab)[1:]:
        best.append(sorted((s + score for start, _, score in ends for s in best[start]), reverse=True)[:3])
    assert np.allclose([s for s, _ in found], best[-1]) and len({tuple(p) for _, p in found}) == len(found)
    assert all(b"".join(vocab.text[i] for i in p) == raw for _, p in found)
