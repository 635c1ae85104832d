"""Deobfuscation, and held-out accuracy of the score."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest

from bourse.llm import toxicity
from bourse.llm.text import Batch

BAD = ["idiot", "stupid", "moron", "trash"]


def prose(rng, n):
    return " ".join(rng.choice(["the", "window", "stone", "river", "tomato", "is", "of", "traffic", "market", "studio", "audio", "more"]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    texts = [prose(rng, 40) + " " + rng.choice(BAD) for _ in range(300)]
    return toxicity.letter_model(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_letter_model_is_a_distribution(model):
    table = np.exp(model).reshape(toxicity.CLASSES, toxicity.CLASSES, toxicity.CLASSES)
    assert np.allclose(table.sum(2), 1)


@pytest.mark.parametrize("hidden,word", [("1d10t", "idiot"), ("id!ot", "idiot"), ("stup1d", "stupid"), ("m0r0n", "moron"), ("tra$h", "trash"),
                                         ("idiiiiot", "idiot"), ("i d i o t", "idiot"), ("i-d-i-o-t", "idiot"), ("m.o.r.o.n", "moron"), ("7rash", "trash")])
def test_hidden_words_are_restored(model, hidden, word):
    restored = toxicity.Restorer(model).restore([f"You {hidden} there".encode(), b"", b"plain\nlines\n"])
    assert restored == [f"you {word} there".encode(), b"", b"plain\nlines\n"]


def test_decoding_is_the_best_reading(model):
    for stretch in ("1d10t", "m00rn", "t4k3", "aaab|1"):
        best = None
        for choice in itertools.product(*toxicity.lattice(stretch)):
            word, score = "".join(c[0] for c in choice), sum(c[1] for c in choice)
            codes = [toxicity.EDGE, toxicity.EDGE, *(ord(c) - 97 for c in word), toxicity.EDGE]
            score += sum(model[(a * toxicity.CLASSES + b) * toxicity.CLASSES + c] for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))
            best = max(best or (-math.inf, ""), (score, word))
        assert toxicity.decode(stretch, model) == best[1]


def test_trigram_counts_cover_all_characters():
    data = Batch([b"abc\nABC", b"", b"x"]).data
    assert toxicity.trigram_counts(data).sum() == len(data) - 2


def labelled(spark, n=1500, hide=False):
    rng = random.Random(7)
    docs, labels = [], []
    for k in range(n):
        toxic = rng.random() < 0.2
        words = prose(rng, rng.randint(10, 60)).split()
        for _ in range(3 if toxic else 0):
            word = rng.choice(BAD)
            word = word.translate(str.maketrans("io", "10")) if hide and rng.random() < 0.5 else word
            words.insert(rng.randrange(len(words)), word)
        docs.append((k, " ".join(words), "x", "y", 1))
        if k % 2:
            labels.append((k, int(toxic), "z"))
    return (spark.createDataFrame(docs, "doc_id long, text string, slice string, counts string, bucket int"),
            spark.createDataFrame(labels, "doc_id long, toxic int, text string"), {k: t for k, t, _ in labels})


@pytest.mark.parametrize("hide", [False, True])
def test_held_out_accuracy(spark, hide):
    docs, labels, truth = labelled(spark, hide=hide)
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(found) == 1500
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held = [(truth[i], r) for i, r in found.items() if r["held_out"] and i in truth]
    assert sum(t == r["predicted"] for t, r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())


def test_edge_cases(documents, edge_rows, spark, rows):
    table = documents(edge_rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.toxicity(table, none).collect()} == {0}
    some = spark.createDataFrame([(None, 1), (5, None), (6, 1), (6, 1), (7, 0)], "doc_id long, toxic int")
    found = toxicity.toxicity(table, some).collect()
    assert len(found) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in found)
    assert not any(r["held_out"] for r in found if r["doc_id"] is None)
    assert rows(toxicity.toxicity(documents([]), some)) == []


@pytest.fixture(scope="module")
def wide_model(spark):
    rng = random.Random(2)
    words = [*BAD, "fool", "pussy", "dude", "loser", "shit", "kill", "ass", "hello", "glass", "class", "pool", "food", "door", "kiss", "hill", "asshole", "stop", "tool"]
    texts = [" ".join(rng.choice(words) for _ in range(60)) + " " + prose(rng, 20) for _ in range(300)]
    return toxicity.letter_model(spark.createDataFrame([(t,) for t in texts], "text string"))


@pytest.mark.parametrize("hidden,word", [
    ("f00l", "fool"), ("l00ser", "loser"), ("pu55y", "pussy"), ("a55hole", "asshole"), ("ki11", "kill"), ("shi7", "shit"), ("a$$", "ass"),
    ("$tupid", "stupid"), ("|diot", "idiot"), ("stop!", "stop"), ("(hello", "hello"), ("(1d10t)", "idiot")])
def test_look_alikes_anywhere_in_a_word(wide_model, hidden, word):
    assert toxicity.Restorer(wide_model).restore([f"you {hidden} there".encode()]) == [f"you {word} there".encode()]


@pytest.mark.parametrize("hidden,left", [
    ("i d 1 0 t", "idiot"), ("s t u p 1 d", "stupid"), ("s t u p i d, man", "stupid, man"), ("f o o l!", "fool!"), ("f   o   o   l", "fool"),
    ("a s s", "ass"), ("f-0.0-l man", "fool man"), ("1 2 3 4", "1 2 3 4"), ("the f o o l man", "the fool man")])
def test_spelled_words_with_look_alikes(wide_model, hidden, left):
    found, = toxicity.Restorer(wide_model).restore([hidden.encode()])
    assert found.rstrip(b"!") == left.encode().rstrip(b"!")


def test_long_words_are_decoded(wide_model):
    word = "1d10t" * 30
    assert b"1" not in toxicity.Restorer(wide_model).restore([word.encode()])[0]
