import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def documents(spark):
    """A table like ``documents`` with extra columns named as the operators' own ones."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, node long, size long, part int, rank string, blob string, bucket int, block int, key long"
        filled = [(i, t, "en", s, len(t) if t is not None else None, 7, 7, 7, "x", "x", 7, 7, 7) for i, t, s in rows]
        return spark.createDataFrame(filled, schema)

    return make


@pytest.fixture
def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows, near and exact copies, other scripts."""
    rng = random.Random(5)
    words = ["the", "of", "Haus", "été", "señal", "漢字", "data", "run", "set", "row", "x1", "Idiot", "and"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(120)
    rows = [(None, "no id " + prose(60), "a"), (1, None, "a"), (2, "", None), (3, " \n\t ", "b"), (4, "one", "b"), (4, "one", "b"),
            (5, prose(4000), "c"), (6, base, "a"), (7, base, "a"), (8, base.replace("data", "info", 1), "a"), (9, base.upper(), None),
            (10, "A\n" + base + "\nB", "b"), (11, "a b c d", "b"), (12, "a  b c\nd", "c"), (13, "password = hunter2hunter2x", "c"),
            (14, "line of words here\n" * 12, "c"), (15, "token: 0123456789abcdef0123456789abcdef01", "a"), (15, prose(80), "a")]
    rows += [(100 + k, prose(rng.randint(1, 200)), rng.choice("abcde")) for k in range(40)]
    return rows


@pytest.fixture
def words():
    return lambda text: WORD.findall(text or "")
