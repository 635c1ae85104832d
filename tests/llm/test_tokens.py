"""Ids of cut texts against ids of whole texts."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bourse.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


CASES = ["", " ", "\n", "a", " a", "a ", "a\n", "\na", "a\nb", "a \nb", "a\n b", "a\n\nb", "a  b", "a   b", " \n ", "\t", "a\tb c", "a\r\nb",
         "it's we'll 's 't", "x 's", "12 34\n56", "!? ...\n---", "é à\nü", "a b c", "a b", "　a b", "a   b", "<|endoftext|> x",
         "漢字 仮名\n交じり", "🙂 🙂\n🙂", "a\x1cb c\x85d", "a\x0bb \x0c c", "end. \n", "  lead", "trail  ", "a\n \nb", "end.,x é. ×, it's. 3.5% a-b a'b c'.d <x>|y", "é'l ç!? À.b ÷.c"]


def test_cases(plain):
    encoder = tokens.Encoder(PATH)
    assert encoder.feed is not None
    for _ in range(2):  # the second time from memory
        assert [r.tolist() for r in encoder.encode(CASES)] == plain(CASES)


def test_random_texts(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 300)
    monkeypatch.setattr(tokens, "REMEMBERED", 60)
    rng = random.Random(1)
    parts = [" ", " ", " ", "\n", "\t", "the", "Haus", "é", "'s", "12", "...", " ", "漢", "a", "\r\n", "un-", "🙂", "_", "#", ",", ".", "!!", "ç", "×", "÷", "'", "$", "Z"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    assert [r.tolist() for r in tokens.Encoder(PATH).encode(texts)] == plain(texts)


def test_no_text():
    encoder = tokens.Encoder(PATH)
    assert encoder.encode([]) == [] and encoder.encode(["", ""])[1].dtype == np.uint32


def test_index():
    rng = np.random.default_rng(1)
    index = tokens._Index(500)
    keys = np.unique(rng.integers(1, 1 << 63, 500).astype(np.uint64) >> np.uint64(rng.integers(0, 3)))
    keys[:50] = np.arange(1, 51)  # all in one place
    index.add(keys[:200])
    index.add(keys[200:])
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(np.arange(1000, 1100, dtype=np.uint64)) == -1).all()


def test_added_tokens_have_their_own_id_as_in_the_library():
    library = Tokenizer.from_file(PATH)
    texts = [*CASES, "<|endoftext|>", "a<|endoftext|>b c", "end <|endoftext|>\n<|endoftext|> x", "<|endoftext", "<| endoftext |>"]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    encoder = tokens.encoder(PATH)
    for _ in range(2):
        assert [r.tolist() for r in encoder.encode(texts)] == expected
    assert expected[len(CASES)] == [library.token_to_id("<|endoftext|>")]
