"""Different long texts whose polynomial hashes modulo 2**64 agree (complementary Thue-Morse texts) stay different."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bourse.llm import jaccard, pieces, tokens
from bourse.llm.text import Batch


def thue_morse(n: int, letters: str = "ab") -> str:
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join(letters[b] for b in bits[:n])


PAIRS = [(thue_morse(n), thue_morse(n, "ba")) for n in (1024, 4096)]


@pytest.mark.parametrize("pair", PAIRS)
def test_span_hashes_differ(pair):
    batch = Batch([t.encode() for t in pair] + [pair[0].encode()])
    h = batch.span_hash(batch.bounds[:-1], batch.bounds[1:] - 1)
    assert h[0] != h[1] and h[0] == h[2]
    short = Batch([b"same words here", b"xx same words here"])
    assert len(set(short.span_hash(np.array([1, 20]), np.array([16, 35])).tolist())) == 1


def test_token_ids_of_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [t for pair in PAIRS for t in pair] + [f"x {t} y" for pair in PAIRS for t in pair]
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [r.tolist() for r in tokens.encoder(path).encode(texts)] == expected


def test_pieces_round_trip():
    vocab = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [t.encode() for pair in PAIRS for t in pair]
    for text, (ids, _) in zip(texts, pieces.encode(texts, vocab, 1), strict=True):
        assert pieces.decode(ids.tolist(), vocab) == text


def test_two_components(documents, rows):
    table = [(k, text, "s") for k, text in enumerate(t for pair in PAIRS for t in pair)] + [(9, PAIRS[0][0], "s")]
    found = {r[0]: r[1] for r in rows(jaccard.join_components(documents(table)), "doc_id", "component_id")}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 9: 0}
    firsts = {r[0] for r in jaccard.first_of_components(documents(table)).select("doc_id").collect()}
    assert firsts == {0, 1, 2, 3}
