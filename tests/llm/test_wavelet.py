"""Token files: round trips, and rank, select and counts against the plain sequence."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bourse.llm import wavelet

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("size,planes", [(0, 4), (1, 1), (7, 3), (511, 5), (512, 5), (513, 5), (5000, 16), (4000, 18)])
def test_matrix(size, planes):
    rng = np.random.default_rng(size)
    tokens = np.minimum(rng.geometric(0.05, size) * rng.integers(1, 50, size), (1 << planes) - 1).astype(np.uint32)
    built = wavelet.WaveletMatrix.build(tokens, planes)
    opened = wavelet.WaveletMatrix.from_bytes(memoryview(built.to_bytes()), size, planes)
    assert (opened.decode() == tokens).all()
    for at in rng.integers(0, size, min(size, 60)):
        assert opened.access(int(at)) == tokens[at]
    for token in {*tokens[:30].tolist(), 0, (1 << planes) - 1}:
        where = np.flatnonzero(tokens == token)
        assert opened.count(token) == len(where)
        low, high = sorted(rng.integers(0, size + 1, 2).tolist())
        assert opened.count(token, low, high) == int((tokens[low:high] == token).sum())
        for k in {0, len(where) // 2, len(where) - 1}:
            assert opened.find(token, k) == (where[k] if 0 <= k < len(where) else None)
    assert opened.count(1 << planes) == 0


def test_documents(documents, edge_rows, spark, tmp_path):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    order = sorted(((-1 << 63 if i is None else i, (t or "").encode()) for i, t, _ in edge_rows))
    expected, start = [], 0
    for i, text in order:
        ids = [*tokenizer.encode(text.decode(), add_special_tokens=False).ids, wavelet.END_ID]
        expected.append((None if i == -1 << 63 else i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = wavelet.encoded_documents(documents(edge_rows), VOCABULARY).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    folder = str(tmp_path / "shards")
    wavelet.write_shards(documents(edge_rows), folder, VOCABULARY, shard_tokens=500)
    shards = wavelet.read_shards(spark, folder)
    assert shards.count() > 5 and shards.groupBy("block", "shard").count().where("count > 1").count() == 0
    assert sorted(map(tuple, wavelet.documents_of(shards).collect()), key=repr) == sorted(expected, key=repr)


def test_files_hold_one_shard_each(documents, edge_rows, spark, tmp_path):
    folder = str(tmp_path / "shards")
    wavelet.write_shards(documents(edge_rows), folder, VOCABULARY, shard_tokens=500)
    files = list((tmp_path / "shards").glob("*.parquet"))
    assert len(files) == wavelet.read_shards(spark, folder).count()


def test_empty_table(documents, rows):
    assert rows(wavelet.encoded_documents(documents([]), VOCABULARY)) == []
