import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from hearback.llm import wavelet
from hearback.llm.common import workspace

TOKENIZER = open(public_tokenizers.path("byte_bpe_50k.json")).read()


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1024, 5000, 70_001])
def test_matrix_against_the_array(n):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.3, n) % 50_257
    matrix = wavelet.WaveletMatrix(wavelet.build(ids, np.array([3]), np.array([n]), 16, 1024))
    assert (matrix.tokens() == ids).all() and matrix.size == n
    for place in rng.integers(0, n, 40) if n else []:
        assert matrix.token(int(place)) == ids[place]
    for value in (0, 1, 2, 7, 50_000, 70_000):
        places = np.flatnonzero(ids == value)
        assert matrix.count(value) == len(places)
        assert matrix.count(value, n // 3) == (ids[: n // 3] == value).sum()
        for k in (0, len(places) // 2, len(places) - 1, len(places)):
            assert matrix.find(value, k) == (places[k] if 0 <= k < len(places) else -1)
    with pytest.raises(IndexError):
        matrix.token(n)


def test_a_bad_file_or_id_is_refused():
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix(b"something else entirely, of some length")
    with pytest.raises(ValueError):
        wavelet.build(np.array([70_000]), np.array([1]), np.array([1]), 16)


def test_ids_equal_the_library():
    texts = ["a  b", "  x", "x ", "x  ", "a \n b", "a\n  b", "it's we'll  don't", "<|endoftext|> a", "", "😀 😀", "a\t b \t c",
             "x \x1c y", "a　 　b", " \u0085 x", "1 22 333 !! ?", "né à la Straße\r\n \r\n"]
    texts += [a + b + c for a in (" ", "\n", "x") for b in (" ", "\t", "y ") for c in (" ", "z", " ")]
    ids, starts = wavelet.ByteEncoder(TOKENIZER)(pa.array(texts, pa.large_string()))
    want = Tokenizer.from_str(TOKENIZER).encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [e.ids for e in want]


def test_files_round_trip(spark, rough, nothing):
    work = workspace(spark)
    wavelet.write(rough, work.path("small"), TOKENIZER, 16, size=50)
    files = spark.read.parquet(work.path("small"))
    assert files.count() > 2
    rows = wavelet.read_documents(files).collect()
    tokenizer = Tokenizer.from_str(TOKENIZER)
    lines = sorted(rough.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    at, want = 0, []
    for r in lines:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want.append((str(r["doc_id"]), at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((str(r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert wavelet.read_documents(wavelet.store(nothing, workspace(spark), TOKENIZER, 16)).collect() == []
