import itertools
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from hearback.llm import pieces
from hearback.llm.common import Distinct

MODEL = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
TEXTS = [
    "", " ", "a  b", "  lead", "trail  ", "a\nb\n\n c\t d\r\n", "▁ mark", "émoji 😀 日本語テキスト", "x\x00y", "<s> </s> <0x41>",
    "a" * 500, "no break here " * 300, "    def f(x):\n        return x", "1234567890 ... !!!", "Straße ﬁ Å",
]


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(MODEL)


def test_ids_equal_the_library(model):
    rng = random.Random(1)
    letters = "abcdefthing  \n.,é日"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(300)]
    ids, starts = model.encode(pa.array(texts, pa.large_string()), Distinct(model.encode_words))
    want = sentencepiece.SentencePieceProcessor(model_proto=MODEL).encode(texts)
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(starts)] == want
    assert [t.replace("▁", " ") for t in texts] == model.decode(ids, starts)


class Scores(pieces.Pieces):
    """A unigram model made by hand."""

    def __init__(self, scores):
        self.kind = "unigram"
        self.text, self.score = list(scores), list(scores.values())
        self.id = {t: i for i, t in enumerate(self.text)}
        self.ending = {t[k:]: -1 for t in self.id for k in range(len(t))}
        self.ending.update(self.id)
        self.has_bytes = False
        self.library = type("Library", (), {"unk_id": staticmethod(lambda: -1)})


def test_unigram_against_all_segmentations():
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(n)) for n in (1, 2, 3, 4) for _ in range(6)} | {"a", "b"}
    model = Scores({w: -rng.random() * 5 for w in sorted(words)})
    cases = ["".join(c) for n in range(1, 9) for c in itertools.islice(itertools.product("ab", repeat=n), 40)]
    for word, got in zip(cases, model.encode_words(cases)):
        ids = np.frombuffer(got, "<i4").tolist()
        best = max(
            sum(model.score[model.id[p]] for p in parts)
            for parts in (pieces_of(word, mask) for mask in range(1 << (len(word) - 1)))
            if all(p in model.id for p in parts)
        )
        assert "".join(model.text[i] for i in ids) == word
        assert abs(sum(model.score[i] for i in ids) - best) < 1e-9


def pieces_of(word, mask):
    cuts = [0, *(i + 1 for i in range(len(word) - 1) if mask >> i & 1), len(word)]
    return [word[a:b] for a, b in itertools.pairwise(cuts)]


def test_rough_rows(rough, nothing):
    rows = pieces.encode(rough, MODEL, check=True).collect()
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    assert len(rows) == rough.count()
    assert all(r["ids"] == library.encode(r["text"] or "") and r["n_tokens"] == len(r["ids"]) and r["round_trip"] for r in rows)
    back = pieces.decode(pieces.encode(rough, MODEL).drop("text"), MODEL).collect()
    assert sorted(r["text"] for r in back) == sorted(r["text"] or "" for r in rough.collect())
    assert pieces.encode(nothing, MODEL).collect() == []
    null = rough.sparkSession.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(null, MODEL).first()["text"] == ""
