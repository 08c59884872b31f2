"""SentencePiece encoding and decoding by a Viterbi search with shared prefixes.

Texts are marked as the model does it (white space becomes ``MARK``) and cut where no
piece can cross: before a mark that follows a word, and around characters of no piece.
Each slice's distinct words are sorted, which makes neighbours share prefixes: going through
them is a depth-first walk of their trie. The forward table holds, for each place of the
current word, the best piece that ends there; of the next word only the places behind the
common prefix are computed.

* Unigram models: best score, the sum of the pieces' scores (shorter last piece on ties).
* BPE models: a chain of pieces is what the merges give exactly if each two neighbours
  are stable, that is, merging their characters gives these two pieces again. So a path may
  only be extended by a piece that is stable next to the path's last piece; one path is left
  for each place, and the ids equal those of the library.

Words that begin with several marks (runs of blanks, whose pieces have one common score in
BPE models) are given to the library. Characters of no piece become their UTF-8 bytes'
pieces, or the unknown piece in models without them.

Decoding joins the pieces' bytes, turns marks into blanks and drops the first blank; bytes
that are no UTF-8 become U+FFFD.

Defined cases: null and empty texts have no ids and decode to an empty text; a mark
character in a text is read as a blank, as in the library; rows come out as they came in,
repeated ones too. Columns of the input named like an output column are replaced by it.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .common import Distinct, free_mark, kept, map_arrow, text_array, unit_ids

MARK = "▁"
KEEP = 120_000  # words a task remembers, beside those of a slice
JOINTS = 300_000  # remembered pairs of a worker
SLICE = 2 << 20


class Pieces:
    """One model's pieces, the forward search over sorted words, and decoding."""

    def __init__(self, model: bytes, kind: str = "bpe"):
        if kind not in ("bpe", "unigram"):
            raise ValueError(f"unknown kind of model: {kind}")
        self.kind, self.library = kind, sentencepiece.SentencePieceProcessor(model_proto=model)
        lib = self.library
        self.score = [lib.get_score(i) for i in range(lib.get_piece_size())]
        self.text = [lib.id_to_piece(i) for i in range(len(self.score))]
        plain = [
            i for i in range(len(self.score))
            if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))
        ]
        self.id = {self.text[i]: i for i in plain}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.has_bytes = lib.is_byte(self.bytes[0])
        # every ending of a piece, with its id if it is a piece itself
        self.ending = {t[k:]: -1 for t in self.id for k in range(len(t))}
        self.ending.update(self.id)
        self.joint: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.out = [
            bytes([self.bytes.index(i)]) if lib.is_byte(i) else self.text[i].replace(MARK, " ").encode() if i in set_plain else b""
            for set_plain in [set(plain)]
            for i in range(len(self.score))
        ]

    # -- stable neighbours of BPE models

    def merged(self, text: str) -> list[str]:
        """Merge the best adjacent pair (highest score, then leftmost) until none is a piece."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k, (a, b) in enumerate(pairwise(parts)):
                i = self.id.get(a + b)
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stable(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.joint.get(key)
        if known is None:
            if len(self.joint) >= JOINTS:
                self.joint.clear()
            pair = [self.text[left], self.text[right]]
            known = self.joint[key] = self.merged(pair[0] + pair[1]) == pair
        return known

    def alone(self, piece: int) -> bool:
        known = self.whole.get(piece)
        if known is None:
            known = self.whole[piece] = self.merged(self.text[piece]) == [self.text[piece]]
        return known

    # -- forward search

    def _next_bpe(self, word: str, i: int, last: list[int]) -> tuple[int, int]:
        """The piece that ends at place ``i`` of the word's only stable path, and where it begins."""
        ending, found, j = self.ending, [], i - 1
        while j >= 0:
            piece = ending.get(word[j:i])
            if piece is None:
                break
            if piece >= 0:
                found.append((piece, j))
            j -= 1
        for piece, j in reversed(found):
            left = last[j]
            if self.stable(left, piece) if left >= 0 else self.alone(piece):
                return piece, j
        return -1, i - 1

    def _next_unigram(self, word: str, i: int, score: list[float]) -> tuple[int, int, float]:
        """The piece that ends at place ``i`` of the best path, where it begins, and the path's score."""
        best, j = (-1, i - 1, score[i - 1] + min(self.score) - 10.0), i - 1
        while j >= 0:
            piece = self.ending.get(word[j:i])
            if piece is None:
                break
            if piece >= 0 and score[j] + self.score[piece] > best[2]:
                best = (piece, j, score[j] + self.score[piece])
            j -= 1
        return best

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each marked word, as 32-bit integers. Words may be in any order."""
        found: dict[str, bytes] = {}
        last, begin, score, path = [-1], [0], [0.0], ""
        unigram = self.kind == "unigram"
        for word in sorted(set(words)):
            if word.startswith(MARK + MARK):
                ids = self.library.encode(word[1:].replace(MARK, " "))
                found[word] = array("i", ids).tobytes()
                continue
            same, limit = 0, min(len(word), len(path))
            while same < limit and word[same] == path[same]:
                same += 1
            del last[same + 1 :], begin[same + 1 :], score[same + 1 :]
            for i in range(same + 1, len(word) + 1):
                if unigram:
                    piece, j, s = self._next_unigram(word, i, score)
                    score.append(s)
                else:
                    piece, j = self._next_bpe(word, i, last)
                last.append(piece)
                begin.append(j)
            path = word
            ids, i = [], len(word)
            while i:
                piece, j = last[i], begin[i]
                if piece >= 0:
                    ids.append(piece)
                elif self.has_bytes:
                    ids.extend(self.bytes[b] for b in reversed(word[j:i].encode()))
                else:
                    ids.append(self.library.unk_id())
                i = j
            found[word] = array("i", reversed(ids)).tobytes()
        return [found[w] for w in words]

    # -- texts

    def cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Marked words of all texts, and where each text's begin."""
        marked = pa.array(self.library.normalize(texts), pa.large_string())
        mark = free_mark(marked)
        marked = pc.replace_substring_regex(marked, f"([^{MARK}]){MARK}", rf"\1{mark}{MARK}")
        alone = "".join(c for c in "\n\t\r" if c not in self.ending)
        if alone:
            marked = pc.replace_substring_regex(marked, f"([{alone}])", rf"{mark}\1{mark}")
        lists = pc.split_pattern(marked, mark)
        return lists.flatten(), lists.offsets.to_numpy().astype(np.int64)

    def encode(self, texts: pa.Array, words: Distinct) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        units, starts = self.cut(texts.to_pylist())
        return unit_ids(units, starts, words)

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """Texts of ids; the marked blank before a text's first word is dropped."""
        size = np.fromiter(map(len, self.out), dtype=np.int64, count=len(self.out))
        ends = np.concatenate([[0], np.cumsum(size[ids])])
        flat = pa.array(self.out, pa.large_binary()).take(pa.array(ids))
        data = flat.buffers()[2]
        data = data.to_pybytes() if data is not None else b""
        cuts = ends[starts].tolist()
        return [data[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in pairwise(cuts)]


def _added(df: DataFrame, *fields: StructField) -> tuple[DataFrame, StructType]:
    df = df.drop(*(f.name for f in fields))
    return df, StructType([*df.schema.fields, *fields])


def encode(df: DataFrame, model: bytes, kind: str = "bpe", check: bool = False) -> DataFrame:
    """Add ``ids`` and ``n_tokens`` of the column ``text``; with ``check`` also ``round_trip``: whether
    the ids decode to the text."""
    fields = [StructField("ids", ArrayType(IntegerType(), False)), StructField("n_tokens", LongType())]
    df, schema = _added(df, *fields, *([StructField("round_trip", BooleanType())] if check else []))
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        pieces = _pieces(sent.value, kind)
        words = Distinct(pieces.encode_words, KEEP)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = text_array(batch.column("text"))
            ids, starts = pieces.encode(texts, words)
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))
            added = [lists, pa.array(np.diff(starts))]
            if check:
                added.append(pc.equal(pa.array(pieces.decode(ids, starts), pa.large_string()), texts))
            return pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

        return work

    return map_arrow(df, make, schema, limit=SLICE, keeps=True)


def decode(df: DataFrame, model: bytes, kind: str = "bpe") -> DataFrame:
    """Add ``text`` of the column ``ids`` (null: empty)."""
    df, schema = _added(df, StructField("text", StringType()))
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(sent.value, kind)
        for batch in batches:
            lists = batch.column("ids")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            texts = pieces.decode(ids, starts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return df.mapInArrow(run, schema)


def _pieces(model: bytes, kind: str) -> Pieces:
    """One copy for each worker process: the stable pairs it has found serve its later tasks."""
    return kept(("pieces", hash(model), kind), lambda: Pieces(model, kind))
