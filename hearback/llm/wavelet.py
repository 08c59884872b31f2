"""Token ids in wavelet matrix files, one matrix per shard.

Texts are encoded with a tokenizer of the tokenizers library, an end id is appended to each,
and the ids of consecutive documents (ascending doc_id) form shards of about ``SHARD`` ids.
A shard is one compressed file, kept as one row (shard, range of documents, payload) of a Parquet table,
so that Spark's commit makes the files complete or absent:

    header   8 bytes mark, then numbers of ids, documents, planes and ids per block (uint64)
    planes   per plane and block of ``BLOCK`` bits: ones before it, offset and length of its data
    bodies   documents' ids and ends, then the blocks' bits, each compressed with zstd

Plane 0 holds every id's highest bit in order; each next plane holds the next bit of the ids
in the order left by moving ids with a 0 before ids with a 1. With the ones counted before
each block, ``token`` (the id at a place), ``count`` (of an id up to a place) and ``find`` (the place of
its n-th occurrence) read one block per plane and step; ``tokens`` reads all in order.

Defined cases: a null text counts as empty and holds the end id alone; documents without
doc_id come last; rows of one doc_id stand in the order of their texts; an empty table gives no
shards. A document longer than a shard has a shard to itself. Other columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .common import Distinct, free_mark, joined_codes, rare_collections, ship, sliced, strings_of, text_array

MARK = b"WAVEMTX1"
SHARD = 2_000_000
BLOCK = 1 << 16
END_ID = 0
SLICE = 4 << 20
KEEP = 1_200_000  # parts a worker remembers


class WaveletMatrix:
    """Reads one shard's file; blocks are unpacked when a query needs them."""

    def __init__(self, payload: bytes):
        if payload[:8] != MARK:
            raise ValueError("not a wavelet matrix file")
        self.size, self.n_docs, self.planes, self.block = struct.unpack_from("<4Q", payload, 8)
        self.payload = payload
        self.blocks = -(-self.size // self.block)
        table = np.frombuffer(payload, "<u8", (self.planes * self.blocks + 1) * 3, 40).reshape(-1, 3)
        self.table = table[:-1].reshape(self.planes, self.blocks, 3)
        self.doc_part = table[-1]
        self._bits = lru_cache(maxsize=64)(self._unpack)
        # per plane the number of zeros: where the ones begin in the next plane
        self.zeros = [self.size - self._rank(p, self.size) for p in range(self.planes)]

    def _part(self, offset: int, length: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.payload[int(offset) : int(offset) + int(length)])

    def _unpack(self, plane: int, block: int) -> np.ndarray:
        _, offset, length = self.table[plane, block]
        bits = np.unpackbits(np.frombuffer(self._part(offset, length), np.uint8), bitorder="little")
        return bits[: min(self.block, self.size - block * self.block)]

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids (null: least long) and where each document's ids end."""
        data = np.frombuffer(self._part(self.doc_part[1], self.doc_part[2]), "<i8").reshape(2, -1)
        return data[0], data[1]

    def _rank(self, plane: int, place: int) -> int:
        """Ones of a plane before a place."""
        block, rest = divmod(place, self.block)
        if block == self.blocks:
            block, rest = self.blocks - 1, self.size - (self.blocks - 1) * self.block
        if self.size == 0:
            return 0
        return int(self.table[plane, block, 0]) + int(self._bits(plane, block)[:rest].sum(dtype=np.int64))

    def _select(self, plane: int, bit: int, n: int) -> int:
        """Place of the n-th (from 0) zero or one of a plane."""
        ones = self.table[plane, :, 0].astype(np.int64)
        before = ones if bit else np.arange(self.blocks, dtype=np.int64) * self.block - ones
        block = int(np.searchsorted(before, n, side="right")) - 1
        return block * self.block + int(np.flatnonzero(self._bits(plane, block) == bit)[n - int(before[block])])

    def token(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.size:
            raise IndexError(place)
        value = 0
        for plane in range(self.planes):
            block, rest = divmod(place, self.block)
            bit = int(self._bits(plane, block)[rest])
            ones = self._rank(plane, place)
            place = self.zeros[plane] + ones if bit else place - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, upto: int) -> tuple[int, int]:
        low, high = 0, upto
        for plane in range(self.planes):
            a, b = self._rank(plane, low), self._rank(plane, high)
            if value >> (self.planes - 1 - plane) & 1:
                low, high = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, value: int, upto: int | None = None) -> int:
        """Occurrences of an id before a place (all of them by default)."""
        if value >> self.planes:
            return 0
        low, high = self._range(value, self.size if upto is None else upto)
        return high - low

    def find(self, value: int, n: int) -> int:
        """Place of the n-th (from 0) occurrence of an id; -1 if there are fewer."""
        if value >> self.planes or n < 0:
            return -1
        low, high = self._range(value, self.size)
        if n >= high - low:
            return -1
        place = low + n
        for plane in reversed(range(self.planes)):
            bit = value >> (self.planes - 1 - plane) & 1
            place = self._select(plane, bit, place - self.zeros[plane] if bit else place)
        return place

    def tokens(self) -> np.ndarray:
        """All ids in order: from the last plane to the first, zeros and ones go back to their places."""
        values = np.zeros(self.size, dtype=np.uint16 if self.planes <= 16 else np.uint32)
        for plane in reversed(range(self.planes)):
            parts = [self._unpack(plane, b) for b in range(self.blocks)]
            bits = np.concatenate(parts).view(bool) if parts else np.zeros(0, dtype=bool)
            line = np.empty_like(values)
            line[~bits] = values[: self.zeros[plane]]
            line[bits] = values[self.zeros[plane] :] | values.dtype.type(1 << (self.planes - 1 - plane))
            values = line
        return values


def build(ids: np.ndarray, doc_ids: np.ndarray, ends: np.ndarray, planes: int, block: int = BLOCK) -> bytes:
    """File of one shard: ids in order, documents' ids and where each one's ids end."""
    if planes < 1 or len(ids) and int(ids.max()) >> planes:
        raise ValueError("an id does not fit the planes")
    squeeze = zstandard.ZstdCompressor(level=1).compress
    n, blocks = len(ids), -(-len(ids) // block)
    table = np.zeros((planes * blocks + 1, 3), dtype="<u8")
    at, bodies = 40 + table.nbytes, []

    def put(row: int, ones: int, data: bytes) -> None:
        nonlocal at
        table[row] = ones, at, len(data)
        bodies.append(data)
        at += len(data)

    line = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    for plane in range(planes):
        bits = (line & line.dtype.type(1 << (planes - 1 - plane))).astype(bool)
        packed = np.packbits(bits, bitorder="little")
        ones = 0
        for b in range(blocks):
            put(plane * blocks + b, ones, squeeze(packed[b * block // 8 : (b + 1) * block // 8].tobytes()))
            ones += int(np.count_nonzero(bits[b * block : (b + 1) * block]))
        line = np.concatenate([line[~bits], line[bits]])
    put(planes * blocks, 0, squeeze(np.stack([doc_ids, ends]).astype("<i8").tobytes()))
    return b"".join([MARK, struct.pack("<4Q", n, len(doc_ids), planes, block), table.tobytes(), *bodies])


class ByteEncoder:
    """Ids of whole texts by the tokenizers library; each distinct stretch is encoded once.

    Texts are cut before single blanks, where byte-level BPE's own split ends a stretch as
    well; texts with a blank between other white space, or at their end after one, are not cut.
    Distinct stretches are cut once more behind each run of letters and digits, where the split also
    ends a stretch, since words come with many signs behind them.
    """

    LOOSE = r"[\s\p{Z}\x0b\x1c-\x1f\x85] [\s\p{Z}\x0b\x1c-\x1f\x85]|[\s\p{Z}\x0b\x1c-\x1f\x85] $"

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.special = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.parts = Distinct(self._encode, KEEP)

    def _encode(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _special(self, texts: pa.Array) -> pa.Array:
        """Whether a text holds the string of a special token, across which nothing is cut."""
        found = pa.array(np.zeros(len(texts), dtype=bool))
        for special in self.special:
            found = pc.or_(found, pc.match_substring(texts, special))
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        mark = free_mark(texts)
        whole = pc.or_(pc.match_substring_regex(texts, self.LOOSE), self._special(texts))
        lists = pc.split_pattern(pc.if_else(whole, texts, pc.replace_substring(texts, " ", f"{mark} ")), mark)
        stretches = lists.flatten().dictionary_encode()
        distinct = stretches.dictionary
        cut = pc.replace_substring_regex(distinct, r"([\pL\pN])([^\pL\pN])", rf"\1{mark}\2")
        parts = pc.split_pattern(pc.if_else(self._special(distinct), distinct, cut), mark)
        coded = parts.flatten().dictionary_encode()
        ids = pa.array(self.parts(strings_of(coded.dictionary)), pa.large_binary())
        data, ends = joined_codes(ids, coded.indices)
        ends = ends[parts.offsets.to_numpy()].astype(np.int64)
        ids = pa.Array.from_buffers(pa.large_binary(), len(distinct), [None, pa.py_buffer(ends), data])
        data, ends = joined_codes(ids, stretches.indices)
        starts = ends[lists.offsets.to_numpy()] // 4
        return np.frombuffer(data, dtype="<i4", count=int(ends[-1]) // 4), starts


_loaded: dict[int, ByteEncoder] = {}


def _encoder(tokenizer: str) -> ByteEncoder:
    """One for each worker process: the stretches it remembers serve its later tasks."""
    key = hash(tokenizer)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ByteEncoder(tokenizer)
    return _loaded[key]


LOWEST = -(1 << 63)


def shards(docs: DataFrame, tokenizer: str, planes: int, end_id: int = END_ID, size: int = SHARD) -> DataFrame:
    """(part, no, n_tokens, n_docs, payload): files of consecutive documents; (part, no) is their order."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    place = F.coalesce("doc_id", F.lit((1 << 63) - 1))  # the sample for the ranges reads no texts
    docs = docs.repartitionByRange(place).sortWithinPartitions(place, F.col("doc_id").isNull(), F.md5("text"))
    docs = docs.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)
    names = ["part", "no", "n_tokens", "n_docs", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare_collections()
        encode = _encoder(sent.value)
        held: list[tuple[int, np.ndarray]] = []
        part, no, weight = 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, no, weight
            lengths = np.array([len(ids) for _, ids in held], dtype=np.int64)
            payload = build(
                np.concatenate([ids for _, ids in held]), np.array([d for d, _ in held], dtype=np.int64),
                np.cumsum(lengths), planes,
            )
            row = [[part], [no], [int(lengths.sum())], [len(held)], [payload]]
            held, no, weight = [], no + 1, 0
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in sliced(batches, "text", SLICE):
            part = batch.column("part")[0].as_py()
            ids, starts = encode(text_array(batch.column("text")))
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[starts[i] : starts[i + 1]], end_id).astype(np.uint16 if planes <= 16 else np.uint32)
                if held and weight + len(own) > size:
                    yield close()
                held.append((LOWEST if doc_id is None else doc_id, own))
                weight += len(own)
        if held:
            yield close()

    ship(docs.sparkSession)
    return docs.mapInArrow(run, "part int, no bigint, n_tokens bigint, n_docs bigint, payload binary")


def write(docs: DataFrame, path: str, tokenizer: str, planes: int, end_id: int = END_ID, size: int = SHARD) -> None:
    """Write the shards of ``docs`` (doc_id, text) to a table of files at ``path``."""
    made = shards(docs, tokenizer, planes, end_id, size)
    made.write.mode("overwrite").option("compression", "uncompressed").option("parquet.block.size", str(8 << 20)).parquet(path)


def read_documents(files: DataFrame) -> DataFrame:
    """Per document of shard files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    sizes = files.select("part", "no", "n_tokens")
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the writer
    totals = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("part").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", "no", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("own"))
    starts = sizes.join(totals, "part").select("part", "no", (F.col("own") + F.col("first")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "no", "doc_id", "at", "n_tokens", "ids_crc32"]
        for batch in batches:
            for part, no, payload in zip(batch.column("part"), batch.column("no"), batch.column("payload")):
                matrix = WaveletMatrix(payload.as_py())
                data = matrix.tokens().astype("<u4").tobytes()
                doc_ids, ends = matrix.documents()
                at = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                sums = [zlib.crc32(data[a * 4 : b * 4]) for a, b in zip(at.tolist(), ends.tolist())]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * n, pa.int32()), pa.array([no.as_py()] * n, pa.int64()),
                        pa.array(doc_ids, pa.int64(), mask=doc_ids == LOWEST), pa.array(at), pa.array(ends - at), pa.array(sums, pa.int64()),
                    ], names,
                )

    ship(files.sparkSession)
    docs = files.select("part", "no", "payload").mapInArrow(
        run, "part int, no bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    docs = docs.join(starts, ["part", "no"])
    return docs.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def store(docs: DataFrame, work: Workspace, tokenizer: str, planes: int, end_id: int = END_ID) -> DataFrame:
    """Write the shards of ``docs`` to the work folder and open them."""
    write(docs, work.path("wavelet"), tokenizer, planes, end_id)
    return work.spark.read.parquet(work.path("wavelet"))
