"""What the operators share: the work folder, Arrow slices of bounded size, text units."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import Workspace

# A fixed value: white space that separates words in every operator here.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"

# Long texts: so many bytes to a batch, where the session has not set its own number.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20

_shipped: set[str] = set()
_kept: dict = {}
_libc = ctypes.CDLL(None)


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, as --py-files would, once per application, and bound
    the bytes of Arrow batches, which are held on both sides."""
    context = spark.sparkContext
    if spark.conf.get(BATCH) == "67108864b":
        spark.conf.set(BATCH, BATCH_BYTES)
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="hearback-")) / "hearback.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in package.rglob("*.py"):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def workspace(spark: SparkSession) -> Workspace:
    """Work folder in spark.checkpoint.dir; a folder of this machine only where that is unset
    and the session runs on this machine alone, as in tests."""
    ship(spark)
    alone = spark.sparkContext.master.startswith("local")
    unset = spark.conf.get("spark.checkpoint.dir", None) is None
    return Workspace(spark, tempfile.mkdtemp(prefix="hearback-work-") if alone and unset else None)


def free_prefix(df: DataFrame, prefix: str) -> str:
    """The prefix, with marks before it until no column's name begins with it."""
    while any(name.lower().startswith(prefix) for name in df.columns):
        prefix = f"_{prefix}"
    return prefix


def text_array(column: pa.Array) -> pa.Array:
    """Texts with nulls as empty texts, with 64-bit offsets."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of ``column``; a longer text comes alone.
    What a piece's work has left unused in Arrow's memory pool goes back to the system."""
    pool = pa.default_memory_pool()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                pool.release_unused()
                start, held = i, 0
            held += int(size)
        yield batch.slice(start)
        pool.release_unused()


def kept(key, make: Callable):
    """What a worker process keeps from task to task: one thing. Asking for another frees the one
    before it, so that a stage's memories do not lie beside those of the next stage."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Free what this worker keeps and give unused memory back to the system."""
    if _kept:
        _kept.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def rare_collections() -> None:
    """Collect garbage seldom: a worker's many remembered strings would be gone through each time."""
    gc.set_threshold(200_000, 50, 100)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema, column: str = "text", limit: int = 4 << 20, keeps: bool = False) -> DataFrame:
    """Apply ``make()(slice)`` to bounded slices; ``make`` runs once per task. Where it ``keeps`` nothing, what the worker has is freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare_collections()
        if not keeps:
            forget()
        work = make()
        for piece in sliced(batches, column, limit):
            made = work(piece)
            if made is not None and made.num_rows:
                yield made

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def strings_of(texts: pa.Array) -> list[str]:
    """Python strings, by way of an object array, which takes a fraction of ``to_pylist``."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in one array, and where each text begins (one more at the end)."""
    values = texts.to_pylist()
    flat = np.frombuffer("".join(values).encode("utf-32-le"), dtype=np.uint32)
    starts = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, values), dtype=np.int64, count=len(values)), out=starts[1:])
    return flat, starts


def free_mark(texts: pa.Array) -> str:
    """A character that none of the texts holds."""
    for code in (0xFFFF, 0xFFFE, *range(0x10FFFF, 0x10FF00, -1)):
        if not pc.any(pc.match_substring(texts, chr(code))).as_py():
            return chr(code)
    raise ValueError("every mark occurs in the texts")


def gather_runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def sum_runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of values[starts[i]:starts[i + 1]] for every i, empty runs included."""
    total = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


class Distinct:
    """Codes for each distinct string, found once and remembered for a while.

    ``encode(list of new strings)`` returns each one's codes as the bytes of 32-bit integers.
    Two generations of at most ``keep`` / 2 strings (and one call's) are held: a full one
    replaces the one before it, and strings that are asked for again move to the new one.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], keep: int = 300_000):
        self.encode, self.keep, self.young, self.old = encode, keep, {}, {}

    def __call__(self, strings: list[str]) -> list[bytes]:
        """Codes of each of the strings, which must differ from one another."""
        if len(self.young) > self.keep // 2:
            self.old, self.young = self.young, {}
        young = self.young
        found = list(map(young.get, strings))
        missing = [i for i, f in enumerate(found) if f is None]
        if missing:
            asked = [strings[i] for i in missing]
            seen = list(map(self.old.get, asked))
            new = [s for s, f in zip(asked, seen) if f is None]
            made = iter(self.encode(new))
            for i, s, f in zip(missing, asked, seen):
                young[s] = found[i] = next(made) if f is None else f
        return found


def unit_ids(units: pa.Array, starts: np.ndarray, codes: Distinct) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts one after the other and where each text's codes begin.

    ``units`` are the texts' parts, ``starts`` where each text's parts begin. Each
    distinct part is encoded once; the rest is array work.
    """
    coded = units.dictionary_encode()
    data, ends = joined_codes(pa.array(codes(strings_of(coded.dictionary)), pa.large_binary()), coded.indices)
    return np.frombuffer(data, dtype="<i4", count=int(ends[-1]) // 4), ends[starts] // 4


def joined_codes(codes: pa.Array, which: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """Bytes of the codes that ``which`` numbers, one after the other, and where each begins."""
    taken = codes.take(which)
    data = taken.buffers()[2]
    return data if data is not None else pa.py_buffer(b""), np.frombuffer(taken.buffers()[1], dtype=np.int64, count=len(taken) + 1)
