"""Scans of raw exports: quoted CSV with any header, and plain-text reports.

Each file is read by one task and streamed out in Arrow batches; which task reads
which file is Spark's choice. Spark's CSV reader is not used here because it drops
blank lines, which count as records of these exports, needs one width for all
files, and does not see files whose names begin with an underscore.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import listing
from .listing import filesystem

# The reading functions travel to the tasks by value: executors need no installed package.
for _module in (listing, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

# Header rows per family; all others have one.
HEADER_ROWS = {"sprig": 2}

RAW_SCHEMA = "period string, source string, source_file string, file_no long, header_key long, row_number long, cells array<string>"
TEXT_SCHEMA = "period string, source_file string, text string, readable boolean"
PLAIN_TEXT = (".md", ".txt")
BATCH_CHARS = 4_000_000
TASK_BYTES = 128 * 1024 * 1024


def _open_text(root: str, source_file: str) -> io.TextIOWrapper:
    files, base = filesystem(root)
    stream = files.open_input_stream(f"{base.rstrip('/')}/{source_file}")
    return io.TextIOWrapper(io.BufferedReader(stream), encoding="utf-8-sig", errors="replace", newline="")


def _records(root: str, source: str, source_file: str) -> Iterator[tuple[int, list[str]]]:
    """Records with their number; header rows have numbers below one."""
    csv.field_size_limit(2**31 - 1)
    first = 1 - HEADER_ROWS.get(source, 1)
    with _open_text(root, source_file) as text:
        yield from enumerate(csv.reader(text), first)


def header_key(source: str, heads: list[list[str]]) -> int:
    """A number that files of one family share exactly when their header rows are equal."""
    content = json.dumps([source, heads]).encode()
    return int.from_bytes(hashlib.sha256(content).digest()[:8], "big", signed=True)


def scan_csv(files: DataFrame, root: str) -> DataFrame:
    """All records of the export files in ``files`` (period, source, source_file, file_no), each
    with the key of its file's header."""
    schema = pa.schema(
        [
            ("period", pa.string()),
            ("source", pa.string()),
            ("source_file", pa.string()),
            ("file_no", pa.int64()),
            ("header_key", pa.int64()),
            ("row_number", pa.int64()),
            ("cells", pa.list_(pa.string())),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                numbers, cells, chars, heads = [], [], 0, []

                def flush(file=file, heads=heads):
                    n = len(numbers)
                    constant = [[file[c]] * n for c in ("period", "source", "source_file")]
                    return pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.string()) for c in constant]
                        + [pa.array([file["file_no"]] * n, pa.int64())]
                        + [pa.array([header_key(file["source"], heads)] * n, pa.int64())]
                        + [pa.array(numbers, pa.int64()), pa.array(cells, pa.list_(pa.string()))],
                        schema=schema,
                    )

                for number, record in _records(root, file["source"], file["source_file"]):
                    if number <= 0:
                        heads.append(record)
                    numbers.append(number)
                    cells.append(record)
                    chars += sum(map(len, record)) + 8
                    if chars > BATCH_CHARS and number > 0:
                        yield flush()
                        numbers, cells, chars = [], [], 0
                if numbers:
                    yield flush()

    return _spread(files).mapInArrow(read, RAW_SCHEMA)


def scan_text(files: DataFrame, root: str) -> DataFrame:
    """Whole text of the reports in ``files``; what is not plain text is unreadable."""
    schema = pa.schema(
        [("period", pa.string()), ("source_file", pa.string()), ("text", pa.string()), ("readable", pa.bool_())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                text = None
                if file["source_file"].lower().endswith(PLAIN_TEXT):
                    try:
                        with _open_text(root, file["source_file"]) as handle:
                            text = handle.read().replace("\r\n", "\n").replace("\r", "\n")
                    except OSError:  # reported as an unreadable file, the run goes on
                        text = None
                yield pa.RecordBatch.from_pylist(
                    [{**{k: file[k] for k in ("period", "source_file")}, "text": text, "readable": text is not None}],
                    schema=schema,
                )

    return _spread(files).mapInArrow(read, TEXT_SCHEMA)


def _spread(files: DataFrame) -> DataFrame:
    """Files in their order, cut into tasks of about ``TASK_BYTES`` (less where that would leave
    cores idle): a task ends where the running sum of sizes passes the next multiple."""
    first = F.min("bytes_before")
    total = files.agg(F.count("*").alias("n"), first.alias("first"), F.sum("size").alias("bytes")).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    share = max(1, min(TASK_BYTES, -(-(total["bytes"] or 0) // cores)))
    tasks = max(1, -(-(total["bytes"] or 0) // share))
    task = F.least(F.floor((F.col("bytes_before") - (total["first"] or 0)) / share), F.lit(tasks - 1)).cast("int")
    return files.select("period", "source", "source_file", "file_no", task.alias("task")).repartitionById(tasks, "task")


def headers_of(raw: DataFrame) -> DataFrame:
    """Header names and labels per file (labels only where the family has them).

    A header row is one record per file, so these rows grow with the files, not
    with the data.
    """
    heads = raw.filter("row_number <= 0")
    return heads.groupBy("period", "source", "source_file", "header_key").agg(
        F.min_by("cells", "row_number").alias("header"),
        F.max_by("cells", "row_number").alias("labels"),
        F.count("*").alias("header_rows"),
    )
