"""Finding the export files of all months."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..settings import Settings

# Extensions of reports.
DOCUMENT_EXTENSIONS = [".docx", ".pdf", ".md", ".txt"]

FILE_SCHEMA = "source_file string, size long"
ENTRIES = 10_000


# Schemes of Spark's connectors and what Arrow calls them.
SCHEMES = {
    "s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "viewfs": "viewfs",
    "abfs": "abfss", "abfss": "abfss", "file": "file",
}


def filesystem(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and base path of a folder: a local path, or a URI as Spark writes it."""
    scheme, colon, rest = root.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), root
    if scheme not in SCHEMES:
        raise ValueError(f"no file system for the scheme of {root}")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")


def _entries(root: str, folder: str, recursive: bool) -> Iterator[tuple[str, int | None]]:
    """Relative path and size of what lies in a folder below ``root``; folders have no size."""
    files, base = filesystem(root)
    base = base.rstrip("/")
    for found in files.get_file_info(pafs.FileSelector(f"{base}/{folder}".rstrip("/"), recursive=recursive)):
        if found.type != pafs.FileType.File and (recursive or found.type != pafs.FileType.Directory):
            continue
        yield found.path[len(base) :].lstrip("/"), found.size if found.type == pafs.FileType.File else None


def _listing(root: str, recursive: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replace every folder by its entries, in tasks; files stay."""
    schema = pa.schema([("source_file", pa.string()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(*(c.to_pylist() for c in batch.columns)):
                entries = [(path, size)] if size is not None else _entries(root, path, recursive)
                while rows := list(islice(entries := iter(entries), ENTRIES)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Relative path and size of every file below ``root``.

    Only names are listed here, no content. The driver lists the root alone, which holds the month folders;
    tasks list what lies in them, and then every folder in there. Spark's own file sources would leave
    out names that begin with an underscore and read brackets as patterns. A folder that
    does not exist raises: an empty run must not replace what was published.
    """
    top = spark.createDataFrame(list(_entries(root, "", recursive=False)), FILE_SCHEMA)
    cores = spark.sparkContext.defaultParallelism
    for recursive in (False, True):
        top = top.repartition(cores, "source_file").mapInArrow(_listing(root, recursive), FILE_SCHEMA)
    return top


def with_origin(files: DataFrame, settings: Settings) -> DataFrame:
    """Add period, source, the parts of the path and the place in processing order.

    Source is an export family, "documents" for reports, or null for a file nobody
    handles. Files outside month folders and hidden files are left out.
    """
    parts = F.split("source_file", "/")
    name = F.element_at(parts, -1)
    extension = F.lower(F.regexp_extract(name, r"[^.].*?(\.[^.]+)$", 1))
    folders = [
        (folder.lower(), source) for source, names in settings.folders.items() for folder in names
    ]
    source: Column = F.lit(None).cast("string")
    for folder, family in reversed(folders):
        source = F.when(F.lower(parts[1]) == folder, F.lit(family)).otherwise(source)
    located = files.withColumns(
        {
            "period": parts[0],
            "file_name": name,
            "extension": extension,
            "folder": F.when(F.size(parts) > 2, F.get(parts, F.size(parts) - 2)),
        }
    )
    handled = (
        located.filter((F.size(parts) > 1) & F.col("period").rlike(settings.month_pattern))
        .filter(~F.exists(parts, lambda p: p.startswith(".")))
        .withColumn(
            "source",
            F.when(F.col("extension").isin(DOCUMENT_EXTENSIONS), "documents").when(
                (F.col("extension") == ".csv") & (F.size(parts) > 2), source
            ),
        )
    )
    # numbered within each period and source; the few groups' totals are added up and joined
    group = ["period", "source"]
    order = W.partitionBy(*group).orderBy(F.split("source_file", "/"))
    size = F.col("size") if "size" in files.columns else F.lit(0).cast("long")
    placed = handled.withColumns(
        {"_no": F.row_number().over(order), "_bytes": F.sum(size).over(order.rowsBetween(W.unboundedPreceding, 0)) - size}
    )
    totals = handled.groupBy(*group).agg(F.count("*").alias("_n"), F.sum(size).alias("_sum"))
    ahead = W.orderBy("period", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        F.col("period").alias("_period"),
        F.col("source").alias("_source"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_files_ahead"),
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_bytes_ahead"),
    )
    same = (F.col("period") == F.col("_period")) & F.col("source").eqNullSafe(F.col("_source"))
    numbered = placed.join(totals, same).withColumns(
        {
            "file_no": (F.col("_files_ahead") + F.col("_no")).cast("long"),
            "bytes_before": F.col("_bytes_ahead") + F.col("_bytes"),
        }
    )
    return numbered.drop("_no", "_bytes", "_period", "_source", "_files_ahead", "_bytes_ahead")
