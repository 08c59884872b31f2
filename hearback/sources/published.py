"""Published tables, mirror and run state: writing and reading back.

A run writes to a folder of its own, ``runs/<id>``, and is made the current one by a last
small file in ``published``: readers see all of a run or all of the one before it. ``remove_old_runs``
removes earlier runs that no reader holds, and what failed runs have left.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import folders_in, remove_folder

from ..schemas import TABLES

MIRROR_SCHEMA = (
    "period string, source string, source_file string, row_number long, "
    "cells array<struct<column:string,label:string,value:string>>"
)

MIRROR_BLOCK = 16 * 1024 * 1024  # bytes of a row group: what a look-up of one record reads

POINTER = "run string, published_at string"
HOLD = "reader string, run string, until string"

# Parts of the run report.
MANIFEST = {
    "run": "run_at string, taxonomy_version string, taxonomy_hash string, months array<string>, "
    "reconciliation_ok boolean, files long",
    "by_source_month": "source string, period string, rows_read long, rows_loaded long, rows_rejected long, files long",
    "rejects_by_reason": "source string, reason string, rows long",
    "tables": "table_name string, rows long",
    "link_rates": "source string, evidence_items long, with_user_key double, with_user_id double",
    "areas": "area string, n long",
    "theme_methods": "theme_method string, n long",
    "alerts": "alert string",
    "schema_snapshot": "source string, column string",
    "reconciliation_failures": "source string, period string, file string, rows_read long, rows_loaded long, rows_rejected long",
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Published columns in published order and type."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def new_run() -> str:
    """Folder of a new run, below the output folder."""
    return f"runs/{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def make_current(spark: SparkSession, out: str, run: str) -> None:
    at = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    spark.createDataFrame([(run, at)], POINTER).coalesce(1).write.mode("append").json(f"{out}/published")


def current(spark: SparkSession, out: str) -> str:
    """Folder of the current run; ``out`` itself where nothing was published."""
    try:
        last = spark.read.schema(POINTER).json(f"{out}/published").dropna().orderBy(F.desc("published_at")).first()
    except AnalysisException:
        last = None
    return f"{out}/{last['run']}" if last else out


def publish_table(df: DataFrame, base: str, name: str) -> int:
    """Write a table of a run, one folder per month where it has one, in files of even size.

    The rows are counted as they are written and their number is returned. The count is taken in the
    stage that writes, whose tasks count once, also where a lost executor has had earlier stages run again.
    """
    df, counted = conform(df, TABLES[name]), Observation()
    by_period = "period" in TABLES[name].names
    df = df.hint("rebalance", "period") if by_period else df
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write
    (writer.partitionBy("period") if by_period else writer).parquet(f"{base}/data/{name}")
    return counted.get["rows"]


def publish_mirror(df: DataFrame, base: str) -> None:
    """Write the mirror by month and source, each file in order of file and row and with Bloom filters of
    the file names, so that a look-up of a few records reads the row groups of their files only."""
    rows = df.hint("rebalance", "period", "source").sortWithinPartitions("period", "source", "source_file", "row_number")
    writer = rows.write.partitionBy("period", "source").option("parquet.bloom.filter.enabled#source_file", "true")
    writer.option("parquet.block.size", MIRROR_BLOCK).parquet(f"{base}/mirror")


def read_table(spark: SparkSession, out: str, name: str) -> DataFrame:
    schema = TABLES[name]
    return spark.read.schema(schema).parquet(f"{current(spark, out)}/data/{name}").select(*schema.names)


def read_mirror(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(MIRROR_SCHEMA).parquet(f"{current(spark, out)}/mirror")


def published_runs(spark: SparkSession, out: str) -> list[str]:
    """Folders of all runs that became current, the latest first; their number is that of the runs kept."""
    try:
        rows = spark.read.schema(POINTER).json(f"{out}/published").dropna().collect()
    except AnalysisException:
        return []
    return [r["run"] for r in sorted(rows, key=lambda r: r["published_at"], reverse=True)]


def hold(spark: SparkSession, out: str, reader: str, hours: float = 24) -> str:
    """Note that ``reader`` reads the current run for so long; it is not removed meanwhile. Returns its folder."""
    base = current(spark, out)
    until = (datetime.now(timezone.utc) + timedelta(hours=hours)).isoformat(timespec="microseconds")
    held = [(reader, base.removeprefix(f"{out}/"), until)]
    spark.createDataFrame(held, HOLD).coalesce(1).write.mode("append").json(f"{out}/holds")
    return base


def held_runs(spark: SparkSession, out: str) -> set[str]:
    """Runs that a reader holds now: each reader's last note counts."""
    try:
        notes = spark.read.schema(HOLD).json(f"{out}/holds").dropna().collect()
    except AnalysisException:
        return set()
    now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    last = {}
    for note in sorted(notes, key=lambda n: n["until"]):
        last[note["reader"], note["run"]] = note["until"]
    return {run for (_, run), until in last.items() if until > now}


def remove_old_runs(spark: SparkSession, out: str, keep: int = 2, failed_after_hours: float = 48) -> list[str]:
    """Remove runs behind the last ``keep`` published ones that no reader holds, and folders of runs that never
    became current and have not been changed for ``failed_after_hours``. The current run always stays."""
    done = published_runs(spark, out)
    staying = set(done[: max(1, keep)]) | held_runs(spark, out)
    limit = (datetime.now(timezone.utc) - timedelta(hours=failed_after_hours)).timestamp() * 1000
    gone = []
    for name, changed in folders_in(spark, f"{out}/runs"):
        run = f"runs/{name}"
        if run not in staying and (run in done or changed < limit) and remove_folder(spark, f"{out}/{run}"):
            gone.append(run)
    return sorted(gone)


def persist_views(spark: SparkSession, out: str, database: str = "default") -> list[str]:
    """Views in the session's catalog over the tables of the current run; with a lasting catalog they
    outlive the session. A later run becomes visible when this is called again."""
    base = current(spark, out)
    for name, schema in TABLES.items():
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        path = f"{base}/data/{name}".replace("`", "``")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM parquet.`{path}`")
    return list(TABLES)


def register_views(spark: SparkSession, out: str) -> list[str]:
    """Temporary views over all published tables, for Spark SQL."""
    for name in TABLES:
        read_table(spark, out, name).createOrReplaceTempView(name)
    return list(TABLES)


def write_manifest(parts: dict[str, DataFrame], base: str) -> None:
    for name, df in parts.items():
        df.write.json(f"{base}/manifest/{name}")


def read_manifest(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A part of the last run report; empty when there is none or it cannot be read."""
    try:
        path = f"{current(spark, out)}/manifest/{name}"
        df = spark.read.schema(MANIFEST[name]).option("mode", "DROPMALFORMED").json(path)
        return df.dropna(how="all")
    except AnalysisException:
        return empty(spark, MANIFEST[name])
