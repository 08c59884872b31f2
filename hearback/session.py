"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Time is handled as UTC without zone; AQE sizes shuffles and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


BROADCAST_BYTES = 64 * 1024 * 1024


class Workspace:
    """Folder for intermediate tables of one run.

    A table written here cuts lineage: later steps read files, not executors' local
    blocks, so a lost executor costs a few tasks and not the whole run. The folder
    is the one the cluster names in ``spark.checkpoint.dir``; ``fallback`` is used
    only where that is unset.
    """

    def __init__(self, spark: SparkSession, fallback: str | None = None):
        base = spark.conf.get("spark.checkpoint.dir", None) or fallback
        if not base:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        self.spark = spark
        self.root = f"{base.rstrip('/')}/hearback-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))


    def settle(self, df: DataFrame, name: str) -> DataFrame:
        """A side table written and measured: broadcast when it is small, joined by
        shuffle when it is not."""
        table = self.stage(df, name)
        written = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if written * 32 <= BROADCAST_BYTES:  # so few bytes in files need no measuring
            return F.broadcast(table)
        size = table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
        return F.broadcast(table) if size <= BROADCAST_BYTES else table


    def remove(self) -> None:
        """Delete the folder and all tables in it."""
        remove_folder(self.spark, self.root)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever store its path names; whether there was one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store's name; relative ones are taken from the working folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(folder).toString()


def scratch(spark: SparkSession) -> Workspace:
    """Work folder in ``spark.checkpoint.dir``; one of this machine only where that is unset and the
    session runs on this machine alone, as in tests."""
    alone = spark.sparkContext.master.startswith("local") and spark.conf.get("spark.checkpoint.dir", None) is None
    return Workspace(spark, tempfile.mkdtemp(prefix="hearback-") if alone else None)


def folders_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names of the folders right below ``path`` and when each was last changed (milliseconds)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(folder):
        return []
    return [(f.getPath().getName(), f.getModificationTime()) for f in files.listStatus(folder) if f.isDirectory()]


class Inline(Workspace):
    """Keeps every step in the one lazy plan; for small inputs and single queries."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def stage(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        return df

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        return df

    def remove(self) -> None:
        pass


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def widen(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Spread a scan of very few row groups over all cores.

    Texts are costly to search, and a table of one row group is read by one task. A
    table with as many splits as cores or more stays as it is: no shuffle there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
