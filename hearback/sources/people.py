"""What people did, bucketed by person: questions across sources then need no shuffle by person.

A run's evidence shrinks to one row for each person and group (source, month, area, theme) with the number of
items and the first and last time. Rows are combined before they are shuffled, so a person with a third of
all items has as few rows as any other, and items without a person are a few rows as well. The rows lie
in files by the hash of the person; tables of the same number of buckets are joined and counted
file by file. The layout is kept beside the tables, so no catalog has to last.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TABLES
from ..session import qualified
from .published import current

GROUPS = ["source", "population", "period", "area", "areas", "theme"]
LAYOUT = "name string, key string, buckets int, columns string"


def activity(items: DataFrame, key: str, by: list[str], at: str) -> DataFrame:
    """Rows, first and last time of each person and group; null keys and times stay as groups and nulls."""
    return items.groupBy(key, *by).agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def write_bucketed(df: DataFrame, base: str, name: str, key: str, buckets: int) -> None:
    """Write ``df`` to ``base/name``, one file for each bucket, and note its layout in ``base/layout``."""
    spark, table = df.sparkSession, f"hearback_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", qualified(spark, f"{base}/{name}")).saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # the name alone: files at a given path stay
    note = [(name, key, buckets, df.schema.json())]
    spark.createDataFrame(note, LAYOUT).coalesce(1).write.mode("append").json(f"{base}/layout")


def read_bucketed(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of ``write_bucketed``; Spark knows its buckets, the session's catalog keeps nothing of it."""
    note = spark.read.schema(LAYOUT).json(f"{base}/layout").filter(F.col("name") == name).first()
    if note is None:
        raise FileNotFoundError(f"{base} holds no bucketed table {name}")
    schema = T.StructType.fromJson(json.loads(note["columns"]))
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    key, place = quoted(note["key"]), qualified(spark, f"{base}/{name}").replace("\\", "\\\\").replace("'", "\\'")
    table = f"hearback_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {note['buckets']} BUCKETS LOCATION '{place}'"
    )
    df = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return df


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def publish_people(spark: SparkSession, base: str, buckets: int | None = None) -> None:
    """Write the people of the run in ``base`` beside its tables."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    evidence = spark.read.schema(TABLES["evidence"]).parquet(f"{base}/data/evidence")
    write_bucketed(activity(evidence, "user_key", GROUPS, "occurred_at"), f"{base}/people", "activity", "user_key", buckets)


def read_people(spark: SparkSession, out: str) -> DataFrame:
    """Activity of the current run: user_key, the groups, n, first_at, last_at."""
    return read_bucketed(spark, f"{current(spark, out)}/people", "activity")
