"""Text search by posting lists of trigrams.

Texts lie in blocks of about ``BLOCK_ROWS`` rows in a given order, a folder each. The posting list of a trigram
(three characters of the lower-cased text that follow one another) names the blocks that hold it. A search looks
up the trigrams of its needle, keeps the blocks that hold all of them and reads these blocks alone; whether
a text holds the needle is then decided by the same ILIKE as without the index. Letters are lowered as ILIKE does
it, so that no hit is lost.

A needle may hold the wildcards of ILIKE: the stretches between them count. Where no stretch has three letters
there is nothing to look up and all blocks are read. Null texts are in no posting list and never hit. The driver
holds the numbers of at most ``FEW_BLOCKS`` blocks; more are joined, and their folders pruned by Spark.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import BROADCAST_BYTES
from .published import current, read_table

BLOCK_ROWS = 20_000
FEW_BLOCKS = 1_000
POSTINGS_BLOCK = 8 * 1024 * 1024  # bytes of a row group: a look-up reads a few of them
GRAM = 3
TEXTS = "name string, text_column string, blocks long, columns string"


def trigrams(lowered: Column) -> Column:
    """The distinct runs of three characters, found in one pass by looking ahead at each place."""
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def stretches(pattern: str) -> list[str]:
    """Literal parts of a LIKE pattern between its wildcards."""
    found, held, at = [], "", 0
    while at < len(pattern):
        sign = pattern[at]
        if sign in "%_":
            found.append(held)
            held = ""
        else:
            at += sign == "\\"
            held += pattern[at : at + 1]
        at += 1
    return [part for part in (*found, held) if part]


def grams_of(spark: SparkSession, needle: str) -> list[str]:
    """Trigrams that every text with the needle holds."""
    lowered = spark.range(1).select(F.lower(F.lit(f"%{needle}%"))).first()[0]
    return sorted({part[i : i + GRAM] for part in stretches(lowered) for i in range(len(part) - GRAM + 1)})


def build_index(df: DataFrame, base: str, text: str, order: list[Column], block_rows: int = BLOCK_ROWS) -> None:
    """Write the rows of ``df`` and the posting lists of its column ``text`` below ``base``.

    Rows are dealt by ranges of ``order``; rows that are equal there are dealt one by one, so that
    copies of one text never make a long block.
    """
    spark = df.sparkSession
    blocks = max(1, -(-df.count() // block_rows))
    dealt = df.repartitionByRange(blocks, *order, F.monotonically_increasing_id())
    dealt = dealt.withColumn(_block(df), F.spark_partition_id())
    dealt.write.partitionBy(_block(df)).parquet(f"{base}/texts")
    note = [(_block(df), text, blocks, df.schema.json())]
    spark.createDataFrame(note, TEXTS).coalesce(1).write.json(f"{base}/layout")
    written = _texts(spark, base)[0]
    held = written.select(F.col(_block(df)).alias("block"), F.explode(trigrams(F.lower(F.col(text)))).alias("gram"))
    postings = held.distinct().repartitionByRange("gram", "block").sortWithinPartitions("gram", "block")
    writer = postings.write.option("parquet.bloom.filter.enabled#gram", "true")
    writer.option("parquet.block.size", POSTINGS_BLOCK).parquet(f"{base}/postings")


def _block(df: DataFrame) -> str:
    """A column name that no column of ``df`` has."""
    name = "block"
    while name in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def _texts(spark: SparkSession, base: str, blocks: list[int] | None = None) -> tuple[DataFrame, str]:
    """Rows of the index with their block, of the given ones only, and that column's name."""
    note = spark.read.schema(TEXTS).json(f"{base}/layout").first()
    schema = T.StructType.fromJson(json.loads(note["columns"])).add(note["name"], T.IntegerType())
    reader = spark.read.schema(schema).option("basePath", f"{base}/texts")
    if blocks is None:
        return reader.parquet(f"{base}/texts"), note["name"]
    if not blocks:
        return spark.createDataFrame([], schema), note["name"]
    return reader.parquet(*[f"{base}/texts/{note['name']}={b}" for b in blocks]), note["name"]


def blocks_with(spark: SparkSession, base: str, needle: str) -> DataFrame | None:
    """Numbers of the blocks that hold all trigrams of the needle; None where it has none."""
    grams = grams_of(spark, needle)
    if not grams:
        return None
    postings = spark.read.schema("block int, gram string").parquet(f"{base}/postings").filter(F.col("gram").isin(grams))
    return postings.groupBy("block").agg(F.count("*").alias("n")).filter(F.col("n") == len(grams)).select("block")


def rows_near(spark: SparkSession, base: str, needle: str) -> DataFrame:
    """All rows of the blocks that may hold the needle, without the block: what is left for ILIKE to decide."""
    wanted = blocks_with(spark, base, needle)
    if wanted is None:
        rows, name = _texts(spark, base)
        return rows.drop(name)
    few = [r["block"] for r in wanted.limit(FEW_BLOCKS + 1).collect()]
    if len(few) <= FEW_BLOCKS:
        rows, name = _texts(spark, base, sorted(few))
        return rows.drop(name)
    rows, name = _texts(spark, base)
    wanted = wanted.withColumnRenamed("block", name)
    if wanted.count() * 4 <= BROADCAST_BYTES // 8:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, name, "left_semi").drop(name)


def index_table(spark: SparkSession, out: str, name: str = "evidence", text: str = "text", order: str = "occurred_at") -> None:
    """Index a published table of the current run, latest rows first; it lies in the run's folder and goes with it."""
    build_index(read_table(spark, out, name), f"{current(spark, out)}/search/{name}", text, [F.desc(order)])


def table_near(spark: SparkSession, out: str, name: str, needle: str) -> DataFrame:
    """Rows of a published table that may hold the needle; the whole table where no index was made."""
    base = f"{current(spark, out)}/search/{name}"
    try:
        return rows_near(spark, base, needle)
    except AnalysisException:
        return read_table(spark, out, name)
