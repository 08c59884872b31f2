"""Exact top-k by inner product over integer vectors, pruned by norms and rotated partial sums.

Candidates are dealt in descending order of length. Each query has a threshold, the score
of its k-th best so far; the first one comes from the longest vectors. Since the product is
at most the product of the lengths (Cauchy-Schwarz), a task is done with a query at the first
candidate too short for it. Before that, all vectors are turned into the basis of the
singular vectors of the whole table (from its Gram matrix, which has one number for each pair of
dimensions whatever the number of rows), which gathers most of the length in the first
dimensions: the product over these plus the product of the lengths of the rests bounds the
score, and only pairs whose bound reaches the threshold are scored, in whole numbers.

Queries are taken in blocks of about ``QUERIES``, each scanned by all tasks against all candidates; a task
returns at most k rows for each query, and the best k of those are kept.

Defined cases: vectors that are null or hold a null, NaN or infinite component, and
rows without vec_id, take no part; shorter vectors, empty ones too, are filled up with zeros; rows
that share a vec_id are rows of their own, each a candidate for the others and, if it is asked, a query
with ranks of its own; ties go to the smaller vec_id; a query with fewer than k candidates returns
them all. Components and scores beyond 64 bits are held at the ends of their range (scores
at ``MOST`` and -``MOST``), and rank by that. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .common import ship, workspace

QUERIES = 32_768
HEAD = 2_048
CANDIDATES = 1_024
QUERY_STEP = 2_048
SAFE = float(1 << 53)  # whole numbers up to here are exact in a double
NONE = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max


def whole_vectors(df: DataFrame, scale: int, vector: str = "embedding") -> DataFrame:
    """(vec_id, v, norm2): floor(scale * x) of every valid vector, and its squared length."""
    x = F.transform(vector, lambda c: c.cast("double"))
    valid = F.col(vector).isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )
    df = df.filter(F.col("vec_id").isNotNull() & valid)
    df = df.select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    return df.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as whole numbers, filled up to ``width``."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Singular vectors of the table, in order of falling singular values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column("v"), width).astype(np.float64)
            gram += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(gram.ravel())], ["cell", "n"])

    cells = vectors.select("v").mapInArrow(run, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n"))
    table = cells.toPandas().sort_values("cell")  # width * width rows
    gram = table["n"].to_numpy().reshape(width, width)
    _, basis = np.linalg.eigh(gram)
    return np.ascontiguousarray(basis[:, ::-1])


class Best:
    """The best k (query, score, id) seen, for many queries at once; ``rows`` are the queries' own rows."""

    def __init__(self, rows: np.ndarray, threshold: np.ndarray, k: int):
        self.rows, self.threshold, self.k = rows, threshold.copy(), k
        self.q, self.score, self.vec = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, q: np.ndarray, score: np.ndarray, row: np.ndarray, vec: np.ndarray) -> None:
        use = (score >= self.threshold[q]) & (row != self.rows[q])
        if not use.any():
            return
        q, score, vec = (np.concatenate([a, b[use]]) for a, b in ((self.q, q), (self.score, score), (self.vec, vec)))
        order = np.lexsort((vec, -score, q))
        q, score, vec = q[order], score[order], vec[order]
        first = np.r_[True, q[1:] != q[:-1]]
        rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        full = q[rank == self.k - 1]
        self.threshold[full] = np.maximum(self.threshold[full], score[rank == self.k - 1])
        keep = rank < self.k
        self.q, self.score, self.vec = q[keep], score[keep], vec[keep]


class Block:
    """A block of queries, ready to be compared with candidates."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, basis: np.ndarray, threshold: np.ndarray):
        self.rows, self.vectors, self.basis, self.threshold = rows, vectors, basis, threshold
        self.lead = max(1, min(vectors.shape[1], max(8, vectors.shape[1] // 4)))

    def search(self, parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> Best:
        """Best k of candidates (rows, ids, vectors) that come in descending order of length."""
        best = Best(self.rows, self.threshold, k)
        exact = self.vectors.astype(np.float64)
        length = np.sqrt((exact * exact).sum(1))
        turned = exact @ self.basis
        lead = np.ascontiguousarray(turned[:, : self.lead])
        rest = np.sqrt((turned[:, self.lead :] ** 2).sum(1))
        for rows, ids, vectors in parts:
            c_exact = vectors.astype(np.float64)
            c_length = np.sqrt((c_exact * c_exact).sum(1))
            slack = 1e-9 * length * c_length.max() + 1e-6
            active = np.flatnonzero(length * c_length.max() + slack >= best.threshold)
            if not len(active):
                break
            c_turned = c_exact @ self.basis
            c_lead, c_rest = c_turned[:, : self.lead].T, np.sqrt((c_turned[:, self.lead :] ** 2).sum(1))
            for at in range(0, len(active), QUERY_STEP):
                q = active[at : at + QUERY_STEP]
                bound = lead[q] @ c_lead
                bound += rest[q, None] * c_rest
                i, j = np.nonzero(bound + slack[q, None] >= best.threshold[q, None])
                if not len(i):
                    continue
                small = length[q].max() * c_length.max() < SAFE
                if small and len(i) * 8 > bound.size:
                    score = (exact[q] @ c_exact.T)[i, j].astype(np.int64)
                elif small:
                    score = np.einsum("ij,ij->i", exact[q[i]], c_exact[j]).astype(np.int64)
                else:  # beyond doubles: whole numbers of any size
                    score = (self.vectors[q[i]].astype(object) * vectors[j].astype(object)).sum(1)
                    score = np.clip(score, -MOST, MOST).astype(np.int64)
                best.add(q[i], score, rows[j], ids[j])
        return best


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CANDIDATES):
            piece = batch.slice(at, CANDIDATES)
            yield piece.column("row").to_numpy(), piece.column("vec_id").to_numpy(), _matrix(piece.column("v"), width)


def top_k(df: DataFrame, is_query: Column, k: int, scale: int, work: Workspace | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``df`` (vec_id, embedding) that ``is_query`` names by its
    vec_id, the ``k`` other rows of highest integer product."""
    spark = df.sparkSession
    work = work or workspace(spark)
    vectors = whole_vectors(df, scale)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = vectors.repartitionByRange(count, F.desc("norm2"), "vec_id").sortWithinPartitions(F.desc("norm2"), "vec_id")
    vectors = work.stage(vectors.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    width = max(1, vectors.agg(F.max(F.size("v"))).first()[0] or 1)
    queries = vectors.filter(is_query)
    n_queries = queries.count()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not n_queries:
        return spark.createDataFrame([], schema)
    basis = rotation(vectors, width)
    longest = vectors.orderBy(F.desc("norm2"), "vec_id").limit(HEAD).toPandas()
    longest_v = _matrix(pa.array(longest["v"].tolist(), pa.list_(pa.int64())), width)
    head = [(longest["row"].to_numpy(), longest["vec_id"].to_numpy(), longest_v)]
    sent = spark.sparkContext.broadcast((basis, head))
    blocks = -(-n_queries // QUERIES)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    queries = work.stage(queries.select("block", "row", "vec_id", "v").repartition(count, "row"), "topk-queries")
    ordered = vectors.sortWithinPartitions(F.desc("norm2"), "vec_id").select("row", "vec_id", "v")

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, head = sent.value
        for batch in batches:
            rows, own = batch.column("row").to_numpy(), _matrix(batch.column("v"), width)
            best = Block(rows, own, basis, np.full(len(rows), NONE)).search(iter(head), k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.threshold)], [*batch.schema.names, "threshold"])

    ship(spark)
    line = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    for b in range(blocks):
        block = queries.filter(F.col("block") == b).select("row", "vec_id", "v")
        block = block.mapInArrow(start, "row bigint, vec_id bigint, v array<bigint>, threshold bigint").toPandas()  # about QUERIES rows
        matrix = _matrix(pa.array(block["v"].tolist(), pa.list_(pa.int64())), width)
        asked = spark.sparkContext.broadcast(
            (block["row"].to_numpy(), block["vec_id"].to_numpy(), matrix, block["threshold"].to_numpy())
        )

        def scan(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            rows, ids, own, threshold = asked.value
            best = Block(rows, own, sent.value[0], threshold).search(_parts(batches, width), k)
            if len(best.q):
                columns = [pa.array(rows[best.q]), pa.array(ids[best.q]), pa.array(best.vec), pa.array(best.score)]
                yield pa.RecordBatch.from_arrays(columns, ["query_row", "query_id", "vec_id", "score"])

        found = ordered.mapInArrow(scan, "query_row bigint, query_id bigint, vec_id bigint, score bigint")
        found = found.withColumn("rank", F.row_number().over(line)).filter(F.col("rank") <= k)
        found.select("query_id", "rank", "vec_id", "score").write.mode("overwrite").parquet(work.path(f"topk/block={b}"))
    return spark.read.schema(schema).parquet(*(work.path(f"topk/block={b}") for b in range(blocks)))
