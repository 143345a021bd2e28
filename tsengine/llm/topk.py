"""Exact top-k inner products over norm-sorted vectors.

Components become integers ``floor(scale * x)``.  The vectors are written in
descending order of length; a rotation from the SVD of all vectors (their Gram
matrix, summed in Spark) puts most of a product into the first coordinates.  A
task reads its vectors slice by slice and drops

* a slice, if ``|q| |x|`` of its longest vector is under every query's bound
  (vectors of like length lie together, but a task may read a file of short
  vectors before one of long vectors: nothing relies on the order),
* a pair whose partial product over the leading rotated coordinates (those that
  hold ``LEAD`` of the squared length) plus ``|q_rest| |x_rest|``
  (Cauchy-Schwarz) is under the query's bound.

The integer products of the survivors decide, taken as one exact matrix product
over the rows and columns that still hold any.  A query's bound starts at its
k-th best score among the longest vectors and rises with what the task finds.
Queries come in blocks of ``QUERY_BLOCK``, one pass each.

Edge cases: vectors that are null or hold null or non-finite components, and
rows with a null id, take no part; an empty vector scores 0; shorter vectors
count as padded with zeros; rows that repeat an id count once (the smallest
vector); ties go to the smaller id; with fewer than k other vectors all are
returned; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsengine.llm._common import save_table

QUERY_BLOCK = 4_096
SEED_ROWS = 2_048
SCAN_ROWS = 2_048
LEAD = 0.75            # share of the squared length in the leading rotated coordinates
SLACK = 1e-9          # relative, for the rounding of the rotated products
SCHEMA = "query_id long, vec_id long, score long"


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    v = F.col("x")
    bad = F.exists(v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return (df.select(df[key].cast("long").alias("vec_id"), df[vector].cast("array<double>").alias("x"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad)
            .select("vec_id", F.transform(v, lambda x: F.floor(x * scale)).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v"))
            .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim).astype(np.int64)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def _gram(dim: int):
    def run(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            x = _matrix(b.column("v"), dim).astype(float)
            total += x.T @ x
        i, j = np.indices((dim, dim))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())],
                                         names=["i", "j", "x"])
    return run


def rotation(vectors: DataFrame, dim: int) -> tuple[np.ndarray, int]:
    """Right singular vectors of all vectors, strongest first (dim x dim), and
    how many of them hold ``LEAD`` of the squared length."""
    rows = (vectors.mapInArrow(_gram(dim), "i long, j long, x double")
            .groupBy("i", "j").agg(F.sum("x").alias("x")).collect())
    gram = np.zeros((dim, dim))
    for r in rows:
        gram[r.i, r.j] = r.x
    energy, turn = np.linalg.eigh(gram)
    share = np.cumsum(np.maximum(energy[::-1], 0))
    return turn[:, ::-1].copy(), int(np.searchsorted(share, LEAD * share[-1])) + 1


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row integer inner products."""
    if not len(q):
        return np.empty(0, np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2**62:
        return np.einsum("ij,ij->i", q, x)
    exact = (q.astype(object) * x.astype(object)).sum(axis=1)
    return np.array([min(max(s, -2**63), 2**63 - 1) for s in exact], np.int64)


class _Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, ids: np.ndarray, k: int, bound: np.ndarray):
        self.ids, self.k, self.bound = ids, k, bound.astype(float)
        empty = np.empty(0, np.int64)
        self.query, self.vec, self.score = empty, empty, empty

    def add(self, query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        query, vec, score = (np.concatenate(p) for p in ((self.query, query), (self.vec, vec), (self.score, score)))
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        last = rank == self.k - 1
        self.bound[query[last]] = np.maximum(self.bound[query[last]], score[last])
        self.query, self.vec, self.score = query[keep], vec[keep], score[keep]


def _scan(q_ids, q, turn, lead, k, bound):
    """Vectors, in any order -> each query's best k in this partition.  ``lead``:
    how many rotated coordinates the partial products take."""
    dim = q.shape[1]
    q_norm = np.sqrt((q.astype(float) ** 2).sum(axis=1))
    q_turn = q @ turn
    q_rest = np.sqrt((q_turn[:, lead:] ** 2).sum(axis=1))
    q_top = float(np.abs(q).max(initial=0))

    def run(batches):
        best = _Best(q_ids, k, bound)
        for b in (b.slice(i, SCAN_ROWS) for b in batches for i in range(0, b.num_rows, SCAN_ROWS)):
            longest = float(np.sqrt(b.column("norm2").to_numpy().max()))
            live = np.flatnonzero(q_norm * longest * (1 + SLACK) >= best.bound)
            if not len(live):
                continue
            ids, x = b.column("vec_id").to_numpy(), _matrix(b.column("v"), dim)
            x_turn = x @ turn
            least = best.bound[live, None] - SLACK * (1 + q_norm[live, None] * longest)
            upper = q_turn[live, :lead] @ x_turn[:, :lead].T
            upper += np.outer(q_rest[live], np.sqrt((x_turn[:, lead:] ** 2).sum(axis=1)))
            open_ = upper >= least
            rows, cols = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            qs = live[rows]
            if q_top * float(np.abs(x).max(initial=0)) * max(dim, 1) < 2**53:      # exact in float64
                score = q[qs].astype(float) @ x[cols].T.astype(float)
                r, c = np.nonzero((score >= best.bound[qs, None]) & open_[np.ix_(rows, cols)])
                score = score[r, c].astype(np.int64)
            else:
                r, c = np.nonzero(open_[np.ix_(rows, cols)])
                score = products(q[qs[r]], x[cols[c]])
            other = q_ids[qs[r]] != ids[cols[c]]
            best.add(qs[r][other], ids[cols[c]][other], score[other])
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_ids[best.query]), pa.array(best.vec), pa.array(best.score)], names=["query_id", "vec_id", "score"])
    return run


def _query_blocks(vectors: DataFrame, is_query: Column, dim: int):
    ids, rows = [], []
    for r in vectors.where(is_query).select("vec_id", "v").toLocalIterator():
        ids.append(r.vec_id)
        rows.append([*r.v, *[0] * (dim - len(r.v))])
        if len(ids) == QUERY_BLOCK:
            yield np.array(ids), np.array(rows, np.int64).reshape(len(rows), dim)
            ids, rows = [], []
    if ids:
        yield np.array(ids), np.array(rows, np.int64).reshape(len(rows), dim)


def top_k(df: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best other vectors.
    ``is_query``: function of the id column that tells the queries."""
    spark = df.sparkSession
    vectors = integer_vectors(df, key, vector, scale)
    by_length = [F.desc("norm2"), F.asc("vec_id")]
    vectors = save_table(vectors.repartitionByRange(*by_length).sortWithinPartitions(*by_length), "vectors")
    dim = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    turn, lead = rotation(vectors, dim) if dim else (np.zeros((0, 0)), 0)
    longest = vectors.orderBy(*by_length).limit(SEED_ROWS).select("vec_id", "v").collect()
    seed_ids = np.array([r.vec_id for r in longest], np.int64)
    seeds = np.array([[*r.v, *[0] * (dim - len(r.v))] for r in longest], np.int64).reshape(len(longest), dim)

    found = None
    for ids, q in _query_blocks(vectors, is_query(F.col("vec_id")), dim):
        bound = np.full(len(ids), -np.inf)
        for i in range(len(ids)):
            others = np.flatnonzero(seed_ids != ids[i])
            if len(others) >= k:
                s = products(np.broadcast_to(q[i], (len(others), dim)), seeds[others])
                bound[i] = np.partition(s, len(s) - k)[len(s) - k]
        part = vectors.mapInArrow(_scan(ids, q, turn, lead, k, bound), SCHEMA)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
