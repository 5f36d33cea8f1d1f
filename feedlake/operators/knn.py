"""Exact cosine top-k of a table of query vectors against a table of vectors.

No pair of query and vector ever becomes a row. Tasks score a block of vectors
against a block of queries with one matrix product and keep k candidates per
query; the candidates of all tasks are then ranked per query.

Queries go to every task in chunks below a size limit, which counts the candidates
they will need; for each chunk the vectors are read without a shuffle. Vectors of another
length than the queries fail the job.

Scores are rounded to `SCORE_DIGITS` before they are compared, so that equal
vectors tie whatever order a sum was taken in; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.operators.topk import top_per
from feedlake.session import cut_lineage

SCORE_DIGITS = 8
_SLACK = 10.0**-SCORE_DIGITS
QUERY_BYTES = 64 * 1024 * 1024
# A candidate's score and id.
_CANDIDATE_BYTES = 16
# Vectors, and scores, that a task holds as a matrix at one time.
_BLOCK_ROWS = 2048
_BLOCK_CELLS = 4_000_000

CANDIDATE = "qid long, vec_id long, score double"


def unit_matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of `dim` values as a matrix of unit vectors; a zero row stays zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if (lengths != dim).any():
        raise ValueError(f"a vector has {lengths[lengths != dim][0]} values, the queries have {dim}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    matrix = flat.reshape(len(column), dim)
    size = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.where(size == 0, 1.0, size)[:, None]


def block_rows(others: int) -> int:
    """Rows of a block that is multiplied with so many others."""
    return max(1, min(_BLOCK_ROWS, _BLOCK_CELLS // max(1, others)))


class Best:
    """The k best candidates per query seen so far, best first; free places score -inf."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.score = np.full((n_queries, k), -np.inf)
        self.vec_id = np.zeros((n_queries, k), np.int64)

    def add(self, queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, which: np.ndarray | None = None) -> None:
        """Look at a block of vectors for all queries, or for those with the numbers `which`."""
        which = np.arange(len(queries)) if which is None else which
        step = max(1, _BLOCK_CELLS // max(1, len(ids)))
        for start in range(0, len(which), step):
            own = which[start : start + step]
            scores = queries[own] @ vectors.T
            # Only what can take a place is looked at: what reaches the k-th
            # score so far or, while there are free places, the k-th of the
            # block. A NaN reaches nothing. Rounding can lift a score by less
            # than the slack.
            floor, last_id = self.score[own, -1], self.vec_id[own, -1]
            bar = floor
            if scores.shape[1] > self.k and np.isneginf(floor).any():
                cut = scores.shape[1] - self.k
                lowest = np.partition(np.where(np.isnan(scores), -np.inf, scores), cut, axis=1)[:, cut]
                bar = np.maximum(bar, lowest)
            q, c = np.nonzero(scores >= (bar - _SLACK)[:, None])
            found, new_ids = np.round(scores[q, c], SCORE_DIGITS) + 0.0, ids[c]
            better = (found > floor[q]) | (new_ids < last_id[q])
            if better.any():
                self._merge(own[q[better]], new_ids[better], found[better])

    def _merge(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Rank the new candidates of some queries together with their old ones."""
        touched = np.unique(q)
        q = np.concatenate([np.repeat(touched, self.k), q])
        ids = np.concatenate([self.vec_id[touched].ravel(), ids])
        scores = np.concatenate([self.score[touched].ravel(), scores])
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = place < self.k
        self.vec_id[q[kept], place[kept]] = ids[kept]
        self.score[q[kept], place[kept]] = scores[kept]

    def rows(self, query_ids: np.ndarray) -> dict[str, np.ndarray]:
        q, place = np.nonzero(self.score > -np.inf)
        return {"qid": query_ids[q], "vec_id": self.vec_id[q, place], "score": self.score[q, place]}


def id_array(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy(), np.int64)


def _candidates(queries: DataFrame, vectors: DataFrame, k: int, dim: int) -> DataFrame:
    """The k best vectors of each task for a chunk of queries."""
    table = queries.toArrow()
    if not table.num_rows:
        return vectors.sparkSession.createDataFrame([], CANDIDATE)
    sent = vectors.sparkSession.sparkContext.broadcast((id_array(table["qid"]), unit_matrix(table["vector"], dim)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_matrix = sent.value
        best = Best(len(query_ids), k)
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK_ROWS):
                part = batch.slice(start, _BLOCK_ROWS)
                best.add(query_matrix, unit_matrix(part.column("vector"), dim), id_array(part.column("vec_id")))
        yield pa.RecordBatch.from_pydict(best.rows(query_ids))

    return vectors.mapInArrow(score, CANDIDATE)


def knn(queries: DataFrame, vectors: DataFrame, k: int, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Top k of `vectors(vec_id, vector)` for each of `queries(qid, vector)`.

    Ids are unique longs, vectors without a value are left out. Returns (qid, rank, vec_id, score),
    rank from 1.
    """
    queries = queries.select(F.col("qid").cast("long"), F.col("vector").cast("array<double>")).filter("vector is not null")
    vectors = vectors.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>")).filter("vector is not null")
    length = F.size("vector")
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.min(length).alias("least"), F.max(length).alias("dim")).first()
    if not size["n"]:
        return vectors.sparkSession.createDataFrame([], "qid long, rank int, vec_id long, score double")
    if size["least"] != size["dim"]:
        raise ValueError(f"the queries have vectors of {size['least']} to {size['dim']} values")
    need = size["n"] * (size["dim"] * 8 + 8 + k * _CANDIDATE_BYTES)
    chunks = max(1, ceil(need / max(1, query_bytes)))
    if chunks > 1:
        queries = cut_lineage(queries, "knn-queries")
    frames = [
        _candidates(queries.filter(F.pmod(F.xxhash64("qid"), F.lit(chunks)) == n), vectors, k, size["dim"])
        for n in range(chunks)
    ]
    ranked = top_per(reduce(DataFrame.unionByName, frames), ["qid"], k, [F.col("score").desc(), F.col("vec_id").asc()])
    return ranked.select("qid", "rank", "vec_id", "score")
