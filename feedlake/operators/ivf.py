"""Approximate vector search: an inverted file of cells, with exact scores and a stated recall.

Vectors are dealt into cells by their nearest centre; the centres come from k-means on a bounded sample. The
cells are folders of a stored table, so that a search reads only those whose centres are nearest to some
query. What it reads is scored exactly, as in `operators.knn`: one matrix product per block and no row per pair. A cell that
holds a large share of all vectors is read by several tasks.

`calibrated` finds how many cells to read for a wanted recall, by comparing a bounded sample of queries with the exact search;
`scanned_share` says what that costs. The way out where no recall below one will do is `exact`: the largest
angle between a centre and its vectors bounds what a cell that was not read can hold, and cells that could still
hold one of the k best are read in a second pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators.knn import CANDIDATE, QUERY_BYTES, SCORE_DIGITS, Best, block_rows, id_array, knn, unit_matrix
from feedlake.operators.tables import balanced
from feedlake.operators.topk import top_per
from feedlake.session import cut_lineage

MOST_CELLS = 4096
# Rows that centres are fitted on, and queries that the number of cells to read is chosen with.
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 64
_SLACK = 10.0**-SCORE_DIGITS
_SEED = 7


def _sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """A bounded sample that does not depend on the layout: the rows whose ids have the smallest hashes."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)


def _centres(vectors: DataFrame, n_cells: int, sample_rows: int) -> np.ndarray:
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    rows = _sample(vectors.filter(length > 0), "vec_id", sample_rows).select(array_to_vector("vector").alias("features"))
    rows = cut_lineage(rows, "ivf-sample")
    model = KMeans(k=n_cells, distanceMeasure="cosine", seed=_SEED, maxIter=20).fit(rows)
    centres = np.array(model.clusterCenters())
    return centres / np.linalg.norm(centres, axis=1)[:, None]


def build_index(vectors: DataFrame, root: str, n_cells: int | None = None, sample_rows: int = SAMPLE_ROWS) -> None:
    """Store `vectors(vec_id, vector)` by cell below a folder. Every vector that is not null is indexed.

    Without `n_cells` there are as many as the square root of the number of vectors, within limits.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>")).filter("vector is not null")
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
    cells = max(1, min(MOST_CELLS, round(size["n"] ** 0.5) if n_cells is None else n_cells, sample_rows))
    dim = size["dim"] or 1
    centres = _centres(vectors, cells, sample_rows) if size["n"] > 1 else np.eye(1, dim)
    sent = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows(len(sent.value))):
                part = batch.slice(start, block_rows(len(sent.value)))
                cosine = unit_matrix(part.column(1), dim) @ sent.value.T
                cell = cosine.argmax(axis=1)
                angle = np.arccos(np.clip(cosine[np.arange(len(cell)), cell], -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(angle), pa.array(cell, pa.int32())], ["vec_id", "vector", "angle", "cell"]
                )

    dealt = vectors.mapInArrow(assign, "vec_id long, vector array<double>, angle double, cell int")
    balanced(dealt, "cell").write.partitionBy("cell").parquet(f"{root}/vectors")
    stored = _stored(spark, root).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("angle"))
    known = spark.createDataFrame([(c, v.tolist()) for c, v in enumerate(centres)], "cell int, centre array<double>")
    known.join(stored, "cell").coalesce(1).write.parquet(f"{root}/cells")


def _stored(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("vec_id long, vector array<double>, angle double, cell int").parquet(f"{root}/vectors")


@dataclass
class CellIndex:
    """An inverted file: its cells that hold vectors (at most `MOST_CELLS`), and the stored vectors."""

    vectors: DataFrame
    cells: np.ndarray
    centres: np.ndarray
    counts: np.ndarray
    angles: np.ndarray

    def _chunks(self, queries: DataFrame, k: int, query_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, unit vectors) of queries, in chunks whose vectors, candidates and cell lists stay below a size."""
        dim = self.centres.shape[1]
        n = queries.count()
        chunks = max(1, ceil(n * (dim * 8 + 8 + k * 16 + len(self.cells) * 4) / max(1, query_bytes)))
        for at in range(chunks):
            table = queries.filter(F.pmod(F.xxhash64("qid"), F.lit(chunks)) == at).toArrow()
            if table.num_rows:
                yield id_array(table["qid"]), unit_matrix(table["vector"], dim)

    def _nearest(self, matrix: np.ndarray, probes: int) -> np.ndarray:
        """(query, cell): whether the cell is among the `probes` nearest to the query."""
        closeness = matrix @ self.centres.T
        order = np.argsort(-closeness, axis=1, kind="stable")[:, :probes]
        chosen = np.zeros(closeness.shape, bool)
        np.put_along_axis(chosen, order, True, axis=1)
        return chosen

    def _candidates(self, ids: np.ndarray, matrix: np.ndarray, chosen: np.ndarray, k: int) -> DataFrame:
        """The k best vectors of each task for each query, from the chosen cells of the query."""
        asked = {int(cell): np.flatnonzero(chosen[:, at]).astype(np.int32) for at, cell in enumerate(self.cells) if chosen[:, at].any()}
        sent = self.vectors.sparkSession.sparkContext.broadcast((ids, matrix, asked))
        dim = matrix.shape[1]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, query_matrix, by_cell = sent.value
            best = Best(len(query_ids), k)
            for batch in batches:
                for start in range(0, batch.num_rows, block_rows(0)):
                    part = batch.slice(start, block_rows(0))
                    vectors, vec_ids = unit_matrix(part.column("vector"), dim), id_array(part.column("vec_id"))
                    cells = part.column("cell").to_numpy()
                    for cell in np.unique(cells):
                        own = cells == cell
                        best.add(query_matrix, vectors[own], vec_ids[own], by_cell[int(cell)])
            yield pa.RecordBatch.from_pydict(best.rows(query_ids))

        # Folders of cells that no query asks for are not listed.
        return self.vectors.filter(F.col("cell").isin(list(asked))).select("vec_id", "vector", "cell").mapInArrow(score, CANDIDATE)

    def _ranked(self, frames: list[DataFrame], k: int) -> DataFrame:
        if not frames:
            return self.vectors.sparkSession.createDataFrame([], "qid long, rank int, vec_id long, score double")
        ranked = top_per(reduce(DataFrame.unionByName, frames), ["qid"], k, [F.col("score").desc(), F.col("vec_id").asc()])
        return ranked.select("qid", "rank", "vec_id", "score")

    def search(self, queries: DataFrame, k: int, probes: int, query_bytes: int = QUERY_BYTES) -> DataFrame:
        """(qid, rank, vec_id, score): the k best of the `probes` cells nearest to each of `queries(qid, vector)`."""
        found = [self._candidates(ids, m, self._nearest(m, probes), k) for ids, m in self._chunks(_clean(queries), k, query_bytes)]
        return self._ranked(found, k)

    def exact(self, queries: DataFrame, k: int, probes: int = 1, query_bytes: int = QUERY_BYTES) -> DataFrame:
        """The k best of all vectors. After the nearest cells, those are read that may hold something as good as the k-th hit."""
        frames = []
        for ids, matrix in self._chunks(_clean(queries), k, query_bytes):
            chosen = self._nearest(matrix, probes)
            first = cut_lineage(self._candidates(ids, matrix, chosen, k), "ivf-first")
            frames.append(first)
            last = {row["qid"]: row["score"] for row in self._ranked([first], k).filter(F.col("rank") == k).collect()}
            floor = np.array([last.get(int(qid), -np.inf) for qid in ids])
            away = np.arccos(np.clip(matrix @ self.centres.T, -1, 1)) - self.angles
            bound = np.cos(np.clip(away, 0, np.pi))
            more = ~chosen & (bound + _SLACK >= floor[:, None])
            if more.any():
                frames.append(self._candidates(ids, matrix, more, k))
        return self._ranked(frames, k)

    def scanned_share(self, queries: DataFrame, probes: int, query_bytes: int = QUERY_BYTES) -> float:
        """The part of all (query, vector) pairs that a search scores."""
        scored = asked = 0
        for _, matrix in self._chunks(_clean(queries), 1, query_bytes):
            scored += int((self._nearest(matrix, probes) @ self.counts).sum())
            asked += len(matrix)
        return scored / max(1, asked * int(self.counts.sum()))

    def calibrated(self, queries: DataFrame, k: int, recall_wanted: float, sample: int = SAMPLE_QUERIES) -> int:
        """How many cells to read, so that a bounded sample of the queries finds the wanted part of its exact hits. All
        cells, at worst: then the search is the exact one."""
        asked = cut_lineage(_sample(_clean(queries), "qid", sample), "ivf-queries")
        truth = cut_lineage(knn(asked, self.vectors.select("vec_id", "vector"), k), "ivf-truth")
        low, high = 0, 1
        enough = lambda probes: probes >= len(self.cells) or mean_recall(self.search(asked, k, probes), truth) >= recall_wanted
        while not enough(high):
            low, high = high, min(len(self.cells), 2 * high)
        while high - low > max(1, low // 8):  # a few cells more than needed do no harm
            mid = (low + high) // 2
            low, high = (low, mid) if enough(mid) else (mid, high)
        return high


def _clean(queries: DataFrame) -> DataFrame:
    return queries.select(F.col("qid").cast("long"), F.col("vector").cast("array<double>")).filter("vector is not null")


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """(qid, recall): the part of the exact hits of a query that a search has found."""
    both = truth.select("qid", "vec_id").join(found.select("qid", "vec_id", F.lit(1).alias("_hit")), ["qid", "vec_id"], "left")
    return both.groupBy("qid").agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))


def mean_recall(found: DataFrame, truth: DataFrame) -> float:
    return recall(found, truth).agg(F.avg("recall")).first()[0] or 0.0


def open_index(spark: SparkSession, root: str) -> CellIndex:
    table = spark.read.schema("cell int, centre array<double>, n long, angle double").parquet(f"{root}/cells").orderBy("cell").collect()
    dim = len(table[0]["centre"]) if table else 1
    column = lambda name, kind: np.array([row[name] for row in table], kind)
    return CellIndex(
        _stored(spark, root), column("cell", np.int64), column("centre", np.float64).reshape(-1, dim), column("n", np.int64), column("angle", np.float64)
    )
