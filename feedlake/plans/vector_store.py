"""Vectors by content: a text that has been embedded once is not sent to the model again.

The store is a folder per model with one row per text hash, written batch by batch. A run embeds the texts that no other
batch holds, once each however many rows share them, and then gives every row its vector.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from feedlake.operators.dedupe import one_per_key
from feedlake.operators.joins import lookup_join
from feedlake.operators.seen import without_known
from feedlake.operators.tables import batch_numbers, read_batches, write_batch
from feedlake.plans.index import Embedder, embedded
from feedlake.schema import EMBED_DIM
from feedlake.session import BROADCAST_BYTES, cut_lineage, measure

_ROW = StructType([StructField("_hash", StringType()), StructField("vector", ArrayType(DoubleType()))])


@dataclass(frozen=True)
class VectorStore:
    """Vectors of one model below a folder. Another model, or another version of one, needs another name."""

    root: str
    name: str
    dim: int = EMBED_DIM
    model: Embedder | None = None

    @property
    def path(self) -> str:
        return f"{self.root}/model={self.name}"

    def stored(self, spark: SparkSession) -> DataFrame:
        """(_hash, vector, batch_id)"""
        return read_batches(spark, self.path, _ROW)

    def add(self, texts: DataFrame, batch_id: int) -> int:
        """Embed the texts of `(text)` that other batches do not hold; returns how many there were.

        A batch that is run again replaces what it wrote.
        """
        return self._add(texts.filter(F.col("text").isNotNull()).select(F.sha2("text", 256).alias("_hash"), "text"), batch_id)

    def _add(self, hashed: DataFrame, batch_id: int) -> int:
        """The same for `(_hash, text)`."""
        spark = hashed.sparkSession
        wanted = hashed.select("_hash").distinct()
        others = [n for n in batch_numbers(spark, self.path) if n != batch_id]
        if others:
            known = self.stored(spark).filter(F.col("batch_id") != batch_id)
            wanted = without_known(cut_lineage(wanted, "text-hashes"), known, "_hash")
        wanted = cut_lineage(wanted, "new-hashes")
        if measure(wanted)[1] <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        # Each task sends one text per hash.
        new = one_per_key(hashed.join(wanted, "_hash", "left_semi"), "_hash", [F.col("_hash")])
        write_batch(embedded(new, F.col("text"), "vector", self.dim, self.model).select("_hash", "vector"), self.path, batch_id, sort_by=None)
        return spark.read.schema(_ROW).parquet(f"{self.path}/log/batch_id={batch_id}").count()

    def embedded(self, df: DataFrame, text: Column, batch_id: int, out: str = "vector") -> DataFrame:
        """The rows with the vectors of their texts, those of new texts being made; a null text has none.

        The rows are looked at several times, so they are computed once and stored.
        """
        spark = df.sparkSession
        rows = cut_lineage(df.select("*", F.sha2(text, 256).alias("_hash"), text.alias("_text")), "texts")
        self._add(rows.filter(F.col("_hash").isNotNull()).select("_hash", F.col("_text").alias("text")), batch_id)
        rows = rows.drop("_text")
        hashes = cut_lineage(rows.select("_hash").filter(F.col("_hash").isNotNull()).distinct(), "text-hashes")
        if measure(hashes)[1] <= BROADCAST_BYTES:
            hashes = F.broadcast(hashes)
        vectors = self.stored(spark).select("_hash", F.col("vector").alias(out)).join(hashes, "_hash", "left_semi")
        vectors = cut_lineage(vectors, "vectors")
        with_text, without = rows.filter(F.col("_hash").isNotNull()), rows.filter(F.col("_hash").isNull())
        # A text that many rows share is one vector; its rows are spread by the other columns.
        found = lookup_join(with_text, vectors, "_hash", spread_by=[c for c, kind in df.dtypes if not kind.startswith("map")])
        empty = without.withColumn(out, F.lit(None).cast("array<double>"))
        return found.select(*df.columns, out).unionByName(empty.select(*df.columns, out))
