"""Document frequencies of a corpus that grows by batches.

A batch's counts are written under its identifier and merged when they are read. A batch
that is given again replaces itself. Compacting adds up all batches into one table, which
remembers whom it holds, so that such a batch is not counted a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.operators.vocabulary import document_frequencies
from firmlens.sources.files import write_parquet

SCHEMA = "word string, df long"


class GrowingFrequencies:
    """Counts below ``folder``, which the cluster shares. ``batches`` has the counts of single
    batches, ``merged`` those of all that were compacted, with their identifiers."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _written(self, place: str) -> list[str]:
        """Names of the tables below ``place`` that were written to the end."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.folder}/{place}")
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
        return sorted(n for n in found if system.exists(hadoop.Path(f"{self.folder}/{place}/{n}/_SUCCESS")))

    def add(self, batch: int, docs: DataFrame, text: str = "text") -> None:
        """Count the documents of a batch. The same batch again takes the place of the first,
        and is left out if that was compacted already."""
        if batch not in self._compacted():
            write_parquet(document_frequencies(docs, text).select("word", "df"), f"{self.folder}/batches/{batch:012d}")

    def _latest(self) -> str | None:
        versions = self._written("members")  # written after their counts
        return versions[-1] if versions else None

    def _compacted(self) -> set[int]:
        version = self._latest()
        if version is None:
            return set()
        return {r.batch for r in self.spark.read.schema("batch long").parquet(f"{self.folder}/members/{version}").collect()}

    def batches(self) -> list[int]:
        """Identifiers of all batches that are counted."""
        return sorted(self._compacted() | {int(n) for n in self._written("batches")})

    def frequencies(self) -> DataFrame:
        """``(word, df)`` of all batches; the empty word counts the documents, as
        :func:`vocabulary.idf_scores` wants it."""
        done, version = self._compacted(), self._latest()
        paths = [f"{self.folder}/batches/{n}" for n in self._written("batches") if int(n) not in done]
        if version is not None:
            paths.append(f"{self.folder}/merged/{version}")
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*paths).groupBy("word").agg(F.sum("df").alias("df"))

    def compact(self) -> None:
        """Add up all batches into a new table. Readers see the old tables until the list of its
        members is written; a run that fails before leaves nothing that counts."""
        members = self.batches()
        latest = self._latest()
        version = f"{int(latest) + 1 if latest is not None else 0:012d}"
        write_parquet(self.frequencies(), f"{self.folder}/merged/{version}")
        write_parquet(self.spark.createDataFrame([(m,) for m in members], "batch long"), f"{self.folder}/members/{version}")
