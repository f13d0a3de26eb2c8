"""Tables between the steps of an operator, in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from firmlens.sources.files import shared_folder, write_parquet

#: Shuffle files of a finished query are of no more use once its result is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stored:
    """A table written once, to be read by several steps and dropped after the last."""

    def __init__(self, table: DataFrame, name: str):
        self.spark = table.sparkSession
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            self.path = write_parquet(table, shared_folder(self.spark, name))
        finally:
            self.spark.conf.set(CLEANUP, before)
        self.table = self.spark.read.schema(table.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(table: DataFrame, name: str) -> DataFrame:
    return Stored(table, name).table
