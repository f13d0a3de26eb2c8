"""File sources and sinks on whatever file system the paths name."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def run_folder(spark: SparkSession) -> str:
    """The folder of all steps of this application, under the session's ``spark.checkpoint.dir``,
    or where that is unset under its warehouse, which all executors share too."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    root = root or f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/firmlens-steps"
    return f"{root.rstrip('/')}/firmlens-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a step of this application."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_steps(spark: SparkSession) -> None:
    """Remove what the steps of this application have written. For the end of a run: tables
    that were not written elsewhere can't be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    merge_schema: bool = False,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Files, folders or globs as one table.

    ``merge_schema`` reads columns that some files lack as null. ``skip_corrupt``
    leaves out what cannot be read: files without a footer, and of a damaged file the rows
    from the damage on (``read_whole_files`` leaves out the file); give a ``schema`` with
    it, otherwise inference may pick a damaged file.
    """
    reader = spark.read.option("mergeSchema", merge_schema).option("ignoreCorruptFiles", skip_corrupt)
    if skip_corrupt:
        reader = reader.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def _file() -> Column:
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("file")


def unreadable_files(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """Paths below ``folder`` of files that are not whole: without a valid footer, or with fewer
    readable rows than their footer says. A valid empty file is whole.

    One pass over the footers and one over the data; the bytes of a file are looked at only
    if no row of it was read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    listed = files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("file"), "content")
    table = read_parquet(spark, folder, schema=schema, skip_corrupt=True)
    stated = table.select(_file()).groupBy("file").agg(F.count("*").alias("stated"))
    data = table.select(_file(), F.xxhash64(*table.columns).alias("row"))
    # Counting alone would need no column, and take the rows from the footers as above.
    read = data.groupBy("file").agg(F.count("*").alias("read"), F.bit_xor("row").alias("check"))
    rows = stated.join(read, "file", "left")
    partly = rows.filter(F.col("check").isNull() | (F.col("read") < F.col("stated"))).select("file")
    silent = listed.join(rows, "file", "left_anti")

    def damaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = []
            for content in batch.column(1):
                try:
                    bad.append(pq.read_metadata(pa.BufferReader(content.as_buffer())).num_rows > 0)
                except (pa.ArrowException, OSError):
                    bad.append(True)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(bad, pa.bool_()))], ["file"])

    return partly.unionByName(silent.mapInArrow(damaged, "file string"))


def read_whole_files(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """The rows of all files below ``folder`` that are whole, none of the others."""
    table = read_parquet(spark, folder, schema=schema, skip_corrupt=True)
    bad = stored(unreadable_files(spark, folder, schema), "unreadable")
    return table.select("*", _file()).join(bad, "file", "left_anti").select(*table.columns)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    ragged: bool = False,
    header: bool = True,
) -> DataFrame:
    """CSV files. Types are inferred (one extra pass) unless ``schema`` is given.

    ``ragged`` accepts lines with too many or too few fields: surplus ones are dropped
    and missing ones are null. It needs a ``schema``.
    """
    if ragged and schema is None:
        raise ValueError("ragged files need an explicit schema")
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE" if ragged else "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(list([paths] if isinstance(paths, str) else paths))


def load_csv_groups(spark: SparkSession, groups: Sequence[str], schemas: Sequence[str | None] | None = None) -> DataFrame:
    """Union of file groups with different headers; absent columns become null."""
    schemas = schemas or [None] * len(groups)
    tables = [read_csv(spark, g, s) for g, s in zip(groups, schemas, strict=True)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_ndjson(spark: SparkSession, paths: str, schema: StructType | str, strict: bool = False) -> DataFrame:
    """One JSON object per line. ``strict`` fails on a malformed line."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(paths)


def read_json(spark: SparkSession, paths: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(paths)


def write_parquet(
    table: DataFrame,
    path: str,
    max_rows_per_file: int | None = None,
    row_group_bytes: int | None = None,
    partition_by: Sequence[str] = (),
) -> str:
    """Write and return the path. Row groups and files can be kept small for readers
    that take them one at a time."""
    writer = table.write.mode("overwrite")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def stored(table: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: several uses compute it once,
    and a lost executor does not send them back to the input."""
    spark = table.sparkSession
    return spark.read.schema(table.schema).parquet(write_parquet(table, shared_folder(spark, name)))


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt to all cores if they are read in fewer parts than there are cores.

    For parallelism only: the rows are the same, and a large input, which has more parts than
    cores, stays as it is and is not shuffled. Meant for a scan with narrow steps over it,
    before work that costs much more than moving the rows; select the columns first.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def write_csv(table: DataFrame, path: str) -> str:
    table.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(table: DataFrame, path: str) -> str:
    table.write.mode("overwrite").json(path)
    return path


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 512 << 20) -> str:
    """Rewrite many part files as few files of about ``file_bytes`` each.

    A small folder becomes one file; a large one never passes through one task. The
    file count comes from the listing, without reading the data.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    total = listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    n_files = max(1, math.ceil(total / file_bytes))
    return write_parquet(spark.read.parquet(source).coalesce(n_files), target)
