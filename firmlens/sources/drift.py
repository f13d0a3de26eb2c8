"""Parquet files that disagree in the types of their columns, as one table.

Footers are read in tasks. Files with one schema are one scan, so that columns are pruned
and filters pushed down in each; a column gets the type that holds the values of all its
types, and scans are put together by column name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.pandas.types import from_arrow_schema

#: Numbers from narrow to wide. What two of them have in common is the wider one, but for
#: long and float, which a double holds better.
NUMBERS = [t.ByteType(), t.ShortType(), t.IntegerType(), t.LongType(), t.FloatType(), t.DoubleType()]


def promoted(a: t.DataType, b: t.DataType) -> t.DataType:
    """The type that columns of types ``a`` and ``b`` are read as.

    Whole numbers widen to long; with a float or a decimal they become double. A date becomes a
    timestamp. A scalar becomes a list of one if the other is a list. Structs are joined by
    field name. Everything else becomes a string; a column of nulls only takes the other type.
    """
    if a == b or isinstance(b, t.NullType):
        return a
    if isinstance(a, t.NullType):
        return b
    if isinstance(a, t.ArrayType) or isinstance(b, t.ArrayType):
        one, two = (x.elementType if isinstance(x, t.ArrayType) else x for x in (a, b))
        return t.ArrayType(promoted(one, two), True)
    if isinstance(a, t.StructType) and isinstance(b, t.StructType):
        names = [*a.names, *(n for n in b.names if n not in a.names)]
        both = [[s[n].dataType for s in (a, b) if n in s.names] for n in names]
        return t.StructType([t.StructField(n, reduce(promoted, kinds)) for n, kinds in zip(names, both, strict=True)])
    if isinstance(a, t.DecimalType) and isinstance(b, t.DecimalType):
        scale = max(a.scale, b.scale)
        return t.DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
    if {type(a), type(b)} == {t.DateType, t.TimestampType}:
        return t.TimestampType()
    if {type(a), type(b)} == {t.DateType, t.TimestampNTZType}:
        return t.TimestampNTZType()
    if a in NUMBERS and b in NUMBERS:
        wide = NUMBERS[max(map(NUMBERS.index, (a, b)))]
        whole = NUMBERS.index(min(a, b, key=NUMBERS.index)) >= 2  # an int or a long: a float would round it
        return t.DoubleType() if isinstance(wide, t.FloatType) and whole else wide
    if all(isinstance(x, t.NumericType) for x in (a, b)):
        return t.DoubleType()
    return t.StringType()


def converted(value: Column, source: t.DataType, target: t.DataType) -> Column:
    """A column of type ``source`` as ``target``, one that :func:`promoted` gave."""
    if source == target:
        return value
    if isinstance(target, t.ArrayType):
        if not isinstance(source, t.ArrayType):
            return F.when(value.isNotNull(), F.array(converted(value, source, target.elementType)))
        return F.transform(value, lambda x: converted(x, source.elementType, target.elementType))
    if isinstance(target, t.StructType) and isinstance(source, t.StructType):
        parts = [
            converted(value.getField(f.name), source[f.name].dataType, f.dataType) if f.name in source.names else F.lit(None).cast(f.dataType)
            for f in target.fields
        ]
        return F.when(value.isNotNull(), F.struct(*[p.alias(f.name) for p, f in zip(parts, target.fields, strict=True)]))
    if isinstance(target, t.StringType) and isinstance(source, (t.StructType, t.MapType)):
        return F.to_json(value)
    return value.cast(target)


def _footer(path: str, content: bytes | None) -> str:
    """The Spark schema of a Parquet file as JSON. Spark's own description of it counts, if it is there."""
    if content is None:
        system, place = pa.fs.FileSystem.from_uri(path)
        found = pq.read_schema(place, filesystem=system)
    else:
        found = pq.read_schema(pa.BufferReader(content))
    own = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    return json.dumps(json.loads(own) if own else from_arrow_schema(found).jsonValue(), sort_keys=True)


def file_schemas(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(schema, files)``: the paths of the files that have a schema, as JSON. Read in tasks,
    footers alone; from file systems that only Spark opens, the whole files."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = listed.load([paths] if isinstance(paths, str) else list(paths)).filter("length > 0")
    schemes = [r[0] for r in files.select(F.lower(F.regexp_extract("path", "^([A-Za-z0-9+.-]+):", 1))).distinct().collect()]
    own = all(s in ("", "file", "s3", "gs", "hdfs") for s in schemes)  # those that Arrow opens
    content = F.lit(None).cast("binary") if own else F.col("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_footer(p, c) for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), batch.column(0)], ["schema", "path"])

    path = F.regexp_replace("path", "^file:/+", "file:///").alias("path")
    schemas = files.select(path, content.alias("content")).mapInArrow(read, "schema string, path string")
    return schemas.groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("files"))


def read_drifting(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet files below ``paths`` as one table, whatever types their columns have.

    A column that a file lacks is null there; :func:`promoted` says what becomes of types
    that differ. Columns stand in the order of the first schema that has them, schemas in
    the order of their first files. The list of paths passes the driver, as for any read of
    files; a damaged footer is an error.
    """
    groups = sorted(file_schemas(spark, paths).collect(), key=lambda r: r.files[0])
    if not groups:
        raise ValueError(f"no Parquet files below {paths}")
    schemas = [t.StructType.fromJson(json.loads(g["schema"])) for g in groups]
    names = list(dict.fromkeys(n for s in schemas for n in s.names))
    kinds = {n: reduce(promoted, [s[n].dataType for s in schemas if n in s.names]) for n in names}
    scans = []
    for group, schema in zip(groups, schemas, strict=True):
        table = spark.read.schema(schema).parquet(*group.files)
        scans.append(table.select(*[converted(F.col(f"`{n}`"), schema[n].dataType, kinds[n]).alias(n) for n in schema.names]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans).select(*[f"`{n}`" for n in names])
