"""File sources and sinks: format round trips, schema evolution and
enforcement, message-payload parsing, ingest provenance, partitioned and
bucketed writes, create-table-as-select.

All writes go under the shared checkpoint root (``scratch_path``) unless a
path is given; reads use explicit schemas where the format would otherwise
infer (inference scans the data once more and can change types).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import scratch_path


# JSON/CSV text keeps microseconds only with an explicit pattern (the default
# writes milliseconds and would silently truncate).
MICROS_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


class SchemaMismatch(ValueError):
    pass


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
         **options) -> DataFrame:
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
          partition_by: Sequence[str] = (), **options) -> str:
    w = df.write.format(fmt).mode(mode)
    for k, v in options.items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def roundtrip(df: DataFrame, fmt: str, name: str, schema: StructType | None = None,
              write_options: dict | None = None, read_options: dict | None = None) -> DataFrame:
    """Write ``df`` in ``fmt`` and read it back (the format's reader and writer)."""
    path = scratch_path(df.sparkSession, name)
    write(df, path, fmt, **(write_options or {}))
    return read(df.sparkSession, path, fmt, schema, **(read_options or {}))


def enforce_schema(df: DataFrame, expected: StructType) -> DataFrame:
    """Raise before any action when names or types differ from ``expected``."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    exp = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    if got != exp:
        missing = sorted(set(exp) - set(got))
        extra = sorted(set(got) - set(exp))
        raise SchemaMismatch(f"schema mismatch: missing {missing}, unexpected {extra}")
    return df


def union_evolving(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing from a frame are NULL (added columns)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def parse_messages(df: DataFrame, schema: StructType | str, key: str = "key", value: str = "value") -> DataFrame:
    """Binary key/value messages -> string key + the JSON payload's fields."""
    return (df.select(F.col(key).cast("string").alias("message_key"),
                      F.from_json(F.col(value).cast("string"), schema,
                                  {"timestampNTZFormat": MICROS_NTZ}).alias("data"))
            .select("message_key", "data.*"))


def with_provenance(df: DataFrame, ingest_time: bool = True) -> DataFrame:
    """Source file path and name per row (file metadata column) and the
    ingestion time."""
    out = df.withColumns({"source_file": F.col("_metadata.file_path"),
                          "source_file_name": F.col("_metadata.file_name")})
    if ingest_time:
        out = out.withColumn("ingested_at", F.current_timestamp())
    return out


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str,
                   sort: str | None = None) -> None:
    """``bucketBy(n, key).sortBy(key)`` table: joins of two such tables on the
    key need no shuffle."""
    w = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key)
    if sort:
        w = w.sortBy(sort)
    w.saveAsTable(table)


def ctas(df: DataFrame, table: str, path: str) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS SELECT (external table at ``path``)."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def append_metrics(spark: SparkSession, metrics: dict, path: str) -> DataFrame:
    """Append one metrics row (a run's observed counts) to a log table."""
    row = spark.createDataFrame([metrics])
    row.write.mode("append").parquet(path)
    return spark.read.parquet(path)
