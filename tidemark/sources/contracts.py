"""Writes that are checked before they can be seen.

``SchemaContract`` is a stored schema that files have to meet before they are
appended: names, types and order are compared with the files' footers, so no row
is read to turn a batch down. ``VersionedTable`` replaces a table, schema and
all, by writing aside, verifying what was written, and only then moving one
small pointer; a reader has the old table or the new one, never half of either.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

REPORT = "batch string, accepted boolean, reason string"


def schema_problems(got: StructType, want: StructType) -> list[str]:
    """What keeps ``got`` from meeting ``want``: columns missing, not expected,
    of another type, or in another order."""
    have, need = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (got, want))
    out = [f"missing {c}" for c in need if c not in have] + [f"unexpected {c}" for c in have if c not in need]
    out += [f"{c} is {have[c]}, not {t}" for c, t in need.items() if c in have and have[c] != t]
    if not out and list(have) != list(need):
        out.append("columns in another order")
    return out


class SchemaContract:
    """A schema kept as one JSON text file under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def save(self, schema: StructType) -> SchemaContract:
        self.spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(self.path)
        return self

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.spark.read.text(self.path).first()["value"]))

    def problems(self, files: str) -> list[str]:
        """Of Parquet files: only footers are read."""
        return schema_problems(self.spark.read.parquet(files).schema, self.schema())

    def append(self, batches: Mapping[str, str], target: str) -> DataFrame:
        """Append the files of every batch (name -> folder) that meets the
        contract to ``target``; ``batch, accepted, reason`` of each."""
        rows, schema = [], self.schema()
        for name, files in batches.items():
            found = schema_problems(self.spark.read.parquet(files).schema, schema)
            if not found:
                self.spark.read.schema(schema).parquet(files).write.mode("append").parquet(target)
            rows.append((name, not found, "; ".join(found)))
        return self.spark.createDataFrame(rows, REPORT)


class WriteNotVerified(ValueError):
    """What a write left behind is not what was written."""


class VersionedTable:
    """A table at ``path``: one folder a version and a pointer to the current one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def version(self) -> int | None:
        """The version that readers see; None before the first one."""
        try:
            return self.spark.read.schema("version long").parquet(f"{self.path}/pointer").agg(F.max("version")).first()[0]
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    def read(self, version: int | None = None) -> DataFrame:
        now = self.version() if version is None else version
        if now is None:
            raise ValueError(f"nothing has been written to {self.path}")
        return self.spark.read.parquet(f"{self.path}/version={now}")

    def overwrite(self, df: DataFrame) -> int:
        """Replace rows and schema; returns the new version. Rows are counted as
        they are written and compared with the files' footers."""
        new, seen = (self.version() or 0) + 1, Observation()
        folder = f"{self.path}/version={new}"
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)     # a write that broke off is written over
        back = self.spark.read.parquet(folder)
        if schema_problems(back.schema, df.schema) or back.count() != seen.get["n"]:
            raise WriteNotVerified(f"{folder} does not hold what was written")
        self.spark.createDataFrame([(new,)], "version long").coalesce(1).write.mode("append").parquet(f"{self.path}/pointer")
        return new
