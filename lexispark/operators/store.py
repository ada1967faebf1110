"""Versioned tables (S6): what a fit has made, kept so that a later session
can go on from it.

A version is a set of tables written to a folder of its own; one row in the
``commits`` table, written last, makes it readable.  A version whose writer
died before that row has no name and is never read, and a second attempt
writes to a new folder.  A row names the tables' folder, their schemas and the
caller's ``info``.  One writer at a time commits to a path; of two rows for
one version, the later counts."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMIT = "version long, at double, folder string, tables string, info string"


def _commits(spark: SparkSession, path: str) -> list:
    try:
        return spark.read.schema(COMMIT).parquet(f"{path}/commits").collect()  # one row a version
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions under ``path``, in order."""
    return sorted({r["version"] for r in _commits(spark, path)})


def commits(spark: SparkSession, path: str) -> list[tuple[int, dict, str]]:
    """(version, info, folder) of every committed version, in order."""
    last = {}
    for r in sorted(_commits(spark, path), key=lambda r: r["at"]):
        last[r["version"]] = (r["version"], json.loads(r["info"]), r["folder"])
    return [last[v] for v in sorted(last)]


def save_version(spark: SparkSession, path: str, tables: dict[str, DataFrame], info: dict | None = None,
                 version: int | None = None) -> int:
    """Writes ``tables`` and then commits them as ``version`` (the next one if
    not given)."""
    if version is None:
        version = max(versions(spark, path), default=-1) + 1
    folder = f"{path}/data/{version}-{uuid.uuid4().hex}"
    schemas = {}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
        schemas[name] = df.schema.jsonValue()
    row = (version, time.time(), folder, json.dumps(schemas), json.dumps(info or {}))
    spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return version


def load_version(spark: SparkSession, path: str, version: int | None = None) -> tuple[dict[str, DataFrame], dict]:
    """(tables, info) of a committed version, the last one if not given."""
    rows = [r for r in _commits(spark, path) if version is None or r["version"] == version]
    if not rows:
        raise ValueError(f"no committed version {'' if version is None else version} in {path}")
    r = max(rows, key=lambda r: (r["version"], r["at"]))
    tables = {name: spark.read.schema(T.StructType.fromJson(s)).parquet(f"{r['folder']}/{name}")
              for name, s in json.loads(r["tables"]).items()}
    return tables, json.loads(r["info"])
