"""Intermediate tables in the folder that all executors share.

A stage that is read more than once, or that ends a long lineage, is written
as Parquet below ``spark.checkpoint.dir``.  The folder is read from the
session; only where it is unset (tests on one machine) a local one is chosen.
A lost executor then costs a re-read, never a recomputation of the lineage.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_ROOTS: set[str] = set()
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of this session's intermediate tables."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file://{tempfile.gettempdir()}/lakeloom"
    root = f"{at.rstrip('/')}/lakeloom-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_drop, spark, root)
    return root


def _drop(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    path = f"{scratch_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _PATHS[out := df.sparkSession.read.schema(df.schema).parquet(path)] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more."""
    for t in tables:
        if path := _PATHS.pop(t, None):
            _drop(t.sparkSession, path)
