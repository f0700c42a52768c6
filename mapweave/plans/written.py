"""Tables that several queries of a session share: written once to the cluster's shared folder, read afterwards."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, tuple[SparkSession, str]] = {}
_DONE: dict[tuple[str, str, str], DataFrame] = {}


def folder(spark: SparkSession) -> str:
    """A folder of this session's own below spark.checkpoint.dir; in local tests without that setting one of this machine."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _FOLDERS[app] = spark, f"{(root or tempfile.mkdtemp(prefix='mapweave-')).rstrip('/')}/shared-{uuid.uuid4().hex}"
    return _FOLDERS[app][1]


@atexit.register
def _clean() -> None:
    for spark, path in _FOLDERS.values():
        with contextlib.suppress(Exception):
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """build()'s rows, written when first asked for in this session."""
    key = spark.sparkContext.applicationId, sf_dir, name
    if key not in _DONE:
        path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
        rows = build()
        rows.write.parquet(path)
        _DONE[key] = spark.read.schema(rows.schema).parquet(path)
    return _DONE[key]
