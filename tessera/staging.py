"""Staged intermediate tables in the folder that driver and executors share.

A staged table cuts the lineage: a lost executor costs the tasks it was running, not the
jobs that came before.  The folder is ``spark.checkpoint.dir``; only where a session on one
machine has none (tests) a folder of the driver is made and set.

Every staged table belongs to the scope that is open where it is made: one of
``temporary_tables``, which removes its tables at its end, or that of a query (``owned``), whose
tables stay until its result has been written and ``release`` is called.  Scopes belong to
their thread.  What nobody has released goes when the driver's process ends.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import tempfile
import threading
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCOPE: ContextVar[list[str] | None] = ContextVar("tables staged here", default=None)
_LEFT: dict[str, SparkSession] = {}
_LOCK = threading.Lock()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, always a URI without a trailing slash."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {master})")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path of its own for a staged table, in the open scope."""
    path = f"{shared_dir(spark)}/tessera/{label}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    with _LOCK:
        _LEFT[path] = spark
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one staged table, whatever store it is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    with _LOCK:
        _LEFT.pop(path, None)


@contextlib.contextmanager
def temporary_tables(spark: SparkSession):
    """Staged tables made inside, by this thread, are removed at the end; results must have been written or collected by then."""
    paths: list[str] = []
    before = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(before)
        for path in paths:
            remove(spark, path)


def owned(query):
    """``query(spark, ...)`` with a scope of its own: ``release`` of its result removes what it has staged, and a failure does at once."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args, **kwargs) -> DataFrame:
        outer, paths = _SCOPE.get(), []
        before = _SCOPE.set(paths)
        try:
            result = query(spark, *args, **kwargs)
        except BaseException:
            for path in paths:
                remove(spark, path)
            raise
        finally:
            _SCOPE.reset(before)
        if outer is not None:  # of a query or scope that this one is part of
            outer.extend(paths)
        result._staged = paths
        return result

    return run


def release(result: DataFrame) -> None:
    """Remove what the query of this result has staged; the result must have been written or collected."""
    for path in getattr(result, "_staged", ()):
        remove(result.sparkSession, path)


@atexit.register
def _at_exit() -> None:
    for path, spark in list(_LEFT.items()):
        with contextlib.suppress(Exception):  # the session may be gone already
            remove(spark, path)
