"""Session helpers: table loading and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import weakref
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``. A session on one machine
    that names none gets a temporary one; on a cluster that would be another folder on every
    machine, so that there the setting is required."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-screenloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_RUN = uuid.uuid4().hex


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; this driver's paths are removed when it ends."""
    root = f"{shared_dir(spark)}/screenloom-{_RUN}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_tidy, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


_ROOTS: set[str] = set()


def _tidy(spark: SparkSession, root: str) -> None:
    # The session may have ended before; then the folder's owner clears it.
    with contextlib.suppress(Exception):
        drop_path(spark, root)


def cut(df: DataFrame, name: str, partition_by: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, as ``schema`` where it is given: the
    plan restarts at the files, so an iteration neither grows its lineage nor depends on blocks
    that one executor holds. The write's own shuffles are deleted once it has ended."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _own_shuffles_end(df.sparkSession):
        writer.parquet(path)
    out = df.sparkSession.read.schema(schema or df.schema).parquet(path)
    _PATHS[id(out)] = (weakref.ref(out, lambda _, k=id(out): _PATHS.pop(k, None)), path)
    return out


@contextlib.contextmanager
def _own_shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffles of what runs in here when it ends, not when the driver happens to
    collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_PATHS: dict[int, tuple] = {}


def release(df: DataFrame) -> None:
    """Delete the table behind what ``cut`` returned, once nothing will read it any more, so that
    iterations keep only their last tables. Other DataFrames are left alone."""
    found = _PATHS.pop(id(df), None)
    if found and found[0]() is df:
        drop_path(df.sparkSession, found[1])


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through the cluster's file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
