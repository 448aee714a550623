"""Written intermediates in the folder that the cluster shares."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def give_back() -> None:
    """Return memory that was freed to the system; a worker process outlives many stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. A folder of this machine only where none is set and all runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "cladeworks-checkpoints")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that Python stages run where it isn't installed."""
    context = spark.sparkContext
    if getattr(context, "_cladeworks_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / "cladeworks.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(target))
    context._cladeworks_shipped = True


def dealt(df: DataFrame) -> DataFrame:
    """Deal the rows of a small table out to all cores; larger ones are left as the scan splits them.

    Decided from the sizes of the files alone: nothing of the plan is run.
    """
    spark = df.sparkSession
    cores, leaves = spark.sparkContext.defaultParallelism, df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    conf = spark._jsparkSession.sessionState().conf()
    split = max(conf.filesOpenCostInBytes(), min(conf.filesMaxPartitionBytes(), size // cores))
    return df.repartition(cores) if size < split * cores and len(df.inputFiles()) < cores else df


def kept(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives a lost executor. options: the writer's."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cladeworks_path = path
    _FOLDERS.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return out


def remove(df: DataFrame) -> None:
    """Delete what `kept` wrote for a frame that nothing reads any more."""
    if path := getattr(df, "_cladeworks_path", None):
        _delete(df.sparkSession, path)


def remove_all(spark: SparkSession) -> None:
    """Delete all that `kept` wrote in this application, once the results that read it are written."""
    for path in _FOLDERS.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


_FOLDERS: dict[str, list[str]] = {}


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
