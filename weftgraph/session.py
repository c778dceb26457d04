"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that suit any size: runtime re-planning, skew splitting, UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: str = "8", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName("weftgraph")
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    return (
        b.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only in local mode where that is unset."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        found = sc._jsc.sc().getCheckpointDir()
        named = found.get() if found.isDefined() else None
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="weftgraph-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def tasks_for(df: DataFrame, mb: int = 8) -> int:
    """A task for each ``mb`` of the files that ``df`` reads, but as many as run at once at least.

    The planner merges the parts of a shuffle by their compressed bytes, so that few tasks get rows of many times that
    size in memory, and sort them; a number that follows the input holds a task's share down however large it is.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    known = sum(x for x in sizes if x < 1 << 50)  # what is no file may have a size that stands for unknown
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-known // (mb << 20)))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/weftgraph/{name}-{uuid.uuid4().hex}"
    _written(spark).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _written(spark: SparkSession) -> list[str]:
    """The folders that ``materialise`` has written in this application."""
    if not hasattr(spark.sparkContext, "_weftgraph_written"):
        spark.sparkContext._weftgraph_written = []
    return spark.sparkContext._weftgraph_written


def drop_written(spark: SparkSession, keep: DataFrame | None = None) -> None:
    """Delete what ``materialise`` has written, but for the files of ``keep``. Frames that read the rest can't be used
    afterwards, so call it when a run's result is written."""
    jvm = spark.sparkContext._jvm
    held = jvm.org.apache.hadoop.fs.Path
    files = [held(f).toUri().getPath() for f in keep.inputFiles()] if keep is not None else []
    left = []
    for path in _written(spark):
        p = held(path)
        if any(f.startswith(p.toUri().getPath() + "/") for f in files):
            left.append(path)
        else:
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    spark.sparkContext._weftgraph_written = left


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, unless their Python finds it on its path anyway."""
    root = Path(__file__).resolve().parent.parent
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if Path.cwd() == root or any(Path(p).resolve() == root for p in paths) or getattr(spark.sparkContext, "_weftgraph_sent", False):
        return
    to = Path(tempfile.mkdtemp(prefix="weftgraph-")) / "weftgraph.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted((root / "weftgraph").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(to))
    spark.sparkContext._weftgraph_sent = True
