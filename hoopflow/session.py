"""Session helpers: a tuned local session, table reading and lineage cuts that survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hoopflow")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; a temporary one only where none is set and the master is local."""
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="hoopflow-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Materialises a frame in the shared checkpoint folder, so later stages neither recompute it nor lose it with an executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for written state inside the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable in the executors' Python workers, wherever they run; once per context."""
    context = spark.sparkContext
    if getattr(context, "_hoopflow_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="hoopflow-code-")) / "hoopflow.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._hoopflow_shipped = True
    return spark
