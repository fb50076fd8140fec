"""Session helpers shared by all plans: table reading, lineage cuts and shipping of the package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table `name` of `folder` (a file or a directory of part files)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Session setting: whether inputs with fewer splits than the session has cores are spread over all cores before costly work per row (default true).
SPREAD = "spark.dotledger.spread"


def spread(df: DataFrame) -> DataFrame:
    """`df` on all cores if its scan has fewer partitions than there are cores, as with one small file; else unchanged.

    Rows and results are the same either way; an input with at least as many splits as cores gets no exchange. ``SPREAD`` set to false
    leaves every scan as it is.
    """
    spark = df.sparkSession
    if spark.conf.get(SPREAD, "true").lower() == "false":
        return df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable folder for lineage cuts.

    The cluster's ``spark.checkpoint.dir`` (shared by all executors) is used as it is. Only a session without one, such as a
    local test, gets a folder of its own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if configured is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="dotledger-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and read it back, so that later stages don't recompute it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    A local master shares the driver's files; elsewhere the package is sent once per application as a zip.
    """
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or getattr(sc, "_dotledger_shipped", False):
        return
    handle, name = tempfile.mkstemp(prefix="dotledger-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, Path(_PACKAGE.name, p.relative_to(_PACKAGE)))
    sc.addPyFile(name)
    sc._dotledger_shipped = True
