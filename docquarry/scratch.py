"""Shared working storage and code shipping for jobs that must survive lost executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: dict[str, str] = {}
_DOOMED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only in local mode, where
    one machine is all there is, a folder of our own is made where it is unset.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="docquarry-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one; it goes when the application ends."""
    path = f"{shared_dir(spark)}/docquarry-{spark.sparkContext.applicationId}"
    if path not in _DOOMED:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = place.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(place)
        store.deleteOnExit(place)
        _DOOMED.add(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage at a table that outlives any executor. Unlike
    ``checkpoint()`` it runs the plan a single time.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="docquarry-code-"), "docquarry.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*")):
            if p.is_file() and "__pycache__" not in p.parts:
                z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(target)
    _SHIPPED[app] = target
