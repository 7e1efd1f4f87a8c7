"""Shipping the package to Python workers, and the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one broadcast at most; larger sides take the shuffled path.
BROADCAST_ROWS = 1_000_000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_sluicework_shipped", False):
        return
    top = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="sluicework-")  # the driver serves the file for as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "sluicework.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(archive)
    sc._sluicework_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; a temporary one only in local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not hasattr(sc, "_sluicework_dir"):
            sc._sluicework_dir = tempfile.mkdtemp(prefix="sluicework-")
            atexit.register(shutil.rmtree, sc._sluicework_dir, ignore_errors=True)
        folder = sc._sluicework_dir
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(folder)
    return folder


_TEMPORARY: list[str] = []


@atexit.register
def _clean() -> None:
    """The temporary paths of this application go when it ends; a killed one leaves its own."""
    gateway = SparkContext._gateway
    with contextlib.suppress(Exception):
        conf = gateway.jvm.org.apache.hadoop.conf.Configuration()
        for path in _TEMPORARY:
            p = gateway.jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _TEMPORARY.append(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and stored in the shared folder, so that later jobs and lost executors don't recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def placed(rows: DataFrame) -> DataFrame:
    """Ordered rows, stored, with their place from 1 on, which is read off the ranges of their sort: no task sees them all."""
    held = cut(rows.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = held.groupBy(part.alias("_part")).count().withColumn("_first", F.sum("count").over(Window.orderBy("_part")) - F.col("count"))  # a row for each range
    all_ = held.withColumn("_part", part).join(F.broadcast(sizes), "_part")
    return all_.select(*rows.columns, (F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("place"))


def sweep(spark: SparkSession) -> None:
    """Shuffle files and checkpoints that nothing refers to any more go now, not when the driver happens to collect its garbage.

    Spark deletes them when the driver's own references are collected, and has
    no other call for it; executors aren't touched.
    """
    gc.collect()
    spark._jvm.System.gc()


def small(df: DataFrame) -> DataFrame:
    """df marked for broadcast if its rows are few enough; it is counted, so it should be stored."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: Rows of a side that side() broadcasts at most.
SIDE_ROWS = 100_000


def side(df: DataFrame, rows: int) -> DataFrame:
    """A side of a join, of so many rows: broadcast if they are few, else shuffled.

    The planner guesses bytes from those of the files below, without what an
    explode or a longer text adds, and would send millions of rows to each
    executor whole.
    """
    return F.broadcast(df) if rows <= SIDE_ROWS else df.hint("merge")


class Files:
    """Files of one folder through the cluster's file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark._jvm
        self.folder = folder.rstrip("/")
        top = self.jvm.org.apache.hadoop.fs.Path(self.folder)
        self.fs = top.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str = "") -> list[str]:
        """Names in a subfolder, sorted; none if it isn't there."""
        p = self._path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole file appears at once: it is written under another name and renamed."""
        part = self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(part)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self.fs.rename(part, self._path(name)):
            self.fs.delete(part, False)
            raise OSError(f"{name} is there already")

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
