"""What a session needs before Python functions run on executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession | None = None) -> None:
    """Send this package to the executors, once per application.

    Executors of a cluster don't have the driver's files; ``addPyFile`` serves the zip to
    each of them, also to those that replace a lost one.
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None or getattr(spark.sparkContext, "_lodegrain_shipped", False):
        return
    root = os.path.dirname(_PACKAGE)
    path = os.path.join(tempfile.mkdtemp(prefix="lodegrain"), "lodegrain_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._lodegrain_shipped = True


def _file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> bool:
    """A small file in any store; false if it is there and must not be overwritten."""
    fs, target = _file(spark, path)
    if not overwrite and fs.exists(target):
        return False
    try:
        out = fs.create(target, overwrite)
    except Exception as e:
        if "exist" not in str(e).lower():
            raise
        return False
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is no such file."""
    fs, target = _file(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder, sorted; nothing if there is no such folder."""
    fs, target = _file(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(target)) if fs.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file(spark, path)
    fs.delete(target, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the folder that all executors share, removed when the application ends."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodegrain-scratch")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    fs, target = _file(spark, path)
    fs.deleteOnExit(target)
    return path
