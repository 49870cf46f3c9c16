"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def local_session(cores: int = 8, name: str = "wearlens") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own.

    Where nothing names a shared folder, this local session takes one of this machine.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wearlens-"))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else the context's; executors must see it, so nothing else will do."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named


def _path(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in whatever store Spark reads."""
    store, path = _path(spark, pattern)
    return [str(f.getPath().toString()) for f in store.globStatus(path) or []]


def remove(spark: SparkSession, path: str) -> None:
    store, path = _path(spark, path)
    store.delete(path, True)


def publish(spark: SparkSession, text: str, path: str) -> bool:
    """Make ``path`` appear with its whole text; False, and nothing changed, where it exists."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    store, final = _path(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    out = store.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # none: an existing file is not replaced
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(store.makeQualified(aside), store.makeQualified(final), options)
    except Py4JJavaError as error:
        store.delete(aside, False)
        if store.exists(final):
            return False
        raise error
    return True


def new_folder(spark: SparkSession, purpose: str) -> str:
    return os.path.join(shared_folder(spark), f"{purpose}-{uuid.uuid4().hex}")
