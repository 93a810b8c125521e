"""Session-level helpers: session builder, shared storage and materialisation."""

from __future__ import annotations

import os
import re
import tempfile
import time
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "quillspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes.

    The time zone is pinned to UTC (timestamps are compared with an oracle),
    and adaptive execution with skew-join splitting is on.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` is the cluster's answer.  Where it is unset on a local
    master (tests, single-machine runs) a temporary folder is made and recorded in it;
    on a cluster that is an error, since executors would write to disks of their own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="quillspark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


class Stash:
    """Intermediate tables written to the shared folder to cut lineage.

    A lost executor then costs a re-read, not a re-computation of everything
    before.  ``drop`` removes tables that later steps no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/quillspark/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def put(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return it as read back."""
        path = f"{self.base}/{self.count:04d}"
        self.count += 1
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._quillspark_path = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._quillspark_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def clean_shared(spark: SparkSession, hours: float) -> list[str]:
    """Delete the tables that finished runs left in the shared folder, those last written ``hours`` ago or earlier; their paths.

    Results may read such tables, so nothing deletes them while a session works: call
    this where no result of that age is read any more, say from a daily job.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/quillspark")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for found in fs.listStatus(root) if fs.exists(root) else []:
        inner = [x.getModificationTime() for x in fs.listStatus(found.getPath())] if found.isDirectory() else []
        if max([found.getModificationTime(), *inner]) <= (time.time() - hours * 3600) * 1000:
            fs.delete(found.getPath(), True)
            gone.append(found.getPath().toString())
    return gone


def ship(spark: SparkSession) -> None:
    """Make the package importable for Python workers, once per application.

    Local masters inherit ``PYTHONPATH``; where that doesn't lead to the package, or
    executors are elsewhere, it goes to them as a zip by way of Spark's own files.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    known = os.path.dirname(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if getattr(sc, "_quillspark_shipped", False) or (sc.master.startswith("local") and known):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="quillspark-"), "quillspark.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._quillspark_shipped = True
