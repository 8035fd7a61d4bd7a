"""Stage tables: what a flow reads several times is written once, below the folder that the cluster shares."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local run gets a folder of its own; a cluster has no
    folder that all of it sees, so that is an error."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not given:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        given = known.get() if known.isDefined() else None
        if not given and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        given = given or tempfile.mkdtemp(prefix="parley-")
        spark.conf.set("spark.checkpoint.dir", given)
    return given


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path to it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    files, p = hadoop(spark, path)
    files.delete(p, True)


def input_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Changes with the names, sizes and times of the files below the paths."""
    found = []
    for path in paths:
        files, p = hadoop(spark, path)
        each = files.listFiles(p, True)
        while each.hasNext():
            f = each.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()[:16]


class Stages:
    """Tables of one run, or with a root and a fingerprint of configuration and input those that any run with both the
    same has written already."""

    def __init__(self, spark: SparkSession, root: str | None = None, fingerprint: str | None = None):
        if root and not fingerprint:
            raise ValueError("a root that is kept needs a fingerprint of configuration and input")
        self.spark, self.keep = spark, bool(root)
        self.root = f"{root}/{fingerprint}" if root else f"{shared_dir(spark).rstrip('/')}/stages-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        files, marker = hadoop(self.spark, f"{path}/_SUCCESS")
        if not (self.keep and files.exists(marker)):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        delete(self.spark, self.root)
