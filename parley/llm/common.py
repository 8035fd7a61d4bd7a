"""What the operators of this subpackage share: written tables, safe column names, hashes of rows."""

from __future__ import annotations

import gc
import os
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stages import delete, shared_dir

#: The characters of `[\x20\x09-\x0D]`, the only white space the word and line contracts know.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Workspace:
    """Tables written below the shared folder, each read back with its lineage cut."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path, schema = f"{self.root}/{name}", df.schema
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, name: str) -> None:
        """Deletes a table of this workspace that nothing reads any more."""
        delete(self.spark, f"{self.root}/{name}")

    def release(self) -> None:
        """Lets Spark delete the shuffle files of rounds that are over: it does once their plans are garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Arrow batches of at most 16 MB, so that batches of long texts stay small in the Python workers, which also get
    this package's folder on their path (on a cluster it is installed or shipped with --py-files)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    env, root = spark.sparkContext.environment, str(Path(__file__).parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def hash128(*cols: Column) -> list[Column]:
    """Two 64-bit hashes of the columns with different seeds: `h1`, `h2`."""
    return [F.xxhash64(*cols).alias("h1"), F.xxhash64(F.lit(0x9E3779B9), *cols).alias("h2")]


LANE, MIX = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Of a lane of 8 bytes, those that belong to a span of so many more.
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def span_hashes(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes, by lanes of 8; `data` goes on for 8 bytes at least after the last span."""
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = sizes.astype(np.uint64) * MIX
    at, left, rows = starts, sizes, slice(None)
    while len(at):
        x = (lanes[at] & MASKS[np.minimum(left, 8)]) * LANE
        x ^= x >> np.uint64(32)
        h = (out[rows] ^ x) * MIX
        out[rows] = h ^ (h >> np.uint64(29))
        more = np.flatnonzero(left > 8)
        rows = more if isinstance(rows, slice) else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def spans(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, .. of sizes[0] numbers, then those from begin[1]."""
    return np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)
