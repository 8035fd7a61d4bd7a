"""SimHash near-dedup with multi-index hashing.

A fingerprint is cut into segments; two fingerprints within `radius` bits must, by the pigeonhole principle, lie
within a small Hamming ball of each other in some segment. The balls are enumerated as probe keys and matched with
the table of segments by an equi-join; whole distances are then checked. Fingerprints are first made distinct, so a
group of copies is one row whatever its size.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, python_ready, table
from .graph import components

SEED, SHINGLE, RADIUS, BITS, SEGMENTS = 42, 3, 2, 64, 2


def fingerprint(text: str | bytes | None, shingle: int = SHINGLE) -> int:
    """64 bits; each is set if it is in over half of the shingles' hashes. No words: 0."""
    if not text:
        return 0
    words = (text.encode() if isinstance(text, str) else text).lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words) - shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip((ends - lengths)[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


@F.arrow_udf(T.LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    found = np.array([fingerprint(x) for x in texts.cast(pa.binary()).to_pylist()], np.uint64)
    return pa.array(found.view(np.int64))


def radii(radius: int, segments: int) -> list[int]:
    """Of each segment's ball, -1 for none: together they hold radius + 1 places, so one must hold."""
    return [(radius + 1) // segments + (i < (radius + 1) % segments) - 1 for i in range(segments)]


def near_fingerprints(prints: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """`prints(fp)`, distinct -> `(a, b)`: each pair within `radius` bits once, a < b."""
    if segments < 2:
        raise ValueError("at least two segments")
    width = BITS // segments
    low = (1 << width) - 1
    cut = [F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit(low)) for i in range(segments)]
    balls = []
    for i, r in enumerate(radii(radius, segments)):
        if r >= 0:
            masks = [sum(1 << b for b in bits) for k in range(r + 1) for bits in combinations(range(width), k)]
            balls.append((i, F.array(*[F.lit(m).cast("long") for m in masks])))
    place = F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), cut[i].alias("key")) for i, _ in balls]))
    rows = prints.select(F.col("fp").alias("b"), place.alias("at")).select("at.seg", "at.key", "b")

    def ball(i, masks):
        return F.transform(masks, lambda mask: F.struct(F.lit(i).alias("seg"), cut[i].bitwiseXOR(mask).alias("key")))

    probes = F.concat(*[ball(i, masks) for i, masks in balls])
    probe = prints.select(F.col("fp").alias("a"), F.explode(probes).alias("at")).select("at.seg", "at.key", "a")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return probe.join(rows, ["seg", "key"]).filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """`doc_id, fp, component_id`, one row per row of `docs`; component_id is the smallest id reachable by links.

    Null, empty and blank texts have fingerprint 0, which links like any other. Null ids belong to groups but never
    name them; a group of null ids alone has a null component_id. Repeated rows stay rows. Other columns are not read.
    An empty table gives an empty result.
    """
    python_ready(docs.sparkSession)
    work = Workspace(docs.sparkSession, "simhash")
    marked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    marked = work.write(marked.select("doc_id", fingerprints("text").alias("fp")), "prints")
    classes = work.write(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    linked = components(work, near_fingerprints(classes.select("fp"), radius))
    named = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = work.write(named.join(least, "root").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def op9_simhash_dedup(spark, sf_dir):
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
