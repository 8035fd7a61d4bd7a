"""Connected components of a table of links, by alternating large-star and small-star rounds.

Nothing is collected: each round is two aggregations and two joins over the links, written to the shared folder. A
hub's links are rows like any other and its joins can be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace

ROUNDS = 60


def components(work: Workspace, links: DataFrame) -> DataFrame:
    """`links(a, b)` -> `(node, root)` for each node with a link; root is the smallest node it reaches.

    Self links, repeated links and either direction are allowed; null ends are not links. No links give no rows.
    """
    ends = links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    stars, mark = work.write(ends.distinct(), "stars0"), None
    for k in range(1, ROUNDS):
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(stars.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = work.write(small.unionAll(root.select("hi", F.col("m").alias("lo"))).distinct(), f"stars{k}")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        work.drop(f"stars{k - 1}")
        stars = now
        if state == mark or not state[0]:
            break
        mark = state
    else:
        raise RuntimeError(f"components are not found after {ROUNDS} rounds")
    roots = stars.select("lo").distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(roots.select("lo", "lo"))
