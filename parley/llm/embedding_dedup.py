"""Embedding near-dedup by NN-descent.

Vectors that are the same are one point. A neighbour graph is refined over the points; a list is enlarged, up to MOST,
by what is at least as near as the threshold. Links that hold in double precision on the vectors give components.
A link can be lost to MOST only if the lists of both its ends are full, so the points of full lists are compared with
each other whole: they are gathered in balls around a neighbour, balls are held against each other in blocks, and where
two components' balls are near enough to hold a link their members are compared.
Recall is audited: in each turn another sample of points, larger for larger tables, is held against all points in blocks,
and if that finds a link between two components the lists are enlarged and refined again. What an audit has found is
not given to the next turn's lists, but it is in the result. If the last audit still finds a link, all points are
compared as those of full lists are, which is exact and takes time by the square of the number of balls. All links lie within components, so each point's links are at last
counted there: lists that were too short are enlarged to their whole component, in blocks of MEMBERS points, without
making a row for a pair.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import dot
from .common import Workspace, table
from .graph import components
from .neighbours import Graph, arrow, matrix, usable

LEAST, K, MOST, ROUNDS = 0.9, 16, 48, 3
AUDIT, AUDITS, MEMBERS = 512, 2, 1024
MARGIN, BALL = 0.02, 0.96


def unit(v):
    n = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: x / n)


def links_of(graph: Graph, points: DataFrame, least: float) -> DataFrame:
    """`a, b`, a < b: pairs of the lists whose cosine is at least that, in double precision."""
    near = graph.nodes.select("id", F.explode(F.arrays_zip("ids", "sims")).alias("l")).filter(F.col("l.sims") >= least - MARGIN)
    pairs = near.select(F.least("id", "l.ids").alias("a"), F.greatest("id", "l.ids").alias("b")).distinct()
    pairs = pairs.join(points.select(F.col("id").alias("a"), F.col("u").alias("ua")), "a").join(points.select(F.col("id").alias("b"), F.col("u").alias("ub")), "b")
    return pairs.filter(dot(F.col("ua"), F.col("ub")) >= least).select("a", "b")


def audit(points: DataFrame, sample: list, least: float) -> DataFrame:
    """`a, b`: the links of the sample with all points."""
    ids = np.array([r["id"] for r in sample], np.int64)
    m = np.array([r["u"] for r in sample])

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for at in range(0, t.num_rows, 512):
                part = t.slice(at, 512)
                i, j = np.nonzero(matrix(part.column("u")) @ m.T >= least)
                yield pa.record_batch([pa.array(part.column("id").to_numpy()[i]), pa.array(ids[j])], names=["a", "b"])

    return points.select("id", "u").mapInArrow(run, "a long, b long").filter("a <> b")


def full_lists(graph: Graph) -> DataFrame:
    """Nodes whose lists may have lost links: as long as they may be, and the last one still near enough."""
    return graph.nodes.filter((F.size("sims") >= graph.most) & (F.element_at("sims", -1) >= graph.above))


def dealt(rows: DataFrame, parts, key: str, same: list[str]) -> DataFrame:
    """Rows in `parts` parts by a hash of `key` -> each pair of parts of the same columns as `i, j, left`, in which the
    left part has its rows with `left` and the right part its own; a part with itself has its rows on both sides."""
    rows = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64(key), F.col("parts")).cast("int"))
    spread = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    one = spread.select(*same, F.col("part").alias("i"), F.col("other").alias("j"), F.lit(True).alias("left"))
    two = spread.select(*same, F.col("other").alias("i"), F.col("part").alias("j"), F.lit(False).alias("left"))
    return one.unionAll(two)


def near_balls(least: float):
    """Balls on the left and on the right -> pairs of different components whose members may be linked, by the
    triangle inequality of angles."""

    def run(rows: pa.Table) -> pa.Table:
        left, u = rows.column("left").to_numpy(zero_copy_only=False), matrix(rows.column("u"))
        leader, root, wide = (rows.column(c).to_numpy() for c in ("leader", "root", "wide"))
        a, b, out = np.flatnonzero(left), np.flatnonzero(~left), []
        for at in range(0, len(a), 256):
            x = a[at : at + 256]
            angle = np.arccos(np.clip(u[x] @ u[b].T, -1, 1))
            i, j = np.nonzero((angle <= np.arccos(least) + wide[x, None] + wide[None, b] + 1e-6) & (root[x, None] < root[None, b]))
            out.append((x[i], b[j]))
        i, j = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int))
        return pa.table([leader[i], root[i], leader[j], root[j]], names=["l1", "r1", "l2", "r2"])

    return run


def nearest_pair(least: float):
    """Members of two balls -> one link between them, if there is one."""

    def run(rows: pa.Table) -> pa.Table:
        left, u, ids = rows.column("left").to_numpy(zero_copy_only=False), matrix(rows.column("u")), rows.column("id").to_numpy()
        a, b = np.flatnonzero(left), np.flatnonzero(~left)
        top, found = -2.0, ([], [])
        for at in range(0, len(a) if len(b) else 0, 1024):
            s = u[a[at : at + 1024]] @ u[b].T
            if s.max() >= max(least, top):
                i, j = np.unravel_index(s.argmax(), s.shape)
                top, found = s.max(), ([ids[a[at + i]]], [ids[b[j]]])
        return pa.table([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

    return run


def bridges(work: Workspace, nodes: DataFrame, points: DataFrame, roots: DataFrame, least: float, name: str) -> DataFrame:
    """`a, b`: links between components, at least one for each two that are linked by points of `nodes`; exact."""
    u, own = points.select("id", "u"), roots.withColumnRenamed("node", "id")
    close = F.filter(F.arrays_zip("ids", "sims"), lambda l: l["sims"] >= BALL)
    ranked = F.transform(F.concat(F.array("id"), F.transform(close, lambda l: l["ids"])), lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("leader")))
    balls = nodes.select("id", F.array_min(ranked)["leader"].alias("leader")).join(u, "id").join(own, "id", "left")
    balls = balls.join(u.select(F.col("id").alias("leader"), F.col("u").alias("c")), "leader")
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(F.col("u"), F.col("c")))))
    balls = work.write(balls.select("id", "leader", F.coalesce("root", "id").alias("root"), "u", "c", angle.alias("angle")), f"balls{name}")
    heads = balls.groupBy("leader", "root").agg(F.max("angle").alias("wide"), F.count("*").alias("size"))
    heads = work.write(heads.join(u.withColumnRenamed("id", "leader"), "leader"), f"heads{name}")
    parts = F.lit(max(1, -(-heads.count() // MEMBERS)))
    both = dealt(heads, parts, "leader", ["leader", "root", "wide", "u"])
    near = work.write(both.groupBy("i", "j").applyInArrow(arrow(near_balls(least)), "l1 long, r1 long, l2 long, r2 long"), f"near{name}")
    # the members of the two balls of each pair, in parts of MEMBERS
    sizes, pair = heads.select("leader", "root", F.ceil(F.col("size") / MEMBERS).cast("int").alias("parts")), ["l1", "r1", "l2", "r2"]
    near = near.join(sizes.toDF("l1", "r1", "n1"), ["l1", "r1"]).join(sizes.toDF("l2", "r2", "n2"), ["l2", "r2"])
    m = balls.select("leader", "root", "id", "u")
    one = near.join(m.toDF("l1", "r1", "id", "u"), ["l1", "r1"]).select(*pair, F.pmod(F.xxhash64("id"), "n1").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n2") - F.lit(1).cast("long"))).alias("j"), F.lit(True).alias("left"), "id", "u")
    two = near.join(m.toDF("l2", "r2", "id", "u"), ["l2", "r2"]).select(*pair, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n1") - F.lit(1).cast("long"))).alias("i"), F.pmod(F.xxhash64("id"), "n2").alias("j"), F.lit(False).alias("left"), "id", "u")
    return work.write(one.unionAll(two).groupBy(*pair, "i", "j").applyInArrow(arrow(nearest_pair(least)), "a long, b long"), f"bridges{name}")


COUNTS = "id long, n long"


def counted(least: float):
    """Members of components, on the left side and the right -> for each left one how many rows on the right are linked."""

    def run(rows: pa.Table) -> pa.Table:
        root, left = rows.column("root").to_numpy(), rows.column("left").to_numpy(zero_copy_only=False)
        ids, times, u = rows.column("id").to_numpy(), rows.column("times").to_numpy(), matrix(rows.column("u"))
        order = np.lexsort((~left, root))
        root, left, ids, times, u = root[order], left[order], ids[order], times[order], u[order]
        cuts = [0, *(np.flatnonzero(np.diff(root)) + 1).tolist(), len(root)]
        out_ids, out_n = [], []
        for a, b in zip(cuts, cuts[1:], strict=False):
            mid = a + int(left[a:b].sum())
            near = (u[a:mid] @ u[mid:b].T >= least) & (ids[a:mid, None] != ids[None, mid:b])
            out_ids.append(ids[a:mid])
            out_n.append(near @ times[mid:b])
        return pa.table([pa.array(np.concatenate(out_ids)), pa.array(np.concatenate(out_n).astype(np.int64))], names=["id", "n"])

    return run


def link_counts(members: DataFrame, least: float) -> DataFrame:
    """`members(id, root, times, u)` -> `id, n`: rows linked with each, over its component; copies count `times`."""
    sizes = members.groupBy("root").agg(F.count("*").alias("size"))
    rows = members.join(sizes, "root").withColumn("parts", F.ceil(F.col("size") / MEMBERS).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # components of one part share tasks; larger ones get one for each pair of parts
    rows = rows.withColumn("pile", F.when(F.col("parts") == 1, F.pmod(F.xxhash64("root"), F.lit(256))).otherwise(F.col("root")))
    spread = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    one = rows.select("*", spread.alias("other")).select("pile", F.col("parts") == 1, F.col("part").alias("i"), F.col("other").alias("j"), F.lit(True).alias("left"), "root", "id", "times", "u")
    two = rows.select("*", spread.alias("other")).select("pile", F.col("parts") == 1, F.col("other").alias("i"), F.col("part").alias("j"), F.lit(False).alias("left"), "root", "id", "times", "u")
    both = one.unionAll(two).toDF("pile", "small", "i", "j", "left", "root", "id", "times", "u")
    return both.groupBy("pile", "small", "i", "j").applyInArrow(arrow(counted(least)), COUNTS).groupBy("id").agg(F.sum("n").alias("n"))


def dedup_embeddings(vectors: DataFrame, least: float = LEAST, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`vec_id, n_links, component_id, kept`, one row for each row of `vectors`.

    Vectors that usable() leaves out link with nothing. A null id takes no part: no links, null component, not kept.
    Of rows that repeat an id the least vector counts, and all get its result. An empty table gives an empty result. Other
    columns are not read.
    """
    work = Workspace(vectors.sparkSession, "embeddings")
    good = work.write(usable(vectors, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v")), "good")
    classes = good.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("times"))
    points = work.write(classes.select("id", "times", "v", unit(F.col("v")).alias("u")), "points")
    of = good.join(points.select("v", F.col("id").alias("point")), "v").select("id", "point")
    size = max(AUDIT, 2 * math.isqrt(points.count()))
    known = []
    for turn in range(AUDITS + 1):
        grow = 1 << turn
        graph = Graph(Workspace(vectors.sparkSession, "descent"), points, k * grow, above=least - MARGIN, most=MOST * grow)
        graph.refine(ROUNDS)
        links = work.write(links_of(graph, points, least), f"links{turn}")
        roots = work.write(components(work, links), f"roots{turn}")
        full = work.write(full_lists(graph).select("id", "ids", "sims"), f"full{turn}")
        if not full.isEmpty():
            links = links.unionAll(bridges(work, full, points, roots, least, str(turn)))
            roots = work.write(components(work, links), f"joined{turn}")
        known.append(links)
        sample = points.orderBy(F.xxhash64(F.lit(turn), "id"), "id").limit(size).select("id", "u").collect()
        found = audit(points, sample, least).join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
        found = found.join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
        missed = work.write(found.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"), f"missed{turn}")
        clean = missed.isEmpty()
        if clean:
            break
        known.append(missed)
    if len(known) > 1:
        links = reduce(DataFrame.unionAll, known)
        roots = work.write(components(work, links), "known")
        if not clean:
            every = bridges(work, graph.nodes.select("id", "ids", "sims"), points, roots, least, "all")
            roots = work.write(components(work, links.unionAll(every)), "whole")
    members = points.join(roots.withColumnRenamed("node", "id"), "id").select("id", "root", "times", "u")
    n = work.write(link_counts(members, least), "counts")
    result = points.select("id", "times").join(n, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    result = result.select(F.col("id").alias("point"), (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    each = work.write(of.join(result, "point").select("id", "n_links", "component_id"), "each")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id")).join(each.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    rows = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op8_embedding_dedup(spark, sf_dir):
    return dedup_embeddings(table(spark, sf_dir, "embeddings"))
