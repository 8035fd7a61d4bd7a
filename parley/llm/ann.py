"""Approximate nearest neighbours: greedy search in an NN-descent graph.

Vectors that are the same are one point of the graph, whatever their number. Queries are points of the index; a query
starts from its own list, and in each round those of its best points that it has not visited yet are expanded: the query's
code goes to their blocks, where the codes of all their neighbours are, and the nearest come back. A query ends when its
BEAM best points are all visited, the search when all queries have ended; the graph's messages are written once, and
only those to points that are asked are sent again. What is nearest by codes is measured again on the original vectors. Vectors of different norms are put into bands in which norms differ by a
factor of at most root 2, so that the component which brings a band to one norm never outweighs the others: a large band
has a graph, which each query enters by the nearest of a sample, and the points of small ones are all compared.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Workspace, table
from .neighbours import NONE, Graph, arrow2, block_of, codes_of, matrix, usable

K, ROUNDS, TOP = 48, 4, 20
HOPS, BEAM, POOL, AGAIN = 100, 96, 256, 160
FEW, DOORS, PART = 1 << 14, 1024, 4096
POOLS = "block int, q long, id long, score float, open boolean"
REQUESTS = "block int, id long, q long, code binary"


def pool_table(blocks, q, ids, scores, is_open) -> pa.Table:
    columns = pa.array(block_of(q, blocks)), pa.array(q, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float32()), pa.array(is_open, pa.bool_())
    return pa.table(list(columns), names=["block", "q", "id", "score", "open"])


def ranked(q: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Rank of each row in its q by key, largest first."""
    order = np.lexsort((-key, q))
    rank = np.empty(len(q), np.int64)
    rank[order] = np.arange(len(q)) - np.searchsorted(q[order], q[order])
    return rank


def chosen(pool: pa.Table, beam: int) -> np.ndarray:
    """Rows to expand next: the open ones among each query's best."""
    q, score = pool.column("q").to_numpy(), pool.column("score").to_numpy()
    return pool.column("open").to_numpy(zero_copy_only=False) & (ranked(q, score) < beam)


def ask(blocks: int, beam: int):
    def run(queries: pa.Table, pool: pa.Table) -> pa.Table:
        at = np.flatnonzero(chosen(pool, beam)) if pool.num_rows else np.zeros(0, np.int64)
        ids, q = (pool.column(c).to_numpy()[at] if len(at) else np.zeros(0, np.int64) for c in ("id", "q"))
        own = queries.column("id").to_numpy() if queries.num_rows else np.zeros(0, np.int64)
        order = np.argsort(own)
        where = order[np.searchsorted(own[order], q)] if len(q) else np.zeros(0, np.int64)
        codes = queries.column("code").take(pa.array(where)).combine_chunks()
        codes = codes if isinstance(codes, pa.Array) else pa.concat_arrays([*codes.chunks, pa.array([], pa.binary())])
        return pa.table([pa.array(block_of(ids, blocks)), pa.array(ids), pa.array(q), codes], names=["block", "id", "q", "code"])

    return run


def answer(blocks: int, pool_size: int):
    def run(messages: pa.Table, requests: pa.Table) -> pa.Table:
        if not messages.num_rows or not requests.num_rows:
            return pool_table(blocks, *NONE, np.zeros(0, bool))
        to = messages.column("to").to_numpy()
        order = np.argsort(to, kind="stable")
        to, near = to[order], messages.column("id").to_numpy()[order]
        codes = codes_of(messages.column("code").take(pa.array(order)).to_pylist())
        want = requests.column("id").to_numpy()
        turn = np.argsort(want, kind="stable")
        want, q = want[turn], requests.column("q").to_numpy()[turn]
        vectors = codes_of(requests.column("code").take(pa.array(turn)).to_pylist())
        cuts = [0, *(np.flatnonzero(np.diff(want)) + 1).tolist(), len(want)]
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            lo, hi = np.searchsorted(to, want[a], "left"), np.searchsorted(to, want[a], "right")
            if hi > lo:
                s = vectors[a:b] @ codes[lo:hi].T
                out.append((np.repeat(q[a:b], hi - lo), np.tile(near[lo:hi], b - a), s.ravel()))
        if not out:
            return pool_table(blocks, *NONE, np.zeros(0, bool))
        q, ids, s = (np.concatenate(x) for x in zip(*out, strict=True))
        keep = ranked(q, s) < pool_size
        return pool_table(blocks, q[keep], ids[keep], s[keep], np.ones(keep.sum(), bool))

    return run


def take_in(blocks: int, beam: int, pool_size: int):
    def run(pool: pa.Table, found: pa.Table) -> pa.Table:
        parts = []
        if pool.num_rows:
            is_open = pool.column("open").to_numpy(zero_copy_only=False) & ~chosen(pool, beam)
            parts.append((*(pool.column(c).to_numpy() for c in ("q", "id", "score")), is_open))
        if found.num_rows:
            parts.append(tuple(found.column(c).to_numpy(zero_copy_only=False) for c in ("q", "id", "score", "open")))
        q, ids, s, is_open = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((is_open, ids, q))  # visited before found again
        q, ids, s, is_open = q[order], ids[order], s[order], is_open[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
        new &= q != ids
        q, ids, s, is_open = q[new], ids[new], s[new], is_open[new]
        keep = ranked(q, s) < pool_size
        return pool_table(blocks, q[keep], ids[keep], s[keep], is_open[keep])

    return run


def search(work: Workspace, graph: Graph, codes: DataFrame, pool: DataFrame, hops: int = HOPS, beam: int = BEAM, pool_size: int = POOL) -> DataFrame:
    """`codes(block, id, code)` of queries and the POOLS they start from -> `q, id, score`: near points by their codes,
    at most pool_size for each."""
    pool, messages = work.write(pool, "pool0"), work.write(graph.messages(), "messages")
    for hop in range(hops):
        requests = codes.groupBy("block").cogroup(pool.groupBy("block")).applyInArrow(arrow2(ask(graph.blocks, beam)), REQUESTS)
        requests = work.write(requests, f"requests{hop}")
        if requests.isEmpty():
            return pool.select("q", "id", "score")
        sent = messages.join(requests.select(F.col("id").alias("to")).distinct(), "to", "left_semi")
        found = sent.groupBy("block").cogroup(requests.groupBy("block")).applyInArrow(arrow2(answer(graph.blocks, pool_size)), POOLS)
        pool = pool.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(arrow2(take_in(graph.blocks, beam, pool_size)), POOLS)
        pool = work.write(pool, f"pool{hop + 1}")
        work.release()
    raise RuntimeError(f"the search has not ended after {hops} hops")


def search_own(work: Workspace, graph: Graph, points: DataFrame) -> DataFrame:
    """search() for points of the graph, from their own lists."""
    queries = work.write(graph.nodes.join(points, "id", "left_semi"), "queries")
    near = queries.select("block", F.col("id").alias("q"), F.explode(F.arrays_zip("ids", "sims")).alias("l"))
    pool = near.select("block", "q", F.col("l.ids").alias("id"), F.col("l.sims").alias("score"), F.lit(True).alias("open"))
    return search(work, graph, queries.select("block", "id", "code"), pool)


def doors(blocks: int, beam: int, ids: np.ndarray, m: np.ndarray):
    """Queries `id, v` -> the nearest of the sample, to start from."""

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for at in range(0, t.num_rows, 512):
                part = t.slice(at, 512)
                v, q = matrix(part.column("v")), part.column("id").to_numpy()
                s = v / np.linalg.norm(v, axis=1, keepdims=True) @ m.T
                n = min(beam, len(ids))
                near = np.argpartition(-s, n - 1, axis=1)[:, :n]
                out = pool_table(blocks, np.repeat(q, n), ids[near].ravel(), np.take_along_axis(s, near, 1).ravel(), np.ones(n * len(q), bool))
                yield from out.to_batches()

    return run


def plain_codes(blocks: int):
    """Queries `id, v` -> `block, id, code`; 0 in the place of the component that lengthens a band's points."""

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if t.num_rows:
                v, q = matrix(t.column("v")), t.column("id").to_numpy()
                code = np.round(v / np.abs(v).max(axis=1, keepdims=True) * 127).astype(np.int8)
                code = np.hstack([code, np.zeros((len(code), 1), np.int8)])
                yield pa.record_batch([pa.array(block_of(q, blocks)), pa.array(q), pa.array([c.tobytes() for c in code], pa.binary())], names=["block", "id", "code"])

    return run


def compared(top: int):
    """Queries on the left and points on the right -> the top of each query."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if left.num_rows and right.num_rows:
            q, ids, v, w = left.column("id").to_numpy(), right.column("id").to_numpy(), matrix(left.column("v")), matrix(right.column("v"))
            order = np.argsort(ids, kind="stable")
            ids, w = ids[order], w[order]
            for at in range(0, len(q), 256):
                s = v[at : at + 256] @ w.T
                near = np.argsort(-s, axis=1, kind="stable")[:, :top]
                out.append((np.repeat(q[at : at + 256], near.shape[1]), ids[near].ravel()))
        q, ids = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table([q, ids], names=["q", "id"])

    return run


def banded(work: Workspace, classes: DataFrame, points: DataFrame, longest: float, top: int, k: int, rounds: int, few: int, **leaf) -> DataFrame:
    """`q, id`: candidates for each query from every band of norms."""
    length = F.sqrt(dot(F.col("v"), F.col("v")))
    rows = work.write(classes.select("id", "v", length.alias("length"), F.floor(2 * F.log2(F.lit(longest) / length)).alias("band")), "bands")
    asking = work.write(classes.join(points, "id", "left_semi").select("id", "v"), "asking-points")
    large = [(r["band"], r["longest"]) for r in rows.groupBy("band").agg(F.count("*").alias("n"), F.max("length").alias("longest")).filter(F.col("n") > few).collect()]
    rest = work.write(rows.filter(~F.col("band").isin([b for b, _ in large])).select("id", "v"), "rest")
    i, j = (max(1, -(-x.count() // PART)) for x in (asking, rest))
    part = lambda x: F.pmod(F.xxhash64("id"), F.lit(x)).cast("int")
    each = lambda x: F.explode(F.sequence(F.lit(0), F.lit(x - 1)))
    lefts = asking.select(part(i).alias("i"), each(j).alias("j"), "id", "v").groupBy("i", "j")
    rights = rest.select(each(i).alias("i"), part(j).alias("j"), "id", "v").groupBy("i", "j")
    pairs = [lefts.cogroup(rights).applyInArrow(arrow2(compared(top + 1)), "q long, id long")]
    for b, norm in large:
        own, band = Workspace(work.spark, "band"), rows.filter(F.col("band") == b).select("id", "v")
        graph = Graph(own, band, k, top=norm, **leaf)
        graph.refine(rounds)
        sample = band.orderBy(F.xxhash64("id"), "id").limit(DOORS).collect()
        entries = doors(graph.blocks, BEAM, np.array([r["id"] for r in sample], np.int64), np.array([r["v"] for r in sample]) / norm)
        codes = own.write(asking.mapInArrow(plain_codes(graph.blocks), "block int, id long, code binary"), "query-codes")
        pool = search(own, graph, codes, asking.mapInArrow(entries, POOLS))
        pairs.append(pool.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "id"))).filter(F.col("n") <= AGAIN).select("q", "id"))
    return work.write(reduce(DataFrame.unionAll, pairs), "candidates")


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def nearest(vectors: DataFrame, asked: DataFrame, top: int = TOP, k: int = K, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", leaf: int | None = None, few: int = FEW) -> DataFrame:
    """`query_id, rank, vec_id, score`: the `top` rows of largest inner product found for each id in `asked(id)`.

    Of rows that repeat an id the least vector counts; queries are rows of `vectors`. Ties go to the
    smaller id. Vectors that usable() leaves out neither ask nor answer. With fewer rows than `top` all others come. An
    empty table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "ann")
    good = work.write(usable(vectors, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v")), "good")
    classes = work.write(good.groupBy("v").agg(F.min("id").alias("id")), "classes")
    of = work.write(good.join(classes.withColumnRenamed("id", "point"), "v").select("id", "point"), "of")
    length = F.sqrt(dot(F.col("v"), F.col("v")))
    shortest, longest = classes.agg(F.min(length), F.max(length)).first()
    lengthened = bool(longest) and longest - shortest > 1e-3 * longest  # else inner products order as cosines do
    asking = work.write(of.join(asked.select("id"), "id", "left_semi").distinct(), "asking")
    points = asking.select(F.col("point").alias("id")).distinct()
    leaves = {"leaf": leaf} if leaf else {}
    if lengthened:
        pairs = banded(work, classes, points, longest, top, k, rounds, few, **leaves)
    else:
        graph = Graph(work, classes, k, **leaves)
        graph.refine(rounds)
        by_code = W.partitionBy("q").orderBy(F.desc("score"), "id")
        pairs = search_own(work, graph, points).withColumn("n", F.row_number().over(by_code)).filter(F.col("n") <= AGAIN).select("q", "id")
    pairs = pairs.unionAll(points.select(F.col("id").alias("q"), "id")).distinct()
    exact = pairs.join(classes, "id").join(classes.select(F.col("id").alias("q"), F.col("v").alias("w")), "q")
    exact = exact.select("q", "id", dot(F.col("v"), F.col("w")).alias("score"))
    by_score = W.partitionBy("q").orderBy(F.desc("score"), "id")
    exact = exact.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= top + 1).drop("n")
    # a class answers with its smallest ids; more than top + 1 of them can't be needed
    part = F.pmod(F.xxhash64("id"), F.lit(64))
    few = of.withColumn("n", F.row_number().over(W.partitionBy("point", part).orderBy("id"))).filter(F.col("n") <= top + 1)
    few = few.withColumn("n", F.row_number().over(W.partitionBy("point").orderBy("id"))).filter(F.col("n") <= top + 1)
    few = few.select(F.col("id").alias("vec_id"), F.col("point").alias("id"))
    # ranked for a class before its queries, however many they are, get their rows
    found = exact.join(few, "id").withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("n") <= top + 1)
    found = found.select("q", "vec_id", "score").join(asking.select(F.col("id").alias("query_id"), F.col("point").alias("q")), "q").filter("query_id <> vec_id")
    last = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top)
    return found.select("query_id", "rank", "vec_id", "score")


def op6_ann_search(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    asked = rows.filter(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("id"))
    return nearest(rows, asked)
