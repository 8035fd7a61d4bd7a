"""NN-descent: a neighbour graph by repeated joins of neighbours of neighbours.

Nodes are dealt into blocks by a hash of their id. A round is three exchanges: each link goes to its far end, so every
node knows the neighbours it has either way; every node sends its code to those neighbours; each block compares, around
each of its nodes, all the codes that have come in, and sends what is nearer than a node's last neighbour to that node.
The first lists come from the leaves of a few random-projection trees. Codes are vectors of length 1 in bytes, so a
message is about 100 bytes; exact measures are taken from the vectors later. Nothing is collected or broadcast but
counts and hyperplanes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, python_ready

LEAF, TREES, SEED = 1024, 4, 11
NODES = "block int, id long, code binary, ids array<long>, sims array<float>"
NAMES = ["block", "id", "code", "ids", "sims"]
KINDS = (pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float32()))


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`id, v array<double>` of the rows whose id is there and whose vector is not null, zero, of another length than
    most or holding null or non-finite components."""
    v = F.col(vector_col).cast("array<double>")
    rows = table.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("v IS NOT NULL")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(~bad & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (usual[0]["n"] if usual else 0))


def matrix(column: pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """A list column whose rows have one length."""
    flat = column.combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)


def codes_of(blobs: list[bytes]) -> np.ndarray:
    """Vectors again, of length 1."""
    m = np.frombuffer(b"".join(blobs), np.int8).reshape(len(blobs), -1).astype(np.float32)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def encode_points(blocks: int, planes: np.ndarray, bits: int, top: float):
    """`id, v` -> `block, id, code, leaf..`: the code of v, lengthened by a component that brings all to norm `top` if that is given."""

    def encode(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            v = matrix(t.column("v"))
            norms = np.linalg.norm(v, axis=1, keepdims=True)
            if top:
                v = np.hstack([v, np.sqrt(np.maximum(top * top - norms * norms, 0))])
                norms = np.full_like(norms, top)
            v = v / norms
            code = np.round(v / np.abs(v).max(axis=1, keepdims=True) * 127).astype(np.int8)
            sides = (v @ planes > 0).reshape(len(v), TREES, -1)[:, :, :bits]
            leaves = (sides * (1 << np.arange(bits))).sum(axis=2).astype(np.int64)
            ids = t.column("id").to_numpy()
            yield pa.record_batch([pa.array(block_of(ids, blocks)), pa.array(ids), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(list(leaves), pa.list_(pa.int64()))], names=["block", "id", "code", "leaves"])

    return encode


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(32)) % np.uint64(blocks)).astype(np.int32)


def best(owner: np.ndarray, ids: np.ndarray, sims: np.ndarray, k: int, above: float = 2.0, most: int = 0):
    """Sorted by owner, nearest first, without repeats, the first k of each owner (up to `most` at sims of at least `above`)."""
    order = np.lexsort((ids, owner))
    owner, ids, sims = owner[order], ids[order], sims[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])
    owner, ids, sims = owner[new], ids[new], sims[new]
    order = np.lexsort((ids, -sims, owner))
    owner, ids, sims = owner[order], ids[order], sims[order]
    first = np.searchsorted(owner, owner)
    rank = np.arange(len(owner)) - first
    keep = (rank < k) | ((sims >= above) & (rank < most))
    return owner[keep], ids[keep], sims[keep]


def nearest_in(ids: np.ndarray, m: np.ndarray, k: int):
    """owner, neighbour, sim: the k nearest of each among the others."""
    n, out = len(ids), []
    k = min(k, n - 1)
    for a in range(0, n, 256):
        s = m[a : a + 256] @ m.T
        s[np.arange(len(s)), a + np.arange(len(s))] = -9
        at = np.argpartition(-s, k - 1, axis=1)[:, :k] if k < n - 1 else np.argsort(-s, axis=1)[:, :k]
        out.append((np.repeat(ids[a : a + 256], k), ids[at].ravel(), np.take_along_axis(s, at, 1).ravel()))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


UPDATES = "block int, owner long, id long, sim float"


def updates(blocks: int, owner, ids, sims) -> pa.Table:
    return pa.table([pa.array(block_of(owner, blocks)), pa.array(owner, pa.int64()), pa.array(ids, pa.int64()), pa.array(sims, pa.float32())], names=["block", "owner", "id", "sim"])


NONE = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)


def leaf_lists(blocks: int, k: int, above: float = 2.0, most: int = 0):
    def run(points: pa.Table) -> pa.Table:
        ids = points.column("id").to_numpy()
        if len(ids) < 2:
            return updates(blocks, *NONE)
        return updates(blocks, *best(*nearest_in(ids, codes_of(points.column("code").to_pylist()), max(k, most)), k, above, most))

    return run


def node_table(block, ids, codes, owner, near, sims) -> pa.Table:
    """Rows of NODES; owner is sorted."""
    order = np.argsort(ids, kind="stable")
    ids, codes = ids[order], [codes[i] for i in order]
    offsets = pa.array(np.concatenate([np.searchsorted(owner, ids), [len(owner)]]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in ((near, pa.int64()), (sims, pa.float32()))]
    return pa.table([pa.array(np.full(len(ids), block, np.int32)), pa.array(ids, pa.int64()), pa.array(codes, pa.binary()), *lists], names=NAMES)


def links_of(nodes: pa.Table):
    ids = nodes.column("id").to_numpy()
    sizes = nodes.column("ids").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    near = np.concatenate([np.zeros(0, np.int64), *(c.flatten().to_numpy() for c in nodes.column("ids").chunks)])
    sims = np.concatenate([np.zeros(0, np.float32), *(c.flatten().to_numpy() for c in nodes.column("sims").chunks)])
    return ids, np.repeat(ids, sizes), near, sims


def merge_lists(k: int, above: float, most: int):
    def run(nodes: pa.Table, found: pa.Table) -> pa.Table:
        if not nodes.num_rows:
            return node_table(0, np.zeros(0, np.int64), [], *NONE)
        ids, owner, near, sims = links_of(nodes)
        if found.num_rows:
            owner = np.concatenate([owner, found.column("owner").to_numpy()])
            near = np.concatenate([near, found.column("id").to_numpy()])
            sims = np.concatenate([sims, found.column("sim").to_numpy()])
        return node_table(nodes.column("block")[0].as_py(), ids, nodes.column("code").to_pylist(), *best(owner, near, sims, k, above, most))

    return run


MESSAGES = "block int, to long, id long, worst float, sim float, code binary"


def send_codes(blocks: int, k: int, above: float = 2.0, most: int = 0):
    """Nodes, and the links that end in them -> each node's code to all its neighbours, of either direction (the
    nearest 2k of those that name it). A list shorter than `most` takes what is at least `above`, however near its last is."""

    def run(nodes: pa.Table, back: pa.Table) -> pa.Table:
        if not nodes.num_rows:
            e = np.zeros(0, np.int64)
            return pa.table([pa.array(e, pa.int32()), e, e, pa.array(e, pa.float32()), pa.array(e, pa.float32()), pa.array([], pa.binary())], names=["block", "to", "id", "worst", "sim", "code"])
        ids, owner, near, sims = links_of(nodes)
        ends = np.searchsorted(owner, ids, side="right") if len(owner) else np.zeros(len(ids), int)
        held = ends - (np.searchsorted(owner, ids) if len(owner) else 0)
        full = held >= k
        worst = np.full(len(ids), -2, np.float32)
        worst[full] = sims[ends[full] - 1]
        worst[full & (held < most)] = np.minimum(worst[full & (held < most)], above)
        if back.num_rows:
            to_owner, to_near, to_sims = best(back.column("owner").to_numpy(), back.column("id").to_numpy(), back.column("sim").to_numpy(), 2 * k)
            owner, near, sims = best(np.concatenate([owner, to_owner]), np.concatenate([near, to_near]), np.concatenate([sims, to_sims]), 1 << 40)
        order = np.argsort(ids)
        at = order[np.searchsorted(ids[order], owner)]
        codes = nodes.column("code").combine_chunks()
        return pa.table([pa.array(block_of(near, blocks)), pa.array(near), pa.array(owner), pa.array(worst[at]), pa.array(sims, pa.float32()), codes.take(pa.array(at))], names=["block", "to", "id", "worst", "sim", "code"])

    return run


def local_join(blocks: int, k: int, above: float = 2.0, most: int = 0):
    """Around each node, all pairs of what has come in; those nearer than the last neighbour of either go out."""

    def run(messages: pa.Table) -> pa.Table:
        to = messages.column("to").to_numpy()
        order = np.argsort(to, kind="stable")
        to, ids, worst = to[order], messages.column("id").to_numpy()[order], messages.column("worst").to_numpy()[order]
        codes = codes_of(messages.column("code").take(pa.array(order)).to_pylist())
        cuts = [0, *(np.flatnonzero(np.diff(to)) + 1).tolist(), len(to)]
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            m = codes[a:b]
            s = m @ m.T
            s[np.arange(b - a), np.arange(b - a)] = -9
            i, j = np.nonzero(s > worst[a:b, None])
            out.append((ids[a:b][i], ids[a:b][j], s[i, j]))
            if len(out) >= 256:
                out = [best(*(np.concatenate(x) for x in zip(*out, strict=True)), 2 * k, above, most)]
        return updates(blocks, *best(*(np.concatenate(x) for x in zip(*out, strict=True)), 2 * k, above, most))

    return run


class Graph:
    """The points and their lists: `nodes` has NODES, `count` points, `blocks` blocks."""

    def __init__(self, work: Workspace, points: DataFrame, k: int, top: float = 0.0, above: float = 2.0, most: int = 0, leaf: int = LEAF):
        """points: `id, v`, distinct ids. above, most: keep up to `most` neighbours of at least that sim beside the k."""
        python_ready(points.sparkSession)
        self.work, self.k, self.above, self.most = work, k, above, most
        self.count = points.count()
        self.blocks = max(1, math.ceil(self.count / 1000))
        first = points.select("v").first()
        width = len(first["v"]) + bool(top) if first else 1
        bits = max(0, math.ceil(math.log2(max(1, self.count / leaf))))
        planes = np.random.default_rng(SEED).standard_normal((width, TREES * max(bits, 1)))
        schema = "block int, id long, code binary, leaves array<long>"
        coded = work.write(points.select("id", "v").mapInArrow(encode_points(self.blocks, planes, bits, top), schema), "codes")
        spread = coded.select("id", "code", F.posexplode("leaves").alias("tree", "leaf"))
        # a leaf of very many points is split by a hash of their ids
        sizes = spread.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / (4 * leaf)).cast("int").alias("parts"))
        spread = spread.join(work.write(sizes, "leaves"), ["tree", "leaf"])
        spread = spread.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        lists = spread.select("tree", "leaf", "part", "id", "code").groupBy("tree", "leaf", "part").applyInArrow(arrow(leaf_lists(self.blocks, k, above, most)), UPDATES)
        empty = coded.select("block", "id", "code", F.array().cast("array<long>").alias("ids"), F.array().cast("array<float>").alias("sims"))
        self.round = 0
        self.nodes = self.merged(empty, lists)

    def merged(self, nodes: DataFrame, found: DataFrame) -> DataFrame:
        out = nodes.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(arrow2(merge_lists(self.k, self.above, self.most)), NODES)
        out = self.work.write(out, f"nodes{self.round}")
        if self.round:
            self.work.drop(f"nodes{self.round - 1}")
        self.round += 1
        self.work.release()
        return out

    def messages(self) -> DataFrame:
        place = block_column("owner", self.blocks)
        back = self.nodes.select(F.col("id").alias("from"), F.explode(F.arrays_zip("ids", "sims")).alias("l"))
        back = back.select(F.col("l.ids").alias("owner"), F.col("from").alias("id"), F.col("l.sims").alias("sim")).withColumn("block", place)
        sent = self.nodes.groupBy("block").cogroup(back.select("block", "owner", "id", "sim").groupBy("block"))
        return sent.applyInArrow(arrow2(send_codes(self.blocks, self.k, self.above, self.most)), MESSAGES)

    def refine(self, rounds: int, enough: float = 0.002) -> None:
        """Up to so many rounds, until a round brings fewer than that share of new neighbours."""
        for _ in range(rounds):
            before = self.total()
            found = self.messages().groupBy("block").applyInArrow(arrow(local_join(self.blocks, self.k, self.above, self.most)), UPDATES)
            self.nodes = self.merged(self.nodes, found)
            now = self.total()
            if now[1] - before[1] <= enough * max(1.0, abs(before[1])) and now[0] == before[0]:
                break

    def total(self) -> tuple[int, float]:
        t = self.nodes.agg(F.sum(F.size("ids")), F.sum(F.aggregate("sims", F.lit(0.0), lambda a, x: a + x))).first()
        return t[0] or 0, t[1] or 0.0


def block_column(name: str, blocks: int):
    """block_of() as a column: the high half of a product modulo 2^64, taken in 32-bit halves so that nothing overflows."""
    x, (hi, lo) = F.col(name), (0x9E3779B9, 0x7F4A7C15)
    low, high = x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32)
    mask = F.lit(0xFFFFFFFF)
    # low * lo needs up to 64 bits: split low again
    l0, l1 = low.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(low, 16)
    p0, p1 = l0 * F.lit(lo), l1 * F.lit(lo)
    carry = F.shiftrightunsigned(F.shiftrightunsigned(p0, 16) + p1, 16)
    part = lambda a, b: ((a.bitwiseAND(F.lit(0xFFFF)) * F.lit(b)) + F.shiftleft((F.shiftrightunsigned(a, 16) * F.lit(b)).bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(mask)
    top = (carry + part(low, hi) + part(high, lo)).bitwiseAND(mask)
    return F.pmod(top, F.lit(blocks)).cast("int")


def arrow(f):
    """With the type hints that Spark asks for."""

    def run(rows: pa.Table) -> pa.Table:
        return f(rows)

    return run


def arrow2(f):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return f(left, right)

    return run
