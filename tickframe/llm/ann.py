"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, shard results merged.

Vectors are dealt to shards by the hash of their id. Each shard's task builds its graph and stores it as flat arrays
(ids, vectors, neighbours of every layer) in one row of the index table, written to the shared folder; every row of the table is
indexed. Equal vectors of a shard are one node with a list of ids. Queries go to all shards in blocks; a (shard, block) pair is
one task with bounded memory, and its best k per query are scored again in double precision on the original vectors. The
best k over the shards, ties to the smaller id, are the result.

Nearness is the largest inner product. Inside a shard vectors get one more component that lifts all to one length, so that the
largest inner product is also the nearest point and the graph is navigable.

Vectors that are null, zero, empty or hold null or non-finite components take no part, nor do rows without id; vectors of other
lengths than a query's are never its candidates. Rows that repeat an id are candidates of their own, but never of a query with that id; a
query id that comes several times is searched once (its least vector). Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import col, ready, stored

# Neighbours kept per node (twice that in the lowest layer), beam widths, and the bound on a shard's rows.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 64, 200
SHARD_ROWS = 32_768
# Smaller tables are still dealt to up to this many shards, of this many rows at least.
MIN_SHARDS, MIN_SHARD_ROWS = 8, 4_096
QUERY_BLOCK = 8_192
_INDEX = "dim int, shard int, arrays array<binary>"


def _beam(points, links, queries, entry, width):
    """Best-first search of all queries at once: (nodes, similarities), best first; -1 where fewer were met."""
    b, deg = len(queries), links.shape[1]
    seen = np.zeros((b, len(points)), bool)
    rows = np.arange(b)
    nodes = np.full((b, width), -1, np.int32)
    sims = np.full((b, width), -np.inf, np.float32)
    done = np.ones((b, width), bool)
    nodes[:, 0], done[:, 0] = entry, False
    sims[:, 0] = np.einsum("bd,bd->b", queries, points[entry])
    seen[rows, entry] = True
    live = rows
    while len(live):
        pick = np.argmin(done[live], axis=1)  # the beam is sorted: the first open node is the best
        open_ = ~done[live, pick]
        live, pick = live[open_], pick[open_]
        if not len(live):
            break
        done[live, pick] = True
        near = links[nodes[live, pick]]
        fresh = near >= 0
        fresh &= ~seen[live[:, None], np.maximum(near, 0)]
        seen[live[:, None], np.maximum(near, 0)] |= fresh
        s = np.matmul(points[np.maximum(near, 0)], queries[live][:, :, None])[:, :, 0]
        s[~fresh] = -np.inf
        all_s = np.concatenate([sims[live], s], 1)
        order = np.argsort(-all_s, axis=1, kind="stable")[:, :width]
        sims[live] = np.take_along_axis(all_s, order, 1)
        nodes[live] = np.take_along_axis(np.concatenate([nodes[live], np.where(fresh, near, -1)], 1), order, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], 1), order, 1)
    return nodes, sims


def _diverse(points, centre, nodes, sims, most):
    """For every row up to ``most`` of its candidates (best first), each closer to the centre than to those chosen before."""
    valid = (nodes >= 0) & np.isfinite(sims)
    v = points[np.maximum(nodes, 0)]
    between = np.matmul(v, v.transpose(0, 2, 1))
    chosen = np.zeros(nodes.shape, bool)
    nearest = np.full(nodes.shape, -np.inf, np.float32)
    count = np.zeros(len(nodes), np.int64)
    for j in range(nodes.shape[1]):
        take = valid[:, j] & (count < most) & (nearest[:, j] <= sims[:, j])
        chosen[:, j] = take
        count += take
        nearest = np.maximum(nearest, np.where(take[:, None], between[:, j, :], -np.inf))
    # Places left are filled with the best of the others.
    rank = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(np.where(valid, nodes, -1), rank, 1)
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((len(out), most - out.shape[1]), -1, out.dtype)], 1)
    return out


def _grow(points, members, degree, beam, upper, rng):
    """Neighbour array of one layer over ``members`` (in insertion order); ``upper`` finds entries for later ones."""
    n = len(points)
    links = np.full((n, degree), -1, np.int32)
    first = members[:max(2 * degree, 64)]
    x = points[first]
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    order = np.argsort(-s, axis=1, kind="stable")
    links[first] = _diverse(points, first, first[order], np.take_along_axis(s, order, 1), degree)
    at = len(first)
    while at < len(members):
        new = members[at:at + min(at, 256)]
        x = points[new]
        nodes, sims = _beam(points, links, x, upper(x, members[0]), beam)
        own = x @ x.T
        np.fill_diagonal(own, -np.inf)
        both_n = np.concatenate([nodes, np.broadcast_to(new, (len(new), len(new)))], 1)
        both_s = np.concatenate([sims, own], 1)
        order = np.argsort(-both_s, axis=1, kind="stable")[:, :beam]
        nodes, sims = np.take_along_axis(both_n, order, 1), np.take_along_axis(both_s, order, 1)
        links[new] = _diverse(points, new, nodes, sims, degree)
        # The way back: every chosen neighbour reconsiders its list with the new nodes.
        src = np.repeat(new, degree)
        dst = links[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        heads, start, count = np.unique(dst, return_index=True, return_counts=True)
        for lo in range(0, len(heads), 512):
            h, st, c = heads[lo:lo + 512], start[lo:lo + 512], count[lo:lo + 512]
            extra = np.full((len(h), c.max()), -1, np.int32)
            row = np.repeat(np.arange(len(h)), c)
            extra[row, np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)] = src[np.repeat(st - (np.cumsum(c) - c), c) + np.arange(len(row))]
            cand = np.concatenate([links[h], extra], 1)
            dup = (extra[:, :, None] == links[h][:, None, :]).any(2)
            cand[:, degree:][dup] = -1
            sim = np.matmul(points[np.maximum(cand, 0)], points[h][:, :, None])[:, :, 0]
            sim[cand < 0] = -np.inf
            order = np.argsort(-sim, axis=1, kind="stable")[:, :2 * degree]
            links[h] = _diverse(points, h, np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1), degree)
        at += len(new)
    return links


class Graph:
    """A shard's index as flat arrays."""

    def __init__(self, vectors, lifted, ids, bounds, layers):
        self.vectors, self.lifted, self.ids, self.bounds, self.layers = vectors, lifted, ids, bounds, layers

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, links: int, beam: int) -> "Graph":
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order] + np.float32(0))  # -0 and 0 are equal
        keys = vectors.view([("", vectors.dtype)] * vectors.shape[1]).ravel() if vectors.shape[1] else np.zeros(len(ids))
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        by = np.argsort(which, kind="stable")  # ids ascend within a node
        bounds = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(first)))])
        vectors, ids = vectors[first], ids[by]
        scale = np.float64(np.abs(vectors).max())
        unit = (vectors / scale).astype(np.float64)
        squares = (unit ** 2).sum(1)
        lifted = np.concatenate([unit, np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]], 1).astype(np.float32)
        rng = np.random.default_rng(len(first))
        level = np.floor(-np.log(1 - rng.random(len(first))) / np.log(links)).astype(int)
        members = rng.permutation(len(first)).astype(np.int32)
        members = members[np.argsort(-level[members], kind="stable")]  # higher nodes first
        layers: list = []
        for at in range(int(level.max()), -1, -1):
            def upper(q, entry, above=tuple(layers)):
                e = np.full(len(q), entry)
                for a in above:
                    e = _beam(lifted, a, q, e, 4)[0][:, 0]
                return e
            layers.append(_grow(lifted, members[level[members] >= at], links * (1 if at else 2), beam, upper, rng))
        return cls(vectors, lifted, ids, bounds, layers), members[0]

    def search(self, entry: int, queries: np.ndarray, own: np.ndarray, k: int, beam: int):
        """(query number, id, score) of up to k nearest of each query, its own id left out."""
        out: list = []
        for lo in range(0, len(queries), 128):
            q = queries[lo:lo + 128]
            lift = np.concatenate([q / np.maximum(np.abs(q).max(1, keepdims=True), 1e-300), np.zeros((len(q), 1))], 1).astype(np.float32)
            e = np.full(len(q), entry)
            for a in self.layers[:-1]:
                e = _beam(self.lifted, a, lift, e, 4)[0][:, 0]
            nodes, _ = _beam(self.lifted, self.layers[-1], lift, e, min(beam, len(self.lifted)))
            for i in range(len(q)):
                found = nodes[i][nodes[i] >= 0]
                score = (self.vectors[found].astype(np.float64) * q[i]).sum(1)
                # Of equal vectors the k smallest ids are enough, beside all rows of the query's own id.
                size = self.bounds[found + 1] - self.bounds[found]
                for j in np.flatnonzero(size > k):
                    run = self.ids[self.bounds[found[j]]:self.bounds[found[j] + 1]]
                    size[j] = min(size[j], k + np.searchsorted(run, own[lo + i], "right") - np.searchsorted(run, own[lo + i]))
                at = np.repeat(self.bounds[found], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                ids, score = self.ids[at], np.repeat(score, size)
                other = ids != own[lo + i]
                ids, score = ids[other], score[other]
                best = np.lexsort((ids, -score))[:k]
                out.append((np.full(len(best), lo + i), ids[best], score[best]))
        return [np.concatenate(c) for c in zip(*out)]

    def to_arrays(self, entry: int) -> list:
        meta = np.array([entry, len(self.ids), len(self.vectors), self.vectors.shape[1], len(self.layers), *[a.shape[1] for a in self.layers]], "<i8")
        return [a.tobytes() for a in (meta, self.ids.astype("<i8"), self.bounds.astype("<i8"), self.vectors.astype("<f4"), self.lifted.astype("<f4"),
                                      *[a.astype("<i4") for a in self.layers])]

    @classmethod
    def from_arrays(cls, parts: list):
        meta = np.frombuffer(parts[0], "<i8")
        entry, _, n, dim = meta[:4].tolist()
        layers = [np.frombuffer(p, "<i4").reshape(n, d) for p, d in zip(parts[5:], meta[5:].tolist())]
        return cls(np.frombuffer(parts[3], "<f4").reshape(n, dim), np.frombuffer(parts[4], "<f4").reshape(n, dim + 1),
                   np.frombuffer(parts[1], "<i8"), np.frombuffer(parts[2], "<i8"), layers), entry


def _matrix(column, dim: int) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _build(links: int, beam: int):
    def run(key, rows):
        dim, shard = (k.as_py() for k in key)
        graph, entry = Graph.build(rows.column("id").to_numpy(), _matrix(rows.column("v"), dim).astype(np.float32), links, beam)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
                         "arrays": pa.array([graph.to_arrays(entry)], pa.list_(pa.binary()))})
    return run


def _search(k: int, beam: int):
    def run(key, index, queries):
        names = ["query_id", "vec_id", "score"]
        empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        if not index.num_rows or not queries.num_rows:
            return empty
        graph, entry = Graph.from_arrays(index.column("arrays")[0].as_py())
        own = queries.column("id").to_numpy()
        at, ids, score = graph.search(entry, _matrix(queries.column("v"), key[0].as_py()).astype(np.float64), own, k, beam)
        return pa.table([pa.array(own[at]), pa.array(ids), pa.array(score)], names)
    return run


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dim) of the rows that take part."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = table.select(col(id_col).cast("long").alias("id"), col(vector_col).cast("array<float>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False))).withColumn("dim", F.size("v"))


def build_index(vectors: DataFrame, n_shards: int, links: int = LINKS, beam: int = BUILD_BEAM) -> DataFrame:
    """The index table: one row per (dim, shard)."""
    ready(vectors.sparkSession)
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int"))
    return stored(dealt.groupBy("dim", "shard").applyInArrow(_build(links, beam), _INDEX), "ann-index")


def search(index: DataFrame, queries: DataFrame, n_queries: int, n_shards: int, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query (id, v, dim)."""
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.withColumn("block", spread(blocks)).groupBy("dim", "shard", "block")
    right = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", spread(n_shards))
    found = left.cogroup(right.groupBy("dim", "shard", "block")).applyInArrow(_search(k, beam), "query_id long, vec_id long, score double")
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score"))), 1, k)
    merged = found.groupBy("query_id").agg(best.alias("best"))  # at most k rows from each shard
    return merged.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "b.vec_id", "b.score")


def nearest(table: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
            beam: int = SEARCH_BEAM) -> DataFrame:
    """Index every usable row of ``table`` and search for those where ``is_query`` (a condition on ``id``) holds."""
    rows = usable(table, id_col, vector_col)
    asked = rows.filter(is_query).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    n, q = rows.agg(F.count("*"), F.count_if(is_query)).first()
    shards = max(-(-n // shard_rows), min(MIN_SHARDS, -(-n // MIN_SHARD_ROWS)), 1)
    return search(build_index(rows, shards), asked, q, shards, k, beam)
