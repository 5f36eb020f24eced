"""Hard negatives by an STR-packed R-tree: best-first search over bounding boxes, exact by construction.

Rows are dealt to shards of bounded size by the hash of their id, whatever their label, so a hot label spreads over all. A shard's task packs
one tree a label by sort-tile-recursive: rows are sorted by one coordinate (widest spread first), cut into slabs, every slab
sorted by the next one, and so on down to leaves of ``LEAF`` rows; ``FANOUT`` neighbouring boxes make a box of the next level. The trees lie as
flat arrays in one row of the index table in the shared folder.

A box holds the least and greatest value of every coordinate, so a coordinate's product with the anchor's lies in an interval and the sums
of the interval ends bound all inner products below. Boxes wait in a queue, highest bound first. Positives: the trees of the anchor's label; a
box strictly below the kth score found is dropped (not one that ties with it, whose ids may be smaller). Negatives: the trees of all
other labels, one search for all windows of an anchor; a box is dropped when it lies outside every window that is still open or strictly below
that window's kth. The best k of all shards are merged.

Components are scaled and rounded down to whole numbers, scores are exact: doubles while every sum stays below 2^53, Python's integers beyond;
a score outside the range of 64 bits counts as that range's end. Ties go to the smaller id.

Rows without id or label, with a null or empty vector or null or non-finite components take no part. Of rows that share an id the least by (label,
vector) counts. Vectors of other lengths than an anchor's are never its candidates. An anchor without another row of its label has no result, nor does
a positive whose window holds no row. Empty tables give empty results.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import col, ready, stored

POSITIVES, NEGATIVES = 5, 5
SCALE, FLOOR_PERCENT = 256, 80
# Bytes of a shard's vectors (as doubles), the least and most rows of a shard, rows of a leaf, boxes of a box, anchors of a task.
SHARD_BYTES, MIN_SHARD_ROWS, MAX_SHARD_ROWS = 16_000_000, 4_096, 65_536
LEAF, FANOUT = 128, 32
ANCHOR_BLOCK = 1_024
_EXACT = 2.0 ** 53
_LONG = 2 ** 63 - 1
_KINDS = ["<i2", "<i4", "<f8"]


def whole_components(column, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of a list column, one row a vector."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.floor(a.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim) * scale)


def str_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """Row order in which every run of ``leaf`` rows is a tile of sort-tile-recursive packing."""
    axes = np.argsort(-(x.max(0) - x.min(0)), kind="stable")
    out: list = []

    def tile(rows, depth):
        pages = -(-len(rows) // leaf)
        if pages <= 1 or depth == len(axes):
            out.append(rows)
            return
        slabs = max(2, int(np.ceil(pages ** (1 / (len(axes) - depth)) - 1e-9)))
        rows = rows[np.argsort(x[rows, axes[depth]], kind="stable")]
        size = -(-pages // slabs) * leaf
        for i in range(0, len(rows), size):
            tile(rows[i:i + size], depth + 1)

    tile(np.arange(len(x)), 0)
    return np.concatenate(out)


class Forest:
    """One tree a label. Boxes lie level by level from the leaves up: (low, high, first child, children, level) each."""

    def __init__(self, ids, vectors, low, high, first, many, leaf, roots, root_label):
        self.ids, self.vectors, self.low, self.high = ids, vectors, low, high
        self.first, self.many, self.leaf, self.roots, self.root_label = first, many, leaf, roots, root_label
        self.most = float(np.abs(vectors).max()) if vectors.size else 0.0

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> "Forest":
        order: list = []
        low, high, first, many, leaf, roots, names = [], [], [], [], [], [], []
        n_boxes = n_rows = 0
        by = np.argsort(labels, kind="stable")
        for rows in np.split(by, np.flatnonzero(np.diff(labels[by])) + 1):
            rows = rows[str_order(vectors[rows], LEAF)]
            order.append(rows)
            x = vectors[rows]
            begin, size, bottom = np.arange(0, len(rows), LEAF), len(rows), True
            lo, hi = np.minimum.reduceat(x, begin), np.maximum.reduceat(x, begin)
            base = n_rows
            while True:
                low.append(lo)
                high.append(hi)
                first.append(begin + base)
                many.append(np.diff(np.append(begin, size)))
                leaf.append(np.full(len(begin), bottom))
                base, n_boxes = n_boxes, n_boxes + len(begin)
                if len(begin) == 1:
                    break
                size, bottom = len(begin), False
                begin = np.arange(0, size, FANOUT)
                lo, hi = np.minimum.reduceat(lo, begin), np.maximum.reduceat(hi, begin)
            roots.append(n_boxes - 1)
            names.append(labels[rows[0]])
            n_rows += len(rows)
        order = np.concatenate(order)
        return cls(ids[order], vectors[order], np.concatenate(low), np.concatenate(high), np.concatenate(first).astype(np.int64),
                   np.concatenate(many).astype(np.int64), np.concatenate(leaf), np.array(roots, np.int64), np.array(names, np.int64))

    def _exactly(self, q: np.ndarray):
        """Arrays whose inner products with ``q`` are exact."""
        if (np.abs(q).max() * self.most) * len(q) < _EXACT:
            return q, self.vectors, self.low, self.high
        big = np.frompyfunc(int, 1, 1)
        if not hasattr(self, "whole"):
            self.whole = big(self.vectors), big(self.low), big(self.high)
        return big(q), *self.whole

    def _walk(self, q, label, same: bool, wanted, rows):
        """Best-first over the trees of the label (or of all others). ``wanted(high, low)``: which boxes may hold a result (bounds
        descend); ``rows(ids, scores)`` takes a leaf; an empty answer for the best box of the queue ends the walk."""
        q, vectors, low, high = self._exactly(q)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        queue: list = []

        def enter(boxes):
            top = high[boxes] @ up + low[boxes] @ down
            bottom = low[boxes] @ up + high[boxes] @ down
            fine = wanted(top, bottom)
            for b, t, u in zip(boxes[fine].tolist(), top[fine].tolist(), bottom[fine].tolist()):
                heapq.heappush(queue, (-t, b, u))

        enter(self.roots[(self.root_label == label) == same])
        while queue:
            t, b, u = heapq.heappop(queue)
            if not wanted(np.array([-t]), np.array([u]))[0]:
                continue
            at = slice(self.first[b], self.first[b] + self.many[b])
            if self.leaf[b]:
                rows(self.ids[at], vectors[at] @ q)
            else:
                enter(np.arange(at.start, at.stop))

    def positives(self, anchor: int, label: int, q: np.ndarray, k: int) -> list:
        """[(score, id)] of the k best other rows of the label."""
        best: list = []

        def wanted(top, bottom):
            return top >= best[-1][0] if len(best) == k else np.ones(len(top), bool)

        def rows(ids, scores):
            hit = ids != anchor
            if len(best) == k:
                hit &= scores >= best[-1][0]
            if hit.any():
                best.extend(zip(scores[hit].tolist(), ids[hit].tolist()))
                best.sort(key=lambda x: (-x[0], x[1]))
                del best[k:]

        self._walk(q, label, True, wanted, rows)
        return best

    def negatives(self, label: int, q: np.ndarray, tops: list, percent: int, k: int) -> list:
        """For each positive's score in ``tops`` [(score, id)] of the k best rows of other labels within percent to 100 % of it."""
        found: list = [[] for _ in tops]
        floor = [-(-percent * p // 100) for p in tops]  # the least whole score of the window
        least = list(floor)  # rises to the kth score once there are k
        window = [w for w, p in enumerate(tops) if floor[w] <= p]

        def wanted(top, bottom):
            out = np.zeros(len(top), bool)
            for w in window:
                out |= (top >= least[w]) & (bottom <= tops[w])
            return out

        def rows(ids, scores):
            if not window or not ((scores >= min(least[w] for w in window)) & (scores <= max(tops[w] for w in window))).any():
                return
            for w in window:
                hit = (scores >= least[w]) & (scores <= tops[w])
                if hit.any():
                    f = found[w]
                    f.extend(zip(scores[hit].tolist(), ids[hit].tolist()))
                    f.sort(key=lambda x: (-x[0], x[1]))
                    del f[k:]
                    if len(f) == k:
                        least[w] = f[-1][0]

        if window:
            self._walk(q, label, False, wanted, rows)
        return found

    def to_arrays(self) -> list:
        """Components in the narrowest type that holds them all; its number comes first."""
        kind = 0 if self.most < 2 ** 15 else 1 if self.most < 2 ** 31 else 2
        return [bytes([kind]), *(a.astype(_KINDS[kind]).tobytes() for a in (self.vectors, self.low, self.high)),
                *(a.astype("<i8").tobytes() for a in (self.ids, self.first, self.many, self.leaf, self.roots, self.root_label))]

    @classmethod
    def from_arrays(cls, parts: list, dim: int) -> "Forest":
        x, low, high = (np.frombuffer(p, _KINDS[parts[0][0]]).astype(np.float64).reshape(-1, dim) for p in parts[1:4])
        ids, first, many, leaf, roots, names = (np.frombuffer(p, "<i8") for p in parts[4:])
        return cls(ids, x, low, high, first, many, leaf.astype(bool), roots, names)


def usable(table: DataFrame, id_col: str, label: object, vector_col: str) -> DataFrame:
    """(id, label, v, dim) of the rows that take part, one an id."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vector = col(vector_col) if dict(table.dtypes)[vector_col] == "array<float>" else col(vector_col).cast("array<double>")
    rows = table.select(col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("v"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0").filter(fine)
    return rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v", F.size("r.v").alias("dim"))


def build_index(rows: DataFrame, n_shards: int, scale: int = SCALE) -> DataFrame:
    """The index table: one row per (dim, shard)."""
    def run(key, t):
        dim, shard = (k.as_py() for k in key)
        forest = Forest.build(t.column("id").to_numpy(), t.column("label").to_numpy(), whole_components(t.column("v"), dim, scale))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "arrays": pa.array([forest.to_arrays()], pa.list_(pa.binary()))})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int"))
    return stored(dealt.groupBy("dim", "shard").applyInArrow(run, "dim int, shard int, arrays array<binary>"), "rtree-index")


_FOUND = "anchor_id long, positive_id long, id long, positive_score long, score long"


def _search(scale: int, percent: int, k: int):
    """Index x anchors of a block. Anchors with a list of positives (``tops``) look for negatives, others for positives."""
    def run(key, index, anchors):
        cells: list = []
        if index.num_rows and anchors.num_rows:
            dim = key[0].as_py()
            forest = Forest.from_arrays(index.column("arrays")[0].as_py(), dim)
            vectors = whole_components(anchors.column("v"), dim, scale)
            fit = lambda s: int(min(max(s, -_LONG - 1), _LONG))
            for q, a, label, tops in zip(vectors, *(anchors.column(c).to_pylist() for c in ("id", "label", "tops"))):
                if tops is None:
                    cells += [(a, None, i, None, fit(s)) for s, i in forest.positives(a, label, q, k)]
                else:
                    hits = forest.negatives(label, q, [t["score"] for t in tops], percent, k)
                    cells += [(a, t["id"], i, t["score"], fit(s)) for t, hit in zip(tops, hits) for s, i in hit]
        columns = list(zip(*cells)) or [[]] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "positive_id", "id", "positive_score", "score"])
    return run


def _over_shards(index: DataFrame, anchors: DataFrame, n_anchors: int, n_shards: int, run) -> DataFrame:
    blocks = max(1, -(-n_anchors // ANCHOR_BLOCK))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.withColumn("block", spread(blocks)).groupBy("dim", "shard", "block")
    right = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", spread(n_shards))
    return left.cogroup(right.groupBy("dim", "shard", "block")).applyInArrow(run, _FOUND)


def _top(found: DataFrame, by: list, k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def mine(table: DataFrame, is_anchor, label=None, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = POSITIVES,
         negatives: int = NEGATIVES, scale: int = SCALE, percent: int = FLOOR_PERCENT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``is_anchor`` (a condition on ``id``) holds.
    ``label``: a column expression over ``table``, its column ``label`` by default."""
    ready(table.sparkSession)
    rows = stored(usable(table, id_col, col("label") if label is None else label, vector_col), "rtree-rows")
    n, n_anchors, widest = rows.agg(F.count("*"), F.count_if(is_anchor), F.max("dim")).first()
    most = min(max(SHARD_BYTES // (8 * (widest or 1)), 1), MAX_SHARD_ROWS)
    shards = max(1, -(-n // most), min(8, -(-n // MIN_SHARD_ROWS)))
    index = build_index(rows, shards, scale)
    anchors = rows.filter(is_anchor)
    kind = "array<struct<score:bigint,id:bigint>>"
    near = _over_shards(index, anchors.withColumn("tops", F.lit(None).cast(kind)), n_anchors, shards, _search(scale, percent, positives))
    tops = _top(near, ["anchor_id"], positives).groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("score", "id")), False).alias("tops"))  # at most ``positives`` an anchor
    asked = stored(anchors.join(tops, "id"), "rtree-positives")
    hard = _top(_over_shards(index, asked, n_anchors, shards, _search(scale, percent, negatives)), ["anchor_id", "positive_id"], negatives)
    return hard.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
