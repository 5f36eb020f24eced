"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair, closed to components.

1. One pass gives every document its set of word shingles (64-bit fingerprints), the set's digest, and counts for a
   fixed-size frequency sketch. Documents with equal sets are one class from here on.
2. Shingles are ordered rare first (sketch frequency, then fingerprint); only each class's prefix is indexed.
   Prefix shingles of a single class can't link and go.
3. Round one pairs each class with one pivot: the class with which it shares most prefix shingles among those that hold
   a shared shingle earliest. Verified pairs are closed to components. Round two joins on prefix shingles again, but only across
   components, so a group of near copies isn't expanded into all pairs and no link between components is lost.
4. Candidates pass the length filter, the positional filter, and suffix filters (parity bits of both sets bound their
   difference inside the join, counts of 32 hash classes their overlap), then are verified on whole texts, once per pair.

Documents without text or words have the empty set and link with nothing; null ids take part and do not become a component's
id; repeated rows form one class; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import col, fresh, mix, ready, stored, text_bytes, text_slices
from tickframe.llm.components import components
from tickframe.llm.shingles import parity_maps, shingle_sets

# Frequency sketch: 2^20 counters, kept as 1,024 rows of 1,024; ranks of 16 bits make 2 MB for every worker.
SKETCH_BITS, SKETCH_ROW = 20, 1024
# Hash classes of the suffix filter; their counts are exact for sets of up to 65,535 shingles.
CLASSES = 32

PARITY = "struct<p0:long,p1:long,p2:long,p3:long>"
_SCANNED = f"id long, tkey long, n int, d long, classes binary, parity {PARITY}, part int, counts binary"
_SCAN_NAMES = ["id", "tkey", "n", "d", "classes", "parity", "part", "counts"]
_PARITY_TYPE = pa.struct([(f"p{i}", pa.int64()) for i in range(4)])
_NODE = "struct<d:long,n:int>"
_PREFIX = "token long, d long, n int, pos int"


def parity_column(h: np.ndarray, at: np.ndarray) -> pa.StructArray:
    maps = parity_maps(h, at)
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(maps[:, i])) for i in range(4)], ["p0", "p1", "p2", "p3"])


def _set_rows(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and order-free digests of the sets (0 sums for empty sets)."""
    n = np.diff(off)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return n, mix(sums[off[1:]] - sums[off[:-1]] + n.astype(np.uint64)).view(np.int64)


def _scan(k: int):
    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        any_rows = False
        for b in batches:
            for rows, data, off in text_slices(b):
                h, at = shingle_sets(data, off, k)
                counts += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)).astype(np.uint32)
                n, d = _set_rows(h, at)
                doc = np.repeat(np.arange(len(n)), n)
                classes = np.bincount(doc * CLASSES + (h % np.uint64(CLASSES)).astype(np.int64), minlength=len(n) * CLASSES)
                classes = np.minimum(classes, 65535).astype("<u2")
                m, none = len(n), None
                any_rows = True
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("tkey"), pa.array(n.astype(np.int32)), pa.array(d),
                     pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * CLASSES), m, [none, pa.py_buffer(classes)]).cast(pa.binary()),
                     parity_column(h, at), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                    _SCAN_NAMES)
        if any_rows:
            parts = counts.reshape(-1, SKETCH_ROW).astype("<u4")
            m = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
                 pa.nulls(m, _PARITY_TYPE), pa.array(np.arange(m, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())],
                _SCAN_NAMES)
    return run


def _add_counts(batches):
    """Sums of the sketch rows that one task holds: at most the whole sketch in memory."""
    total: dict = {}
    for b in batches:
        for part, counts in zip(b.column("part").to_pylist(), b.column("counts").to_pylist()):
            have = total.setdefault(part, np.zeros(SKETCH_ROW, np.uint64))
            have += np.frombuffer(counts, "<u4")
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([np.minimum(np.log2(c + 1.0) * 1024, 65535).astype("<u2").tobytes() for c in total.values()], pa.binary())],
            ["part", "ranks"])


def _ranks(scanned: DataFrame) -> np.ndarray:
    """The sketch as ranks (a fine logarithm of the count): 2^20 values of 16 bits, whatever the corpus size."""
    rows = scanned.filter(F.col("part").isNotNull()).select("part", "counts").repartition("part")
    out = np.zeros((1 << SKETCH_BITS) // SKETCH_ROW * SKETCH_ROW, "<u2").reshape(-1, SKETCH_ROW)
    for part, ranks in rows.mapInArrow(_add_counts, "part int, ranks binary").collect():
        out[part] = np.frombuffer(bytes(ranks), "<u2")
    return out.reshape(-1)


def _prefixes(k: int, num: int, den: int, ranks):
    def run(batches):
        rank = ranks.value.astype(np.uint64)
        low = np.uint64((1 << 48) - 1)
        for b in batches:
            done: set = set()  # equal sets of one batch are indexed once
            for _, data, off in text_slices(b):
                h, at = shingle_sets(data, off, k)
                n, d = _set_rows(h, at)
                key = (rank[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] << np.uint64(48)) | (h & low)
                keep = n - (num * n + den - 1) // den + 1
                keep[n == 0] = 0
                for i, c in enumerate(zip(d.tolist(), n.tolist())):
                    if c in done:
                        keep[i] = 0
                    elif n[i]:
                        done.add(c)
                        key[at[i]:at[i + 1]].sort()
                doc = np.repeat(np.arange(len(n)), keep)
                pos = np.arange(len(doc)) - np.repeat(np.cumsum(keep) - keep, keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at[doc] + pos].view(np.int64)), pa.array(d[doc]), pa.array(n[doc].astype(np.int32)), pa.array(pos.astype(np.int32))],
                    ["token", "d", "n", "pos"])
    return run


def _suffix_filter(num: int, den: int):
    """Pairs whose class counts leave room for the needed overlap."""
    def run(batches):
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            x, y = (np.frombuffer(b.column(c).cast(pa.binary(2 * CLASSES)).buffers()[1], "<u2", m * CLASSES,
                                  b.column(c).offset * 2 * CLASSES).reshape(m, CLASSES).astype(np.int64) for c in ("cx", "cy"))
            nx, ny = (pc.struct_field(b.column(c), "n") for c in ("a", "b"))
            nx, ny = (v.to_numpy(zero_copy_only=False).astype(np.int64) for v in (nx, ny))
            bound = np.minimum(x, y).sum(1)
            need = (num * (nx + ny) + num + den - 1) // (num + den)
            ok = (bound >= need) | (np.maximum(nx, ny) > 65535)
            yield b.select(["a", "b"]).filter(pa.array(ok))
    return run


def _verify(k: int, num: int, den: int):
    def run(batches):
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for s in range(0, b.num_rows, 500):
                part = b.slice(s, 500)
                (hx, ax), (hy, ay) = (shingle_sets(*text_bytes(part.column(c)), k) for c in ("tx", "ty"))
                for i in range(part.num_rows):
                    x, y = hx[ax[i]:ax[i + 1]], hy[ay[i]:ay[i + 1]]
                    both = np.sort(np.concatenate([x, y]))
                    same = int((both[1:] == both[:-1]).sum())
                    ok[s + i] = same > 0 and den * same >= num * (len(both) - same)
            yield b.select(["a", "b"]).filter(pa.array(ok))
    return run


class Candidates:
    """Classes of equal texts with index rows (token, node, pos), texts (node, text) and parity maps (node, parity); a node is
    the struct (d, n)."""

    def __init__(self, index: DataFrame, texts: DataFrame, parities: DataFrame, k: int, num: int, den: int):
        self.index, self.texts, self.parities, self.k, self.num, self.den = index, texts, parities, k, num, den

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs left by filters that need no texts."""
        return pairs

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of the distinct pairs (a, b), those that are similar enough."""
        p = self.likely(pairs)
        p = p.join(self.texts.select(F.col("node").alias("a"), F.col("text").alias("tx")), "a")
        p = p.join(self.texts.select(F.col("node").alias("b"), F.col("text").alias("ty")), "b")
        return p.mapInArrow(_verify(self.k, self.num, self.den), f"a {_NODE}, b {_NODE}")

    def passes(self, n1: str, p1: str, n2: str, p2: str):
        """Length filter."""
        a, b = F.col(n1).cast("long"), F.col(n2).cast("long")
        return F.least(a, b) * self.den >= F.greatest(a, b) * self.num

    def parity_passes(self, n1: str, m1: str, n2: str, m2: str):
        """Sets that differ in more elements than the threshold allows are seen to differ in more bits."""
        bits = sum((F.bit_count(F.col(f"{m1}.p{i}").bitwiseXOR(F.col(f"{m2}.p{i}"))) for i in range(1, 4)),
                   F.bit_count(F.col(f"{m1}.p0").bitwiseXOR(F.col(f"{m2}.p0"))))
        return bits * (self.num + self.den) <= (F.col(n1) + F.col(n2)).cast("long") * (self.den - self.num)

    def pivot_pairs(self) -> DataFrame:
        """For every class the one pivot with which it shares most index shingles."""
        pivots = self.index.groupBy("token").agg(F.min(F.struct("pos", "node")).alias("p"))
        rows = self.index.join(pivots, "token").select(F.col("node").alias("a"), "pos", F.col("p.node").alias("b"), F.col("p.pos").alias("ppos"))
        rows = rows.filter((F.col("a") != F.col("b")) & self.passes("a.n", "pos", "b.n", "ppos"))
        votes = rows.groupBy("a", "b").agg(F.count("*").alias("votes"))
        return votes.groupBy("a").agg(F.max(F.struct("votes", "b")).alias("best")).select("a", F.col("best.b").alias("b"))

    def cross_pairs(self, roots: DataFrame, done: DataFrame) -> DataFrame:
        """Every candidate pair between different components that isn't verified yet."""
        index = self.index.join(roots, "node", "left").select("token", "node", "pos", F.coalesce("root", "node").alias("root"))
        open_ = index.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("token")
        index = stored(index.join(open_, "token").join(self.parities, "node"), "cross-index")
        x = index.select("token", F.col("node").alias("a"), F.col("pos").alias("pa"), F.col("root").alias("ra"), F.col("parity").alias("ma"))
        y = index.select("token", F.col("node").alias("b"), F.col("pos").alias("pb"), F.col("root").alias("rb"), F.col("parity").alias("mb"))
        pairs = x.join(y, "token").filter((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & self.passes("a.n", "pa", "b.n", "pb")
                                          & self.parity_passes("a.n", "ma", "b.n", "mb"))
        pairs = pairs.select("a", "b").distinct()
        done = done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return pairs.join(done, ["a", "b"], "left_anti")

    def roots(self) -> DataFrame:
        """(node, root) of every class with a link."""
        pairs = stored(self.pivot_pairs(), "pivot-pairs")
        links = stored(self.links(pairs), "pivot-links")
        more = self.links(stored(self.cross_pairs(components(links), pairs), "cross-pairs"))
        return components(links.union(more))


class _Join(Candidates):
    """Documents as classes of equal shingle sets, indexed by their prefixes."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int):
        spark = docs.sparkSession
        ready(spark)
        self.k, self.num, self.den = k, num, den
        rows = docs.select(col(id_col).cast("long").alias("id"), F.xxhash64(col(text_col)).alias("tkey"), col(text_col).alias("text"))
        scanned = stored(rows.mapInArrow(_scan(k), _SCANNED), "shingle-scan")
        self.rows = scanned.filter(F.col("part").isNull()).select("id", "tkey", F.struct("d", "n").alias("node"), "classes", "parity")
        ranks = spark.sparkContext.broadcast(_ranks(scanned))
        self.classes = stored(self.rows.filter(F.col("node.n") > 0).groupBy("node").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tkey")).alias("first"), F.max("classes").alias("classes"),
            F.max("parity").alias("parity")), "shingle-classes")
        self.parities = self.classes.select("node", "parity")
        prefix = rows.select("text").mapInArrow(_prefixes(k, num, den, ranks), _PREFIX)
        shared = prefix.groupBy("token").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.min("n").alias("ln"), F.max("n").alias("hn"))
        shared = shared.filter((F.col("lo") != F.col("hi")) | (F.col("ln") != F.col("hn"))).select("token")
        # Equal sets met in several batches come several times; they are few now.
        index = prefix.join(shared, "token").select("token", F.struct("d", "n").alias("node"), "pos")
        self.index = stored(index.distinct(), "shingle-index")
        named = self.classes.join(self.index.select("node").distinct(), "node").select("node", "first.id", "first.tkey")
        texts = rows.join(named, rows["id"].eqNullSafe(named["id"]) & (rows["tkey"] == named["tkey"]))
        self.texts = stored(texts.select("node", "text").dropDuplicates(["node"]), "shingle-texts")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Suffix filter."""
        c = self.classes.select("node", "classes")
        p = pairs.join(c.select(F.col("node").alias("a"), F.col("classes").alias("cx")), "a")
        p = p.join(c.select(F.col("node").alias("b"), F.col("classes").alias("cy")), "b")
        return p.mapInArrow(_suffix_filter(self.num, self.den), f"a {_NODE}, b {_NODE}")

    def passes(self, n1: str, p1: str, n2: str, p2: str):
        """Length and positional filter for two sets whose first shared shingle stands at these places."""
        a, b = F.col(n1).cast("long"), F.col(n2).cast("long")
        need = F.ceil((a + b) * self.num / (self.num + self.den))
        room = 1 + F.least(a - F.col(p1), b - F.col(p2)) - 1
        return super().passes(n1, p1, n2, p2) & (room >= need)


def shingle_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """One row per input row: id, tkey (hash of the text), n_shingles, component_id (smallest id of its component), first (the
    component's first row as (id, tkey)). Two texts link when den * intersection >= num * union of their k-word shingle sets."""
    join = _Join(docs, id_col, text_col, k, num, den)
    classes = join.classes.join(join.roots(), "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    best = classes.groupBy("root").agg(F.min("first").alias("best"))
    classes = classes.join(best, "root").select(F.col("node").alias("cnode"), "best")
    out = join.rows.join(classes, F.col("node") == F.col("cnode"), "left")
    return out.select("id", "tkey", F.col("node.n").cast("long").alias("n_shingles"),
                      F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("component_id"), "best")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row left of each component (that of the smallest id); rows without words all stay."""
    rows = shingle_components(docs, id_col, text_col, k, num, den)
    key, kid, kkey, every = fresh(docs, "text_key", "kept_id", "kept_key", "all_stay")
    kept = rows.filter(F.col("best").isNull() | (F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.tkey") == F.col("tkey"))))
    kept = kept.groupBy(F.col("id").alias(kid), F.col("tkey").alias(kkey)).agg(F.max(F.col("best").isNull()).alias(every))
    wide = docs.withColumn(key, F.xxhash64(col(text_col)))
    out = wide.join(kept, col(id_col).eqNullSafe(F.col(kid)) & (F.col(key) == F.col(kkey)))
    names = [col(c) for c in docs.columns]
    once = out.filter(~F.col(every)).dropDuplicates([id_col, key]).select(*names)
    return once.unionByName(out.filter(F.col(every)).select(*names))
