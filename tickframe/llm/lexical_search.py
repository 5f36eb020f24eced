"""Ranked lexical search, reversed: the items' terms are the index, the documents stream through it.

The items (the queries) are few against the documents, so their terms make the inverted index: term -> (item, how often). It
is made for a block of items at a time, at most ``BLOCK_TERMS`` term occurrences unless one item alone has more, and goes to the tasks
inside the plan; more items mean more blocks, not a larger index. For each block

1. every document is cut into terms once; its length and its counts of the block's terms are written to the shared folder,
2. document frequencies of the block's terms and the corpus totals are summed from them,
3. the written counts stream through the index; a task keeps the best k documents of every item in bounded arrays, and its
   kth score lets later documents pass at once if they cannot enter,
4. the tasks' lists are merged, in two steps (by item and task group, then by item).

Terms are maximal runs of ASCII letters, ASCII digits and characters beyond ASCII; only A-Z are lower-cased. A term is found by a hash
and then compared byte by byte. Weights use double precision, everything else whole numbers.

Null or empty texts have no terms: such documents count nowhere, such items have no results. A document without id counts in the statistics
but is no result. Documents that repeat an id are results of their own; equal scores come by ascending id. Equal rows of the items table are
one item; several texts of one item id are one item with all their terms. Empty tables give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import col, mix, ready, stored, text_slices

TOP = 10
# Term occurrences and items of one index; score cells of a task at a time.
BLOCK_TERMS = 200_000
BLOCK_ITEMS = 4_096
CELLS = 4_000_000
_EXACT = 2 ** 53

_IS_TERM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def term_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, text) of all terms of the texts that lie end to end in ``data``."""
    inside = _IS_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.concatenate([[False], inside])  # the byte before a place is a term byte of the same text
    after = np.concatenate([inside, [False]])
    begin = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    return begin, end, np.searchsorted(off, begin, "right") - 1


def _words(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each term from its eight-byte parts."""
    size = end - begin
    # The eight bytes from every place on, as one number.
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    h = size.astype(np.uint64)
    at = np.arange(len(begin))
    for step in range(0, int(size.max()) if len(size) else 0, 8):
        at = at[size[at] > step]
        part = eight[begin[at] + step] & _FIRST[np.minimum(size[at] - step, 8)]
        with np.errstate(over="ignore"):
            h[at] = mix(h[at] * _MULTIPLIER ^ part)
    return h


class TermIndex:
    """The sorted hashes and the bytes of a block's terms."""

    def __init__(self, terms: list):
        self.terms = sorted(terms)
        data = np.frombuffer(b"".join(self.terms), np.uint8)
        end = np.cumsum([len(t) for t in self.terms], dtype=np.int64)
        begin = np.concatenate([[0], end[:-1]])
        hashes = _words(data, begin, end)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.number = hashes[order], order
        self.data, self.begin, self.size = data, begin, end - begin
        # Terms of one hash stand side by side; so many places are tried.
        self.tries = int(np.unique(hashes, return_counts=True)[1].max()) if len(hashes) else 0

    def find(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each span's term, -1 where it is none of the index."""
        out = np.full(len(begin), -1, np.int64)
        if not self.tries or not len(begin):
            return out
        h = _words(data, begin, end)
        first = np.searchsorted(self.hashes, h)
        for k in range(self.tries):
            at = np.minimum(first + k, len(self.hashes) - 1)
            maybe = np.flatnonzero((out < 0) & (self.hashes[at] == h))
            t = self.number[at[maybe]]
            same = self.size[t] == end[maybe] - begin[maybe]
            maybe, t = maybe[same], t[same]
            if len(t):
                n = self.size[t]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                equal = self.data[np.repeat(self.begin[t], n) + step] == data[np.repeat(begin[maybe], n) + step]
                fine = np.logical_and.reduceat(equal, np.cumsum(n) - n)
                out[maybe[fine]] = t[fine]
        return out


def _count(index: TermIndex):
    """Documents -> (id, n, terms, tf): length and counts of the index's terms; documents without terms give no row."""
    def run(batches):
        for b in batches:
            for rows, data, off in text_slices(b):
                data = _LOWER[data]
                begin, end, doc = term_spans(data, off)
                n = np.bincount(doc, minlength=rows.num_rows)
                term = index.find(data, begin, end)
                hit = term >= 0
                key, tf = np.unique(doc[hit] * max(len(index.terms), 1) + term[hit], return_counts=True)
                of = key // max(len(index.terms), 1)
                ends = np.searchsorted(of, np.arange(rows.num_rows + 1)).astype(np.int32)
                some = pa.array(np.flatnonzero(n))
                terms = pa.ListArray.from_arrays(pa.array(ends), pa.array((key % max(len(index.terms), 1)).astype(np.int32)))
                counts = pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([rows.column("id").take(some), pa.array(n).take(some), terms.take(some), counts.take(some)],
                                                 ["id", "n", "terms", "tf"])
        pa.default_memory_pool().release_unused()
    return run


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(np.asarray(column.offsets))


def _frequencies(n_terms: int):
    def run(batches):
        total, df = np.zeros(2, np.int64), np.zeros(n_terms, np.int64)
        for b in batches:
            total += [b.num_rows, b.column("n").to_numpy().sum()]
            df += np.bincount(_flat(b.column("terms"))[0], minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([total, df[some]]))], ["term", "df"])
    return run


def term_values(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 8 * m), m = 25 + (75 * n * N) div L, in whole numbers."""
    if len(tf) and (int(n.max()) * docs * 75 >= 2 ** 63 or int(tf.max()) >= 9 * 10 ** 9):
        tf, n = tf.astype(object), n.astype(object)  # beyond 64 bits: whole numbers of any size
    m = 25 + (75 * n * docs) // max(length, 1)
    return ((1_000_000_000 * tf) // (1000 * tf + 8 * m)).astype(np.int64)


class Postings:
    """term -> (item, weight x occurrences), as flat arrays."""

    def __init__(self, term: np.ndarray, item: np.ndarray, weight: np.ndarray, n_terms: int, n_items: int):
        order = np.argsort(term, kind="stable")
        self.item, self.weight = item[order], weight[order].astype(np.float64)
        self.size = np.bincount(term, minlength=n_terms)
        self.begin = np.cumsum(self.size) - self.size
        self.n_items = n_items
        # Sums of doubles are exact below 2^53.
        self.exact = bool((np.bincount(item, weight.astype(np.float64), n_items) * 1e6 < _EXACT).all())


def _best(postings: Postings, docs: int, length: int, k: int):
    """Streamed documents -> the best k (item, id, score) of this task."""
    def run(batches):
        items = postings.n_items
        score = np.zeros((items, k), np.int64)  # best first; 0: a free place
        ids = np.full((items, k), 2 ** 63 - 1, np.int64)

        def put(values, names):
            """values (documents x items) against the kept ones."""
            row, item = np.nonzero((values > 0) & (values >= score[:, -1]))
            if not len(row):
                return
            s, d = values[row, item], names[row]
            enters = (s > score[item, -1]) | (d < ids[item, -1])
            item, s, d = item[enters], s[enters], d[enters]
            touched = np.unique(item)
            have = score[touched] > 0
            item = np.concatenate([item, np.repeat(touched, have.sum(1))])
            s = np.concatenate([s, score[touched][have]])
            d = np.concatenate([d, ids[touched][have]])
            order = np.lexsort((d, -s, item))
            item, s, d = item[order], s[order], d[order]
            first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
            place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
            kept = place < k
            score[touched], ids[touched] = 0, 2 ** 63 - 1
            score[item[kept], place[kept]], ids[item[kept], place[kept]] = s[kept], d[kept]

        for b in batches:
            b = b.filter(b.column("id").is_valid())
            if not b.num_rows:
                continue
            names, n = b.column("id").to_numpy(), b.column("n").to_numpy()
            terms, many = _flat(b.column("terms"))
            tf = b.column("tf").flatten().to_numpy()
            doc = np.repeat(np.arange(b.num_rows), many)
            value = term_values(tf, n[doc], docs, length)
            work = np.cumsum(postings.size[terms])  # postings read, up to and with each (document, term)
            ends = np.cumsum(many)
            at = 0
            while at < b.num_rows:
                lo = ends[at - 1] if at else 0
                spent = work[lo - 1] if lo else 0
                upto = np.searchsorted(work, spent + CELLS, "right")
                stop = max(at + 1, min(int(np.searchsorted(ends, upto, "right")), at + max(1, CELLS // max(items, 1)), b.num_rows))
                hi = ends[stop - 1]
                t, size = terms[lo:hi], postings.size[terms[lo:hi]]
                spot = np.repeat(postings.begin[t], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                cell = np.repeat(doc[lo:hi] - at, size) * items + postings.item[spot]
                part = np.repeat(value[lo:hi], size)
                if postings.exact:
                    total = np.bincount(cell, postings.weight[spot] * part, (stop - at) * items).astype(np.int64)
                else:
                    total = np.zeros((stop - at) * items, np.int64)
                    np.add.at(total, cell, postings.weight[spot].astype(np.int64) * part)
                put(total.reshape(stop - at, items), names[at:stop])
                at = stop
        item, place = np.nonzero(score)
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(ids[item, place]), pa.array(score[item, place])], ["item", "doc_id", "score"])
    return run


def _blocks(items: DataFrame, id_col: str, text_col: str):
    """The items' term counts in blocks of bounded size: ([item ids], [terms], (term number, item number, occurrences))."""
    def cut(batches):
        for b in batches:
            for rows, data, off in text_slices(b):
                data = _LOWER[data]
                begin, end, doc = term_spans(data, off)
                raw = data.tobytes()
                words = [raw[i:j] for i, j in zip(begin, end)]
                yield pa.RecordBatch.from_arrays([rows.column("id").take(pa.array(doc)), pa.array(words, pa.binary())], ["item_id", "term"])

    kind = dict(items.dtypes)[id_col]
    rows = items.select(col(id_col).alias("id"), col(text_col).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL").distinct()
    terms = rows.mapInArrow(cut, f"item_id {kind}, term binary").groupBy("item_id", "term").agg(F.count("*").alias("many"))
    per_item = stored(terms.groupBy("item_id").agg(F.collect_list(F.struct("term", "many")).alias("terms"), F.sum("many").alias("n")), "search-items")
    ids, found = [], []
    held = 0
    for row in per_item.toLocalIterator():  # an item at a time; a full block is handed on and dropped
        if ids and (held + row["n"] > BLOCK_TERMS or len(ids) >= BLOCK_ITEMS):
            yield ids, found
            ids, found, held = [], [], 0
        ids.append(row["item_id"])
        found.append([(bytes(t["term"]), t["many"]) for t in row["terms"]])
        held += row["n"]
    if ids:
        yield ids, found


def _search_block(docs: DataFrame, ids: list, found: list, kind: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    index = TermIndex(list({t for item in found for t, _ in item}))
    counted = stored(docs.mapInArrow(_count(index), "id long, n long, terms array<int>, tf array<long>"), "search-counts")
    sums = counted.mapInArrow(_frequencies(len(index.terms)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r["term"]: r["df"] for r in sums.collect()}  # a row a term of the block
    n_docs, length = df.get(-2, 0), df.get(-1, 0)
    number = {t: i for i, t in enumerate(index.terms)}
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(index.terms))]
    triples = np.array([(number[t], i, many * weight[number[t]]) for i, item in enumerate(found) for t, many in item], np.int64).reshape(-1, 3)
    postings = Postings(triples[:, 0], triples[:, 1], triples[:, 2], len(index.terms), len(ids))
    best = counted.mapInArrow(_best(postings, n_docs, length, k), "item int, doc_id long, score long")
    order = [F.desc("score"), F.asc("doc_id")]
    groups = F.pmod(F.spark_partition_id(), F.lit(64))
    near = best.withColumn("part", groups).withColumn("place", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    near = near.filter(F.col("place") <= k).drop("place", "part")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], f"item int, item_id {kind}")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    ready(spark)
    kind = dict(items.dtypes)[item_id]
    rows = docs.select(col(doc_id).cast("long").alias("id"), col(doc_text).alias("text")).filter("text IS NOT NULL")
    out = None
    for ids, found in _blocks(items, item_id, item_text):
        part = stored(_search_block(rows, ids, found, kind, k), "search-block")
        out = part if out is None else out.unionAll(part)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
