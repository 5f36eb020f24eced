"""Exact duplicates by Patricia-trie owners.

Texts are compared after runs of white space become one space. Every map task first merges the copies
inside each Arrow batch, so a text that fills a third of the table reaches its owner once per batch. Rows then
go to owners by (byte length, content hash); each owner inserts the full byte strings into a compressed radix
trie whose terminal nodes hold the smallest identifier and the number of copies. A trie that outgrows its
memory bound writes its largest subtree to a task-local temporary file and finishes it afterwards.

Nulls count as empty texts. Rows without identifier take part; a group of such rows alone has a null ``keep_id``.
Of repeated rows with one identifier exactly one is kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import SPACES, col, fresh, ready

# Bytes of edges and nodes that one trie may hold before it spills.
TRIE_BYTES = 48_000_000
_NODE_BYTES = 250


def smaller(a, b):
    return b if a is None else a if b is None else min(a, b)


class _Node:
    __slots__ = ("edge", "children", "entry")

    def __init__(self, edge: bytes, entry=None):
        self.edge, self.children, self.entry = edge, {}, entry


class _Spilled:
    """All keys below one branch, appended to a file as (key, id, copies)."""

    __slots__ = ("path", "file")

    def __init__(self, folder: str):
        handle, self.path = tempfile.mkstemp(dir=folder)
        self.file = os.fdopen(handle, "wb")

    def add(self, key: bytes, ident, copies: int) -> None:
        pickle.dump((key, ident, copies), self.file, protocol=5)

    def take(self):
        """The entries; the file is gone afterwards."""
        self.file.close()
        with open(self.path, "rb") as f:
            while True:
                try:
                    yield pickle.load(f)
                except EOFError:
                    break
        os.unlink(self.path)


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by bisection on slices."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class PatriciaTrie:
    """Byte strings with their smallest identifier and copy count, spilling by subtree."""

    def __init__(self, most: int = TRIE_BYTES, folder: str | None = None):
        self.root, self.held, self.most, self.folder, self.spills = _Node(b""), 0, most, folder, []

    def add(self, key: bytes, ident, copies: int = 1) -> None:
        node, i = self.root, 0
        while True:
            if i == len(key):
                break
            child = node.children.get(key[i])
            if child is None:
                node.children[key[i]] = child = _Node(key[i:])
                self.held += len(key) - i + _NODE_BYTES
                node = child
                break
            if isinstance(child, _Spilled):
                child.add(key, ident, copies)
                return
            if key.startswith(child.edge, i):
                i += len(child.edge)
                node = child
                continue
            n = _shared(child.edge, key[i:i + len(child.edge)])
            middle = _Node(child.edge[:n])
            child.edge = child.edge[n:]
            middle.children[child.edge[0]] = child
            node.children[key[i]] = middle
            self.held += _NODE_BYTES
            node, i = middle, i + n
        old = node.entry
        node.entry = (ident, copies) if old is None else (smaller(old[0], ident), old[1] + copies)
        if self.held > self.most:
            self._spill()

    @staticmethod
    def _entries(node: _Node, prefix: bytes):
        stack = [(node, prefix)]
        while stack:
            n, p = stack.pop()
            if isinstance(n, _Spilled):
                continue
            p += n.edge
            if n.entry is not None:
                yield p, *n.entry
            stack.extend((c, p) for c in n.children.values())

    @staticmethod
    def _spilled(node: _Node) -> list:
        out, stack = [], [node]
        while stack:
            n = stack.pop()
            if isinstance(n, _Spilled):
                out.append(n)
            else:
                stack.extend(n.children.values())
        return out

    @staticmethod
    def _weight(node: _Node) -> int:
        total, stack = 0, [node]
        while stack:
            n = stack.pop()
            if not isinstance(n, _Spilled):
                total += len(n.edge) + _NODE_BYTES
                stack.extend(n.children.values())
        return total

    def _spill(self) -> None:
        """Move the heaviest branch below the first fork to a file."""
        node, prefix = self.root, b""
        while len(node.children) == 1 and node.entry is None and isinstance(only := next(iter(node.children.values())), _Node):
            node, prefix = only, prefix + only.edge
        weights = {b: self._weight(c) for b, c in node.children.items() if isinstance(c, _Node)}
        if len(node.children) < 2 or not weights:
            self.most = self.held * 2  # a lone chain can't be divided
            return
        b = max(weights, key=weights.get)
        self.folder = self.folder or tempfile.mkdtemp()
        out = _Spilled(self.folder)
        for entry in self._entries(node.children[b], prefix):
            out.add(*entry)
        # Branches below that were spilled before a fork appeared above them move along.
        for older in self._spilled(node.children[b]):
            self.spills.remove(older)
            for entry in older.take():
                out.add(*entry)
        node.children[b] = out
        self.spills.append(out)
        self.held -= weights[b]

    def items(self):
        """Every (key, smallest id, copies), spilled subtrees last; frees files as it goes."""
        yield from self._entries(self.root, b"")
        self.root = _Node(b"")
        for s in self.spills:
            part = PatriciaTrie(self.most, self.folder)
            for entry in s.take():
                part.add(*entry)
            yield from part.items()
        self.spills = []


_LOCAL = "n_bytes int, hash long, text string, id long, copies long"
_OWNED = "sha string, keep_id long, group_size long"


def _merge_batches(batches):
    """Copies within a batch become one row."""
    for b in batches:
        first: dict = {}
        texts, ids, hashes, copies = b.column("text"), b.column("id").to_pylist(), b.column("hash").to_pylist(), []
        rows = []
        for i, h in enumerate(hashes):
            for k in first.setdefault(h, []):
                if texts[rows[k]].equals(texts[i]):
                    ids[rows[k]] = smaller(ids[rows[k]], ids[i])
                    copies[k] += 1
                    break
            else:
                first[h].append(len(rows))
                rows.append(i)
                copies.append(1)
        out = b.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [out.column("n_bytes"), out.column("hash"), out.column("text"),
             pa.array([ids[i] for i in rows], pa.int64()), pa.array(copies, pa.int64())],
            ["n_bytes", "hash", "text", "id", "copies"])


def _own(most: int):
    def run(batches):
        with tempfile.TemporaryDirectory() as folder:
            trie = PatriciaTrie(most, folder)
            for b in batches:
                for key, ident, copies in zip(b.column("text"), b.column("id").to_pylist(), b.column("copies").to_pylist()):
                    trie.add(key.as_buffer().to_pybytes(), ident, copies)
            rows: list = []
            for key, ident, copies in trie.items():
                rows.append((hashlib.sha256(key).hexdigest(), ident, copies))
                if len(rows) == 10_000:
                    yield _owned(rows)
                    rows = []
            if rows:
                yield _owned(rows)
    return run


def _owned(rows: list) -> pa.RecordBatch:
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.int64()), pa.array(c, pa.int64())],
                                      ["sha", "keep_id", "group_size"])


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(sha, keep_id, group_size): one row per distinct normalised text."""
    ready(docs.sparkSession)
    rows = docs.select(normalised(col(text_col)).alias("text"), col(id_col).cast("long").alias("id"))
    rows = rows.select(F.octet_length("text").alias("n_bytes"), F.xxhash64("text").alias("hash"), "text", "id")
    local = rows.mapInArrow(_merge_batches, _LOCAL)
    return local.repartition("n_bytes", "hash").mapInArrow(_own(trie_bytes), _OWNED)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept`` and the digest of the normalised text."""
    groups = exact_groups(docs, id_col, text_col, trie_bytes)
    rows = docs.select(col(id_col).alias(id_col), F.sha2(normalised(col(text_col)), 256).alias("text_sha256"))
    again = Window.partitionBy(id_col, "text_sha256").orderBy(F.lit(0))
    rows = rows.withColumn("_again", F.row_number().over(again))
    out = rows.join(groups, rows["text_sha256"] == groups["sha"])
    return out.select(id_col, "keep_id", "group_size",
                      (col(id_col).eqNullSafe(F.col("keep_id")) & (F.col("_again") == 1)).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """The rows that stay, with the columns of ``docs``. Joined on (id, digest), so no group meets in one task."""
    groups = exact_groups(docs, id_col, text_col, trie_bytes)
    sha, = fresh(docs, "sha_of_text")
    kept, kept_sha = fresh(docs.withColumn(sha, F.lit(0)), "keep_id", "kept_sha")
    groups = groups.select(F.col("keep_id").alias(kept), F.col("sha").alias(kept_sha))
    wide = docs.withColumn(sha, F.sha2(normalised(col(text_col)), 256))
    out = wide.join(groups, (wide[sha] == groups[kept_sha]) & wide[id_col].eqNullSafe(groups[kept]))
    return out.dropDuplicates([id_col, sha]).select(*[col(c) for c in docs.columns])
