"""Repeated windows by depth-limited radix passes over suffixes.

A window of ``threshold`` bytes is repeated when an equal string starts anywhere else, in the same document or
another. Suffixes are ordered only through ``threshold`` bytes, by most-significant-digit passes whose digits are 64-bit
fingerprints of byte spans; after the last digit, equal groups are exactly the repeated windows:

1. First digit. Every window belongs to its minimiser (the 16-byte gram of smallest fingerprint in it), so equal windows meet
   at equal minimisers. Neighbouring windows of one minimiser, up to 64, form a run, and the digit is the span that all
   windows of such a run share (337 bytes). Runs whose digit occurs once hold no repeated window and go.
2. Second digit: the run's whole content. Equal contents repeat all their windows. A digit with one content is then settled.
3. Last digit: of digits with several contents, the windows one by one; one run stands for all of equal content.

Each pass counts fingerprints (partial sums before the shuffle) and joins the counts back, so a passage shared by a
third of all documents is never gathered in one task. Each pass is written to the shared folder, and its shuffle files go before the next.

``docs`` must give its rows in the same order at every read, as a table does. Null texts count as empty; texts shorter than the threshold hold no window; repeated rows are documents of their own; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import SpanHash, col, mix, ready, stored, text_bytes, text_slices

THRESHOLD = 400
GRAM = 16
# Most windows of a run; a power of two.
RUN = 64


def window_runs(data: np.ndarray, off: np.ndarray, threshold: int, gram: int = GRAM, run: int = RUN) -> tuple:
    """(text, first start, windows, digit, content) of every run of windows, in order of position."""
    n, width = len(data), threshold - gram + 1
    if n < threshold:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    hashes = SpanHash(data)
    at = np.arange(n - gram + 1)
    # Fingerprint in the high bits, place in the low ones: the least value is the leftmost smallest gram.
    low = np.uint64((1 << int(n).bit_length()) - 1)
    value = (hashes.spans(at, at + gram) & ~low) | at.astype(np.uint64)
    padded = np.full(-(-len(value) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(value)] = value
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - threshold + 1], ahead[width - 1:width + n - threshold])
    windows = np.maximum(np.diff(off) - threshold + 1, 0)
    text = np.repeat(np.arange(len(windows)), windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + off[text]
    minimiser = (least[start] & low).astype(np.int64)
    slot = (minimiser - start) // run
    new = np.ones(len(text), bool)
    new[1:] = (minimiser[1:] != minimiser[:-1]) | (slot[1:] != slot[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(text)) - 1
    begin, end, minimiser, slot = start[first], start[last], minimiser[first], slot[first]
    shared = minimiser - run * slot
    digit = mix(hashes.spans(shared, shared - (run - 1) + threshold) + slot.astype(np.uint64)) if len(first) else np.zeros(0, np.uint64)
    content = mix(hashes.spans(begin, end + threshold) + (minimiser - begin).astype(np.uint64) * np.uint64(31))
    return text[first], begin - off[text[first]], end - begin + 1, digit, content


def _runs(threshold: int, gram: int, run: int):
    def go(batches):
        for b in batches:
            for rows, data, off in text_slices(b):
                text, begin, n, digit, content = window_runs(data, off, threshold, gram, run)
                if len(text):
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("key").take(pa.array(text)), pa.array(begin * run + n - 1), pa.array(digit.view(np.int64)), pa.array(content.view(np.int64))],
                        ["key", "span", "digit", "content"])
    return go


def _window_hashes(threshold: int, run: int):
    """The last digit: every window of the runs (begin * run + windows - 1, times seen) of a document."""
    def go(batches):
        for b in batches:
            for rows, data, off in text_slices(b):
                spans = rows.column("spans").flatten()
                if not len(spans):
                    continue
                doc = np.repeat(np.arange(rows.num_rows), pc.list_value_length(rows.column("spans")).to_numpy(zero_copy_only=False))
                code, seen = (spans.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                n = code % run + 1
                k = np.repeat(np.arange(len(code)), n)
                start = code[k] // run + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
                at = start + off[doc[k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(SpanHash(data).spans(at, at + threshold).view(np.int64)), rows.column("key").take(pa.array(doc[k])),
                     pa.array(start), pa.array(seen[k].astype(np.int32))], ["window", "key", "start", "seen"])
    return go


def covered(first: np.ndarray, last: np.ndarray, threshold: int) -> np.ndarray:
    """Union of the byte spans of windows first..last as an array of (start, end) rows."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order] + threshold)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > last[:-1]
    head = np.flatnonzero(new)
    return np.stack([first[head], last[np.append(head[1:], len(first)) - 1]], 1)


def _cut(threshold: int, run: int):
    def go(batches):
        for b in batches:
            for s in range(0, b.num_rows, 1000):
                part = b.slice(s, 1000)
                data, off = text_bytes(part.column("text"))
                rows = []
                for i, codes in enumerate(part.column("marks").to_pylist()):
                    text = data[off[i]:off[i + 1]]
                    spans = np.zeros((0, 2), np.int64)
                    if codes:
                        code = np.array(codes, np.int64)
                        spans = covered(code // run, code // run + code % run, threshold)
                    keep, at = [], 0
                    for a, e in spans.tolist():
                        keep.append(text[at:a].tobytes())
                        at = e
                    keep.append(text[at:].tobytes())
                    kept = b"".join(keep)
                    rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, spans.ravel().tolist()))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()),
                     pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.list_(pa.int64()))],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])
    return go


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, gram: int = GRAM,
                   run: int = RUN) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes left) and spans (start, end, start, end ...)."""
    if run & (run - 1) or not 0 < gram <= threshold - run:
        raise ValueError("run must be a power of two and gram + run at most the threshold")
    ready(docs.sparkSession)
    texts = docs.select(F.monotonically_increasing_id().alias("key"), col(id_col).cast("long").alias("id"),
                        F.coalesce(col(text_col), F.lit("")).alias("text"))
    runs = texts.select("key", "text").mapInArrow(_runs(threshold, gram, run), "key long, span long, digit long, content long")
    twice = runs.groupBy("digit").agg(F.count("*").alias("n")).filter("n > 1").select("digit")
    runs = stored(runs.join(twice, "digit"), "window-runs")
    contents = runs.groupBy("digit", "content").agg(F.count("*").alias("n"), F.min(F.struct("key", "span")).alias("one"))
    several = contents.groupBy("digit").agg(F.count("*").alias("k")).filter("k > 1").select("digit")
    open_ = contents.join(several, "digit").groupBy("one.key").agg(F.collect_list(F.struct("one.span", F.least("n", F.lit(2)).alias("seen"))).alias("spans"))
    windows = texts.select("key", "text").join(open_, "key").mapInArrow(_window_hashes(threshold, run), "window long, key long, start long, seen int")
    windows = stored(windows, "windows")
    again = windows.groupBy("window").agg(F.sum("seen").alias("n")).filter("n > 1").select("window")
    single = windows.filter("seen = 1").join(again, "window").select("key", (F.col("start") * run).alias("mark"))
    whole = runs.join(contents.filter("n > 1").select("digit", "content"), ["digit", "content"]).select("key", F.col("span").alias("mark"))
    marks = stored(whole.union(single).groupBy("key").agg(F.collect_list("mark").alias("marks")), "window-marks")
    out = texts.join(marks, "key", "left").select("id", "text", "marks")
    return out.mapInArrow(_cut(threshold, run), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<long>")
