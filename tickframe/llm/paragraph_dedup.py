"""Substring dedup over paragraphs: MinHash banding, exact verification, removals clustered by components.

Paragraphs are the lines of a text. As passages are often copied into the middle of a line, lines are also cut into sections:
after each word whose three-word context has the smallest fingerprint among ``SECTION`` neighbours, so a copied passage is
cut alike wherever it stands. Lines and sections with equal word sequences (letters A to Z lower-cased, white space
ignored) are one class. Lines of ``LINE_WORDS`` words or more are also banded: ``BANDS`` bands of ``ROWS`` MinHash
values over five-word shingles, which let 0.3 % of pairs at Jaccard 0.8 go by, fewer above. Classes that collide in a band are
verified on their exact shingle sets and joined to components (first with one pivot per band value, then across components, as in
the n-gram join).

One pass parses the texts: it writes every line's and section's place and digest, and the band values of each line that a block of texts
holds for the first time. What follows reads that table, but for the texts of colliding lines and the cut itself.

Of every component the first place stays: smallest id, then row, then position. Other places that are whole lines of
``LINE_WORDS`` words or more are removed; sections and shorter lines where runs of covered words reach ``MIN_RUN`` words, so short common
phrases within lines are left; a passage of 50 words or more always has such a run.

Null texts count as empty. Repeated rows are documents of their own, null ids come last when the place that stays is chosen. An
empty table gives an empty result. ``docs`` must give its rows in the same order at every read, as a table does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import SpanHash, col, discard, mix, ready, stored, text_slices
from tickframe.llm.ngram_join import PARITY, Candidates, parity_column
from tickframe.llm.shingles import lower_ascii, shingle_sets, word_spans
from tickframe.session import fresh_dir

BANDS, ROWS = 8, 3
SHINGLE, NUM, DEN = 5, 80, 100
SECTION, LINE_WORDS, MIN_RUN = 16, SHINGLE, 16

_SEEDS = mix(np.arange(1, 1025, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)


def units(data: np.ndarray, off: np.ndarray, section: int) -> tuple:
    """Every line and section as (text, first byte, end byte, words, sequence fingerprint, is a line, first word), and all words' fingerprints."""
    data = lower_ascii(data)
    text, start, end = word_spans(data, off)
    m = len(text)
    if not m:
        return (*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, bool, np.int64)), np.zeros(0, np.uint64))
    words = SpanHash(data).spans(start, end)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    new_line = np.ones(m, bool)
    new_line[1:] = (text[1:] != text[:-1]) | (breaks[start[1:]] != breaks[end[:-1]])
    line_first = np.flatnonzero(new_line)
    line_last = np.append(line_first[1:], m) - 1
    # Sections end after the least three-word context of any ``section`` neighbouring words.
    padded = np.concatenate([words[:1], words, words[-1:]])
    context = mix(padded[:-2] * _SEEDS[0] + padded[1:-1] * _SEEDS[1] + padded[2:] * _SEEDS[2])
    low = np.uint64((1 << int(m).bit_length()) - 1)
    value = (context & ~low) | np.arange(m, dtype=np.uint64)
    last = new_line.copy()
    last[:-1] = new_line[1:]
    last[-1] = True
    if m >= section:
        least = np.lib.stride_tricks.sliding_window_view(value, section).min(1)
        last[np.unique((least & low).astype(np.int64))] = True
    sec_last = np.flatnonzero(last)
    sec_first = np.concatenate([[0], sec_last[:-1] + 1])
    whole = new_line[sec_first] & np.isin(sec_last, line_last)
    first = np.concatenate([line_first, sec_first[~whole]])
    final = np.concatenate([line_last, sec_last[~whole]])
    n = final - first + 1
    digest = SpanHash(words).spans(first, final + 1)
    is_line = np.arange(len(first)) < len(line_first)
    return text[first], start[first], end[final], n, digest, is_line, first, words


def band_values(words: np.ndarray, first: np.ndarray, n: np.ndarray, k: int, bands: int, rows: int) -> np.ndarray:
    """One row of ``bands`` values for every line of ``n`` words from ``first`` on: MinHash over its k-word shingles (a shorter line's
    whole sequence). A shingle that a line holds twice has no more weight in a minimum."""
    count = np.maximum(n - k + 1, 1)
    to = np.cumsum(count)
    begin = np.repeat(first - to + count, count) + np.arange(to[-1] if len(to) else 0)
    size = np.minimum(n, k)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    h = np.zeros(len(begin), np.uint64)
    for j in range(k):
        part = padded[begin + j] * _SEEDS[512 + j]
        if len(size) and size.min() <= j:
            part[np.repeat(size <= j, count)] = 0
        h += part
    h = mix(h + np.repeat(size.astype(np.uint64), count) * _SEEDS[511])
    out = np.empty((len(n), bands), np.uint64)
    for band in range(bands):
        token = np.full(len(n), band + 1, np.uint64)
        for r in range(rows):
            # An odd factor permutes the 64-bit values; the values are mixed already.
            low = np.minimum.reduceat(h * _SEEDS[8 + band * rows + r], to - count) if len(n) else h
            token = mix(token * _SEEDS[4] + low)
        out[:, band] = token
    return out


def _scan(section: int, line_words: int, k: int, bands: int, rows: int):
    """The one parse of the texts: all places, with band values where a block of texts holds a line for the first time."""
    def run(batches):
        for b in batches:
            for part, data, off in text_slices(b):
                text, start, end, n, digest, is_line, first, words = units(data, off, section)
                line = is_line & (n >= line_words)
                at = np.flatnonzero(line)
                _, once = np.unique(digest[at], return_index=True)
                at = at[np.sort(once)]
                values = band_values(words, first[at], n[at], k, bands, rows)
                held = np.zeros(len(text) + 1, np.int32)
                held[at + 1] = bands
                tokens = pa.ListArray.from_arrays(pa.array(np.cumsum(held, dtype=np.int32)), pa.array(values.reshape(-1).view(np.int64)))
                of = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(of), part.column("id").take(of), pa.array((start - off[text]).astype(np.int32)),
                     pa.array((end - off[text]).astype(np.int32)), pa.array(digest.view(np.int64)), pa.array(line), tokens],
                    ["key", "id", "start", "end", "d", "line", "tokens"])
    return run


def _line_sets(k: int):
    def run(batches):
        for b in batches:
            for part, data, off in text_slices(b):
                h, at = shingle_sets(data, off, k)
                yield pa.RecordBatch.from_arrays([part.column("d"), pa.array(np.diff(at).astype(np.int32)), part.column("text"), parity_column(h, at)],
                                                 ["d", "n", "text", "parity"])
    return run


def _cut(min_run: int):
    """Cuts out whole lines and other runs of covered words from ``min_run`` on."""
    def covered(a, e, begins, ends):
        change = np.zeros(len(a) + 1, np.int64)
        np.add.at(change, np.searchsorted(a, begins), 1)
        np.add.at(change, np.searchsorted(e, ends) + 1, -1)
        return np.cumsum(change)[:-1] > 0

    def edges(cover):
        return np.flatnonzero(np.diff(np.concatenate([[0], cover, [0]]).astype(np.int8))).reshape(-1, 2)

    def run(batches):
        for b in batches:
            for rows, data, off in text_slices(b):
                text, start, end = word_spans(data, off)
                bounds = np.searchsorted(text, np.arange(len(off)))
                out = []
                lists = (rows.column(c).to_pylist() for c in ("begins", "ends", "line_begins", "line_ends"))
                for i, (begins, ends, line_begins, line_ends) in enumerate(zip(*lists)):
                    a, e = start[bounds[i]:bounds[i + 1]] - off[i], end[bounds[i]:bounds[i + 1]] - off[i]
                    doc = data[off[i]:off[i + 1]]
                    spans, gone = [], 0
                    if begins:
                        cut = covered(a, e, line_begins, line_ends)
                        for first, stop in edges(covered(a, e, begins, ends)).tolist():
                            if stop - first >= min_run:
                                cut[first:stop] = True
                        for first, stop in edges(cut).tolist():
                            spans.append((int(a[first]), int(e[stop - 1])))
                            gone += stop - first
                    keep, at = [], 0
                    for s, t in spans:
                        keep.append(doc[at:s].tobytes())
                        at = t
                    keep.append(doc[at:].tobytes())
                    kept = b"".join(keep).decode("utf-8", "replace") if spans else None
                    out.append((len(a), gone, len(spans), kept, [x for s in spans for x in s]))
                cols = list(zip(*out))
                texts = pc.coalesce(pa.array(cols[3], pa.string()), rows.column("text").cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), *(pa.array(c, pa.int64()) for c in cols[:3]), texts, pa.array(cols[4], pa.list_(pa.int64()))],
                    ["id", "n_words", "removed_words", "n_spans", "kept_text", "spans"])
    return run


def _central_first(index: DataFrame, lines: DataFrame) -> DataFrame:
    """The index (token, d) as (token, node, pos), ``pos`` telling how far a class is from the majority of its band value, in parity bits.

    Edits differ from copy to copy, so the majority of bits is that of the text the copies were made from, and the class nearest to it
    is the pivot that links to most of them.
    """
    rows = index.join(lines.select("d", "node", "parity"), "d")
    halves = ("p0", "p1")
    ones = [F.sum(F.shiftright(F.col(f"parity.{p}"), j).bitwiseAND(F.lit(1))).alias(f"{p}_{j}") for p in halves for j in range(64)]
    votes = rows.groupBy("token").agg(F.count("*").alias("votes"), *ones)
    major = votes.select("token", *[sum((F.when(2 * F.col(f"{p}_{j}") > F.col("votes"), F.shiftleft(F.lit(1).cast("long"), j)).otherwise(F.lit(0).cast("long"))
                                         for j in range(1, 64)), F.when(2 * F.col(f"{p}_0") > F.col("votes"), F.lit(1)).otherwise(F.lit(0)).cast("long")).alias("m" + p)
                                    for p in halves])
    away = [F.bit_count(F.col(f"parity.{p}").bitwiseXOR(F.col("m" + p))) for p in halves]
    return rows.join(major, "token").select("token", "node", (away[0] + away[1]).cast("int").alias("pos"))


def remove_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS, k: int = SHINGLE,
                      num: int = NUM, den: int = DEN, section: int = SECTION, line_words: int = LINE_WORDS, min_run: int = MIN_RUN) -> DataFrame:
    """One row per input row: id, n_words, removed_words, n_spans, kept_text and spans (start, end, start, end ... in bytes)."""
    ready(docs.sparkSession)
    texts = docs.select(F.monotonically_increasing_id().alias("key"), col(id_col).cast("long").alias("id"),
                        F.coalesce(col(text_col), F.lit("")).alias("text"))
    spark = docs.sparkSession
    scan_at, places_at = fresh_dir(spark, "paragraph-scan"), fresh_dir(spark, "paragraph-places")
    scan = stored(texts.mapInArrow(_scan(section, line_words, k, bands, rows), "key long, id long, start int, end int, d long, line boolean, tokens array<long>"),
                  "paragraph-scan", scan_at)
    # Near copies among lines.
    banded = scan.select(F.explode("tokens").alias("token"), "d")
    shared = banded.groupBy("token").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter("lo != hi").select("token")
    index = stored(banded.join(shared, "token").select("token", "d").distinct(), "band-index")
    # The texts of colliding lines, from one place each.
    found = scan.filter(F.size("tokens") > 0).join(index.select("d").distinct(), "d").groupBy("d").agg(F.min(F.struct("key", "start", "end")).alias("p"))
    found = found.groupBy("p.key").agg(F.collect_list(F.struct("p.start", "p.end", "d")).alias("at"))
    found = texts.join(found, "key").select(F.encode("text", "UTF-8").alias("raw"), F.explode("at").alias("p"))
    found = found.select("p.d", F.expr("decode(substring(raw, p.start + 1, p.end - p.start), 'UTF-8')").alias("text"))
    lines = found.mapInArrow(_line_sets(k), f"d long, n int, text string, parity {PARITY}")
    lines = stored(lines.select("d", F.struct("d", "n").alias("node"), "text", "parity"), "band-lines")
    index = stored(_central_first(index, lines), "central-index")
    roots = stored(Candidates(index, lines.select("node", "text"), lines.select("node", "parity"), k, num, den).roots().select(F.col("node.d").alias("d"), F.col("root.d").alias("label")), "line-roots")
    # Every place of a class that is met twice or has near copies.
    places = scan.drop("tokens")
    twice = places.groupBy("d").agg(F.count("*").alias("n")).filter("n > 1").select("d")
    twice = twice.union(roots.select("d")).distinct().join(roots, "d", "left").select("d", F.coalesce("label", "d").alias("label"))
    twice = stored(twice, "met-twice")  # a plain exchange on both sides lets a hot line's join be split
    places = stored(places.join(twice, "d").select("key", "id", "start", "end", "line", "label"), "paragraph-places", places_at)
    discard(spark, scan_at)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "start", "end")
    stays = stored(places.groupBy("label").agg(F.min(place).alias("stays")), "first-places")  # so a hot label's join can be split too
    gone = places.join(stays, "label").filter((F.col("key") != F.col("stays.key")) | (F.col("start") != F.col("stays.start")) | (F.col("end") != F.col("stays.end")))
    gone = stored(gone.groupBy("key").agg(F.collect_list("start").alias("begins"), F.collect_list("end").alias("ends"),
                                   *[F.collect_list(F.when(F.col("line"), F.col(c))).alias(to) for c, to in (("start", "line_begins"), ("end", "line_ends"))]), "paragraph-cuts")
    discard(spark, places_at)
    out = texts.join(gone, "key", "left").select("id", "text", "begins", "ends", "line_begins", "line_ends")
    return out.mapInArrow(_cut(min_run), "id long, n_words long, removed_words long, n_spans long, kept_text string, spans array<long>")
