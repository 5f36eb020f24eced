"""Language-model scoring by Katz backoff over words.

Counts come from all training documents: n-grams of orders 1 to ``order`` over the words of each document and one end, with
counts lowered by Good-Turing estimates (a line fitted to the logarithms of the counts of counts). Every n-gram of the
training text is in the model, whatever its count and the size of the corpus; the discounts make the mass that backoff
weights hand to the next lower order, computed from the very sums they must balance:

    P(w | h) = d(c(hw)) c(hw) / c(h)       if hw is in the model
             = a(h) P(w | h without its first word)  otherwise
    a(h)     = (1 - sum of the kept P(w | h)) / (1 - sum of the lower P of the same w)

The lowest order holds every training word, and one unit for all others, with the mass of words seen once.

Words are 63-bit fingerprints, the most frequent ones numbers. Texts are dealt to blocks; the distinct n-grams of a block go, packed and
compressed, to buckets by their last context word, where all contexts that end in it are whole and the recursion runs order by order. Context words
too frequent for one bucket are dealt over several by the word before, and their bigrams are summed and weighted in a table. The probabilities come
back to the blocks as 4-byte floats and are summed in doubles. Nothing that grows with the corpus goes to the driver or to every task.

``fit`` and a ``share`` given to ``score_documents`` are the bounded variant: words and n-grams below that share of all tokens
are left out, and the conditional part of the model goes to every task.

Null texts count as empty (one end token). Repeated rows count and score as often as they come; null ids hash as the empty text; an empty
training set gives uniform mass to the unknown unit. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import SpanHash, col, crc_mod, discard, mix, ready, stored, text_bytes, text_slices
from tickframe.llm.shingles import lower_ascii, word_spans
from tickframe.session import fresh_dir

ORDER = 3
HELD_OUT_OF = 10
# The one token that no word can be: a space.
END = " "
# Fingerprint of the end.
END_MARK = np.uint64(0x5851F42D4C957F2D)
# Most frequent words that have a number of their own (at most 4 MB to every task); others travel as fingerprints with the highest bit set.
TOP_WORDS, RARE = 1 << 18, np.uint64(1 << 63)
# Text of a block, and of a bucket's share; the number of both grows with the corpus.
BLOCK_BYTES = 4_000_000
# Buckets are evaluated in so many rounds: only one round's n-grams lie in shuffle files at a time.
ROUNDS = 2
# Rows of a bucket that are merged and evaluated at once, about: a worker's arrays do not grow with the largest bucket's n-grams.
PART_ROWS = 1 << 16
_SEEDS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def word_array(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(text of each word, the words) lower-cased, in order."""
    data = lower_ascii(data)
    text, start, end = word_spans(data, off)
    at = np.concatenate([[0], np.cumsum(end - start)])
    flat = data[(data != 32) & ((data < 9) | (data > 13))]
    return text, pa.Array.from_buffers(pa.large_string(), len(text), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)])


def _word_counts(batches):
    """Training words with their counts in one block; the end token comes once for every document."""
    for b in batches:
        for rows, data, off in text_slices(b, most=8_000_000):
            train = rows.column("train").to_numpy(zero_copy_only=False)
            text, words = word_array(data, off)
            d = words.filter(pa.array(train[text])).dictionary_encode()
            counts = np.bincount(d.indices.to_numpy(zero_copy_only=False), minlength=len(d.dictionary))
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([d.dictionary.cast(pa.string()), pa.array([END])]), pa.array(np.append(counts, train.sum()).astype(np.int64))],
                ["word", "n"])


class Vocabulary:
    """Context words by number; every other word shares the last number."""

    def __init__(self, words: list):
        self.words = sorted({*words, END})
        self.end = self.words.index(END)
        self.other = len(self.words)
        self.number = {w: i for i, w in enumerate(self.words)}

    def ids(self, words: pa.Array) -> np.ndarray:
        d = words.dictionary_encode()
        known = np.array([self.number.get(w, self.other) for w in d.dictionary.to_pylist()], np.int64)
        return known[d.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)


def _with_ends(text: np.ndarray, ids: np.ndarray, n: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token stream with an end after every document: (document, id, place of each word)."""
    place = np.arange(len(text)) + text
    doc = np.empty(len(text) + n, np.int64)
    out = np.full(len(text) + n, end, np.int64)
    count = np.bincount(text, minlength=n)
    doc[:] = np.repeat(np.arange(n), count + 1)
    out[place] = ids
    return doc, out, place


def _windows(doc: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the n-grams that stay in one document and hold only numbered words but for the last: (end place, ok)."""
    at = np.arange(n - 1, len(ids))
    return at, doc[at - (n - 1)] == doc[at] if len(at) else np.zeros(0, bool)


def pack(columns: list, base: int) -> np.ndarray:
    """N-grams of word numbers as one number each (exact while base ** n < 2 ** 63)."""
    out = columns[0].copy()
    for c in columns[1:]:
        out = out * base + c
    return out


def _ngram_counts(n: int, vocab, lower: dict):
    """Counts of n-grams in a block whose own (n - 1)-grams are kept (an n-gram is never more frequent than those)."""
    def run(batches):
        v = vocab.value
        base = v.other + 1
        kept = {k: t.value for k, t in lower.items()}
        for b in batches:
            for rows, data, off in text_slices(b, most=8_000_000):
                train = rows.column("train").to_numpy(zero_copy_only=False)
                text, words = word_array(data, off)
                doc, ids, _ = _with_ends(text, v.ids(words), len(off) - 1, v.end)
                at, ok = _windows(doc, ids, n)
                at = at[ok & train[doc[at]]] if len(at) else at
                parts = [ids[at - (n - 1 - k)] for k in range(n)]
                ok = np.ones(len(at), bool)
                for p in parts:
                    ok &= p != v.other
                if n > 2:
                    for sub in (parts[:-1], parts[1:]):
                        ok &= _find(kept[n - 1], pack(sub, base)) >= 0
                keys, counts = np.unique(pack([p[ok] for p in parts], base), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], ["gram", "n"])
    return run


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted array, -1 where it is missing."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def good_turing(counts_of_counts: list) -> tuple[float, float]:
    """(a, b) of the line log Z = a + b log r through the averaged counts of counts; b is at most -1.

    The discounted count is r* = (r + 1) S(r + 1) / S(r) = r (1 + 1 / r) ** (b + 1), between 0 and r for every r.
    """
    rows = sorted(counts_of_counts)
    if len(rows) < 2:
        return 0.0, -1.5
    r = np.array([x for x, _ in rows], float)
    n = np.array([y for _, y in rows], float)
    before = np.concatenate([[0], r[:-1]])
    after = np.append(r[1:], 2 * r[-1] - before[-1])
    z = n / (0.5 * (after - before))
    b, a = np.polyfit(np.log(r), np.log(z), 1)
    return float(a), float(min(b, -1.0001))


def discount(count, slope: float):
    """Good-Turing share of a count that is kept."""
    return (1 + 1 / np.maximum(count, 1)) ** (slope + 1)


class Model:
    """The conditional part: kept n-grams as sorted arrays with log probabilities, and backoff weights of contexts."""

    def __init__(self, vocab: Vocabulary, unigram: np.ndarray, order: int):
        self.vocab, self.base, self.order = vocab, vocab.other + 1, order
        self.unigram = unigram  # log10 probability of every context word; the last number is looked up by word
        self.keys: dict = {}
        self.logp: dict = {}
        self.contexts: dict = {}  # n -> (sorted (n - 1)-gram contexts, log10 backoff weight)

    def lower(self, parts: list) -> np.ndarray:
        """log10 P of the last word given the others, for kept words: the recursion of the module's head."""
        if len(parts) == 1:
            return self.unigram[parts[0]]
        n = len(parts)
        at = _find(self.keys[n], pack(parts, self.base))
        out = np.empty(len(parts[0]))
        hit = at >= 0
        out[hit] = self.logp[n][at[hit]]
        if not hit.all():
            rest = [p[~hit] for p in parts]
            out[~hit] = self.backoff(rest[:-1]) + self.lower(rest[1:])
        return out

    def backoff(self, context: list) -> np.ndarray:
        """log10 of the backoff weight of each context (0 where the model keeps no n-gram after it)."""
        keys, weight = self.contexts[len(context) + 1]
        at = _find(keys, pack(context, self.base))
        return np.where(at >= 0, weight[np.maximum(at, 0)] if len(weight) else 0.0, 0.0)

    def add(self, n: int, keys: np.ndarray, counts: np.ndarray, slope: float, context_count) -> None:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(float)
        parts, rest = [], keys
        for _ in range(n):
            parts.append(rest % self.base)
            rest = rest // self.base
        parts = parts[::-1]
        context = keys // self.base
        p = counts * discount(counts, slope) / context_count(context)
        self.keys[n], self.logp[n] = keys, np.log10(p)
        heads, which = np.unique(context, return_inverse=True)
        below = np.power(10.0, self.lower(parts[1:])) if len(keys) else np.zeros(0)
        kept = np.bincount(which, p, len(heads))
        under = np.bincount(which, below, len(heads))
        weight = np.log10(np.maximum(1 - kept, 1e-12)) - np.log10(np.maximum(1 - under, 1e-12))
        self.contexts[n] = (heads, weight)

    def score_tokens(self, doc: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every token log10 P without the lowest order's part where the word isn't a context word, and that mask."""
        total = np.zeros(len(ids))
        other = ids == self.vocab.other
        age = np.arange(len(ids)) - np.searchsorted(doc, doc)  # tokens of the document before this one
        todo = np.arange(len(ids))
        for n in range(self.order, 1, -1):
            # Context of n - 1 words, where the document has them and all are context words.
            use = todo[age[todo] >= n - 1]
            parts = [ids[use - (n - 1 - k)] for k in range(n)]
            ok = np.ones(len(use), bool)
            for p in parts[:-1]:
                ok &= p != self.vocab.other
            use, parts = use[ok], [p[ok] for p in parts]
            at = np.where(parts[-1] != self.vocab.other, _find(self.keys[n], pack(parts, self.base)), -1)
            hit = at >= 0
            total[use[hit]] += self.logp[n][at[hit]]
            total[use[~hit]] += self.backoff([p[~hit] for p in parts[:-1]])
            done = np.zeros(len(ids), bool)
            done[use[hit]] = True
            todo = todo[~done[todo]]
        rest = todo[~other[todo]]
        total[rest] += self.unigram[ids[rest]]
        return total, other


def _score(model, order: int):
    """Rows of a document: its own sums (word null), and its words outside the context vocabulary with their number of uses."""
    def run(batches):
        m = model.value
        for b in batches:
            for rows, data, off in text_slices(b, most=8_000_000):
                n = len(off) - 1
                text, words = word_array(data, off)
                ids = m.vocab.ids(words)
                doc, stream, _ = _with_ends(text, ids, n, m.vocab.end)
                logp, _ = m.score_tokens(doc, stream)
                total = np.bincount(doc, logp, n)
                head = stream != m.vocab.other
                base = np.bincount(doc[head], m.base_logp[stream[head]], n)
                known = np.bincount(doc[head & m.seen[stream]], minlength=n)
                tokens = np.bincount(doc, minlength=n)
                key = rows.column("key")
                rare = ids == m.vocab.other
                d = words.filter(pa.array(rare)).dictionary_encode()
                pair, uses = np.unique(text[rare] * max(len(d.dictionary), 1) + d.indices.to_numpy(zero_copy_only=False), return_counts=True)
                at, word = pair // max(len(d.dictionary), 1), pair % max(len(d.dictionary), 1)
                k = len(pair)
                none = lambda t: pa.nulls(k, t)
                ident, held = rows.column("id"), rows.column("held_out")
                for arrays in ([key, ident, held, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(total), pa.array(base),
                                pa.array(known), pa.array(tokens)],
                               [key.take(pa.array(at)), none(ident.type), none(pa.bool_()), d.dictionary.take(pa.array(word)).cast(pa.string()),
                                pa.array(uses.astype(np.int64)), none(pa.float64()), none(pa.float64()), none(pa.int64()), none(pa.int64())]):
                    yield pa.RecordBatch.from_arrays(arrays, ["key", "id", "held_out", "word", "uses", "logp", "base", "known", "tokens"])
    return run


_SCORED = "key long, id {}, held_out boolean, word string, uses long, logp double, base double, known long, tokens long"


def count_words(rows: DataFrame) -> DataFrame:
    """Every training word (and the end token) with its count, partitioned by hash in the shared folder."""
    words = rows.mapInArrow(_word_counts, "word string, n long").filter("n > 0")
    return stored(words.groupBy("word").agg(F.sum("n").alias("n")), "katz-order-1")


def fit(rows: DataFrame, order: int = ORDER, share: float = 0.0):
    """(conditional model, word table, facts): rows has text and train."""
    spark = rows.sparkSession
    words = count_words(rows)
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ofcounts = _counts_of_counts(words)
    _, slope = good_turing(ofcounts)
    once = dict(ofcounts).get(1, 0)
    # Mass of words never seen: Good-Turing's share of words seen once; one word at least.
    unseen = max(once, 1) / (total + max(once, 1)) if total else 1.0
    kept_mass = words.agg(F.sum(_star(F.col("n"), slope))).first()[0] or 1.0
    scale = (1 - unseen) / kept_mass
    least = max(share * total, 1)
    head = words.filter((F.col("n") >= least) | (F.col("word") == END)).toPandas()  # at most 1 / share words, and the end
    head = dict(zip(head["word"], head["n"]))
    vocab = Vocabulary(list(head))
    head_n = np.array([head.get(w, 0) for w in vocab.words] + [0], float)
    unigram = np.log10(np.where(head_n > 0, head_n * discount(head_n, slope) * scale, unseen))
    model = Model(vocab, unigram, order)
    model.seen = head_n > 0
    model.base_logp = np.log10((head_n + 0.1) / (total + 0.1 * (distinct + 1)))
    facts = {"total": int(total), "distinct": int(distinct), "slope": slope, "scale": scale, "unseen": unseen}
    shared = spark.sparkContext.broadcast(vocab)
    kept: dict = {}
    for n in range(2, order + 1):
        grams = rows.mapInArrow(_ngram_counts(n, shared, kept), "gram long, n long")
        grams = stored(grams.groupBy("gram").agg(F.sum("n").alias("n")), f"katz-order-{n}")
        _, slope_n = good_turing(_counts_of_counts(grams))
        found = grams.filter(F.col("n") >= least).toPandas()  # at most 1 / share n-grams
        keys, counts = found["gram"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
        if n == 2:
            context_count = lambda c: head_n[c]
        else:
            lower_keys, lower_counts = kept_counts
            context_count = lambda c, k=lower_keys, v=lower_counts: v[_find(k, c)]
        model.add(n, keys, counts, slope_n, context_count)
        by = np.argsort(keys)
        kept_counts = (keys[by], counts[by].astype(float))
        kept[n] = spark.sparkContext.broadcast(keys[by])
    return model, words, facts


def _star(n, slope: float):
    return n * F.pow(1 + 1 / n, F.lit(slope + 1))


def _counts_of_counts(counts: DataFrame) -> list:
    """(count, how many have it); counts from 1,000 on are left to the fitted line."""
    rows = counts.filter("n < 1000").groupBy("n").agg(F.count("*").alias("m")).collect()
    return [(r["n"], r["m"]) for r in rows]


def _marks(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of every token, its number among the distinct words, their 63-bit fingerprints)."""
    text, words = word_array(data, off)
    d = words.dictionary_encode()
    flat, at = text_bytes(d.dictionary)
    marks = np.append(SpanHash(flat).spans(at[:-1], at[1:]), END_MARK) >> np.uint64(1)
    doc, ids, _ = _with_ends(text, d.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(off) - 1, len(marks) - 1)
    return doc, ids, marks


def _mark_counts(batches):
    """Distinct words of a block with their training count (0 for those of held-out documents alone)."""
    for b in batches:
        for rows, data, off in text_slices(b, most=4_000_000):
            train = rows.column("train").to_numpy(zero_copy_only=False)
            doc, ids, marks = _marks(data, off)
            counts = np.bincount(ids[train[doc]], minlength=len(marks))
            yield pa.RecordBatch.from_arrays([pa.array(marks.view(np.int64)), pa.array(counts.astype(np.int64))], ["w", "n"])


class Coding:
    """Words as numbers: 0 stands before a document, then the ``TOP_WORDS`` most frequent words, most frequent first; any other word is
    its fingerprint with the highest bit set. Only the frequent ones go to every task, so its size does not depend on the corpus."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, order: int, buckets: int, total: int):
        by = np.argsort(words)
        self.words, self.code = words[by], by.astype(np.uint64) + np.uint64(1)
        self.counts = np.concatenate([[0], counts]).astype(np.int64)
        self.order, self.buckets = order, buckets
        # Parts into which the n-grams of a frequent last context word are dealt.
        self.parts = np.maximum(self.counts * buckets // max(total, 1), 1).astype(np.uint64)

    def codes(self, marks: np.ndarray) -> np.ndarray:
        at = _find(self.words, marks)
        return np.where(at >= 0, self.code[np.maximum(at, 0)] if len(self.code) else np.uint64(0), marks | RARE)

    def known(self, codes: np.ndarray) -> np.ndarray:
        """Training counts of frequent words; -1 for the others."""
        top = codes < RARE
        return np.where(top, self.counts[np.where(top, codes, np.uint64(0)).astype(np.int64)], -1)

    def split(self, codes: np.ndarray) -> np.ndarray:
        """Which context words have their n-grams in several buckets."""
        return (codes < RARE) & (self.parts[np.where(codes < RARE, codes, np.uint64(0)).astype(np.int64)] > 1)

    def deal(self, parts: list) -> np.ndarray:
        """Hash by the last context word: all contexts that end in it, of any order, share it. A frequent one is dealt further by the word
        before it, so contexts of two words and more stay whole; n-grams at a document's start need no context and go by their word."""
        last = parts[-2]
        deal = self.parts[np.where(last < RARE, last, np.uint64(0)).astype(np.int64)]
        other = mix(parts[-3] if self.order > 2 else parts[-1])
        return np.where(last == 0, mix(parts[-1] + np.uint64(7)), mix(last * _SEEDS[1] + np.where((last < RARE) & (deal > 1), other % deal, np.uint64(0)) * _SEEDS[2]))

    def bucket(self, parts: list) -> np.ndarray:
        return (mix(self.deal(parts)) % np.uint64(self.buckets)).astype(np.int64)


def _hashed(parts: list) -> np.ndarray:
    return mix(sum(mix(p + np.uint64(1)) * _SEEDS[i] for i, p in enumerate(parts)))


def _block_grams(doc: np.ndarray, ids: np.ndarray, codes: np.ndarray, coding: Coding):
    """Distinct n-grams of a block by bucket, then context: (words, one array a place; bucket; the row of each token).

    The order depends on the set of n-grams alone, so that a recomputed block meets its answers."""
    # Words by the order of their codes; 0 stands before the document.
    codes, rank = np.unique(np.append(codes, np.uint64(0)), return_inverse=True)
    ids = rank.astype(np.uint32)[ids]
    age = np.arange(len(doc)) - np.searchsorted(doc, doc)
    parts = []
    for k in range(max(coding.order, 2) - 1, -1, -1):
        before = np.concatenate([np.zeros(min(k, len(ids)), np.uint32), ids[:len(ids) - k]]) if k else ids
        parts.append(np.where(age >= k, before, np.uint32(0)) if k < coding.order else np.zeros(len(ids), np.uint32))
    del age, rank
    # The last context word leads, then the words before it, then the word itself.
    lead = [parts[-2], *parts[-3::-1], parts[-1]]
    if len(codes) ** len(lead) < 1 << 63:
        _, first, which = np.unique(pack([lead[0].astype(np.uint64), *lead[1:]], np.uint64(len(codes))), return_index=True, return_inverse=True)
    else:
        _, first, which = np.unique(_hashed([p.astype(np.uint64) for p in parts]), return_index=True, return_inverse=True)
        by = np.lexsort([p[first] for p in lead[::-1]])
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        first, which = first[by], place[which]
    parts = [codes[p[first].astype(np.int64)] for p in parts]
    bucket = coding.bucket(parts)
    by = np.argsort(bucket.astype(np.uint16) if coding.buckets <= 1 << 16 else bucket, kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    return [p[by] for p in parts], bucket[by], place[which]


def _pack_rows(parts: list, counts: np.ndarray) -> tuple[bytes, bytes]:
    """(numbers of frequent words and counts by byte place, compressed; fingerprints of the other words)."""
    rare = [p >= RARE for p in parts]
    small = [np.where(r, np.uint64(0xFFFFFF), p).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T for r, p in zip(rare, parts)]
    planes = np.concatenate([*small, counts.astype("<i4").view(np.uint8).reshape(-1, 4).T])
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True), np.concatenate([p[r] for r, p in zip(rare, parts)]).astype("<u8").tobytes()


def _unpack_rows(n: int, width: int, packed: bytes, rare: bytes) -> tuple[list, np.ndarray]:
    planes = np.frombuffer(pa.decompress(packed, n * (3 * width + 4), "zstd", asbytes=True), np.uint8).reshape(-1, n)
    rare, parts, used = np.frombuffer(rare, "<u8"), [], 0
    for k in range(width):
        a, b, c = (planes[3 * k + i].astype(np.uint64) for i in range(3))
        p = a | (b << np.uint64(8)) | (c << np.uint64(16))
        other = p == 0xFFFFFF
        m = int(other.sum())
        p[other] = rare[used:used + m]
        used += m
        parts.append(p)
    return parts, np.ascontiguousarray(planes[-4:].T).view("<i4").ravel().astype(np.int64)


_PACKED = "block long, bucket long, n_rows long, packed binary, rare binary"


def _gram_blocks(shared):
    """Every block's distinct n-grams with training counts, one packed row a bucket."""
    def run(t):
        coding = shared.value
        (data, off), train = text_bytes(t.column("text")), t.column("train").to_numpy()
        doc, ids, marks = _marks(data, off)
        parts, bucket, row = _block_grams(doc, ids, coding.codes(marks), coding)
        counts = np.bincount(row[train[doc]], minlength=len(bucket))
        at = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        cells = [_pack_rows([p[i:j] for p in parts], counts[i:j]) for i, j in zip(at[:-1], at[1:])]
        return pa.table([pa.array(np.full(len(cells), t.column("block")[0].as_py(), np.int64)), pa.array(bucket[at[:-1]]), pa.array(np.diff(at)),
                         pa.array([c[0] for c in cells], pa.binary()), pa.array([c[1] for c in cells], pa.binary())],
                        names=["block", "bucket", "n_rows", "packed", "rare"])
    return run


def _bucket_rows(t, coding: Coding, part_rows: int):
    """A bucket's rows in turn, block by block: (words, counts, part of each row, parts). Equal contexts lie in one part, as in one bucket."""
    width, sizes = max(coding.order, 2), t.column("n_rows").to_pylist()
    n = sum(sizes)
    parts, counts, part = [np.empty(n, np.uint64) for _ in range(width)], np.empty(n, np.int32), np.empty(n, np.uint16)
    many = min(max(1, -(-n // part_rows)), 1 << 16)
    packed, rare, upto = t.column("packed"), t.column("rare"), 0
    for i, m in enumerate(sizes):
        rows, counted = _unpack_rows(m, width, packed[i].as_py(), rare[i].as_py())
        here = slice(upto, upto + m)
        for p, r in zip(parts, rows):
            p[here] = r
        counts[here] = counted
        part[here] = mix(coding.deal(rows) + _SEEDS[4]) % np.uint64(many)
        upto += m
    pa.default_memory_pool().release_unused()
    return parts, counts, part, many


def _merge(parts: list, counts: np.ndarray):
    """Distinct n-grams: (words, counts, the distinct one of each row)."""
    _, first, which = np.unique(_hashed(parts), return_index=True, return_inverse=True)
    return [p[first] for p in parts], np.bincount(which, counts, len(first)).astype(np.int64), which


_ASKED = "kind int, bucket long, w2 long, w1 long, n long"


def _survey(shared, part_rows: int):
    """What a bucket has to tell and to ask: counts of counts (kind: the order, w1: the count), words whose count it lacks (kind 0), and its
    part of the bigrams of context words that several buckets share (kind 1)."""
    def run(t):
        coding = shared.value
        bucket = t.column("bucket")[0].as_py()
        rows, seen, part, many = _bucket_rows(t, coding, part_rows)
        lone, pairs, ofcounts = [], [], []
        for i in range(many):
            at = np.flatnonzero(part == i)
            parts, n, _ = _merge([p[at] for p in rows], seen[at])
            hot = coding.split(parts[-2])
            lone.append(np.unique(parts[-1][(parts[-1] >= RARE) & ~hot]))
            for k in range(2, coding.order + 1):
                use = parts[-k] != 0
                _, first, which = np.unique(_hashed([p[use] for p in parts[-k:]]), return_index=True, return_inverse=True)
                counts = np.bincount(which, n[use], len(first)).astype(np.int64)
                if k == 2:
                    split = hot[use][first]
                    pairs.append((parts[-2][use][first][split], parts[-1][use][first][split], counts[split]))
                    counts = counts[~split]
                r, m = np.unique(counts[(counts > 0) & (counts < 1000)], return_counts=True)
                ofcounts.append((k, r, m))
        out = []

        def add(kind, w2, w1, counts):
            k = len(w1)
            out.append(pa.table([pa.array(np.full(k, kind, np.int32)), pa.array(np.full(k, bucket, np.int64)), pa.array(w2.view(np.int64)),
                                 pa.array(w1.view(np.int64)), pa.array(counts.astype(np.int64))], names=["kind", "bucket", "w2", "w1", "n"]))
        asked = np.unique(np.concatenate(lone)) if lone else np.zeros(0, np.uint64)
        add(0, np.zeros(len(asked), np.uint64), asked, np.zeros(len(asked)))
        # A pair may lie in several parts of a bucket; it is asked for once. A model of single words has none.
        if pairs:
            w2, w1, counts = (np.concatenate(x) for x in zip(*pairs))
            _, first, which = np.unique(_hashed([w2, w1]), return_index=True, return_inverse=True)
            add(1, w2[first], w1[first], np.bincount(which, counts, len(first)))
        for k, r, m in ofcounts:
            add(k, np.zeros(len(r), np.uint64), r.astype(np.uint64), m)
        return pa.concat_tables(out)
    return run


def _left(x):
    return np.log10(np.maximum(1 - x, 1e-12))


def _evaluate(shared, slopes: dict, facts: dict, part_rows: int):
    """log10 probability of every n-gram of a bucket, for each block in the order of its packed rows; and counts of its other last words."""
    def run(t, answers):
        coding = shared.value
        w2, w1 = (answers.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("w2", "w1"))
        got_n, got_logp = answers.column("n_word").to_numpy(), answers.column("logp").to_numpy()
        key = np.where(w2 == 0, w1, mix(w2 * _SEEDS[3] + w1))
        by = np.argsort(key)
        key, got_n, got_logp = key[by], got_n[by], got_logp[by]
        rows, seen, part, many = _bucket_rows(t, coding, part_rows)
        row_logp, row_word = np.empty(len(part), "<f4"), np.empty(len(part), "<i8")
        for i in range(many):
            mine = np.flatnonzero(part == i)
            parts, n, which = _merge([p[mine] for p in rows], seen[mine])
            logp, word = probabilities(coding, parts, n, key, got_n, got_logp)
            row_logp[mine], row_word[mine] = logp.astype("<f4")[which], word[which]
        rare = rows[-1] >= RARE
        cells, upto = [], 0
        for m in t.column("n_rows").to_pylist():
            here = slice(upto, upto + m)
            upto += m
            cells.append((row_logp[here].tobytes(), row_word[here][rare[here]].tobytes()))
        return pa.table([t.column("block"), t.column("bucket"), pa.array([c[0] for c in cells], pa.binary()), pa.array([c[1] for c in cells], pa.binary())],
                        names=["block", "bucket", "logp", "counts"])

    def probabilities(coding, parts, n, key, got_n, got_logp):
        hot = coding.split(parts[-2])
        at = _find(key, np.where(hot, mix(parts[-2] * _SEEDS[3] + parts[-1]), parts[-1]))
        word = coding.known(parts[-1])
        word = np.where(word >= 0, word, got_n[np.maximum(at, 0)] if len(key) else 0)
        seen = np.maximum(word, 1)
        logp = np.where(word > 0, np.log10(seen * discount(seen, facts["slope"]) * facts["scale"]), math.log10(facts["unseen"]))
        for k in range(2, coding.order + 1):
            use = np.flatnonzero(parts[-k] != 0)
            _, first, gram = np.unique(_hashed([p[use] for p in parts[-k:]]), return_index=True, return_inverse=True)
            count = np.bincount(gram, n[use], len(first))
            first = use[first]
            heads, head = np.unique(_hashed([p[first] for p in parts[-k:-1]]), return_inverse=True)
            met = count > 0
            star = np.maximum(count, 1) * discount(count, slopes[k])
            total = np.bincount(head[met], count[met], len(heads))
            kept = np.bincount(head[met], star[met], len(heads)) / np.maximum(total, 1)
            under = np.bincount(head[met], np.power(10.0, logp[first][met]), len(heads))
            weight = np.where(total > 0, _left(kept) - _left(under), 0.0)
            new = np.where(met, np.log10(star / np.maximum(total[head], 1)), weight[head] + logp[first])
            if k == 2 and len(key):
                new = np.where(hot[first], got_logp[np.maximum(at[first], 0)], new)
            logp[use] = new[gram]
        return logp, word
    return run


def _sum_up(shared, facts: dict, fields: list):
    """Documents of a block with the sums of their tokens."""
    denominator = math.log10(facts["total"] + 0.1 * (facts["distinct"] + 1))

    def run(t, answers):
        coding = shared.value
        data, off = text_bytes(t.column("text"))
        doc, ids, marks = _marks(data, off)
        parts, _, row = _block_grams(doc, ids, coding.codes(marks), coding)
        answers = answers.sort_by("bucket")
        logp = np.frombuffer(b"".join(answers.column("logp").to_pylist()), "<f4").astype(float)
        word = coding.known(parts[-1])
        word[word < 0] = np.frombuffer(b"".join(answers.column("counts").to_pylist()), "<i8")
        rows = len(off) - 1
        sums = lambda x: np.bincount(doc, x[row], rows)
        counted = [pa.array(np.bincount(doc, minlength=rows)), pa.array(sums((word > 0).astype(float)).astype(np.int64)),
                   pa.array(sums(np.log10(word + 0.1) - denominator)), pa.array(sums(logp))]
        return pa.table([t.column("id"), t.column("held_out"), *counted], names=fields)
    return run


def _score_whole(docs: DataFrame, id_col: str, text_col: str, held_out_of: int, order: int, block_bytes: int, part_rows: int) -> DataFrame:
    """The whole model. Texts are dealt to blocks by a hash of id and text, so a recomputed task makes the same blocks; a block's distinct n-grams
    go, packed, to buckets by last context word, and their probabilities come back to the block."""
    spark = docs.sparkSession
    held_out = crc_mod(col(id_col), held_out_of) == 0
    text = F.coalesce(col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text).cast("long")), F.count("*")).first()
    buckets = max(1, -(-((size[0] or 0) + 7 * size[1]) // block_bytes))
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.pmod(F.xxhash64(col(id_col), text), F.lit(buckets)).alias("block"), col(id_col).alias("id"), held_out.alias("held_out"), text.alias("text"))
    words = rows.select((~F.col("held_out")).alias("train"), "text").mapInArrow(_mark_counts, "w long, n long")
    words = stored(words.groupBy("w").agg(F.sum("n").alias("n")), "katz-words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    ofcounts = _counts_of_counts(words.filter("n > 0"))
    _, slope = good_turing(ofcounts)
    once = dict(ofcounts).get(1, 0)
    # Mass of words never seen: Good-Turing's share of words seen once; one word at least.
    unseen = max(once, 1) / (total + max(once, 1)) if total else 1.0
    kept_mass = words.filter("n > 0").agg(F.sum(_star(F.col("n"), slope))).first()[0] or 1.0
    facts = {"total": int(total), "distinct": int(distinct), "slope": slope, "scale": (1 - unseen) / kept_mass, "unseen": unseen}
    # The lowest count that at most TOP_WORDS words reach, by steps of an eighth of a power of two.
    step = F.floor(F.log2("n") * 8)
    least, found = 1 << 20, 0
    for r in sorted(words.filter("n > 0").groupBy(step.alias("step")).agg(F.count("*").alias("m")).collect(), reverse=True):
        found += r["m"]
        if found > TOP_WORDS:
            break
        least = r["step"]
    top = words.filter((F.col("n") > 0) & (step >= least)).toPandas().sort_values(["n", "w"], ascending=[False, True])
    shared = spark.sparkContext.broadcast(Coding(top["w"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), order, buckets, int(total)))

    at = fresh_dir(spark, "katz-grams")
    grams = rows.select("block", (~F.col("held_out")).alias("train"), "text").groupBy("block").applyInArrow(_gram_blocks(shared), _PACKED)
    grams = stored(grams, "katz-grams", at)
    asked = stored(grams.groupBy("bucket").applyInArrow(_survey(shared, part_rows), _ASKED), "katz-asked")
    # Frequent words are numbered in the requests; their counts come from the same table by their fingerprints.
    numbered = spark.createDataFrame(top.assign(code=np.arange(1, len(top) + 1)), "w long, n long, code long").select(F.col("code").alias("w1"), F.col("n").alias("n_word"))
    counts = words.select(F.col("w").bitwiseOR(F.lit(-1 << 63)).alias("w1"), F.col("n").alias("n_word")).union(numbered)
    shares = asked.filter("kind = 1").select("bucket", "w2", "w1", "n")
    pairs = stored(shares.groupBy("w2", "w1").agg(F.sum("n").alias("n")).join(counts, "w1"), "katz-pairs")
    slopes = {}
    for k in range(2, order + 1):
        found = dict((r["w1"], r["m"]) for r in asked.filter(F.col("kind") == k).groupBy("w1").agg(F.sum("n").alias("m")).collect())
        if k == 2:
            for r, m in _counts_of_counts(pairs.filter("n > 0")):
                found[r] = found.get(r, 0) + m
        slopes[k] = good_turing(list(found.items()))[1]
    at_least = lambda c: F.greatest(c, F.lit(1))
    unigram = F.when(F.col("n_word") > 0, F.log10(_star(at_least("n_word"), slope) * facts["scale"])).otherwise(math.log10(unseen))
    pairs = pairs.withColumn("below", unigram)
    star = _star(at_least("n"), slopes.get(2, -1.5))
    left = lambda x: F.log10(F.greatest(1 - x, F.lit(1e-12)))
    heads = pairs.filter("n > 0").groupBy("w2").agg(F.sum("n").alias("total"), F.sum(star).alias("kept"), F.sum(F.pow(F.lit(10.0), F.col("below"))).alias("under"))
    pairs = pairs.join(heads, "w2", "left").withColumn("logp", F.when(F.col("n") > 0, F.log10(star / F.col("total"))).otherwise(
        F.coalesce(left(F.col("kept") / F.col("total")) - left(F.col("under")), F.lit(0.0)) + F.col("below")))
    scored = []
    for part in range(ROUNDS):
        mine = F.col("bucket") % ROUNDS == part
        answers = shares.filter(mine).select("bucket", "w2", "w1").join(pairs.select("w2", "w1", "n_word", "logp"), ["w2", "w1"])
        answers = answers.select("bucket", "w2", "w1", "n_word", "logp").union(
            asked.filter(mine & (F.col("kind") == 0)).join(counts, "w1").select("bucket", F.lit(0).cast("long"), "w1", "n_word", F.lit(0.0)))
        of_blocks = grams.filter(mine).groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
            _evaluate(shared, slopes, facts, part_rows), "block long, bucket long, logp binary, counts binary")
        scored.append(stored(of_blocks, "katz-scored"))
    scored = reduce(DataFrame.union, scored)
    discard(spark, at)
    fields = ["id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    out = rows.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(
        _sum_up(shared, facts, fields), f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("id", "held_out", "n_tokens", "n_known", F.lit(facts["total"]).cast("long").alias("train_tokens"), "base_score", "score")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_of: int = HELD_OUT_OF, order: int = ORDER,
                    share: float | None = None, block_bytes: int = BLOCK_BYTES, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text).

    ``block_bytes`` of text make a block, and the n-grams of as many a bucket; ``part_rows`` of them are merged at a time. The result does
    not depend on either."""
    spark = docs.sparkSession
    ready(spark)
    if share is None:
        return _score_whole(docs, id_col, text_col, held_out_of, order, block_bytes, part_rows)
    rows = docs.select((crc_mod(col(id_col), held_out_of) != 0).alias("train"), col(text_col).alias("text"))
    model, words, facts = fit(rows, order, share)
    shared = spark.sparkContext.broadcast(model)
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), col(id_col).alias("id"),
                        (crc_mod(col(id_col), held_out_of) == 0).alias("held_out"), col(text_col).alias("text"))
    parts = stored(keyed.mapInArrow(_score(shared, order), _SCORED.format(dict(docs.dtypes)[id_col])), "katz-parts")
    least = max(share * facts["total"], 1)
    rare = parts.filter(F.col("word").isNotNull()).join(words.filter(F.col("n") < least), "word", "left")
    n = F.coalesce("n", F.lit(0))
    denominator = math.log10(facts["total"] + 0.1 * (facts["distinct"] + 1))
    logp = F.when(n > 0, F.log10(_star(F.greatest(n, F.lit(1)), facts["slope"]) * facts["scale"])).otherwise(math.log10(facts["unseen"]))
    rare = rare.select("key", (F.col("uses") * logp).alias("logp"), (F.col("uses") * (F.log10(n + 0.1) - denominator)).alias("base"),
                       F.when(n > 0, F.col("uses")).otherwise(0).alias("known"))
    more = rare.groupBy("key").agg(*[F.sum(c).alias(c + "_more") for c in ("logp", "base", "known")])
    whole = parts.filter(F.col("word").isNull()).join(more, "key", "left")
    both = lambda c: F.col(c) + F.coalesce(c + "_more", F.lit(0))
    return whole.select("id", "held_out", F.col("tokens").alias("n_tokens"), both("known").alias("n_known"),
                        F.lit(facts["total"]).cast("long").alias("train_tokens"), both("base").alias("base_score"), both("logp").alias("score"))
