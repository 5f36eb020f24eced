"""Token counts by rank-synchronous merging over ragged arrays.

Byte-level BPE merges, in every pre-token, the adjacent pair of lowest rank until no pair has a rank. Here the distinct
pre-tokens of a block of texts lie end to end in one symbol array. Each round finds the lowest rank of every sequence, merges all
its places in all sequences at once, and looks up the ranks of the pairs that changed; sequences without a ranked pair leave the
arrays with their count of surviving symbols. This equals one merge after the other because a pair's parts are made by
merges of lower rank only, which is checked when the file is loaded. A sequence longer than ``LONG`` symbols is cut where no token can
lie across, and merged over linked arrays with one list of places per rank, so its rounds cost what they change.

Pre-tokens come from the tokenizer's own splitting rule. A single space between two characters that are not white space always begins a
pre-token, so a block's distinct space-led words are split and counted once, and long texts are worked off in parts cut at such
spaces. The file's special strings are cut out first and count one token each, as the tokenizers library does by default.

Null texts count as empty: no bytes, no tokens. Rows are counted one by one, so repeated rows and null ids give rows of their own;
an empty table gives none.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import col, ready, slices
from tickframe.llm.packing import _odd, tokenizer_file

LIMIT = 1024
# Bytes of text counted at a time, symbols from which a sequence is merged by lists of places.
BLOCK_BYTES = 8_000_000
LONG = 2_048
# Below this character the ``regex`` package splits as the tokenizers library does (tested); texts beyond go to the library's splitter.
NARROW = "\u0500"
_NONE = np.int32(2 ** 31 - 1)


class PairMerger:
    """Ranked pairs of a byte-level BPE as arrays."""

    def __init__(self, vocab: dict, merges: list, byte_of: dict):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        made = [a + b for a, b in pairs]
        born = {t: r for r, t in enumerate(made)}
        if len(born) != len(made) or any(born.get(x, -1) >= r for r, p in enumerate(pairs) for x in p):
            raise ValueError("a pair's parts must be made by one merge each, of lower rank")
        self.made = np.array([vocab[t] for t in made] or [0], np.int32)
        self.wide = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.wide) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.by_key = np.append(keys[order], np.int64(2 ** 62)), np.append(order, 0).astype(np.int32)
        # Bytes -> symbols; pairs of bytes that some token holds side by side.
        self.symbol = np.zeros(256, np.int32)
        for c, b in byte_of.items():
            self.symbol[b] = vocab[c]
        self.joined = np.zeros((256, 256), bool)
        for t in made:
            codes = [byte_of[c] for c in t]
            self.joined[codes[:-1], codes[1:]] = True

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.wide + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.by_key[at], _NONE)

    def counts(self, data: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Symbols that survive in each of the byte sequences that lie end to end in ``data``."""
        owner = np.repeat(np.arange(len(length)), length)
        part = owner
        long = length > LONG
        if long.any():
            # Cut the long ones where no token can lie across; parts that stay long go by themselves.
            apart = np.zeros(len(data), bool)
            apart[1:] = long[owner[1:]] & ~self.joined[data[:-1], data[1:]] & (owner[1:] == owner[:-1])
            part = np.cumsum(apart) + owner
        symbols = self.symbol[data]
        sizes = np.bincount(part, minlength=len(length))
        out = np.zeros(len(sizes), np.int64)
        short = sizes <= LONG
        out[short] = self._together(symbols[short[part]], sizes[short])
        at = np.cumsum(sizes) - sizes
        for i in np.flatnonzero(~short):
            out[i] = self._alone(symbols[at[i]:at[i] + sizes[i]].copy())
        total = np.zeros(len(length), np.int64)
        np.add.at(total, owner[at], out)
        return total

    def _together(self, sym: np.ndarray, length: np.ndarray) -> np.ndarray:
        counts = length.astype(np.int64)
        seq = np.repeat(np.arange(len(length), dtype=np.int32), length)
        rank = np.full(len(sym), _NONE, np.int32)
        if len(sym) > 1:
            rank[:-1] = np.where(seq[1:] == seq[:-1], self.ranks(sym[:-1], sym[1:]), _NONE)
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            over = low == _NONE
            counts[seq[first[over]]] = size[over]
            lowest = np.repeat(low, size)
            if over.any():
                stay = lowest != _NONE
                sym, seq, rank, lowest = sym[stay], seq[stay], rank[stay], lowest[stay]
            h = np.flatnonzero(rank == lowest)
            if not len(h):
                break
            h = self._apart(h, np.diff(h) == 1)
            sym[h] = self.made[rank[h]]
            keep = np.ones(len(sym), bool)
            keep[h + 1] = False
            sym, seq, rank = sym[keep], seq[keep], rank[keep]
            p = h - np.arange(len(h))
            changed = np.zeros(len(sym), bool)
            changed[p] = True
            changed[p[p > 0] - 1] = True
            p = np.flatnonzero(changed)
            q = np.minimum(p + 1, len(sym) - 1)
            rank[p] = np.where((q > p) & (seq[q] == seq[p]), self.ranks(sym[p], sym[q]), _NONE)
        return counts

    @staticmethod
    def _apart(h: np.ndarray, touches: np.ndarray) -> np.ndarray:
        """Of places that overlap the one before, every second from the left."""
        if not touches.any():
            return h
        new = np.concatenate([[True], ~touches])
        begin = np.flatnonzero(new)
        return h[(np.arange(len(h)) - np.repeat(begin, np.diff(np.append(begin, len(h))))) % 2 == 0]

    def _alone(self, sym: np.ndarray) -> int:
        n = len(sym)
        after, before = np.arange(1, n + 1, dtype=np.int64), np.arange(-1, n - 1, dtype=np.int64)
        rank = np.full(n, _NONE, np.int32)
        rank[:-1] = self.ranks(sym[:-1], sym[1:])
        places: dict = {}
        queue: list = []

        def enter(at):
            at = at[rank[at] != _NONE]
            if not len(at):
                return
            at = at[np.argsort(rank[at], kind="stable")]
            r = rank[at]
            for part in np.split(at, np.flatnonzero(np.diff(r)) + 1):
                key = int(rank[part[0]])
                if key not in places:
                    places[key] = []
                    heapq.heappush(queue, key)
                places[key].append(part)

        enter(np.arange(n - 1))
        left = n
        while queue:
            r = heapq.heappop(queue)
            h = np.unique(np.concatenate(places.pop(r)))
            h = h[rank[h] == r]
            if not len(h):
                continue
            h = self._apart(h, after[h[:-1]] == h[1:])
            gone = after[h]
            sym[h] = self.made[r]
            rank[gone] = _NONE
            left -= len(h)
            after[h] = after[gone]
            inner = after[h] < n
            before[after[h[inner]]] = h[inner]
            p = np.unique(np.concatenate([h, before[h][before[h] >= 0]]))
            q = after[p]
            rank[p] = np.where(q < n, self.ranks(sym[p], sym[np.minimum(q, n - 1)]), _NONE)
            enter(p)
        return left


class TokenCounter:
    """Counts the tokens of texts as the tokenizers library would, from a byte-level BPE file."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback") if model.get(k)]
        plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        special = spec.get("added_tokens") or []
        if model.get("type") != "BPE" or odd or spec.get("normalizer") or not plain or any(t.get(k) for t in special for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("a plain byte-level BPE file is needed")
        self.library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.pattern = regex.compile(pattern)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in sorted(special, key=lambda t: -len(t["content"])))) if special else None
        # The characters that stand for bytes in the file, read off the library: one character for every byte UTF-8 can hold.
        every = [*range(0x800), *range(0x800, 0x10000, 0x800), *range(0x10000, 0x110000, 0x4000)]
        byte_of = {}
        for code in every:
            if not 0xD800 <= code < 0xE000:
                byte_of.update(zip("".join(p for p, _ in self.library(chr(code))), chr(code).encode()))
        self.merger = PairMerger(model["vocab"], model["merges"], byte_of | {c: 0 for c in {c for t in model["vocab"] for c in t} - set(byte_of)})

    def _ends(self, text: str) -> np.ndarray:
        """Where the pre-tokens of a text end, in characters."""
        if text.isascii() or max(text) < NARROW:
            return np.cumsum(np.fromiter(map(len, self.pattern.findall(text)), np.int64))
        return np.array([e for _, (_, e) in self.library(text)], np.int64)

    def _split(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pre-tokens of each text by itself: (number of the text, begin in its characters, token count)."""
        ends = [self._ends(t) for t in texts]
        n = np.array([len(e) for e in ends], np.int64)
        of = np.repeat(np.arange(len(texts)), n)
        size = np.array([len(t) for t in texts], np.int64)
        whole = np.concatenate([*ends, np.zeros(0, np.int64)]) + np.repeat(np.cumsum(size) - size, n)
        text = "".join(texts)
        data = np.frombuffer(text.encode(), np.uint8)
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))[whole] if len(data) > len(text) else whole
        begins = np.concatenate([[0], whole[:-1]])[:len(whole)] - np.repeat(np.cumsum(size) - size, n)
        return of, begins, self.merger.counts(data, np.diff(at, prepend=0))

    def _alone(self, texts: list) -> np.ndarray:
        of, _, n = self._split(texts)
        return np.bincount(of, n, len(texts)).astype(np.int64)

    def _words(self, names: list) -> np.ndarray:
        """Token counts of the given words, each with a space before it."""
        out = np.zeros(len(names), np.int64)
        wide = np.fromiter((not w.isascii() and max(w) >= NARROW for w in names), bool, len(names))
        for kind in (False, True):
            mine = np.flatnonzero(wide == kind)
            if len(mine):
                words = [names[i] for i in mine] if wide.any() else names
                size = np.fromiter(map(len, words), np.int64, len(words)) + 1
                _, at, n = self._split([" " + " ".join(words)])
                out[mine] = np.bincount(np.searchsorted(np.cumsum(size) - size, at, "right") - 1, n, len(words))
        return out

    @staticmethod
    def _parts(text: str):
        """The text in parts of about a block, cut at single spaces that begin a pre-token; each later part begins with its space."""
        begin = 0
        while len(text) - begin > BLOCK_BYTES:
            at = text.find(" ", begin + BLOCK_BYTES // 2)
            while at > 0 and (at + 1 >= len(text) or text[at - 1].isspace() or text[at + 1].isspace()):
                at = text.find(" ", at + 1)
            if at < 0:
                break
            yield text[begin:at]
            begin = at
        yield text[begin:]

    def count(self, texts: list) -> np.ndarray:
        """Tokens of each text (no nulls)."""
        out = np.zeros(len(texts), np.int64)
        whole, whole_of, plain, plain_of, led = [], [], [], [], []
        for i, text in enumerate(texts):
            runs = [text]
            if self.special is not None and self.special.search(text):
                runs = self.special.split(text)
                out[i] += len(runs) - 1
            for run in runs:
                for k, part in enumerate(self._parts(run)):
                    body = part[1:] if k else part
                    if not body:
                        continue
                    if _odd(body):
                        whole.append(part)
                        whole_of.append(i)
                    else:
                        plain.append(body)
                        plain_of.append(i)
                        led.append(k > 0)
        if plain:
            out += self._plain(plain, np.array(plain_of), np.array(led), len(texts))
        if whole:
            np.add.at(out, whole_of, self._alone(whole))
        return out

    def _plain(self, texts: list, owner: np.ndarray, led: np.ndarray, n: int) -> np.ndarray:
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        flat = parts.flatten().dictionary_encode()
        names = flat.dictionary.to_pylist()
        at = flat.indices.to_numpy(zero_copy_only=False)
        tokens = self._words(names)[at]
        offsets = np.asarray(parts.offsets).astype(np.int64)
        offsets -= offsets[0]
        # The first word of a text has no space before it.
        heads = offsets[:-1][~led]
        tokens[heads] = self._alone([names[k] for k in at[heads]])
        upto = np.concatenate([[0], np.cumsum(tokens)])
        out = np.zeros(n, np.int64)
        np.add.at(out, owner, upto[offsets[1:]] - upto[offsets[:-1]])
        return out


_COUNTERS: dict = {}


def _counter(*files: str) -> TokenCounter:
    if files not in _COUNTERS:
        _COUNTERS[files] = TokenCounter(*files)
    return _COUNTERS[files]


def _run(path: str, pattern: str):
    def run(batches):
        counter = _counter(path, pattern)
        for b in batches:
            texts = b.column("text").fill_null("")
            size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in slices(size, BLOCK_BYTES):
                n = counter.count(texts.slice(i, j - i).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("id").slice(i, j - i), pa.array(size[i:j]), pa.array(n)], ["id", "n_bytes", "n_tokens"])
        pa.default_memory_pool().release_unused()
    return run


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, tokenizer: str | None = None,
                 pattern: str | None = None) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit. ``tokenizer`` is the path of a byte-level BPE file (.json), ``pattern`` its
    splitting rule."""
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    ready(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    out = rows.mapInArrow(_run(tokenizer or tokenizer_file("byte_bpe_50k.json"), pattern), f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
