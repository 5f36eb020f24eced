"""Packing by power-of-two decomposition.

The ids of a document (byte-level BPE, then one end id) are cut into pieces whose lengths are powers of two: as many
pieces of the longest length as fit, then the binary digits of the rest, longest first. Every piece is a
sequence of its own, bucketed with the pieces of equal length, so no sequence crosses documents and none needs padding.

Encoding goes through the distinct space-led words of a block of documents: byte-level BPE never joins
across a single space between two non-space characters, so a block's distinct words are encoded once, as one string, and
each document is put together from their ids. Texts with other white space next to a space, or with the vocabulary's
control strings, are encoded whole by the tokenizers library. Null texts count as empty (one piece: the end id). Rows are
packed one by one, so repeated rows and null ids give pieces of their own; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import col, ready, slices

MAX_TOKENS = 2048
END_ID = 1
# Bytes of text encoded at a time, and distinct words remembered by a worker.
BLOCK_BYTES = 4_000_000
WORDS_HELD = 200_000

# A space beside other white space, or white space at an end: such texts take the whole-text path.
_PAIRS = ["  ", *(w + " " for w in "\t\n\v\f\r\x1c\x1d\x1e\x1f"), *(" " + w for w in "\t\n\v\f\r\x1c\x1d\x1e\x1f")]
_WIDE = re.compile(r"[^\S\x00-\x7F]")


def _odd(t: str) -> bool:
    return t[:1].isspace() or t[-1:].isspace() or any(p in t for p in _PAIRS) or (not t.isascii() and _WIDE.search(t) is not None)


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class BlockEncoder:
    """Token ids of many texts at once, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        with open(json_path, encoding="utf-8") as f:
            self.control = [t["content"] for t in json.load(f).get("added_tokens", [])]
        self.json_path, self._whole = json_path, None
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.leads = np.zeros(max(ranks.values()) + 1, bool)  # ids whose bytes begin with a space
        self.leads[[i for b, i in ranks.items() if b[:1] == b" "]] = True
        self.forget()

    def forget(self) -> None:
        """Drop the remembered words."""
        self.known: dict = {}
        self.ids, self.start, self.end = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def whole(self):
        """The tokenizers library's encoder, loaded when a text needs it."""
        if self._whole is None:
            from tokenizers import Tokenizer
            self._whole = Tokenizer.from_file(self.json_path)
        return self._whole

    def _learn(self, new: list) -> None:
        """Encode new words as one text; a word begins where an id's bytes begin with a space."""
        ids = np.array(self.words.encode_ordinary("".join(" " + w for w in new)), np.int32)
        at = np.flatnonzero(self.leads[ids])
        if len(at) != len(new):
            raise ValueError("words and ids do not line up")
        base = len(self.ids)
        self.known.update(zip(new, range(len(self.start), len(self.start) + len(new))))
        self.ids = np.concatenate([self.ids, ids])
        self.start = np.concatenate([self.start, base + at])
        self.end = np.concatenate([self.end, base + np.append(at[1:], len(ids))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, n + 1 offsets). ``texts`` holds no nulls."""
        strings = texts.to_pylist()
        odd = np.array([_odd(t) or any(c in t for c in self.control) for t in strings], bool)
        plain = np.array([not o and t != "" for o, t in zip(odd, strings)], bool)
        counts = np.zeros(len(strings), np.int64)
        parts = pc.split_pattern(texts.filter(pa.array(plain)).cast(pa.large_string()), " ")
        flat = parts.flatten().dictionary_encode()
        if len(self.known) > WORDS_HELD:
            self.forget()
        names = flat.dictionary.to_pylist()
        new = [w for w in names if w not in self.known]
        if new:
            self._learn(new)
        number = np.array([self.known[w] for w in names], np.int64)[flat.indices.to_numpy(zero_copy_only=False)] if names else np.zeros(0, np.int64)
        # The first word of a text has no space before it: it is encoded by itself.
        offsets = np.asarray(parts.offsets)
        offsets = offsets - offsets[0]
        first = offsets[:-1].astype(np.int64)
        heads = [self.words.encode_ordinary(names[k]) for k in flat.indices.take(pa.array(first)).to_pylist()] if len(first) else []
        length = self.end[number] - self.start[number]
        begin = self.start[number].copy()
        head_ids = np.array([i for h in heads for i in h], np.int32)
        head_len = np.array([len(h) for h in heads], np.int64)
        pool = np.concatenate([self.ids, head_ids])
        length[first] = head_len
        begin[first] = len(self.ids) + np.cumsum(head_len) - head_len
        upto = np.concatenate([[0], np.cumsum(length)])
        ids = pool[np.repeat(begin - upto[:-1], length) + np.arange(upto[-1])]
        counts[plain] = upto[offsets[1:]] - upto[offsets[:-1]]
        if odd.any():
            which = np.flatnonzero(odd)
            whole = [e.ids for e in self.whole.encode_batch([strings[i] for i in which], add_special_tokens=False)]
            counts[which] = [len(w) for w in whole]
            off = np.concatenate([[0], np.cumsum(counts)])
            out = np.empty(off[-1], np.int32)
            keep = np.ones(off[-1], bool)
            for i, w in zip(which, whole):
                out[off[i]:off[i + 1]] = w
                keep[off[i]:off[i + 1]] = False
            out[keep] = ids
            return out, off
        return ids, np.concatenate([[0], np.cumsum(counts)])


def cut(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length) of the power-of-two pieces of rows with ``counts`` ids, in order."""
    full = counts // most
    rest = counts % most
    lengths = [1 << k for k in range(most.bit_length() - 2, -1, -1)]
    has = np.stack([rest & n != 0 for n in lengths], 1) if lengths else np.zeros((len(counts), 0), bool)
    n = full + has.sum(1)
    row = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    tail = np.broadcast_to(np.array(lengths, np.int64), has.shape)[has]
    length = np.full(len(row), most, np.int64)
    length[k >= full[row]] = tail
    upto = np.cumsum(length) - length
    first = upto[np.minimum(np.cumsum(n) - n, max(len(row) - 1, 0))] if len(row) else np.zeros(0, np.int64)
    return row, upto - first[row], length


_ENCODERS: dict = {}


def _encoder(files: tuple) -> BlockEncoder:
    if files not in _ENCODERS:
        _ENCODERS[files] = BlockEncoder(*files)
    return _ENCODERS[files]


def _pieces(files: tuple, most: int, end_id: int):
    def run(batches):
        encoder = _encoder(files)
        for b in batches:
            texts = b.column("text").fill_null("")
            for i, j in slices(pc.binary_length(texts).to_numpy(zero_copy_only=False), BLOCK_BYTES):
                ids, off = encoder.encode(texts.slice(i, j - i))
                ends = off[1:] + np.arange(1, len(off))
                every = np.empty(len(ids) + len(ends), "<u4")
                is_end = np.zeros(len(every), bool)
                is_end[ends - 1] = True
                every[is_end] = end_id
                every[~is_end] = ids
                counts = np.diff(np.concatenate([[0], ends]))
                row, start, length = cut(counts, most)
                byte_off = np.concatenate([[0], np.cumsum(length * 4)]).astype(np.int32)
                piece = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(byte_off), pa.py_buffer(every)])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(i, j - i).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(counts[row]), piece],
                    ["id", "start", "length", "doc_tokens", "ids"])
        encoder.forget()  # a worker that is used again starts without them
        pa.default_memory_pool().release_unused()
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_TOKENS, end_id: int = END_ID,
         tokenizer: str | None = None, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Pieces: id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), bucket (log2 of the length),
    sequence_id and offset. ``tokenizer`` and ``ranks`` are two files of one vocabulary, ``pattern`` its splitting rule."""
    if most < 1 or most & (most - 1):
        raise ValueError("the longest piece must be a power of two")
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    ready(docs.sparkSession)
    files = (tokenizer or tokenizer_file("byte_bpe_50k.json"), ranks or tokenizer_file("byte_bpe_50k.tiktoken"), pattern)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    out = rows.mapInArrow(_pieces(files, most, end_id), f"id {kind}, start long, length long, doc_tokens long, ids binary")
    return out.select(F.col("id").alias(id_col), "start", "length", "doc_tokens", "ids",
                      F.log2("length").cast("int").alias("bucket"), F.monotonically_increasing_id().alias("sequence_id"),
                      F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Training files: one folder per length, so that a reader batches equal lengths without padding."""
    pieces.write.partitionBy("bucket").parquet(path)
