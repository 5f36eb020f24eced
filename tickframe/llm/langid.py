"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of white-space separated pieces of a text in both directions and gives a distribution over
the languages at every byte; a document's distribution is the mean over all its bytes. It is trained with numpy by
backpropagation through time, every byte of a piece labelled with its document's language.

Training reads the whole texts of all labelled rows that are not held out: their distinct pieces are counted per language and dealt to
shards. The first shard gives every other one its start; then each is read by a network of its own and the networks' weights are
averaged. A piece weighs by the logarithm of its count, and languages with fewer pieces weigh more. Prediction reads whole texts. The
network's state starts afresh at every piece, so equal pieces have equal outputs, and each block of documents runs the network
once per distinct piece.

Texts that are null or hold no letter are ``und`` with score 0, as is everything where no labelled row exists. Null ids take
part (hashed as the empty text). Repeated rows are predicted alike. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import col, crc_mod, ready, slices, stored

UNKNOWN = "und"
HELD_OUT_OF = 5
# Distinct pieces of a shard; the number of shards grows with the corpus.
SHARD = 100_000
# Share of a language's training documents that may score below the rejection level.
SURE_BELOW = 0.05
HIDDEN, EPOCHS, BATCH, RATE = 16, 2, 128, 0.01
# Steps of the first shard's network at least, so that few pieces are read more often.
LEAST_STEPS = 1200
# Batch and rate of the shards' networks that are averaged.
SHARD_BATCH, SHARD_RATE = 512, 0.004
# Weights are averaged as whole multiples of this, so that their order does not matter.
GRAIN = 2.0 ** -32
# Longer pieces are read in parts of this many bytes.
PART = 64
BLOCK_BYTES = 4_000_000
PIECES_HELD = 250_000


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class BiGru:
    """Two gated recurrent layers, one per direction, and a softmax over their states at every byte."""

    def __init__(self, n_out: int, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.h, self.n_out = hidden, n_out
        rand = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        # Per direction: what each byte adds to the gates (z, r, n), and the recurrent weights.
        self.w = {"xf": rand(256, 3 * hidden, s=0.3), "xb": rand(256, 3 * hidden, s=0.3),
                  "uf": rand(hidden, 3 * hidden, s=hidden ** -0.5), "ub": rand(hidden, 3 * hidden, s=hidden ** -0.5),
                  "o": rand(2 * hidden, n_out, s=(2 * hidden) ** -0.5), "c": np.zeros(n_out, np.float32)}

    def _run(self, data, x, u, keep):
        """States after every byte of ``data`` (rows of equal length); with ``keep`` also what training needs."""
        m, t = data.shape
        h = np.zeros((m, self.h), np.float32)
        states, saved, k = np.empty((t, m, self.h), np.float32), [], self.h
        for i in range(t):
            g = x[data[:, i]]
            a = h @ u
            zr = _sigmoid(g[:, :2 * k] + a[:, :2 * k])
            z, r = zr[:, :k], zr[:, k:]
            n = np.tanh(g[:, 2 * k:] + r * a[:, 2 * k:])
            if keep:
                saved.append((h, z, r, n, a[:, 2 * k:]))
            h = n + z * (h - n)
            states[i] = h
        return states, saved

    def _softmax(self, states):
        s = states @ self.w["o"] + self.w["c"]
        s -= s.max(-1, keepdims=True)
        np.exp(s, out=s)
        return s / s.sum(-1, keepdims=True)

    def _both(self, data, keep=False):
        f, sf = self._run(data, self.w["xf"], self.w["uf"], keep)
        b, sb = self._run(data[:, ::-1], self.w["xb"], self.w["ub"], keep)
        return np.concatenate([f, b[::-1]], 2), sf, sb

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """Sum over the bytes of their distributions, for rows of equal length."""
        return self._softmax(self._both(data)[0]).sum(0)

    def _back(self, data, saved, grad, u, gx, gu):
        """Backpropagation through time for one direction."""
        k = self.h
        h, z, r, n, a = (np.stack(x) for x in zip(*saved))
        to_n, to_z, to_r = (1 - z) * (1 - n * n), (h - n) * z * (1 - z), a * r * (1 - r)
        dx, da = np.empty((len(saved), len(data), 3 * k), u.dtype), np.empty((len(saved), len(data), 3 * k), u.dtype)
        dh, ut = np.zeros_like(grad[0]), np.ascontiguousarray(u.T)
        for i in range(len(saved) - 1, -1, -1):
            dh = dh + grad[i]
            dn = dh * to_n[i]
            dx[i, :, :k] = dh * to_z[i]
            dx[i, :, k:2 * k] = dn * to_r[i]
            dx[i, :, 2 * k:] = dn
            da[i, :, :2 * k] = dx[i, :, :2 * k]
            da[i, :, 2 * k:] = dn * r[i]
            dh = dh * z[i] + da[i] @ ut
        gu += h.reshape(-1, k).T @ da.reshape(-1, 3 * k)
        # Rows of equal bytes lie together and are summed at once.
        byte = data.T.ravel()
        by = np.argsort(byte, kind="stable")
        byte = byte[by]
        first = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
        gx[byte[first]] += np.add.reduceat(dx.reshape(-1, 3 * k)[by], first)

    def gradients(self, data, labels, weights=None) -> tuple[dict, float]:
        states, sf, sb = self._both(data, keep=True)
        p = self._softmax(states)
        t, m, _ = p.shape
        loss = -np.log(np.maximum(p[:, np.arange(m), labels], 1e-12)).mean()
        p[:, np.arange(m), labels] -= 1
        p /= t * m
        if weights is not None:
            p *= weights[:, None]
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        g["o"] = np.tensordot(states, p, ((0, 1), (0, 1)))
        g["c"] = p.sum((0, 1))
        d = p @ self.w["o"].T
        self._back(data, sf, d[:, :, :self.h], self.w["uf"], g["xf"], g["uf"])
        self._back(data[:, ::-1], sb, d[::-1, :, self.h:], self.w["ub"], g["xb"], g["ub"])
        return g, float(loss)

    def fit(self, pieces: list, labels: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 11, weights=None) -> "BiGru":
        """Adam over batches of equal length."""
        rng = np.random.default_rng(seed)
        size = np.array([len(p) for p in pieces])
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        total = sum(-(-int((size == n).sum()) // batch) for n in np.unique(size)) * epochs
        for _ in range(epochs):
            batches = []
            for n in np.unique(size):
                at = rng.permutation(np.flatnonzero(size == n))
                batches += [at[i:i + batch] for i in range(0, len(at), batch)]
            for b in rng.permutation(len(batches)):
                rows = batches[b]
                data = np.frombuffer(b"".join(pieces[i] for i in rows), np.uint8).reshape(len(rows), -1)
                g, _ = self.gradients(data, labels[rows], None if weights is None else weights[rows])
                step += 1
                lr = rate * (1 - (step - 1) / max(total, 1)) * len(rows) / batch
                for k, v in self.w.items():
                    mean[k] += 0.1 * (g[k] - mean[k])
                    square[k] += 0.01 * (g[k] ** 2 - square[k])
                    v -= lr * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
        return self

    def score(self, pieces: list) -> np.ndarray:
        """Summed byte distributions of every piece."""
        out = np.zeros((len(pieces), self.n_out))
        parts, owner = [], []
        for i, p in enumerate(pieces):
            for j in range(0, len(p), PART):
                parts.append(p[j:j + PART])
                owner.append(i)
        owner, size = np.array(owner, np.int64), np.array([len(p) for p in parts])
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            for s in range(0, len(at), 4096):
                rows = at[s:s + 4096]
                data = np.frombuffer(b"".join(parts[i] for i in rows), np.uint8).reshape(len(rows), -1)
                np.add.at(out, owner[rows], self.probabilities(data))
        return out


    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[k].ravel() for k in sorted(self.w)])

    def unflatten(self, flat: np.ndarray) -> "BiGru":
        at = 0
        for k in sorted(self.w):
            v = self.w[k]
            self.w[k] = flat[at:at + v.size].reshape(v.shape).astype(v.dtype)
            at += v.size
        return self


def _count_pieces(langs: list):
    """Distinct parts of pieces, cut as ``BiGru.score`` cuts them, by language number with their counts in one block."""
    def run(batches):
        for b in batches:
            texts = b.column("text")
            number = pc.index_in(b.column("lang"), value_set=pa.array(langs, b.schema.field("lang").type)).to_numpy(zero_copy_only=False)
            for i, j in slices(pc.binary_length(texts).to_numpy(zero_copy_only=False), BLOCK_BYTES):
                parts = pc.utf8_split_whitespace(texts.slice(i, j - i).cast(pa.large_string()))
                flat = parts.flatten().dictionary_encode()
                label = np.repeat(number[i:j], np.diff(np.asarray(parts.offsets)))
                key, n = np.unique(flat.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(langs) + label, return_counts=True)
                word, label = key // len(langs), key % len(langs)
                raw = flat.dictionary.cast(pa.large_binary())
                size = pc.binary_length(raw).to_numpy(zero_copy_only=False)
                short = (size[word] > 0) & (size[word] <= PART)
                out = [(raw.take(pa.array(word[short])).cast(pa.binary()), label[short], n[short])]
                cut = [(raw[w].as_py()[k:k + PART], y, m) for w, y, m in zip(word, label, n) if size[w] > PART for k in range(0, size[w], PART)]
                if cut:
                    out.append(tuple(zip(*cut)))
                for piece, y, m in out:
                    yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(piece, pa.binary()), pa.array(m, pa.int64())], ["y", "piece", "n"])
    return run


def _fit_shard(net: BiGru, scale: dict, first: bool):
    """The weights of a network that starts as ``net`` and reads the pieces of a shard."""
    def run(t):
        t = t.sort_by([("y", "ascending"), ("piece", "ascending")])
        pieces, labels = t.column("piece").to_pylist(), t.column("y").to_numpy().astype(np.int64)
        weights = ((1 + np.log(t.column("n").to_numpy())) * np.array([scale.get(y, 0.0) for y in range(net.n_out)])[labels]).astype(np.float32)
        own = BiGru(net.n_out, net.h).unflatten(net.flat())
        if first:
            steps = sum(-(-int(m) // BATCH) for m in np.bincount([len(p) for p in pieces]))
            own.fit(pieces, labels, max(EPOCHS, -(-LEAST_STEPS // steps)), weights=weights)
        else:
            own.fit(pieces, labels, 1, SHARD_BATCH, SHARD_RATE, weights=weights)
        flat = own.flat()
        return pa.table([pa.array(np.arange(len(flat))), pa.array(np.rint(flat / GRAIN).astype(np.int64))], names=["at", "value"])
    return run


def _training(docs: DataFrame, id_col: str, text_col: str, lang_col: str, held_out_of: int) -> DataFrame:
    """lang and text of the rows to learn from."""
    rows = docs.filter((crc_mod(col(id_col), held_out_of) != 0) & col(lang_col).isNotNull() & col(text_col).isNotNull())
    return rows.select(col(lang_col).cast("string").alias("lang"), col(text_col).alias("text"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out_of: int = HELD_OUT_OF, shard: int = SHARD):
    """(network, languages) from all training rows, or (None, []). ``shard`` distinct pieces are read by one network."""
    rows = _training(docs, id_col, text_col, lang_col, held_out_of)
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not langs:
        return None, []
    pieces = rows.mapInArrow(_count_pieces(langs), "y int, piece binary, n long")
    pieces = stored(pieces.groupBy("y", "piece").agg(F.sum("n").alias("n")), "langid-pieces")
    # In whole thousandths, so that the order of the rows does not matter.
    mass = {r["y"]: (r["distinct"], r["mass"] / 1000) for r in pieces.groupBy("y").agg(
        F.count("*").alias("distinct"), F.sum(F.round(1000 * (1 + F.log("n"))).cast("long")).alias("mass")).collect()}
    if not mass:
        return None, []
    distinct = sum(d for d, _ in mass.values())
    # Between equal pieces and equal languages; one on average.
    scale = {y: m ** -0.5 for y, (_, m) in mass.items()}
    mean = sum(scale[y] * m for y, (_, m) in mass.items()) / distinct
    scale = {y: x / mean for y, x in scale.items()}
    shards = -(-distinct // shard)
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("y", "piece"), F.lit(shards)))
    net = BiGru(len(langs))
    start = dealt.agg(F.min("shard")).first()[0]
    for first in (True, False):
        part = dealt.filter(F.col("shard") == start) if first else dealt
        fitted = part.groupBy("shard").applyInArrow(_fit_shard(net, scale, first), "at long, value long")
        values = fitted.groupBy("at").agg((F.sum("value") / F.count("*")).alias("value")).collect()
        net = BiGru(len(langs)).unflatten(np.array([r["value"] for r in sorted(values, key=lambda r: r["at"])]) * GRAIN)
    return net, langs


def rejection_level(net: BiGru, langs: list, rows: DataFrame, margin: float) -> float:
    """The least score that counts as identified. ``rows``: lang and text of all training documents.

    It lies ``margin`` of the way from 1 / languages, which every text reaches, to 1. Where the network tells some language less
    surely than that, it is the score that all but ``SURE_BELOW`` of that language's training documents reach, so clean documents stay.
    """
    level = 1 / net.n_out + margin * (1 - 1 / net.n_out)
    scored = rows.withColumn("letters", F.col("text").rlike(r"\p{L}")).mapInArrow(_label(net, langs), "lang string, lang_pred string, score double")
    scored = stored(scored.filter(F.col("lang_pred") != UNKNOWN).select("lang", "score"), "langid-scores")
    # Equal texts may differ in the last bits of a float from one block to the next.
    return min([level, *lowest_share(scored, SURE_BELOW).values()]) * (1 - 1e-6)


def lowest_share(scored: DataFrame, share: float, bins: int = 1024) -> dict:
    """For every lang the least score that at most ``share`` of its rows lie below; exact.

    Each round counts the rows between two scores by bins and goes on with the one bin that holds the wanted rank."""
    spark = scored.sparkSession
    kind = dict(scored.dtypes)["lang"]
    span = {r["lang"]: (r["lo"], r["hi"], int(share * r["n"])) for r in scored.groupBy("lang").agg(
        F.min("score").alias("lo"), F.max("score").alias("hi"), F.count("*").alias("n")).collect()}
    while open_ := {k: v for k, v in span.items() if v[0] < v[1]}:
        bounds = F.broadcast(spark.createDataFrame([(k, lo, hi) for k, (lo, hi, _) in open_.items()], f"lang {kind}, lo double, hi double"))
        inside = scored.join(bounds, "lang").filter("score BETWEEN lo AND hi")
        # The ends always fall into the first and the last bin.
        place = F.when(F.col("score") == F.col("hi"), bins - 1).otherwise(F.least(F.floor((F.col("score") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 2)))
        found: dict = {}
        for r in inside.groupBy("lang", place.alias("bin")).agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.count("*").alias("n")).collect():
            found.setdefault(r["lang"], []).append((r["bin"], r["lo"], r["hi"], r["n"]))
        for k in open_:
            rank = span[k][2]
            for _, lo, hi, n in sorted(found[k]):
                if rank < n:
                    span[k] = lo, hi, rank
                    break
                rank -= n
    return {k: lo for k, (lo, _, _) in span.items()}


def _label(net: BiGru, langs: list, least: float | None = None):
    """Prediction for Arrow batches: every distinct piece of a block runs once.

    With ``least`` the rows themselves come out, without those of unknown language or a lower score.
    """
    names = pa.array([*langs, UNKNOWN])
    known: dict = {}
    held = np.zeros((0, len(langs) + 1))

    def run(batches):
        nonlocal held
        for b in batches:
            texts = b.column("text").fill_null("")
            for i, j in slices(pc.binary_length(texts).to_numpy(zero_copy_only=False), BLOCK_BYTES):
                parts = pc.utf8_split_whitespace(texts.slice(i, j - i).cast(pa.large_string()))
                flat = parts.flatten().dictionary_encode()
                pieces = flat.dictionary.to_pylist()
                if len(known) > PIECES_HELD:
                    known.clear()
                    held = held[:0]
                new = [w for w in pieces if w not in known]
                if new:
                    raw = [w.encode() for w in new]
                    known.update(zip(new, range(len(held), len(held) + len(new))))
                    held = np.concatenate([held, np.column_stack([net.score(raw), [len(w) for w in raw]])])
                number = np.array([known[w] for w in pieces], np.int64)
                values = held[number][flat.indices.to_numpy(zero_copy_only=False)] if pieces else np.zeros((0, len(langs) + 1))
                off = np.asarray(parts.offsets)
                doc = np.repeat(np.arange(j - i), np.diff(off))
                pooled = np.stack([np.bincount(doc, values[:, c], j - i) for c in range(len(langs) + 1)], 1)
                mean = pooled[:, :-1] / np.maximum(pooled[:, -1:], 1)
                best = mean.argmax(1)
                none = ~b.column("letters").slice(i, j - i).fill_null(False).to_numpy(zero_copy_only=False) | (pooled[:, -1] == 0)
                score = np.clip(mean[np.arange(j - i), best], 0, 1)
                best[none], score[none] = len(langs), 0.0
                if least is not None:
                    part = b.slice(i, j - i).filter(pa.array((best < len(langs)) & (score >= least)))
                    names_out = [c if c != "text" else "body" for c in b.schema.names if c != "letters"]
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in b.schema.names if c != "letters"], names_out)
                    continue
                rest = [b.column(c).slice(i, j - i) for c in b.schema.names if c not in ("text", "letters")]
                yield pa.RecordBatch.from_arrays([*rest, names.take(pa.array(best)), pa.array(score)],
                                                 [*(c for c in b.schema.names if c not in ("text", "letters")), "lang_pred", "score"])
        known.clear()
        held = held[:0]
        pa.default_memory_pool().release_unused()
    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out_of: int = HELD_OUT_OF) -> DataFrame:
    """One row per input row: id, tkey (hash of the text), held_out, lang_pred, score."""
    ready(docs.sparkSession)
    net, langs = train(docs, id_col, text_col, lang_col, held_out_of)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("tkey"), (crc_mod(col(id_col), held_out_of) == 0).alias("held_out"),
                       col(text_col).alias("text"), col(text_col).rlike(r"\p{L}").alias("letters"))
    if net is None:
        return rows.select("id", "tkey", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_label(net, langs), f"id {kind}, tkey long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, min_score: float = 0.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    held_out_of: int = HELD_OUT_OF, margin: float | None = None) -> DataFrame:
    """``docs`` without the rows whose language is unknown or whose score is below ``min_score``; no shuffle.

    With ``margin`` rows below the ``rejection_level`` go too.
    """
    ready(docs.sparkSession)
    net, langs = train(docs, id_col, text_col, lang_col, held_out_of)
    if net is None:
        return docs.limit(0)
    if margin is not None:
        min_score = max(min_score, rejection_level(net, langs, _training(docs, id_col, text_col, lang_col, held_out_of), margin))
    # The text goes to the workers once; the other columns travel as one struct, whatever their names.
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[col(c) for c in others]).alias("row"), col(text_col).alias("text"), col(text_col).rlike(r"\p{L}").alias("letters"))
    fields = docs.select(*[col(c) for c in others]).schema.simpleString()
    rows = rows.mapInArrow(_label(net, langs, min_score), f"row {fields}, body string")
    return rows.select(*[F.col("body").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
