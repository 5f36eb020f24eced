import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents
from tickframe.llm import ann, chat, katz, langid, mixing, packing
from tickframe.llm.common import crc_mod

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


# --- packing -------------------------------------------------------------------
def test_pieces_hold_the_ids_of_the_tokenizer(docs):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.tokenizer_file("byte_bpe_50k.json"))
    rows = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, tuple(whole.encode(r.text or "", add_special_tokens=False).ids + [1])) for r in rows)
    got = packing.pack(docs).collect()
    seqs = defaultdict(list)
    assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} == {0}
    for r in got:
        assert len(r.ids) == 4 * r.length and 2 ** r.bucket == r.length <= 2048
        seqs[r.doc_id].append(r)
    back = Counter()
    for i, pieces in seqs.items():
        # Rows that share an id are told apart by their own order.
        pieces.sort(key=lambda r: r.sequence_id)
        ids = []
        for p in pieces:
            assert p.start == len(ids)
            ids += np.frombuffer(bytes(p.ids), "<u4").tolist()
            if len(ids) == p.doc_tokens:
                back[(i, tuple(ids))] += 1
                ids = []
        assert not ids
    assert back == want


def test_white_space_at_the_ends_of_neighbouring_texts():
    """Words with white space at an end are never encoded beside each other."""
    import public_tokenizers
    from tokenizers import Tokenizer
    path = packing.tokenizer_file("byte_bpe_50k.json")
    texts = ["a s\n", "\tfoo b", "x\n\n", "\n\n\ty z", "p q\x0b", " lead", "trail ", "k\u00a0", "\u00a0m n"]
    ids, off = packing.BlockEncoder(path, packing.tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).encode(pa.array(texts))
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == want


def test_cut_is_the_binary_decomposition():
    row, start, length = packing.cut(np.array([1, 0, 5, 16, 37]), 16)
    assert list(zip(row.tolist(), start.tolist(), length.tolist())) == [
        (0, 0, 1), (2, 0, 4), (2, 4, 1), (3, 0, 16), (4, 0, 16), (4, 16, 16), (4, 32, 4), (4, 36, 1)]


# --- chat ----------------------------------------------------------------------
def turns(spark):
    said = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a < b # c \\h \\"), (1, 2, "user", "bye"), (1, 3, "assistant", "x\n</turn>\n### user: y"),
            (2, 0, "user", None), (3, 0, "assistant", "alone"), (3, 1, "user", "rest"), (4, 0, "us:er\\c", said), (4, 0, "us:er\\c", said),
            (4, None, None, said), (None, 5, "assistant", ""), (5, 1, "assistant", "é日本"), (-7, 0, "user", said), (-7, 1, "assistant", said)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("whole", F.lit(1)).withColumn("parts", F.lit(2))


def test_chat_round_trip(spark):
    df = turns(spark)
    by = defaultdict(list)
    for r in df.collect():
        by[r.conv_id].append((r.turn is not None, r.turn, r.role or "", r.text or ""))
    got = {r.conv_id: r for r in chat.chat_digest(chat.chat_examples(df)).collect()}
    assert set(got) == set(by)
    for c, ts in by.items():
        ts.sort()
        r = got[c]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        loss = "".join(t[3] for t in ts if t[2] == "assistant")
        assert r.n_turns == len(ts)
        assert r.turns_sha256 == sha("".join(f"{t[2]}\n{t[3]}\n" for t in ts))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_chat_examples_train_one_reply_each(spark):
    ex = chat.chat_examples(turns(spark)).filter("conv_id = 1").orderBy("example").collect()
    assert [e.text[e.loss_start:e.loss_end] for e in ex] == ["a \\l b \\h c \\bh \\b", "x\n\\l/turn>\n\\h\\h\\h user: y"]
    assert ex[1].text.startswith(ex[0].text) and ex[0].text.startswith("### user: hi</turn>\n### assistant: ")
    assert [e.last for e in ex] == [False, True]


# --- mixing --------------------------------------------------------------------
def test_mix_comes_near_its_targets(docs):
    rows = mixing.mix_sources(docs, keep=["doc_id", "source"]).select("row.*", "size", "source_size", "target", "copies", "taken").collect()
    sizes = Counter()
    biggest = Counter()
    for r in docs.collect():
        n = len(WORD.findall(r.text or ""))
        sizes[r.source] += n
        biggest[r.source] = max(biggest[r.source], n)
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while True:     # reshare what is above the cap until none is
        rest = budget - sum(target.values())
        level = rest / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] >= 2 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            free.discard(s)
    target |= {s: level * weight[s] for s in free}
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert sum(taken.values()) <= budget
    for s in sizes:
        assert abs(taken[s] - target[s]) <= sum(biggest.values())
    again = mixing.mix_sources(docs, keep=["doc_id", "source"]).select("row.*", "size", "copies").collect()
    assert Counter((r.doc_id, r.source, r.size, r.copies) for r in rows) == Counter((r.doc_id, r.source, r.size, r.copies) for r in again)
    stream = mixing.mixed_stream(docs)
    assert stream.columns == docs.columns and stream.count() == sum(r.copies for r in rows)


# --- language ------------------------------------------------------------------
def test_gradients_match_finite_differences():
    net = langid.BiGru(3, hidden=4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    net._run = lambda data, x, u, keep, f=net._run: f(data, x, u, keep)
    data = np.frombuffer(b"abcaxyzxaabb", np.uint8).reshape(3, 4)
    labels = np.array([0, 2, 1])
    grads, _ = net.gradients(data, labels)
    rng = np.random.default_rng(0)
    for name, w in net.w.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w.shape)
            if name[0] == "x":
                at = (int(data.ravel()[rng.integers(0, data.size)]), at[1])
            old, eps = w[at], 1e-2
            w[at] = old + eps
            up = net.gradients(data, labels)[1]
            w[at] = old - eps
            down = net.gradients(data, labels)[1]
            w[at] = old
            assert grads[name][at] == pytest.approx((up - down) / (2 * eps), abs=2e-3)


def test_language_held_out_accuracy(spark):
    from tests.conftest import SF01
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    out = langid.identify(df).join(df.select(F.col("doc_id").alias("id"), "lang"), "id").collect()
    held = [r for r in out if r.held_out]
    assert {r.id for r in held} == {r.id for r in out if zlib.crc32(str(r.id).encode()) % 5 == 0}
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edge_cases(docs):
    out = langid.identify(docs).collect()
    assert len(out) == docs.count()
    text = {(r.doc_id, r.text): r for r in docs.collect()}
    none = {i for (i, t) in text if i is not None and not any(c.isalpha() for c in t or "")}
    assert {r.id for r in out if r.lang_pred == "und" and r.id is not None} == none
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.lang_pred != "und" for r in out)
    assert langid.identify(docs.limit(0)).count() == 0
    unlabelled = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_language_learns_from_whole_texts(spark):
    rng = random.Random(5)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(3, 7)))
    # What tells the languages apart comes after 200 words that all texts share.
    rows = [(i, " ".join(["same"] * 200 + [word("abcdef" if i % 2 else "uvwxyz") for _ in range(40)]), "ab" if i % 2 else "uz") for i in range(60)]
    rows += [(100 + i, " ".join(word("abcdef" if i % 2 else "uvwxyz") for _ in range(40)), None) for i in range(40)]
    out = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).filter("id >= 100").collect()
    assert all(r.lang_pred == ("ab" if r.id % 2 else "uz") for r in out)


def test_language_pieces_and_shards(spark):
    rows = [("a", "x y x " + "é" * 40), ("b", "x z" + "q" * 130), ("a", " "), ("a", "x\u2003y")]
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["lang", "text"])
    got = Counter()
    for b in langid._count_pieces(["a", "b"])([batch]):
        for r in b.to_pylist():
            got[r["y"], r["piece"]] += r["n"]
    long, other = ("é" * 40).encode(), b"z" + b"q" * 130
    assert got == {(0, b"x"): 3, (0, b"y"): 2, (0, long[:64]): 1, (0, long[64:]): 1, (1, b"x"): 1, (1, other[:64]): 1, (1, other[64:128]): 1, (1, other[128:]): 1}
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(3, 7)))
    docs = spark.createDataFrame([(i, " ".join(word("abcdef" if i % 2 else "uvwxyz") for _ in range(40)), "ab" if i % 2 else "uz") for i in range(60)],
                                 "doc_id long, text string, lang string")
    net, langs = langid.train(docs, shard=300)
    again, _ = langid.train(docs.repartition(7), shard=300)
    assert langs == ["ab", "uz"] and np.array_equal(net.flat(), again.flat())
    assert net.score([b"abcfe"])[0].argmax() == 0 and net.score([b"xyzwu"])[0].argmax() == 1


def test_rejection_level_is_of_all_training_documents(spark):
    rng = random.Random(7)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(2, 4)))
    rows = [(i, " ".join(word(["abcd", "abce", "cdef"][i % 3]) for _ in range(rng.randint(1, 6))), ["p", "q", "r"][i % 3]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net, langs = langid.train(docs)
    level = langid.rejection_level(net, langs, langid._training(docs, "doc_id", "text", "lang", 5), 1.0)
    scores = {}
    for i, t, lang in rows:
        if zlib.crc32(str(i).encode()) % 5:
            pieces = [w.encode() for w in t.split()]
            scores.setdefault(lang, []).append((net.score(pieces).sum(0) / sum(map(len, pieces))).max())
    assert all(len(x) > 250 for x in scores.values())
    assert level == pytest.approx(min(sorted(x)[int(0.05 * len(x))] for x in scores.values()), rel=1e-5)


def test_lowest_share_is_exact(spark):
    rng = random.Random(9)
    scores = {"a": [rng.random() for _ in range(500)], "b": [rng.choice([0.1, 0.2, 0.3]) for _ in range(90)], "c": [0.5], "d": [0.4, 0.4 + 1e-16, 0.9]}
    df = spark.createDataFrame([(k, x) for k, v in scores.items() for x in v], "lang string, score double").repartition(5)
    for share in (0.0, 0.05, 0.5, 0.99):
        assert langid.lowest_share(df, share, bins=4) == {k: sorted(v)[int(share * len(v))] for k, v in scores.items()}


# --- Katz ----------------------------------------------------------------------
def test_base_score_and_counts(docs):
    rows = docs.select("doc_id", "text").collect()
    toks = [(r.doc_id, [*WORD.findall((r.text or "").translate(LOWER)), " "]) for r in rows]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(w for i, t in toks if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for i, t in toks)
    for share in (1e-6, 2e-3):
        got = katz.score_documents(docs, share=share).collect()
        assert sorted((str(r.id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        assert all(r.score < 0 for r in got)


@pytest.mark.parametrize("share", [1e-6, 2e-3])
def test_backoff_is_normalised_and_scores_agree_with_plain_recursion(docs, share):
    rows = docs.select((crc_mod(F.col("doc_id"), 10) != 0).alias("train"), "text")
    model, words, facts = katz.fit(rows, 3, share)
    uni = {r.word: r.n for r in words.collect()}
    p1 = {w: n * (1 + 1 / n) ** (facts["slope"] + 1) * facts["scale"] for w, n in uni.items()}
    assert sum(p1.values()) + facts["unseen"] == pytest.approx(1)
    ids = np.arange(len(model.vocab.words))
    rest = facts["unseen"] + sum(p for w, p in p1.items() if w not in model.vocab.number)
    for n in (2, 3):
        contexts = model.contexts[n][0]
        assert len(contexts)
        for key in contexts[::max(1, len(contexts) // 10)]:
            parts = []
            for _ in range(n - 1):
                parts.insert(0, int(key) % model.base)
                key = int(key) // model.base
            whole = (10 ** model.lower([np.full(len(ids), p) for p in parts] + [ids])).sum()
            back = np.prod([10 ** model.backoff([np.array([p]) for p in parts[k:]])[0] for k in range(n - 1)])
            assert whole + back * rest == pytest.approx(1, abs=1e-9)

    def prob(history, w):
        """log10 P by the definition, one token at a time; histories of context words only."""
        history = history[-2:]
        while history:
            parts = [np.array([model.vocab.number.get(x, model.vocab.other)]) for x in [*history, w]]
            if all(p[0] != model.vocab.other for p in parts[:-1]):
                n = len(parts)
                at = katz._find(model.keys[n], katz.pack(parts, model.base))[0] if parts[-1][0] != model.vocab.other else -1
                if at >= 0:
                    return model.logp[n][at]
                return model.backoff(parts[:-1])[0] + prob(history[1:], w)
            history = history[1:]
        return math.log10(p1.get(w, facts["unseen"]))
    got = sorted((str(r.id), round(r.score, 5)) for r in katz.score_documents(docs, share=share).filter("n_tokens < 300").collect())
    want = []
    for r in docs.select("doc_id", "text").collect():
        t = [*WORD.findall((r.text or "").translate(LOWER)), " "]
        if len(t) < 300:
            want.append((str(r.doc_id), sum(prob(t[:i], w) for i, w in enumerate(t))))
    assert [x for x, _ in got] == [x for x, _ in sorted(want)]
    assert [s for _, s in got] == pytest.approx([s for _, s in sorted((a, round(b, 5)) for a, b in want)], abs=1e-4)


def test_katz_beats_the_base_on_held_out_text(spark):
    from tests.conftest import SF01
    got = katz.score_documents(spark.read.parquet(f"{SF01}/documents.parquet")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.8 * got[1]


def test_katz_without_training_rows(docs):
    assert katz.score_documents(docs.limit(0)).count() == 0
    alone = docs.filter("doc_id is not null").filter(crc_mod(F.col("doc_id"), 10) == 0)
    out = katz.score_documents(alone).collect()
    assert len(out) == alone.count() and all(r.train_tokens == 0 and r.n_known == 0 for r in out)


def _same_scores(got, want):
    fields = lambda rows: sorted((str(r.id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), r.score) for r in rows)
    got, want = fields(got), fields(want)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for k in (5, 6):
        assert [r[k] for r in got] == pytest.approx([r[k] for r in want], rel=1e-6, abs=1e-3)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_joined_tables_score_like_the_model_in_memory(docs, order):
    rows = docs.filter("text is null or length(text) < 20000")
    _same_scores(katz.score_documents(rows, order=order).collect(), katz.score_documents(rows, order=order, share=0.0).collect())


@pytest.mark.parametrize("order", [2, 3])
def test_many_blocks_and_split_context_words_change_no_score(docs, order):
    rows = docs.filter("text is null or length(text) < 20000")
    hot = rows.sparkSession.createDataFrame([(10_000 + i, " ".join(f"the w{(i * 7 + j) % 90} the the" for j in range(60))) for i in range(40)], "doc_id long, text string")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").union(hot)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    _same_scores(katz.score_documents(rows, order=order, block_bytes=size // 9).collect(), katz.score_documents(rows, order=order, share=0.0).collect())


def test_buckets_in_parts_change_no_score_and_hold_less(docs):
    rows = docs.filter("text is null or length(text) < 20000").select("doc_id", "text")
    _same_scores(katz.score_documents(rows, part_rows=50, block_bytes=50_000).collect(), katz.score_documents(rows, part_rows=1 << 30, block_bytes=50_000).collect())
    # One bucket's rows from several blocks: arrays beside the rows themselves depend on the part, not on the bucket.
    rng = np.random.default_rng(4)
    coding = katz.Coding(np.arange(1, 3001, dtype=np.uint64), np.arange(3000, 0, -1), 3, 1, 4_501_500)
    cells = [katz._pack_rows([rng.integers(1, 3001, 40_000).astype(np.uint64) for _ in range(3)], np.ones(40_000, np.int64)) for _ in range(10)]
    bucket = pa.table({"block": list(range(10)), "bucket": [0] * 10, "n_rows": [40_000] * 10, "packed": [c[0] for c in cells], "rare": [c[1] for c in cells]})
    answers = pa.table({c: pa.array([], pa.float64() if c == "logp" else pa.int64()) for c in ("bucket", "w2", "w1", "n_word", "logp")})

    class Shared:
        value = coding
    peaks, out = [], []
    for part_rows in (1 << 30, 1 << 14):
        tracemalloc.start()
        out.append((sorted(map(str, katz._survey(Shared, part_rows)(bucket).filter(pa.compute.field("kind") < 2).to_pylist())),
                    katz._evaluate(Shared, {2: -1.5, 3: -1.7}, {"slope": -1.4, "scale": 1e-7, "unseen": 0.01}, part_rows)(bucket, answers)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert out[0] == out[1] and peaks[1] < 0.6 * peaks[0], peaks


def test_rare_grams_stay_however_large_the_corpus(spark):
    rare = "seven rare words that come only once"
    rows = [(1, "x y z " * 400_000), (2, rare), *((i, f"{rare} {i}") for i in range(3, 40))]
    rows = [r for r in rows if r[0] < 3 or zlib.crc32(str(r[0]).encode()) % 10 == 0]
    assert len(rows) > 2 and not any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows[:2])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = katz.score_documents(df).collect()
    assert {r.train_tokens > 1e6 for r in got} == {True}
    _same_scores(got, katz.score_documents(df, share=0.0).collect())


# --- nearest neighbours --------------------------------------------------------
def vectors(spark, n=700, dim=12, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    hot = rows[10][1]
    rows += [(n + i, hot) for i in range(60)]                       # one very common vector
    rows += [(2000, None), (2020, []), (2040, [0.0] * dim), (2060, [float("nan")] + hot[1:]), (2080, [float("inf")] + hot[1:]),
             (2100, [None] + hot[1:]), (2120, [1.0, 2.0, 3.0]), (2121, [1.0, 2.0, 4.0]), (None, hot), (5, hot), (40, hot)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return rows, df.withColumn("shard", F.lit(1)).withColumn("v", F.lit(2)).repartition(3)


def test_recall_against_brute_force(spark):
    rows, df = vectors(spark)
    ok = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows
          if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    ask = {}
    for i, v in sorted(((i, tuple(v)) for i, v in ok if i % 20 == 0), reverse=True):
        ask[i] = np.array(v)
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("id") % 20 == 0, k=20, shard_rows=300).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    for q, v in ask.items():
        best = sorted((-float((x * v).sum()), i) for i, x in ok if i != q and len(x) == len(v))[:20]
        mine = sorted(got.pop(q, []))
        assert [r for r, _, _ in mine] == list(range(1, len(best) + 1))
        assert mine == sorted(mine, key=lambda r: (-r[2], r[1]))
        for _, i, s in mine:
            assert any(j == i and s == pytest.approx(float((x * v).sum()), rel=1e-12, abs=1e-12) for j, x in ok)
        hit += len({i for _, i, _ in mine} & {i for _, i in best})
        total += len(best)
    assert not got and hit >= 0.97 * total


def test_repeated_rows_of_the_query_hide_no_equal_vector(spark):
    hot = [1.0, 2.0, 3.0]
    rows = [(20, hot)] * 30 + [(i, hot) for i in range(21, 40)] + [(3, hot), (4, [1.0, 2.0, 2.5]), (5, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(df, F.col("id") % 20 == 0, k=10).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == list(enumerate([3, *range(21, 30)], 1))


def test_no_vectors(spark):
    _, df = vectors(spark, n=30)
    assert ann.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert ann.nearest(df, F.lit(False)).count() == 0
