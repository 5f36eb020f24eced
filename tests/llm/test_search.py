"""Token counts, ranked lexical search and hard negatives against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.fixtures import documents, words
from tickframe.llm import hard_negatives, lexical_search, packing, token_counts


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


# --- token counts --------------------------------------------------------------
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_file("byte_bpe_50k.json"))


def counter():
    import public_tokenizers
    return token_counts.TokenCounter(packing.tokenizer_file("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def test_token_counts_equal_the_library(docs):
    whole = library()
    want = Counter((r.doc_id, len((r.text or "").encode()), len(whole.encode(r.text or "", add_special_tokens=False).ids))
                   for r in docs.select("doc_id", "text").collect())
    got = token_counts.count_tokens(docs, limit=50).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 50) for r in got)
    assert token_counts.count_tokens(docs.limit(0)).collect() == []


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    alphabet = list("abcde  \n\t.,!?'sLl190é日本 ​ñ\U0001f600\x85\x1c՘") + ["<|endoftext|>", " the", " and", "'ll", " "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_token_counts_of_odd_and_long_texts(monkeypatch):
    whole, c = library(), counter()
    rng = random.Random(2)
    long = ["a" * 30_000, "ab" * 9_001, "日本語" * 3_000, "x  y" * 3_000, " " * 5_000, "\n" * 9_001,
            "".join(rng.choice("abcdefghijklmnop") for _ in range(20_000)), "".join(rng.choice("thein ") for _ in range(40_000))]
    texts = odd_texts(4_000) + long
    want = [len(e.ids) for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert c.count(texts).tolist() == want
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 500)  # texts worked off in parts
    assert c.count(texts).tolist() == want
    monkeypatch.setattr(token_counts, "LONG", 16)          # long sequences: cut, and merged by lists of places
    assert c.count(texts).tolist() == want


def test_narrow_characters_split_as_the_library_splits():
    c = counter()
    for code in range(ord(token_counts.NARROW)):
        s = f"a{chr(code)}1 {chr(code)} !{chr(code)}b  {chr(code)}{chr(code)} "
        assert [m.end() for m in c.pattern.finditer(s)] == [e for _, (_, e) in c.library(s)], code


def test_merge_order_is_checked():
    with pytest.raises(ValueError):
        token_counts.PairMerger({"a": 0, "b": 1, "ab": 2, "abb": 3}, ["ab b", "a b"], {"a": 97, "b": 98})


# --- lexical search ------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def search_by_hand(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(list)
    for i, t in set(items):
        if i is not None:
            asked[i] += terms(t)
    out = {}
    for item, ts in asked.items():
        scores = []
        for d, c in held:
            m = 25 + (75 * sum(c.values()) * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0 and d is not None:
                scores.append((-s, d))
        for rank, (s, d) in enumerate(sorted(scores)[:k], 1):
            out[item, rank] = (d, -s)
    return out


def item_rows(rng, texts):
    rows = [(k, " ".join(rng.sample(rng.choice(texts).split() or ["x"], 1) * rng.randint(1, 3) + words(rng, rng.randint(0, 12)).split())) for k in range(30)]
    return rows + [(30, None), (31, ""), (32, "... !!!"), (33, "KA Ka ka, é 日本-x"), (33, "second text"), (34, "zzzzzzzzzzzzzzzzzzzzzzzzz qqq"), (None, "ka lo"),
                   (2, rows[2][1]), (35, words(rng, 700))]


@pytest.mark.parametrize("block", [10 ** 6, 40])
def test_search_equals_brute_force(spark, docs, monkeypatch, block):
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)  # 40: many blocks of items
    monkeypatch.setattr(lexical_search, "CELLS", 500)
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = item_rows(rng, [t for _, t in rows if t])
    items = items if block > 100 else items[::4]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1)).withColumn("n", F.lit("x"))
    got = lexical_search.search(docs, table, k=4).collect()
    assert {(r.item_id, r.rank): (r.doc_id, r.score) for r in got} == search_by_hand(rows, items, 4) and got
    assert len(got) == len({(r.item_id, r.rank) for r in got})


def test_search_of_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "ka lo")], "item_id long, text string")
    assert lexical_search.search(docs, items.limit(0)).collect() == []
    assert lexical_search.search(docs.limit(0), items).collect() == []


def test_term_index_compares_bytes(monkeypatch):
    monkeypatch.setattr(lexical_search, "mix", lambda h: h & np.uint64(3))  # nearly every term collides
    index = lexical_search.TermIndex([b"one", b"three", b"fourteen-or-more", b"four"])
    text = np.frombuffer(b"one two three four five fourteen-or-more onetwo", np.uint8)
    begin, end = zip(*[(m.start(), m.end()) for m in re.finditer(rb"\S+", text.tobytes())])
    found = index.find(text, np.array(begin), np.array(end))
    assert [index.terms[i] if i >= 0 else None for i in found] == [b"one", None, b"three", b"four", None, b"fourteen-or-more", None]


def test_values_beyond_64_bits_stay_whole():
    tf, n = np.array([3, 2]), np.array([10 ** 9, 5])
    got = lexical_search.term_values(tf, n, 10 ** 10, 10 ** 12)
    want = [(10 ** 9 * t) // (1000 * t + 8 * (25 + 75 * m * 10 ** 10 // 10 ** 12)) for t, m in zip(tf.tolist(), n.tolist())]
    assert got.tolist() == want


# --- hard negatives ------------------------------------------------------------
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("score", T.StringType()), T.StructField("id", T.StringType())])


def vector_rows(seed, n, dim, scale=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    out = []
    for i in range(n):
        v = (centre[i % 6] + rng.normal(size=dim) * 0.4) * scale
        if i % 9 == 0:
            v = np.round(v, 1)
        out.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3)) if i % 5 else 0, "s", "i"))
    out += [(n + 1, None, 1, None, None), (n + 2, [], 1, None, None), (n + 3, [float("nan")] * dim, 1, None, None), (n + 4, [float("inf")] * dim, 1, None, None),
            (n + 5, [None] + [1.0] * (dim - 1), 1, None, None), (None, out[1][1], 1, None, None), (n + 6, out[2][1], None, None, None), (n + 7, [0.0] * dim, 2, None, None),
            (100, out[100 % n][1], out[100 % n][2], "again", None), (1100, [1.0] * (dim + 1), 0, None, None), (1200, [0.5] * dim, 99, None, None)]
    out += [(n + 20 + k, out[3][1], k % 3, None, None) for k in range(12)]  # one vector many times, several labels
    return out


def mine_by_hand(rows, percent=80):
    best = {}
    for i, v, label, *_ in rows:
        if i is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v):
            key = (label, v)
            best[i] = min(best.get(i, key), key)
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in best.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a, (label, v) in q.items():
        if a % 100:
            continue
        scored = sorted((-dot(v, w), i, lab) for i, (lab, w) in q.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            hard = [(i, t) for t, i, lab in scored if lab != label and percent * -s <= 100 * -t <= 100 * -s][:5]
            out |= {(a, p, rank, i, -s, -t) for rank, (i, t) in enumerate(hard, 1)}
    return out


@pytest.mark.parametrize("seed,n,dim,scale,small", [(1, 420, 8, 1.0, True), (2, 420, 3, 1.0, False), (3, 230, 4, 8e5, True)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed, n, dim, scale, small):
    if small:  # deep trees and several shards
        for name, value in (("LEAF", 4), ("FANOUT", 3), ("MIN_SHARD_ROWS", 100), ("ANCHOR_BLOCK", 2)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = vector_rows(seed, n, dim, scale)
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS).repartition(3), F.col("id") % 100 == 0).collect()
    want = mine_by_hand(rows)
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 20


def test_scores_beyond_doubles_stay_exact():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(60, 5)) * 2.0 ** 40)
    forest = hard_negatives.Forest.build(np.arange(60), np.zeros(60, np.int64), x)
    kept = hard_negatives.Forest.from_arrays(forest.to_arrays(), 5)
    want = sorted((-sum(int(a) * int(b) for a, b in zip(x[7], y)), i) for i, y in enumerate(x) if i != 7)[:5]
    assert kept.positives(7, 0, x[7], 5) == [(-s, i) for s, i in want]


def test_hard_negatives_of_empty_and_lonely_tables(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0], 1, None, None), (100, [1.0, 1.0], 2, None, None)], VECTORS)
    assert hard_negatives.mine(table, F.col("id") % 100 == 0).collect() == []
    assert hard_negatives.mine(table.limit(0), F.col("id") % 100 == 0).collect() == []


def test_str_tiles_hold_every_row_once():
    x = np.random.default_rng(0).normal(size=(1000, 3))
    order = hard_negatives.str_order(x, 16)
    assert sorted(order.tolist()) == list(range(1000))
    spread = [np.prod(np.ptp(x[order[i:i + 16]], axis=0)) for i in range(0, 992, 16)]
    assert np.mean(spread) < 0.1 * np.prod(np.ptp(x, axis=0))
