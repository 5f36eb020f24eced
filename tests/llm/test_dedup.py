import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.fixtures import documents
from tickframe.llm import exact_dedup, ngram_join, paragraph_dedup, suffix_dedup
from tickframe.llm.shingles import shingle_sets
from tickframe.llm.common import text_bytes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


def brute_sets(texts, k):
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute_roots(ids, sets, num, den):
    """(root row, smallest id) of the component of every row."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [(find(i), least.get(find(i)) if sets[i] else ids[i]) for i in range(len(ids))]


def brute_components(ids, sets, num, den):
    return [c for _, c in brute_roots(ids, sets, num, den)]


def test_trie_with_and_without_spill():
    rng = np.random.default_rng(1)
    keys = [bytes(rng.integers(97, 99, rng.integers(0, 12), dtype=np.uint8)) for _ in range(3000)] + [b"prefix" * 50 + bytes([i]) for i in range(60)]
    want = defaultdict(lambda: [None, 0])
    for i, k in enumerate(keys):
        want[k][0] = exact_dedup.smaller(want[k][0], i)
        want[k][1] += 1
    for most in (10 ** 9, 20_000, 2_000):
        trie = exact_dedup.PatriciaTrie(most)
        for i, k in enumerate(keys):
            trie.add(k, i)
        got = list(trie.items())
        assert len(got) == len(want) and {k: [i, n] for k, i, n in got} == dict(want), most


def test_exact_dedup(docs):
    rows = docs.select("doc_id", "text").collect()
    norm = [re.sub("[\x20\x09-\x0D]+", " ", r.text or "") for r in rows]
    groups = defaultdict(list)
    for r, t in zip(rows, norm):
        groups[t].append(r.doc_id)
    got = exact_dedup.exact_dedup(docs, trie_bytes=30_000).collect()
    assert len(got) == len(rows)
    keep = {hashlib.sha256(t.encode()).hexdigest(): (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}
    kept = defaultdict(int)
    for r in got:
        assert (r.keep_id, r.group_size) == keep[r.text_sha256]
        assert not r.kept or r.doc_id == r.keep_id
        kept[r.text_sha256] += r.kept
    assert set(kept) == set(keep) and set(kept.values()) == {1}
    stay = exact_dedup.drop_exact(docs)
    assert stay.columns == docs.columns and stay.count() == len(groups)


def test_shingles_match_words():
    import pyarrow as pa
    texts = ["", None, "a", "A  b", "a b c\td e\nF", "  x ", "é É e f g é É e f g", "a a a a a a"]
    for k in (1, 4, 5):
        h, at = shingle_sets(*text_bytes(pa.array(texts)), k)
        sets = brute_sets(texts, k)
        assert np.diff(at).tolist() == [len(s) for s in sets]
        parts = [set(h[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
        for i in range(len(texts)):
            for j in range(len(texts)):
                assert len(parts[i] & parts[j]) == len(sets[i] & sets[j])


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (2, 50, 100)])
def test_ngram_join_finds_every_link(docs, k, num, den):
    rows = docs.select("doc_id", "text").collect()
    sets = brute_sets([r.text for r in rows], k)
    comp = brute_components([r.doc_id for r in rows], sets, num, den)
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted(((r.doc_id, len(s), c) for r, s, c in zip(rows, sets, comp)), key=key)
    out = ngram_join.shingle_components(docs, k=k, num=num, den=den)
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in out.select("id", "n_shingles", "component_id").collect()), key=key) == want


def test_drop_near_keeps_one_of_each_group(docs):
    rows = docs.select("doc_id", "text").collect()
    sets = brute_sets([r.text for r in rows], 5)
    roots = brute_roots([r.doc_id for r in rows], sets, 80, 100)
    want = [c for _, c in {x for x, t in zip(roots, sets) if t}] + [r.doc_id for r, t in zip(rows, sets) if not t]
    out = ngram_join.drop_near(docs)
    assert out.columns == docs.columns
    assert Counter(x.doc_id for x in out.collect()) == Counter(want)


def brute_windows(texts, threshold):
    seen = defaultdict(int)
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        for s in range(len(b) - threshold + 1):
            seen[b[s:s + threshold]] += 1
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - threshold + 1):
            if seen[b[s:s + threshold]] > 1:
                gone[s:s + threshold] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("threshold,gram,run", [(400, 16, 64), (100, 16, 64), (60, 8, 8)])
def test_repeated_windows(docs, threshold, gram, run):
    short = docs.filter("text is null or length(text) < 5000")
    rows = short.select("doc_id", "text").collect()
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted([(r.doc_id, *w) for r, w in zip(rows, brute_windows([r.text for r in rows], threshold))], key=key)
    out = suffix_dedup.remove_repeats(short, threshold=threshold, gram=gram, run=run)
    got = sorted([(r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()], key=key)
    assert got == want and any(w[2] for w in want)


def test_paragraph_dedup_leaves_one_copy(docs):
    rows = docs.select("doc_id", "text").collect()
    out = paragraph_dedup.remove_paragraphs(docs).collect()
    assert len(out) == len(rows)
    texts = sorted(r.text or "" for r in rows)
    count = Counter(r.doc_id for r in rows)
    once = {r.doc_id: r.text or "" for r in rows if count[r.doc_id] == 1}
    assert all(r.kept_text == once[r.id] for r in out if r.id in once and not r.removed_words)

    def windows(ts, n):
        seen = defaultdict(set)
        for i, t in enumerate(ts):
            w = WORD.findall(t.translate(LOWER))
            for s in range(len(w) - n + 1):
                seen[tuple(w[s:s + n])].add(i)
        return seen
    before = windows(sorted(texts), 50)
    after = windows([r.kept_text for r in out], 50)
    assert any(len(v) > 1 for v in before.values())
    assert not any(len(v) > 1 for v in after.values())      # no passage of 50 words is left twice
    assert not [w for w, v in before.items() if len(v) >= 10 and w not in after]   # and a common one stays once
    alone = {r.doc_id for r in rows if r.doc_id is not None and 36 + 24 <= r.doc_id < 36 + 54}
    assert not [r.id for r in out if r.id in alone and r.removed_words]


def brute_paragraphs(rows, k, num, den, line_words, min_run):
    """(words, removed words, spans, kept text) of every (id, text), lines as units: each rule by comparing all with all."""
    units, found = [], []                                    # (row, first word, end word, word sequence, shingles)
    for i, (_, text) in enumerate(rows):
        raw = (text or "").encode()
        words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        found.append((raw, words))
        at = 0
        for line in raw.split(b"\n"):
            seq = tuple(line.decode().translate(LOWER).encode().split())
            if seq:
                units.append((i, at, at + len(seq), seq, {seq[j:j + k] for j in range(len(seq) - k + 1)}))
            at += len(seq)
    label = {u[3]: u[3] for u in units}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    near = {u[3]: u[4] for u in units if len(u[3]) >= line_words}
    for a, x in near.items():
        for b, y in near.items():
            if a < b and den * len(x & y) >= num * len(x | y):
                label[root(a)] = root(b)
    places = defaultdict(list)
    for u in units:
        i = u[0]
        places[root(u[3])].append(((rows[i][0] is None, rows[i][0] or 0, i, u[1]), u))
    covered, whole = ([[False] * len(w) for _, w in found] for _ in range(2))
    for group in places.values():
        for _, (i, first, end, seq, _) in sorted(group, key=lambda g: g[0])[1:]:
            covered[i][first:end] = [True] * (end - first)
            if len(seq) >= line_words:
                whole[i][first:end] = [True] * (end - first)
    out = []
    for (raw, words), some, cut in zip(found, covered, whole):
        for flags, least, to in ((some, min_run, cut), (cut, 1, None)):
            runs, at = [], 0
            for flag, run in itertools.groupby(flags):
                n = len(list(run))
                if flag and n >= least:
                    runs.append((at, at + n))
                at += n
            if to is not None:
                for a, e in runs:
                    to[a:e] = [True] * (e - a)
        spans = [(words[a][0], words[e - 1][1]) for a, e in runs]
        kept, at = b"", 0
        for a, e in spans:
            kept, at = kept + raw[at:a], e
        out.append((len(words), sum(cut), [x for sp in spans for x in sp], (kept + raw[at:]).decode()))
    return out


def test_paragraph_dedup_equals_brute_force(spark):
    """Whole operator, lines as units; 64 bands miss a pair at Jaccard 0.8 once in 10^20."""
    import random
    from tests.llm.fixtures import words
    rng = random.Random(11)
    long = [words(rng, 60).split() for _ in range(3)]
    short = [" ".join(words(rng, n).split()) for n in (1, 2, 3, 4, 4, 5, 6, 9, 12)]

    def edited():
        w = list(rng.choice(long))
        for _ in range(rng.choice((0, 1, 1, 2, 4))):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        return " ".join(w)

    def line():
        x = rng.choice((edited(), *rng.choices(short, k=4), words(rng, rng.randrange(1, 30)), "", "\u00e9\u00df " + words(rng, 6)))
        return rng.choice((x, x, x.upper() if x.isascii() else x, x.replace(" ", "\t ")))
    rows = [(rng.choice((i, i, i // 2, None)), "\n".join(line() for _ in range(rng.randrange(0, 12)))) for i in range(90)]
    rows += [(7, None), (None, None), (8, " \n\t"), rows[3], rows[3], (500, "\n".join(line() for _ in range(1500)))]
    rows += [(600 + i, "\n".join(short[:5] * 3)) for i in range(2)]                # short lines next to each other make a run
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = paragraph_dedup.remove_paragraphs(df, bands=64, section=10 ** 9).collect()
    want = brute_paragraphs(rows, 5, 80, 100, 5, 16)
    have = [(r.id, r.n_words, r.removed_words, tuple(r.spans), r.kept_text) for r in got]
    assert all(r.n_spans == len(r.spans) // 2 for r in got)
    assert Counter(have) == Counter((i, n, gone, tuple(spans), kept) for (i, _), (n, gone, spans, kept) in zip(rows, want))
    assert want[-1][1] > 0 and sum(w[1] for w in want) > 1000


def test_band_values_meet_as_often_as_they_should():
    """Pairs of sets at Jaccard 0.8 that share no band: about (1 - 0.8^3)^8 = 0.3 %."""
    rng = np.random.default_rng(1)
    pairs = 3000
    w = rng.integers(0, 2 ** 63, (pairs, 100), dtype=np.uint64)
    sets = np.stack([w[:, :90], np.concatenate([w[:, :80], w[:, 90:]], 1)], 1)
    v = paragraph_dedup.band_values(sets.reshape(-1), np.arange(2 * pairs) * 90, np.full(2 * pairs, 90), 1, 8, 3).reshape(pairs, 2, 8)
    assert (v[:, 0] != v[:, 1]).all(1).mean() < 0.008
    met = (v[:, 0] == v[:, 1]).mean()
    assert abs(met - 0.8 ** 3) < 0.02


def test_near_paragraphs_are_verified(spark):
    import random
    from tests.llm.fixtures import SCHEMA, words
    rng = random.Random(3)
    base = words(rng, 60).split()
    near = base[:30] + ["changed"] + base[31:]      # Jaccard 51 / 61
    far = base[:20] + ["p", "q"] + base[22:40] + ["r"] + base[41:]
    assert len({tuple(base[i:i + 5]) for i in range(56)} & {tuple(near[i:i + 5]) for i in range(56)}) == 51
    df = spark.createDataFrame([(1, " ".join(base), None, None), (2, " ".join(near), None, None), (3, " ".join(far), None, None)], SCHEMA)
    got = {r.id: r.removed_words for r in paragraph_dedup.remove_paragraphs(df, section=40).collect()}
    assert got[1] == 0 and got[2] == 60
    assert got[3] < 60


def test_repeated_short_lines_go_but_for_the_first(spark):
    import random
    from tests.llm.fixtures import SCHEMA, words
    rng = random.Random(4)
    nine, five, four = (" ".join(f"{w}{n}" for w in "abcdefghi"[:n]) for n in (9, 5, 4))
    def text(*lines):
        return "\n".join(x for line in lines for x in (words(rng, 40), line, words(rng, 40)))
    texts = [text(nine, five, four), text(nine.upper(), four), text(five, nine, nine), text(four + " " + words(rng, 30))]
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)
    got = {r.id: r for r in paragraph_dedup.remove_paragraphs(df).collect()}
    assert [got[i].removed_words for i in range(4)] == [0, 9, 23, 0]
    assert [got[i].n_spans for i in range(4)] == [0, 1, 3, 0]
    for i, t in enumerate(texts):
        gone = [x.translate(LOWER) in (nine, five) and i > 0 for x in t.split("\n")]
        assert got[i].kept_text.split("\n") == ["" if g else x for g, x in zip(gone, t.split("\n"))]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.drop_exact(none).count() == 0
    assert ngram_join.shingle_components(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert paragraph_dedup.remove_paragraphs(none).count() == 0


# --- fingerprints --------------------------------------------------------------
def thue_morse(n, a, b):
    word = [a]
    for _ in range(n):
        word += [b if x == a else a for x in word]
    return word


def test_structured_texts_have_fingerprints_of_their_own():
    from tickframe.llm.common import PRIME, SpanHash, times
    p = int(PRIME)
    a = np.array([p - 1, p - 1, 0, 12345678901234567, 2 ** 60], np.uint64)
    b = np.array([p - 1, 1, 5, 2 ** 61 - 2, 2 ** 60 + 7], np.uint64)
    assert [int(x) for x in times(a, b)] == [int(x) * int(y) % p for x, y in zip(a, b)]
    for n in range(6, 15):
        data = np.frombuffer("".join(thue_morse(n, "a", "b") + thue_morse(n, "b", "a") + thue_morse(n, "a", "b")).encode(), np.uint8)
        at = np.arange(3) << n
        h = SpanHash(data).spans(at, at + (1 << n))
        assert h[0] != h[1] and h[0] == h[2]


@pytest.fixture(scope="module")
def twins(spark):
    """Texts that a polynomial modulo 2^64 can't tell apart: long words, and lines of many words."""
    long_word = ["".join(thue_morse(10, *ab)) for ab in ("ab", "ba")]
    line = [" ".join(thue_morse(10, *ab)) for ab in (("lo", "mi"), ("mi", "lo"))]
    rows = [(i, t, "en", "s") for i, t in enumerate([*long_word, *line, *(f"one two three {w} four five" for w in long_word)])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_structured_texts_are_not_taken_for_copies(twins):
    from tickframe.llm import katz, ngram_join, paragraph_dedup, suffix_dedup
    joined = ngram_join.shingle_components(twins).collect()
    assert [r.component_id for r in joined if r.id in (0, 1, 4, 5)] == [r.id for r in joined if r.id in (0, 1, 4, 5)]
    for r in paragraph_dedup.remove_paragraphs(twins.filter("doc_id IN (0, 1, 2, 3)")).collect():
        if r.id < 2:
            assert r.removed_words == 0
    texts = [r.text.encode() for r in twins.orderBy("doc_id").collect()]
    want = repeated_bytes(texts, 400)
    assert {r.id: r.n_removed for r in suffix_dedup.remove_repeats(twins).collect()} == want
    data = np.frombuffer(b" ".join(texts[:2]), np.uint8)
    assert len(set(katz.SpanHash(data).spans(np.array([0, 1025]), np.array([1024, 2049])).tolist())) == 2


def repeated_bytes(texts, n):
    """Bytes of each text that lie in an n-byte string which starts anywhere else too."""
    places = {}
    for i, t in enumerate(texts):
        for at in range(len(t) - n + 1):
            places.setdefault(t[at:at + n], []).append((i, at))
    gone = [set() for _ in texts]
    for found in places.values():
        if len(found) > 1:
            for i, at in found:
                gone[i].update(range(at, at + n))
    return {i: len(g) for i, g in enumerate(gone)}
