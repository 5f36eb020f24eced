import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF01
from tests.llm.fixtures import documents
from tests.llm.test_dedup import brute_roots, brute_sets
from tickframe.llm import langid, mixing, packing
from tickframe.llm.queries import QUERIES


def test_stages_against_brute_force(spark, tmp_path):
    docs = documents(spark)
    path = str(tmp_path / "t")
    os.makedirs(path)
    docs.write.parquet(f"{path}/documents.parquet")
    rows = docs.select("doc_id", "text", "source").collect()
    good = Counter((r.id) for r in langid.identify(docs).filter("lang_pred != 'und'").collect())
    now = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, path)
        assert now.columns == docs.columns
        now = now.cache()
        seen[name] = [(r.doc_id, r.text) for r in now.collect()]
    assert Counter(i for i, _ in seen["language_id"]) <= good
    least = {}
    for i, t in seen["language_id"]:
        t = re.sub("[\x20\x09-\x0D]+", " ", t)
        least[t] = i if least.get(t) is None else min(x for x in (i, least[t]) if x is not None)
    assert Counter(i for i, _ in seen["exact_dedup"]) == Counter(least.values())
    ids, sets = [i for i, _ in seen["exact_dedup"]], brute_sets([t for _, t in seen["exact_dedup"]], 5)
    roots = set(brute_roots(ids, sets, 80, 100))
    assert Counter(i for i, _ in seen["near_dedup"]) == Counter(c for _, c in roots)
    assert {i for i, _ in seen["source_mix"]} <= {i for i, _ in seen["near_dedup"]}
    assert max(Counter(seen["source_mix"]).values()) <= 2
    out = corpus_pipeline.run(spark, path).collect()
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(packing.tokenizer_file("byte_bpe_50k.json"))
    want = Counter()
    for i, t in seen["source_mix"]:
        want[i] += len(tk.encode(t, add_special_tokens=False).ids) + 1
    got = Counter()
    for r in out:
        got[r.doc_id] += r.length
    assert got == want


@pytest.mark.parametrize("langs", [("de", "en", "es", "fr"), ("en", "fr")])
def test_lettered_junk_is_rejected_and_clean_text_stays(spark, langs):
    rng = random.Random(8)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").filter(F.col("lang").isin(*langs)).select("doc_id", "text", "lang", "source")
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "qxzjkvw", "日本語漢字山川海空", "0123456789#$%&{}=;a"]
    junk = [(10 ** 6 + i, " ".join("".join(rng.choices(alphabets[i % 4], k=rng.randint(2, 9))) for _ in range(120)), None, "junk") for i in range(40)]
    kept = corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(junk, docs.schema)), SF01)
    kept = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not kept & {r[0] for r in junk}
    clean = docs.filter(F.size(F.split("text", " ")) >= 50).select("doc_id", "lang").collect()
    for lang in langs:
        ids = {r.doc_id for r in clean if r.lang == lang}
        assert len(ids & kept) >= 0.98 * len(ids) > 0


def test_the_mix_comes_in_queue_order(spark):
    docs = documents(spark).filter("doc_id is not null").dropDuplicates(["doc_id"]).cache()
    times = {r.doc_id: r for r in mixing.mix_sources(docs).select("row.doc_id", "finish", "source_size", "target", "copies").collect()}
    seen, finish = Counter(), []
    for r in corpus_pipeline.source_mix(spark, docs, SF01).select("doc_id").collect():
        t = times[r.doc_id]
        finish.append(t.finish + (seen[r.doc_id] * t.source_size / t.target if t.target else 0))
        seen[r.doc_id] += 1
    assert finish == pytest.approx(sorted(finish), rel=1e-12) and max(seen.values()) == 2
    assert seen == Counter({i: t.copies for i, t in times.items() if t.copies})


SQL = sorted(n for n, (_, sql) in QUERIES.items() if sql)


@pytest.mark.parametrize("name", SQL)
def test_queries_equal_their_sql(spark, name):
    from tools.oracle_check import canon, duck
    df = entry.queries()[name](spark, SF01)
    res = duck(SF01).execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), cols)


def test_every_operator_is_registered():
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
