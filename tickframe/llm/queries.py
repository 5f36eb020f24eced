"""The operators as registered queries over the given tables, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import (ann, chat, exact_dedup, hard_negatives, katz, langid, lexical_search, mixing, ngram_join, packing, paragraph_dedup, suffix_dedup,
                           token_counts)
from tickframe.llm.common import table

_BLANK = r"[\x20\x09-\x0D]+"
_WORDS = r"[^\x20\x09-\x0D]+"


def op1_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.shingle_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def near_sql(docs: str, k: int, num: int, den: int) -> str:
    """CTEs that end in near_comp (doc_id, n_shingles, component_id) for the rows of ``docs``."""
    return rf"""near_words AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM {docs}),
near_sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= {k} THEN list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))
                                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM near_words),
near_flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM near_sets),
near_links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM near_flat a JOIN near_flat b ON a.g = b.g AND a.doc_id < b.doc_id
               GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING {den} * count(*) >= {num} * (a.n + b.n - count(*))),
near_both AS (SELECT a, b FROM near_links UNION ALL SELECT b, a FROM near_links),
near_reach AS (SELECT DISTINCT a AS doc_id, a AS other FROM near_both
               UNION SELECT r.doc_id, l.b FROM near_reach r JOIN near_both l ON r.other = l.a),
near_root AS (SELECT doc_id, min(other) AS root FROM near_reach GROUP BY doc_id),
near_comp AS (SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
              FROM near_sets d LEFT JOIN near_root r ON d.doc_id = r.doc_id)"""


OP3_SQL = "WITH RECURSIVE " + near_sql("documents", 4, 85, 100) + " SELECT * FROM near_comp"


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


def op5_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = rf"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_BLANK}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AND row_number() OVER (PARTITION BY text_sha256, doc_id) = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


def op7_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = paragraph_dedup.remove_paragraphs(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "removed_words", "n_spans", "spans", "kept_text")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.chat_digest(chat.chat_examples(turns.unionByName(extra)))


OP8_SQL = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
             length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h')) + length(role) + 14 AS chars FROM rows),
r AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto, max(k) OVER (PARTITION BY conv_id) AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(CASE WHEN role = 'assistant' OR k = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role = 'assistant' OR k = n) AS n_examples
FROM r GROUP BY conv_id
"""


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("row.doc_id", "size", "source_size", "target", "taken")


# Sources that hold all columns of ``documents``: {docs}; the rows to return: {out}.
MIX_SQL = rf"""
WITH mix_sized AS (SELECT *, coalesce(length(regexp_extract_all(text, '{_WORDS}')), 0) AS mix_size,
                          md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS mix_key FROM {{docs}}),
mix_source AS (SELECT source, sum(mix_size) AS source_size FROM mix_sized GROUP BY source),
mix_cap AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
                   source_size * 2.0::DOUBLE AS cap FROM mix_source),
mix_fill AS (SELECT *, (sum(source_size) OVER ()) * 1.5::DOUBLE AS budget,
        coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
        sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
    FROM mix_cap),
mix_level AS (SELECT (budget - cap_before) / weight_left AS level FROM mix_fill
              WHERE cap > (budget - cap_before) / weight_left * weight ORDER BY cap / weight LIMIT 1),
mix_target AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, budget,
                      coalesce(least(cap, (SELECT level FROM mix_level) * weight), cap) AS target FROM mix_fill),
mix_done AS (SELECT d.*, t.source_size, t.budget, t.target, CAST(sum(mix_size) OVER (PARTITION BY d.source ORDER BY mix_key, mix_size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS done
             FROM mix_sized d JOIN mix_target t ON d.source IS NOT DISTINCT FROM t.source),
mix_copies AS (SELECT *, CASE WHEN target > 0 THEN (done + e * source_size)::DOUBLE / target ELSE 0 END AS finish
               FROM mix_done, (VALUES (0), (1)) AS v(e)),
mix_order AS (SELECT *, sum(mix_size) OVER (ORDER BY finish, mix_key, mix_size) <= budget AS fits FROM mix_copies)
{{out}}
"""

OP9_SQL = MIX_SQL.format(docs="documents", out="""
SELECT doc_id, mix_size AS size, source_size, target, CAST(sum(CASE WHEN fits THEN mix_size ELSE 0 END) AS BIGINT) AS taken
FROM mix_order GROUP BY doc_id, mix_size, source_size, target, done""")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms_sql(rows: str, key: str) -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, unnest(regexp_extract_all({lower}, '{_TERMS}')) AS term FROM {rows}"


OP12_SQL = f"""
WITH doc_terms AS ({_terms_sql('documents', 'doc_id')}),
item_terms AS (SELECT item_id, term, count(*) AS many FROM ({_terms_sql('benchmark', 'item_id')}) GROUP BY item_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
totals AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
counts AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, totals GROUP BY term),
vals AS (SELECT c.doc_id, c.term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // big_l)) AS v
         FROM counts c JOIN lengths l ON c.doc_id = l.doc_id, totals),
scores AS (SELECT item_id, doc_id, CAST(sum(many * w * v) AS BIGINT) AS score
           FROM item_terms i JOIN weights w ON i.term = w.term JOIN vals v ON i.term = v.term GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


OP13_SQL = """
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
              FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                  CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
           FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
tops AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
         QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
hard AS (SELECT t.*, s.vec_id AS negative_id, s.score AS negative_score,
                row_number() OVER (PARTITION BY t.anchor_id, t.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
         FROM tops t JOIN scored s ON t.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 5
"""


#: name -> (query, SQL or None)
QUERIES = {
    "op1_hnsw_search": (op1_hnsw_search, None),
    "op2_packing": (op2_packing, None),
    "op3_ngram_join": (op3_ngram_join, OP3_SQL),
    "op4_language_id": (op4_language_id, None),
    "op5_katz_scoring": (op5_katz_scoring, None),
    "op6_exact_dedup": (op6_exact_dedup, OP6_SQL),
    "op7_paragraph_dedup": (op7_paragraph_dedup, None),
    "op8_chat_formatting": (op8_chat_formatting, OP8_SQL),
    "op10_suffix_array_dedup": (op10_suffix_array_dedup, None),
    "op9_source_mixing": (op9_source_mixing, OP9_SQL),
    "op11_token_counts": (op11_token_counts, None),
    "op12_lexical_search": (op12_lexical_search, OP12_SQL),
    "op13_hard_negatives": (op13_hard_negatives, OP13_SQL),
}
