"""Small document tables with the awkward cases: nulls, empties, ties, repeated rows, long texts, clashing names."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])

_SYLLABLES = "ka lo mi ne tu ra si vo pe du ga hi".split()


def words(rng, n):
    return " ".join("".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = "x" + str(rng.randrange(10 ** 6))
    return " ".join(w)


def document_rows(seed=5):
    """About 120 rows: near copies at many distances, exact copies, passages, a long text and the awkward cases."""
    rng = random.Random(seed)
    passage = words(rng, 70)
    out = []
    for base in range(4):
        text = words(rng, 160)
        out.append(text)
        out += [edited(rng, text, k) for k in (1, 1, 2, 2, 3, 4, 6, 9)]
        out += [text, text.replace(" ", "  \n", 3), text.upper()]
    for k in range(12):
        a, b = words(rng, rng.randint(5, 60)), words(rng, rng.randint(5, 60))
        out.append(f"{a} {passage} {b}" if k % 2 else f"{a}\n{passage}\n{b}")
    out += [words(rng, rng.randint(1, 120)) for _ in range(30)]
    out += [words(rng, 9000), "", "   \n\t ", None, None, "one", "one", "One  ", "a b", "a b c", "É è 日本 語 <|endoftext|> ok",
            "1234 5678 !!!", " lead", "trail ", "tab\there  there", "aaaa " * 400, "ab" * 900, "ab" * 900 + "c"]
    rows = [(i, t, "en" if i % 3 else "de", None if i % 11 == 0 else f"s{i % 5}") for i, t in enumerate(out)]
    rows += [rows[3], rows[3], (None, "null id text here", "en", "s1"), (None, None, None, None), (500, out[0], None, "s9"), (7, "second text of id seven", "en", "s2")]
    return rows


# Names that the operators might use themselves.
CLASHES = ["key", "row", "size", "node", "text_key", "sha_of_text", "keep_id", "kept_sha", "score", "target", "slot", "id", "tkey", "n", "d", "copies", "letters", "SOURCE_SIZE"]


def documents(spark, rows=None, clashes=True):
    df = spark.createDataFrame(document_rows() if rows is None else rows, SCHEMA)
    if clashes:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(7).alias(c) for c in CLASHES])
    return df.repartition(3).cache()
