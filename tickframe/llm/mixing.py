"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Each source gets a share of the total budget by weight, at most ``max_epochs`` times its own size; what is
above goes to the other sources by weight. Documents of a source stand in a shuffled order that depends on the
seed and the id alone. Copy e of a document finishes at virtual time (e * source size + words of the source up to and
with it) / target; all copies are sorted by that time over all sources and taken until the budget is full.

Running sums are taken in two steps (sums of hash ranges, then inside each range), so a source that holds a third of
all rows is spread over ``RANGES`` windows. Null texts have size 0; null sources are one source that comes last; null
ids shuffle as the text ``null``; repeated rows are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import WORD, col, stored

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2
# Hash ranges per source, and slots of virtual time: three hexadecimal digits.
RANGES = 4096
# Virtual times from here on share one slot (targets end at 1).
LAST_TIME = 16.0


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = BUDGET_SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target): min(epochs * size, level * weight), the level such that targets sum to the budget.

    The work is on one row per source: sources sorted by cap / weight fill up one after another.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_code_point) - 1) % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", w).withColumn("cap", F.col("source_size") * float(epochs))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("*", (F.sum("source_size").over(everything) * float(share)).alias("budget"),
                 F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
                 (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_left"))
    # The first source, in filling order, that the remaining level doesn't fill sets the level for all after it.
    level = (F.col("budget") - F.col("cap_before")) / F.col("weight_left")
    s = s.withColumn("level", level).withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    s = s.withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level"))))
                     .over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"))


def _sized(docs: DataFrame, keep: list, source_col: str, id_col: str, text_col: str, seed: str) -> DataFrame:
    """``row`` (the columns to keep) with size, source (never null), shuffle key and hash range."""
    ident = F.coalesce(col(id_col).cast("string"), F.lit("null"))
    named = F.when(col(source_col).isNotNull(), F.concat(F.lit("s"), col(source_col).cast("string")))
    rows = docs.select(F.struct(*[col(c) for c in keep]).alias("row"), n_words(col(text_col)).alias("size"), named.alias("source"),
                       F.md5(F.concat(F.lit(seed + ":"), ident).cast("binary")).alias("key"))
    return rows


def _finish(epoch: int) -> F.Column:
    done = (F.col("start") + F.col("inside") + F.lit(epoch) * F.col("source_size")).cast("double")
    return F.when(F.col("target") > 0, done / F.col("target")).otherwise(F.lit(0.0))


def _timed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``inside``, the running words within the hash range, and the range's ``start`` in its source."""
    rows = rows.withColumn("src", F.coalesce("source", F.lit("n"))).withColumn("slot", F.substring("key", 1, 3))
    inside = Window.partitionBy("src", "slot").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("inside", F.sum("size").over(inside)).drop("source").join(plan, ["src", "slot"])


def mix_sources(docs: DataFrame, keep: list | None = None, source_col: str = "source", id_col: str = "doc_id",
                text_col: str = "text", seed: str = "mix", weights=WEIGHTS, share: float = BUDGET_SHARE,
                epochs: int = MAX_EPOCHS) -> DataFrame:
    """``row`` (struct of the columns ``keep``, all by default), size, source_size, target, copies, taken, finish."""
    sized = stored(_sized(docs, [id_col], source_col, id_col, text_col, seed), "mix-sizes")
    targets = source_targets(sized, weights, share, epochs)
    sums = sized.groupBy("source", F.substring("key", 1, 3).alias("slot")).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    plan = sums.alias("a").join(targets.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
    plan = stored(plan.select(F.coalesce("a.source", F.lit("n")).alias("src"), "slot", "start", "source_size", "target"), "mix-plan")

    copies = _timed(sized, plan).select("size", "key", F.explode(F.array(*[_finish(e) for e in range(epochs)])).alias("finish"))
    budget = (sized.agg(F.sum("size")).first()[0] or 0) * float(share)
    cut = F.struct(*[F.lit(x).cast(t).alias(n) for x, t, n in zip(_cut(copies, budget), ("double", "string", "long"), ("finish", "key", "size"))])
    narrow = keep is not None and list(keep) == [id_col]
    rows = _timed(sized if narrow else _sized(docs, docs.columns if keep is None else keep, source_col, id_col, text_col, seed), plan)
    taken = [(F.struct(_finish(e).alias("finish"), F.col("key"), F.col("size")) <= cut).cast("int") for e in range(epochs)]
    rows = rows.withColumn("copies", sum(taken[1:], taken[0])).withColumn("finish", _finish(0))
    return rows.select("row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "finish")


def _cut(copies: DataFrame, budget: float) -> tuple:
    """The last copy, in order of (finish, key, size), that still fits the budget: one row for the driver."""
    copies = copies.withColumn("slot", F.floor(F.least(F.col("finish"), F.lit(LAST_TIME)) * RANGES))
    sums = copies.groupBy("slot").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("upto", F.sum("words").over(Window.orderBy("slot")))  # a bounded number of slots
    slot = sums.filter(F.col("upto") - F.col("words") <= budget).agg(F.max(F.struct("slot", "upto", "words")).alias("s")).first()["s"]
    if slot is None:
        return (-1.0, "", 0)
    inside = copies.filter(F.col("slot") == slot["slot"])
    before = slot["upto"] - slot["words"]
    inside = inside.withColumn("upto", F.sum("size").over(Window.orderBy("finish", "key", "size")) + F.lit(before))
    last = inside.filter(F.col("upto") <= budget).agg(F.max(F.struct("finish", "key", "size")).alias("s")).first()["s"]
    if last is None:  # not even the first copy of this slot fits: everything before the slot is taken
        return (slot["slot"] / RANGES, "", -1)
    return (last["finish"], last["key"], last["size"])


def mixed_stream(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every taken copy as a row with the columns of ``docs``, range-sorted by virtual finish time."""
    rows = mix_sources(docs, **options).filter(F.col("copies") > 0)
    step = F.col("source_size") / F.col("target")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    rows = rows.withColumn("finish", F.col("finish") + F.col("epoch") * F.coalesce(step, F.lit(0.0)))
    return rows.orderBy("finish").select("row.*")
