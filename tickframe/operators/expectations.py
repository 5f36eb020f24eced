"""Table expectations: the collector's self-test invariants, checked over data.

Each rule is a boolean "violated" column; one aggregation counts rows checked
and violations per rule, then ``stack`` turns the single summary row into
``(rule, checked, violations)`` rows. Rules needing a running session value
(VWAP bounds, previous close) use one window over the session
``(symbol, session_date)``; per-day digests keep the sink check cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions.candle import is_collapsed
from ..functions.quality import data_quality
from ..params import DEFAULT, DQ_LABELS, Params
from ..schema import INT_COLUMNS, LEGACY_MISSING, PARTITION_COLUMNS, TICK_SCHEMA
from ..session import materialised

RULES = ["EXP-1", "EXP-2", "EXP-3", "EXP-4", "EXP-5", "EXP-6", "EXP-7", "EXP-8", "EXP-11", "EXP-12"]


def _with_absent(ticks: DataFrame) -> DataFrame:
    """Older layouts lack the bar columns: read them as NULL."""
    return ticks.select("*", *[F.lit(None).cast(TICK_SCHEMA[c].dataType).alias(c) for c in LEGACY_MISSING if c not in ticks.columns])


def violations(ticks: DataFrame, p: Params = DEFAULT, session_col: str | None = None) -> DataFrame:
    """Add one ``v_<rule>`` column per data rule: True where violated, NULL where the row can't tell.

    The bar's day and hour come from ``bar_ts`` or, in older rows, from the stored
    calendar columns. The session is ``session_col`` or else the day the tick was
    collected (``tick_ts``). Rows without a session are windows of their own.
    """
    t = _with_absent(ticks)
    d = F.coalesce(F.to_date("bar_ts"), F.make_date("year", "month", "date"))
    hour = F.coalesce(F.hour("bar_ts"), F.col("hour"))
    sess = F.col(session_col) if session_col else F.to_date("tick_ts")
    lone = F.when(sess.isNull(), F.monotonically_increasing_id())
    base = Window.partitionBy("symbol", sess, lone).orderBy(F.coalesce("bar_ts", "tick_ts"), "tick_ts")
    upto = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The stored previous close is the rounded close of the session's previous stored tick.
    t = t.select("*", F.lag("close").over(base).alias("prev_close_rt"), F.min("low").over(upto).alias("_low"), F.max("high").over(upto).alias("_high"))
    dq = data_quality("close", "volume", F.col("prev_close_rt"), p)
    rules = {
        "EXP-1": ~F.col("days_to_expiry").between(0, 6) | ((F.col("expiry") == 1) != (F.col("days_to_expiry") == 0)),
        "EXP-2": (F.col("is_monthly_expiry") == 1) & ((F.col("expiry") != 1) | (d != cal.last_expiry_of_month(d, p))),
        "EXP-3": (F.col("week_of_month") != cal.week_of_month(d)) | ~F.col("week_of_month").between(1, 5),
        "EXP-4": F.col("session_number") != cal.session_number(hour),
        "EXP-5": ~F.col("data_quality").isin(*DQ_LABELS) | (F.col("data_quality") != dq),
        "EXP-6": (F.col("upper_shadow") < 0) | (F.col("lower_shadow") < 0) | ~F.col("body_pct").between(0, 100) | (F.col("hl_ratio") < 1),
        "EXP-7": (F.col("vwap") < F.round("_low", 2)) | (F.col("vwap") > F.round("_high", 2)),
        "EXP-8": is_collapsed("open", "high", "low", "close"),
        "EXP-11": ~cal.is_market_open(F.col("tick_ts"), p),
        "EXP-12": d != sess,
    }
    return t.select("*", *[e.alias("v_" + k.replace("-", "_")) for k, e in rules.items()]).drop("_low", "_high")


def expectation_report(ticks: DataFrame, p: Params = DEFAULT, session_col: str | None = None) -> DataFrame:
    """``(rule, checked, violations)``, one row per data rule; ``checked`` counts the rows that could tell."""
    return _counted(violations(ticks, p, session_col).groupBy())


def session_report(ticks: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``(unit, rule, checked, violations)`` of the data rules by unit (``unit_of``): no rule looks beyond a unit's rows."""
    return _counted(violations(ticks, p).groupBy(unit_of().alias("unit")), "unit")


def unit_of():
    """The day a tick was collected; rows without it count by the day they are stored under."""
    return F.coalesce(F.date_format("tick_ts", "yyyy-MM-dd"), F.concat_ws("-", F.lit("none"), *PARTITION_COLUMNS))


def _counted(rows, *by: str) -> DataFrame:
    names = [(k, k.replace("-", "_")) for k in RULES]
    summary = rows.agg(*[F.count("v_" + n).alias("c_" + n) for _, n in names], *[F.count_if(F.col("v_" + n)).alias(n) for _, n in names])
    stack = ", ".join(f"'{k}', c_{n}, {n}" for k, n in names)
    return summary.selectExpr(*by, f"stack({len(RULES)}, {stack}) AS (rule, checked, violations)")


def schema_report(schema: T.StructType) -> list[tuple[str, bool]]:
    """EXP-9: the integer columns exist with INT type; the bar columns exist."""
    types = {f.name: f.dataType for f in schema.fields}
    out = [(f"int:{c}", isinstance(types.get(c), T.IntegerType)) for c in INT_COLUMNS]
    out += [(f"present:{c}", c in types) for c in LEGACY_MISSING]
    return out


def schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """EXP-9 as rows: (check, ok)."""
    return spark.createDataFrame(schema_report(schema), "check string, ok boolean")


def full_report(spark: SparkSession, of, p: Params = DEFAULT, data_rules: DataFrame | None = None) -> DataFrame:
    """``(rule, checked, violations)`` of every rule, EXP-9 on the table's schema included; with the three sinks
    (``sinks.fanout.Sinks``) instead of a table name EXP-10 too: rows that a file sink lacks or has beyond the table's.

    ``data_rules``: the data rules' rows, where they are known (``plans.report.stored_report``)."""
    table = spark.table(of if isinstance(of, str) else of.table)
    checks = schema_report(table.schema)
    out = (expectation_report(table, p) if data_rules is None else data_rules).unionAll(spark.createDataFrame([("EXP-9", len(checks), sum(not ok for _, ok in checks))], "rule string, checked long, violations long"))
    if not isinstance(of, str):
        sides = of.read(spark)
        # Columns that an older table lacks are NULL in the files.
        seen = sides.pop("table")
        agree = sinks_agree(_with_absent(seen).select(*TICK_SCHEMA.fieldNames()), sides)
        out = out.unionAll(agree.select(F.lit("EXP-10").alias("rule"), F.col("rows").alias("checked"), (F.col("missing") + F.col("extra")).alias("violations"))
                           .groupBy("rule").agg(F.sum("checked").alias("checked"), F.sum("violations").alias("violations")))
    return out


def _row_hash(cols: list):
    """Hash of a row that also tells which fields are NULL."""
    return F.xxhash64(*cols, *[F.col(c).isNull() for c in cols]).cast("decimal(38,0)")


def sinks_agree(reference: DataFrame, copies: dict[str, DataFrame], keys: tuple = ("year", "month", "date")) -> DataFrame:
    """EXP-10: per copy, row count and rows missing / extra against ``reference`` (multiset).

    Every side is read once for per-day digests (row count and summed row hash,
    partially aggregated before the shuffle), kept as one small table. Only where a
    day differs are the rows of such days compared exactly, both ways.
    """
    cols = reference.columns
    keys = [k for k in keys if k in cols]
    sides = {"": reference, **{n: df.select(*cols) for n, df in copies.items()}}
    labelled = None
    for name, df in sides.items():
        part = df.select(F.lit(name).alias("sink"), *keys, _row_hash(cols).alias("h"))
        labelled = part if labelled is None else labelled.unionByName(part)
    per_day = labelled.groupBy(*keys).agg(*[x for i, n in enumerate(sides) for x in (
        F.count_if(F.col("sink") == n).alias(f"n{i}"), F.coalesce(F.sum(F.when(F.col("sink") == n, F.col("h"))), F.lit(0)).alias(f"h{i}"))])
    per_day = materialised(per_day, "sink-digests")
    differs = {n: (F.col(f"n{i}") != F.col("n0")) | (F.col(f"h{i}") != F.col("h0")) for i, n in enumerate(sides) if n}
    totals = per_day.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(n) for i, n in enumerate(sides) if n],
                         *[F.count_if(e).alias("bad_" + n) for n, e in differs.items()]).first()

    def only(df: DataFrame, days: DataFrame) -> DataFrame:
        return df.join(days, [df[k].eqNullSafe(days[k]) for k in keys], "left_semi") if keys else df

    out = None
    for name in copies:
        part = reference.sparkSession.range(1).select(F.lit(name).alias("sink"), F.lit(totals[name]).cast("long").alias("rows"))
        if totals["bad_" + name]:
            days = per_day.filter(differs[name]).select(*keys)
            a, b = only(reference, days), only(sides[name], days)
            part = part.crossJoin(a.exceptAll(b).agg(F.count("*").alias("missing"))).crossJoin(b.exceptAll(a).agg(F.count("*").alias("extra")))
        else:
            part = part.select("*", F.lit(0).cast("long").alias("missing"), F.lit(0).cast("long").alias("extra"))
        out = part if out is None else out.unionByName(part)
    return out
