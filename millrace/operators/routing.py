"""Routing rows to named relationships.

Each operator has two forms: a frame for each relationship, every one a lazy filter of
the same rows, for a caller that uses few of them; and all rows in one pass with the
relationship as a column (``label_…``), for one that uses several.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.operators.lookup import lookup_join
from millrace.operators.ordered import running_sums
from millrace.session import scratch_path

UNMATCHED = "unmatched"


def _predicate(value: Column | str) -> Column:
    return F.coalesce(F.expr(value) if isinstance(value, str) else value, F.lit(False))


def route_label(predicates: Mapping[str, Column | str]) -> Column:
    """The first relationship whose predicate holds, else ``unmatched``."""
    label = F.lit(UNMATCHED)
    for name, predicate in reversed(predicates.items()):
        label = F.when(_predicate(predicate), F.lit(name)).otherwise(label)
    return label


def route_on_attribute(
    df: DataFrame, predicates: Mapping[str, Column | str], mode: str = "all"
) -> dict[str, DataFrame]:
    """Route rows by predicates; a null predicate does not match.

    ``all``: a row goes to every relationship that matches; ``first``: to the
    first only. Rows that match none go to ``unmatched``.
    """
    if mode == "first":
        label = route_label(predicates)
        return {name: df.where(label == name) for name in [*predicates, UNMATCHED]}
    if mode != "all":
        raise ValueError("mode is 'all' or 'first'")
    routes = {name: df.where(_predicate(p)) for name, p in predicates.items()}
    any_match = reduce(Column.__or__, [_predicate(p) for p in predicates.values()], F.lit(False))
    return {**routes, UNMATCHED: df.where(~any_match)}


def label_on_attribute(
    df: DataFrame, predicates: Mapping[str, Column | str], mode: str = "all", name: str = "relationship"
) -> DataFrame:
    """As ``route_on_attribute`` in one pass: a row for each relationship, named in ``name``."""
    if mode == "first":
        return df.withColumn(name, route_label(predicates))
    if mode != "all":
        raise ValueError("mode is 'all' or 'first'")
    found = F.filter(
        F.array(*[F.when(_predicate(p), F.lit(relationship)) for relationship, p in predicates.items()]),
        lambda relationship: relationship.isNotNull(),
    )
    # Materialised before it is tested, so each predicate is evaluated once.
    labels = df.withColumn(name, found)
    return labels.withColumn(
        name, F.explode(F.when(F.size(name) > 0, F.col(name)).otherwise(F.array(F.lit(UNMATCHED))))
    )


def label_on_content(
    df: DataFrame, col: str, patterns: Mapping[str, str], mode: str = "all", name: str = "relationship"
) -> DataFrame:
    """As ``route_on_content`` in one pass."""
    found = {relationship: F.col(col).rlike(pattern) for relationship, pattern in patterns.items()}
    return label_on_attribute(df, found, mode, name)


def label_outcome(
    df: DataFrame, ok: Column | str, reason: Column | str, name: str = "relationship"
) -> DataFrame:
    """As ``split_outcome`` in one pass; successful rows have a null ``reason``."""
    good = _predicate(ok)
    why = F.expr(reason) if isinstance(reason, str) else reason
    return df.withColumns(
        {name: F.when(good, "success").otherwise("failure"), "reason": F.when(~good, why)}
    )


def route_on_content(
    df: DataFrame, col: str, patterns: Mapping[str, str], mode: str = "all"
) -> dict[str, DataFrame]:
    """Route rows by regular expressions found anywhere in the text."""
    return route_on_attribute(
        df, {name: F.col(col).rlike(pattern) for name, pattern in patterns.items()}, mode
    )


def split_outcome(
    df: DataFrame, ok: Column | str, reason: Column | str
) -> dict[str, DataFrame]:
    """``success`` and ``failure``; failed rows keep their input and get a ``reason``."""
    good = _predicate(ok)
    why = F.expr(reason) if isinstance(reason, str) else reason
    return {"success": df.where(good), "failure": df.where(~good).withColumn("reason", why)}


def fan_in(frames: Sequence[DataFrame]) -> DataFrame:
    """The rows of all frames; columns that a frame lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def label_wait_notify(
    waiting: DataFrame,
    signals: DataFrame,
    key: str,
    target: int,
    count_col: str | None = None,
    name: str = "relationship",
) -> DataFrame:
    """As ``wait_notify`` with one aggregate and one join: ``signals`` and the relationship of each row."""
    # Signals are summed where they are read, so a busy key sends few rows.
    amount = F.lit(1) if count_col is None else F.col(count_col)
    sums = signals.groupBy(key).agg(F.sum(amount).cast("bigint").alias("signals"))
    held = lookup_join(waiting, sums, key).withColumn(
        "signals", F.coalesce("signals", F.lit(0))
    )
    return held.withColumn(name, F.when(F.col("signals") >= target, "released").otherwise("waiting"))


def wait_notify(
    waiting: DataFrame, signals: DataFrame, key: str, target: int, count_col: str | None = None
) -> dict[str, DataFrame]:
    """``released`` rows have signals for their key that add up to ``target``; others are ``waiting``.

    Signals are summed where they are read, so a busy key sends few rows.
    """
    held = label_wait_notify(waiting, signals, key, target, count_col, "_label")
    return {
        relationship: held.where(F.col("_label") == relationship).drop("_label")
        for relationship in ("released", "waiting")
    }


def label_wait_notify_timeout(
    waiting: DataFrame,
    signals: DataFrame,
    key: str,
    target: int,
    ttl_seconds: int,
    ts: str = "ts",
    count_col: str | None = None,
    name: str = "outcome",
) -> DataFrame:
    """Rows of ``waiting`` with ``signals``, the sum within the time-out before and after them, and their outcome.

    ``released`` if the sum reaches ``target``, else ``expired``: what ``wait_notify_stream``
    decides once all rows are in. A window is the difference of two running sums along
    the key's signals, so no row is joined with the signals of its window. Times count
    in milliseconds; a null key or time has no signals.
    """
    spark = waiting.sparkSession
    # Written once, as the numbers of the rows must not change.
    path = scratch_path(spark, "waiting")
    numbered = waiting.withColumn("_row", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    held = spark.read.schema(numbered.schema).parquet(path)
    amount = F.lit(1) if count_col is None else F.col(count_col)
    at = F.unix_millis(F.col(ts).cast("timestamp"))
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    heard = signals.where(known).select(
        F.col(key).alias("_key"), at.alias("_at"), F.lit(0).alias("_sign"), amount.cast("bigint").alias("_amount"), F.lit(None).cast("bigint").alias("_row")
    ).groupBy("_key", "_at", "_sign", "_row").agg(F.sum("_amount").alias("_amount"))
    reach = ttl_seconds * 1000
    ends = F.explode(F.array(F.struct((at - reach - 1).alias("at"), F.lit(-1).alias("sign")), F.struct((at + reach).alias("at"), F.lit(1).alias("sign"))))
    asked = held.where(known).select(F.col(key).alias("_key"), ends.alias("_end"), "_row").select(
        "_key", F.col("_end.at").alias("_at"), F.col("_end.sign").alias("_sign"), F.lit(0).cast("bigint").alias("_amount"), "_row"
    )
    # At one time the signals come before the ends of windows.
    points = heard.select(*asked.columns).union(asked).withColumn("_asks", F.col("_row").isNotNull())
    summed = running_sums(points, ["_key"], ["_at", "_asks"], "_amount", "_until").where("_asks")
    sums = summed.groupBy("_row").agg(F.sum(F.col("_sign") * F.col("_until")).alias("signals"))
    found = held.join(sums, "_row", "left").withColumn("signals", F.coalesce("signals", F.lit(0)))
    return found.withColumn(name, F.when(F.col("signals") >= target, "released").otherwise("expired")).drop("_row")


def log_attributes(
    df: DataFrame, name: str, exprs: Mapping[str, Column | str]
) -> tuple[DataFrame, Observation]:
    """Measure aggregates at a point of the flow, in the pass that runs it anyway."""
    observation = Observation(name)
    metrics = [
        (F.expr(e) if isinstance(e, str) else e).alias(metric) for metric, e in exprs.items()
    ]
    return df.observe(observation, *metrics), observation
