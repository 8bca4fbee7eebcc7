"""Alert rules: a value per evaluation, a threshold, a hold time, a state."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed
from .reports import time_filter
from .sequences import interval_key

STEP = fixed.EVALUATE_SECONDS


def trailing(panes: DataFrame, window_seconds: int, step: int = STEP, out: str = "eval_s") -> DataFrame:
    """Repeat each pane at every evaluation whose trailing window holds it.

    `panes` are aggregates over (end - step, end] in column `pane`. Only these few rows are repeated,
    never the events behind them.
    """
    last = F.col("pane") + (window_seconds - step)
    return panes.withColumn(out, F.explode(F.sequence(F.col("pane"), last, F.lit(step).cast("bigint"))))


def error_rate_evaluations(frame: DataFrame, rule: dict = fixed.ERROR_RATE_RULE) -> DataFrame:
    """Error share per service over the trailing window at every evaluation, where enough rows exist."""
    panes = frame.groupBy("service", interval_key(F.col("timestamp"), STEP).alias("pane")).agg(
        F.count("*").alias("_rows"), F.count_if("is_error").alias("_errors"))
    summed = trailing(panes, rule["window_seconds"]).groupBy("service", "eval_s").agg(
        F.sum("_rows").alias("requests"), F.sum("_errors").alias("errors"))
    return summed.filter(F.col("requests") >= rule["min_rows"]).select(
        F.lit(rule["rule"]).alias("rule"), "service", "eval_s",
        F.round(100 * F.col("errors").cast("double") / F.col("requests"), 3).alias("value"),
    )


def error_rate_now(frame: DataFrame, as_of: Column, rule: dict = fixed.ERROR_RATE_RULE) -> DataFrame:
    """The error-rate rule's input at one moment."""
    start = as_of - F.expr(f"INTERVAL {rule['window_seconds']} SECONDS")
    recent = time_filter(frame, start, as_of)
    return recent.groupBy("service").agg(
        F.round(100 * F.count_if("is_error").cast("double") / F.count("*"), 3).alias("error_rate"),
        F.count("*").alias("requests"),
    ).filter(F.col("requests") >= rule["min_rows"])


def visible_groups(offsets: DataFrame) -> DataFrame:
    """Offset rows of the groups that are not internal."""
    return offsets.filter(~F.col("consumergroup").rlike("^_confluent") & ~F.col("consumergroup").startswith("_internal"))


def lag_evaluations(offsets: DataFrame, rule: dict = fixed.LAG_RULE) -> DataFrame:
    """Lag per visible consumer group at every evaluation: last known value of each partition."""
    visible = visible_groups(offsets)
    keys = ["consumergroup", "topic", "partition"]
    panes = visible.groupBy(*keys, interval_key(F.col("ts"), STEP).alias("pane")).agg(
        F.max_by(F.col("latest") - F.col("committed"), "ts").alias("_lag"))
    known = trailing(panes, rule["window_seconds"]).groupBy(*keys, "eval_s").agg(F.max_by("_lag", "pane").alias("_lag"))
    return known.groupBy("consumergroup", "eval_s").agg(F.sum("_lag").cast("double").alias("value")).select(
        F.lit(rule["rule"]).alias("rule"), F.col("consumergroup").alias("service"), "eval_s", "value")


def dlq_evaluations(dead: DataFrame, time: str = "failed_at", rule: dict = fixed.DLQ_RULE) -> DataFrame:
    """Dead letters per second over the trailing window at every evaluation."""
    panes = dead.groupBy(interval_key(F.col(time), STEP).alias("pane")).agg(F.count("*").alias("_n"))
    summed = trailing(panes, rule["window_seconds"]).groupBy("eval_s").agg(F.sum("_n").alias("_n"))
    return summed.select(
        F.lit(rule["rule"]).alias("rule"), F.lit("all").alias("service"), "eval_s",
        (F.col("_n") / rule["window_seconds"]).alias("value"))


def alert_states(evaluations: DataFrame, rule: dict, step: int = STEP) -> DataFrame:
    """Normal, Pending or Firing at every evaluation.

    Pending starts with the first breach and turns into Firing once it has held for the rule's time. A
    missing evaluation ends it. Consecutive breaches share (evaluation number - rank): that difference
    names their run. Rows per rule and service are bounded by the clock, not by traffic.
    """
    keys = ["rule", "service"]
    breached = F.col("value") > rule["threshold"]
    number = F.floor(F.col("eval_s") / step)
    bad = evaluations.filter(breached).withColumn(
        "_run", number - F.row_number().over(Window.partitionBy(*keys).orderBy("eval_s")))
    since = F.min("eval_s").over(Window.partitionBy(*keys, "_run"))
    held = F.col("eval_s") - since
    state = F.when(held >= rule["hold_seconds"], "Firing").otherwise("Pending")
    loud = bad.select(*keys, "eval_s", "value", held.alias("held_seconds"), state.alias("state"))
    quiet = evaluations.filter(~breached).select(
        *keys, "eval_s", "value", F.lit(0).cast("bigint").alias("held_seconds"), F.lit("Normal").alias("state"))
    return loud.unionByName(quiet).withColumn("eval_ts", F.timestamp_seconds("eval_s"))


def with_silence(states: DataFrame, step: int = STEP) -> DataFrame:
    """The states plus, after a Pending or Firing one that no evaluation follows, the missing evaluation as Normal."""
    after = F.lead("eval_s").over(Window.partitionBy("rule", "service").orderBy("eval_s"))
    gaps = states.withColumn("_next", after).filter((F.col("state") != "Normal") & ~F.coalesce(F.col("_next") == F.col("eval_s") + step, F.lit(False)))
    ended = gaps.select("rule", "service", (F.col("eval_s") + step).alias("eval_s"), F.lit(None).cast("double").alias("value"),
                        F.lit(0).cast("bigint").alias("held_seconds"), F.lit("Normal").alias("state"))
    return states.unionByName(ended.withColumn("eval_ts", F.timestamp_seconds("eval_s")))


def state_changes(states: DataFrame, step: int = STEP) -> DataFrame:
    """The evaluations at which an instance's state is another than before; one that starts, or comes back, was Normal."""
    before = Window.partitionBy("rule", "service").orderBy("eval_s")
    follows = F.lag("eval_s").over(before) == F.col("eval_s") - step
    last = F.coalesce(F.when(follows, F.lag("state").over(before)), F.lit("Normal"))
    return states.withColumn("_last", last).filter(F.col("state") != F.col("_last")).drop("_last")
