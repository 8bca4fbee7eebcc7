"""Counters, histograms, rates, consumer lag and run totals over sample tables."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from .sequences import interval_key

LABELS = "labels"


def _series_key() -> Column:
    """Labels as ordered text: maps cannot be grouped."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(LABELS))))


def counters_by(frame: DataFrame, *labels: str) -> DataFrame:
    return frame.groupBy(*labels).agg(F.count("*").alias("n"))


def failures_by_stage(dead: DataFrame) -> DataFrame:
    return counters_by(dead, "error_stage")


def failures_over_time(dead: DataFrame, interval: str) -> DataFrame:
    return dead.groupBy(F.window("failed_at", interval).alias("_w"), "error_stage").agg(F.count("*").alias("n")).select(
        F.col("_w.start").alias("time"), "error_stage", "n")


def run_totals(routed: DataFrame) -> DataFrame:
    """Records consumed, parsed, copied to errors and dead-lettered, and the dead-letter ratio: one row."""
    def is_route(name: str) -> Column:
        return F.count_if(F.col("route") == name)

    return routed.agg(
        is_route("parsed").alias("parsed"), is_route("errors").alias("errors"), is_route("dlq").alias("dlq"),
    ).select(
        (F.col("parsed") + F.col("dlq")).alias("consumed"), "parsed", "errors", "dlq",
        F.round(F.try_divide("dlq", F.col("parsed") + F.col("dlq")), 6).alias("dlq_ratio"),
    )


def observed(processed: DataFrame, name: str = "run_totals") -> tuple[DataFrame, Observation]:
    """The output of `pipeline.process` and counters that the job which reads it fills as it goes.

    On a stream the counters of each batch are in its progress report, under the name.
    """
    observation, fine = Observation(name), F.col("_stage").isNull()
    return processed.observe(
        observation, F.count_if(fine).alias("parsed"), F.count_if(fine & F.col("is_error")).alias("errors"),
        F.count_if(~fine).alias("dlq")), observation


def observed_totals(spark: SparkSession, counters: dict[str, int]) -> DataFrame:
    """The row of `run_totals` from the counters of a job that has ended: nothing is read again."""
    parsed, errors, dlq = (int(counters[n]) for n in ("parsed", "errors", "dlq"))
    row = spark.createDataFrame([(parsed + dlq, parsed, errors, dlq)], "consumed bigint, parsed bigint, errors bigint, dlq bigint")
    return row.withColumn("dlq_ratio", F.round(F.try_divide("dlq", "consumed"), 6))


def watched(messages: DataFrame, name: str = "messages") -> tuple[DataFrame, Observation]:
    """Strictly typed topic rows (see kafka.parse_rows, `skipped`) without the broken ones, and counters of what went by.

    `unknown` counts rows with members that the record type does not have: they are taken, but somebody should know.
    """
    observation = Observation(name)
    counted = messages.observe(
        observation, F.count("*").alias("messages"), F.count_if("_broken").alias("broken"), F.count_if(F.col("_unknown") > 0).alias("unknown"))
    return counted.filter(~F.col("_broken")).drop("_broken", "_rescued", "_unknown"), observation


def histogram(frame: DataFrame, value: Column | str, bounds: list[float], *keys: str) -> DataFrame:
    """Cumulative buckets per key in one pass: rows (keys.., le, count), and the sum and count of values.

    `le` is null for the last, unbounded bucket.
    """
    value = F.col(value) if isinstance(value, str) else value
    frame = frame.select(*keys, value.alias("_v")).filter(F.col("_v").isNotNull())
    sums = [F.count_if(F.col("_v") <= bound).alias(f"_b{i}") for i, bound in enumerate(bounds)]
    wide = frame.groupBy(*keys).agg(*sums, F.count("*").alias("total_count"), F.sum("_v").alias("total_sum"))
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("count")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("total_count").alias("count")))
    return wide.select(*keys, F.explode(F.array(*rows)).alias("_r"), "total_count", "total_sum").select(
        *keys, "_r.le", "_r.count", "total_count", "total_sum")


def histogram_quantile(buckets: DataFrame, q: float, *keys: str, count: str = "count") -> DataFrame:
    """Quantile per key from cumulative buckets, interpolated inside the bucket it falls into.

    In the unbounded bucket the answer is the highest finite bound. A key has one row per bound, so the
    window per key is small whatever the data.
    """
    keyless = [F.lit(0)] if not keys else list(keys)
    by_bound = Window.partitionBy(*keyless).orderBy(F.asc_nulls_last("le"))
    everything = Window.partitionBy(*keyless)
    frame = buckets.withColumns({
        "_total": F.max(count).over(everything),
        "_low": F.coalesce(F.lag("le").over(by_bound), F.lit(0.0)),
        "_below": F.coalesce(F.lag(count).over(by_bound), F.lit(0)).cast("double"),
    })
    rank = F.lit(q) * F.col("_total")
    hit = frame.filter((F.col(count) >= rank) & (F.col("_total") > 0) & ((F.col("_below") < rank) | (F.col("_below") == 0)))
    inside = F.when(F.col("le").isNull(), F.col("_low")).otherwise(
        F.col("_low") + (F.col("le") - F.col("_low")) * (rank - F.col("_below")) / (F.col(count) - F.col("_below")))
    found = hit.select(*keys, F.coalesce("le", F.lit(float("inf"))).alias("_le"), inside.alias("_value"))
    return found.groupBy(*keys).agg(F.min_by("_value", "_le").alias("quantile"))


def counter_increase(samples: DataFrame, window_seconds: int, *labels: str) -> DataFrame:
    """Increase of every series per window; a step down counts from zero, as after a restart.

    Steps are taken inside (series, window) groups; the step between two windows is joined on from one
    row per group, so no task sees the whole life of a series.
    """
    frame = samples.select(
        F.col("metric"), _series_key().alias("_series"), LABELS, "ts", "value",
        interval_key(F.col("ts"), window_seconds).alias("_end"),
    )
    group = ["metric", "_series", "_end"]
    before = F.lag("value").over(Window.partitionBy(*group).orderBy("ts"))
    steps = frame.withColumn("_before", before)
    step = F.when(F.col("value") < F.col("_before"), F.col("value")).otherwise(F.col("value") - F.col("_before"))
    per_window = steps.groupBy(*group).agg(
        F.coalesce(F.sum(step), F.lit(0.0)).alias("_inner"),
        F.min_by("value", "ts").alias("_first"), F.max_by("value", "ts").alias("_last"),
        F.any_value(LABELS).alias(LABELS),
    )
    last = F.lag("_last").over(Window.partitionBy("metric", "_series").orderBy("_end"))
    joined = per_window.withColumn("_previous", last)
    jump = F.when(F.col("_first") < F.col("_previous"), F.col("_first")).otherwise(
        F.coalesce(F.col("_first") - F.col("_previous"), F.lit(0.0)))
    return joined.select(
        "metric", *[F.col(LABELS)[name].alias(name) for name in labels],
        F.timestamp_seconds("_end").alias("window_end"), (F.col("_inner") + jump).alias("increase"),
    )


def counter_rate(samples: DataFrame, window_seconds: int, *labels: str) -> DataFrame:
    """Per-second rate per window, summed by labels. No extrapolation to the window's edges."""
    grown = counter_increase(samples, window_seconds, *labels)
    return grown.groupBy("metric", *labels, "window_end").agg(
        (F.sum("increase") / window_seconds).alias("rate"))


def label_matches(frame: DataFrame, label: Column | str, pattern: str, exclude: bool = False) -> DataFrame:
    """Rows whose label fits the whole pattern, or does not."""
    fits = (F.col(label) if isinstance(label, str) else label).rlike(f"^(?:{pattern})$")
    return frame.filter(~fits if exclude else fits)


def latest_by(samples: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """Latest value of every series."""
    return samples.groupBy(*keys).agg(*[F.max_by(v, "ts").alias(v) for v in values])


def gauge_sum(samples: DataFrame, *labels: str) -> DataFrame:
    """Sum of the latest gauge values by label."""
    frame = samples.select("ts", "value", LABELS, "metric", _series_key().alias("_series"))
    latest = frame.groupBy("metric", "_series").agg(
        F.max_by("value", "ts").alias("value"), F.any_value(LABELS).alias(LABELS))
    return latest.groupBy("metric", *[F.col(LABELS)[name].alias(name) for name in labels]).agg(F.sum("value").alias("value"))


_PARTITION = ["consumergroup", "topic", "partition"]


def positions_as_of(committed: DataFrame, latest: DataFrame) -> DataFrame:
    """Offset rows (see OFFSET_SCHEMA) at every moment either side reported, each with the other side's last known value.

    `committed` has ts, consumergroup, topic, partition, committed; `latest` ts, topic, partition, latest. A group meets the
    reports of the partitions it has a position in; the rows of a partition are bounded by the clock, not by traffic.
    """
    keys = ["consumergroup", "topic", "partition"]
    groups = committed.select(*keys).distinct()
    theirs = latest.join(groups, ["topic", "partition"]).select(
        "ts", *keys, F.lit(None).cast("bigint").alias("committed"), F.col("latest").cast("bigint"))
    ours = committed.select("ts", *keys, F.col("committed").cast("bigint"), F.lit(None).cast("bigint").alias("latest"))
    moments = ours.unionByName(theirs).groupBy("ts", *keys).agg(F.max("committed").alias("committed"), F.max("latest").alias("latest"))
    so_far = Window.partitionBy(*keys).orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = [F.last(c, ignorenulls=True).over(so_far).alias(c) for c in ("committed", "latest")]
    return moments.select("ts", *keys, *filled).filter("committed is not null and latest is not null")


def consumer_lag(offsets: DataFrame, groups: DataFrame) -> DataFrame:
    """Lag of each listed group now. A group without samples has an unknown lag: null, never 0."""
    latest = latest_by(offsets, _PARTITION, "committed", "latest")
    lags = latest.groupBy("consumergroup").agg(F.sum(F.col("latest") - F.col("committed")).alias("lag"))
    return groups.join(lags, "consumergroup", "left")


def lag_over_time(offsets: DataFrame, seconds: int) -> DataFrame:
    """Lag per group and interval, from the last sample of each partition in it."""
    frame = offsets.withColumn("_end", interval_key(F.col("ts"), seconds))
    last = frame.groupBy(*_PARTITION, "_end").agg(
        F.max_by(F.col("latest") - F.col("committed"), "ts").alias("_lag"))
    return last.groupBy("consumergroup", F.timestamp_seconds("_end").alias("ts")).agg(F.sum("_lag").alias("lag"))


def burst_report(lags: DataFrame, burst_end: Column, limit_seconds: int = 60) -> DataFrame:
    """Per group: highest lag, and seconds from the end of the burst until the lag is gone."""
    drained = F.when((F.col("lag") <= 0) & (F.col("ts") >= burst_end), F.col("ts"))
    report = lags.groupBy("consumergroup").agg(F.max("lag").alias("peak_lag"), F.min(drained).alias("_at"))
    seconds = F.unix_seconds("_at") - F.unix_seconds(burst_end)
    return report.select(
        "consumergroup", "peak_lag", seconds.alias("drain_seconds"),
        F.coalesce(seconds < limit_seconds, F.lit(False)).alias("passed"))


def throughput(rows: DataFrame, interval: str = "2 seconds", time: str = "timestamp", failed: str = "failed") -> DataFrame:
    """Events, failures, events per second and success share per interval."""
    window = F.window(time, interval)
    seconds = F.unix_seconds("_w.end") - F.unix_seconds("_w.start")
    return rows.groupBy(window.alias("_w")).agg(
        F.count("*").alias("events"), F.count_if(failed).alias("failures")
    ).select(
        F.col("_w.start").alias("time"), "events", "failures",
        F.round(F.col("events") / seconds, 1).alias("per_second"),
        F.round(100 * (F.col("events") - F.col("failures")) / F.col("events")).cast("bigint").alias("success_pct"),
    )


def tier_report(stored: DataFrame) -> DataFrame:
    """Rows and time span per day and tier."""
    return stored.groupBy("event_date", "tier").agg(
        F.count("*").alias("rows"), F.min("timestamp").alias("min_time"), F.max("timestamp").alias("max_time"))


def rows_per_stream(**streams: DataFrame) -> DataFrame:
    """Row count of each named table."""
    counts = [f.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stream"), "rows") for name, f in streams.items()]
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.unionByName(more)
    return whole


def peek(frame: DataFrame, n: int, time: str | None = None) -> DataFrame:
    """The first `n` rows as they come, or the last `n` by time."""
    return frame.limit(n) if time is None else frame.orderBy(F.desc(time)).limit(n)
