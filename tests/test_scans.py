"""Running values and quantiles over range partitions, with keys and seconds that hold nearly everything."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sparklogs.operators import reports, sequences

START = datetime.datetime(2026, 1, 1)


def hot_rows(n=4000):
    """One key with 90 % of the rows in one second; null keys and values, zeros, small keys."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.9
        second = 7 if hot else rng.randrange(3600)
        key = "hot" if hot else rng.choice(["a", "b", None])
        rows.append((f"e{i:05d}", key, START + datetime.timedelta(seconds=second), rng.choice([None, 0, *range(1, 40)])))
    return rows


SCHEMA = "event_id string, service string, timestamp timestamp, response_time_ms long"


@pytest.mark.parametrize("parts", ["8", "64"])
def test_rolling_mean_of_a_hot_second(spark, parts):
    rows, n = hot_rows(), 50
    want, seen = {}, {}
    for event, key, moment, value in sorted(rows, key=lambda r: (r[2], r[0])):
        if value:
            window = seen.setdefault(key, [])
            window.append(value)
            want[event] = statistics.fmean(window[-n:])
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(rows, SCHEMA)
        got = {r.event_id: r.rolling_mean for r in sequences.rolling_mean(frame, ["service"], rows=n).collect()}
        assert got == {e: pytest.approx(v) for e, v in want.items()}
        # The hot second is in many parts, none of which holds much of it.
        order = ["service", "timestamp", "event_id"]
        sizes = [r.n for r in sequences._ranged(frame, order).filter("service = 'hot'").groupBy("_part").agg(F.count("*").alias("n")).collect()]
        assert len(sizes) > int(parts) / 2 and max(sizes) < 3 * 4000 / int(parts) + 50
        ranks = {r.event_id: r._rank for r in sequences.with_rank(frame, ["service"], "timestamp", "event_id").collect()}
        by_key = {}
        for event, key, moment, _ in sorted(rows, key=lambda r: (r[2], r[0])):
            by_key[key] = by_key.get(key, 0) + 1
            assert ranks[event] == by_key[key]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("values", [
    [None], [5], [1, 2], [3] * 1000 + [None] * 9, [random.Random(1).randrange(-50, 10 ** 6) for _ in range(2001)], list(range(100)) * 7 + [10 ** 9],
])
def test_exact_quantiles(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    shares = {"a": 0.0, "b": 0.5, "c": 0.95, "d": 0.999, "e": 1.0}
    got = sequences.exact_quantiles(frame, "v", shares, F.sum("v")).first()
    want = frame.agg(F.percentile("v", F.array(*[F.lit(s) for s in shares.values()])).alias("q"), F.sum("v").alias("s")).first()
    assert [got[n] for n in shares] == ([None] * 5 if want.q is None else pytest.approx(want.q))
    assert got.rows == len(values) and got._sum0 == want.s


def test_tiles_of_nothing(spark):
    frame = spark.createDataFrame([], SCHEMA + ", is_error boolean, stored_at timestamp, ingested_at timestamp")
    assert tuple(reports.stat_tiles(frame).first()) == (0, 0.0, None, 0)
    assert tuple(reports.ingest_latency(frame).first()) == (0, None, None, None, None)
