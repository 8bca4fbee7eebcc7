"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

`parse_rows_per_second` is the parse, enrich, redact and validate chain over every log line of the
tables, batch, without a broker: it is not like for like with a figure measured through one.
"""

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from sparklogs.operators import pipeline  # noqa: E402
from sparklogs.plans import catalog, fixtures  # noqa: E402
from sparklogs.session import build_session, scratch_path  # noqa: E402

QUERIES = [
    "flagship", "process_events", "parse_json_app", "decode_validate_dlq", "envelope_ids", "geo_range_join", "scrub_text",
    "service_metrics_1m", "minute_service", "service_health", "ingest_latency", "p95_ts", "recent_errors", "dedupe_final",
    "loss_recon", "rolling_mean", "counter_rate", "hist_quantile", "alert_state", "wiki_map", "hot_roundtrip",
    "service_metrics_1m_stream", "stream_parse",
]
# Run once unmeasured: a new JVM first has to compile the parser.
WARM_UP = ["flagship", "parse_json_app"]
CHAIN_COPIES = 10


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        run(catalog.QUERIES[name](spark, sf_dir))
    seconds = {}
    for name in QUERIES:
        started = time.perf_counter()
        run(catalog.QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)

    # The chain on its own: lines lie in Parquet, every row goes through all stages.
    lines = scratch_path(spark, "bench-lines")
    copies = F.explode(F.sequence(F.lit(1), F.lit(CHAIN_COPIES)))
    source = fixtures.table(spark, sf_dir, "events").select("*", copies.alias("_copy")).repartition(int(cpus) * 4)
    fixtures.raw_json_from(source).select("value").write.parquet(lines)
    stamp = F.lit(fixtures.AS_OF).cast("timestamp")
    raw = spark.read.parquet(lines)
    rows = raw.count()
    chain = pipeline.process(pipeline.decode(raw), stamp, fixtures.OPTIONS)
    run(chain.limit(10_000))
    started = time.perf_counter()
    run(chain)
    chain_seconds = time.perf_counter() - started
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"), "parse_rows": rows, "parse_seconds": round(chain_seconds, 3),
        "parse_rows_per_second": round(rows / chain_seconds),
        "warm_up": WARM_UP, "parse_note": "envelopes decoded and processed, batch over Parquet, no broker; the reference's figure includes broker reads and writes",
    }))


if __name__ == "__main__":
    main()
