"""Progress of running streams as rows."""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources import folders

COLUMNS = (
    "run_id string, batch bigint, at string, input_rows bigint, rows_per_second double, "
    "dropped_late bigint, source string, start_offset string, end_offset string, latest_offset string, query string"
)
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
#: Rows of progress kept in the driver before they are written; what is kept is written when a query ends, too.
KEPT = 100


class ProgressTable(StreamingQueryListener):
    """Puts one row per batch and source into a folder of JSON files, many rows to a file and without a job."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path, self._rows = spark, path, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def onQueryProgress(self, event) -> None:
        self.add([event.progress.json])

    def add(self, reports: list[str]) -> None:
        for report in reports:
            self._rows += progress_rows(json.loads(report))
        if len(self._rows) >= KEPT:
            self.flush()

    def flush(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            text = "\n".join(json.dumps(dict(zip(NAMES, row))) for row in rows)
            folders.write_new(self._spark, f"{self._path}/progress-{uuid.uuid4().hex}.json", text)


def progress_rows(progress: dict) -> list[tuple]:
    """Rows of COLUMNS from one progress report."""
    late = sum(operator.get("numRowsDroppedByWatermark", 0) for operator in progress.get("stateOperators", []))
    return [
        (
            progress["runId"], progress["batchId"], progress["timestamp"], source.get("numInputRows"),
            float(source.get("processedRowsPerSecond") or 0.0), late, source.get("description"),
            json.dumps(source.get("startOffset")), json.dumps(source.get("endOffset")),
            json.dumps(source.get("latestOffset")), progress.get("name"),
        )
        for source in progress.get("sources", [])
    ]


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COLUMNS).json(path)


def positions(progress: DataFrame) -> DataFrame:
    """ts, consumergroup, topic, partition, committed, latest: where each stream stands after each batch.

    Sources with positions by topic and partition give a row for each of them. Of others (files) the rows read
    so far are the position in one partition; what is there beyond is not known from their reports. Offsets may be texts in
    texts, as some sources report them.
    """
    kind = "map<string,map<string,bigint>>"

    def offsets(column: str):
        plain = F.try_parse_json(F.col(column))
        return F.from_json(F.coalesce(F.try_variant_get(plain, "$", "string"), F.col(column)), kind)

    rows = progress.select(
        F.col("at").cast("timestamp").alias("ts"), F.coalesce("query", "run_id").alias("consumergroup"), "run_id", "batch",
        "source", "input_rows", offsets("end_offset").alias("end"), offsets("latest_offset").alias("last"))
    # A single number is not by topic: it parses to no map, or to one without partitions.
    rows = rows.withColumn("by_topic", F.coalesce(F.exists(F.map_values("end"), lambda p: p.isNotNull()), F.lit(False)))
    topics = rows.filter("by_topic").select("ts", "consumergroup", "last", F.explode("end").alias("topic", "parts"))
    known = topics.select("ts", "consumergroup", "topic", "last", F.explode("parts").alias("number", "committed")).select(
        "ts", "consumergroup", "topic", F.col("number").cast("int").alias("partition"), "committed",
        F.try_element_at(F.try_element_at("last", F.col("topic")), F.col("number")).alias("latest"))
    so_far = Window.partitionBy("run_id", "source").orderBy("batch")
    counted = rows.filter(~F.col("by_topic")).select(
        "ts", "consumergroup", F.col("source").alias("topic"), F.lit(0).alias("partition"),
        F.sum("input_rows").over(so_far).alias("committed"), F.lit(None).cast("bigint").alias("latest"))
    return known.unionByName(counted)
