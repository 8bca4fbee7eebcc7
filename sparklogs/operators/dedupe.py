"""Copies of the same event."""

from pyspark.sql import DataFrame, Window, functions as F

KEY = ["service", "timestamp", "event_id"]


def latest_copy(frame: DataFrame) -> DataFrame:
    """Of all copies of an event keep the one processed last.

    Spark keeps one row per key in every task before the shuffle, so even a key that holds a large part
    of the table costs one row per task.
    """
    ties = [F.desc_nulls_last(c) for c in ("stored_at", "ingested_at") if c in frame.columns]
    # The day follows from the time; in the key it lets day filters above reach the scan.
    key = [*KEY, *(c for c in ("event_date",) if c in frame.columns)]
    newest = Window.partitionBy(*key).orderBy(F.desc_nulls_last("processed_at"), *ties)
    return frame.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def repeated_ids(frame: DataFrame, most: int = 10) -> DataFrame:
    """Ids that occur more than once, most copies first."""
    return frame.groupBy("event_id").agg(F.count("*").alias("copies")).filter("copies > 1").orderBy(
        F.desc("copies"), "event_id").limit(most)


def duplicate_totals(frame: DataFrame) -> DataFrame:
    """Rows, distinct keys and surplus copies, from one count per key."""
    return frame.groupBy(*KEY).agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("total_rows"), F.count("*").alias("unique_rows"), (F.sum("n") - F.count("*")).alias("duplicates"),
    )
