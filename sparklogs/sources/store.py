"""The day-partitioned event table with a hot and a cold tier, each a table of committed folders."""

import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import fixed
from ..functions.text import best_effort_time
from ..operators.dedupe import latest_copy
from ..operators.sequences import storage_order
from ..schemas import PARSED_COLUMNS, PARSED_SCHEMA, TIME_COLUMNS
from . import commits

STORED_COLUMNS = [*PARSED_COLUMNS, "stored_at"]
_TIER_SCHEMA = T.StructType([
    *PARSED_SCHEMA, T.StructField("stored_at", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
])


def typed_rows(rows: DataFrame, stored_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed rows, times as ISO text or TIMESTAMP, in the table's types and column order, after the columns to keep.

    Text that is no time becomes the epoch: one bad stamp must not stop a batch.
    """
    kinds = dict(rows.dtypes)
    columns = []
    for field in PARSED_SCHEMA:
        column = F.col(field.name)
        if field.name in TIME_COLUMNS and kinds[field.name] == "string":
            column = best_effort_time(column)
        columns.append(column.cast(field.dataType).alias(field.name))
    return rows.select(*keep, *columns, stored_at.alias("stored_at"))


def _by_day(frame: DataFrame) -> DataFrame:
    """Rows in the order and the split they are written in.

    The rebalance gathers a day's rows and splits days that are large, so neither many small files nor
    one huge task results; files are sorted for row-group skipping.
    """
    return storage_order(frame.withColumn("event_date", F.to_date("timestamp")).hint("rebalance", "event_date"))


def _write_days(frame: DataFrame, path: str, batch: str, repeated: bool = False) -> None:
    """Write a batch by day; all days that the same batch wrote before are replaced in one step."""
    commits.write(_by_day(frame), path, batch, ["event_date"], repeated)


def append_hot(rows: DataFrame, root: str, stored_at: Column | None = None, batch: str | None = None, repeated: bool = False) -> None:
    """Add rows to the hot tier. Writing the same `batch` again replaces it; without a name it is new.

    A `repeated` batch, as a stream sends after a failure, has its old rows: where a compaction has merged them, they stay.
    """
    frame = typed_rows(rows, F.current_timestamp() if stored_at is None else stored_at)
    _write_days(frame, f"{root}/hot", batch or uuid.uuid4().hex, **({"repeated": True} if repeated else {}))


def read_tier(spark: SparkSession, root: str, tier: str) -> DataFrame:
    """Rows of `hot` or `cold`; an empty frame when the tier does not exist yet."""
    return commits.read(spark, f"{root}/{tier}", _TIER_SCHEMA).select(*STORED_COLUMNS, "event_date")


def read_store(spark: SparkSession, root: str, final: bool = False) -> DataFrame:
    """All tiers with column `tier`. `final` keeps only the latest copy of every event."""
    cold = read_tier(spark, root, "cold").withColumn("tier", F.lit("cold"))
    frame = cold.unionByName(read_tier(spark, root, "hot").withColumn("tier", F.lit("hot")))
    return latest_copy(frame) if final else frame


def cold_form(rows: DataFrame) -> DataFrame:
    """Cold rows keep the hash of the client, not the client."""
    return rows.withColumn("client_ip", F.lit(None).cast("string"))


def tier_of(timestamp: Column, as_of: Column, hot_days: int = fixed.HOT_DAYS) -> Column:
    """Tier a row belongs to: cold once it is older than the hot window."""
    return F.when(timestamp < as_of - F.expr(f"INTERVAL {hot_days} DAYS"), "cold").otherwise("hot")


def tiered(rows: DataFrame, as_of: Column, hot_days: int = fixed.HOT_DAYS) -> DataFrame:
    """The table as it reads after tiering: `tier` set, clients of cold rows removed."""
    frame = rows.withColumn("tier", tier_of(F.col("timestamp"), as_of, hot_days))
    return frame.withColumn("client_ip", F.when(F.col("tier") == "hot", F.col("client_ip")))


def move_to_cold(spark: SparkSession, root: str, as_of_day: str, hot_days: int = fixed.HOT_DAYS) -> list[str]:
    """Move whole days that are past the hot window to the cold tier in one job; returns the days.

    Days are written to cold first and dropped from hot after. Rows that are in cold already are not
    written again, so a run that failed half-way can simply be repeated, and late rows of a day moved
    before join it. Only the batches that were there at the start are read and dropped: one that lands in
    the day meanwhile stays hot until the next move.
    """
    limit = _day_before(as_of_day, hot_days)
    path = f"{root}/hot"
    old = [e for e in commits.entries(spark, path) if _day(commits.parts_of(e)) < limit]
    if old:
        hot = commits.read(spark, path, _TIER_SCHEMA, only=old).select(*STORED_COLUMNS, "event_date")
        copy = ["event_date", "event_id", "processed_at"]
        known = read_tier(spark, root, "cold").filter(F.col("event_date") < F.lit(limit).cast("date")).select(
            *[F.col(c).alias(f"_{c}") for c in copy])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in copy]
        rows = hot.join(known, same, "left_anti")
        _write_days(cold_form(rows).drop("event_date"), f"{root}/cold", uuid.uuid4().hex)
        commits.drop(spark, path, lambda parts: True, only=old)
    return sorted({_day(commits.parts_of(e)) for e in old})


def kept(rows: DataFrame, stream: str, as_of: Column, time: str = "timestamp") -> DataFrame:
    """Rows a stream still holds at `as_of` under its retention."""
    start = as_of - F.expr(f"INTERVAL {fixed.RETENTION_HOURS[stream]} HOURS")
    held = rows.filter(F.col(time) >= start)
    if time == "timestamp" and "event_date" in rows.columns:
        held = held.filter(F.col("event_date") >= F.to_date(start))
    return held


def drop_expired_days(spark: SparkSession, path: str, stream: str, as_of_day: str) -> list[str]:
    """Drop the days of a stream whose last moment is past its retention; without a file read or rewritten."""
    limit = _day_before(as_of_day, fixed.RETENTION_HOURS[stream] // 24)
    return sorted({_day(commits.parts_of(e)) for e in commits.drop(spark, path, lambda parts: _day(parts) < limit)})


def compact_day(spark: SparkSession, root: str, day: str) -> None:
    """Rewrite one hot day as one batch without superseded copies, in one step for readers.

    Readers that began before go on with the old files until `commits.vacuum` removes them.
    """
    path = f"{root}/hot"
    old = [e for e in commits.entries(spark, path) if _day(commits.parts_of(e)) == day]
    if old:
        rows = commits.read(spark, path, _TIER_SCHEMA, only=old)
        commits.merge(_by_day(latest_copy(rows).drop("event_date")), path, old, ["event_date"])


def days(spark: SparkSession, path: str) -> list[str]:
    """Days of a table, oldest first."""
    return sorted({_day(commits.parts_of(e)) for e in commits.entries(spark, path)})


def drop_day(spark: SparkSession, path: str, day: str) -> None:
    commits.drop(spark, path, lambda parts: _day(parts) == day)


def _day(parts: dict[str, str]) -> str:
    return parts["event_date"]


def _day_before(day: str, count: int) -> str:
    return (date.fromisoformat(day) - timedelta(days=count)).isoformat()
