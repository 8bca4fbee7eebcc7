"""Was anything lost, kept twice or left behind?"""

from pyspark.sql import Column, DataFrame, functions as F

from .pipeline import Options, decode, parsed_rows, process, route


def lost_records(acknowledged: DataFrame, readable: DataFrame, keys: list[str]) -> DataFrame:
    """Acknowledged keys that cannot be read back, once each.

    Both sides are reduced to distinct keys before they meet, so repeated reads of one record do not
    pile up in one task; the join reuses the partitioning of that step.
    """
    return acknowledged.select(*keys).distinct().join(readable.select(*keys).distinct(), keys, "left_anti")


def loss_report(acknowledged: DataFrame, readable: DataFrame, keys: list[str]) -> DataFrame:
    """Acknowledged and lost records per leading key."""
    sent = acknowledged.select(*keys).distinct()
    seen = readable.select(*keys).distinct().withColumn("_seen", F.lit(True))
    return sent.join(seen, keys, "left").groupBy(keys[0]).agg(
        F.count("*").alias("acknowledged"), F.count_if(F.col("_seen").isNull()).alias("lost"))


def conservation(raw: DataFrame, routed: DataFrame) -> DataFrame:
    """One row: raw records against parsed plus dead-lettered ones. Each side is only counted."""
    totals = routed.agg(
        F.count_if(F.col("route") == "parsed").alias("parsed"), F.count_if(F.col("route") == "dlq").alias("dead_lettered"))
    consumed = raw.agg(F.count("*")).scalar()
    return totals.select(
        consumed.alias("consumed"), "parsed", "dead_lettered",
        (consumed == F.col("parsed") + F.col("dead_lettered")).alias("balanced"))


def replay(dead: DataFrame, stored: DataFrame, as_of: Column, options: Options) -> DataFrame:
    """Parsed rows from dead letters under today's parsers, without those stored already."""
    again = route(process(decode(dead.select(F.col("original").alias("value"))), as_of, options))
    return parsed_rows(again).join(stored.select("event_id"), "event_id", "left_anti")


def errors_not_parsed(errors: DataFrame, parsed: DataFrame) -> DataFrame:
    """Error copies without their parsed row. There must be none."""
    return errors.join(parsed.select("event_id"), "event_id", "left_anti")


def errors_also_parsed(errors: DataFrame, parsed: DataFrame) -> DataFrame:
    return errors.join(parsed.select("event_id"), "event_id", "left_semi")


def error_trace(errors: DataFrame, parsed: DataFrame) -> DataFrame:
    """One row: error copies, those with a parsed row and those without; each side is looked at once."""
    known = parsed.select("event_id").distinct().withColumn("_known", F.lit(True))
    marked = errors.select("event_id").join(known, "event_id", "left")
    return marked.agg(F.count("*").alias("error_copies"), F.count_if(F.col("_known").isNotNull()).alias("also_parsed"),
                      F.count_if(F.col("_known").isNull()).alias("orphans"))
