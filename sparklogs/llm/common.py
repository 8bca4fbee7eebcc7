"""Helpers of the training-data operators."""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path

# Fixed values of the query contracts: what separates words there.
BLANKS = " \t\n\x0b\x0c\r"
#: Tables of names and numbers (some 16 bytes a row) up to this many rows are broadcast; above it the join shuffles.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends, its size is known, executors may be lost."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def bounded(names: DataFrame) -> DataFrame:
    """A stored table of names, to be broadcast only when its counted size is within the bound."""
    return F.broadcast(names) if names.count() <= BROADCAST_ROWS else names


def free(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have in any case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def present(frame: DataFrame, name: str, kind: str) -> Column:
    """The column, or nulls where the frame lacks it."""
    return F.col(f"`{name}`") if name in frame.columns else F.lit(None).cast(kind)


def quoted(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def words(text: Column) -> Column:
    """Words between blanks as an array; null has none. No regular expression: blanks become spaces first."""
    spaced = F.translate(F.coalesce(text, F.lit("")), BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.array_remove(F.split(spaced, " ", -1), "")


def ordinals(frame: DataFrame, *order: Column, name: str = "ordinal") -> DataFrame:
    """Number the rows from 0 in the given order, without one task for all of them.

    Rows are range-partitioned and sorted; each number is the row's place in its part plus the rows of the
    parts before it. The window sees one row per partition.
    """
    part, place, before = (free(frame, n) for n in ("part", "place", "before"))
    parts = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = stored(parts.select("*", F.spark_partition_id().alias(part),
                                F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(place)), "ordinals")
    starts = parts.groupBy(part).agg(F.count("*").alias(before))
    starts = starts.select(part, (F.sum(before).over(Window.orderBy(part)) - F.col(before)).alias(before))
    return parts.join(F.broadcast(starts), part).select(
        *quoted(frame.columns), (F.col(before) + F.col(place)).alias(name))
