"""Operators on rows in order, split so that no key has to fit into one task."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed
from ..session import scratch_path


def _ranged(frame: DataFrame, order: list[str]) -> DataFrame:
    """The rows range-partitioned by the order, with their part as `_part`; written, so that the parts stay what they are."""
    path = scratch_path(frame.sparkSession, "ranged")
    frame.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def _borders(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _part, _before) for the parts that a key comes into from earlier ones: at most one a part."""
    counts = parts.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keys, "_part", F.sum("_n").over(earlier).alias("_before")).filter("_before is not null")


def _ranked(parts: DataFrame, borders: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    numbered = parts.withColumn("_n", F.row_number().over(inside))
    joined = numbered.join(F.broadcast(borders), _same(numbered, borders, [*keys, "_part"]), "left")
    rank = (F.coalesce(borders["_before"], F.lit(0)) + numbered["_n"]).cast("bigint")
    return joined.select(*[numbered[c] for c in parts.columns], rank.alias(out))


def with_rank(frame: DataFrame, keys: list[str], time: str, tie: str, slice_size: str | None = None, out: str = "_rank") -> DataFrame:
    """Exact 1-based rank by (time, tie) within `keys`.

    Rows are range-partitioned by key, time and tie, so a key of any size, or a second that holds most of it, is
    cut into parts; a row's rank is its place in its part plus the rows of its key in earlier ones. `slice_size` is not
    needed for that and not looked at.
    """
    parts = _ranged(frame, [*keys, time, tie])
    return _ranked(parts, _borders(parts, keys), keys, [time, tie], out).drop("_part")


def rolling_mean(
    frame: DataFrame, keys: list[str], value: str = "response_time_ms", time: str = "timestamp", tie: str = "event_id",
    rows: int = fixed.ROLLING_RESPONSES, slice_size: str | None = None, block: int | None = None, out: str = "rolling_mean",
) -> DataFrame:
    """Mean of the last `rows` non-zero values per key, at every row that has one.

    The parts are those of `with_rank`. What a key's first rows in a part look back to is in earlier parts: it is found by rank
    and joins the part for the frame only. No task sees more than a part and `rows` more; `slice_size` and `block` are
    not looked at.
    """
    kept = frame.filter(F.col(value).isNotNull() & (F.col(value) != 0))
    parts = _ranged(kept, [*keys, time, tie])
    borders = _borders(parts, keys)
    ranked = _ranked(parts, borders, keys, [time, tie], "_rank")
    # Ranks (_before - rows + 1, _before] lie in two blocks of `rows` ranks.
    last = F.floor(F.col("_before") / rows)
    wanted = borders.select(*keys, F.col("_part").alias("_to"), "_before", F.explode(F.array(last - 1, last)).alias("_block"))
    own = ranked.withColumn("_block", F.floor(F.col("_rank") / rows))
    lent = own.join(F.broadcast(wanted), _same(own, wanted, [*keys, "_block"])
                    & (own["_rank"] > wanted["_before"] - (rows - 1)) & (own["_rank"] <= wanted["_before"]))
    lent = lent.select(*[wanted["_to"].alias(c) if c == "_part" else own[c] for c in ranked.columns], F.lit(True).alias("_lent"))
    over = Window.partitionBy(*keys, "_part").orderBy("_rank").rowsBetween(-(rows - 1), 0)
    every = ranked.withColumn("_lent", F.lit(False)).unionByName(lent).withColumn(out, F.avg(value).over(over))
    return every.filter("not _lent").drop("_rank", "_part", "_lent")


def exact_quantiles(frame: DataFrame, value: str, shares: dict[str, float], *sums: Column) -> DataFrame:
    """One row: each named quantile of the column (linear between neighbours, null without values), and sums over all rows.

    Counts per distinct value are summed in tasks; the counts are range-partitioned by value, and their running
    sums go from part to part. No task holds the values of more than its part.
    """
    names = [f"_sum{i}" for i in range(len(sums))]
    counts = frame.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"), *[c.alias(n) for c, n in zip(sums, names)])
    parts = _ranged(counts, ["_value"])
    known = F.sum(F.when(F.col("_value").isNotNull(), F.col("_n")).otherwise(0))
    totals = parts.groupBy("_part").agg(known.alias("_in"))
    # One row a part.
    totals = totals.select("_part", (F.sum("_in").over(Window.orderBy("_part")) - F.col("_in")).alias("_before"),
                           F.sum("_in").over(Window.partitionBy()).alias("_all"))
    running = Window.partitionBy("_part").orderBy(F.col("_value").asc_nulls_last())
    placed = parts.join(F.broadcast(totals), "_part").withColumn("_end", F.col("_before") + F.sum("_n").over(running))

    def at(index: Column) -> Column:
        """The value whose run of equal ones holds the index."""
        inside = F.col("_value").isNotNull() & (index >= F.col("_end") - F.col("_n")) & (index < F.col("_end"))
        return F.max(F.when(inside, F.col("_value").cast("double")))

    place = {name: (F.col("_all") - 1) * F.lit(share) for name, share in shares.items()}
    found = placed.agg(
        *[at(F.floor(p)).alias(f"_low_{n}") for n, p in place.items()], *[at(F.ceil(p)).alias(f"_high_{n}") for n, p in place.items()],
        *[F.max(p - F.floor(p)).alias(f"_part_{n}") for n, p in place.items()], *[F.sum(n).alias(n) for n in names], F.sum("_n").alias("rows"))
    between = [(F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * F.col(f"_part_{n}")).alias(n) for n in shares]
    return found.select(F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), *between, *names)


def rate_capped(
    frame: DataFrame, per_second: int = fixed.LIVE_EVENTS_PER_SECOND, time: str = "timestamp", tie: str = "event_id",
) -> DataFrame:
    """The first `per_second` rows of every second. A fixed budget per second, not a token bucket."""
    first = Window.partitionBy(F.date_trunc("second", F.col(time))).orderBy(time, tie)
    return frame.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= per_second).drop("_n")


def sampled_out(frame: DataFrame, per_second: int = fixed.LIVE_EVENTS_PER_SECOND, time: str = "timestamp") -> DataFrame:
    """Kept and dropped rows of every second under the cap."""
    counts = frame.groupBy(F.date_trunc("second", F.col(time)).alias("second")).agg(F.count("*").alias("n"))
    kept = F.least("n", F.lit(per_second).cast("bigint"))
    return counts.select("second", kept.alias("kept"), (F.col("n") - kept).alias("sampled_out"))


def newest_n(frame: DataFrame, keys: list[str], n: int = fixed.LIVE_QUEUE, time: str = "timestamp", tie: str = "event_id") -> DataFrame:
    """The newest `n` rows per key. Every task keeps at most `n` per key before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(time), F.desc(tie))
    return frame.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= n).drop("_n")


def in_service_order(frame: DataFrame, *more: str) -> DataFrame:
    """Rows of a service in time order. Range partitions cut a large service by time instead of sending
    it to one task; partition numbers follow the order."""
    order = ["service", *more, "timestamp", "event_id"]
    return frame.repartitionByRange(*order).sortWithinPartitions(*order)


def storage_order(frame: DataFrame) -> DataFrame:
    """Rows as the store writes them, within whatever parts they are in."""
    return frame.sortWithinPartitions("event_date", "service", "timestamp", "event_id")


def out_of_order(frame: DataFrame, unit: str, order: list[str], keys: list[str]) -> DataFrame:
    """Rows per key, units (files, partitions) that hold some, and rows that come before their predecessor in a unit.

    `frame` is read or computed in the order that is asked about; a unit is what one task reads or makes.
    """
    placed = frame.withColumn("_at", F.monotonically_increasing_id())
    before = Window.partitionBy(unit, *keys).orderBy("_at")
    own = F.struct(*order)
    checked = placed.withColumn("_late", F.coalesce(F.lag(own).over(before) > own, F.lit(False)))
    return checked.groupBy(*keys).agg(F.count("*").alias("rows"), F.count_distinct(unit).alias("units"), F.count_if("_late").alias("out_of_order"))


def interval_key(time: Column, seconds: int) -> Column:
    """End of the interval (end - seconds, end] that holds `time`, in epoch seconds."""
    return (F.ceil(F.unix_micros(time) / (seconds * 1_000_000)) * seconds).cast("bigint")
