"""Joins against reference tables whose size is checked before they are broadcast."""

import ipaddress
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed
from ..functions import enrich
from ..functions.text import settled
from ..session import scratch_path

MAX_BROADCAST_ROWS = 500_000


def maybe_broadcast(frame: DataFrame, most_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """`frame` with a broadcast hint if it has at most `most_rows` rows, unchanged otherwise.

    Without the hint the join shuffles both sides and Spark splits skewed partitions at run time.
    """
    small = frame.limit(most_rows + 1).count() <= most_rows
    return F.broadcast(frame) if small else frame


def lookup(frame: DataFrame, dimension: DataFrame, key: str, most_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join to a dimension with one row per key."""
    return frame.join(maybe_broadcast(dimension, most_rows), key, "left")


@dataclass(frozen=True)
class Networks:
    """A longest-prefix index over addresses of both families, loaded and checked once.

    `ranges` holds (block, start, end, country) that do not overlap: a block is the first 16 bits of an IPv4 or the first 32
    of an IPv6 address, so a lookup is an equality and a comparison with the few ranges of one block. `wide` holds
    (head, country) for IPv6 networks above /16, by the first 16 bits.
    """

    ranges: DataFrame
    wide: DataFrame


def _key(address) -> str:
    return f"{address.version}{int(address):0{address.max_prefixlen // 4}x}"


def _block_bits(version: int) -> int:
    return 16 if version == 4 else 32


def _network_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block that a network touches: the part of it inside, and its length."""
    for batch in batches:
        out = []
        for text, country in zip(batch.column("network").to_pylist(), batch.column("country").to_pylist()):
            net = ipaddress.ip_network(text)
            if net.version == 6 and net.prefixlen < 16:
                first = int(net.network_address) >> 112
                out += [(f"6{h:04x}", None, None, net.prefixlen, country) for h in range(first, first + (1 << 16 - net.prefixlen))]
                continue
            bits = _block_bits(net.version)
            subnets = net.subnets(new_prefix=bits) if net.prefixlen < bits else [net]
            out += [(_key(n.network_address)[:1 + bits // 4], _key(n.network_address), _key(n.broadcast_address), net.prefixlen, country)
                    for n in subnets]
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "start", "end", "bits", "country"])


def _flat(block: pa.Table) -> pa.Table:
    """The networks of a block as ranges that do not overlap: the longest prefix wins, and what is around it stays."""
    rows = sorted(zip(*(block[c].to_pylist() for c in ("start", "bits", "end", "country"))), key=lambda r: r[:2])
    width, family = len(rows[0][0]) - 1, rows[0][0][0]

    def step(key: str, by: int) -> str:
        return f"{family}{int(key[1:], 16) + by:0{width}x}"

    out, above = [], []  # networks that hold the current place, outermost first, each with the place it is told up to

    def close(until: str | None) -> None:
        while above and (until is None or above[-1][0] < until):
            end, country, told = above.pop()
            if told <= end:
                out.append((told, end, country))
            if above:
                above[-1][2] = max(above[-1][2], step(end, 1)) if end != family + "f" * width else "~"

    for i, (start, bits, end, country) in enumerate(rows):
        if i and rows[i - 1][:2] == (start, bits) and rows[i - 1][3] != country:
            raise ValueError(f"a network has two countries: {start}/{bits}")
        close(start)
        if above and above[-1][2] < start:
            out.append((above[-1][2], step(start, -1), above[-1][1]))
        above.append([end, country, start])
    close(None)
    columns = list(zip(*out))
    return pa.table([pa.array([block["block"][0].as_py()] * len(out)), *[pa.array(c, pa.string()) for c in columns]],
                    ["block", "start", "end", "country"])


def load_networks(networks: DataFrame) -> Networks:
    """An index of (network, country), as in `192.0.2.0/24` or `2001:db8::/32`; nested networks are fine, the longest wins.

    A text that is no network, one with bits beyond its length, and a network with two countries are errors. A null country is
    a network without one.
    """
    schema = "block string, start string, end string, bits int, country string"
    parts = networks.select("network", "country").mapInArrow(_network_blocks, schema)
    parts = stored(parts, "network-blocks")
    heads = parts.filter("start is null").groupBy(F.col("block").alias("head"))
    wide = heads.agg(F.max_by("country", "bits").alias("country"))
    ranges = parts.filter("start is not null").groupBy("block").applyInArrow(_flat, "block string, start string, end string, country string")
    return Networks(bounded(ranges, "networks"), bounded(wide, "wide-networks"))


def load_ranges(ranges: DataFrame, most_rows: int = MAX_BROADCAST_ROWS) -> Networks:
    """An index of IPv4 ranges (start, end, country) by number; ranges that overlap are an error."""
    parts = maybe_broadcast(check_ranges(stored(_range_blocks(ranges), "ranges")), most_rows)
    return Networks(parts, ranges.sparkSession.createDataFrame([], "head string, country string"))


def _range_blocks(ranges: DataFrame) -> DataFrame:
    """One row per block that a range touches, with the part of it inside."""
    block = 1 << 32 - _block_bits(4)
    parts = ranges.withColumn("_block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor(F.col("end") / block))))
    inside = [F.greatest("start", F.col("_block") * block), F.least("end", F.col("_block") * block + (block - 1))]
    keys = [enrich.address_key(c.cast("bigint"), F.lit(None).cast("string")) for c in inside]
    return parts.select(F.left(keys[0], F.lit(5)).alias("block"), keys[0].alias("start"), keys[1].alias("end"), "country")


def check_ranges(ranges: DataFrame) -> DataFrame:
    """Refuse ranges that overlap: a client would get two countries. Compared block by block."""
    parts = ranges if "block" in ranges.columns else _range_blocks(ranges)
    before = F.max("end").over(Window.partitionBy("block").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    if not parts.withColumn("_before", before).filter(F.col("_before") >= F.col("start")).isEmpty():
        raise ValueError("ranges overlap")
    return ranges


def stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def bounded(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table, to be broadcast if its counted rows (some 100 bytes each) are within the bound."""
    return maybe_broadcast(stored(frame, name))


def located(frame: DataFrame, networks: Networks, address: str = "_address", geo: str = "_geo") -> DataFrame:
    """`geo` (STRUCT<country, source>) with the country of the network that holds the address, if one does.

    Two joins by equality; with an index of usual size both are broadcast, so a batch or a stream passes without a shuffle.
    """
    columns = [c for c in frame.columns if c not in (address, geo)]
    key = F.col(address)
    # Settled, or the optimizer copies what makes the address into every use of it.
    frame = frame.select(settled(*[F.col(f"`{c}`") for c in (*columns, geo, address)]))
    frame = frame.withColumns({
        "_block": F.left(key, F.when(key.startswith("4"), 5).otherwise(9)), "_head": F.when(key.startswith("6"), F.left(key, F.lit(5)))})
    ranges = networks.ranges.select(
        F.col("block").alias("_block"), F.col("start").alias("_start"), F.col("end").alias("_end"), F.struct("country").alias("_found"))
    wide = networks.wide.select(F.col("head").alias("_head"), F.struct("country").alias("_wide"))
    inside = (frame["_block"] == ranges["_block"]) & key.between(F.col("_start"), F.col("_end"))
    joined = frame.join(ranges, inside, "left").drop(ranges["_block"]).join(wide, "_head", "left")
    found = F.coalesce("_found", "_wide")
    known = F.struct(found["country"].alias("country"), F.lit("maxmind").alias("source"))
    return joined.select(*[F.col(f"`{c}`") for c in columns], F.when(found.isNotNull(), known).otherwise(F.col(geo)).alias(geo))


def with_country(
    frame: DataFrame, networks: Networks | DataFrame, client: str = "client_ip", most_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Add `geo_country` and `geo_source`, looking public addresses up. Addresses in no network stay `unresolved`.

    A frame of ranges is loaded, and checked, on each call; load it once for several.
    """
    if not isinstance(networks, Networks):
        networks = load_ranges(networks, most_rows)
    frame = located(enrich.with_geo(frame, F.col(client), "_geo", "_address"), networks)
    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if c != "_geo"],
                        F.col("_geo.country").alias("geo_country"), F.col("_geo.source").alias("geo_source"))


def country_dimension(spark) -> DataFrame:
    """Top-level domain to country, as a table of fixed size."""
    rows = [*fixed.COUNTRY_BY_TLD.items(), *[(tld, "US") for tld in fixed.US_ONLY_TLDS]]
    return spark.createDataFrame(rows, "tld string, country string")


def service_dimension(spark) -> DataFrame:
    """First path segment to service, as a table of fixed size."""
    return spark.createDataFrame(list(fixed.SERVICE_BY_SEGMENT.items()), "segment string, service_name string")


