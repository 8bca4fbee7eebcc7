"""The network index against a search over all networks."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from sparklogs.operators import lookup, pipeline

NESTED = [
    ("8.0.0.0/7", "A"), ("8.0.0.0/8", "B"), ("8.8.0.0/16", "C"), ("8.8.8.0/24", "D"), ("8.8.8.8/32", "E"), ("8.8.8.9/32", None),
    ("8.8.9.0/24", "D"), ("8.8.255.0/24", "F"), ("9.255.255.255/32", "G"), ("130.0.0.0/13", "H"),
    ("2a00::/12", "I"), ("2a02::/15", "J"), ("2a02::/16", "K"), ("2a02:26f0::/32", "L"), ("2a02:26f0:1::/48", "M"),
    ("2a02:26f0:ffff:ffff:ffff:ffff:ffff:ffff/128", "N"), ("2600::/20", "O"), ("2001:4860:4860::8888/128", "P"),
]


def test_longest_prefix(spark):
    rng, networks = random.Random(1), [(ipaddress.ip_network(t), c) for t, c in NESTED]
    addresses = []
    for net, _ in networks:
        first, last = int(net.network_address), int(net.broadcast_address)
        kind = type(net.network_address)
        around = [first, last, first - 1, last + 1, *[rng.randrange(first, last + 1) for _ in range(6)]]
        addresses += [str(kind(a)) for a in around if 0 <= a < 1 << net.max_prefixlen]
    addresses = sorted(set(addresses)) + ["h.example.jp", "10.0.0.1", "fe80::1", "", None]

    def want(text):
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            return ("JP", "tld") if text and text.endswith(".jp") else (None, "unresolved")
        if address.is_private or address.is_loopback or address.is_link_local or address.is_reserved:
            return None, "private"
        held = [(n.prefixlen, c) for n, c in networks if address.version == n.version and address in n]
        return (max(held, key=lambda h: h[0])[1], "maxmind") if held else (None, "unresolved")

    index = lookup.load_networks(spark.createDataFrame(NESTED, "network string, country string"))
    clients = spark.createDataFrame([(a,) for a in addresses], "client_ip string")
    got = {r.client_ip: (r.geo_country, r.geo_source) for r in lookup.with_country(clients, index).collect()}
    assert got == {a: want(a) for a in addresses}
    # Without a broadcast the answers are the same.
    plain = lookup.Networks(spark.createDataFrame(index.ranges.collect(), index.ranges.schema), spark.createDataFrame(index.wide.collect(), index.wide.schema))
    assert {r.client_ip: (r.geo_country, r.geo_source) for r in lookup.with_country(clients, plain).collect()} == got


@pytest.mark.parametrize("rows", [[("8.8.8.1/24", "A")], [("8.8.8.0/24", "A"), ("8.8.8.0/24", "B")], [("here", "A")]])
def test_bad_networks_are_refused(spark, rows):
    with pytest.raises(Exception):
        lookup.load_networks(spark.createDataFrame(rows, "network string, country string"))


def test_the_chain_locates_without_a_shuffle(spark):
    index = lookup.load_networks(spark.createDataFrame(NESTED, "network string, country string"))
    raw = spark.range(3).select(
        F.concat(F.lit("event-000"), "id").alias("event_id"), F.lit("2026-01-01T00:00:00Z").alias("ingested_at"), F.lit("h").alias("host"),
        F.lit("s").alias("service"), F.lit("nginx_combined").alias("source_format"),
        F.concat(F.element_at(F.array(*[F.lit(c) for c in ("8.8.8.8", "2A02:26f0:1::7", "10.1.1.1")]), (F.col("id") + 1).cast("int")),
                 F.lit(' - - [30/Jul/2026:18:40:01 +0000] "GET /a HTTP/1.0" 200 10')).alias("raw_message"))
    rows = pipeline.process(raw, F.lit("2026-08-01").cast("timestamp"), pipeline.Options(salt="s", networks=index))
    assert [(r.geo_country, r.geo_source) for r in rows.orderBy("event_id").collect()] == [("E", "maxmind"), ("M", "maxmind"), (None, "private")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
