"""What must not be lost or kept when work is repeated."""

from pyspark.sql import Row, functions as F

from sparklogs.operators import wiki
from sparklogs.schemas import CHANGE_SCHEMA
from sparklogs.sources import kafka, sinks


def test_a_repeated_batch_replaces_all_its_routes(spark, tmp_path):
    def batch(route):
        columns = [F.lit(None).cast("string").alias(c) if c != "route" else F.lit(route).alias(c) for c in sinks._COMBINED]
        return spark.range(1).select(*columns)

    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    sinks.write_routes(batch("dlq"), str(tmp_path / "routes"))
    sinks.write_routes(batch("parsed"), str(tmp_path / "routes"))
    assert [r.route for r in spark.read.parquet(str(tmp_path / "routes")).collect()] == ["parsed"]


def test_an_empty_server_name_falls_through_to_the_domain(spark):
    rows = [Row(server_name="", meta=Row(uri=None, dt="2024-01-01T00:00:00Z", id=None, domain="d.example")),
            Row(server_name="", meta=Row(uri=None, dt="2024-01-01T00:00:00Z", id=None, domain=""))]
    full = [[getattr(r, f.name, None) if f.name in ("server_name", "meta") else None for f in CHANGE_SCHEMA] for r in rows]
    reasons = spark.createDataFrame(full, CHANGE_SCHEMA).select(wiki.skip_reason().alias("r")).collect()
    assert [r.r for r in reasons] == [None, "unmappable"]


def test_credentials_are_escaped():
    env = {"KAFKA_SECURITY_PROTOCOL": "SASL_SSL", "KAFKA_SASL_USERNAME": 'a"b', "KAFKA_SASL_PASSWORD": "c\\d"}
    config = kafka.security_options(env)["kafka.sasl.jaas.config"]
    assert 'username="a\\"b"' in config and 'password="c\\\\d"' in config
    assert kafka.source_options("t", "s")["failOnDataLoss"] == "true"
