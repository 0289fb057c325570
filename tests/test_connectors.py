"""Connector settings; brokers, registries and databases are not available to tests."""

import json

import pytest
from pyspark.sql import DataFrameWriter

from tickloom.schemas import TICKER_SCHEMA, avro_contract
from tickloom.session import configure
from tickloom.sources import topics
from tickloom.sources.decode import decode_avro


def test_topic_options(monkeypatch, spark):
    seen = []
    monkeypatch.setattr(topics, "_subscribe", lambda session, options: seen.append(options))
    topics.read_topic(spark, "b:1", "t", max_offsets=100)
    topics.read_live_topic(spark, "b:1", "t")
    assert (seen[0]["startingOffsets"], seen[0]["maxOffsetsPerTrigger"]) == ("earliest", "100")
    assert (seen[1]["startingOffsets"], seen[1]["failOnDataLoss"]) == ("latest", "false")
    assert (seen[1]["kafka.session.timeout.ms"], seen[1]["kafka.request.timeout.ms"]) == ("30000", "40000")


def test_database_sink_skips_empty_batches(monkeypatch, spark):
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties: calls.append((url, table, mode)))
    assert topics.write_jdbc(spark.range(0), "jdbc:x", "gold.t", {}) is False
    assert topics.write_jdbc(spark.range(2), "jdbc:x", "gold.t", {}) is True
    assert calls == [("jdbc:x", "gold.t", "append")]


def test_database_errors_fail_the_batch(monkeypatch, spark):
    def broken(*a, **k):
        raise OSError("down")

    monkeypatch.setattr(DataFrameWriter, "jdbc", broken)
    with pytest.raises(OSError):
        topics.write_jdbc(spark.range(1), "jdbc:x", "t", {})


def test_avro_contract():
    fields = {f["name"]: f for f in json.loads(avro_contract())["fields"]}
    assert list(fields) == TICKER_SCHEMA.names
    assert fields["symbol"] == {"name": "symbol", "type": "string"}
    assert fields["count"] == {"name": "count", "type": ["null", "long"], "default": None}


def test_avro_needs_its_package(spark):
    raw = spark.createDataFrame([], "value binary, topic string, partition int, offset long, timestamp timestamp")
    try:
        columns = decode_avro(raw).columns
    except Exception as error:
        assert "avro" in str(error).lower()
    else:
        assert "decode_ok" in columns


def test_session_settings():
    class Builder(dict):
        def config(self, name, value):
            self[name] = value
            return self

    assert configure(Builder())["spark.sql.session.timeZone"] == "UTC"
