import pytest
from pyspark.sql.utils import ParseException

from millpulse.session import DEFAULTS, object_store_conf, versioned_catalog_conf
from millpulse.sinks.messages import kafka_sink_options
from millpulse.sources.messages import kafka_options
from millpulse.sources.tables import branch_query
from millpulse.workspace import scratch_path


def test_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    for key in DEFAULTS:
        assert spark.conf.get(key) == DEFAULTS[key]


def test_kafka_source_options():
    assert kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "false", "kafka.security.protocol": "PLAINTEXT",
    }
    bounded = kafka_options("h:1", "t", max_offsets_per_trigger=10, min_partitions=6, groupIdPrefix="g")
    assert (bounded["maxOffsetsPerTrigger"], bounded["minPartitions"], bounded["groupIdPrefix"]) == (
        "10", "6", "g")


def test_kafka_sink_options():
    assert kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_catalog_settings_are_all_arguments():
    conf = versioned_catalog_conf("lake", "http://host/api", "s3a://bucket/x", "dev", options={"a.b": "c"})
    assert conf["spark.sql.catalog.lake.ref"] == "dev"
    assert conf["spark.sql.catalog.lake.uri"] == "http://host/api"
    assert conf["spark.sql.catalog.lake.warehouse"] == "s3a://bucket/x"
    assert conf["spark.sql.catalog.lake.a.b"] == "c"


def test_object_store_settings_hold_no_default_keys():
    assert not any("key" in k for k in object_store_conf("http://host"))
    assert object_store_conf("http://host", "a", "b")["spark.hadoop.fs.s3a.secret.key"] == "b"


def test_branch_query_parses(spark):
    text = branch_query("lake.db.t", "it's")
    assert text == "SELECT * FROM lake.db.t VERSION AS OF 'it''s'"
    try:
        spark.sql(text)
    except ParseException as error:  # the catalog may be missing, the syntax may not
        pytest.fail(str(error))
    except Exception:
        pass


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    paths = {scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3 and all(p.startswith(base + "/x-") for p in paths)


