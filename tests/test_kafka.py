"""Property files and the mapping of client properties to Spark options, one rule a case."""

import pytest

from loglens.sources.kafka import kafka_sink_options, kafka_source_options, load_properties

BROKER = {"bootstrap.servers": "b:1"}


@pytest.mark.parametrize("text, want", [
    ("a=1\nb = 2 \n", {"a": "1", "b": "2 "}),
    ("a:b=c", {"a": "b=c"}),
    ("url: http://x?y=z", {"url": "http://x?y=z"}),
    ("key value with spaces", {"key": "value with spaces"}),
    ("k=one,\\\n    two", {"k": "one,two"}),
    ("k=ends\\\\\nnext=1", {"k": "ends\\", "next": "1"}),
    ("# c\n! c\n\n  k=v", {"k": "v"}),
    ("a\\=b\\:c=\\u0041\\t.", {"a=b:c": "A\t."}),
    ("lonely", {"lonely": ""}),
    ("k=1\nk=2", {"k": "2"}),
])
def test_property_files(tmp_path, text, want):
    p = tmp_path / "f.properties"
    p.write_text(text)
    assert load_properties(str(p)) == want


def test_missing_file_is_empty_and_names_no_topic(tmp_path):
    assert load_properties(str(tmp_path / "none")) == {}
    with pytest.raises(ValueError, match="topic"):
        kafka_source_options({})


@pytest.mark.parametrize("props, want", [
    ({"topics": "x"}, {"subscribe": "x"}),
    ({"topics": " x , y,"}, {"subscribe": "x,y"}),
    ({"topic": "x", "auto.offset.reset": "earliest"}, {"subscribe": "x", "startingOffsets": "earliest"}),
    ({"topic": "x", "fetch.min.bytes": "7"}, {"subscribe": "x", "kafka.fetch.min.bytes": "7"}),
    ({"topic": "x", "key.deserializer": "K", "value.deserializer": "V", "enable.auto.commit": "true"}, {"subscribe": "x"}),
])
def test_source_rules(props, want):
    assert kafka_source_options({**BROKER, **props}) == {"kafka.bootstrap.servers": "b:1", **want}


@pytest.mark.parametrize("props", [{"auto.offset.reset": "none"}, {"interceptor.classes": "I"}])
def test_source_refuses(props):
    with pytest.raises(ValueError):
        kafka_source_options({"topic": "x", **props})


@pytest.mark.parametrize("props, topic, want", [
    ({"topic": "x"}, None, {"topic": "x"}),
    ({"topic": "x"}, "y", {"topic": "y"}),
    ({"topic": "x", "key.serializer": "K", "value.serializer": "V"}, None, {"topic": "x"}),
    ({"topic": "x", "acks": "all"}, None, {"topic": "x", "kafka.acks": "all"}),
])
def test_sink_rules(props, topic, want):
    assert kafka_sink_options(props, topic) == want


def test_sink_needs_a_topic():
    with pytest.raises(ValueError, match="topic"):
        kafka_sink_options(BROKER)


def _has_connector(spark):
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def test_reader_without_the_connector_fails_at_once(spark):
    from loglens.sources.kafka import read_kafka_stream
    if _has_connector(spark):
        pytest.skip("the connector is installed; a broker would be needed")
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_stream(spark, {**BROKER, "topics": "t"})
