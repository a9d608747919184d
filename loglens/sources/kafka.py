"""Kafka as a source and a sink, configured from Java-style property files.

The Kafka connector jar is not part of a plain PySpark install; these
helpers only build the reader / writer, Spark reports a missing connector
when the query starts.  The option mapping is pure Python and tested alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Consumer / producer keys that Spark's Kafka source and sink set
# themselves (dropped here), and those that would change records (refused).
_DROPPED = ("key.deserializer", "value.deserializer", "key.serializer", "value.serializer", "enable.auto.commit")
_REFUSED = ("interceptor.classes",)
_OFFSETS = ("earliest", "latest")
_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "f": "\f"}


def _logical_lines(text: str):
    """Lines without comments and blank ones, joined where one ends in an odd number of backslashes."""
    kept = ""
    for raw in text.splitlines():
        line = raw.lstrip(" \t\f")
        if not kept and (not line or line[0] in "#!"):
            continue
        ends = len(line) - len(line.rstrip("\\"))
        if ends % 2:
            kept += line[:-1]
            continue
        yield kept + line
        kept = ""
    if kept:
        yield kept


def _unescape(text: str) -> str:
    def one(m: re.Match) -> str:
        return chr(int(m[1], 16)) if m[1] else _ESCAPES.get(m[2], m[2])
    return re.sub(r"\\(?:u([0-9a-fA-F]{4})|(.))", one, text)


def load_properties(path: str) -> dict[str, str]:
    """Read a Java property file; a missing file gives ``{}``.

    A key ends at the first ``=``, ``:`` or white space that is not escaped;
    a backslash at a line's end continues it; later keys win.
    """
    try:
        with open(path, encoding="latin-1") as fh:
            text = fh.read()
    except FileNotFoundError:
        return {}
    props: dict[str, str] = {}
    for line in _logical_lines(text):
        m = re.match(r"((?:\\.|[^\\=: \t\f])*)[ \t\f]*[=:]?[ \t\f]*(.*)", line, re.S)
        props[_unescape(m[1])] = _unescape(m[2])
    return props


def _plain(props: dict[str, str]) -> dict[str, str]:
    """Client keys with their Spark prefix, without those that Spark sets; raises for those it cannot honour."""
    for key in _REFUSED:
        if key in props:
            raise ValueError(f"Spark does not accept the Kafka property {key!r}")
    return {f"kafka.{k}": v for k, v in props.items() if k not in (*_DROPPED, "topic", "topics", "auto.offset.reset")}


def _topics(value: str) -> list[str]:
    return [t.strip() for t in value.split(",") if t.strip()]


def kafka_source_options(props: dict[str, str]) -> dict[str, str]:
    """Map consumer properties to ``readStream.format("kafka")`` options.

    ``topics`` (or ``topic``) becomes ``subscribe``; ``auto.offset.reset``
    becomes ``startingOffsets`` and must be ``earliest`` or ``latest``; what
    Spark sets itself is dropped; every other key is passed to the consumer
    with the ``kafka.`` prefix.  Raises when no topic is named, since the
    stream would read nothing, and for properties that Spark does not accept.
    """
    topics = [t for key in ("topics", "topic") for t in _topics(props.get(key, ""))]
    if not topics:
        raise ValueError("no Kafka topic given (property 'topics')")
    opts = {**_plain(props), "subscribe": ",".join(topics)}
    reset = props.get("auto.offset.reset")
    if reset is not None:
        if reset not in _OFFSETS:
            raise ValueError(f"auto.offset.reset must be one of {_OFFSETS}, not {reset!r}")
        opts["startingOffsets"] = reset
    return opts


def kafka_sink_options(props: dict[str, str], topic: str | None = None) -> dict[str, str]:
    """Map producer properties to ``write.format("kafka")`` options."""
    named = [t for key in ("topic", "topics") for t in _topics(props.get(key, ""))]
    topic = topic or (named[0] if named else None)
    if not topic:
        raise ValueError("no Kafka topic given (property 'topic')")
    return {**_plain(props), "topic": topic}


def read_kafka_stream(spark: SparkSession, props: dict[str, str]) -> DataFrame:
    """Streaming ``key, value`` strings plus Kafka's own metadata columns."""
    raw = spark.readStream.format("kafka").options(**kafka_source_options(props)).load()
    return raw.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                          "topic", "partition", "offset", "timestamp")


def write_kafka(df: DataFrame, props: dict[str, str], topic: str | None = None,
                column: str = "value") -> None:
    """Write one string column as Kafka record values (batch)."""
    (df.selectExpr(f"CAST({column} AS STRING) AS value")
       .write.format("kafka").options(**kafka_sink_options(props, topic)).save())


def write_kafka_stream(df: DataFrame, props: dict[str, str], checkpoint: str,
                       topic: str | None = None, column: str = "value",
                       processing_time: str | None = None):
    """Continuously write one string column of a stream as Kafka record values.

    The checkpoint makes the sink restartable; Kafka writes are at least
    once, so consumers should de-duplicate on a key if they need exactly once.
    """
    writer = (df.selectExpr(f"CAST({column} AS STRING) AS value")
                .writeStream.format("kafka").options(**kafka_sink_options(props, topic))
                .option("checkpointLocation", checkpoint))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
