"""Sources: parquet tables, text files, in-memory rows, access-log lines, Kafka options."""

from loglens.sources.tables import read_table
from loglens.sources.text import text_lines, document_lines, inline, stage_text
from loglens.sources.access_log import access_log_lines, ip_of_user, lines_of_events
from loglens.sources.kafka import (
    load_properties, kafka_source_options, kafka_sink_options, read_kafka_stream, write_kafka,
    write_kafka_stream,
)

__all__ = [
    "read_table", "text_lines", "document_lines", "inline", "stage_text",
    "access_log_lines", "ip_of_user", "lines_of_events",
    "load_properties", "kafka_source_options", "kafka_sink_options",
    "read_kafka_stream", "write_kafka", "write_kafka_stream",
]
