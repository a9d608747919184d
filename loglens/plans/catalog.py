"""Named queries over a data folder: ``name -> fn(spark, data_dir) -> DataFrame``.

Inputs, all derived by Spark from the shared tables so that the work grows
with them:

* lines ``L``: every line of every ``documents.text``;
* access log ``G``: one line per ``events`` row (see
  :mod:`loglens.sources.access_log`);
* agents ``D``: ``documents`` with ``doc_id`` as the client and ``text`` as
  its agent string (``source`` as the client for the agent list).

Windows of 30 s / 10 s and 20 s / 4 s are kept as the log jobs configured
them; the events are minutes apart, so 3 d / 1 d and 5 d / 1 d windows
(same length-to-slide ratios) are where counts build up.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import functions as F

from loglens.functions.numeric import floor_div
from loglens.operators import (
    access_log_rejects, agent_keywords, agents_of, concat_ordered, concat_pieces, concat_udaf,
    distinct_keywords, filter_with_partition_resource, hits_by_ip, hits_by_window,
    isin_filter, keyword_freq, leaderboard, line_lengths, longest_line, member_filter,
    min_hits, observed_total, parse_access_log, regex_filter, regex_predicate_udf,
    snapshot_json, span_udaf, tokenize, top_keywords, total_sum, tumbling_counts, word_count,
    word_count_sorted,
)
from loglens.session import staging_dir
from loglens.sources import access_log_lines, document_lines, lines_of_events, read_table, stage_text, text_lines
from loglens.streaming import (
    PANE_ROWS, batch_count_sink, closed_windows, event_stream, late_rows, latest_wins, leaderboard_sink,
    newest_push, pane_windows, push_for, read_batch_counts, read_latest, read_latest_snapshot, read_open_windows, read_pushes,
    read_window_upserts, run_available, run_to_files, snapshot_stream, text_stream, window_upsert_sink, windowed_hits,
)

# Fixed values of the test queries.
KEEP_EVENT_TYPES = ("click", "view", "purchase")   # the broadcast set
DIGITS_REGEX = r"1\d+"                              # whole-match pattern
STATE_PARTITIONS = 8                                # of the streams' window state
ONE_CLIENT = "src1"                                # the client whose agents are listed
CONCAT_CHUNK = 1000                                 # event ids per concatenated chunk
CONCAT_PIECE = 4096                                 # bytes in which the values of a piece begin
DAY = 86400


def _lines(spark, d):
    return document_lines(spark, d)


def _log(spark, d):
    return access_log_lines(spark, d)


def _parsed(spark, d):
    return parse_access_log(_log(spark, d))


def _agents(spark, d):
    return read_table(spark, d, "documents", "doc_id", "text")


def _keywords(spark, d):
    return agent_keywords(_agents(spark, d), "doc_id", "text")


def _props_k(spark, d):
    ev = read_table(spark, d, "events", "event_id", "props")
    return ev.select("event_id", F.get_json_object("props", "$.k").alias("k"))


# -- text ---------------------------------------------------------------

def q_text_scan(spark, d):
    return text_lines(spark, stage_text(_lines(spark, d), name="lines"))


def q_tokenize_lines(spark, d):
    return tokenize(_lines(spark, d), keep=("doc_id",))


def q_word_count(spark, d):
    return word_count(_lines(spark, d))


def q_word_count_sorted(spark, d):
    return word_count_sorted(_lines(spark, d))


def q_line_lengths(spark, d):
    return line_lengths(_lines(spark, d), keep=("doc_id",))


def q_longest_line(spark, d):
    return longest_line(_lines(spark, d))


# -- filters, accumulators, user functions ----------------------------------

def q_broadcast_filter(spark, d):
    ev = read_table(spark, d, "events", "event_id", "event_type")
    return member_filter(ev, "event_type", KEEP_EVENT_TYPES)


def q_isin_filter(spark, d):
    ev = read_table(spark, d, "events", "event_id", "event_type")
    return isin_filter(ev, "event_type", KEEP_EVENT_TYPES)


def q_regex_full_match(spark, d):
    return regex_filter(_props_k(spark, d), "k", DIGITS_REGEX)


def q_udf_predicate(spark, d):
    df = _props_k(spark, d)
    return df.where(regex_predicate_udf(DIGITS_REGEX)(F.col("k")))


class _Matcher:
    """A matcher holding a lock: it cannot be pickled, so it is built per task."""

    def __init__(self, regex: str):
        self.lock = threading.Lock()
        self.pattern = re.compile(regex, re.ASCII)


def _make_matcher():
    return _Matcher(DIGITS_REGEX)


def _matcher_test(matcher, s):
    with matcher.lock:
        return s.str.fullmatch(matcher.pattern)


def q_udf_partition_resource(spark, d):
    return filter_with_partition_resource(_props_k(spark, d), "k", _make_matcher, _matcher_test)


def q_acc_sum(spark, d):
    return total_sum(read_table(spark, d, "lineitem", "l_linenumber"), "l_linenumber")


def q_observe_sum(spark, d):
    return observed_total(read_table(spark, d, "lineitem", "l_linenumber"), "l_linenumber", "linenumber_sum")


def q_acc_concat(spark, d):
    ev = read_table(spark, d, "events", "event_id", "event_type")
    return concat_ordered(ev, "event_type", "event_id", chunk_width=CONCAT_CHUNK)


def q_acc_concat_pieces(spark, d):
    ev = read_table(spark, d, "events", "event_id", "event_type")
    return concat_pieces(ev, "event_type", "event_id", CONCAT_PIECE)


def q_udaf_concat(spark, d):
    ev = read_table(spark, d, "events", "event_id", "event_type")
    ev = ev.withColumn("chunk", floor_div("event_id", CONCAT_CHUNK))
    return concat_udaf(ev, "event_type", "event_id", "chunk")


def q_udaf_span(spark, d):
    ev = read_table(spark, d, "events", "event_id", "event_type")
    return span_udaf(ev, "event_id", "event_type")


def q_udaf_span_nulls(spark, d):
    # nullable 64-bit values beyond what a double holds, and a nullable 64-bit key
    ev = read_table(spark, d, "events", "event_id", "user_id")
    big = F.lit(9007199254740993).cast("bigint")
    value = F.when(F.col("event_id") % 7 != 0, big + F.col("event_id"))
    key = F.when(F.col("user_id") % 5 != 0, big + F.col("user_id"))
    return span_udaf(ev.select(key.alias("key"), value.alias("v")), "v", "key")


# -- access log ---------------------------------------------------------------

def q_parse_access_log(spark, d):
    return _parsed(spark, d).select("ip", "path", "seen", F.unix_millis("ets").alias("ets_ms"))


def q_access_log_rejects(spark, d):
    mixed = _log(spark, d).unionByName(_lines(spark, d).select("value"))
    return access_log_rejects(mixed)


def q_hits_by_ip(spark, d):
    return hits_by_ip(_parsed(spark, d))


def q_hits_min10(spark, d):
    return min_hits(hits_by_ip(_parsed(spark, d)), 10)


def q_hits_window_30s_10s(spark, d):
    return hits_by_window(_parsed(spark, d), "30 seconds", "10 seconds")


def q_hits_window_20s_4s(spark, d):
    return hits_by_window(_parsed(spark, d), "20 seconds", "4 seconds")


def q_hits_window_3d_1d(spark, d):
    return hits_by_window(_parsed(spark, d), "3 days", "1 day")


def q_hits_min5_window(spark, d):
    return min_hits(hits_by_window(_parsed(spark, d), "5 days", "1 day"), 5).orderBy(
        F.desc("hits"), F.desc("ip"))


def q_top50_by_key(spark, d):
    return leaderboard(q_hits_window_3d_1d(spark, d), 50, by="key")


def q_top50_by_hits(spark, d):
    return leaderboard(q_hits_window_3d_1d(spark, d), 50, by="hits")


def q_snapshot_json(spark, d):
    newest = _parsed(spark, d).agg(F.unix_micros(F.max("ets")).alias("newest"))
    return snapshot_json(q_top50_by_hits(spark, d), newest)


def q_tumbling_counts(spark, d):
    return tumbling_counts(read_table(spark, d, "events", "ts"), "ts", DAY)


# -- agent keywords ---------------------------------------------------------

def q_agent_keywords(spark, d):
    return _keywords(spark, d)


def q_agent_keyword_freq(spark, d):
    return keyword_freq(_keywords(spark, d))


def q_agent_distinct_keywords(spark, d):
    return distinct_keywords(_keywords(spark, d), "doc_id")


def q_agent_top50_keywords(spark, d):
    return top_keywords(_keywords(spark, d), "doc_id", 50)


def q_agents_of_ip(spark, d):
    return agents_of(read_table(spark, d, "documents", "source", "text"), "source", "text", value=ONE_CLIENT)


# -- streams (the events table, streamed in place) ------------------------------

def _stream(spark, d):
    return lines_of_events(event_stream(spark, d))


def _run(stream, sink, root, mode="update"):
    run_available(stream, sink, f"{root}/checkpoint", output_mode=mode, state_partitions=STATE_PARTITIONS)


def q_stream_hits_kafka(spark, d):
    root = staging_dir(spark, "hits-stream")
    _run(windowed_hits(_stream(spark, d), "3 days", "1 day"), window_upsert_sink(f"{root}/out"), root)
    return read_window_upserts(spark, f"{root}/out")


def q_stream_snapshot_kafka(spark, d):
    # top(50) by the address, re-sorted by hits, newest closed window pushed as JSON
    root = staging_dir(spark, "board-stream")
    _run(windowed_hits(_stream(spark, d), "3 days", "1 day"), leaderboard_sink(f"{root}/snapshots", 50, by="key"), root, "append")
    return read_latest_snapshot(spark, f"{root}/snapshots")


def q_stream_hits_socket(spark, d):
    root = staging_dir(spark, "hits-stream")
    _run(windowed_hits(_stream(spark, d), "5 days", "1 day"), window_upsert_sink(f"{root}/out", 5), root)
    return read_window_upserts(spark, f"{root}/out")


def q_late_data_dropped(spark, d):
    # The earliest line, delivered again after a restart: past the watermark.
    # The layout sorts by time, so the top-1 by the timestamp token is the oldest.
    root = staging_dir(spark, "late-stream")
    oldest = _log(spark, d).orderBy(F.substring_index("value", " ", -1)).limit(1)
    oldest.limit(0).write.text(f"{root}/late")
    lines = _stream(spark, d).unionByName(text_stream(spark, f"{root}/late"))
    stream, sink = windowed_hits(lines, "3 days", "1 day"), window_upsert_sink(f"{root}/out")
    _run(stream, sink, root)
    oldest.write.mode("append").text(f"{root}/late")
    _run(stream, sink, root)
    return read_window_upserts(spark, f"{root}/out")


def q_stream_hits_panes(spark, d):
    # closed windows from the sink, open ones from the state
    root = staging_dir(spark, "panes-stream")
    run_to_files(pane_windows(_stream(spark, d), "3 days", "1 day"), f"{root}/out", f"{root}/checkpoint", state_partitions=STATE_PARTITIONS)
    closed = closed_windows(spark.read.schema(PANE_ROWS).parquet(f"{root}/out"), "3 days")
    return closed.unionByName(read_open_windows(spark, f"{root}/checkpoint", "3 days", "1 day"))


def q_stream_late_rows(spark, d):
    # The earliest line, delivered again after a restart: given out with the windows it missed.
    root = staging_dir(spark, "late-rows")
    oldest = _log(spark, d).orderBy(F.substring_index("value", " ", -1), "value").limit(1)
    oldest.limit(0).write.text(f"{root}/late")
    stream = pane_windows(_stream(spark, d).unionByName(text_stream(spark, f"{root}/late")), "3 days", "1 day")
    for _ in range(2):
        run_to_files(stream, f"{root}/out", f"{root}/checkpoint", state_partitions=STATE_PARTITIONS)
        oldest.write.mode("append").text(f"{root}/late")
    return late_rows(spark.read.schema(PANE_ROWS).parquet(f"{root}/out"))


def q_stream_latest_event(spark, d):
    # the newest event type of each user, kept in the state and read from there
    root = staging_dir(spark, "latest-stream")
    rows = event_stream(spark, d).withColumn("at", F.unix_micros(F.col("ts").cast("string").cast("timestamp")))
    run_to_files(latest_wins(rows, "user_id", "at", "event_type"), f"{root}/out", f"{root}/checkpoint", "update", state_partitions=STATE_PARTITIONS)
    return read_latest(spark, f"{root}/checkpoint").select(F.col("key").alias("user_id"), F.col("value").alias("event_type"))


def q_stream_push_newest(spark, d):
    # the newest closed window, pushed by a timer once a second at most
    root = staging_dir(spark, "push-stream")
    _run(windowed_hits(_stream(spark, d), "3 days", "1 day"), leaderboard_sink(f"{root}/snapshots", 50, by="key"), root, "append")
    if read_latest_snapshot(spark, f"{root}/snapshots").isEmpty():
        return read_latest_snapshot(spark, f"{root}/snapshots")
    push_for(newest_push(snapshot_stream(spark, f"{root}/snapshots"), 1000), f"{root}/pushed", f"{root}/push-checkpoint", 120,
             lambda: not read_pushes(spark, f"{root}/pushed").isEmpty())
    return read_pushes(spark, f"{root}/pushed")


def q_stream_batch_counts(spark, d):
    # One file of the table per batch.
    root = staging_dir(spark, "count-stream")
    _run(event_stream(spark, d), batch_count_sink(f"{root}/out"), root, "append")
    return read_batch_counts(spark, f"{root}/out")


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items())
           if name.startswith("q_") and callable(fn)}
