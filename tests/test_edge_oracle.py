"""Registered queries on tables with hand-written edge rows (FIXTURES §2-3),
against their DuckDB twins: trailing and only-space lines, a character
outside the BMP, empty and NULL texts, events with NULL parts."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import TABLES, compare, duck_connection

EDGE_DOCS = """
  SELECT * FROM read_parquet('{src}/documents.parquet')
  UNION ALL SELECT 900001, NULL, 'en', 'src1', 0
  UNION ALL SELECT 900002, '', 'en', 'src2', 0
  UNION ALL SELECT 900003, 'a b  c  ' || chr(10) || '   ' || chr(10) || ' a😀 Mozilla/5.0 (X11; Linux)',
                   'en', NULL, 0"""

EDGE_EVENTS = """
  SELECT * FROM read_parquet('{src}/events.parquet')
  UNION ALL SELECT 900001, TIMESTAMP '2024-01-02 03:04:05.678', NULL, 'click', 1.0, '{{"k": 12}}'
  UNION ALL SELECT 900002, TIMESTAMP '2024-01-02 03:04:06.001', 7, NULL, 1.0, '{{"k": 13}}'
  UNION ALL SELECT 900003, NULL, 8, 'view', 1.0, NULL"""

NAMES = ["text_scan", "tokenize_lines", "word_count", "line_lengths", "longest_line",
         "agent_keywords", "agent_top50_keywords", "agents_of_ip", "access_log_rejects",
         "parse_access_log", "hits_by_ip", "hits_window_3d_1d", "top50_by_hits",
         "regex_full_match", "acc_concat", "tumbling_counts"]


@pytest.fixture(scope="module")
def edge_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("edge")
    con = duckdb.connect()
    for t in TABLES:
        if t == "documents":
            con.execute(f"COPY ({EDGE_DOCS.format(src=SF_SMALL)}) TO '{d}/{t}.parquet' (FORMAT parquet)")
        elif t == "events":
            con.execute(f"COPY ({EDGE_EVENTS.format(src=SF_SMALL)}) TO '{d}/{t}.parquet' (FORMAT parquet)")
        else:
            os.symlink(f"{SF_SMALL}/{t}.parquet", f"{d}/{t}.parquet")
    return str(d)


@pytest.mark.parametrize("name", NAMES)
def test_edge_rows_match_oracle(spark, edge_dir, name):
    ok, msg = compare(entry.queries()[name](spark, edge_dir), duck_connection(edge_dir),
                      entry.oracle_sql()[name])
    assert ok, msg
