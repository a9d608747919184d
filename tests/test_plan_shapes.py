"""The physical plans keep the properties the design relies on at scale."""

import os
import sys

import pytest

from conftest import SF_SMALL
from loglens.plans import QUERIES as Q

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plan_report import plan_text, summarize  # noqa: E402


@pytest.fixture(scope="module")
def plans(spark):
    names = [n for n in Q if not n.startswith(("stream_", "late_"))]
    return {n: plan_text(Q[n](spark, SF_SMALL)) for n in names}


def test_top_k_limits_before_the_shuffle(plans):
    for name in ("top50_by_hits", "top50_by_key", "agent_top50_keywords"):
        assert "WindowGroupLimit" in plans[name] and "Partial" in plans[name], name


def test_hits_use_hash_aggregation(plans):
    for name in ("hits_by_ip", "hits_window_3d_1d", "hits_window_30s_10s", "word_count",
                 "agent_keyword_freq"):
        s = summarize(plans[name])
        assert s["hash_agg"] >= 2 and s["sort_agg"] == 0, name


def test_filters_reach_the_scan(plans):
    assert "PushedFilters: [In(event_type" in plans["isin_filter"]


def test_broadcasts_only_on_bounded_sides(plans):
    for name in ("word_count", "hits_window_3d_1d", "top50_by_hits", "agents_of_ip", "snapshot_json"):
        assert summarize(plans[name])["broadcasts"] == 0, name


def test_python_only_in_the_udf_queries(plans):
    with_python = {n for n, p in plans.items() if summarize(p)["python"]}
    assert with_python == {"udf_predicate", "udf_partition_resource", "udaf_concat", "udaf_span", "udaf_span_nulls"}


def test_only_needed_columns_are_read(plans):
    assert "ReadSchema: struct<l_linenumber:int>" in plans["acc_sum"]
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plans["isin_filter"]
