"""License scans against exact containment in every window."""

import re

import pytest

from loglens.llm import licenses as li


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _seq(text):
    w = _words(text)
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def _brute(text):
    seq, found = _seq(text), {}
    for name, template in li.TEMPLATES:
        t = set(_seq(template))
        b = li.block_of(len(t))
        for a in range(0, len(seq), b):
            share = len(set(seq[a:a + 2 * b]) & t) / len(t)
            if 100 * share >= 80:
                found[name] = max(found.get(name, 0), share)
    return found


MIT = li.TEMPLATES[9][1]
TEXTS = [None, "", "Released", "Released under the MIT License.", "x " * 50 + "released UNDER the\nmit license y", MIT, "pre " * 37 + MIT.replace("charge", "cost") + " post" * 90,
         " ".join(t for _, t in li.TEMPLATES), "Licensed under CC BY-NC 4.0. " * 40, "Licensed under the Apache License, Version 1.1", MIT[:100], "é " * 9000 + li.TEMPLATES[5][1]]


def test_matches_equal_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None), (None, TEXTS[3], None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, matches string").repartition(3)
    got = li.scan(df).collect()
    assert len(got) == len(rows)
    assert sorted(repr((r.doc_id, {m.license: round(m.share, 9) for m in r.matches})) for r in got) == \
        sorted(repr((d, {n: round(s, 9) for n, s in sorted(_brute(t).items())})) for d, t, _ in rows)
    assert li.scan(df.where("false")).count() == 0


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: ",".join(sorted(_brute(r.text))) for r in docs.collect()}
    assert {r.doc_id: r.licenses for r in li.q_op6(spark, "/root/testdata/sf0.001").collect()} == want
    assert any(want.values())


@pytest.mark.parametrize("group", li.plan(li.TEMPLATES))
def test_bands_are_enough(group):
    for s in group["sets"]:
        j = 0.8 * len(s) / (2 * group["block"] + 0.2 * len(s))
        assert (1 - j) ** len(group["xor"]) <= li.MISS * 1.0001
        assert group["block"] >= 1.25 * len(s)
