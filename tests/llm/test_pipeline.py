"""The pipeline's stages against brute force on what each one got."""

import re

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import tiktoken

import corpus_pipeline
from loglens import materialize
from loglens.llm import bpe, quality, toxicity
from loglens.llm.tables import table
from llm_brute import brute as _brute

SF = "/root/testdata/sf0.001"


def _item_windows(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return w, {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9) if w else 0)}


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "t-" + name.split()[0])
        kept.append({r.doc_id: r for r in docs.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    all_docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    model = toxicity.train(table(spark, SF, "documents").where(~toxicity.held_out("doc_id")), table(spark, SF, "labels", "doc_id", "toxic"))
    scores = toxicity.Scorer(model).rows(pa.array([r.text for r in all_docs.values()]))
    assert set(kept[0]) == {d for d, s in zip(all_docs, scores) if s < toxicity.THRESHOLD}
    judged = quality.quality(spark.createDataFrame(list(kept[0].values()), table(spark, SF, "documents").schema)).collect()
    assert set(kept[1]) == {r.doc_id for r in judged if r.kept}
    rows = sorted((d, r.text) for d, r in kept[1].items())
    assert set(kept[2]) == {int(b[0]) for b in _brute(rows, 5, 80) if b[3]}
    windows = set().union(*(_item_windows(r.text)[1] for r in table(spark, SF, "benchmark").collect()))
    sizes = {len(w) for w in windows}

    def clean(text):
        w, _ = _item_windows(text)
        return not any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    assert set(kept[3]) == {d for d, r in kept[2].items() if clean(r.text)}
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(), special_tokens={})
    assert set(kept[4]) == set(kept[3])
    for d, r in kept[4].items():
        assert r.text == all_docs[d].text and r.ids == reference.encode_ordinary(r.text) and r.n_tokens == len(r.ids)
    got = sorted(corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").collect())
    assert [tuple(r) for r in got] == sorted((d, r.n_tokens) for d, r in kept[4].items())
    assert np.isfinite(scores).all()


def test_tokens_stage_has_one_python_step_at_a_time(spark):
    rows = [(1, "one, two\n three", "en", "web", 0), (2, "", "en", "web", 0), (3, None, None, None, 0), (3, "ünï 12", "de", "web", 0)]
    out = corpus_pipeline.tokens_stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), SF)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "text"]
    assert sorted((r.doc_id, r.text, len(r.ids) == r.n_tokens) for r in out.collect()) == sorted((d, t or "", True) for d, t, *_ in rows)
