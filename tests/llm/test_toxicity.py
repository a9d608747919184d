"""Toxicity: held-out accuracy, tolerance of inserted characters, kernel values, edge cases."""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from loglens.llm import toxicity as tx

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def made(spark):
    """Documents with planted insults of one stem per language and clean ones."""
    rng = np.random.default_rng(2)
    syllables = ["an", "re", "tion", "ou", "le", "st", "er", "ing", "ha", "mo", "ti", "sh"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    bad = ["idiot", "stupid", "vequ", "loweik"]
    rows = []
    for i in range(900):
        words = [word() for _ in range(rng.integers(20, 80))]
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.integers(len(words)), bad[i // 6 % 4] + (word() if i // 6 % 4 > 1 else ""))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy_and_inserted_characters(spark, made):
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in made], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in made] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    model = tx.train(docs.where(~tx.held_out("doc_id")), labels)
    out = {r.doc_id: r.score for r in tx.with_scores(docs, model).collect()}
    held = [(out[i], y) for i, _, y in made if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 150
    assert all((s >= tx.THRESHOLD) == bool(y) for s, y in held)
    score = lambda t: tx.Scorer(model).rows(pa.array([t]))[0]
    assert min(score("so i-d-i-o-t ha"), score("an i d i o t"), score("1diot")) >= tx.THRESHOLD > max(score("an hour"), score(""), score(None) if False else 0)
    kept = tx.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in out.items() if s < tx.THRESHOLD}


def test_query_shape_and_labels_unused_for_scores(spark):
    got = tx.q_op3(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got[:50]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_edges(spark):
    model = tx.fit(["an idiot here", "a fine day", "stupid idiot", "nice words now"] * 6, [1, 0, 1, 0] * 6)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "x" * 70_000), (5, "a b c d"), (5, "a b c d"), (None, "idiot"), (6, "😀 é"), (7, "a"), (8, "q w e"), (9, "x y")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id bigint, text string, __toxicity string")
    out = tx.with_scores(df, model)
    assert out.columns == df.columns + ["score"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert tx.with_scores(df.where("false"), model).count() == 0
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    flat = tx.train(df.select("doc_id", "text"), none)
    assert all(r.score < 0.01 for r in tx.with_scores(df, flat).collect())


def test_rows_do_not_depend_on_the_batch():
    model = tx.fit(["an idiot here", "a fine day"] * 8, [1, 0] * 8)
    texts = ["idiot", "b a d x", "", "o", "w e", "r t y u", "longer words thanhavequitelong"]
    together = tx.Scorer(model).rows(pa.array(texts))
    assert np.allclose(together, [tx.Scorer(model).rows(pa.array([t]))[0] for t in texts])


def test_kernel_equals_its_definition():
    def brute(a, b):
        def phi(cells):
            out = {}
            for i in range(len(cells)):
                for j in range(i + 1, len(cells)):
                    for k in range(j + 1, min(len(cells), i + tx.SPAN)):
                        if cells[i] and cells[j] and cells[k]:
                            key = (cells[i], cells[j], cells[k])
                            out[key] = out.get(key, 0) + tx.DECAY ** (k - i - 2)
            return out
        x, y = phi(a), phi(b)
        dot = lambda p, q: sum(v * q.get(c, 0) for c, v in p.items())
        return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5

    raw = np.frombuffer(b"idiot i.d.iot aaaaaa", np.uint8)
    cells, many = tx._cells(raw, np.array([0, 6, 14]), np.array([5, 13, 20]))
    assert many.tolist() == [1, 1, 1]
    dense = tx._dense(cells)
    for i in range(3):
        for j in range(3):
            assert abs(float(dense[i] @ dense[j]) - brute(cells[i].tolist(), cells[j].tolist())) < 1e-5
    w = np.random.default_rng(0).normal(size=tx.CODES)
    w[0] = 0
    assert np.allclose(tx._values(cells, w), dense @ w, atol=1e-4)


@pytest.fixture(scope="module")
def by_language():
    """{(lang, toxic): (rows predicted toxic, rows)} over the held-out labels of sf0.1, whose insults differ by language."""
    big = "/root/testdata/sf0.1"
    rows = pd.read_parquet(f"{big}/documents.parquet").merge(pd.read_parquet(f"{big}/labels.parquet"), on="doc_id")
    held = rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    known = rows[~held & rows.text.str.len().between(1, tx.SAMPLE_CHARS)].sample(frac=1, random_state=1).groupby("toxic").head(tx.SAMPLE).sort_values("doc_id")
    model = tx.fit(known.text.tolist(), known.toxic.tolist(), totals=tuple(rows[~held].toxic.value_counts().sort_index()))
    rows = rows[held].assign(found=tx.Scorer(model).rows(pa.array(rows[held].text.tolist())) >= tx.THRESHOLD)
    return {key: (int(g.found.sum()), len(g)) for key, g in rows.groupby(["lang", "toxic"])}


def test_toxic_texts_without_rare_triples_are_learned_from(by_language):
    for lang in ("es", "fr"):
        found, n = by_language[lang, 1]
        assert found >= n / 2, (lang, found, n)


def test_evidence_of_several_words_adds_up(by_language):
    # German insults begin with a stem that clean texts have as well, but once
    found, n = by_language["de", 1]
    assert found >= n / 2, (found, n)


def test_letters_of_all_scripts_are_distinct():
    u = tx.Units(pa.array(["дурак", "рукав", "Дурак", "漢字文", "文漢字"]))
    cells, _ = tx._cells(u.raw, u.start, u.end)
    dense = tx._dense(cells)
    assert np.allclose(dense[0] @ dense[2], 1)
    assert abs(dense[0] @ dense[1]) < 0.2 and dense[3] @ dense[4] < 0.7
    words = ["стол", "окно", "книга", "рукав", "карта", "вода", "город", "рука", "курад", "арукд"]
    rng = np.random.default_rng(4)
    texts = [" ".join([*rng.choice(words, 30), *(["дурак"] if i % 4 == 0 else [])]) for i in range(200)]
    model = tx.fit(texts, [int(i % 4 == 0) for i in range(200)])
    clean = " ".join(rng.choice(words, 30))
    low, high = tx.Scorer(model).rows(pa.array([clean, clean + " Дурак"]))
    assert low < tx.THRESHOLD <= high
