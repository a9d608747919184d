"""BPE and token files against the public libraries, row by row."""

import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from loglens.llm import bpe, token_files
from loglens.session import staging_dir

EDGES = [None, "", " ", "\n\n", "a  b", " a \n b\t c  ", "x <|endoftext|>  y  <|endoftext|>", "it's they'll  'S",
         "a" * 900, "ab" * 700 + " " * 300 + "x", "ñ́ 中文 😀​ z", "same", "same", "\x1c\x85  q"]
SCHEMA = "doc_id bigint, text string, ids string, n_tokens int"


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(EDGES)] + [(3, "again", None, None), (None, "no id", None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(), special_tokens={})


def _digests(reference, rows):
    out = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(map(repr, out))


def test_op8_equals_the_library(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = bpe.q_op8(spark, "/root/testdata/sf0.001").collect()
    assert sorted(repr(tuple(r)) for r in got) == _digests(reference, docs)


def test_encode_edges_and_round_trip(edges, reference):
    both = bpe.decode(bpe.encode(edges, out_col="ids")).collect()
    assert len(both) == edges.count()
    for r in both:
        assert r["ids"] == reference.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
        assert "n_tokens" in r.asDict()


def test_random_texts(reference):
    random.seed(7)
    alphabet = " \n\t\r\x1c\x85 　aA1é中😀'sst.,!-​"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    memory = bpe.Memory(bpe.by_merging(bpe.Merger(bpe.pair_table(bpe.load_ranks())), P.PATTERN))
    ids, off = memory.encode(texts)
    for k, t in enumerate(texts):
        assert ids[off[k]:off[k + 1]].tolist() == reference.encode_ordinary(t)


def test_forgetting_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 3)
    memory = bpe.Memory(bpe.by_merging(bpe.Merger(bpe.pair_table(bpe.load_ranks())), P.PATTERN))
    for t in ["a b c d e f", "a b z", "e f g h"]:
        assert memory.encode([t])[0].tolist() == reference.encode_ordinary(t)


def test_unknown_ids_raise():
    with pytest.raises(ValueError):
        bpe._joined([b"a", None], [1])
    with pytest.raises(ValueError):
        bpe._joined([b"a"], [-1])


def _expected_files(rows):
    tokenizer, start, out = Tokenizer.from_file(token_files.TOKENIZER), 0, []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op7_equals_the_library(spark):
    docs = sorted(tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in token_files.q_op7(spark, "/root/testdata/sf0.001").collect())
    assert got == _expected_files(docs)


@pytest.mark.parametrize("bits", [1, 8])
def test_files_of_edges(spark, edges, bits):
    manifest = token_files.write_ids(edges, staging_dir(spark, "ids-test"), bits=bits, block=64)
    got = token_files.read_ids(manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted([r["doc_id"] for r in edges.collect()], key=lambda x: (x is not None, x or 0))
    tokenizer = Tokenizer.from_file(token_files.TOKENIZER)
    texts = sorted(repr(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in edges.collect())
    assert sorted(repr(r["ids"]) for r in got) == texts
    starts = 0
    for r in got:
        assert r["start"] == starts
        starts += r["n_tokens"]


def test_empty_table(spark, edges):
    none = edges.where("false")
    assert bpe.encode(none).count() == 0
    assert token_files.read_ids(token_files.write_ids(none, staging_dir(spark, "ids-none"))).count() == 0


@pytest.mark.parametrize("bits", [1, 8])
def test_planes_round_trip(bits):
    for ids in (np.zeros(5, "<u4"), np.array([2**32 - 1, 0, 7], "<u4"), np.arange(1000, dtype="<u4"), np.empty(0, "<u4")):
        assert (token_files.from_planes(token_files.to_planes(ids, bits), len(ids), bits) == ids).all()


def test_file_rejects_other_bytes():
    with pytest.raises(ValueError):
        token_files.Reader(io.BytesIO(b"x" * 100))


def test_runs_of_marks_encode_as_in_whole_texts():
    """Words with runs of marks go to the model piece by piece, without the library's whole encoding."""
    with open(token_files.TOKENIZER) as file:
        json = file.read()
    r = random.Random(3)
    marks = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())
    texts = [" ".join(r.choice(["word", "É", "don't", "x2", "we'll"]) + "".join(r.choice(marks) for _ in range(r.randint(0, 4))) + r.choice(["", "", "\nnext'", "\n's", "<|endoftext|>"])
                      for _ in range(30)) for _ in range(200)] + [f"a{m} b\nc{m}{m}" for m in marks]
    learn, whole = token_files._by_library(json, True)
    ids, off = bpe.Memory(learn, whole).encode(texts)
    library = Tokenizer.from_str(json)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(re.fullmatch(token_files.PLAIN, x) for x in ("berzu,$$$", "\tnd&&&", "en.\nÊanch***"))
    assert not any(re.fullmatch(token_files.PLAIN, x) for x in ("don't", "a<|endoftext|>", "a2", "a\n\nb"))
