"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

Words are runs of ASCII letters and digits and non-ASCII characters, with A-Z
lower-cased.  An item's windows are its runs of ``window`` words; an item of
fewer words, but not none, is one window.  Because a window must be contained
whole, its necessary prefix is one token: its rarest, by the number of times
the benchmark's words occur in all documents.  A document word equal to a
window's prefix token makes a candidate; the token's position in the window
and the text's bounds fix where the window would begin and end, the words'
hashes are compared one by one, and then the bytes.

Nulls: a null text has no words; windows of an item whose id is null hit words
but no item is named.  Repeated rows of documents each get a row; repeated
items count once.  Empty tables give empty results or no hits.  A very long text is
one row's work for one task, in slices of bounded memory.  Columns other than those named
have no influence, but for helpers' names, which begin with ``__``.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.tables import Staged, table
from loglens.llm.text import ALNUM, Words, chunks, lists

WINDOW = 10
#: Distinct windows that are joined at a time: the bound of what is broadcast.
BLOCK_WINDOWS = 500_000


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(words, items): each distinct window, words joined by a space, with the ids it belongs to."""

    def cut(batches):
        for batch in chunks(batches):
            w, ids = Words(batch.column("text"), ALNUM), batch.column("id").to_pylist()
            out = []
            for d, item in enumerate(ids):
                own = [w.word(i) for i in range(w.first[d], w.first[d + 1])]
                for i in range(max(1, len(own) - window + 1) if own else 0):
                    out.append((b" ".join(own[i:i + window]), item))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["words", "item"])

    cols = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(cut, "words binary, item string").groupBy("words").agg(F.collect_set("item").alias("items"))


class Index:
    """The windows of one block, by their rarest word."""

    def __init__(self, windows: list[tuple[bytes, list[str]]], rarity: dict[int, int]):
        self.items = [tuple(x[1]) for x in windows]
        w = Words(pa.array([bytes(x[0]) for x in windows], pa.binary()), ALNUM, lower=False)
        self.raw, self.start, self.size = w.raw, w.start, w.end - w.start
        self.first, self.length = w.first[:-1], w.counts
        self.hash = w.hash
        token = np.empty(len(windows), np.uint64)
        offset = np.empty(len(windows), np.int64)
        for k, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
            own = w.hash[a:b]
            offset[k] = min(range(b - a), key=lambda i: (rarity.get(int(own[i]), 0), int(own[i])))
            token[k] = own[offset[k]]
        self.order = np.argsort(token, kind="stable")
        self.offset = offset
        self.token, self.begin = np.unique(token[self.order], return_index=True)
        self.begin = np.append(self.begin, len(windows))
        self.seen = np.zeros(1 << 18, bool)
        self.seen[self.token & np.uint64((1 << 18) - 1)] = True

    def matches(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, first word, window) of every occurrence."""
        at = np.flatnonzero(self.seen[w.hash & np.uint64((1 << 18) - 1)])
        slot = np.minimum(np.searchsorted(self.token, w.hash[at]), len(self.token) - 1)
        ok = self.token[slot] == w.hash[at]
        at, slot = at[ok], slot[ok]
        many = self.begin[slot + 1] - self.begin[slot]
        flat = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        win = self.order[np.repeat(self.begin[slot], many) + flat]
        at = np.repeat(at, many)
        row = np.searchsorted(w.first, at, "right") - 1
        begin = at - self.offset[win]
        ok = (begin >= w.first[row]) & (begin + self.length[win] <= w.first[row + 1])
        row, begin, win = row[ok], begin[ok], win[ok]
        for k in range(int(self.length.max(initial=0))):
            here = k < self.length[win]
            ok = ~here
            ok[here] = w.hash[begin[here] + k] == self.hash[self.first[win[here]] + k]
            row, begin, win = row[ok], begin[ok], win[ok]
        for k in range(int(self.length.max(initial=0))):  # the words' bytes
            here = np.flatnonzero(k < self.length[win])
            i, j = begin[here] + k, self.first[win[here]] + k
            size = self.size[j]
            ok = np.ones(len(win), bool)
            ok[here] = w.end[i] - w.start[i] == size
            ok_here = ok[here]
            i, j, size, here = i[ok_here], j[ok_here], size[ok_here], here[ok_here]
            flat = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            same = w.raw[np.repeat(w.start[i], size) + flat] == self.raw[np.repeat(self.start[j], size) + flat]
            bad = np.add.reduceat(~same, np.cumsum(size) - size) if len(size) else np.empty(0, int)
            ok[here[bad > 0]] = False
            row, begin, win = row[ok], begin[ok], win[ok]
        return row, begin, win


def _rarity(docs: DataFrame, vocabulary) -> DataFrame:
    """(token, n): how often each word of the vocabulary occurs in all documents."""

    def count(batches):
        vocab = vocabulary.value
        total = np.zeros(len(vocab), np.int64)
        for batch in chunks(batches):
            h = Words(batch.column("text"), ALNUM).hash
            at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
            total += np.bincount(at[vocab[at] == h], minlength=len(vocab))
        yield pa.RecordBatch.from_arrays([pa.array(vocab.view(np.int64)), pa.array(total)], ["token", "n"])

    return docs.select("text").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


_SCAN = {"__n_words": "bigint", "__from": "array<int>", "__to": "array<int>", "__items": "array<string>"}


def _spans(docs: DataFrame, index, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of docs with the word count, hit spans and items for one block's windows."""
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), *(f"{c} {t}" for c, t in _SCAN.items())])

    def scan(batches):
        ix = index.value
        for batch in chunks(batches, text_col):
            w = Words(batch.column(text_col), ALNUM)
            row, begin, win = ix.matches(w)
            order = np.lexsort((begin, row))
            row, begin, win = row[order], begin[order], win[order]
            end = begin + ix.length[win]
            # Word positions do not overlap between rows: one running maximum serves all rows.
            new = np.ones(len(row), bool)
            if len(row):
                new[1:] = (begin[1:] > np.maximum.accumulate(end)[:-1]) | (row[1:] != row[:-1])
            a = np.flatnonzero(new)
            top = np.maximum.reduceat(end, a) if len(a) else end
            srow = row[a]
            off = np.searchsorted(srow, np.arange(batch.num_rows + 1))
            shift = w.first[srow]
            items = defaultdict(set)
            for r, k in set(zip(row.tolist(), win.tolist())):
                items[r].update(ix.items[k])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), pa.array(w.counts, pa.int64()), lists(begin[a] - shift, off, pa.int32()), lists(top - shift, off, pa.int32()),
                 pa.array([sorted(items.get(r, ())) for r in range(batch.num_rows)], pa.list_(pa.string()))],
                [*keep, *_SCAN])

    return docs.mapInArrow(scan, schema)


def _indexes(docs: DataFrame, items: DataFrame, window: int, block_windows: int):
    """Broadcast indexes of blocks of about ``block_windows`` windows; one at least, maybe empty."""
    sc = docs.sparkSession.sparkContext
    windows = Staged(item_windows(items, window), "windows")
    blocks = max(1, -(-windows.df.count() // block_windows))
    for k in range(blocks):
        part = [(r[0], r[1]) for r in windows.df.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k).collect()]
        hashes = np.unique(Words(pa.array([bytes(x[0]) for x in part], pa.binary()), ALNUM, lower=False).hash)
        counted = {}
        if len(hashes):
            counted = {int(np.uint64(r[0] & (2**64 - 1))): r[1] for r in _rarity(docs, sc.broadcast(hashes)).collect()}
        yield sc.broadcast(Index(part, counted))
    windows.drop()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, n_words, spans, items) for every document row: merged hit spans of words and the items found.

    Windows come in blocks of about ``block_windows``, so what is broadcast
    stays bounded however large the benchmark is; with more than one block the
    spans of the blocks are gathered per document.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    indexes = list(_indexes(own, items, window, block_windows))
    keyed = own.withColumn("__key", F.xxhash64("text"))
    out = _spans(keyed, indexes[0], ["doc_id", "__key"])
    if len(indexes) > 1:
        for index in indexes[1:]:
            out = out.unionByName(_spans(keyed, index, ["doc_id", "__key"]))
        out = out.groupBy("doc_id", "__key").agg(
            F.max("__n_words").alias("__n_words"), (F.count("*") / len(indexes)).cast("int").alias("__rows"),
            *(F.flatten(F.collect_list(c)).alias(c) for c in ("__from", "__to", "__items")))
        out = out.withColumn("__row", F.explode(F.sequence(F.lit(1), "__rows")))
    spans = F.array_sort(F.arrays_zip(F.col("__from").alias("a"), F.col("__to").alias("b")))
    return out.select("doc_id", F.col("__n_words").alias("n_words"), spans.alias("spans"), F.array_sort(F.array_distinct("__items")).alias("items"))


def _covered(spans):
    """Words inside the spans, which are sorted and may overlap."""
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(spans, zero, lambda acc, s: F.struct(
        F.greatest(acc["to"], s["b"]).alias("to"),
        (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["to"], s["a"]))).alias("n")), lambda acc: acc["n"])


def q_op10(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    hit = _covered(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text",
                      block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents in which no item's window occurs, with all their columns and without a shuffle."""
    own = docs.select(F.col(text_col).alias("text"))
    for index in list(_indexes(own, items, window, block_windows)):
        docs = _spans(docs, index, docs.columns, text_col).where(F.size("__from") == 0).drop(*_SCAN)
    return docs


ORACLE_OP10 = r"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x{00}-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x{00}-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS p FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, sizes WHERE len(w) >= n)),
m AS (SELECT dg.rid, dg.n, dg.p, win.item_id FROM dg JOIN win USING (n, g)),
hit AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT rid, n, p FROM m)) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM m WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
