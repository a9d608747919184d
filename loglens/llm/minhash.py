"""Near-duplicate groups by min-max hashing.

Words are runs of characters outside ASCII white space, A-Z lower-cased; a
document's set is its distinct ``width``-word shingles (with fewer words: the
whole sequence as one).  Under each of ``permutations`` hash permutations both
the smallest and the largest value of the set are kept: two documents agree on
either with probability equal to their Jaccard similarity, so half as many
hash evaluations give an unbiased signature of twice as many values, whose
variance is lower as the two are negatively correlated.  The values are cut into
bands.  Sets that are equal form one class first (a 128-bit digest of the
whole set); classes that share a band are compared on their whole sets.

Candidates are verified on their whole sets by :mod:`loglens.llm.linking`, which
loses no link between them and never makes all pairs of a bucket.

Nulls, empty texts and texts without words have no set and no links.  Rows
with a null id take no part: their component is null and they are kept.
Repeated rows of an id each get a row; an id with different texts has each
row judged by its own text.  An empty table gives no rows.  A very long text is one
row's work for one task, in slices of bounded memory but for its set.  Columns
other than the two named in the calls have no influence; ``drop_near_duplicates``
keeps them, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm import linking
from loglens.llm.tables import Staged, bounded_batches, table
from loglens.llm.text import U, Words, chunks, lists, mix, shingles, stream

WIDTH = 5
SIMILARITY = 80        # per cent
BANDS, ROWS = 30, 5    # 150 values of 75 permutations: a link of similarity 0.8 is missed with 7e-6


def _extremes(flat: np.ndarray, off: np.ndarray, permutations: int) -> np.ndarray:
    """(rows, 2 * permutations): minima, then maxima; rows without a set have zeros."""
    full = np.flatnonzero(np.diff(off))
    out = np.zeros((len(off) - 1, 2 * permutations), U)
    if len(full):
        at = off[:-1][full]
        for k, (xor, mul) in enumerate(zip(stream(11, permutations), stream(12, permutations) | U(1))):
            x = (flat ^ xor) * mul
            x ^= x >> U(32)
            out[full, k] = np.minimum.reduceat(x, at)
            out[full, permutations + k] = np.maximum.reduceat(x, at)
    return out


def _bands(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band; minima and maxima of a permutation go to different bands."""
    out = np.empty((len(values), bands), U)
    step = stream(13, rows) | U(1)
    for b in range(bands):
        total = np.full(len(values), b + 1, U) * U(0xD6E8FEB86659FD93)
        for r in range(rows):
            total += values[:, b * rows + r] * step[r]
        out[:, b] = mix(total)
    return out


def signatures(docs: DataFrame, width: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, digest, bands) per row; digest and bands are null without a set."""

    def sign(batches):
        for batch in chunks(batches):
            flat, off = shingles(Words(batch.column("text")), width)
            sizes = np.diff(off)
            values = _bands(_extremes(flat, off, -(-bands * rows // 2)), bands, rows)
            digest = linking.set_digests(flat, off)
            keys = lists(values.view(np.int64).ravel(), np.arange(len(values) + 1) * bands, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digest, pa.binary()), keys],
                                             ["doc_id", "n_shingles", "digest", "bands"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(own.dtypes)["doc_id"]
    return own.mapInArrow(sign, f"doc_id {kind}, n_shingles bigint, digest binary, bands array<bigint>")


def near_duplicates(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
                    rounds: int = linking.ROUNDS, block: int = linking.BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row; component_id is the smallest id reachable over links."""
    bounded_batches(docs.sparkSession)
    signed = Staged(signatures(docs, width, bands, rows, id_col, text_col), "signatures").df
    classes = (signed.where("doc_id is not null and digest is not null")
               .groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")))
    classes = Staged(classes.withColumnRenamed("digest", "node"), "classes")
    buckets = linking.crowded(classes.df.select("node", F.explode("bands").alias("bucket")))
    ids = classes.df.select("doc_id", "node")
    fetch = lambda nodes: linking.shingle_sets(docs, ids.join(nodes, "node"), width, id_col, text_col)
    found = linking.component_ids(signed, linking.components(buckets, fetch, similarity, block, rounds))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, with all its columns: that of the smallest id.

    Rows with a null id stay; of repeated rows (same id and text) one stays.
    """
    found = near_duplicates(docs, width, similarity, id_col=id_col, text_col=text_col, **options).where("doc_id is not null")
    # One small table of ids, so that texts move only if there are very many of them.
    ids = Staged(found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n")).where("not kept or n > 1"), "duplicate-ids").df
    # The ids' own column names never meet those of the documents: both joins return documents only.
    kept = ids.where("kept")
    alone = docs.join(ids, docs[id_col] == ids["doc_id"], "left_anti")
    again = docs.join(kept, docs[id_col] == kept["doc_id"], "left_semi").dropDuplicates([id_col, text_col])
    return alone.unionByName(again)


def q_op1(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), width=4)


ORACLE_OP1 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(len(w), 4) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON reach.c = e.x)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
