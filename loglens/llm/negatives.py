"""Hard negatives by slots between the positives' upper limits.

For every anchor the ``n_positives`` best rows of its label are its positives, and
each positive opens a window of scores, ``low`` to ``high`` per cent of its own.
The windows overlap, so they are not searched one by one: their distinct upper
limits, in descending order, split the scores into disjoint slots, a row of
another label falls into one slot, and every task keeps only the best
``n_negatives`` rows of each slot (a combiner; tasks after the shuffle do the same
over what the combiners kept).  Going from the lowest slot upwards, the kept rows of
a slot are merged with those of all slots below and cut again: that is the best
of everything up to the slot's limit, and its part from the window's lower limit
on is the window's answer.

Scores are inner products of components ``floor(scale * x)``, exact integers below
2 ** 63 (beyond that they wrap); higher ones come first, ties by the smaller id.
Vectors of other lengths are compared as if padded with zeros.  Rows with a null
id, label or vector, or a null or non-finite component, take no part.  Rows that
agree on the id and on the score for an anchor count once for it, so repeated rows
change nothing; differing rows of one id are rows of their own, and never a
positive or negative of an anchor of that id.  A window of a negative positive score
is empty.  An empty table, or one without anchors, gives no rows.  Other columns,
whatever their names, have no influence.

Anchors are a stated query set: they are dealt to blocks of about BLOCK_CELLS
components by a hash of their id, each block is broadcast and meets all rows in
two scans, one for the positives and one for the negatives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm.tables import Staged, bounded_batches, table
from loglens.session import staging_dir

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100            # per cent of the positive's score
BLOCK_CELLS = 1 << 20          # components of the anchors of one block
CELLS = 1 << 20                # scores that a task holds at a time
TOP = 2.0 ** 62                # components saturate here
SCHEMA = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def quantize(column: pa.ListArray, scale: int = SCALE, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(int64 matrix, usable): floor(scale * x) padded with zeros or cut to ``width``; rows with nulls are not usable."""
    n = len(column)
    size = np.zeros(n, np.int64) if n == 0 else column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null is NaN
    row = np.repeat(np.arange(n), size)
    bad = ~np.isfinite(flat)
    usable = np.array(column.is_valid().to_numpy(zero_copy_only=False), bool)
    usable[row[bad]] = False
    width = int(size.max(initial=0)) if width is None else width
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    keep = ~bad & (at < width)
    out = np.zeros((n, width), np.int64)
    with np.errstate(over="ignore"):
        out[row[keep], at[keep]] = np.clip(np.floor(scale * flat[keep]), -TOP, TOP).astype(np.int64)
    return out, usable


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows, in a type in which they are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2 ** 53:
        kind = np.float32 if most < 2 ** 24 else np.float64
        return a.astype(kind) @ b.astype(kind).T
    return a @ b.T


def best(group: np.ndarray, score: np.ndarray, row: np.ndarray, most: int) -> np.ndarray:
    """Indices of the ``most`` first (score descending, then id) of each group, equal ones once, in that order."""
    order = np.lexsort((row, -score, group))
    g, s, r = group[order], score[order], row[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    order, g = order[new], g[new]
    first = np.ones(len(g), bool)
    first[1:] = g[1:] != g[:-1]
    start = np.flatnonzero(first)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return order[rank < most]


class Kept:
    """The best rows of each group seen so far."""

    def __init__(self, most: int):
        self.most = most
        self.group, self.score, self.row = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        group, score, row = np.concatenate([self.group, group]), np.concatenate([self.score, score]), np.concatenate([self.row, row])
        at = best(group, score, row, self.most)
        self.group, self.score, self.row = group[at], score[at], row[at]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (self.group, self.score, self.row)], ["grp", "score", "id"])


def _own(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    own = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vec_col).alias("v"))
    return own.where("id is not null and label is not null and v is not null")


def _combined(rows: DataFrame, shared, pick, most: int, scale: int) -> DataFrame:
    """(grp, score, id): what the combiners keep of the candidates ``pick(scores, anchors, labels, ids)`` of every task."""

    def run(batches):
        anchors = shared.value
        kept = Kept(most)
        step = max(1, CELLS // max(1, len(anchors["id"])))
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                x, usable = quantize(part.column("v"), scale, anchors["q"].shape[1])
                ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
                ids, labels, x = ids[usable], labels[usable], x[usable]
                for lo in range(0, len(anchors["id"]), CELLS):
                    some = slice(lo, lo + CELLS)
                    scores = products(anchors["q"][some], x)
                    group, a, b = pick(scores, anchors, some, labels, ids)
                    kept.add(group, scores[a - lo, b].astype(np.int64), ids[b])
        yield kept.batch()

    return rows.mapInArrow(run, "grp bigint, score bigint, id bigint")


def _merged(partial: DataFrame, key: Column, most: int, finish) -> DataFrame:
    """The combiners' rows, dealt by ``key`` and cut once more; ``finish(kept)`` makes the result's columns."""
    def run(batches):
        kept = Kept(most)
        for batch in batches:
            kept.add(*(batch.column(c).to_numpy() for c in ("grp", "score", "id")))
        yield finish(kept)

    return partial.repartition(key).mapInArrow(run, finish.schema)


def _positive_pick(scores, anchors, some, labels, ids):
    same = (anchors["label"][some, None] == labels) & (anchors["id"][some, None] != ids)
    a, b = np.nonzero(same)
    return a + some.start, a + some.start, b


def _negative_pick(scores, anchors, some, labels, ids):
    """Groups are anchor * slots + slot; slot j holds the scores up to the j-th limit and above the next."""
    limits = anchors["limits"]
    a, b = np.nonzero((anchors["label"][some, None] != labels) & (anchors["id"][some, None] != ids)
                      & (scores <= limits[some, :1]) & (scores >= anchors["least"][some, None]))
    own = scores[a, b].astype(np.int64)
    a = a + some.start
    slot = (limits[a] >= own[:, None]).sum(axis=1) - 1
    return a * limits.shape[1] + slot, a, b


def _whole(kept: Kept) -> pa.RecordBatch:
    return kept.batch()


_whole.schema = "grp bigint, score bigint, id bigint"


class _Answers:
    """From the kept rows of the slots to the windows' answers, by merging the slots from the lowest upwards."""

    schema = SCHEMA

    def __init__(self, shared, most: int):
        self.shared, self.most = shared, most

    def __call__(self, kept: Kept) -> pa.RecordBatch:
        v = self.shared.value
        slots = v["limits"].shape[1]
        anchor, slot = kept.group // slots, kept.group % slots
        below, out = Kept(self.most), []
        for j in range(slots - 1, -1, -1):
            here = slot == j
            below.add(anchor[here], kept.score[here], kept.row[here])
            own = np.flatnonzero(v["slot"] == j)  # positives whose limit is this slot's
            start, end = np.searchsorted(below.group, v["anchor"][own]), np.searchsorted(below.group, v["anchor"][own], "right")
            n = end - start
            p = np.repeat(own, n)
            rank = np.arange(len(p)) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(start, n) + rank
            ok = below.score[at] >= v["lower"][p]
            p, at, rank = p[ok], at[ok], rank[ok]
            out.append((v["id"][v["anchor"][p]], v["positive"][p], rank + 1, below.row[at], v["score"][p], below.score[at]))
        cols = [np.concatenate(x) for x in zip(*out)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [c.split()[0] for c in SCHEMA.split(", ")])


def windows(anchor: np.ndarray, score: np.ndarray, n_anchors: int, low: int, high: int) -> dict[str, np.ndarray]:
    """The limits of the positives' windows: per anchor the distinct upper ones (descending, padded) and the least lower one."""
    upper, lower = high * score // 100, -(-low * score // 100)
    open_ = lower <= upper
    none = np.int64(-2 ** 63)
    limits, least = np.full((n_anchors, 1), none), np.full(n_anchors, np.int64(2 ** 63 - 1))
    slot = np.full(len(score), -1)
    order = np.lexsort((-upper, anchor))
    order = order[open_[order]]
    if len(order):
        a, u = anchor[order], upper[order]
        fresh = np.ones(len(a), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (u[1:] != u[:-1])
        head = np.ones(len(a), bool)
        head[1:] = a[1:] != a[:-1]
        count = np.cumsum(fresh)
        slot[order] = count - np.repeat(count[head], np.diff(np.append(np.flatnonzero(head), len(a))))
        limits = np.full((n_anchors, int(slot.max()) + 1), none)
        limits[a, slot[order]] = u
        np.minimum.at(least, a, lower[order])
    return {"limits": limits, "least": least, "lower": lower, "slot": slot}


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows for which ``is_anchor`` holds."""
    spark = rows.sparkSession
    bounded_batches(spark)
    own = _own(rows, id_col, vec_col, label_col)

    def clean(batches):
        for batch in batches:
            q, usable = quantize(batch.column("v"), scale)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(q) + 1) * q.shape[1], pa.int32()), pa.array(q.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), flat], ["id", "label", "q"]).filter(pa.array(usable))

    anchors = Staged(_own(rows.where(is_anchor), id_col, vec_col, label_col).mapInArrow(clean, "id bigint, label bigint, q array<bigint>").distinct(), "anchors")
    cells = anchors.df.agg(F.sum(F.size("q") + 1)).first()[0] or 0
    blocks = -(-cells // block_cells)
    out = staging_dir(spark, "negatives")
    for k in range(blocks):
        got = anchors.df.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).toArrow().sort_by([("id", "ascending"), ("label", "ascending")]).combine_chunks()
        if not got.num_rows:
            continue
        q, _ = quantize(got.column("q").combine_chunks().cast(pa.list_(pa.float64())), 1)
        value = {"id": got.column("id").to_numpy(), "label": got.column("label").to_numpy(), "q": q}
        first = spark.sparkContext.broadcast(value)
        found = _merged(_combined(own, first, _positive_pick, n_positives, scale), F.col("grp"), n_positives, _whole).toArrow()
        found = found.sort_by([("grp", "ascending"), ("score", "descending"), ("id", "ascending")])
        anchor, score = found.column("grp").to_numpy().astype(np.int64), found.column("score").to_numpy().astype(np.int64)
        value |= windows(anchor, score, len(q), low, high) | {"anchor": anchor, "positive": found.column("id").to_numpy(), "score": score}
        slots = value["limits"].shape[1]
        second = spark.sparkContext.broadcast(value)
        partial = _combined(own, second, _negative_pick, n_negatives, scale)
        _merged(partial, F.floor(F.col("grp") / F.lit(slots)), n_negatives, _Answers(second, n_negatives)).write.mode("append").parquet(out)
        first.unpersist()
        second.unpersist()
    anchors.drop()
    return spark.read.schema(SCHEMA).parquet(out) if blocks else spark.createDataFrame([], SCHEMA)


def q_op13(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.col("label").cast("bigint")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, F.try_add(label, F.lit(1)) % 10).otherwise(label))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLE_OP13 = """
WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS s
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (SELECT p.a AS anchor_id, p.b AS positive_id, n.b AS negative_id, p.s AS positive_score, n.s AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) AS INTEGER) AS rank
      FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND n.s <= p.s)
SELECT * FROM n WHERE rank <= 5
"""
