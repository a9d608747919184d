"""Size-aware heavy-light similarity join of shingle sets.

Words are runs of characters outside ASCII white space, A-Z lower-cased; a
document's set is its distinct ``width``-word shingles (with fewer words: the
whole sequence as one).  Two sets link when 100 * shared >= similarity * united,
that is when they share ``need(a, b)`` shingles, a number that only depends on
their sizes.  Equal sets are one class first.

*Small sets* enumerate fixed-size subsets: for each size b that a partner may have,
all their subsets of need(a, b) shingles, named by a hash of the subset and of both
sizes.  Two small sets that link share such a name; sets of different sizes that share
one link, too.  *Large sets* scan inverted lists, which hold the parts of every set that
a large one may link to: a hash deals all shingles to one part more than linked sets
of such sizes may differ in, so that at least one part of both has the very same
shingles, and they meet in its list for sure.  A part has some nine shingles at 90 per
cent, so what meets in a list is similar; lists of single shingles would grow with the
square of the corpus.

The boundary between both is the size of least cost: names of the enumerated
subsets on one side, and on the other the postings and the lengths of the lists
that they are in, both summed over all classes.

Marks of all postings, four bytes each, prove most lists to have one entry; these go before
any other shuffle, by a bounded sketch of the marks met twice.  Candidates are compared by
their parities first (:func:`linking.parities`), then by their necessary prefixes: their size -
need + 1 shingles that come first in one order of all shingles, of which linked sets
share some.  The order puts shingles that many documents have last, by a bounded table
of their counts; which ones that table knows changes what is compared further, not the
result.  What is left is verified on whole sets and contracted to
components by :mod:`loglens.llm.linking`; no link is lost, and no pairs of a list are
enumerated.

Nulls, empty texts and texts without words have an empty set and no links.  Rows
with a null id take no part: their component is null.  Repeated rows of an id each
get a row; an id with different texts has each row judged by its own text.  An empty
table gives no rows.  Columns other than the two named have no influence.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm import linking, sketch
from loglens.llm.tables import Staged, bounded_batches, table
from loglens.llm.text import U, Words, chunks, lists, mix, shingles, stream

WIDTH = 3
SIMILARITY = 90          # per cent
SUBSETS = 2048           # names of one set at most, so sizes beyond are large whatever their cost
COMMON = 1 << 17         # shingles whose counts decide the order
COUNTED = 1 << 22        # shingles that a task counts at a time
OFTEN = 3                # of these counts, less says nothing


def need(a: int, b: int, similarity: int = SIMILARITY) -> int:
    """Shingles that sets of sizes a and b must share to link."""
    return -(-similarity * (a + b) // (100 + similarity))


def partners(n: int, similarity: int = SIMILARITY) -> list[int]:
    """Sizes that a set of n shingles may link to, other than by being equal."""
    return [b for b in range(-(-similarity * n // 100), 100 * n // similarity + 1) if b != n or need(n, n, similarity) < n]


def names_of_size(n: int, similarity: int = SIMILARITY) -> int:
    """How many subsets a small set of n shingles enumerates."""
    return sum(comb(n, need(n, b, similarity)) for b in partners(n, similarity))


def largest_small(similarity: int = SIMILARITY) -> int:
    """The largest size up to which no set has more than SUBSETS names."""
    n = 0
    while names_of_size(n + 1, similarity) <= SUBSETS and n < SUBSETS:
        n += 1
    return n


def prefix_length(n, similarity: int = SIMILARITY):
    """Shingles of a set of n of which any linked set has one, in whatever order."""
    return n - -(-similarity * n // 100) + 1


def subset_names(items: np.ndarray, similarity: int = SIMILARITY) -> np.ndarray:
    """The names of a small set's subsets: the sum of the set's hashes less the left-out ones, and both sizes."""
    n, h = len(items), mix(items ^ U(0xA5A5A5A5DEADBEEF))
    total, out = h.sum(dtype=U), []
    for b in partners(n, similarity):
        less = n - need(n, b, similarity)
        gone = h[np.array(list(combinations(range(n), less)), np.int64).reshape(-1, less)].sum(axis=1, dtype=U) if less else np.zeros(1, U)
        sizes = stream(min(n, b) * 65536 + max(n, b), 1)[0]
        out.append(mix(total - gone ^ sizes))
    return np.concatenate(out) if out else np.empty(0, U)


def tops(most: int, similarity: int = SIMILARITY) -> np.ndarray:
    """The largest sizes of the classes of sizes, up to one that has ``most``; sets that may link are of one class or of neighbouring ones."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, 100 * out[-1] // similarity))
    return np.array(out, np.int64)


def part_names(flat: np.ndarray, off: np.ndarray, similarity: int = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """The names of the parts of sets (flat shingles, row offsets), as the same: each by the sum of its shingles' hashes.

    A set is cut for its own class of sizes and, as a visitor, for the next: into one part
    more than the shingles in which linked sets up to that class's top may differ.
    """
    size = np.diff(off)
    top = tops(int(size.max(initial=1)) + 1, similarity)
    top = np.append(top, max(top[-1] + 1, 100 * top[-1] // similarity))
    own = np.searchsorted(top, size)
    n = [np.where(size > 0, (100 - similarity) * 2 * top[own + k] // (100 + similarity) + 1, 0) for k in (0, 1)]
    ends = np.concatenate([[0], np.cumsum(n[0] + n[1])])
    row = np.repeat(np.arange(len(size)), size)
    dealt, value = mix(flat ^ U(0x3C3C3C3C7E57AB1E)) >> U(32), mix(flat ^ U(0xA5A5A5A5DEADBEEF))
    total = np.zeros(int(ends[-1]), U)
    for parts, start in zip(n, (ends[:-1], ends[:-1] + n[0])):
        np.add.at(total, start[row] + (dealt * parts[row].astype(U) >> U(32)).astype(np.int64), value)
    group = np.repeat(np.stack([own, own + 1], axis=1).ravel(), np.stack(n, axis=1).ravel())
    place = np.arange(len(total)) - np.repeat(np.stack([ends[:-1], ends[:-1] + n[0]], axis=1).ravel(), np.stack(n, axis=1).ravel())
    return mix(total ^ mix(group.astype(U) << U(32) | place.astype(U))), ends


def common_shingles(docs: DataFrame, width: int, text_col: str, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """(shingles ascending, counts) of those found in most documents, at most ``most``; counts are lower bounds."""

    def count(batches):
        held, n = [], 0

        def flush():
            shingle, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= OFTEN
            return pa.RecordBatch.from_arrays([pa.array(shingle[often].view(np.int64)), pa.array(times[often], pa.int64())], ["shingle", "n"])

        for batch in chunks(batches):
            flat, _ = shingles(Words(batch.column("text")), width)
            held.append(flat)
            n += len(flat)
            if n >= COUNTED:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "shingle bigint, n bigint")
    top = counted.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    shingle = top.column("shingle").to_numpy().view(U)
    order = np.argsort(shingle)
    return shingle[order], top.column("n").to_numpy()[order]


def first_in_order(flat: np.ndarray, off: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """The prefixes of sorted sets (flat shingles, row offsets), as the same: rare shingles by hash, then common ones by count."""
    size = np.diff(off)
    row = np.repeat(np.arange(len(size)), size)
    known, counts = common
    if len(known) and len(flat):
        at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
        weight = np.where(known[at] == flat, counts[at], 0)
        if weight.any():
            flat = flat[np.lexsort((weight, row))]
    length = np.where(size > 0, prefix_length(size, similarity), 0)
    place = np.arange(len(flat)) - np.repeat(off[:-1], size)
    return flat[place < np.repeat(length, size)], np.concatenate([[0], np.cumsum(length)])


def prefixed(docs: DataFrame, width: int, similarity: int, small: int, common, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, digest, prefix, parity, parts, items) per row; items are the whole set of those up to ``small`` shingles, else null."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        for batch in chunks(batches):
            flat, off = shingles(Words(batch.column("text")), width)
            size = np.diff(off)
            first, ends = first_in_order(flat, off, shared.value, similarity)
            little = size <= small
            items = np.repeat(little, size)
            whole = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(little, size, 0))]), pa.int32()), pa.array(flat[items].view(np.int64)), mask=pa.array(~little))
            names, upto = part_names(flat, off, similarity)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(linking.set_digests(flat, off), pa.binary()),
                                              lists(first.view(np.int64), ends, pa.int64()), pa.array(linking.parities(flat, off), pa.binary()), lists(names.view(np.int64), upto, pa.int64()), whole], ["doc_id", "n_shingles", "digest", "prefix", "parity", "parts", "items"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, f"doc_id {dict(own.dtypes)['doc_id']}, n_shingles bigint, digest binary, prefix array<bigint>, parity binary, parts array<bigint>, items array<bigint>")


def set_classes(signed: DataFrame) -> DataFrame:
    """(node, doc_id, n, prefix, parity, parts, items): one row per distinct set, with its smallest id; only sets that may have copies are shuffled."""
    own = signed.where("doc_id is not null and digest is not null").withColumn("key", F.xxhash64("digest"))
    shared = signed.sparkSession.sparkContext.broadcast(sketch.build(own, "key", sketch.bits_for(own.count())))

    def kept(again: bool):
        def run(batches):
            found = shared.value
            for batch in batches:
                yield batch.filter(pa.array(found.met_twice(batch.column("key").to_numpy().view(U)) == again))
        return own.mapInArrow(run, own.schema)

    columns = ("n", "prefix", "parity", "parts", "items")
    name = lambda x: x.withColumnsRenamed({"digest": "node", "n_shingles": "n"})
    copies = name(kept(True)).groupBy("node").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in columns))
    return name(kept(False)).select("node", "doc_id", *columns).unionByName(copies)


def boundary(classes: DataFrame, postings: DataFrame, small: int, similarity: int) -> int:
    """The size of least cost up to which sets enumerate subsets; ``small`` at most.

    ``postings`` (size, bucket) has the lists of several members whole; all others have one.
    """
    lengths = postings.groupBy("bucket").agg(F.count("*").alias("length"))
    asked = postings.where(F.col("size") <= small).groupBy("bucket", "size").agg(F.count("*").alias("sets"))
    longer = {r["size"]: r["cost"] for r in asked.join(lengths, "bucket").groupBy("size").agg(F.sum(F.col("sets") * (F.col("length") - 1)).alias("cost")).collect()}
    own = classes.where(F.col("n") <= small).groupBy("n").agg(F.count("*").alias("sets"), F.sum(F.size("parts")).alias("postings")).collect()
    sets = {r["n"]: r["sets"] for r in own}
    scans = {r["n"]: 2 * r["postings"] + longer.get(r["n"], 0) for r in own}

    def cost(x: int) -> int:
        light = sum(c * names_of_size(n, similarity) + (scans[n] if 100 * n // similarity > x else 0) for n, c in sets.items() if n <= x)
        return light + sum(c for n, c in scans.items() if n > x)

    return min(range(small + 1), key=cost)


def _not_alone(listed: DataFrame, column: str, bits: int | None = None) -> DataFrame:
    """(node, size, bucket, label) of the lists in ``column``, without buckets that marks prove to have one member.

    Only marks met twice go to the bounded sketch, so that it doesn't fill with those met once.  The label is the least bucket that a node is left in.
    """
    keys = listed.select(F.explode(column).alias("bucket"))
    lead = sketch.mark_bits(listed.agg(F.sum(F.size(column))).first()[0] or 0)
    found = Staged(sketch.repeated(keys, "bucket", lead), "repeated")
    shared = listed.sparkSession.sparkContext.broadcast(sketch.build(found.df, "mark", bits or sketch.bits_for(8 * found.df.count())))
    found.drop()

    def run(batches):
        found = shared.value
        for batch in batches:
            names = batch.column(column)
            flat = names.flatten()
            node = np.repeat(np.arange(batch.num_rows), names.value_lengths().to_numpy(zero_copy_only=False))
            kept = np.flatnonzero(found.met(sketch.marks(flat.to_numpy().view(U), lead)))
            node, bucket = node[kept], flat.to_numpy()[kept]
            start = np.flatnonzero(np.diff(node, prepend=-1))
            label = np.repeat(np.minimum.reduceat(bucket, start), np.diff(np.append(start, len(node)))) if len(node) else bucket
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(node)) for c in ("node", "n")), pa.array(bucket), pa.array(label)], ["node", "size", "bucket", "label"])

    return listed.select("node", "n", column).mapInArrow(run, "node binary, size bigint, bucket bigint, label bigint")


def candidates(classes: DataFrame, postings: DataFrame, x: int, similarity: int) -> DataFrame:
    """(node, size, bucket, label): names of the subsets of sets up to x shingles, and those of the ``postings`` whose sets a larger one may link to."""

    def enumerate_(batches):
        for batch in batches:
            sets = batch.column("items")
            off, flat = sets.offsets.to_numpy(), sets.values.to_numpy().view(U)
            for i in range(0, batch.num_rows, 256):
                rows = range(i, min(i + 256, batch.num_rows))
                names = [subset_names(flat[off[k]:off[k + 1]], similarity) for k in rows]
                nodes = batch.column("node").take(pa.array(np.repeat(np.array(rows), [len(k) for k in names])))
                size = pa.array(np.repeat(np.diff(off)[rows.start:rows.stop], [len(k) for k in names]), pa.int64())
                yield pa.RecordBatch.from_arrays([nodes, size, pa.array(np.concatenate(names).view(np.int64))], ["node", "size", "bucket"])

    light = classes.where(F.col("n") <= x).select("node", "items").mapInArrow(enumerate_, "node binary, size bigint, bucket bigint")
    return postings.where(F.floor(F.lit(100) * F.col("size") / similarity) > x).unionByName(light.withColumn("label", F.col("bucket")))


def jaccard_components(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY, limit: int | None = None, common: int = COMMON,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the smallest id reachable over links; ``limit`` sets the boundary instead of the cost."""
    bounded_batches(docs.sparkSession)
    small = largest_small(similarity)
    order = common_shingles(docs, width, text_col, common)
    signed = Staged(prefixed(docs, width, similarity, small, order, id_col, text_col), "prefixes")
    classes = Staged(set_classes(signed.df), "classes")
    rows = Staged(signed.df.select("doc_id", "n_shingles", "digest"), "rows").df
    signed.drop()
    postings = Staged(_not_alone(classes.df, "parts"), "postings")
    x = boundary(classes.df, postings.df, small, similarity) if limit is None else min(limit, small)
    buckets = linking.crowded(candidates(classes.df, postings.df, x, similarity))
    postings.drop()
    ids = classes.df.select("doc_id", "node")
    fetch = lambda nodes: linking.shingle_sets(docs, ids.join(nodes, "node"), width, id_col, text_col)
    heads = classes.df.select("node", "n", F.col("prefix").alias("head"), "parity")
    return linking.component_ids(rows, linking.components(buckets, fetch, similarity, heads=heads))


def q_op11(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE_OP11 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(len(w), 3) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON reach.c = e.x)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(c) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
