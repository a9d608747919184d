"""The trie of conversation prefixes, with subtree sums, without building a tree.

A node is a distinct sequence of first turns (role, text).  A conversation's
prefixes are named by 128-bit digests: sums of one hash per turn and depth, so they
are running totals and a conversation of any length is spread over tasks.  A
count-min sketch of all prefixes comes first: an estimate of one proves that a
prefix belongs to a single conversation, and so do all longer ones of that
conversation; this tail is finished where it is.  Only prefixes that may be shared
are shuffled and grouped, exactly, with partial aggregates.

Sums over subtrees need no walk over the depths.  A node is represented by its
smallest member, and the nodes that a conversation represents are those from
some depth on (a longer prefix has fewer members).  So with r that depth for each
conversation, and its words before it, a node's sums are plain sums over its
members: children (r is at most the next depth), leaves (the member represents
the childless node it ends at), and saved tokens, which are all members' words
below the node less those of all distinct nodes below it.

The members that end at a node are range-sorted by (node, id), written out as text
by each task and only hashed in sequence, in bounded memory.

Turns are ordered by turn (nulls first), ties by a hash of role and text; repeated
rows are turns of their own.  A null role or text is empty.  Rows without a
conversation id take no part; a conversation without turns is a member of the root.
A table without conversations has no nodes, not even a root.  Other columns,
whatever their names, have no influence.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.llm import sketch
from loglens.llm.tables import Staged, bounded_batches, table
from loglens.operators.scan import running_totals

WORD = r"[^\x20\x09-\x0D]+"
PIECE = 1 << 15        # ids of one piece of a node's list
EMPTY = hashlib.sha256(b"").hexdigest()
_LANES = ["f0", "f1", "f2", "f3"]
_KEY = ["hi", "lo", "depth"]
NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")


def compact(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, a, b, words, one): two hashes of role and text and the text's number of words, in place of the text."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    return turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"), F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"), F.lit(1).cast("bigint").alias("one"))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, words) of :func:`compact` rows: depth counts a conversation's turns from 1."""
    out = running_totals(turns, [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")], ["one"], "conv_id", "conversation-turns")
    return out.select("conv_id", (F.col("before_one") + 1).alias("depth"), "a", "b", "words")


def lengths(rows: DataFrame) -> DataFrame:
    """(conv_id, length) of numbered turns."""
    return rows.groupBy("conv_id").agg(F.count("*").alias("length"))


def spliced(rows: DataFrame, sizes: DataFrame, donor: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``heads`` turns are those of the conversation ``donor``: (numbered turns, lengths).

    Both are expressions over conv_id, ``heads`` at most ``most``.  All turns of the donor are
    given if it has fewer, none if it is absent; then come the own turns after the first ``heads``.
    """
    own = sizes.select("conv_id", "length", donor.alias("donor"), heads.cast("bigint").alias("cut"))
    of = sizes.select(F.col("conv_id").alias("donor"), F.col("length").alias("given"))
    facts = own.join(of, "donor", "left").select("conv_id", "donor", "cut", F.least(F.col("cut"), F.coalesce("given", F.lit(0))).alias("taken"),
                                                 F.greatest(F.col("length") - F.col("cut"), F.lit(0)).alias("left"))
    facts = Staged(facts, "conversation-facts").df
    kept = rows.join(facts, "conv_id").where("depth > cut").select("conv_id", (F.col("depth") - F.col("cut") + F.col("taken")).alias("depth"), "a", "b", "words")
    first = rows.where(F.col("depth") <= most).select(F.col("conv_id").alias("donor"), "depth", "a", "b", "words")
    given = facts.where("taken > 0").join(first, "donor").where("depth <= taken").select("conv_id", "depth", "a", "b", "words")
    return kept.unionByName(given), facts.select("conv_id", (F.col("taken") + F.col("left")).alias("length"))


def _digest(a: str, b: str, after: bool) -> Column:
    """Half a prefix's digest: the totals of two 32-bit lanes, with this turn or before it."""
    one, two = (F.col(f"before_{x}") + F.col(x) if after else F.col(f"before_{x}") for x in (a, b))
    mask = F.lit(0xFFFFFFFF)
    return F.shiftleft(one.bitwiseAND(mask), 32).bitwiseOR(two.bitwiseAND(mask))


def prefixes(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per conversation and prefix but the empty one: digest (hi, lo), that of the prefix before (phi, plo), words of the last turn and before it."""
    x, y = F.xxhash64(F.lit(3), "depth", "a", "b"), F.xxhash64(F.lit(4), "depth", "a", "b")
    mask = F.lit(0xFFFFFFFF)
    lane = {"f0": F.shiftrightunsigned(x, 32), "f1": x.bitwiseAND(mask), "f2": F.shiftrightunsigned(y, 32), "f3": y.bitwiseAND(mask)}
    split = rows.join(sizes, "conv_id").select("conv_id", "depth", "length", "words", *(v.alias(k) for k, v in lane.items()))
    out = running_totals(split, [F.col("depth")], [*_LANES, "words"], "conv_id", "conversation-prefixes")
    return out.select("conv_id", "depth", "length", "words", "before_words", _digest("f0", "f1", True).alias("hi"), _digest("f2", "f3", True).alias("lo"),
                      _digest("f0", "f1", False).alias("phi"), _digest("f2", "f3", False).alias("plo"))


def _screened(rows: DataFrame, bits: int | None) -> DataFrame:
    """``rows`` with ``alone`` (the sketch proves the prefix a singleton) and ``inner`` (the prefix before was proven here, too)."""
    hashed = rows.withColumn("key", F.xxhash64("hi", "lo"))
    found = sketch.build(hashed, "key", bits or sketch.bits_for(rows.count()))
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def run(batches):
        estimate = shared.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv, depth = batch.column("conv_id").to_numpy(), batch.column("depth").to_numpy()
            proven = ~estimate.met_twice(batch.column("key").to_numpy().view(np.uint64))
            goes_on = np.zeros(n, bool)
            goes_on[1:] = (conv[1:] == conv[:-1]) & (depth[1:] == depth[:-1] + 1)
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(goes_on, 0, at))
            alone = np.maximum.accumulate(np.where(proven, at, -1)) >= start  # a proven prefix before, in the same run of turns
            inner = np.zeros(n, bool)
            inner[1:] = alone[:-1] & goes_on[1:]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(alone), pa.array(inner)], [*batch.schema.names[:-1], "alone", "inner"])

    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return hashed.sortWithinPartitions("conv_id", "depth").mapInArrow(run, f"{schema}, alone boolean, inner boolean")


def list_digests(ends: DataFrame) -> DataFrame:
    """(hi, lo, depth, ends_sha256) of (hi, lo, depth, conv_id): the digest of a node's ids, ascending, comma-joined."""

    def write(batches):
        for batch in batches:
            node = np.stack([batch.column(c).to_numpy() for c in _KEY], axis=1)
            ids = batch.column("conv_id").to_numpy()
            cut = np.flatnonzero((node[1:] != node[:-1]).any(axis=1)) + 1 if len(ids) else np.empty(0, int)
            edges = [0, *cut.tolist(), len(ids)]
            start = [i for a, b in zip(edges, edges[1:]) for i in range(a, b, PIECE)]
            stop = start[1:] + [len(ids)]
            text = [",".join(map(str, ids[i:j].tolist())) for i, j in zip(start, stop)]
            yield pa.RecordBatch.from_arrays([*(pa.array(node[start, k]) for k in range(3)), pa.array(ids[start]), pa.array(text, pa.string())], [*_KEY, "first", "text"])

    def run(batches):
        now, state = None, None
        for batch in batches:
            keys, out = [batch.column(c).to_pylist() for c in _KEY], []
            for hi, lo, depth, text in zip(*keys, batch.column("text").to_pylist()):
                if (hi, lo, depth) != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = (hi, lo, depth), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield rows_of(out)
        if now is not None:
            yield rows_of([(*now, state.hexdigest())])

    def rows_of(out):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(4)], [*_KEY, "ends_sha256"])

    by = [*_KEY, "conv_id"]
    written = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(write, "hi bigint, lo bigint, depth bigint, first bigint, text string")
    return written.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(run, "hi bigint, lo bigint, depth bigint, ends_sha256 string")


def prefix_trie(rows: DataFrame, sizes: DataFrame, bits: int | None = None) -> DataFrame:
    """The nodes (``NODE``) of numbered turns and the lengths of all conversations; ``bits`` sets the sketch's size."""
    bounded_batches(rows.sparkSession)
    sizes = Staged(sizes, "conversation-lengths").df
    screened = Staged(_screened(prefixes(rows, sizes), bits), "prefixes").df
    zero = F.lit(0).cast("bigint")
    root = sizes.select("conv_id", zero.alias("depth"), "length", *(zero.alias(c) for c in ("words", "before_words", "hi", "lo", "phi", "plo")))
    shared = screened.where("not alone").drop("alone", "inner").unionByName(root)
    alone = screened.where("alone")

    # the depth from which on each conversation represents its prefixes, and its words before that depth
    grouped = Staged(shared.groupBy(*_KEY).agg(F.min("conv_id").alias("member"), F.max("length").alias("deepest"), F.min("before_words").alias("before_words")), "shared-prefixes").df
    represented = grouped.select(F.col("member").alias("conv_id"), "depth", "before_words", (F.col("deepest") == F.col("depth")).alias("leaf"))
    single = alone.select("conv_id", "depth", "before_words", (F.col("length") == F.col("depth")).alias("leaf"))
    never = screened.where("depth = length").select("conv_id", (F.col("depth") + 1).alias("depth"), (F.col("before_words") + F.col("words")).alias("before_words"), F.lit(False).alias("leaf"))
    facts = represented.unionByName(single).unionByName(never).groupBy("conv_id").agg(F.min("depth").alias("r"), F.min("before_words").alias("q"), F.bool_or("leaf").alias("leaf"))

    r = F.coalesce("r", F.col("length") + 1)
    child = (r <= F.col("depth") + 1) & (F.col("depth") < F.col("length"))
    saved = F.when(r > F.col("depth"), F.coalesce("q", zero) - F.col("before_words")).otherwise(zero)
    nodes = shared.join(facts, "conv_id", "left").groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(child.cast("bigint")).alias("n_children"), F.sum(F.coalesce("leaf", F.lit(False)).cast("bigint")).alias("n_leaves"),
        F.sum(saved).alias("saved_tokens"), F.min("phi").alias("phi"), F.min("plo").alias("plo"))
    ends = list_digests(shared.where("depth = length"))
    nodes = nodes.join(ends, _KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))

    one = F.lit(1).cast("bigint")
    own = F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY))
    tails = alone.select("conv_id", "depth", "phi", "plo", "inner", one.alias("n_convs"), (F.col("depth") < F.col("length")).cast("bigint").alias("n_children"),
                         one.alias("n_leaves"), zero.alias("saved_tokens"), own.alias("ends_sha256"))
    # A proven prefix whose parent is not among the grouped ones has a proven parent.
    asking = nodes.select("conv_id", "depth", "phi", "plo", F.lit(False).alias("inner"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").unionByName(tails.where("not inner"))
    parent = grouped.select(F.col("hi").alias("phi"), F.col("lo").alias("plo"), (F.col("depth") + 1).alias("depth"), F.col("member").alias("parent"))
    found = asking.join(parent, ["phi", "plo", "depth"], "left").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")))
    names = [c.split()[0] for c in NODE.split(", ")]
    return found.select(*names).unionByName(tails.where("inner").withColumn("parent_conv_id", F.col("conv_id")).select(*names))


def q_op12(spark, sf_dir: str) -> DataFrame:
    # written once: sorting reads its input twice, and texts should be read once
    turns = Staged(compact(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")), "compact-turns").df
    rows = numbered(turns)
    sizes = Staged(lengths(rows), "conversation-sizes").df
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefix_trie(*spliced(rows, sizes, F.col("conv_id") - F.col("conv_id") % 20, heads, 3))


ORACLE_OP12 = r"""
WITH RECURSIVE poly AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
          FROM (SELECT DISTINCT conv_id FROM own), poly),
made AS (SELECT c.conv_id, 0 AS part, o.i, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.i <= c.h
         UNION ALL SELECT c.conv_id, 1, o.i, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d, md5(role || chr(0) || text) AS g, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM made),
pre AS (SELECT conv_id, 0 AS d, '' AS k, '' AS p, 0 AS w FROM convs
        UNION ALL SELECT conv_id, d, string_agg(g, '') OVER o, coalesce(string_agg(g, '') OVER (PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), w
        FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY d)),
size AS (SELECT conv_id, max(d) AS l FROM pre GROUP BY conv_id),
node AS (SELECT k, any_value(p) AS p, d, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = l) AS ends
         FROM pre JOIN size USING (conv_id) GROUP BY k, d),
kids AS (SELECT p, d - 1 AS d, count(*) AS c FROM node WHERE d > 0 GROUP BY p, d),
full_ AS (SELECT node.*, coalesce(c, 0) AS c FROM node LEFT JOIN kids ON kids.p = node.k AND kids.d = node.d),
sub AS (SELECT a.k, a.d, sum(CASE WHEN b.c = 0 THEN 1 ELSE 0 END) AS leaves, sum((b.n - 1) * b.w) AS saved FROM full_ a JOIN full_ b ON b.d >= a.d AND starts_with(b.k, a.k) GROUP BY a.k, a.d)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, f.n AS n_convs, f.c AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(f.ends, '')) AS ends_sha256
FROM full_ f JOIN sub USING (k, d) LEFT JOIN full_ q ON f.d > 0 AND q.k = f.p AND q.d = f.d - 1
"""
