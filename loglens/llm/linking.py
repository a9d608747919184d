"""Exact components of similar sets among the members of buckets, without all pairs of a bucket.

Callers put distinct sets (nodes, named by a digest) into buckets such that any two
that may be similar enough share one.  Here the members are verified on their whole
sets, but only as far as a verified link can still connect something:

* every member against its bucket's first hub (the smallest node), links are
  contracted to components; then against the second hub (the largest) where the two
  are not connected yet.  Buckets of up to three members are thereby done;
* in a bucket that still holds several components, the hubs leave, and the members
  outside its largest component are compared with that component's and with each
  other, block against block: for ``r`` such members of ``m`` that is about
  ``m + r * m / block`` rows, so a few outsiders of a huge group cost a few of its
  rows each, and only members whose sizes fit an outsider are sent.

No link between candidates is lost.  Tasks hold two blocks of whole sets at most.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm import sketch
from loglens.llm.components import connected_components
from loglens.llm.tables import Staged
from loglens.llm.text import U, Words, chunks, lists, mix, shingles

ROUNDS = 2
PARITY_CELLS = 64, 8192 # of a set, at least and at most
BLOCK = 256             # members of one bucket whose whole sets meet in a task, from either side


def set_digests(flat: np.ndarray, off: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each sorted set; None for an empty one."""
    raw = memoryview(np.ascontiguousarray(flat)).cast("B") if len(flat) else b""
    return [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) if b > a else None for a, b in zip(off[:-1].tolist(), off[1:].tolist())]


def shingle_sets(docs: DataFrame, classes: DataFrame, width: int, id_col: str, text_col: str) -> Staged:
    """(node, items) for the (doc_id, node) classes: all their shingles.

    The texts are read again, and only the sets of ids that a bounded sketch of the
    wanted ones lets pass are made and shuffled.
    """
    classes = Staged(classes, "wanted-sets").df
    hashed = classes.select(F.xxhash64("doc_id").alias("key"))
    shared = docs.sparkSession.sparkContext.broadcast(sketch.build(hashed, "key", sketch.bits_for(8 * classes.count()), 1))

    def cut(batches):
        wanted = shared.value
        for batch in chunks(batches):
            rows = np.flatnonzero(wanted.met(batch.column("key").to_numpy().view(np.uint64)))
            if not len(rows):
                continue
            flat, off = shingles(Words(batch.column("text").take(pa.array(rows))), width)
            yield pa.RecordBatch.from_arrays([pa.array(set_digests(flat, off), pa.binary()), lists(flat.view(np.int64), off, pa.int64())], ["node", "items"])

    own = docs.where(F.col(id_col).isNotNull()).select(F.xxhash64(F.col(id_col)).alias("key"), F.col(text_col).alias("text"))
    sets = own.mapInArrow(cut, "node binary, items array<bigint>")
    # Other texts may pass, and copies: one row per wanted class stays.
    return Staged(sets.join(classes.select("node"), "node", "left_semi").dropDuplicates(["node"]), "shingle-sets")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar enough."""
    x = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(x, "a").join(y, "b")
            .where(F.lit(100) * both >= F.lit(similarity) * (F.size("x") + F.size("y") - both)).select("a", "b"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted distinct arrays, as a matrix; memory is bounded by slabs of tokens."""
    sides, flat = (left, right), []
    for arrays in sides:
        who = np.repeat(np.arange(len(arrays)), [len(x) for x in arrays])
        flat.append((np.concatenate(arrays), who))
    shared = np.intersect1d(flat[0][0], flat[1][0])
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(shared):
        return out
    cells = []
    for tokens, who in flat:
        at = np.minimum(np.searchsorted(shared, tokens), len(shared) - 1)
        ok = shared[at] == tokens
        order = np.argsort(at[ok], kind="stable")
        cells.append((at[ok][order], who[ok][order]))
    for lo in range(0, len(shared), 4096):
        part = []
        for (at, who), arrays in zip(cells, sides):
            x = np.zeros((len(arrays), 4096), np.float32)
            i, j = np.searchsorted(at, [lo, lo + 4096])
            x[who[i:j], at[i:j] - lo] = 1
            part.append(x)
        out += part[0] @ part[1].T
    return out


def _connecting(rows: list[tuple], similarity: int) -> list[tuple]:
    """Links (root, root) that connect components among the rows (side, root, items) of one pair of blocks."""
    left = [r for r in rows if r[0] <= 0]
    right = [r for r in rows if r[0] >= 0]
    if not left or not right:
        return []
    both = _overlaps([r[2] for r in left], [r[2] for r in right])
    sizes = np.array([len(r[2]) for r in left])[:, None] + np.array([len(r[2]) for r in right])[None, :]
    parent: dict = {}

    def top(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in np.argwhere(100 * both.astype(np.float64) >= similarity * (sizes - both.astype(np.float64))).tolist():
        a, b = top(left[i][1]), top(right[j][1])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((left[i][1], right[j][1]))
    return out


def least_shared(n, m, p, q, similarity: int):
    """How many of their first ``p`` and ``q`` elements linked sets of ``n`` and ``m`` share at least, in whatever common order.

    Of the shared elements, ``need`` or more, at most n - p follow the first set's head
    and m - q the second's.  Numbers or arrays.
    """
    need = -(-similarity * (n + m) // (100 + similarity))
    return need, np.minimum(p - (n - need), q - (m - need))


def parities(flat: np.ndarray, off: np.ndarray) -> list[bytes]:
    """Per set, for each of some two cells an element, packed: whether an odd number of its elements fall into it.

    Two sets that differ in k elements differ in k cells at most (:func:`_cells_apart`).
    """
    size = np.diff(off)
    width = np.clip(1 << np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64), *PARITY_CELLS)
    ends = np.concatenate([[0], np.cumsum(width)])
    row = np.repeat(np.arange(len(size)), size)
    odd = np.bincount(ends[row] + (mix(flat ^ U(0x6A09E667F3BCC909)) & (width[row] - 1).astype(U)).astype(np.int64), minlength=int(ends[-1])) & 1
    packed, at = np.packbits(odd.astype(bool), bitorder="little").tobytes(), ends // 8
    return [packed[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _folded(parity: bytes, cells: int) -> np.ndarray:
    """The parities of the same set for so many cells, a smaller power of two: those whose number has the same last bits are one."""
    return np.bitwise_xor.reduce(np.frombuffer(parity, np.uint8).reshape(-1, cells // 8), axis=0)


def _cells_apart(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """In how many cells parities differ, as a matrix."""
    cells = 8 * min(map(len, (*left, *right)))
    x, y = (np.unpackbits(np.stack([_folded(p, cells) for p in side]), axis=1).astype(np.float32) for side in (left, right))
    return x.sum(axis=1)[:, None] + y.sum(axis=1)[None, :] - 2 * (x @ y.T)


def _most_apart(n, m, similarity: int):
    """How many elements linked sets of n and m have at most that the other has not."""
    need = -(-similarity * (n + m) // (100 + similarity))
    return np.where(need <= np.minimum(n, m), n + m - 2 * need, -1)


def _may_link(bucket: int, rows: list[tuple], similarity: int) -> bool:
    """Whether heads (side, root, head, size, …) of one pair of blocks leave a link between two components possible.

    Two sets that share several elements of their heads are looked at in the bucket of the least only.
    """
    left = [r for r in rows if r[0] <= 0]
    right = [r for r in rows if r[0] >= 0]
    if not left or not right:
        return False
    both = _overlaps([r[2] for r in left], [r[2] for r in right])
    column = lambda f, x: np.array([f(r) for r in x], np.int64)
    n, m = column(lambda r: r[3], left)[:, None], column(lambda r: r[3], right)[None, :]
    need, least = least_shared(n, m, column(lambda r: len(r[2]), left)[:, None], column(lambda r: len(r[2]), right)[None, :], similarity)
    number = {root: k for k, root in enumerate({r[1] for r in rows})}
    apart = column(lambda r: number[r[1]], left)[:, None] != column(lambda r: number[r[1]], right)[None, :]
    for i, j in np.argwhere(apart & (both >= least) & (need <= np.minimum(n, m))).tolist():
        first = np.intersect1d(left[i][2], right[j][2])[0]
        if first == bucket or bucket not in left[i][2]:
            return True
    return False


def by_size(members: DataFrame, similarity: int) -> DataFrame:
    """The members (bucket, node, root, part, size) in one bucket per class of sizes, with the old one as ``origin``.

    Sets that may link are of one class or of neighbouring ones, so each is in the bucket of
    its own class and, as a visitor, in that of the next; visitors need not meet each other.
    """
    # a little wider than the ratio of linked sizes, so that rounding cannot part these by two classes
    own = F.floor(F.ln(F.col("size")) / F.ln(F.lit(100.001 / similarity)))
    both = members.withColumn("origin", F.col("bucket")).withColumn("class", own).withColumn("visits", F.explode(F.array(F.lit(0), F.lit(1))))
    part = F.when(F.col("visits") == 1, F.lit("visitors").cast("binary")).otherwise(F.col("part"))
    return both.select(F.xxhash64("origin", F.col("class") + F.col("visits")).alias("bucket"), "node", "root", part.alias("part"), "size", "origin")


def deal(members: DataFrame, similarity: int, block: int) -> DataFrame:
    """(bucket, i, j, side, node, root): the members (bucket, node, root, part, size) dealt to pairs of blocks.

    Members of one part need not meet.  Of every bucket, the members outside its largest part
    meet those of that part (i >= 0: its blocks) and each other (i < 0).
    """
    parts = members.groupBy("bucket", "part").agg(F.count("*").alias("n"), F.min("size").alias("least"), F.max("size").alias("most"))
    main = parts.groupBy("bucket").agg(F.max(F.struct("n", "part")).alias("top"), F.count("*").alias("parts")).where("parts > 1").select("bucket", F.col("top.part").alias("main"))
    rest = (parts.join(main, "bucket").where("part <> main").groupBy("bucket", "main")
            .agg(F.sum("n").alias("n_rest"), F.min("least").alias("least"), F.max("most").alias("most")))
    # a set of the main part can only be linked to an outsider if its size fits
    fits = (F.col("size") * 100 >= F.col("least") * similarity) & (F.col("size") * similarity <= F.col("most") * 100)
    own = members.join(rest, "bucket").withColumn("outside", F.col("part") != F.col("main")).where(F.col("outside") | fits)
    n_main = own.where("not outside").groupBy("bucket").agg(F.count("*").alias("n_main"))
    extra = [c for c in members.columns if c == "origin"]
    own = own.join(n_main, "bucket", "left").select(
        "bucket", "node", "root", *extra, "outside", F.ceil(F.col("n_rest") / block).cast("int").alias("rests"), F.coalesce(F.ceil(F.col("n_main") / block), F.lit(0)).cast("int").alias("mains"))
    place = lambda n: F.pmod(F.xxhash64("node"), F.greatest(F.col(n), F.lit(1))).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    main_side = own.where("not outside").select("bucket", place("mains").alias("i"), upto("rests").alias("j"), F.lit(-1).alias("side"), "node", "root", *extra)
    other_side = own.where("outside and mains > 0").select("bucket", upto("mains").alias("i"), place("rests").alias("j"), F.lit(1).alias("side"), "node", "root", *extra)
    among = own.where("outside").withColumn("mine", place("rests")).withColumn("other", upto("rests"))
    among = among.select("bucket", (-1 - F.least("mine", "other")).alias("i"), F.greatest("mine", "other").alias("j"), F.signum(F.col("mine") - F.col("other")).cast("int").alias("side"), "node", "root", *extra)
    return main_side.unionByName(other_side).unionByName(among)


def _by_blocks(keyed: DataFrame, judge, schema: str) -> DataFrame:
    """What ``judge(key, rows)`` gives (a record batch) for the rows (side, root, items, size, origin, node) of each pair of blocks (bucket, i, j)."""
    spark = keyed.sparkSession
    shuffles = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def compare(batches):
        key, rows = None, []
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "i", "j", "side", "root", "size", "origin", "node")]
            items = batch.column("items")
            if pa.types.is_binary(items.type):
                own = items.to_pylist()
            else:
                off, flat = items.offsets.to_numpy(), items.values.to_numpy()
                own = [flat[a:b].copy() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            for k, (bucket, i, j, side, root, size, origin, node) in enumerate(zip(*cols)):
                if (bucket, i, j) != key:
                    if len(rows) > 1:
                        yield judge(key, rows)
                    key, rows = (bucket, i, j), []
                rows.append((side, bytes(root), own[k], size, origin, bytes(node)))
        if len(rows) > 1:
            yield judge(key, rows)

    origin = F.col("origin" if "origin" in keyed.columns else "bucket").alias("origin")
    return (keyed.select("bucket", "i", "j", "side", "root", "items", "size", origin, "node").repartition(shuffles, "bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j").mapInArrow(compare, schema))


def _block_links(dealt: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(ra, rb): links between components of a bucket."""
    def judge(key, rows):
        links = _connecting(rows, similarity)
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.binary()), pa.array([x[1] for x in links], pa.binary())], ["ra", "rb"])

    return _by_blocks(dealt.join(sets, "node").withColumn("size", F.size("items")), judge, "ra binary, rb binary")


def _possible_blocks(dealt: DataFrame, heads: DataFrame, similarity: int) -> DataFrame:
    """(bucket, i, j): the pairs of blocks in which heads leave a link possible."""
    def judge(key, rows):
        some = [key] if _may_link(rows[0][4], rows, similarity) else []
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in some], pa.int64()), pa.array([k[1] for k in some], pa.int32()), pa.array([k[2] for k in some], pa.int32())], ["bucket", "i", "j"])

    return _by_blocks(dealt.join(heads.select("node", F.col("head").alias("items"), F.col("n").alias("size")), "node"), judge, "bucket bigint, i int, j int")


def _near_members(dealt: DataFrame, marks: DataFrame, similarity: int) -> DataFrame:
    """The rows of ``dealt`` that parities leave a link to another component possible in their pair of blocks."""
    def judge(key, rows):
        left, right = (np.array([k for k, r in enumerate(rows) if r[0] in sides], np.int64) for sides in ((-1, 0), (0, 1)))
        some = []
        if len(left) and len(right):
            number = {root: k for k, root in enumerate({r[1] for r in rows})}
            root, n = (np.array([f(r) for r in rows], np.int64) for f in (lambda r: number[r[1]], lambda r: r[3]))
            near = _cells_apart([rows[k][2] for k in left], [rows[k][2] for k in right]) <= _most_apart(n[left][:, None], n[right][None, :], similarity)
            near &= root[left][:, None] != root[right][None, :]
            some = sorted({*left[near.any(axis=1)].tolist(), *right[near.any(axis=0)].tolist()})
        own = [rows[k] for k in some]
        return pa.RecordBatch.from_arrays([pa.array([x] * len(own), t) for x, t in zip(key, (pa.int64(), pa.int32(), pa.int32()))] +
                                          [pa.array([r[k] for r in own], t) for k, t in ((0, pa.int32()), (5, pa.binary()), (1, pa.binary()), (4, pa.int64()))], ["bucket", "i", "j", "side", "node", "root", "origin"])

    return _by_blocks(dealt.join(marks.select("node", F.col("parity").alias("items"), F.col("n").alias("size")), "node"), judge,
                      "bucket bigint, i int, j int, side int, node binary, root binary, origin bigint")


def _near(pairs: DataFrame, marks: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) that their parities leave possible."""
    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            apart = np.array([_cells_apart([x], [y])[0, 0] for x, y in zip(batch.column("parity_a").to_pylist(), batch.column("parity_b").to_pylist())], np.float64)
            yield batch.select(["a", "b"]).filter(pa.array(apart <= _most_apart(n, m, similarity)))

    side = lambda k: marks.select(*(F.col(c).alias(f"{c}_{k}") for c in ("node", "n", "parity"))).withColumnRenamed(f"node_{k}", k)
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "parity_a", "n_b", "parity_b").mapInArrow(run, "a binary, b binary")


def _of_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows whose ``node`` a bounded sketch of the staged ``nodes`` lets pass, before any shuffle; others may pass, too."""
    shared = rows.sparkSession.sparkContext.broadcast(sketch.build(nodes.select(F.xxhash64("node").alias("key")), "key", sketch.bits_for(8 * nodes.count())))

    def run(batches):
        found = shared.value
        for batch in batches:
            yield batch.filter(pa.array(found.met(batch.column("key").to_numpy().view(np.uint64))))

    keyed = rows.withColumn("key", F.xxhash64("node"))
    return keyed.mapInArrow(run, keyed.schema).drop("key")


def _possible(pairs: DataFrame, heads: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) that their heads leave possible."""
    side = lambda k: heads.select(*(F.col(c).alias(f"{c}_{k}") for c in ("node", "n", "head"))).withColumnRenamed(f"node_{k}", k)
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    need = F.ceil((F.col("n_a") + F.col("n_b")) * similarity / (100 + similarity))
    least = F.least(F.size("head_a") - F.col("n_a"), F.size("head_b") - F.col("n_b")) + need
    return both.where((need <= F.least("n_a", "n_b")) & (F.size(F.array_intersect("head_a", "head_b")) >= least)).select("a", "b")


def _merge(of: Staged, ends: DataFrame) -> Staged:
    """The roots (node, root) after joining components along the links ``ends`` (ra, rb) of roots."""
    links = Staged(ends.distinct(), "links")
    if links.df.isEmpty():
        links.drop()
        return of
    to = connected_components(links.df, "ra", "rb")
    merged = Staged(of.df.join(to.df.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
                    .select("node", F.coalesce("to", "root").alias("root")), "roots")
    for old in (of, to, links):
        old.drop()
    return merged


def crowded(members: DataFrame) -> Staged:
    """(bucket, node, label, n, hub, hub2): the members (bucket, node) of buckets with several.

    Of buckets of the same members one stays.  Where members come with a ``label``, the least
    of their buckets, two members of one label are looked at in the bucket that it names, and in
    no other; buckets that have only such pairs go.  Hubs are structs of node, label and, where
    members come with it, their set's ``size``.
    """
    labelled = "label" in members.columns
    own = members if labelled else members.withColumn("label", F.col("bucket"))
    one = F.struct("node", "label", *(["size"] if "size" in members.columns else []))
    full = own.groupBy("bucket").agg(F.count("*").alias("n"), F.min(one).alias("hub"), F.max(one).alias("hub2"),
                                     *([F.min("label").alias("l0"), F.max("label").alias("l1")] if labelled else
                                       [F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("node")).alias("x")])).where("n > 1")
    if labelled:
        full = full.where("l0 <> l1 or l0 = bucket").select("bucket", "n", "hub", "hub2")
    else:
        full = full.groupBy("n", "s", "x", "hub.node", "hub2.node").agg(F.min("bucket").alias("bucket"), F.min("hub").alias("hub"), F.min("hub2").alias("hub2")).select("bucket", "n", "hub", "hub2")
    return Staged(own.join(full, "bucket"), "buckets")


def _rooted(members: DataFrame, of: DataFrame, sizes: DataFrame) -> DataFrame:
    """(bucket, node, label, root, size) of the members (bucket, node, label): a node, however many buckets it is in, meets its root and size once."""
    own = members.groupBy("node").agg(F.collect_list(F.struct("bucket", "label")).alias("places"))
    return own.join(of, "node").join(sizes, "node").select("node", "root", "size", F.explode("places").alias("at")).select("at.bucket", "node", "at.label", "root", "size")


def components(buckets: Staged, fetch, similarity: int, block: int = BLOCK, rounds: int = ROUNDS, heads: DataFrame | None = None) -> Staged:
    """(node, root) of all nodes in ``buckets`` (see :func:`crowded`), which is dropped.  A link: 100 * shared >= similarity * united.

    ``fetch(nodes)`` gives the staged whole sets (node, items) of nodes.  ``heads`` (node, n, head), the
    first elements of every set in one order and its size, spare most whole sets of
    dissimilar members (:func:`least_shared`); with the column ``parity`` (:func:`parities`), these
    go first, and only what they leave possible sends heads.  ``rounds`` (0 to 2) hubs are tried before blocks are
    compared.  Neither changes the components.
    """
    nodes = buckets.df.select("node").distinct()
    of = Staged(nodes.select("node", F.col("node").alias("root")), "roots")
    parity = heads is not None and "parity" in heads.columns
    marks = Staged(_of_nodes(heads.select("node", "n", "parity"), of.df), "marks") if parity else None
    others, pairs = buckets.df, []
    for hub in ("hub", "hub2")[:rounds]:
        others = others.where(F.col("node") != F.col(f"{hub}.node"))
        here = (F.col("label") != F.col(f"{hub}.label")) | (F.col("label") == F.col("bucket"))
        if "size" in buckets.df.columns:  # sets of such sizes may link
            a, b = F.col("size"), F.col(f"{hub}.size")
            here = here & (F.least(a, b) * 100 >= F.greatest(a, b) * similarity)
        some = others.where(here).select(F.col("node").alias("a"), F.col(f"{hub}.node").alias("b")).distinct()
        if marks is not None:
            near = Staged(_near(some, marks.df, similarity), "near-pairs")
            some, known = near.df, _of_nodes(heads.drop("parity"), near.df.select(F.explode(F.array("a", "b")).alias("node")))
        else:
            known = heads
        pairs.append(Staged(some if heads is None else _possible(some, known, similarity), "pairs"))
        if marks is not None:
            near.drop()
    wanted = nodes
    if heads is not None:
        ends = [x.df.select(F.col(c).alias("node")) for x in pairs for c in ("a", "b")]
        wanted = functools.reduce(DataFrame.union, ends, nodes.limit(0)).distinct()
    sets = fetch(wanted)
    for k, found in enumerate(pairs):
        x = of.df.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        y = of.df.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        apart = found.df.join(x, "a").join(y, "b").where("ra <> rb").select("a", "b") if k else found.df
        of = _merge(of, _verified(apart, sets.df, similarity).join(x, "a").join(y, "b").select("ra", "rb"))
        found.drop()
    sizes = sets.df.select("node", F.size("items").alias("size")) if heads is None else heads.select("node", F.col("n").alias("size"))
    rooted = _rooted(others.where(F.col("n") > rounds + 1), of.df, sizes)
    # Members of one component, and those whose label names another bucket that they share, need not meet.
    part = F.when(F.col("label") == F.col("bucket"), F.col("root")).otherwise(F.col("label").cast("string").cast("binary"))
    rooted = rooted.withColumn("part", part)
    several = (rooted.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("part").alias("p0"), F.max("part").alias("p1"))
               .where("r0 <> r1 and p0 <> p1").select("bucket"))
    left = Staged(rooted.join(several, "bucket"), "apart")
    if not left.df.isEmpty():
        dealt = Staged(deal(left.df if heads is None else by_size(left.df, similarity), similarity, block), "dealt")
        if heads is None:
            of = _merge(of, _block_links(dealt.df, sets.df, similarity))
        else:
            if marks is not None:
                whole, dealt = dealt, Staged(_near_members(dealt.df, marks.df, similarity), "near-members")
                whole.drop()
                heads = _of_nodes(heads.drop("parity"), dealt.df)
            near = Staged(_possible_blocks(dealt.df, heads, similarity), "near-blocks")
            if not near.df.isEmpty():
                again = Staged(dealt.df.join(near.df, ["bucket", "i", "j"]), "dealt-again")
                more = fetch(again.df.select("node").distinct())
                of = _merge(of, _block_links(again.df, more.df, similarity))
                again.drop()
                more.drop()
            near.drop()
        dealt.drop()
    for old in (left, sets, buckets, *([marks] if marks is not None else [])):
        old.drop()
    return of


def component_ids(signed: DataFrame, of: Staged) -> DataFrame:
    """(doc_id, n_shingles, component_id) of rows (doc_id, n_shingles, digest): the smallest doc_id of the same root."""
    roots = of.df.select(F.col("node").alias("digest"), "root")
    known = signed.select("doc_id", "n_shingles", "digest").join(roots, "digest", "left").withColumn("root", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "digest")))
    spans = known.where("doc_id is not null and root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return known.join(spans, "root", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
