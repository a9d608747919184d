"""The size-aware similarity join against brute force, and what linking sends for hot buckets."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loglens.llm import jaccard, linking
from loglens.llm.tables import Staged
from loglens.llm.text import Words, shingles
from llm_brute import brute

SCHEMA = "doc_id bigint, text string, digest string, prefix int, items string, n int, node string, bucket int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "y", 2, "z", 3) for d, t in rows], SCHEMA).repartition(4)


def got(spark, rows, **options):
    return sorted((repr(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame(spark, rows), **options).collect())


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 5)))
    out, n = [], 0
    for size in [*range(9, 34), 40, 60, 90, 200]:      # sets just below, at and above the threshold
        base = [word() for _ in range(size + 2)]
        out.append((n, " ".join(base)))
        for cut in range(1, 4):
            out.append((n + cut, " ".join(base[:-cut])))
            changed = list(base)
            changed[0] = word()
            out.append((n + 3 + cut, " ".join(changed + [word() for _ in range(cut - 1)])))
        n += 10
    passage = [word() for _ in range(30)]              # in many texts
    out += [(5000 + k, " ".join(passage + [word() for _ in range(r.choice([1, 2, 40]))])) for k in range(40)]
    return out + [(6000, None), (6001, ""), (6002, " \n\t"), (6003, "one two"), (6004, "ONE\x0btwo"), (6005, "one"), (None, out[0][1]), (6006, out[0][1].upper()),
                  (6006, out[0][1].upper()), (6006, "one two")]


@pytest.mark.parametrize("options", [{}, {"limit": 0}, {"limit": 100}, {"limit": 12, "common": 5}, {"similarity": 75}, {"width": 1, "similarity": 60}])
def test_components_equal_brute_force(spark, rows, options):
    want = [x[:3] for x in brute(rows, options.get("width", 3), options.get("similarity", 90))]
    assert got(spark, rows, **options) == sorted(want)


def test_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, "a b c d"), (1, None)]) == sorted([("None", 2, None), ("1", 0, 1)])


@pytest.mark.parametrize("similarity", [60, 75, 80, 90])
def test_sizes_and_prefixes(similarity):
    for a in range(1, 60):
        linked = [b for b in range(1, 120) if any(100 * c >= similarity * (a + b - c) for c in range(min(a, b) + 1))]
        assert [b for b in linked if b != a or jaccard.need(a, a, similarity) < a] == jaccard.partners(a, similarity)
        for b in linked:
            least = next(c for c in range(min(a, b) + 1) if 100 * c >= similarity * (a + b - c))
            assert jaccard.need(a, b, similarity) == least
            assert a - least < jaccard.prefix_length(a, similarity)  # what is not shared does not fill the prefix


def test_subset_names_meet_exactly_for_links():
    r = random.Random(4)
    sets = [np.unique(np.array([r.randrange(2 ** 60) for _ in range(r.randint(8, 14))], np.uint64)) for _ in range(4)]
    sets += [np.unique(np.append(s[r.randint(0, 2):], np.array([r.randrange(2 ** 60) for _ in range(r.randint(0, 2))], np.uint64))) for s in sets * 6]
    names = [set(jaccard.subset_names(s, 80).tolist()) for s in sets]
    linked = 0
    for i, j in combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        link = 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)
        linked += link
        if not np.array_equal(sets[i], sets[j]):
            meet = bool(names[i] & names[j])
            assert meet or not link
            assert link or not meet or len(sets[i]) == len(sets[j])  # these may meet under another size's name
    assert linked


def test_prefix_puts_common_shingles_last():
    flat, off = shingles(Words(pa.array(["a b c d e f g h i j", "x y z", None])), 1)
    known = np.sort(flat[:3])
    first, ends = jaccard.first_in_order(flat, off, (known, np.array([7, 9, 8])), 50)
    assert ends.tolist() == [0, 6, 8, 8] and not set(first[:6].tolist()) & set(known.tolist())
    first, ends = jaccard.first_in_order(flat, off, (known, np.array([7, 9, 8])), 10)
    assert first[:10].tolist() == [*flat[3:10], known[0], known[2], known[1]]


def test_an_outsider_of_a_hot_bucket_costs_a_few_rows_a_member(spark):
    """One bucket of near copies, all of one component, and one outsider."""
    n = 100_000
    members = spark.range(n + 1).select(F.lit(7).cast("bigint").alias("bucket"), F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("node"),
                                        F.when(F.col("id") < n, F.lit(b"main")).otherwise(F.lit(b"other")).alias("part"), F.lit(b"r").alias("root"), (F.lit(100) + F.col("id") % 5).cast("int").alias("size"))
    dealt = linking.deal(members, 80, 256)
    assert n < dealt.count() < 2 * n
    blocks = dealt.groupBy("bucket", "i", "j").count()
    assert blocks.agg(F.max("count")).first()[0] < 600


def test_every_pair_of_components_meets(spark):
    r = random.Random(6)
    rows = [(b, f"n{b}-{k}".encode(), f"r{r.choice([0, 0, 0, 1, 2, k])}".encode(), b"r", 10) for b in range(4) for k in range(25)]
    dealt = linking.deal(spark.createDataFrame(rows, "bucket bigint, node binary, part binary, root binary, size int"), 80, 3).collect()
    met = set()
    cells = {}
    for x in dealt:
        cells.setdefault((x.bucket, x.i, x.j), []).append((x.side, bytes(x.node)))
    for (b, _, _), own in cells.items():
        met |= {(b, frozenset((p, q))) for s, p in own if s <= 0 for t, q in own if t >= 0}
    for b in range(4):
        own = [x for x in rows if x[0] == b]
        assert all((b, frozenset((p[1], q[1]))) in met for p, q in combinations(own, 2) if p[2] != q[2])


def test_block_links_connect_what_hubs_leave(spark):
    """Chains of sets in one bucket, most of them not similar to either hub."""
    sets = [(f"n{k:03d}".encode(), list(range(k * 3 + 1000 * (k // 20), k * 3 + 1000 * (k // 20) + 40))) for k in range(60)]
    heads_of = [(n, len(x), x[:len(x) - 32 + 1]) for n, x in sets]
    for rounds, heads in [(0, None), (1, None), (2, None), (0, 1), (1, 1), (2, 1)]:
        heads = heads and spark.createDataFrame(heads_of, "node binary, n bigint, head array<bigint>")
        stored = spark.createDataFrame(sets, "node binary, items array<bigint>")
        fetch = lambda nodes: Staged(stored.join(nodes, "node"), "test-sets")
        buckets = linking.crowded(spark.createDataFrame([(n, 1) for n, _ in sets], "node binary, bucket bigint"))
        roots = {}
        for x in linking.components(buckets, fetch, 80, 4, rounds, heads).df.collect():
            roots.setdefault(bytes(x.root), []).append(bytes(x.node))
        assert sorted(sorted(v) for v in roots.values()) == [[f"n{k:03d}".encode() for k in range(i, i + 20)] for i in (0, 20, 40)]


def test_heads_never_exclude_a_link():
    r = random.Random(8)
    for similarity in (60, 80, 90):
        for _ in range(300):
            a = sorted(r.sample(range(60), r.randint(1, 40)))
            b = sorted(set(a) - set(r.sample(a, min(len(a) - 1, r.randint(0, 3)))) | set(r.sample(range(60), r.randint(0, 3))))
            both = len(set(a) & set(b))
            if 100 * both >= similarity * (len(a) + len(b) - both):
                p, q = jaccard.prefix_length(len(a), similarity), jaccard.prefix_length(len(b), similarity)
                need, least = linking.least_shared(len(a), len(b), p, q, similarity)
                assert need <= both and least >= 1 and len(set(a[:p]) & set(b[:q])) >= least


def test_size_classes_let_all_meet_that_may_link(spark):
    sizes = list(range(1, 400))
    members = spark.createDataFrame([(5, f"n{k}".encode(), b"r", f"p{k}".encode(), k) for k in sizes], "bucket bigint, node binary, root binary, part binary, size int")
    for similarity in (80, 90):
        cells = {}
        for x in linking.by_size(members, similarity).collect():
            assert x.origin == 5
            cells.setdefault(x.bucket, []).append((x.size, bytes(x.part)))
        met = {frozenset((a, b)) for own in cells.values() for a, p in own for b, q in own if p != q}
        assert all(frozenset((a, b)) in met for a in sizes for b in range(a + 1, 400) if 100 * a >= similarity * b)
        assert len(met) < 399 * 398 // 4


@pytest.mark.parametrize("similarity", [60, 75, 90])
def test_linked_sets_have_a_part_in_common(similarity):
    r = random.Random(similarity)
    top = jaccard.tops(500, similarity)
    for a in range(1, 400):
        assert np.searchsorted(top, 100 * a // similarity) <= np.searchsorted(top, a) + 1
    linked = 0
    for n in [*range(1, 60), *range(60, 400, 9)]:
        for _ in range(4):
            a = {r.randrange(2 ** 62) for _ in range(n)}
            b = set(list(a)[:n - r.randint(0, n // 8)]) | {r.randrange(2 ** 62) for _ in range(r.randint(0, n // 8))}
            flat = np.concatenate([np.array(sorted(x), np.uint64) for x in (a, b)])
            names, ends = jaccard.part_names(flat, np.array([0, len(a), len(a) + len(b)]), similarity)
            if 100 * len(a & b) >= similarity * len(a | b):
                linked += 1
                assert set(names[:ends[1]].tolist()) & set(names[ends[1]:].tolist())
    assert linked > 50


def test_lists_of_dissimilar_sets_do_not_grow(spark):
    """Texts of one small vocabulary share many single shingles, but hardly a part."""
    r = random.Random(12)
    texts = [(k, " ".join(str(r.randrange(20)) for _ in range(200))) for k in range(400)]
    signed = jaccard.prefixed(frame(spark, texts), 3, 90, 0, (np.empty(0, np.uint64), np.empty(0, np.int64)), "doc_id", "text")
    met = lambda column: signed.select(F.explode(column).alias("b")).groupBy("b").count().where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    assert met("prefix") > 4000 and met("parts") < 100


def test_a_node_of_many_buckets_meets_its_root_once(spark):
    members = spark.range(400).select((F.col("id") % 40).alias("bucket"), F.concat(F.lit("n"), F.floor(F.col("id") / 40).cast("string")).cast("binary").alias("node"), F.lit(3).cast("bigint").alias("label"))
    nodes = members.select("node").distinct()
    rooted = linking._rooted(members, nodes.withColumn("root", F.lit(b"r")), nodes.withColumn("size", F.lit(8)))
    assert sorted((r.bucket, bytes(r.node)) for r in rooted.collect()) == sorted((r.bucket, bytes(r.node)) for r in members.collect())
    assert {(bytes(r.root), r.size, r.label) for r in rooted.collect()} == {(b"r", 8, 3)}
    plan = rooted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join Inner")  # the plan's root comes first: buckets are laid out after both joins


def test_parities_bound_the_difference():
    r = random.Random(5)
    sets = [np.unique(np.array([r.randrange(2 ** 62) for _ in range(n)], np.uint64)) for n in (0, 1, 7, 31, 33, 64, 300, 520, 6000)]
    sets += [np.unique(np.append(s[r.randint(0, 1 + len(s) // 9):], np.array([r.randrange(2 ** 62) for _ in range(r.randint(0, len(s) // 9))], np.uint64))) for s in sets * 3]
    parity = linking.parities(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    apart, near, linked = linking._cells_apart(parity, parity), 0, 0
    for i, j in combinations(range(len(sets)), 2):
        a, b = sets[i], sets[j]
        both = len(np.intersect1d(a, b))
        assert apart[i, j] <= len(a) + len(b) - 2 * both and linking._cells_apart([parity[i]], [parity[j]])[0, 0] <= len(a) + len(b) - 2 * both
        for similarity in (60, 90):
            if len(a) and len(b):
                may = linking._cells_apart([parity[i]], [parity[j]])[0, 0] <= linking._most_apart(len(a), len(b), similarity)
                assert may or 100 * both < similarity * (len(a) + len(b) - both)
                near, linked = near + may, linked + (100 * both >= similarity * (len(a) + len(b) - both))
    assert 0 < linked <= near < 3 * linked


def test_marks_let_lists_of_one_go_however_many_there_are(spark):
    """In 2 ** 16 cells a sketch of all entries would let most of the 400000 single ones pass."""
    rows = spark.range(400_000).select(F.xxhash64("id").cast("string").cast("binary").alias("node"), F.lit(9).cast("bigint").alias("n"),
                                       F.array(F.xxhash64("id"), F.xxhash64(F.lit(1), (F.col("id") / 2000).cast("int"))).alias("parts"))
    left = jaccard._not_alone(rows, "parts", 16)
    assert 400_000 <= left.count() < 402_000
    assert left.groupBy("bucket").count().where("count = 2000").count() == 200


def test_set_classes_are_distinct(spark):
    signed = jaccard.prefixed(frame(spark, [(k, f"a b c d {k % 7}") for k in range(40)] + [(50, "x y z"), (None, "q r s t"), (51, None)]), 3, 90, 20, (np.empty(0, np.uint64), np.empty(0, np.int64)), "doc_id", "text")
    got = jaccard.set_classes(signed).collect()
    assert sorted((r.doc_id, r.n) for r in got) == sorted([(k, 3) for k in range(7)] + [(50, 1)])
    assert len({bytes(r.node) for r in got}) == 8 and all(len(r["items"]) == r.n for r in got)
