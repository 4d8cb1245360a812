import random

import numpy as np
import pytest
import xxhash

from facetry.llm import near_copies, near_dup
from tests.llm.fixtures import TEXTS, docs, words


def print_of(t):
    w = [x for x in (t or "").translate({c: c + 32 for c in range(65, 91)}).replace("\n", " ").replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(ids, fps, radius=3):
    lead = list(range(len(ids)))

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                lead[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return {x: least[find(i)] for i, x in enumerate(ids)}


def test_matches_brute_force(spark):
    rng = random.Random(3)
    long = [words(rng, 900) for _ in range(6)]
    texts = TEXTS + long + [t.replace("w7 ", "w8 ", 1) for t in long] + [t + " tail" for t in long for _ in range(2)] + [words(rng, 30) for _ in range(60)]
    got = near_dup.components(docs(spark, texts)).collect()
    ids, fps = list(range(10, 10 + len(texts))), [print_of(t) for t in texts]
    assert {r.doc_id: r.fp & (2**64 - 1) for r in got} == dict(zip(ids, fps))
    assert {r.doc_id: r.component_id for r in got} == components_of(ids, fps)


@pytest.mark.parametrize("parts,radius", [(2, 3), (3, 3), (4, 5), (1, 1)])
def test_links_connect_what_is_near(spark, parts, radius):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base[:20].tolist():  # dense groups and chains
        for _ in range(60):
            b ^= sum(1 << int(x) for x in rng.choice(64, int(rng.integers(1, radius + 1)), replace=False))
            fps.add(b)
    fps = sorted(fps)
    sign = [x - 2**64 if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in sign], "fp long")
    edges = near_dup.links(df, radius, parts).collect()
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= radius for r in edges)
    lead = {x: x for x in sign}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for r in edges:
        a, b = find(r.a), find(r.b)
        lead[max(a, b)] = min(a, b)
    want = components_of(sign, fps, radius)
    assert {x: find(x) for x in sign} == want


def test_allocation_covers_radius():
    rng = np.random.default_rng(0)
    bits = rng.random((500, 64)) < np.linspace(0.02, 0.5, 64)
    both = bits.T.astype(float) @ bits
    for parts in (1, 2, 3, 4):
        dealt = near_dup.group_bits(500, both, parts)
        assert sorted(b for p in dealt for b in p) == list(range(64))
        for radius in (0, 1, 3, 6):
            t = near_dup.allocate(500, both, dealt, radius)
            assert sum(x + 1 for x in t) == radius + 1 and all(x >= -1 for x in t)


def test_large_group_is_cut_exactly(monkeypatch):
    monkeypatch.setattr(near_dup, "_LARGE", 50)
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 2**24, 400, dtype=np.uint64) | np.uint64(7 << 40))
    fps = np.unique(np.concatenate([fps, fps ^ np.uint64(1 << 5), fps[:100] ^ np.uint64(3)]))
    lead = {int(x): int(x) for x in fps}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for a, b in near_dup.connect(fps, 3):
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = find(x), find(y)
            lead[max(x, y)] = min(x, y)
    assert {x: find(x) for x in lead} == components_of([int(x) for x in fps], [int(x) for x in fps])


def test_nulls_repeats_and_empty(spark):
    got = near_dup.components(docs(spark, ["", None, "same text here", "same text here", "x y z"], [5, 5, None, 4, None])).collect()
    assert len(got) == 5
    assert sorted((r.doc_id is None, r.component_id) for r in got if r.component_id is not None) == [(False, 4), (False, 5), (False, 5), (True, 4)]
    assert near_dup.components(docs(spark, [])).count() == 0


def _near(rng, t, share):
    w = t.split()
    for i in rng.sample(range(len(w)), max(1, int(len(w) * share))):
        w[i] = f"edit{rng.randint(0, 10**6)}"
    return " ".join(w)


def _jaccard(a, b):
    a, b = (set(zip(*(t.split()[i:] for i in range(5)))) for t in (a, b))
    return len(a & b) / len(a | b)


def test_near_copies(spark):
    rng = random.Random(5)
    base = [words(rng, rng.choice((60, 200, 1500)), 5000) for _ in range(150)]
    near = [_near(rng, t, 0.008) for t in base]
    other = [words(rng, 120, 5000) for _ in range(100)]
    shared = words(rng, 60, 5000)
    passages = [words(rng, 150, 5000) + " " + shared for _ in range(60)]
    texts = base + near + other + passages + base[:30]
    d = docs(spark, texts)
    kept = near_copies.keep_one(d)
    assert kept.columns == d.columns
    left = {r.doc_id - 10 for r in kept.collect()}
    similar = [i for i in range(150) if _jaccard(base[i], near[i]) >= 0.8]
    missed = [i for i in similar if 150 + i in left]
    assert len(similar) > 100 and len(missed) <= 0.05 * len(similar)
    assert set(range(150)) | set(range(300, 460)) <= left and not left & set(range(460, 490))


def test_near_copies_are_exact(spark):
    rng = random.Random(9)
    base, below, above = [], [], []
    for n in (24, 30, 60, 130, 200, 460, 520) * 15:
        t = words(rng, n, 5000)
        for texts, share in ((below, 0.72 + 0.07 * rng.random()), (above, 0.8)):
            r = int((n - 4) * (1 - share) / (1 + share)) + (texts is below)
            texts.append(" ".join(t.split()[: n - r]) + " " + words(rng, r, 5000))
        base.append(t)
    assert max(map(_jaccard, base, below)) < 0.8 <= min(map(_jaccard, base, above))
    n = len(base)
    for texts, want in ((below, range(10, 10 + 2 * n)), (above, range(10, 10 + n))):
        for group_terms in (1_000_000, 300):
            kept = near_copies.keep_one(docs(spark, base + texts), group_terms=group_terms)
            assert sorted(r.doc_id for r in kept.collect()) == list(want)


def test_near_copies_edges(spark):
    got = near_copies.keep_one(docs(spark, TEXTS + ["one", "one", None, "again", "again"], [*range(10, 10 + len(TEXTS)), 3, None, None, 7, 7]))
    ids = [r.doc_id for r in got.collect()]
    assert ids.count(None) == 2 and ids.count(7) == 1 and 3 in ids and 13 not in ids and 15 not in ids and sum(i in (10, 11, 12) for i in ids) == 1
    assert near_copies.keep_one(docs(spark, [])).count() == 0


def test_one_id_on_two_texts(spark):
    rng = random.Random(12)
    a, b, c = (words(rng, 80, 5000) for _ in range(3))
    got = near_copies.keep_one(docs(spark, [a, a + " end", b, c, c, b + " end"], [1, 9, 9, 4, 4, 2])).collect()
    # the copies of a and b under the larger id go, and one of two equal rows
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(1, a), (2, b + " end"), (4, c)])
    other = near_copies.keep_one(docs(spark, [a, a + " end", b], [1, 9, 9])).collect()
    assert sorted((r.doc_id, r.text) for r in other) == sorted([(1, a), (9, b)])


def test_large_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "_LARGE", 20)
    rng = random.Random(13)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 6))) for _ in range(300)})
    sign = [x - 2**64 if x >> 63 else x for x in fps]
    lead = {x: x for x in sign}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for r in near_dup.links(spark.createDataFrame([(x,) for x in sign], "fp long")).collect():
        a, b = find(r.a), find(r.b)
        lead[max(a, b)] = min(a, b)
    assert {x: find(x) for x in sign} == components_of(sign, fps)


def test_large_groups_meet_in_blocks(spark):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    rows = spark.createDataFrame([(1, 50, i) for i in range(50)] + [(2, 7, 100 + i) for i in range(7)], "key long, n long, node long")
    got = near_copies.block_groups(rows, 10).groupBy("key").agg(F.collect_list("node").alias("ids")).collect()
    assert max(len(set(r.ids)) for r in got) < 20
    assert {(a, b) for r in got for a in r.ids for b in r.ids if a < b} == {(a, b) for x in (range(50), range(100, 107)) for a in x for b in x if a < b}
    base = words(rng, 300, 5000)
    d = docs(spark, [base] + [_near(rng, base, 0.004) for _ in range(80)] + [words(rng, 100, 5000) for _ in range(20)])
    assert sorted(r.doc_id for r in near_copies.keep_one(d, group_rows=8).collect()) == sorted(r.doc_id for r in near_copies.keep_one(d).collect()) == [10, *range(91, 111)]


def test_components_helper(spark):
    from facetry.operators.graph import connected_components

    rng = random.Random(6)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000, 2000 + i) for i in range(50)] + [(5000 + i, 5001 + i) for i in range(64)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    lead = {x: x for e in edges for x in e}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        lead[max(a, b)] = min(a, b)
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_near_copies_by_fingerprints_alone(spark, monkeypatch):
    """near_dup's search by itself finds what differs in three bits at most."""
    rng = random.Random(12)
    words = [[f"w{rng.randrange(5000)}" for _ in range(800)] for _ in range(6)]
    texts = [" ".join(w) for w in words] + [" ".join([*w[:-1], "other"]) for w in words]
    monkeypatch.setattr(near_copies, "near_copy_links", lambda distinct, *_: spark.createDataFrame([], "a long, b long"))
    assert {r.doc_id for r in near_copies.keep_one(docs(spark, texts, [*range(12)])).collect()} == set(range(6))
