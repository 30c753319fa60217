import random

import numpy as np
import pytest

from kestrel.llm import jaccard, words as W
from kestrel.llm.components import components
from kestrel.llm.jaccard import Similarity, jaccard_join, keep_one_of_each, scheme, signatures

from . import brute


@pytest.mark.parametrize("sim", [Similarity(3, 90, 100), Similarity(5, 80, 100)])
def test_links_and_components_equal_all_pairs(spark, sim):
    rows = brute.unique_ids(brute.documents())
    got = {r["id"]: (r["n_shingles"], r["n_links"], r["component"]) for r in jaccard_join(brute.frame(spark, rows), sim=sim).collect()}
    assert got == {a: tuple(x) for a, *x in brute.jaccard(rows, sim.n, sim.num, sim.den)}


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("sim", [Similarity(3, 90, 100), Similarity(5, 80, 100)])
def test_components_without_counts(spark, sim, small, monkeypatch):
    """Also where groups and clusters are dealt to chunks and blocks, with copies, near copies and strays in them."""
    if small:
        monkeypatch.setattr(jaccard, "GROUP", 3)
        monkeypatch.setattr(jaccard, "BLOCK_SETS", 2)
        monkeypatch.setattr(jaccard, "FLUSH", 500)
    rng, rows = random.Random(3), brute.unique_ids(brute.documents())
    base = " ".join(brute.sentence(rng, 12) for _ in range(12)).split()
    for k in range(60):  # a family with more and more edits: chains of links
        w = list(base)
        for _ in range(k // 4):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(9)}"
        rows.append((1000 + k, " ".join(w), "en", "s"))
    rows += [(2000 + k, " ".join(base[:90] + [f"other{k}x{i}" for i in range(60)]), "en", "s") for k in range(12)]  # a shared passage
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in jaccard_join(brute.frame(spark, rows).repartition(5), sim=sim, count_links=False).collect()}
    assert got == {a: (n, c) for a, n, _, c in brute.jaccard(rows, sim.n, sim.num, sim.den)}


def made_groups():
    rng = random.Random(5)
    want, rows = {}, []
    for sig in range(300):
        members = sorted({rng.randrange(-60, 60) for _ in range(rng.choice([1, 1, 2, 3, 9, 40]))})
        want[sig] = members
        while members:
            k = rng.randint(1, len(members))
            rows.append((sig, members[0], np.array(members[1:k], dtype=np.int64).tobytes()))
            members = members[k:] if rng.random() < 0.7 or k < 2 else members[k - 1:]  # sent twice by two tasks
    return want, rows


@pytest.mark.parametrize("limit", [4, 4096])
def test_groups_equal_the_plain_version(spark, limit, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", limit)
    want, rows = made_groups()
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        got = jaccard.signature_groups(spark.createDataFrame(rows, "sig long, digest long, more binary")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    found = {}
    for r in got:
        found.setdefault(r["gid"], set()).add(r["digest"])
    # each list of members once; a list in chunks once for each signature
    assert {tuple(sorted(x)) for x in found.values()} == {tuple(m) for m in want.values() if len(m) > 1}
    assert all(r["chunk"] < 0 for r in got) == (limit == 4096)
    sizes = {}
    for r in got:
        sizes[r["gid"], r["chunk"]] = sizes.get((r["gid"], r["chunk"]), 0) + 1
    assert max(sizes.values()) <= limit


def test_odd_rows(spark):
    rows = brute.documents()
    got = jaccard_join(brute.frame(spark, rows), sim=Similarity(3, 90, 100)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["id"], []).append(r)
    assert [r["n_links"] for r in by[0]] == [2, 2, 2]  # a row that comes three times
    assert all(r["component"] == i and r["n_shingles"] == 0 for i in (100, 101, 102) for r in by[i])
    assert by[103][0]["component"] == by[104][0]["component"] == 103  # one word, other case
    assert len(by[7]) == 2 and len({r["n_shingles"] for r in by[7]}) == 2


def test_empty(spark):
    assert jaccard_join(brute.frame(spark, [])).count() == 0
    assert keep_one_of_each(brute.frame(spark, [])).count() == 0


@pytest.mark.parametrize("sim", [Similarity(3, 90, 100), Similarity(5, 80, 100)])
def test_similar_sets_share_a_signature(sim):
    rng = np.random.default_rng(1)
    bands = sim.bands(1 << 16)
    for _ in range(300):
        n = int(rng.integers(4, 700))
        a = np.unique(W.mix(rng.integers(0, 1 << 62, n).astype(np.uint64)))
        # as far apart as the similarity allows: drop some, add some
        out = int(rng.integers(0, n * (sim.den - sim.num) // sim.den + 1))
        b = a[np.sort(rng.permutation(len(a))[out:])]
        while True:
            c = np.unique(np.append(b, W.mix(rng.integers(0, 1 << 62, 1).astype(np.uint64))))
            if sim.den * (len(a) - out) < sim.num * (len(a) + len(c) - (len(a) - out)):
                break
            b = c
        if out == 0 and len(a) == len(b) or sim.den * (len(a) - out) < sim.num * (len(b) + out):
            continue
        assert len(np.intersect1d(signatures(a, sim, bands), signatures(b, sim, bands)))


def test_scheme_leaves_a_whole_group():
    for sim in (Similarity(3, 90, 100), Similarity(5, 80, 100)):
        for k in range(1, 500):
            s = scheme(k, sim)
            assert (s.groups - s.spare) * (s.out + 1) > k


def test_one_document_of_each_group_stays(spark):
    rows = brute.documents()
    sim = Similarity(3, 90, 100)
    frame = brute.frame(spark, rows)
    kept = keep_one_of_each(frame, sim=sim)
    assert kept.columns == frame.columns
    left = kept.collect()
    again = jaccard_join(kept, sim=sim).collect()
    assert all(r["n_links"] == 0 for r in again)
    unique = brute.unique_ids(rows)
    stay = {a for a, n, _, c in brute.jaccard(unique, 3, 90, 100) if n == 0 or a == c}
    assert {r["doc_id"] for r in left} - {None} >= stay
    assert sum(r["doc_id"] == 0 for r in left) <= 1 and sum(r["text"] is None for r in left) == 2


def test_components_of_random_links(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)]
    parts = brute.Parts()
    for a, b in edges:
        parts.join(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: parts.find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_counts_never_exceed_the_difference():
    """Sets of any two sizes, near and far: the filter keeps every pair that may be linked."""
    rng = np.random.default_rng(4)
    fresh = lambda n: W.mix(rng.integers(0, 1 << 62, n).astype(np.uint64))
    sets = []
    for size in (3, 200, 1100, 5000, 20_000, 70_000):
        base = np.unique(fresh(size))
        for share in (1.0, 0.9, 0.4):
            sets.append(np.unique(np.concatenate([base[rng.random(len(base)) < share], fresh(int(size * (1 - share)))])))
    crowded = np.unique(fresh(9000) >> np.uint64(5))  # all in the first parts of the domain
    sets += [crowded, crowded[50:], crowded[: len(crowded) // 8]]
    counts = jaccard.Counts([jaccard.counted(x) for x in sets])
    x, y = (np.array(v) for v in zip(*[(i, j) for i in range(len(sets)) for j in range(i)]))
    real = np.array([len(np.setxor1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(x, y)])
    assert (counts.apart(x, y) <= real).all()
    assert (np.abs(counts.coarse()[x] - counts.coarse()[y]).sum(axis=1) <= real).all()


@pytest.mark.parametrize("size", [300, 5000, 30_000])
def test_counts_part_long_sets_that_share_half(size):
    rng, sim = np.random.default_rng(6), Similarity(5, 80, 100)
    fresh = lambda n: W.mix(rng.integers(0, 1 << 62, n).astype(np.uint64))
    shared = fresh(size // 2)
    sets = [np.unique(np.concatenate([shared, fresh(size // 2)])) for _ in range(20)]
    near = [np.unique(np.concatenate([sets[0][size // 20:], fresh(size // 20)]))]
    n = np.array([len(x) for x in sets + near])
    far = np.zeros(len(n), dtype=bool)
    found = jaccard.near_pairs(np.array([0]), far, far, n, [jaccard.counted(x) for x in sets + near], sim)
    assert found == [(0, 20)]
