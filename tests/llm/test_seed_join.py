"""Decontamination against all pairs of documents and items; short items, ids of any kind, long lists of items."""

import random

from kestrel.llm import decontamination as D

from . import brute
from .test_corpus import plain_alignment


def edited_copies(seed=3):
    rng = random.Random(seed)
    items = [(f"i{k}", brute.sentence(rng, rng.randint(8, 40))) for k in range(25)] + [("i3", brute.sentence(rng, 20)), (None, brute.sentence(rng, 15))]
    rows = [(k, brute.sentence(rng, rng.randint(5, 60)), "en", "s") for k in range(60)]
    for k in range(150):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randrange(1 + len(w) // 3)):
            at = rng.randrange(len(w))
            rng.choice([lambda: w.pop(at), lambda: w.insert(at, "more"), lambda: w.__setitem__(at, "other")])()
        rows.append((1000 + k, " ".join([brute.sentence(rng, 20), *w, brute.sentence(rng, 9)]), "en", "s"))
    return rows, items


def test_recall_against_all_pairs(spark):
    rows, items = edited_copies()
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = {}
    for d, text, *_ in rows:
        for i, item in items:
            a, b = brute.words(item), brute.words(text)
            score = plain_alignment(a, b) / (2 * len(a))
            if score >= 0.5:
                want[d, i] = max(score, want.get((d, i), 0))
    got = {(r["id"], r["item"]): r["score"] for r in D.contaminated(brute.frame(spark, rows), bench).collect()}
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want) and len(want) > 120
    assert sum(abs(got[k] - want[k]) < 1e-9 for k in got) >= 0.97 * len(got)
    parts = {(r["id"], r["item"]): r["score"] for r in D.contaminated(brute.frame(spark, rows), bench, block_words=1).collect()}
    assert parts == got


def test_short_items_inside_longer_texts(spark):
    bench = spark.createDataFrame([(1, "red fox"), (2, "Zebra"), (3, "a b"), (4, "one two three")], "item_id int, text string")
    rows = [(1, "x y z red fox z y x", "en", "s"), (2, "red\nFOX", "en", "s"), (3, "fox red zebras", "en", "s"), (4, "zebra", "en", "s"),
            (5, "q one two three q", "en", "s"), (6, "two", "en", "s")]
    got = {(r["id"], r["item"], r["score"], r["first_word"]) for r in D.contaminated(brute.frame(spark, rows), bench).collect()}
    assert got == {(1, 1, 1.0, 3), (2, 1, 1.0, 0), (4, 2, 1.0, 0), (5, 4, 1.0, 1)}
    assert {r["doc_id"] for r in D.drop_contaminated(brute.frame(spark, rows), bench).collect()} == {3, 6}


def test_maps_hold_every_hash(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(64) - (1 << 63) for _ in range(5000)] + [0, -1, 1, (1 << 63) - 1, -(1 << 63)]
    import numpy as np
    h = np.array(values, dtype=np.int64).view(np.uint64)
    bits = D.bit_map(spark.createDataFrame([(v,) for v in values], "h long"), "h")
    assert D.in_map(bits, h).all()
    assert D.in_map(bits, np.array([rng.getrandbits(64) for _ in range(5000)], dtype=np.uint64)).mean() < 0.01
    assert not D.bit_map(spark.createDataFrame([], "h long"), "h").any()
