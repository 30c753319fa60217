"""Bootstrapped contexts against a plain version, planted identifiers of unseen forms, order of spans, bytes that are no text."""

import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import pii, queries

from . import brute
from .test_texts import plain_spans

PARTS = re.compile(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+")


def plain_patterns(texts, rounds=3, support=3, confidence=0.6):
    """{(kind, words): confidence}, from spans, contexts and scores worked out one by one."""
    edges = defaultdict(bool)
    for text in set(texts):
        for kind, a, b, seed in pii.marked(text):
            left, right = [x.lower() for x in PARTS.findall(text[:a])][-2:], [x.lower() for x in PARTS.findall(text[b:])][:2]
            names = [f"{left[0]} {left[1]} _"] if len(left) == 2 else []
            names += [f"{left[-1]} _ {right[0]}"] if left and right else []
            names += [f"_ {right[0]} {right[1]}"] if len(right) == 2 else []
            for x in names:
                edges[x, kind, text[a:b].lower()] |= seed
    n = defaultdict(int)
    for x, _, _ in edges:
        n[x] += 1
    found = {}
    for r in range(rounds):
        wrong = defaultdict(lambda: 1.0)
        for (x, kind, inst), seed in edges.items():
            if not seed and (kind, x) in found:
                wrong[kind, inst] *= max(1e-9, 1 - found[kind, x])
        score, seeds = defaultdict(float), defaultdict(int)
        for (x, kind, inst), seed in edges.items():
            score[kind, x] += 1.0 if seed else 1 - wrong[kind, inst] if r else 0.0
            seeds[kind, x] += seed
        found = {k: v / (n[k[1]] + 1) for k, v in score.items() if seeds[k] >= support and v / (n[k[1]] + 1) >= confidence}
    return found


def planted(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, hidden = [], {}
    say = ["{} please write to {} for {} help", "the number to call is {} any day {} {}", "{} paid by card {} on {}"]
    for k in range(90):
        form = k % 3
        value = [f"u{k}@mail{k % 7}.org", f"+49 30 1234{k:03d}", "4111 1111 1111 1111"][form]
        args = [value, word(), word()] if form == 1 else [word(), value, word()]
        rows.append((k, say[form].format(*args), "en", "s"))
    for k in range(40):  # the same contexts, and identifiers without any of the forms
        form = k % 2
        value = ["Office-%d" % k, "ext%04d" % k][form]
        text = say[form].format(*([value, word(), word()] if form else [word(), value + ",", word()]))
        rows.append((200 + k, "é " + text, "en", "s"))
        hidden[200 + k] = ("email" if form == 0 else "phone", text.index(value) + 2, text.index(value) + 2 + len(value))
    for k in range(60):  # identifier-like words in other contexts, and plain words in a context that seeds share
        rows.append((400 + k, f"{word()} flight LH{k:03d} to {word()} gate {word()} and we talked about {word()} today", "en", "s"))
        rows.append((500 + k, f"we talked about {'me%d@x.org' % k if k % 4 == 0 else word()} today at length", "en", "s"))
    rows.append((600, "we talked about room-12 today", "en", "s"))
    return rows, hidden


def test_patterns_equal_the_plain_version(spark):
    rows, _ = planted()
    docs = brute.frame(spark, rows).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), "text")
    got = {(r["kind"], r["words"]): r["confidence"] for r in pii.bootstrap(pii.occurrences(docs)).collect()}
    want = plain_patterns([r[1] for r in rows])
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(want) >= 8


def test_planted_identifiers_are_found(spark):
    rows, hidden = planted()
    got = {r["id"]: r for r in pii.find_pii(brute.frame(spark, rows)).collect()}
    found = {(i, x) for i, r in got.items() for x in r["added"].split(",") if x}
    want = {(i, f"context_{k}:{a}:{b}") for i, (k, a, b) in hidden.items()}
    recall, precision = len(found & want) / len(want), len(found & want) / max(1, len(found))
    assert recall >= 0.95 and precision >= 0.95
    assert got[600]["added"] == ""  # its slot mostly holds plain words


def test_spans_are_listed_by_kind_and_start(spark, tmp_path):
    rows, hidden = planted()
    rows.append((700, "x please write to Office-7 for it, or to a@b.org, or call +49 30 1234567 or 10.0.0.1, or please write to Desk-9 for it", "en", "s"))
    brute.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op3_bootstrapped_pii(spark, str(tmp_path)).collect():
        spans = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in r["spans"].split(",") if x)]
        assert spans == sorted(spans)
        text = next(x[1] for x in rows if x[0] == r["doc_id"])
        base = {(pii.KINDS.index(k), *s) for k, v in plain_spans(text).items() for s in v}
        assert base <= set(spans)
        if r["doc_id"] == 700:
            assert [text[a:b] for _, a, b in spans] == ["Office-7", "a@b.org", "Desk-9", "10.0.0.1", "+49 30 1234567"]


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF20783140622E6F726720C3') AS string) AS text")
    r = pii.find_pii(docs).first()
    assert r["n_email"] == 1 and r["spans"] == "email:3:11"


def test_places_of_words():
    raw = "Müller, x-1 ünd".encode()
    around = pii.Around.of(raw)
    left, right = around.sides(np.array([raw.index(b"x-1")]), np.array([raw.index(b"x-1") + 3]))
    assert around.names(int(left[0]), int(right[0])) == [" müller _", "müller _ ünd", "_ ünd "]
