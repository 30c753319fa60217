"""Decontamination, toxicity, quality, mixing, the pipeline, and what is registered."""

import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from kestrel.llm import decontamination, mixing, quality, toxicity
from kestrel.llm.queries import ORACLE_SQL, QUERIES

from . import brute


def plain_alignment(item, text):
    best, up = 0, [0] * (len(text) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, up[j] + (2 if a == b else -1), up[j + 1] - 1, row[-1] - 1))
        best, up = max(best, max(row)), row
    return best


def test_alignment_equals_the_table():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 25))
        score, start, stop = decontamination.align(a, b)
        assert score == plain_alignment(a.tolist(), b.tolist())
        if score:
            assert plain_alignment(a.tolist(), b[start:stop].tolist()) == score


def test_copies_and_edited_copies_of_items(spark):
    rng = random.Random(6)
    items = [(k, brute.sentence(rng, 30)) for k in range(12)] + [(50, "short one"), (51, None), (52, ""), (None, "x y z w")]
    rows = brute.unique_ids(brute.documents())
    w = items[3][1].split()
    edited = " ".join(x if k % 6 else "edit" for k, x in enumerate(w))
    rows += [(300, "before " + items[0][1] + " after", "en", "s"), (301, "lead " + edited + " tail", "en", "s"), (302, "Short ONE", "en", "s"),
             (303, " ".join(items[5][1].split()[:8]), "en", "s")]
    frame, bench = brute.frame(spark, rows + rows[-4:-3]), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(frame, bench).collect()
    assert {(r["id"], r["item"]) for r in got} == {(300, 0), (301, 3), (302, 50)}
    assert next(r for r in got if r["id"] == 300)["score"] == 1.0 and (r := next(r for r in got if r["id"] == 300))["stop_word"] - r["first_word"] == 30
    blocks = decontamination.contaminated(frame, bench, block_words=40).collect()  # a few items at a time
    assert sorted(map(str, blocks)) == sorted(map(str, got))
    left = decontamination.drop_contaminated(frame, bench)
    assert left.columns == frame.columns and left.count() == len(rows) - 3
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(frame, none).count() == 0 and decontamination.drop_contaminated(frame, none).count() == len(rows) + 1
    assert decontamination.contaminated(brute.frame(spark, []), bench).count() == 0


def labelled(spark, n=400, seed=7):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        bad = rng.random() < 0.3
        w = brute.sentence(rng, 25).rstrip(".").split()
        if bad:
            w.insert(rng.randrange(len(w)), rng.choice(["idiot!", "SCUM", "moron"]))
            if rng.random() < 0.5:
                w.insert(rng.randrange(len(w)), "muslims")
        elif rng.random() < 0.1:
            w.insert(rng.randrange(len(w)), "christians")
        rows.append((k, " ".join(w), "en", "s"))
        labels.append((k, int(bad)))
    return brute.frame(spark, rows), spark.createDataFrame(labels + [(9999, 1), (None, 1), (1, None)], "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy(spark):
    docs, labels, truth = labelled(spark)
    got = {r["id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    out = [k for k in got if zlib.crc32(str(k).encode()) % 4 == 2]
    assert all(got[k]["held_out"] == (k in set(out)) for k in got)
    assert sum(got[k]["predicted"] == truth[k] for k in out) >= 0.97 * len(out)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k in got if got[k]["predicted"] == 0}


def test_counterfactuals_spare_neutral_mentions(spark):
    docs, labels, _ = labelled(spark)
    sample = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic", 20_000)
    found = np.sort(np.array([toxicity._word_hash("muslims")], dtype=np.uint64))
    with_pull = toxicity.fit(sample, toxicity.Fit(counterfactual=1.0)).score(found)
    without = toxicity.fit(sample, toxicity.Fit(counterfactual=0.0)).score(found)
    assert with_pull < without


def test_toxicity_of_odd_rows(spark):
    _, labels, _ = labelled(spark)
    frame = brute.frame(spark)
    got = toxicity.toxicity(frame, labels).collect()
    assert len(got) == frame.count() and all(0 <= r["score"] <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity(frame, none).collect()} == {0.5}
    assert toxicity.toxicity(brute.frame(spark, []), labels).count() == 0


def oracle(spark, name, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    return sorted((tuple(sorted(zip(names, r))) for r in cur.fetchall()), key=repr)


@pytest.mark.parametrize("rows", [brute.documents(), []], ids=["odd", "empty"])
def test_quality_and_mixing_equal_their_sql(spark, rows):
    frame = brute.frame(spark, rows)
    for name, got in (("op8_adaptive_quality", quality.quality_filter(frame)), ("op10_low_discrepancy_mix", mixing.mix_sources(frame))):
        got = got.withColumnRenamed("id", "doc_id")
        assert sorted((tuple(sorted(r.asDict().items())) for r in got.collect()), key=repr) == oracle(spark, name, rows)


def test_mix_meets_its_targets(spark):
    rng = random.Random(8)
    rows = [(k, brute.sentence(rng, rng.randint(1, 400)), "en", rng.choice(["a", "a", "a", "b", "c", None])) for k in range(300)]
    got = mixing.mix_sources(brute.frame(spark, rows), block=16).collect()
    taken = {}
    for r in got:
        assert r["size"] == len(brute.words(rows[r["id"]][1])) and r["taken"] <= 2 * r["size"]
        assert r["target"] <= 2 * r["source_size"] + 1e-6
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(taken[r["source"]] == int(r["target"]) for r in got)
    assert abs(sum(taken.values()) - 1.5 * sum(r["size"] for r in got)) <= len(taken)


def test_schedule_keeps_to_the_targets_all_along(spark):
    plan = spark.createDataFrame([(("a",), 50_000, 60_000.0), (("b",), 40_000, 30_000.0), (("c",), 3_000, 500.0)],
                                 "skey struct<name:string>, source_size long, target double")
    rows = mixing.schedule(plan, 100).orderBy("slot").collect()
    part = [r["skey"]["name"] for r in rows[:400]]
    for n in (50, 100, 200, 400):
        assert abs(part[:n].count("a") / n - 600 / 905) < 0.05


def test_quality_drops_what_lies_outside(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(brute.sentence(rng, 12) for _ in range(6)), "en", "s1") for k in range(200)]
    rows += [(500, " ".join(w + "***" for w in brute.words(rows[0][1])), "en", "s1"), (501, "too few words", "en", "s1"),
             (502, " ".join(["again and again"] * 40), "en", "s1"), (503, re.sub(r"\w+", "internationalisation", rows[1][1], count=60), "en", "s1")]
    got = {r["id"]: r for r in quality.quality_filter(brute.frame(spark, rows)).collect()}
    assert all(got[k]["kept"] for k in range(200)) and not any(got[k]["kept"] for k in (500, 501, 502))
    assert got[502]["base_failed"] and got[501]["base_failed"] and not got[500]["base_failed"]


def test_native_plans_have_no_python(spark, sf_small):
    for name in ("op8_adaptive_quality", "op10_low_discrepancy_mix"):
        plan = QUERIES[name](spark, sf_small)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_stages_and_registration(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "mixing"]
    for n in range(1, 11):
        assert [q for q in E.queries() if q.startswith(f"op{n}_")]
    assert set(ORACLE_SQL) <= set(QUERIES) and E.queries().keys() >= {"pipeline"}


def test_stages_on_odd_documents(spark, tmp_path):
    spark.createDataFrame([(k, int(k % 12 == 5)) for k in range(60)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    item = "\n".join(brute.documents()[7][1].split("\n")[:1])
    spark.createDataFrame([(1, brute.sentence(random.Random(1), 30)), (2, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = brute.frame(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        assert 0 < out.count() <= docs.count()
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        docs = corpus_pipeline.written(out, name)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.count() == docs.count()
