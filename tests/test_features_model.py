"""Folds, class weights, one-hot, exact AUC and the forest pipeline against brute force."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from kestrel.operators import features, model


def brute_folds(labels, k=5):
    """Unshuffled stratified assignment: classes by first appearance, sorted labels dealt round
    robin into k folds gives each fold's share of every class; rows of a class fill folds in order."""
    order = []
    for y in labels:
        if y not in order:
            order.append(y)
    enc = [order.index(y) for y in labels]
    sorted_enc = sorted(enc)
    share = [[0] * len(order) for _ in range(k)]
    for pos, c in enumerate(sorted_enc):
        share[pos % k][c] += 1
    folds, seen = [], [0] * len(order)
    for c in enc:
        r, f = seen[c], 0
        while r >= share[f][c]:
            r -= share[f][c]
            f += 1
        folds.append(f)
        seen[c] += 1
    return folds


def test_stratified_folds_match_brute_force(spark):
    rnd = random.Random(4)
    for n, p1 in ((103, 0.3), (57, 0.5), (12, 0.2)):
        labels = [1 if rnd.random() < p1 else 0 for _ in range(n)]
        labels[0] = 1  # class 1 appears first
        df = spark.createDataFrame(list(enumerate(labels)), "pos long, y int")
        got = [r["fold"] for r in features.stratified_folds(df, "y", "pos", 5, "fold").orderBy("pos").collect()]
        assert got == brute_folds(labels)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    got = {r["y"]: r["weight"] for r in features.balanced_class_weights(df, "y").collect()}
    assert got == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}
    m = features.ClassWeighter(labelCol="y", weightCol="w").fit(df)
    assert {r["y"]: r["w"] for r in m.transform(df).collect()} == got


def test_one_hot_unknown_and_null_are_zero(spark):
    train = spark.createDataFrame([("en",), ("fr",), ("en",)], "lang string")
    enc = features.fit_one_hot(train, "lang")
    out = enc.transform(spark.createDataFrame([("en",), ("fr",), ("de",), (None,)], "lang string"))
    assert out.columns == ["lang", "lang_en", "lang_fr"]
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0), (0, 1), (0, 0), (0, 0)]


def test_imputers(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (3.0, "b"), (10.0, "b"), (None, "a")], "x double, s string")
    m = features.ExactMedianImputer(inputCols=["x"], outputCols=["x2"]).fit(df)
    assert [r["x2"] for r in m.transform(df).collect()] == [1.0, 3.0, 3.0, 10.0, 3.0]
    mm = features.ModeImputer(inputCols=["s"], outputCols=["s2"]).fit(df)
    assert [r["s2"] for r in mm.transform(df).collect()] == ["a", "a", "b", "b", "a"]  # tie -> smallest


def brute_auc(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi == 0]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def test_exact_auc_with_ties(spark):
    rnd = random.Random(9)
    y = [rnd.randint(0, 1) for _ in range(300)]
    p = [rnd.choice([0.1, 0.2, 0.5, 0.7]) if rnd.random() < 0.5 else rnd.random() for _ in range(300)]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p double")
    got = model.auc(df, "y", "p").first()["auc"]
    assert abs(got - brute_auc(y, p)) < 1e-12
    flipped = model.auc(df.withColumn("p", -F.col("p")), "y", "p").first()["auc"]
    assert abs(got + flipped - 1.0) < 1e-12


def test_classification_report(spark):
    y = [1, 1, 0, 0, 1, 0]
    p = [0.9, 0.4, 0.6, 0.1, 0.5, 0.2]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p double")
    rep = {r["metric"]: r["value"] for r in model.classification_report(df, "y", "p").collect()}
    assert (rep["tp"], rep["fn"], rep["fp"], rep["tn"]) == (2, 1, 1, 2)
    assert rep["precision_1"] == 2 / 3 and rep["recall_1"] == 2 / 3 and rep["accuracy"] == 4 / 6
    assert rep["auc"] == brute_auc(y, p)


def test_forest_pipeline_scores_and_cv(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(120):
        y = 1 if rnd.random() < 0.3 else 0
        x = rnd.gauss(3 if y else 0, 1)
        rows.append((i, None if rnd.random() < 0.1 else x, rnd.choice(["a", "b", None]), y))
    df = spark.createDataFrame(rows, "id long, x double, c string, y int")
    fitted = model.fit_forest(df, "y", ["x"], ["c"], num_trees=10, max_depth=5)
    scored = model.score(fitted, df.drop("y"), "p")
    ps = np.array([r["p"] for r in scored.collect()])
    assert scored.columns == ["id", "x", "c", "p"] and ((ps >= 0) & (ps <= 1)).all()
    folds = features.stratified_folds(df, "y", "id", 3, "fold")
    cv = {r["fold"]: r["auc"] for r in model.cross_validated_auc(folds, "y", ["x"], ["c"], "fold",
                                                               num_trees=10, max_depth=5).collect()}
    assert set(cv) == {0, 1, 2, -1, -2} and cv[-1] > 0.7


def test_rows_reach_the_forest_sorted_by_features_and_keep_their_order(spark):
    rnd = random.Random(5)
    rows = [(i % 150 if i % 9 else None, None if rnd.random() < 0.1 else float(rnd.randrange(40)),
             rnd.choice(["a", "b", "c", None]), rnd.randrange(2)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x double, c string, y int").repartition(3).localCheckpoint()
    fitted = model.fit_forest(df, "y", ["x"], ["c"], num_trees=10, max_depth=8)
    gone = df.drop("y").where("id is null or id < 140")
    plain = fitted.transform(gone.withColumn("__label", F.lit(0.0)))
    both = model.vector_to_array("probability")
    scored, classes = model.score(fitted, gone, "p"), model.class_scores(fitted, gone, ["p0", "p1"])
    assert scored.collect() == plain.select("id", "x", "c", both[1].alias("p")).collect()
    assert classes.collect() == plain.select("id", "x", "c", both[0].alias("p0"), both[1].alias("p1")).collect()
    for q in (scored, scored.agg(F.avg("p"), F.count_if(F.col("p") >= 0.5))):
        assert "Sort [__by" in q._jdf.queryExecution().optimizedPlan().toString()
