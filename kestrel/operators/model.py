"""Model operators: class-weighted random forest pipeline, cross-validated ROC-AUC, exact AUC and a
classification report, batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from kestrel.operators.features import ClassWeighter, ExactMedianImputer, ModeImputer
from kestrel.operators.ordered import cumulative_sum
from kestrel.operators.stats import one_row
from kestrel.session import written

# Forest settings of the job this rebuilds (trees, seed, features per split).
NUM_TREES, SEED, SUBSET = 300, 42, "sqrt"
MAX_FOLDS = 1000


def forest_pipeline(label: str, num_cols: Sequence[str], text_cols: Sequence[str],
                    num_trees: int = NUM_TREES, max_depth: int = 30, seed: int = SEED) -> Pipeline:
    """M1-M6: weights, median / most-frequent imputation, one-hot (unknown = zeros), assembler,
    class-weighted forest. Every statistic is fitted on the rows given to ``fit`` only."""
    num_imp = [f"{c}__imp" for c in num_cols]
    txt_imp = [f"{c}__imp" for c in text_cols]
    idx = [f"{c}__idx" for c in text_cols]
    ohe = [f"{c}__ohe" for c in text_cols]
    stages = [ClassWeighter(labelCol=label, weightCol="__weight")]
    if num_cols:
        stages.append(ExactMedianImputer(inputCols=list(num_cols), outputCols=num_imp))
    if text_cols:
        stages += [ModeImputer(inputCols=list(text_cols), outputCols=txt_imp),
                   StringIndexer(inputCols=txt_imp, outputCols=idx, stringOrderType="alphabetAsc",
                                 handleInvalid="keep"),
                   OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="keep")]
    stages += [VectorAssembler(inputCols=num_imp + ohe, outputCol="__features", handleInvalid="keep"),
               RandomForestClassifier(featuresCol="__features", labelCol="__label", weightCol="__weight",
                                      numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                      featureSubsetStrategy=SUBSET, impurity="gini",
                                      # more nodes split per pass over the data, node ids cached for
                                      # deep trees: fewer Spark jobs, same model parameters
                                      maxMemoryInMB=1024, cacheNodeIds=True)]
    return Pipeline(stages=stages)


def _with_label(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn("__label", F.col(label).cast("double"))


def fit_forest(train: DataFrame, label: str, num_cols, text_cols, **kw) -> PipelineModel:
    return forest_pipeline(label, num_cols, text_cols, **kw).fit(_with_label(train, label))


def _transformed(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M7: the rows with the forest's outputs, in the order they had.

    Each partition is sorted by the features before the forest: rows that follow each other then pass
    mostly the same nodes, which are still in the processor's cache. A deep forest takes more than
    the cache holds, and rows in any order wait for the memory at every node.
    """
    *prepare, forest = model.stages
    ready = df.withColumn("__label", F.lit(0.0)) if "__label" not in df.columns else df
    for stage in prepare:
        ready = stage.transform(ready)
    ready = ready.select("*", vector_to_array(forest.getFeaturesCol()).alias("__by"), F.monotonically_increasing_id().alias("__at"))
    scored = forest.transform(ready.sortWithinPartitions("__by"))
    # numbers given after the forest: without them Spark drops a sort that another one follows
    return scored.withColumn("__then", F.monotonically_increasing_id()).sortWithinPartitions("__at", "__then")


def score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """M7: class-1 probability next to the input columns."""
    return _transformed(model, df).select(*df.columns, vector_to_array("probability").getItem(1).alias(out))


def class_scores(model: PipelineModel, df: DataFrame, out: Sequence[str]) -> DataFrame:
    """M7: the probability of each class in the order of the classes, next to the input columns."""
    both = vector_to_array("probability")
    return _transformed(model, df).select(*df.columns, *[both.getItem(k).alias(name) for k, name in enumerate(out)])


def auc(df: DataFrame, label: str, score_col: str, out: str = "auc") -> DataFrame:
    """M9: exact ROC-AUC, ties counted half, as a one-row frame.

    Rows are grouped by distinct score (partial aggregation); the running count of negatives below
    each score comes from an ordered scan; AUC = sum(pos * (neg_below + neg_tied / 2)) / (P * N).
    All partial sums are multiples of 1/2, so the result does not depend on summation order.
    """
    g = df.groupBy(score_col).agg(F.sum(F.col(label).cast("long")).alias("__pos"),
                                  F.sum((1 - F.col(label)).cast("long")).alias("__neg"))
    c = cumulative_sum(g, [], [score_col], "__neg", "__cum_neg")
    area = F.sum(F.col("__pos").cast("double") * (F.col("__cum_neg").cast("double") - F.col("__neg") * 0.5))
    pn = F.sum("__pos").cast("double") * F.sum("__neg").cast("double")
    return c.agg(F.when(pn > 0, area / pn).alias(out))


def auc_by(df: DataFrame, group: str, label: str, score_col: str, out: str = "auc") -> DataFrame:
    """M9 for each value of ``group`` (folds, sources): (group, auc), from one ordered scan keyed by it."""
    g = df.groupBy(group, score_col).agg(F.sum(F.col(label).cast("long")).alias("__pos"),
                                         F.sum((1 - F.col(label)).cast("long")).alias("__neg"))
    c = cumulative_sum(g, [group], [score_col], "__neg", "__cum_neg")
    area = F.sum(F.col("__pos").cast("double") * (F.col("__cum_neg").cast("double") - F.col("__neg") * 0.5))
    pn = F.sum("__pos").cast("double") * F.sum("__neg").cast("double")
    return c.groupBy(group).agg(F.when(pn > 0, area / pn).alias(out))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))


REPORT_METRICS = ["auc", "tn", "fp", "fn", "tp", "precision_0", "recall_0", "f1_0", "support_0",
                  "precision_1", "recall_1", "f1_1", "support_1", "accuracy", "macro_precision",
                  "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]


def classification_report(df: DataFrame, label: str, score_col: str, threshold: float = 0.5) -> DataFrame:
    """AUC, confusion counts and per-class / averaged precision, recall, F1 as
    (metric, value) rows. Predicted class is ``score >= threshold``; 0 where a denominator is 0."""
    y, yhat = F.col(label), (F.col(score_col) >= threshold)
    counts = df.agg(F.count_if((y == 0) & ~yhat).alias("tn"), F.count_if((y == 0) & yhat).alias("fp"),
                    F.count_if((y == 1) & ~yhat).alias("fn"), F.count_if((y == 1) & yhat).alias("tp"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p0, r0, p1, r1 = _ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    s0, s1 = (tn + fp).cast("double"), (tp + fn).cast("double")
    f0, f1 = _f1(p0, r0), _f1(p1, r1)

    def wavg(a: Column, b: Column) -> Column:
        return _ratio(a * s0 + b * s1, s0 + s1)

    metrics = {
        "tn": tn.cast("double"), "fp": fp.cast("double"), "fn": fn.cast("double"), "tp": tp.cast("double"),
        "precision_0": p0, "recall_0": r0, "f1_0": f0, "support_0": s0,
        "precision_1": p1, "recall_1": r1, "f1_1": f1, "support_1": s1,
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        "macro_precision": (p0 + p1) / 2.0, "macro_recall": (r0 + r1) / 2.0, "macro_f1": (f0 + f1) / 2.0,
        "weighted_precision": wavg(p0, p1), "weighted_recall": wavg(r0, r1), "weighted_f1": wavg(f0, f1),
    }
    report = counts.select(*[v.alias(k) for k, v in metrics.items()])
    row = one_row([auc(df, label, score_col, "auc"), report])
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                        for m in REPORT_METRICS])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def cross_validated_auc(df: DataFrame, label: str, num_cols, text_cols, fold_col: str,
                        num_trees: int = NUM_TREES, max_depth: int = 30, seed: int = SEED,
                        parallelism: int = 5) -> DataFrame:
    """M8: fit on all folds but one, AUC on the held-out fold; (fold, auc) rows plus the mean and
    population standard deviation as rows with fold = -1 and -2.

    Fold fits are independent, so up to ``parallelism`` of them are submitted at once from driver
    threads (as ``CrossValidator(parallelism=...)`` does); the scheduler interleaves their jobs.
    """
    df = written(df.where(F.col(fold_col).isNotNull()), "folds")  # fold assignment computed once for all fits
    rows = df.select(fold_col).distinct().limit(MAX_FOLDS + 1).collect()
    if len(rows) > MAX_FOLDS:  # a model is fitted for each fold, so there are only ever a few
        raise ValueError(f"{fold_col} has more than {MAX_FOLDS} folds")
    folds = sorted(r[0] for r in rows)

    def one_fold(f):
        train, test = df.filter(F.col(fold_col) != f), df.filter(F.col(fold_col) == f)
        m = fit_forest(train, label, num_cols, text_cols, num_trees=num_trees, max_depth=max_depth, seed=seed)
        s = score(m, test, "__p")
        return auc(s, label, "__p", "auc").select(F.lit(f).cast("int").alias("fold"), "auc")

    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(folds)))) as pool:
        per_fold = list(pool.map(one_fold, folds))
    table = per_fold[0]
    for p in per_fold[1:]:
        table = table.unionByName(p)
    summary = table.agg(F.avg("auc").alias("mean"), F.stddev_pop("auc").alias("std"))
    return table.unionByName(summary.select(F.lit(-1).alias("fold"), F.col("mean").alias("auc"))).unionByName(
        summary.select(F.lit(-2).alias("fold"), F.col("std").alias("auc")))
