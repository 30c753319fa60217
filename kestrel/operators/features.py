"""Feature operators: exact-median and most-frequent imputation, one-hot encoding, balanced class
weights, stratified fold assignment. Estimators are ``pyspark.ml`` stages so they compose in a
``Pipeline`` and are re-fitted inside each cross-validation fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.sql import Column, DataFrame, functions as F

from kestrel.operators.ordered import cumulative_sum, row_number_in_order
from kestrel.operators.stats import exact_medians, mode_with_frequency, modes
from kestrel.session import written


class _FillModel(Model, HasInputCols, HasOutputCols):
    """Fitted imputer: each output column is its input with nulls replaced by a fitted value."""

    def __init__(self, fills: dict | None = None):
        super().__init__()
        self.fills = dict(fills or {})

    def _transform(self, df: DataFrame) -> DataFrame:
        outs = {}
        for i, o in zip(self.getInputCols(), self.getOutputCols()):
            fill = self.fills.get(i)
            outs[o] = F.col(i) if fill is None else F.coalesce(F.col(i), F.lit(fill))
        return df.withColumns(outs)


class _ImputerBase(Estimator, HasInputCols, HasOutputCols):
    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fills(self, df: DataFrame, cols: Sequence[str]) -> dict:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> _FillModel:
        m = _FillModel(self._fills(df, list(self.getInputCols())))
        m._set(inputCols=self.getInputCols(), outputCols=self.getOutputCols())
        return m


class ExactMedianImputer(_ImputerBase):
    """M1: nulls replaced by the exact (interpolated) median of the fitted data."""

    def _fills(self, df, cols):
        return exact_medians(df, cols)


class ModeImputer(_ImputerBase):
    """M2: nulls replaced by the most frequent value of the fitted data, ties to the smallest."""

    def _fills(self, df, cols):
        text = [c for c in cols if df.schema[c].dataType.typeName() == "string"]
        fills = modes(df, text) if text else {}
        for c in cols:
            if c not in text:  # other types are not stacked: their values keep their own order
                row = mode_with_frequency(df, c, "m").first()
                if row is not None:
                    fills[c] = row[0]
        return fills


def balanced_class_weights(df: DataFrame, label: str) -> DataFrame:
    """M5: weight = n_rows / (n_classes * n_class) per class, as a (label, n, weight) frame."""
    counts = written(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), "classes")
    total, k = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    return counts.withColumn("weight", F.lit(float(total or 0)) / (F.lit(float(k)) * F.col("n").cast("double")))


class ClassWeighter(Estimator):
    """M5 as a pipeline stage: fitted on the training rows of each fold, adds a weight column."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "output weight column", TypeConverters.toString)

    @keyword_only
    def __init__(self, labelCol: str = "label", weightCol: str = "weight"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ClassWeightModel":
        label = self.getOrDefault(self.labelCol) if self.isSet(self.labelCol) else "label"
        weights = balanced_class_weights(df, label).select(F.col(label).alias("__class"), F.col("weight").alias("__w"))
        return ClassWeightModel(label, self.getOrDefault(self.weightCol) if self.isSet(self.weightCol) else "weight", weights)


class ClassWeightModel(Model):
    """The weights stay a table of one row per class, joined to the rows."""

    def __init__(self, label: str, weight_col: str, weights: DataFrame):
        super().__init__()
        self.label, self.weight_col, self.weights = label, weight_col, weights

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.label not in df.columns:  # scoring rows without a label: weights are not used
            return df.withColumn(self.weight_col, F.lit(1.0))
        joined = df.join(self.weights, F.col(self.label).eqNullSafe(F.col("__class")), "left")
        return joined.withColumn(self.weight_col, F.col("__w")).drop("__class", "__w")


class OneHot:
    """M3 fitted: one 0/1 int column per level seen in training, ``<col>_<level>``; unseen levels
    and null give all zeros (StringIndexer keeps them in an extra slot that the encoder drops)."""

    def __init__(self, col: str, levels: list[str], model):
        self.col, self.levels, self.model = col, levels, model

    def transform(self, df: DataFrame) -> DataFrame:
        vec = f"__{self.col}_ohe"
        out = self.model.transform(df)
        arr = vector_to_array(F.col(vec))
        cols = [arr.getItem(i).cast("int").alias(f"{self.col}_{lvl}") for i, lvl in enumerate(self.levels)]
        return out.select(*df.columns, *cols)


def fit_one_hot(train: DataFrame, col: str) -> OneHot:
    idx, vec = f"__{col}_idx", f"__{col}_ohe"
    pipe = Pipeline(stages=[
        StringIndexer(inputCol=col, outputCol=idx, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[idx], outputCols=[vec], dropLast=True, handleInvalid="keep"),
    ]).fit(train)
    levels = list(pipe.stages[0].labelsArray[0])
    return OneHot(col, levels, pipe)


def stratified_folds(df: DataFrame, label: str, order_col: str, k: int = 5, out: str = "fold") -> DataFrame:
    """M8: unshuffled stratified k-fold test-fold index per row, as the common reference
    implementation assigns it.

    Classes are numbered by first appearance (``order_col``); sorting rows by that number and
    dealing them round-robin into k folds fixes how many rows of each class each fold gets; the
    rows of a class then fill folds 0..k-1 in that order. Row ranks within a class, and the classes'
    own order, come from ordered scans; the class statistics are joined to the rows. Rows without a
    label are in no fold (null).
    """
    classes = (df.where(F.col(label).isNotNull()).groupBy(label)
               .agg(F.count(F.lit(1)).alias("__n"), F.min(order_col).alias("__first")))
    placed = cumulative_sum(classes, [], ["__first", label], "__n", "__to").select(
        F.col(label).alias("__class"), (F.col("__to") - F.col("__n")).alias("__from"), "__to")
    ranked = row_number_in_order(df, [label], [order_col], "__rn").join(placed, F.col(label) == F.col("__class"), "left")

    def dealt(m: Column, f: int) -> Column:  # how many of the first m rows go to fold f when dealt round-robin
        return F.greatest(F.lit(0), F.floor((m + F.lit(k - 1 - f)) / F.lit(k)))

    bound, fold = F.lit(0), F.lit(0)
    for f in range(k - 1):
        bound = bound + dealt(F.col("__to"), f) - dealt(F.col("__from"), f)
        fold = fold + (F.col("__rn") > bound).cast("int")
    fold = F.when(F.col("__class").isNotNull(), fold).cast("int")
    return ranked.withColumn(out, fold).drop("__rn", "__class", "__from", "__to")
