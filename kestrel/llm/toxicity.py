"""Toxicity classifier with counterfactual regularisation.

A logistic model over the words a text holds. For every labelled text that holds an identity term,
the text with that term swapped for another one of its group must score alike: the squared change of
the log-odds is added to the loss. Neutral mentions of a group then weigh little, whatever the labels
of the texts they happen to stand in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import keep_buckets, map_batches, rows_of, written

#: Identity terms, by group; terms of a group are swapped for each other.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "african", "european", "latino", "arab"),
    ("american", "mexican", "chinese", "indian", "german", "french", "spanish", "turkish", "russian"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "young", "elderly"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)


@dataclass(frozen=True)
class Fit:
    """``max_rows`` bounds the labelled rows a model is fitted on, ``features`` the words it weighs.

    A word is weighed if it stands in ``min_texts`` texts or more and a chi-square statistic of
    ``min_chi`` ties it to the label; identity terms always are. ``groups`` are those terms, single words, which
    are swapped for one another; ``counterfactual`` weighs the change of score that a swap makes.
    """

    max_rows: int = 20_000
    features: int = 4_096
    min_texts: int = 3
    min_chi: float = 15.0
    ridge: float = 1e-4
    counterfactual: float = 1.0
    steps: int = 400
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS


@dataclass(frozen=True)
class Model:
    """Sorted word hashes, their weights, and the log-odds of a text with none of them."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        at = np.unique(np.searchsorted(self.words, found))
        at = at[at < len(self.words)]
        at = at[np.isin(self.words[at], found)]
        return float(1.0 / (1.0 + np.exp(-np.clip(self.bias + self.weights[at].sum(), -30, 30))))


def held_out(id_col: str) -> Column:
    """The rows that labels are never learnt from: a quarter, by the id's checksum."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _word_hash(term: str) -> int:
    return int(W.hash_words(term.encode(), "marks")[2][0])


def identity_groups(groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> list[np.ndarray]:
    """The hashes of the groups' terms; a term that is no single word can't be met, and is refused."""
    odd = [t for group in groups for t in group if len(W.hash_words(t.encode(), "marks")[2]) != 1]
    if odd:
        raise ValueError(f"identity terms must be single words: {odd[:5]}")
    return [np.array([_word_hash(t) for t in group], dtype=np.uint64) for group in groups]


def distinct_words(batch: pa.RecordBatch, text: str) -> Iterator[np.ndarray]:
    for _, _, _, h in W.each_text(rows_of(batch, text), "marks"):
        yield np.unique(h)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """(text, label): at most ``max_rows`` labelled rows outside the held-out part, equal texts once.

    Rows come by the hash of their id; an id labelled twice counts as labelled 1 if either is.
    """
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    chosen = written(chosen, "labelled")
    rows = keep_buckets(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), F.col("id"), chosen, F.col("id"))
    return written(rows.join(chosen, "id").where("text is not null").groupBy("text").agg(F.max("label").alias("label")), "sample")


def fit(sample: DataFrame, how: Fit = Fit()) -> Model:
    """A model of ``sample`` (text, label). Without rows of both labels every text scores the share of label 1."""
    def spell(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for label, x in zip(batch.column(1).to_pylist(), distinct_words(batch, "text")):
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(np.full(len(x), label, dtype=np.int32))],
                                             names=["word", "label"])

    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = float(np.log((ones + 0.5) / (n - ones + 0.5)))
    groups = identity_groups(how.groups)
    terms = np.unique(np.concatenate([*groups, np.empty(0, np.uint64)]))
    if not 0 < ones < n:
        return Model(terms[:0], np.empty(0), prior)
    counted = (map_batches(sample, spell, "word long, label int").groupBy("word")
               .agg(F.count("*").alias("n"), F.sum("label").alias("ones")).where(F.col("n") >= how.min_texts))
    expected = F.col("n") * F.lit(ones / n)
    chi = (F.col("ones") - expected) ** 2 / (expected * F.lit(1 - ones / n))
    best = counted.where(chi >= how.min_chi).orderBy(chi.desc(), "word").limit(how.features).select("word").toPandas()["word"].to_numpy(np.int64)
    vocab = np.unique(np.concatenate([best.view(np.uint64), terms]))

    def index(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hits = [np.flatnonzero(np.isin(vocab, x)).astype(np.int32).tobytes() for x in distinct_words(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(hits, pa.binary())], names=["label", "found"])

    # the sample's bound bounds what comes here; in one order, so that reruns agree
    rows = map_batches(sample, index, "label int, found binary").toPandas().sort_values(["found", "label"], kind="stable")
    found = [np.frombuffer(x, dtype=np.int32) for x in rows["found"]]
    weights, bias = _descend(found, rows["label"].to_numpy(float), len(vocab),
                             [np.searchsorted(vocab, g) for g in groups], prior, how)
    return Model(vocab, weights, bias)


def swaps(found: list[np.ndarray], groups: list[np.ndarray]) -> np.ndarray:
    """(term, other, times): the counterfactuals, each labelled text with one term swapped for another."""
    out: dict[tuple[int, int], int] = {}
    member = {int(t): g for g in groups for t in g}
    for x in found:
        for t in x.tolist():
            for other in member.get(t, ()):
                if other != t:
                    out[t, int(other)] = out.get((t, int(other)), 0) + 1
    return np.array([(a, b, k) for (a, b), k in sorted(out.items())], dtype=np.int64).reshape(-1, 3)


def _descend(found: list[np.ndarray], label: np.ndarray, size: int, groups: list[np.ndarray], bias: float,
             how: Fit) -> tuple[np.ndarray, float]:
    """Weights that minimise log-loss + ridge + the counterfactual penalty, by Adam over all rows."""
    length = np.array([len(x) for x in found])
    row, col = np.repeat(np.arange(len(found)), length), np.concatenate(found) if len(found) else np.empty(0, np.int32)
    pairs = swaps(found, groups)
    a, b, times = pairs.T
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = bias
    for step in range(1, how.steps + 1):
        z = np.bincount(row, w[col], len(found)) + w[-1]
        off = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - label
        grad = np.append(np.bincount(col, off[row], size), off.sum()) / len(found)
        grad[:-1] += how.ridge * w[:-1]
        pull = 2.0 * how.counterfactual * times * (w[a] - w[b]) / len(found)
        np.add.at(grad, a, pull)
        np.add.at(grad, b, -pull)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def scores(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    """``docs`` with a last column ``score``; other columns are passed through untouched."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = [model.score(x) for x in distinct_words(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], schema=pa.schema(
            [batch.schema.field(0), pa.field("score", pa.float64())]))

    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return map_batches(rows, run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = 0.3, how: Fit = Fit()) -> DataFrame:
    """(id, held_out, score, predicted): one row for each row of ``docs``.

    A null, empty or wordless text scores the model's prior. A null id is not held out, and carries no
    label. Repeated rows score alike. Without labels of both kinds every text scores the smoothed share of
    label 1. An empty table gives an empty table.
    """
    model = fit(labelled_sample(docs, labels, id_col, text_col, label_col, how.max_rows), how)
    got = scores(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, "text")
    return got.select("row.id", held_out("row.id").alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", threshold: float = 0.3, how: Fit = Fit()) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns as they are."""
    model = fit(labelled_sample(docs, labels, id_col, text_col, label_col, how.max_rows), how)
    return scores(docs, model, text_col).where(F.col("score") < threshold).select("row.*")
