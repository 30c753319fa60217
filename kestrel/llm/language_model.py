"""Interpolated modified Kneser-Ney n-gram model of any order.

Counted in Spark: tasks count the n-grams of their texts and deal them to shards by the context's hash; a
shard adds them up, stores them as a sorted array of hashes with their counts, and passes on what it knows of
its contexts and words, which a second exchange adds up, and of the shorter n-grams, which are the next
level's rows. A context whose last word holds more than a shard's share of the text is dealt by the n-gram's
hash instead, so no shard grows with one word. The number of shards follows the text, so a shard's memory does
not. Workers memory-map the arrays from the shared folder, a bounded number at a time, and look up whole
batches at once.

P(w|uv) = max(c(uvw) - D, 0) / c(uv) + g(uv) P(w|v),  ...,  P(w) = max(n(w) - D', 0) / n + g' / (V + 1)

c counts occurrences at the highest order and in n-grams from a text's start, distinct words before the n-gram
otherwise; n(w) are the distinct words before w, n the distinct pairs. Each order has three discounts, for
counts of 1, 2 and more; g is the mass that they free. One share of V + 1 is for unknown words.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import scratch_path

from . import words as W
from .common import rows_of, written
from .shared_arrays import load, save

#: Hashes that stand for the start and the end of a text.
START, END = np.uint64(0x1B873593CC9E2D51), np.uint64(0x85EBCA77C2B2AE63)
#: Tokens that a shard of pairs, and of words, holds on average at most.
PAIR_TOKENS, WORD_TOKENS = 1 << 21, 1 << 23
GRAMS = {"key": "u8", "count": "u8"}
CONTEXTS = {"key": "u8", "follow": "u8", "n1": "u8", "n2": "u8", "n3": "u8"}
WORDS = {"key": "u8", "count": "u8", "before": "u8", "follow": "u8", "n1": "u8", "n2": "u8", "n3": "u8"}
#: Arrays that a worker has mapped at a time.
OPEN = 512


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The key of an n-gram from that of its context, a word's own hash if that is one word, and its last word."""
    return W.mix(v * np.uint64(0x9E3779B97F4A7C15) + W.mix(w))


def line_of(h: np.ndarray) -> np.ndarray:
    return np.concatenate([[START], h, [END]])


def before(line: np.ndarray, back: int) -> np.ndarray:
    """For each token of a line, its words and then the end, the word ``back`` places before it, 0 where there is none."""
    out = np.zeros(len(line) - 1, dtype=np.uint64)
    if back < len(line):
        out[back - 1:] = line[:len(line) - back]
    return out


@dataclass
class Model:
    """Where the arrays are, and what is the same for all words; ``discount`` by order, ``shards`` of each level."""

    path: str
    order: int
    shards: int
    word_shards: int
    hot: np.ndarray
    tokens: int = 0
    vocabulary: int = 0
    pairs: int = 0
    discount: dict[int, np.ndarray] = field(default_factory=dict)
    word_back_off: float = 1.0

    def gram_shard(self, last: np.ndarray, context: np.ndarray, key: np.ndarray) -> np.ndarray:
        by = np.where(np.isin(last, self.hot), key, context) if len(self.hot) else context
        return (W.mix(by) % np.uint64(self.shards)).astype(np.int64)

    def word_shard(self, w: np.ndarray) -> np.ndarray:
        return (W.mix(w) % np.uint64(self.word_shards)).astype(np.int64)

    def context_shard(self, key: np.ndarray) -> np.ndarray:
        return (W.mix(key) % np.uint64(self.shards)).astype(np.int64)


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and more, from the numbers of items counted 1, 2, 3, 4 times."""
    n1, n2, n3, n4 = (float(x) for x in counts_of_counts)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d = [0.0] + [max(0.0, k - (k + 1) * y * b / a) if a else 0.0 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.minimum(d, [0.0, 1.0, 2.0, 3.0])


#: What a row of a level holds: its n-grams for the next level, or parts of what is known of contexts or words, or counts.
NEXT, CONTEXT, WORD, TOLD = 0, 1, 2, 3
_COLUMNS = "abcdefg"
_ROWS = "kind int, level int, shard long, " + ", ".join(f"{c} array<long>" for c in _COLUMNS)


def _rows(kind: int, level: int, shard: np.ndarray, columns: list[np.ndarray], sizes: list[np.ndarray | None] | None = None) -> pa.Table:
    """One row for each shard with its part of the columns, which are sorted by shard; ``sizes``: values per entry."""
    ids, cut = np.unique(shard, return_index=True)
    edge = np.append(cut, len(shard))
    out = [pa.array(np.full(len(ids), kind), pa.int32()), pa.array(np.full(len(ids), level), pa.int32()), pa.array(ids, pa.int64())]
    for k in range(len(_COLUMNS)):
        if k >= len(columns):
            out.append(pa.nulls(len(ids), pa.list_(pa.int64())))
            continue
        at = edge
        if sizes is not None and sizes[k] is not None:
            at = np.concatenate([[0], np.cumsum(sizes[k])])[edge]
        values = columns[k].view(np.int64) if columns[k].dtype == np.uint64 else columns[k].astype(np.int64, copy=False)
        out.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values)))
    return pa.table(out, names=["kind", "level", "shard", *_COLUMNS])


def _flat(group: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in group[name].chunks] or [np.empty(0)]).astype(np.int64, copy=False)


def _grams(level: int, words: list[np.ndarray], count: np.ndarray, model: Model) -> pa.Table:
    """n-grams dealt to the shards of their level: a contexts, word by word, b their numbers of n-grams, c last words, d counts."""
    context = words[0]
    for w in words[1:-1]:
        context = pair_key(context, w)
    shard = model.gram_shard(words[-2], context, pair_key(context, words[-1]))
    order = np.lexsort((context, shard))
    words, count, shard, context = [w[order] for w in words], count[order], shard[order], context[order]
    head = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])]))
    run = np.diff(np.append(head, len(context)))
    heads = np.stack([w[head] for w in words[:-1]], axis=1).ravel()
    per = np.full(len(head), level - 1)
    return _rows(NEXT, level, shard[head], [heads, run, words[-1], count], [per, None, run, run])


def count_grams(texts: DataFrame, model: Model) -> DataFrame:
    """n-grams of ``texts`` (text) with partial counts: of the model's order, and shorter ones from a text's start."""
    n = model.order

    def flush(lines: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate([before(x, back) for x in lines]) for back in range(n - 1, 0, -1)]
        columns.append(np.concatenate([x[1:] for x in lines]))
        place = np.concatenate([np.arange(1, len(x)) for x in lines])
        for level in range(2, n + 1):
            use = place >= n - 1 if level == n else place == level - 1
            words = [c[use] for c in columns[n - level:]]
            if not len(words[0]):
                continue
            key = words[0]
            for w in words[1:]:
                key = pair_key(key, w)
            _, at, count = np.unique(key, return_index=True, return_counts=True)
            yield from _grams(level, [w[at] for w in words], count, model).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, size = [], 0
        for batch in batches:
            step = max(1, min(batch.num_rows, int(batch.num_rows * (2 << 20) / max(1, batch.nbytes))))
            for start in range(0, batch.num_rows, step):
                for _, _, _, h in W.each_text(rows_of(batch.slice(start, step), "text")):
                    lines.append(line_of(h))
                    size += len(h) + 1
                if size >= PAIR_TOKENS:
                    yield from flush(lines)
                    lines, size = [], 0
        if size:
            yield from flush(lines)

    return texts.select("text").mapInArrow(run, _ROWS)


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, with the sums of each column of values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[head], *[np.add.reduceat(x[order], head) if len(head) else x[:0] for x in values]


def store_grams(dealt: DataFrame, level: int, model: Model) -> DataFrame:
    """Each shard's n-grams of a level stored; rows of what they say of contexts, words and shorter n-grams, and
    the shard's numbers of n-grams counted 1 to 4 times and in all.

    CONTEXT: a context, b its n-grams' counts, c to e its n-grams counted once, twice, more often. WORD: a word, b its
    count as a token, c distinct words before it, d to g as b to e of CONTEXT for the word as a context.
    """
    def run(group: pa.Table) -> pa.Table:
        runs = _flat(group, "b")
        heads = _flat(group, "a").view(np.uint64).reshape(-1, level - 1)
        words = [np.repeat(heads[:, k], runs) for k in range(level - 1)] + [_flat(group, "c").view(np.uint64)]
        count = _flat(group, "d")
        context = words[0]
        for w in words[1:-1]:
            context = pair_key(context, w)
        key = pair_key(context, words[-1])
        order = np.argsort(key, kind="stable")
        key, context, count, words = key[order], context[order], count[order], [w[order] for w in words]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, context, words, count = key[head], context[head], [w[head] for w in words], np.add.reduceat(count, head)
        save(f"{model.path}/grams{level}-{group['shard'][0].as_py()}", {"key": key, "count": count.astype(np.uint64)})
        ones = np.ones(len(key), np.int64)
        of_context = _sums(context, count, (count == 1) * ones, (count == 2) * ones, (count > 2) * ones)
        # the occurrences of a word as a token are those of the n-grams that are counted by occurrence
        raw = (words[0] == START) | (level == model.order)
        last, tokens, distinct = _sums(words[-1], count * raw, ones if level == 2 else 0 * ones)
        out = []
        if level == 2:  # a context is a word
            zero_a, zero_b = np.zeros(len(last), np.int64), np.zeros(len(of_context[0]), np.int64)
            known = _sums(np.concatenate([last, of_context[0]]), *[np.concatenate(x) for x in (
                (tokens, zero_b), (distinct, zero_b), *[(zero_a, c) for c in of_context[1:]])])
        else:
            shard = model.context_shard(of_context[0])
            by = np.argsort(shard, kind="stable")
            out.append(_rows(CONTEXT, level, shard[by], [x[by] for x in of_context]))
            out.append(_grams(level - 1, words[1:], ones, model))
            some = tokens > 0
            known = (last[some], tokens[some], *[np.zeros(int(some.sum()), np.int64)] * 5)
        shard = model.word_shard(known[0])
        by = np.argsort(shard, kind="stable")
        if len(by):
            out.append(_rows(WORD, level, shard[by], [x[by] for x in known]))
        told = [int((count == k).sum()) for k in (1, 2, 3, 4)] + [len(key)]
        out.append(_rows(TOLD, level, np.zeros(5, np.int64), [np.array(told)]))
        return pa.concat_tables(out)

    return dealt.groupBy("shard").applyInArrow(run, _ROWS)


def store_contexts(parts: DataFrame, level: int, model: Model) -> int:
    """Each shard's contexts of a level stored; their number."""
    def run(group: pa.Table) -> pa.Table:
        found = _sums(_flat(group, "a").view(np.uint64), *[_flat(group, c) for c in "bcde"])
        save(f"{model.path}/contexts{level}-{group['shard'][0].as_py()}", dict(zip(CONTEXTS, [found[0], *[x.astype(np.uint64) for x in found[1:]]])))
        return pa.table({"n": [len(found[0])]})

    return parts.groupBy("shard").applyInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def store_words(parts: DataFrame, model: Model) -> DataFrame:
    """Each shard's words stored; (words, tokens, n1..n4): its words, their tokens, and how many words
    stand after 1 to 4 distinct others."""
    def run(group: pa.Table) -> pa.Table:
        words, *sums = _sums(_flat(group, "a").view(np.uint64), *[_flat(group, c) for c in "bcdefg"])
        save(f"{model.path}/words-{group['shard'][0].as_py()}", dict(zip(WORDS, [words, *[x.astype(np.uint64) for x in sums]])))
        held = [int((sums[1] == k).sum()) for k in (1, 2, 3, 4)]
        return pa.table({"words": [int((sums[0] > 0).sum())], "tokens": [int(sums[0].sum())],
                         **{f"n{k}": [x] for k, x in enumerate(held, 1)}, "n3plus": [int((sums[1] > 2).sum())]})

    return parts.groupBy("shard").applyInArrow(run, "words long, tokens long, n1 long, n2 long, n3 long, n4 long, n3plus long")


def hot_words(texts: DataFrame, share: int, tokens: int) -> np.ndarray:
    """All words with more than 1/``share`` of the tokens, and some with half of that: 2 * ``share`` at most.

    A batch reports the words that make a 2 * ``share``-th of it; a hot word is reported for half of
    its occurrences at least.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.concatenate([x[3] for x in W.each_text(rows_of(batch, "text"))] or [np.empty(0, np.uint64)])
            word, n = np.unique(h, return_counts=True)
            use = 2 * share * n >= len(h)
            yield pa.RecordBatch.from_arrays([pa.array(word[use].view(np.int64)), pa.array(n[use], pa.int64())], names=["word", "n"])

    seen = texts.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = seen.where(F.col("n") * (2 * share) >= tokens).select("word").collect()
    return np.unique(np.array([START, *np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64)], dtype=np.uint64))


def fit(texts: DataFrame, order: int = 2) -> Model:
    """A model of the texts (text) with ``order - 1`` words of context; null counts as empty, and each text ends once."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = texts.sparkSession

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(len(h) + 1 for batch in batches for _, _, _, h in W.each_text(rows_of(batch, "text")))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    tokens = texts.select("text").mapInArrow(size, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    model = Model(scratch_path(spark, "language-model"), order, max(1, -(-tokens // PAIR_TOKENS)), max(1, -(-tokens // WORD_TOKENS)),
                  np.empty(0, np.uint64), tokens)
    if not tokens:
        return model
    if model.shards > 1:
        model.hot = hot_words(texts, model.shards, tokens)
    counted = count_grams(texts, model)
    short = written(counted.where(F.col("level") < order), "short") if order > 2 else None  # from the texts' starts
    rows, words = counted.where(F.col("level") == order) if order > 2 else counted, None
    for level in range(order, 1, -1):
        told = written(store_grams(rows, level, model), "grams")
        count = F.col("a")
        n1, n2, n3, n4, model.pairs = told.where(F.col("kind") == TOLD).agg(*[F.sum(F.get(count, F.lit(k))) for k in range(5)]).first()
        model.discount[level] = discounts(np.array([n1, n2, n3, n4]))
        of_words = told.where(F.col("kind") == WORD)
        words = of_words if words is None else words.union(of_words)
        if level > 2:
            store_contexts(told.where(F.col("kind") == CONTEXT), level, model)
            rows = told.where(F.col("kind") == NEXT).union(short.where(F.col("level") == level - 1))
    kept = store_words(words, model)
    model.vocabulary, _, n1, n2, n3, n4, more = kept.agg(*[F.sum(x) for x in ("words", "tokens", "n1", "n2", "n3", "n4", "n3plus")]).first()
    model.discount[1] = discounts(np.array([n1, n2, n3, n4]))
    model.word_back_off = float(model.discount[1][1:] @ np.array([n1, n2, more])) / model.pairs
    return model


class Reader:
    """Look-ups in a model's arrays, which are mapped when needed; those not needed for longest are let go."""

    def __init__(self, model: Model):
        self.model, self.open = model, OrderedDict()

    def _mapped(self, kind: str, shard: int, kinds: dict[str, str]) -> dict[str, np.ndarray]:
        if (kind, shard) not in self.open:
            try:
                self.open[kind, shard] = load(f"{self.model.path}/{kind}-{shard}", kinds)
            except FileNotFoundError:  # a shard that no training token was dealt to
                self.open[kind, shard] = {c: np.empty(0, t) for c, t in kinds.items()}
            if len(self.open) > OPEN:
                self.open.popitem(last=False)
        self.open.move_to_end((kind, shard))
        return self.open[kind, shard]

    def look_up(self, kind: str, kinds: dict[str, str], shard: np.ndarray, key: np.ndarray) -> dict[str, np.ndarray]:
        """The columns of each key, 0 where it is not stored."""
        out = {c: np.zeros(len(key), dtype=np.int64) for c in kinds if c != "key"}
        order = np.lexsort((key, shard))
        ids, cut = np.unique(shard[order], return_index=True)
        for s, at in zip(ids.tolist(), np.split(order, cut[1:])):
            held = self._mapped(kind, s, kinds)
            if not len(held["key"]):
                continue
            spot = np.minimum(np.searchsorted(held["key"], key[at]), len(held["key"]) - 1)
            hit = held["key"][spot] == key[at]
            for c in out:
                out[c][at[hit]] = held[c][spot[hit]]
        return out

    def log10(self, lines: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """log10 P of each token of the lines after those before it, and its count as a word."""
        m = self.model
        w, v = np.concatenate([x[1:] for x in lines]), np.concatenate([x[:-1] for x in lines])
        place = np.concatenate([np.arange(1, len(x)) for x in lines])
        words, back = np.unique(np.concatenate([w, v]), return_inverse=True)
        held = self.look_up("words", WORDS, m.word_shard(words), words)
        of_w = {c: x[back[:len(w)]] for c, x in held.items()}
        seen = of_w["before"]
        flat = m.discount.get(1, np.zeros(4))
        p = (seen - flat[np.minimum(seen, 3)]) / max(1, m.pairs) + m.word_back_off / (m.vocabulary + 1)
        context = v
        for level in range(2, m.order + 1):
            if level == 2:
                known = {c: x[back[len(w):]] for c, x in held.items()}
            else:
                parts = [np.concatenate([before(x, k) for x in lines]) for k in range(level - 1, 0, -1)]
                context = parts[0]
                for x in parts[1:]:
                    context = pair_key(context, x)
                known = self.look_up(f"contexts{level}", CONTEXTS, m.context_shard(context), context)
            key = pair_key(context, w)
            count = self.look_up(f"grams{level}", GRAMS, m.gram_shard(v, context, key), key)["count"]
            d, follow = m.discount.get(level, np.zeros(4)), np.maximum(known["follow"], 1)
            free = (d[1] * known["n1"] + d[2] * known["n2"] + d[3] * known["n3"]) / follow
            higher = (count - d[np.minimum(count, 3)]) / follow + free * p
            p = np.where((known["follow"] > 0) & (place >= level - 1), higher, p)
        return np.log10(p), of_w["count"]


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, n_tokens, n_known, base_score, score): ``row`` has all columns of ``docs`` but the text.

    ``score`` is the model's log10 probability of the text and its end, ``base_score`` that of add-one
    word frequencies; perplexity is 10 ** (-score / n_tokens). A null or empty text is one token, its end.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            step = max(1, min(batch.num_rows, int(batch.num_rows * (1 << 20) / max(1, batch.nbytes))))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                lines = [line_of(h) for _, _, _, h in W.each_text(rows_of(part, "text"))]
                size = np.array([len(x) - 1 for x in lines])
                logs, seen = reader.log10(lines)
                base = np.log10((seen + 1) / (model.tokens + model.vocabulary + 1))
                head = np.cumsum(size) - size
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(np.add.reduceat((seen > 0).astype(np.int64), head)),
                     pa.array(np.add.reduceat(base, head)), pa.array(np.add.reduceat(logs, head))],
                    schema=pa.schema([part.schema.field(0), *[pa.field(n, k) for n, k in zip(
                        ("n_tokens", "n_known", "base_score", "score"), (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]]))

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row for each row of ``docs``.

    The model learns from the rows whose id's checksum leaves another remainder than 2 by 7; a null id
    is learnt from. Repeated rows count as often as they come. Without rows to learn from, each token's
    probability is 1, of the one unknown word. An empty table gives an empty table.
    """
    out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), out.alias("held_out"), F.col(text_col).alias("text"))
    model = fit(rows.where("not held_out"), order)
    return score(rows, model, "text").select("row.*", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
