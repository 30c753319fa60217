"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The seeds of a test item are the rarer half of its n-grams. Rare means unlikely from the training
corpus' word counts, the product of the words' shares: an n-gram that contamination has made frequent
stays a seed. A passage that holds a seed of an item is aligned with the whole item, word by word; the
score is the best local alignment's share of the best score possible. Edited and paraphrased copies
keep a high one.

Seeds are a table (n-gram, item, place) made by Spark, and are joined to the n-grams of the training texts;
texts that share a seed with an item meet its words in a second join and are aligned in tasks. Nothing of
the items goes through the driver but two bit maps of fixed size, which only spare the joins what can't match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bit_map, in_map, keep_buckets, map_batches, other_buckets, rows_of, written

MATCH, MISS, GAP = 2, -1, -1


#: Tokens whose words are counted at a time.
COUNT_TOKENS = 1 << 20


def item_words(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, id, words) of the items that have words; words is the run of their hashes, key numbers the items."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [(at, h.tobytes()) for at, _, _, h in W.each_text(rows_of(batch, "text")) if len(h)]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([x[0] for x in found], pa.int64())),
                                          pa.array([x[1] for x in found], pa.binary())], names=["id", "words"])

    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null").distinct()
    items = map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, words binary")
    return written(items.select(F.monotonically_increasing_id().alias("key"), "id", "words"), "items")


def word_counts(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(word, n): how often each word in the map occurs in all of ``docs`` (text); the number of all words has a null word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, total = [], 0, 0
        for batch in batches:
            for _, _, _, h in W.each_text(rows_of(batch, "text")):
                total += len(h)
                held.append(h[in_map(wanted, h)])
                size += len(held[-1])
            if size >= COUNT_TOKENS:
                word, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])
                held, size = [], 0
        word, n = np.unique(np.concatenate([*held, np.empty(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array([None, *word.view(np.int64).tolist()], pa.int64()), pa.array([total, *n.tolist()], pa.int64())],
                                         names=["word", "n"])

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words, those of other lengths told apart; none in a shorter text."""
    return W.mix(W.ngrams(h, n) + np.uint64(n * 0x51ED270B)) if len(h) >= n else h[:0]


def choose_seeds(items: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(gram, key, place): the rarer half of each item's n-grams, by its words' shares of all words of ``docs``.

    An item shorter than ``n`` words has one seed, all of its words.
    """
    def words(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        each = [np.unique(np.frombuffer(x, dtype=np.uint64)) for x in rows_of(batch, "words")]
        row = pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each]))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), pa.array(np.concatenate(each).view(np.int64))], names=["key", "word"])

    def choose(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seeds, owner, place = [], [], []
        for at, (raw, known) in enumerate(zip(rows_of(batch, "words"), batch.column(2).to_pylist())):
            h = np.frombuffer(raw, dtype=np.uint64)
            counts = {r["word"]: r["n"] for r in known or []}
            share = np.log([(counts.get(x, 0) + 0.5) / every for x in h.view(np.int64).tolist()])
            size = min(n, len(h))
            found = grams(h, size)
            use = np.argsort(np.convolve(share, np.ones(size), "valid"), kind="stable")[:(len(found) + 1) // 2]
            seeds.append(found[use])
            owner.append(np.full(len(use), at))
            place.append(use)
        if seeds:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(seeds).view(np.int64)), batch.column(0).take(pa.array(np.concatenate(owner))),
                                              pa.array(np.concatenate(place), pa.int32())], names=["gram", "key", "place"])

    rows = written(map_batches(items.select("key", "words"), words, "key long, word long"), "item-words")
    counts = written(word_counts(docs, bit_map(rows, "word")), "counts")
    every = max(1, counts.where("word is null").agg(F.sum("n")).first()[0] or 0)
    known = rows.join(counts, "word").groupBy("key").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    return map_batches(items.join(known, "key", "left").select("key", "words", "known"), choose, "gram long, key long, place int")


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """(score, start, stop): the best local alignment and the words of the passage it spans."""
    m = len(passage)
    row, begin = np.zeros(m + 1, dtype=np.int64), np.arange(m + 1)
    best = (0, 0, 0)
    place = np.arange(m + 1)
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISS)
        up = row[1:] + GAP
        take = diagonal >= up
        now = np.concatenate([[0], np.maximum(np.where(take, diagonal, up), 0)])
        origin = np.concatenate([[0], np.where(take, begin[:-1], begin[1:])])
        origin = np.where(now > 0, origin, place)
        # gaps in the item: the best cell to the left, less a gap for each step
        reach = np.maximum.accumulate(now - GAP * place)
        source = np.maximum.accumulate(np.where(now - GAP * place == reach, place, 0))
        filled = reach + GAP * place
        origin = np.where(filled > now, origin[source], origin)
        row = np.maximum(now, filled)
        begin = np.where(row > 0, origin, place)
        top = int(row.argmax())
        if row[top] > best[0]:
            best = int(row[top]), int(begin[top]), top
    return best


def best_alignment(h: np.ndarray, item: np.ndarray, begin: np.ndarray, n: int) -> tuple[int, int, int]:
    """(score, first word, last word + 1) of the item's best alignment near places where it may begin in a text."""
    size, starts, best = len(item), np.unique(begin), (0, 0, 0)
    # seeds that suggest nearly the same place are one passage, aligned with a margin on both sides
    for g in np.split(starts, np.flatnonzero(np.diff(starts) > size) + 1):
        a, b = max(0, int(g[0]) - size // 2 - n), min(len(h), int(g[-1]) + size + size // 2 + n)
        score, s, e = align(item, h[a:b])
        if score > best[0]:
            best = score, a + s, a + e
    return best


def seed_hits(rows: DataFrame, seeds: DataFrame, sizes: list[int]) -> DataFrame:
    """(id, th, gram, at): the runs of ``sizes`` words of ``rows`` (id, th, text) that may be seeds."""
    wanted = bit_map(seeds, "gram")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, gram, place = [], [], []
        for k, _, _, h in W.each_text(rows_of(batch, "text")):
            for n in sizes:
                found = grams(h, n)
                at = np.flatnonzero(in_map(wanted, found))
                row.append(np.full(len(at), k))
                gram.append(found[at])
                place.append(at)
        if row:
            take = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(gram).view(np.int64)),
                                              pa.array(np.concatenate(place), pa.int32())], names=["id", "th", "gram", "at"])

    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, th long, gram long, at int")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", n: int = 3, least: float = 0.5,
                 block_words: int = 200_000) -> DataFrame:
    """(id, th, item, score, first_word, stop_word): the pairs of a row of ``docs`` and a test item that it holds.

    The score is the alignment's share of a perfect one, ``least`` or more; the words are those that
    the best alignment spans. ``th`` is the hash of the text. Items without words match nothing; an
    item shorter than ``n`` words matches where all its words stand in a row. An item id that repeats with
    other texts is scored for each of them, the best counts, and so do items without an id. Null and empty
    texts match nothing, repeated rows match as one. Empty tables give an empty table. A text that shares seeds
    with items of more than ``block_words`` words in all meets them in parts.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    items = item_words(benchmark, item_id_col, item_text_col)
    sizes = sorted({min(n, r["n"]) for r in items.select(F.least(F.octet_length("words") / 8, F.lit(n)).cast("int").alias("n")).distinct().collect()})
    seeds = written(choose_seeds(items, rows, n), "seeds")
    # the places where an item may begin, of each text and item that share a seed
    met = (seed_hits(rows, seeds, sizes).join(seeds, "gram").groupBy("id", "th", "key")
           .agg(F.collect_set(F.col("at") - F.col("place")).alias("begin")))
    met = written(met.join(items.select("key", F.col("id").alias("item"), "words"), "key"), "met")
    text_words = met.groupBy("id", "th").agg(F.ceil(F.sum(F.octet_length("words") / 8) / block_words).cast("int").alias("parts"))
    key = F.struct("id", "th")
    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    lists = (met.withColumn("of", key).join(text_words.select(key.alias("of"), "parts"), "of")
             .groupBy("of", part.alias("part")).agg(F.collect_list(F.struct("item", "words", "begin")).alias("items")))
    texts = keep_buckets(rows.select(key.alias("of"), "text"), F.col("of"), text_words.select(key.alias("of")), F.col("of"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got, lists = [], batch.column(2)
        for at, _, _, h in W.each_text(rows_of(batch, "text")):
            for x in lists[at].as_py():
                item = np.frombuffer(x["words"], dtype=np.uint64)
                score, first, stop = best_alignment(h, item, np.array(x["begin"]), n)
                if score >= least * MATCH * len(item):
                    got.append((at, x["item"], score / (MATCH * len(item)), first, stop))
        if got:
            at, item, score, first, stop = zip(*got)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(item, lists.type.value_type.field("item").type), pa.array(score, pa.float64()),
                 pa.array(first, pa.int32()), pa.array(stop, pa.int32())], names=["of", "item", "score", "first_word", "stop_word"])

    id_kind, item_kind = rows.schema["id"].dataType.simpleString(), items.schema["id"].dataType.simpleString()
    found = map_batches(texts.dropDuplicates(["of"]).join(lists, "of").select("of", "text", "items"), run,
                        f"of struct<id:{id_kind},th:long>, item {item_kind}, score double, first_word int, stop_word int")
    best = F.max(F.struct("score", "first_word", "stop_word")).alias("m")
    return found.groupBy("of", "item").agg(best).select("of.*", "item", "m.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all columns as they are."""
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"))
    bad = written(contaminated(docs, benchmark, id_col, text_col, **how).select(F.struct("id", "th").alias("bad")).distinct(), "contaminated")
    same = other_buckets(docs, key, bad, F.col("bad"))
    rows = keep_buckets(docs, key, bad, F.col("bad")).select(F.struct("*").alias("row"), key.alias("key"))
    return same.union(rows.join(bad, F.col("key") == F.col("bad"), "left_anti").select("row.*"))
