"""Substring deduplication by sliding sentence spans.

A sentence ends at a line break or after a word that ends in ".", "!" or "?", closing quotes and brackets aside. The shortest runs of
several sentences with enough words that begin and that end at each sentence are hashed; a longer run
that repeats is covered by such runs, which repeat with it. A run that occurs more than once is kept
where it comes first, by document and place; sentences covered by any other occurrence go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import keep_buckets, map_batches, other_buckets, rows_of, written


def sentence_starts(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of the words that begin a sentence."""
    if not len(starts):
        return starts
    data = np.frombuffer(text, dtype=np.uint8)
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    # closing quotes and brackets after the mark: ASCII ones, and the last bytes of ” ’ »
    end, begin = ends.copy(), starts
    for _ in range(3):
        one = (end - 1 > begin) & np.isin(data[end - 1], (34, 39, 41, 93, 125))
        last = data[end - 1]
        three = (end - 3 > begin) & (data[np.maximum(end - 3, 0)] == 0xE2) & (data[np.maximum(end - 2, 0)] == 0x80) & ((last == 0x9D) | (last == 0x99))
        two = (end - 2 > begin) & (data[np.maximum(end - 2, 0)] == 0xC2) & (last == 0xBB)
        end = end - one - 3 * three - 2 * two
    stop = np.isin(data[end - 1], (33, 46, 63))
    return np.flatnonzero(np.concatenate([[True], stop[:-1] | (line[1:] != line[:-1])]))


def shortest_runs(bound: np.ndarray, sentences: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First sentences and ends of the shortest runs from each sentence and up to each, each run once.

    ``bound`` holds the first word of each sentence and the number of words. Where a run's last
    sentences are too short to begin one themselves, the shortest run up to its end holds them.
    """
    n = len(bound) - 1
    at, stop = np.arange(n), np.arange(1, n + 1)
    end = np.maximum(at + sentences, np.searchsorted(bound, bound[:-1] + min_words))
    begin = np.minimum(stop - sentences, np.searchsorted(bound, bound[1:] - min_words, side="right") - 1)
    begin, end = np.concatenate([at, begin]), np.concatenate([end, stop])
    use = (begin >= 0) & (end <= n)
    return np.divmod(np.unique(begin[use] * (n + 1) + end[use]), n + 1)


def span_rows(rows: DataFrame, sentences: int, min_words: int) -> DataFrame:
    """(id, th, at, length, h1, h2) of the runs in ``rows`` (id, th, text): first sentence, number of sentences, hash."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, row, at, size, one, two = rows_of(batch, "text"), [], [], [], [], []
        for k, starts, ends, h in W.each_text(texts):
            first = sentence_starts(texts[k], starts, ends)
            bound = np.append(first, len(h))
            begin, end = shortest_runs(bound, sentences, min_words)
            if not len(begin):
                continue
            runs, lo, hi = W.Runs(h), bound[begin], bound[end]
            row.append(np.full(len(begin), k))
            at.append(begin)
            size.append(end - begin)
            one.append(runs.hash(lo, hi, 1))
            two.append(W.Runs(h, second=True).hash(lo, hi))
        if row:
            take = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(at), pa.int32()),
                 pa.array(np.concatenate(size), pa.int32()), pa.array(np.concatenate(one).view(np.int64)),
                 pa.array(np.concatenate(two).view(np.int64))], names=["id", "th", "at", "length", "h1", "h2"])

    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, th long, at int, length int, h1 long, h2 long")


def document_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: int = 2,
                   min_words: int = 16) -> DataFrame:
    """(id, th, at, length, kept_id): every run that occurred before, with the document it occurs in first.

    Runs come in the order of id (null first), hash of the text, and place; rows that repeat id and
    text are one document. ``th`` is the hash of the text. Texts of fewer sentences or words, null
    and empty ones have no runs; an empty table gives an empty table.
    """
    spans = span_rows(document_rows(docs, id_col, text_col), sentences, min_words)
    place = F.struct("id", "th", "at")
    firsts = (spans.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
              .where("first != last").select("h1", "h2", "first"))
    firsts = written(firsts, "repeated")
    again = keep_buckets(spans, F.col("h1"), firsts, F.col("h1")).join(firsts, ["h1", "h2"])
    return (again.where(place != F.col("first"))
            .select("id", "th", "at", "length", F.col("first.id").alias("kept_id")))


def covered(spans: DataFrame) -> DataFrame:
    """(id, th, gone, kept_ids): the numbers of the sentences that each document loses, in order."""
    return (spans.select("id", "th", F.explode(F.sequence("at", F.col("at") + F.col("length") - 1)).alias("at"), "kept_id")
            .groupBy("id", "th").agg(F.sort_array(F.collect_set("at")).alias("gone"), F.sort_array(F.collect_set("kept_id")).alias("kept_ids")))


def without(text: bytes, gone: set[int]) -> bytes:
    """A text without some sentences, each cut from its first word to the next sentence's."""
    starts, ends, _ = W.hash_words(text)
    first = starts[sentence_starts(text, starts, ends)].tolist()
    cut = [0, *first[1:], len(text)]
    return b"".join(text[a:b] for k, (a, b) in enumerate(zip(cut, cut[1:])) if k not in gone).rstrip(b" \t\n\r\x0b\x0c")


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: int = 2,
                min_words: int = 16) -> DataFrame:
    """``docs`` without the sentences of ``repeated_spans``; a text may become "". Other columns are as they were."""
    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        new = [without(x, set(g.as_py())).decode("utf-8", "replace") if g.is_valid else t.as_py()
               for x, t, g in zip(rows_of(batch, "text"), batch.column(1), batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())],
                                         schema=pa.schema([batch.schema.field(0), pa.field("text", pa.string())]))

    gone = written(covered(repeated_spans(docs, id_col, text_col, sentences, min_words))
                   .select(F.struct("id", "th").alias("key"), "gone"), "gone")
    key: Column = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"))
    same = other_buckets(docs, key, gone, F.col("key"))
    rows = keep_buckets(docs, key, gone, F.col("key")).select(F.struct("*").alias("row"), key.alias("key"))
    joined = rows.join(gone, "key", "left").select("row", F.col(f"row.`{text_col}`").alias("text"), "gone")
    changed = map_batches(joined, cut, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    swap = F.col("row").withField(f"`{text_col}`", F.col("text"))
    return same.union(changed.select(swap.alias("row")).select("row.*"))
