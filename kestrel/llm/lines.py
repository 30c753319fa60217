"""Line deduplication by a deletion-neighbourhood join.

A line is its sequence of words, lower-cased. Lines that are equal, or differ by one word replaced,
added or left out, are one line; its earliest occurrence, by document and position, stays.

Every variant of a line within the bound is emitted as a hashed key. Two lines that differ in the
word at place i share the variant without word i; a line with a word more has the other line itself
among its variants. Within a group of equal keys only the earliest line matters, so no pairs are
made. Only lines that share a half with another line emit variants: one edit leaves the first or the
last half of the shorter line as it is, so no others can be near.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bit_map, in_map, keep_buckets, map_batches, other_buckets, rows_of, written

_LINE = "h1", "h2"


def _lines(text: bytes, starts: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the lines with ``min_words`` words or more, and their runs of words."""
    breaks = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10)
    cut = np.concatenate([[0], np.searchsorted(starts, breaks), [len(starts)]])
    keep = np.flatnonzero(np.diff(cut) >= max(1, min_words))
    return keep, cut[keep], cut[keep + 1]


def line_rows(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """(id, th, line, h1, h2, halves) of the lines of ``docs`` (id, th, text); halves are keys of a
    line's first and last halves, none where it has fewer than ``near_words`` words."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, ids, ths = rows_of(batch, "text"), batch.column(0), batch.column(1)
        row, line, one, two, halves, sizes = [], [], [], [], [], []
        for at, starts, _, h in W.each_text(texts):
            number, lo, hi = _lines(texts[at], starts, min_words)
            if not len(number):
                continue
            runs, size = W.Runs(h), hi - lo
            row.append(np.full(len(number), at))
            line.append(number)
            one.append(runs.hash(lo, hi, 1))
            two.append(W.Runs(h, second=True).hash(lo, hi))
            near = size >= near_words
            keys = [runs.hash(lo, lo + p, 3) for p in (size // 2, (size - 1) // 2)]
            keys += [runs.hash(hi - p, hi, 4) for p in (size // 2, (size - 1) // 2)]
            use = np.stack([near, near & (size % 2 == 0)] * 2)
            sizes.append(use.sum(axis=0))
            halves.append(np.stack(keys).T[use.T])
        if not row:
            return
        at = pa.array(np.concatenate(row))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [ids.take(at), ths.take(at), pa.array(np.concatenate(line), pa.int32()),
             pa.array(np.concatenate(one).view(np.int64)), pa.array(np.concatenate(two).view(np.int64)),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(halves).view(np.int64)))],
            names=["id", "th", "line", "h1", "h2", "halves"])

    kind = docs.schema["id"].dataType.simpleString()
    return map_batches(docs, run, f"id {kind}, th long, line int, h1 long, h2 long, halves array<long>")


def line_words(rows: DataFrame) -> DataFrame:
    """(h1, h2, words) of the lines whose numbers ``rows`` (text, wanted) names; words is the run of their hashes."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = rows_of(batch, "text")
        one, two, found = [], [], []
        for at, starts, _, h in W.each_text(texts):
            number, lo, hi = _lines(texts[at], starts, 1)
            use = np.isin(number, batch.column(1)[at].as_py())
            lo, hi = lo[use], hi[use]
            one.append(W.Runs(h).hash(lo, hi, 1))
            two.append(W.Runs(h, second=True).hash(lo, hi))
            found += [h[a:b].tobytes() for a, b in zip(lo, hi)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(one).view(np.int64)),
                                          pa.array(np.concatenate(two).view(np.int64)), pa.array(found, pa.binary())],
                                         names=["h1", "h2", "words"])

    return map_batches(rows, run, "h1 long, h2 long, words binary")


def variants(lines: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """(key, kind, first) of ``lines`` (words, first): the deletion neighbourhood of each line, or its keys in a map.

    kind 0: the line without a word, the place told apart (lines that share it differ in that word);
    kind 1: the line without a word; kind 2: the line itself, to meet the variants of longer lines.
    """
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, kinds, owner = [], [], []
        for at, x in enumerate(rows_of(batch, "words")):
            h = np.frombuffer(x, dtype=np.uint64)
            runs, n = W.Runs(h), len(h)
            less = runs.without_each(5)
            placed = W.mix(less + np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            keys += [placed, np.unique(less), runs.hash(np.array([0]), np.array([n]), 5)]
            kinds += [np.zeros(n, np.int8), np.ones(len(keys[-2]), np.int8), np.full(1, 2, np.int8)]
            owner.append(np.full(n + len(keys[-2]) + 1, at))
        if keys:
            key, kind, row = np.concatenate(keys), np.concatenate(kinds), np.concatenate(owner)
            if wanted is not None:
                use = in_map(wanted, key)
                key, kind, row = key[use], kind[use], row[use]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(kind), batch.column(1).take(pa.array(row))],
                                             names=["key", "kind", "first"])

    rows = lines.select("words", "first")
    return map_batches(rows, run, f"key long, kind byte, first {rows.schema['first'].dataType.simpleString()}")


def near_lines(lines: DataFrame, firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """(h1, h2, first, earlier) of the distinct lines that an earlier line is near to, with one such line."""
    halves = lines.select("h1", F.explode("halves").alias("key"))
    shared = halves.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo != hi").select("key")
    active = halves.join(shared, "key", "left_semi").select("h1").distinct()
    active = written(firsts.join(active, "h1", "left_semi").select("h1", "h2", "first"), "active")

    # the words of an active line are read from the document that has it first
    wanted = active.groupBy(F.struct("first.id", "first.th").alias("key")).agg(F.collect_list("first.line").alias("wanted"))
    wanted = written(wanted, "wanted")
    text = keep_buckets(docs.select(F.struct("id", "th").alias("key"), "text"), F.col("key"), wanted, F.col("key"))
    words = line_words(text.join(wanted, "key").select("text", "wanted"))
    known = written(words.join(active, [*_LINE]).groupBy(*_LINE).agg(F.first("words").alias("words"), F.first("first").alias("first")), "known")
    # equal keys: the earliest line of each kind; without two lines a key tells nothing
    least = [F.min(F.when(F.col("kind") == k, F.col("first"))).alias(f"least{k}") for k in (0, 1, 2)]
    groups = variants(known).groupBy("key").agg(*least, F.min("first").alias("lo"), F.max("first").alias("hi")).where("lo != hi")
    groups = written(groups, "shared")
    keys = variants(known, bit_map(groups, "key"))  # few keys are shared: the others are not sent again
    other = F.when(F.col("kind") == 0, F.col("least0")).when(F.col("kind") == 1, F.col("least2")).otherwise(F.col("least1"))
    met = (keys.join(groups, "key").select("first", other.alias("earlier")).where("earlier < first")
           .groupBy("first").agg(F.min("earlier").alias("earlier")))
    pairs = (met.join(known, "first").select("first", "earlier", "h1", "h2", F.col("words").alias("a"))
             .join(known.select(F.col("first").alias("earlier"), F.col("words").alias("b")), "earlier"))
    return verified(pairs.select("h1", "h2", "first", "earlier", "a", "b"))


def one_edit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sequences differ by at most one element replaced, added or left out."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    differ = np.flatnonzero(a[:len(b)] != b)
    if not len(differ):
        return True
    i = int(differ[0])
    return bool(np.array_equal(a[i + 1:], b[i + 1:] if len(a) == len(b) else b[i:]))


def verified(pairs: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = [i for i, (a, b) in enumerate(zip(rows_of(batch, "a"), rows_of(batch, "b")))
                if one_edit(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64))]
        if keep:
            yield batch.select([0, 1, 2, 3]).take(pa.array(keep))

    first = pairs.schema["first"].dataType.simpleString()
    return map_batches(pairs, run, f"h1 long, h2 long, first {first}, earlier {first}")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5,
                  near_words: int = 10) -> DataFrame:
    """(id, th, line, kept_id, near): every line that is left out, with the document whose line stays.

    A line of fewer than ``min_words`` words is never left out, one of fewer than ``near_words`` only
    for an equal one. Lines come in the order of id (null first), hash of the text, and place; a line
    goes if any line before it is equal or near, whether or not that one stays itself. ``th`` is the
    hash of the text, so that documents that share an id are told apart; rows that repeat id and text
    are one document, and a line of theirs that stays, stays in each. Null and empty texts have no
    lines; an empty table gives an empty table. Bytes that are not UTF-8 are compared as they are, and become
    U+FFFD in a text that loses lines.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    lines = written(line_rows(rows, min_words, near_words), "lines")
    place = F.struct("id", "th", "line")
    firsts = (lines.groupBy(*_LINE).agg(F.min(place).alias("first"), F.max(place).alias("last"),
                                        F.max(F.size("halves")).alias("n_halves")))
    firsts = written(firsts, "firsts")
    near = written(near_lines(lines, firsts.where("n_halves > 0"), rows), "near")
    # lines that occur once and are near no other stay as they are and need no join
    known = (firsts.where("first != last").select(*_LINE, "first").join(near.select(*_LINE, F.col("earlier")), [*_LINE], "full")
             .join(near.select(*_LINE, F.col("first").alias("own")), [*_LINE], "left")
             .select(*_LINE, F.coalesce("first", "own").alias("first"), "earlier"))
    hits = keep_buckets(lines.select("id", "th", "line", *_LINE), F.col("h1"), known, F.col("h1")).join(known, [*_LINE])
    return (hits.where(F.col("earlier").isNotNull() | (place != F.col("first")))
            .select("id", "th", "line", F.coalesce("earlier.id", "first.id").alias("kept_id"),
                    F.col("earlier").isNotNull().alias("near")).distinct())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5,
                near_words: int = 10) -> DataFrame:
    """``docs`` without the lines of ``dropped_lines``, all columns as they are but the text.

    A document that loses lines and keeps none with a word goes; others stay, those without text too.
    """
    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, keep = rows_of(batch, "text"), []
        for at, gone in enumerate(batch.column(2)):
            if gone.is_valid:
                drop = set(gone.as_py())
                texts[at] = b"\n".join(x for i, x in enumerate(texts[at].split(b"\n")) if i not in drop)
            if not gone.is_valid or texts[at].strip(b" \t\n\r\x0b\x0c"):
                keep.append(at)
        new = pa.array([x.decode("utf-8", "replace") if t.is_valid else None for x, t in zip(texts, batch.column(1))], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), new], schema=pa.schema(
            [batch.schema.field(0), pa.field("text", pa.string())])).take(pa.array(keep, pa.int64()))

    gone = written(dropped_lines(docs, id_col, text_col, min_words, near_words)
                   .groupBy("id", "th").agg(F.collect_list("line").alias("gone")), "gone")
    gone = gone.select(F.struct("id", "th").alias("key"), "gone")
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"))
    # documents in buckets without a loser keep all their lines, and are not shuffled
    same = other_buckets(docs, key, gone, F.col("key"))
    rows = keep_buckets(docs, key, gone, F.col("key")).select(F.struct("*").alias("row"), key.alias("key"))
    joined = rows.join(gone, "key", "left").select("row", F.col(f"row.`{text_col}`").alias("text"), "gone")
    changed = map_batches(joined, cut, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    swap = F.col("row").withField(f"`{text_col}`", F.col("text"))
    return same.union(changed.select(swap.alias("row")).select("row.*"))
