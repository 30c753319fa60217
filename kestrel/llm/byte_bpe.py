"""Byte-level BPE encoding and decoding with numpy matrices.

A text is cut by the vocabulary's pattern; each piece is encoded by itself. A piece that is a token is that
token. The other distinct pieces of a batch are dealt to matrices by length, one piece a row, padded at the
end. In every round each row merges its leftmost pair of the least rank, the pair's rank is looked up in a
hash table, and the columns behind the merge move up (compaction); rows without a pair that can merge leave.

The rank file is read once, by the driver, and broadcast: its size does not depend on the data.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows_of

#: No pair: above every rank.
NONE = np.int32(2**31 - 1)
_PAD = np.int32(-1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Ranks of pairs of tokens in a hash table with open addressing, looked up by whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(4 * len(rank)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << bits, NONE, dtype=np.int32)
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot, todo = self._slots(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.ranks[slot[put]] = key[put], rank[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where the two do not merge or one is padding."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(len(left), NONE, dtype=np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left[at].astype(np.int64) << 32) | right[at].astype(np.int64)
        slot = self._slots(key)
        while len(at):
            held = self.keys[slot]
            hit = held == key
            out[at[hit]] = self.ranks[slot[hit]]
            go = ~hit & (held != -1)
            at, key, slot = at[go], key[go], (slot[go] + 1) & self.mask
        return out.reshape(shape)


@dataclass
class Vocabulary:
    """Tokens by rank (an id is a rank), the pairs that merge, and the pattern that cuts texts."""

    pattern: str
    tokens: list[bytes]
    single: np.ndarray
    pairs: PairTable

    @staticmethod
    def of(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        """``ranks`` must hold all 256 bytes; two tokens merge where their bytes in a row are a token."""
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            tokens[r] = token
        return Vocabulary(pattern, tokens, np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32),
                          PairTable(np.array(left, dtype=np.int32), np.array(right, dtype=np.int32), np.array(rank, dtype=np.int32)))

    @staticmethod
    def load(path: str, pattern: str) -> Vocabulary:
        """A rank file: lines of a token in base64 and its rank."""
        with open(path, "rb") as f:
            return Vocabulary.of({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}, pattern)


#: Cells of a matrix at most, but for a single longer piece.
CELLS = 1 << 19
#: Bytes from which a piece is merged by itself.
WIDE = 256


def merge_matrix(rows: np.ndarray, pairs: PairTable) -> np.ndarray:
    """Each row's tokens after all merges, padded at the end. One merge a row and round, leftmost least rank first."""
    rows = rows.copy()
    rank = pairs(rows[:, :-1], rows[:, 1:])
    active = np.arange(len(rows))
    work = rows
    while len(active) and rank.shape[1]:
        at = rank.argmin(axis=1)
        best = rank[np.arange(len(active)), at]
        go = best != NONE
        if not go.all():  # finished rows leave
            rows[active[~go], :work.shape[1]] = work[~go]
            rows[active[~go], work.shape[1]:] = _PAD
            active, work, rank, at, best = active[go], work[go], rank[go], at[go], best[go]
            if not len(active):
                break
        line, width = np.arange(len(active)), work.shape[1]
        work[line, at] = best
        # the columns behind the merged pair move up by one
        column = np.arange(width - 1)
        work = np.take_along_axis(work, column + (column[None, :] > at[:, None]), axis=1)
        column = np.arange(width - 2)
        rank = np.take_along_axis(rank, column + (column[None, :] >= at[:, None]), axis=1)
        if width > 2:
            before = np.flatnonzero(at > 0)
            rank[before, at[before] - 1] = pairs(work[before, at[before] - 1], work[before, at[before]])
            after = np.flatnonzero(at < width - 2)
            rank[after, at[after]] = pairs(work[after, at[after]], work[after, at[after] + 1])
    if len(active):
        rows[active, :work.shape[1]] = work
        rows[active, work.shape[1]:] = _PAD
    return rows


def merge_wide(row: np.ndarray, pairs: PairTable) -> np.ndarray:
    """The same for one long piece, where a round makes all merges of the least rank that one by one would come next.

    From left to right, without overlaps, they follow one another unless a merge makes a pair of that rank or a
    lesser one; where one does, the round makes the first merge only.
    """
    rank = pairs(row[:-1], row[1:])
    while len(rank):
        least = rank.min()
        if least == NONE:
            break
        at = np.flatnonzero(rank == least)
        run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        left = np.where(np.diff(at, prepend=-3) == 2, least, row[at - 1])
        left[at == 0] = _PAD
        right = np.where(at + 2 < len(row), row[np.minimum(at + 2, len(row) - 1)], _PAD)
        made = np.full(len(at), least, dtype=np.int32)
        if min(pairs(left, made).min(), pairs(made, right).min()) <= least:
            at = at[:1]
        row[at] = least
        row, rank = np.delete(row, at + 1), np.delete(rank, at)
        now = at - np.arange(len(at))  # where the merged tokens stand
        for near in (now[now > 0] - 1, now[now < len(rank)]):
            rank[near] = pairs(row[near], row[near + 1])
    return row


def merge_pieces(pieces: Sequence[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """The tokens of each piece, in matrices by length."""
    out: list[np.ndarray] = [np.empty(0, dtype=np.int32)] * len(pieces)
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    bucket = np.ceil(np.log2(np.maximum(size, 1))).astype(int)
    for b in np.unique(bucket):
        inside, width = np.flatnonzero(bucket == b), 1 << int(b)
        if width > WIDE:
            for k in inside:
                out[k] = merge_wide(vocabulary.single[np.frombuffer(pieces[k], dtype=np.uint8)], vocabulary.pairs)
            continue
        step = max(1, CELLS // width)
        for lo in range(0, len(inside), step):
            part = inside[lo:lo + step]
            body = np.frombuffer(b"".join(pieces[k] for k in part), dtype=np.uint8)
            rows = np.full((len(part), max(2, width)), _PAD, dtype=np.int32)
            rows[np.arange(max(2, width))[None, :] < size[part][:, None]] = vocabulary.single[body]
            rows = merge_matrix(rows, vocabulary.pairs)
            for k, row, n in zip(part, rows, (rows >= 0).sum(axis=1)):
                out[k] = row[:n].copy()
    return out


class _Numbers(dict):
    """A number for each piece, in the order in which pieces are first asked for."""

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        return n


def gather(body: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices ``body[start:start + size]`` in a row."""
    end = np.cumsum(size)
    return body[np.repeat(start - end + size, size) + np.arange(end[-1] if len(end) else 0)]


class Encoder:
    """Encodes texts; remembers the tokens of pieces that it has seen, at most ``MEMORY`` of them."""

    MEMORY = 1 << 18

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.pattern = vocabulary, regex.compile(vocabulary.pattern)
        self.known = {token: r for r, token in enumerate(vocabulary.tokens) if token}
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.start, self.size = _Numbers(), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.body = np.empty(0, dtype=np.uint32)

    def _learn(self, pieces: list[bytes]) -> None:
        whole = [self.known.get(p) for p in pieces]
        rest = iter(merge_pieces([p for p, r in zip(pieces, whole) if r is None], self.vocabulary))
        found = [np.array([r], dtype=np.int32) if r is not None else next(rest) for r in whole]
        size = np.array([len(x) for x in found], dtype=np.int64)
        self.start = np.concatenate([self.start, len(self.body) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.body = np.concatenate([self.body, np.concatenate(found).astype(np.uint32)])

    def __call__(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        if len(self.numbers) > self.MEMORY:
            self._forget()
        cut = [self.pattern.findall(t) for t in texts]
        before = len(self.numbers)
        each = [len(x) for x in cut]
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=sum(each))
        if len(self.numbers) > before:
            new = [*islice(reversed(self.numbers), len(self.numbers) - before)][::-1]
            self._learn([p.encode("utf-8", "replace") for p in new])
        size = self.size[number]
        ids = gather(self.body, self.start[number], size)
        edge = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *each])]
        return [ids[a:b] for a, b in zip(edge, edge[1:])]


class Decoder:
    """Bytes of ids; an id without a token stands for none."""

    def __init__(self, vocabulary: Vocabulary):
        self.size = np.array([*map(len, vocabulary.tokens), 0], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.body = np.frombuffer(b"".join(vocabulary.tokens), dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        at = np.minimum(ids.astype(np.int64), len(self.size) - 1)
        return gather(self.body, self.start[at], self.size[at]).tobytes()


def shared(spark: SparkSession, path: str, pattern: str):
    """The vocabulary as a broadcast variable."""
    return spark.sparkContext.broadcast(Vocabulary.load(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): one row for each row of ``docs``; ids are unsigned 32-bit integers, the low byte first.

    A null or empty text has no tokens (ids of no bytes). Bytes that are not UTF-8 count as U+FFFD. Texts of any
    length and pieces of any length are encoded whole. Repeated rows and null ids come back as they came; other
    columns play no part, whatever their names. An empty table gives an empty table.
    """
    vocabulary = shared(docs.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Encoder(vocabulary.value)
        for batch in batches:
            step = max(1, min(batch.num_rows, int(batch.num_rows * (2 << 20) / max(1, batch.nbytes))))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = work([x.decode("utf-8", "replace") for x in rows_of(part, "text")])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], names=["id", "n_tokens", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids binary")


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes): the bytes that the ids of each row stand for, one row for each row of ``tokens``.

    Null ids stand for no bytes, and so does an id that the vocabulary does not hold.
    """
    vocabulary = shared(tokens.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Decoder(vocabulary.value)
        for batch in batches:
            found = [work(np.frombuffer(x, dtype="<u4")) for x in rows_of(batch, "ids")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "bytes"])

    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each row: digests of what ``encode`` gives and ``decode`` makes of it.

    The rules for nulls, empty and repeated rows are those of ``encode``.
    """
    coded = encode(docs, path, pattern, id_col, text_col)
    carried = F.struct("id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256")).alias("id")
    return decode(coded.select(carried, "ids"), path, pattern).select("id.*", F.sha2("bytes", 256).alias("decoded_sha256"))
