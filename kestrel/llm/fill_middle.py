"""Fill-in-middle transformation by secondary sort.

Every document is cut into units and a prefix, a middle and a suffix of whole units; runs of units go out as
pieces of bounded size, keyed by document and position in the output. One shuffle by document with a sort
inside the partitions (Spark's repartition and sort within partitions) brings each document's pieces in output
order; a task streams them into a digest and holds one piece at a time. Restoration reads that output stream
alone: it finds the markers, gives each piece its place in the text and sorts again inside the partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import rows_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The marked segments in the order of the output, by form: marker, and the segment's place in the text.
ORDERS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)), "plain": ((b"", 0),)}
#: Bytes of a piece, but for a longer unit's share; a unit is cut only where it is longer itself.
PIECE = 1 << 14

_SPACE = frozenset(b" \t\n\x0b\x0c\r")
_PART = "part long, at long, id {id}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, body binary"


def unit_ends(text: bytes, ends: np.ndarray) -> np.ndarray:
    """Ends of the units: words with the white space before them, and white space at the end by itself."""
    return np.append(ends, len(text)) if len(text) and text[-1] in _SPACE else ends


def draws(doc_id: object, seed: int) -> list[int]:
    """Four numbers of 32 bits from the seed and the document's id; a null id counts as the empty text."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(found[k:k + 8], 16) for k in range(0, 32, 8)]


def plan(text: bytes, ends: np.ndarray, doc_id: object, seed: int, rate: int, spm_rate: int) -> tuple[str, int, int]:
    """The form, and the bytes at which the middle begins and ends."""
    h = draws(doc_id, seed)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return "plain", 0, 0
    edge = np.concatenate([[0], ends])
    low, high = sorted((h[0] % len(edge), h[1] % len(edge)))
    return ("spm" if h[3] % 100 < spm_rate else "psm"), int(edge[low]), int(edge[high])


def chars(text: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80))


def chunks(lo: int, hi: int, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """The bytes [lo, hi) as runs of whole units of ``PIECE`` bytes at most, a longer unit cut."""
    while hi - lo > PIECE:
        k = int(np.searchsorted(ends, lo + PIECE, side="right")) - 1
        stop = int(ends[k]) if k >= 0 and ends[k] > lo else lo + PIECE
        yield lo, stop
        lo = stop
    if hi > lo:
        yield lo, hi


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """(part, at, id, n, form, prefix_chars, middle_chars, output_sha256, body): the pieces of each row of ``docs``.

    ``part`` is the row's number, so that rows which repeat an id stay apart. The piece at 0 is the row's head:
    the columns from id to middle_chars, without body; the others have only a body. ``rate`` and ``spm_rate``
    are shares in hundredths.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("part"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, min(batch.num_rows, int(batch.num_rows * (2 << 20) / max(1, batch.nbytes))))
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                texts, ids = rows_of(part, "text"), part.column(1).to_pylist()
                row, at, head, body = [], [], [], []
                for k, _, word_ends, _ in W.each_text(texts):
                    ends = unit_ends(texts[k], word_ends)
                    form, lo, hi = plan(texts[k], ends, ids[k], seed, rate, spm_rate)
                    cut = ((0, lo), (lo, hi), (hi, len(texts[k])))
                    plain = form == "plain"
                    found: list = [None]
                    for mark, segment in ORDERS[form]:
                        a, b = (0, len(texts[k])) if plain else cut[segment]
                        bodies = [texts[k][x:y] for x, y in chunks(a, b, ends)] or [b""]
                        found += [mark + bodies[0], *bodies[1:]]
                    row += [k] * len(found)
                    at += range(len(found))
                    body += found
                    head.append((k, len(ends), form, None if plain else chars(texts[k][:lo]), None if plain else chars(texts[k][lo:hi])))
                # rows come in order, one head each
                first = np.flatnonzero(np.array(at) == 0)
                put = np.full(len(row), -1)
                put[first] = np.arange(len(first))
                take = pa.array(put, mask=put < 0)
                values = [pa.array(x, t).take(take) for x, t in zip(zip(*[h[1:] for h in head]), (pa.int64(), pa.string(), pa.int64(), pa.int64()))]
                source = pa.array(np.array(row))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(source), pa.array(at, pa.int64()), part.column(1).take(pa.array(np.array(row), mask=put < 0)), *values,
                     pa.nulls(len(row), pa.string()), pa.array(body, pa.binary())],
                    names=["part", "at", "id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "body"])

    return rows.mapInArrow(run, _PART.format(id=kind))


class Places:
    """Gives the bytes of an output stream their places in the text: finds the markers, also across pieces."""

    def __init__(self, form: str):
        self.todo, self.rest, self.segment = list(ORDERS[form]), b"", None
        self._next()

    def _next(self) -> None:
        self.mark, self.coming = self.todo.pop(0) if self.todo else (b"", None)
        if not self.mark and self.coming is not None:  # a plain text has no markers
            self.segment, self.coming = self.coming, None

    def __call__(self, body: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        body, self.rest = self.rest + body, b""
        while self.coming is not None:
            at = body.find(self.mark)
            if at < 0:
                break
            if at:
                yield self.segment, body[:at]
            body, self.segment = body[at + len(self.mark):], self.coming
            self._next()
        if self.coming is not None and not last:  # a marker may go on in the next piece
            keep = min(len(body), len(self.mark) - 1)
            body, self.rest = body[:len(body) - keep], body[len(body) - keep:]
        if body:
            yield self.segment, body


#: Places in the text: segment number, then the number of the piece within the stream.
_SEGMENT = 1 << 48


def assembled(parts: DataFrame) -> DataFrame:
    """The sorted pieces streamed into each row's output: its digest, and its pieces at their places in the text.

    Returns the columns of ``pieces``; ``output_sha256`` is set in the heads, and ``at`` is the place in the
    text, which is derived from the output's bytes and its form alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, places, digest, count = None, None, None, 0
        out: list[tuple] = []
        size = 0

        def close() -> Iterator[tuple]:
            nonlocal count
            if head is not None:
                for segment, body in places(b"", last=True):
                    count += 1
                    yield (head[0], segment * _SEGMENT + count, None, None, None, None, None, None, body)
                yield (head[0], 0, *head[2:7], digest.hexdigest(), None)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns)]):
                if row[1] == 0:
                    out += close()
                    head, places, digest, count = row, Places(row[4]), hashlib.sha256(), 0
                    continue
                digest.update(row[8])
                for segment, body in places(row[8]):
                    count += 1
                    size += len(body)
                    out.append((row[0], segment * _SEGMENT + count, None, None, None, None, None, None, body))
                if size > 4 << 20 or len(out) > 8192:
                    yield batch_of(out)
                    out, size = [], 0
        out += close()
        if out:
            yield batch_of(out)

    dealt = parts.repartition("part").sortWithinPartitions("part", "at")
    return dealt.mapInArrow(run, _PART.format(id=parts.schema["id"].dataType.simpleString()))


def restored(parts: DataFrame, texts: bool = False) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) from ``assembled`` pieces.

    They are sorted again within their partitions, which hold whole rows, and streamed into a second digest.
    With ``texts`` the restored text follows, as bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, body = None, None, []

        def line() -> list[tuple]:
            return [] if head is None else [(*head[2:8], digest.hexdigest(), *([b"".join(body)] if texts else []))]

        kinds = None
        for batch in batches:
            kinds = kinds or pa.schema([*[batch.schema.field(k) for k in range(2, 8)], pa.field("restored_sha256", pa.string()),
                                        *([pa.field("text", pa.binary())] if texts else [])])
            out, size = [], 0
            for row in zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns)]):
                if row[1] == 0:
                    out += line()
                    head, digest, body = row, hashlib.sha256(), []
                else:
                    digest.update(row[8])
                    if texts:
                        body.append(row[8])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), kinds)], schema=kinds)
        if head is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*line()), kinds)], schema=kinds)

    kind = parts.schema["id"].dataType.simpleString()
    return parts.sortWithinPartitions("part", "at").mapInArrow(
        run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
        + (", text binary" if texts else ""))


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): one row for each row of ``docs``.

    A null or empty text has no units, the form plain and an empty output. A text that holds a marker stays
    plain, so that markers in an output are its own. Ids decide the cut: rows that repeat an id and a text give
    equal rows; a null id counts as the empty text. Texts are whole, of any length, in pieces of bounded size.
    Other columns play no part, whatever their names. An empty table gives an empty table.
    """
    return restored(assembled(pieces(docs, id_col, text_col, seed, rate, spm_rate)))


def outputs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """(id, form, text): the transformed texts themselves, for training files; the rules are those of ``fill_middle``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, body, out, kinds = None, [], [], None
        for batch in batches:
            kinds = pa.schema([batch.schema.field(2), batch.schema.field(4), pa.field("text", pa.string())])
            for row in zip(*[batch.column(k).to_pylist() for k in range(batch.num_columns)]):
                if row[1] == 0:
                    out += [] if head is None else [(head[2], head[4], b"".join(body).decode("utf-8", "replace"))]
                    head, body = row, []
                else:
                    body.append(row[8])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), kinds)], schema=kinds)
                out = []
        if head is not None:
            last = (head[2], head[4], b"".join(body).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(last, kinds)], schema=kinds)

    parts = pieces(docs, id_col, text_col, seed, rate, spm_rate)
    return (parts.repartition("part").sortWithinPartitions("part", "at")
            .mapInArrow(run, f"id {parts.schema['id'].dataType.simpleString()}, form string, text string"))


#: The same rows in SQL, for the seed and the shares above.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         ('0x' || substr(h, 1, 8))::UBIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT AS h2,
         ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4
  FROM d),
c AS (
  SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1))::BIGINT AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1))::BIGINT AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
