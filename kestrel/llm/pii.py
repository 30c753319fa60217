"""Personal data by patterns and by bootstrapped contexts.

The base finds e-mail and IP addresses, card and phone numbers by their form. These are seeds: the
words around them induce lexical patterns. Occurrences of anything that looks somewhat like an
identifier form a graph of patterns and instances. In each round a pattern's confidence is the mean
score of the distinct instances it matches, and an instance's score is one less the odds that all its
confident patterns are wrong; seeds score 1. Confident patterns then name identifiers that the base
has not: addresses without a domain's ending, numbers whose check digit is wrong, phones without "+".

They also propose what stands in their slots. Every token of every text is looked up by the words around it; of
a pattern whose slots hold seeds and named identifiers for the most part, the tokens with a digit, an "@" or
an inner mark are identifiers too, whatever their form.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bit_map, in_map, map_batches, rows_of, written

#: In the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

# fixed values: the forms of the base kinds; a start inside a run of digits can never do better than its first
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")
#: What may be an identifier: something@something, and numbers of seven digits or more, with separators.
NUMBER = re.compile(r"(?<![A-Za-z0-9])[0-9](?:[\x20().:-]{0,2}+[0-9]){6,}+(?![A-Za-z0-9])")
#: What a token in a slot must have to be an identifier, and the marks that do not belong to it at its ends.
IDENTIFIER = re.compile(r"[0-9@]|\w[._+-]\w")
EDGES = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>*`"


def luhn(digits: str) -> bool:
    total = 0
    for at, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if at % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, stop, matches) around each "@" with a local part; leftmost, not overlapping."""
    at, free = -1, 0
    while (at := text.find("@", at + 1)) >= 0:
        head = text[free:at]
        start = free + len(head.rstrip(LOCAL))
        if start < at:
            m = DOMAIN.match(text, at + 1)
            if m:
                yield start, m.end(), True
                free = m.end()
                at = free - 1
                continue
            yield start, at + 1, False
        free = max(free, at)


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not ANY.search(text):
        return out
    out["email"] = [(a, b) for a, b, ok in emails(text) if ok]
    for m in IP.finditer(text):
        if all(len(x) <= 3 and int(x) <= 255 for x in (p.lstrip("0") or "0" for p in m[0].split("."))):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out["card"].append(m.span())
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m[0])) <= 15:
            out["phone"].append(m.span())
    return out


def listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def _looks_like(piece: str) -> str:
    """The kind whose looser form a candidate has."""
    n = len(digits_of(piece))
    if "@" in piece:
        return "email"
    if piece.count(".") == 3 and n <= 12 and not set(piece) - set("0123456789."):
        return "ip"
    return "card" if n >= 13 else "phone"


def candidates(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """(kind, start, stop) of what may be an identifier and overlaps no base span."""
    found = []
    for a, b, ok in emails(text):
        if not ok:
            m = re.compile(r"[A-Za-z0-9.-]*[A-Za-z0-9]").match(text, b)
            if m and m.end() > b:
                found.append((a, m.end()))
    found += [m.span() for m in NUMBER.finditer(text)]
    taken = sorted(taken)
    at, last = 0, -1
    for a, b in sorted(found):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if a >= last and not (at < len(taken) and taken[at][0] < b):
            last = b
            yield _looks_like(text[a:b]), a, b


@dataclass
class Around:
    """The words of a text, parted by spaces and ASCII marks, by which contexts are named."""

    raw: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray

    @staticmethod
    def of(raw: bytes) -> Around:
        return Around(raw, *W.hash_words(raw, "marks"))

    def sides(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the first words from the bytes ``start`` on, and after the bytes ``stop``."""
        return np.searchsorted(self.ends, start, "right"), np.searchsorted(self.starts, stop)

    def patterns(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the three patterns of each slot, and which of them there are: the two words before, the word
        before and the one after, the two after."""
        n, h = len(self.hashes), np.append(self.hashes, np.zeros(2, np.uint64))
        pick = lambda at: h[np.clip(at, 0, n)]
        pairs = ((left - 2, left - 1), (left - 1, right), (right, right + 1))
        keys = [W.mix(pick(a) * np.uint64(0x9E3779B97F4A7C15) + W.mix(pick(b)) + np.uint64(k)) for k, (a, b) in enumerate(pairs)]
        return np.stack(keys, axis=1), np.stack([(a >= 0) & (b < n) for a, b in pairs], axis=1)

    def names(self, left: int, right: int) -> list[str]:
        word = lambda k: self.raw[self.starts[k]:self.ends[k]].decode("utf-8", "replace").lower() if 0 <= k < len(self.starts) else ""
        return [f"{word(left - 2)} {word(left - 1)} _", f"{word(left - 1)} _ {word(right)}", f"_ {word(right)} {word(right + 1)}"]


def byte_places(raw: bytes, text: str) -> np.ndarray | None:
    """The byte at which each code point begins, and the end; None where they are the same."""
    if len(raw) == len(text):
        return None
    clean = raw if raw.decode("utf-8", "replace").encode() == raw else text.encode()
    data = np.frombuffer(clean, dtype=np.uint8)
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def marked(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, stop, seed) of the base spans and the candidates of a text."""
    base = base_spans(text)
    spans = [(k, a, b, True) for k in KINDS for a, b in base[k]]
    return spans + [(k, a, b, False) for k, a, b in candidates(text, [x for k in KINDS for x in base[k]])]


_PATTERNS = "array<struct<pattern:long,words:string>>"


def occurrences(rows: DataFrame) -> DataFrame:
    """(id, th, kind, seed, start, stop, instance, patterns) of seeds and candidates in ``rows`` (id, th, text)."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = []
        for at, raw in enumerate(rows_of(batch, "text")):
            text = raw.decode("utf-8", "replace")
            if not ANY.search(text) or not (spans := marked(text)):
                continue
            around, place = Around.of(text.encode()), byte_places(text.encode(), text)
            a, b = (np.array([x[k] for x in spans]) for k in (1, 2))
            left, right = around.sides(*((a, b) if place is None else (place[a], place[b])))
            keys, there = around.patterns(left, right)
            for k, (kind, start, stop, seed) in enumerate(spans):
                names = around.names(int(left[k]), int(right[k]))
                patterns = [{"pattern": int(np.int64(keys[k, j].view(np.int64))), "words": names[j]} for j in range(3) if there[k, j]]
                got.append((at, kind, seed, start, stop, text[start:stop].lower(), patterns))
        if got:
            at, *cols = zip(*got)
            at = pa.array(at, pa.int64())
            kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("pattern", pa.int64()), ("words", pa.string())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *[pa.array(x, t) for x, t in zip(cols, kinds)]],
                names=["id", "th", "kind", "seed", "start", "stop", "instance", "patterns"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"id {kind}, th long, kind string, seed boolean, start long, stop long, instance string, patterns {_PATTERNS}")


def slots(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """(id, th, pattern, start, stop, use, n): the tokens of all ``rows`` (id, th, text) that may stand in a pattern's slot.

    ``use`` is "new" for a token that looks like an identifier; seeds and candidates ("known") and other words
    ("plain") are counted by pattern in each task, without places. Patterns are looked up in a bit map, so a join
    with them must follow.
    """
    wanted = bit_map(patterns, "pattern")
    names = ["id", "th", "pattern", "start", "stop", "use", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, str]] = Counter()
        kinds = None
        for whole in batches:
            kinds = whole.schema.field(0).type, whole.schema.field(1).type
            step = max(1, min(whole.num_rows, int(whole.num_rows * (2 << 20) / max(1, whole.nbytes))))
            for begin in range(0, whole.num_rows, step):
                yield from tokens(whole.slice(begin, step), counts)
        if counts:
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, kinds[0]), pa.nulls(n, kinds[1]), pa.array([k for k, _ in counts], pa.int64()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.array([u for _, u in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=names)

    def tokens(batch: pa.RecordBatch, counts: Counter) -> Iterator[pa.RecordBatch]:
        got = []
        for at, raw in enumerate(rows_of(batch, "text")):
            around = Around.of(raw)
            start, stop, _ = W.hash_words(raw)
            if not len(start):
                continue
            keys, there = around.patterns(*around.sides(start, stop))
            hit = there & in_map(wanted, keys.ravel()).reshape(keys.shape)
            if not hit.any():
                continue
            text = raw.decode("utf-8", "replace")
            place = byte_places(raw, text)
            if place is not None and place[-1] != len(raw):
                continue  # bytes that are not UTF-8: places in the text can't be told
            spans = sorted((a, b) for _, a, b, _ in marked(text))
            begins = np.array([a for a, _ in spans])
            for k in np.flatnonzero(hit.any(axis=1)):
                a, b = (int(start[k]), int(stop[k])) if place is None else (int(x) for x in np.searchsorted(place, (start[k], stop[k])))
                token = text[a:b]
                a, b = a + len(token) - len(token.lstrip(EDGES)), b - len(token) + len(token.rstrip(EDGES))
                near = int(np.searchsorted(begins, b)) - 1
                known = near >= 0 and spans[near][1] > a
                use = "known" if known else "new" if a < b and IDENTIFIER.search(text, a, b) else "plain"
                found = [int(keys[k, j].view(np.int64)) for j in np.flatnonzero(hit[k])]
                if use == "new":
                    got += [(at, x, a, b) for x in found]
                else:
                    counts.update((x, use) for x in found)
        if got:
            at, *cols = zip(*got)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *[pa.array(x, pa.int64()) for x in cols],
                                              pa.array(["new"] * len(at)), pa.array([1] * len(at), pa.int64())], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, th long, pattern long, start long, stop long, use string, n long")


def slot_spans(rows: DataFrame, patterns: DataFrame, how: Bootstrap) -> DataFrame:
    """(id, th, kind, start, stop) of the tokens that confident patterns propose.

    A pattern proposes them where seeds and candidates are ``confidence`` of all that its slots hold. A token
    that patterns of several kinds propose is of the kind of the most confident.
    """
    if patterns.isEmpty():
        return rows.select("id", "th", F.lit("").alias("kind"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("stop")).where("false")
    found = written(slots(rows, patterns), "slots")
    n = F.coalesce(F.sum(F.when(F.col("use") == "known", F.col("n"))), F.lit(0)).alias("known")
    share = (found.groupBy("pattern").agg(n, F.coalesce(F.sum(F.when(F.col("use") != "new", F.col("n"))), F.lit(0)).alias("n"))
             .where(F.col("known") >= how.confidence * F.col("n")))
    best = F.max(F.struct("confidence", "kind")).getField("kind").alias("kind")
    return (found.where("use = 'new'").drop("n").join(share, "pattern").join(patterns, "pattern").groupBy("id", "th", "start", "stop").agg(best)
            .select("id", "th", "kind", "start", "stop"))


@dataclass(frozen=True)
class Bootstrap:
    """A pattern counts from ``support`` distinct seeds on, and names identifiers from ``confidence`` on."""

    rounds: int = 3
    support: int = 3
    confidence: float = 0.6


def bootstrap(found: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """(kind, pattern, words, confidence) of the confident patterns of ``occurrences``, scored in rounds.

    A pattern is scored for a kind by the instances of that kind's form it matches; instances of other
    kinds count against it.
    """
    edges = written(found.select("kind", "seed", F.xxhash64("kind", "instance").alias("instance"), F.inline("patterns"))
                    .groupBy("pattern", "kind", "instance").agg(F.max("seed").alias("seed"), F.min("words").alias("words")), "edges")
    size = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    patterns = None
    for _ in range(how.rounds):
        if patterns is None:
            scored = edges.withColumn("score", F.col("seed").cast("double"))
        else:
            wrong = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))
            odds = edges.where("not seed").join(patterns.drop("words"), ["kind", "pattern"]).groupBy("kind", "instance").agg((1 - F.exp(wrong)).alias("odds"))
            scored = (edges.join(odds, ["kind", "instance"], "left")
                      .withColumn("score", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.coalesce("odds", F.lit(0.0)))))
        patterns = (scored.groupBy("kind", "pattern").agg(F.sum("score").alias("score"), F.sum(F.col("seed").cast("int")).alias("seeds"),
                                                             F.min("words").alias("words"))
                    .where(F.col("seeds") >= how.support).join(size, "pattern")
                    .select("kind", "pattern", "words", (F.col("score") / (F.col("n") + 1)).alias("confidence"))
                    .where(F.col("confidence") >= how.confidence))
        patterns = written(patterns, "patterns")
    return patterns


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Bootstrap = Bootstrap()) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, added, spans): one row for each row of ``docs``.

    ``base`` lists the base spans as kind:start:stop, by kind and start, in code points; ``added`` those
    that contexts add, as context_kind; ``spans`` all of them by kind and start, under the kinds' own names.
    Each is comma-joined, "" if there are none.

    A null or empty text has no spans. Ids may be null; rows that share id and text are given the same
    spans each. Bytes that are not UTF-8 count as U+FFFD. An empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    found = written(occurrences(rows), "occurrences")
    patterns = bootstrap(found, how)
    named = (found.where("not seed").select("id", "th", "kind", "start", "stop", F.inline("patterns")).join(patterns.drop("words"), ["kind", "pattern"])
             .select("id", "th", "kind", "start", "stop").union(slot_spans(rows, patterns, how)).distinct())
    place = F.array(*[F.lit(k) for k in KINDS])
    span = lambda kind, start, stop: F.struct(F.array_position(place, kind).alias("at"), start.alias("start"), stop.alias("stop"), kind.alias("kind"))
    added = named.groupBy(F.struct("id", "th").alias("key")).agg(
        F.sort_array(F.collect_list(span(F.col("kind"), F.col("start"), F.col("stop")))).alias("more"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        spans = [base_spans(x.decode("utf-8", "replace")) for x in rows_of(batch, "text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array([len(s[k]) for s in spans], pa.int64()) for k in KINDS],
             pa.array([listed(s) for s in spans], pa.string())],
            names=["id", "th", *[f"n_{k}" for k in KINDS], "base"])

    def joined(spans, prefix: str = ""):
        return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
            ":", F.concat(F.lit(prefix), x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))))

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    base = map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, th long, {counts}, base string")
    parts = F.transform(F.split(F.when(F.col("base") != "", F.col("base")), ","), lambda x: F.split(x, ":"))
    own = F.transform(parts, lambda x: span(x[0], x[1].cast("long"), x[2].cast("long")))
    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(joined(F.sort_array(F.concat(F.coalesce(own, F.array()), "more"))))
    return (base.withColumn("key", F.struct("id", "th")).join(added, "key", "left")
            .select("id", *[f"n_{k}" for k in KINDS], "base", F.coalesce(joined(F.col("more"), "context_"), F.lit("")).alias("added"),
                    every.alias("spans")))
