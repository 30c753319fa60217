"""Whitening, fill-in-middle and byte-level BPE against plain Python versions and the public library."""

import base64
import hashlib
import random
import re
import struct

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from kestrel.llm import byte_bpe, fill_middle, whitening
from kestrel.llm.queries import ORACLE_SQL, QUERIES

from . import brute

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 7, "v") for r in rows], f"vec_id long, embedding array<{kind}>, id int, v string")


def plain_whitening(rows, most=32):
    """{vec_id: (deviation, whitened up to signs)}, shares, number of vectors; for distinct ids."""
    x = {k: [int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for k, v in rows}
    n, d = len(x), len(next(iter(x.values())))
    sums = [sum(r[j] for r in x.values()) for j in range(d)]
    cov = np.array([[sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x.values()) / n**3 for j in range(d)] for i in range(d)])
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:most], vec[:, ::-1][:, :most]
    away = {k: [n * r[j] - sums[j] for j in range(d)] for k, r in x.items()}
    return {k: (sum(a * a for a in v), np.array(v) / n @ vec / np.sqrt(e)) for k, v in away.items()}, e / np.trace(cov), n


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e12])
def test_whitening_equals_the_plain_version(spark, scale):
    rng = np.random.default_rng(3)
    mixed = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) * scale if scale != 1e-3 else rng.normal(size=(300, 6)) * [9, 7, 5, 3, 2, 1]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(mixed)]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] + [0.0] * 5), (903, [float("inf")] + [0.0] * 5), (904, [])]
    got = whitening.whiten(vectors(spark, rows + bad, "double").repartition(5)).collect()
    want, share, n = plain_whitening(rows)
    assert len(got) == 300 * 6 and {r["n"] for r in got} == {n}
    by = {(r["id"], r["component"]): r for r in got}
    sign = [1 if abs(by[0, c + 1]["whitened"] - want[0][1][c]) < 1e-6 else -1 for c in range(6)]
    for k, (deviation, w) in want.items():
        for c in range(6):
            r = by[k, c + 1]
            assert int(r["deviation"]) == deviation
            assert abs(r["whitened"] * sign[c] - w[c]) < 1e-6
            assert abs(r["explained"] / share[c] - 1) < 1e-6
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-6


def test_scatter_is_exact():
    rng = np.random.default_rng(4)
    for most in (1, 2, 300, 2**40, 2**61):
        x = rng.integers(-most, most + 1, (130, 5))
        least, top = x.min(axis=0), x.max(axis=0)
        bits = [int(b - a).bit_length() for a, b in zip(least.tolist(), top.tolist())]
        shifted = [[int(v) - int(m) for v, m in zip(r, least)] for r in x]
        want = [[sum(r[i] * r[j] for r in shifted) for j in range(5)] for i in range(5)]
        assert whitening.scatter(x, least.tolist(), bits) == want


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [float("nan")])])).collect() == []
    one = whitening.whiten(vectors(spark, [(1, [0.5, 0.25])])).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(0, 0.0, 0.0, 0.0)] * 2
    again = whitening.whiten(vectors(spark, [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [1.5, 0.25]), (None, [1.5, 0.25])])).collect()
    assert len(again) == 8 and {abs(round(r["whitened"], 9)) for r in again if r["component"] == 1} == {1.0}
    assert {r["whitened"] for r in again if r["component"] == 2} == {0.0}
    far = whitening.whiten(vectors(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0])], "double")).collect()
    assert len(far) == 4 and all(np.isfinite(r["whitened"]) for r in far)
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(vectors(spark, [(1, [0.5, 0.25]), (2, [0.5])]).coalesce(1)).collect()


def test_whitening_query(spark, sf_small):
    got = QUERIES["op11_bit_sliced_whitening"](spark, sf_small)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.collect()
    given = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, share, n = plain_whitening(given)
    assert len(rows) == 32 * n
    for r in rows:
        deviation, w = want[r["vec_id"]]
        assert r["deviation"] == int(r["deviation_exact"]) == deviation and abs(abs(r["whitened"]) - abs(w[r["component"] - 1])) < 1e-6
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-6 and r["identity_error"] < 1e-6


UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text, seed=42, rate=50, spm_rate=80):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, len(units), "plain", None, None, text, text)
    form = "spm" if h4 % 100 < spm_rate else "psm"
    out = f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"
    return (doc_id, len(units), form, len(pre), len(mid), out, text)


def fim_documents():
    rng = random.Random(8)
    rows = brute.documents() + [(200 + k, t, "en", "s") for k, t in enumerate(
        ["a <P> b", "<S>", "x<M>y z", "<P", "< P> <", " lead", "trail \n", "\t", "a", "é ñ 日本", "<<P <S <", "wörter " * 30_000, "z" * 70_000])]
    return rows + [(300 + k, "".join(rng.choice("a <PSM>\né日") for _ in range(rng.randint(0, 40))), "en", "s") for k in range(300)]


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("piece", [3, 1 << 14])
def test_fill_middle_equals_the_plain_version(spark, piece, monkeypatch):
    monkeypatch.setattr(fill_middle, "PIECE", piece)
    rows = [r for r in fim_documents() if piece > 9 or len(r[1] or "") < 5000]
    docs = brute.frame(spark, rows).repartition(7)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted(((*p[:5], sha(p[5]), sha(p[6])) for p in (plain_fim(r[0], r[1]) for r in rows)), key=key)
    assert sorted((tuple(r) for r in fill_middle.fill_middle(docs).collect()), key=key) == want
    texts = sorted(((p[0], p[2], p[5]) for p in (plain_fim(r[0], r[1]) for r in rows)), key=key)
    assert sorted((tuple(r) for r in fill_middle.outputs(docs).collect()), key=key) == texts


def test_fill_middle_restores_and_takes_parameters(spark):
    rows = fim_documents()[:80]
    docs = brute.frame(spark, rows)
    found = fill_middle.restored(fill_middle.assembled(fill_middle.pieces(docs, seed=7, rate=100, spm_rate=0)), texts=True).collect()
    assert sorted(bytes(r["text"]).decode() for r in found) == sorted(r[1] or "" for r in rows)
    assert {r["form"] for r in found} == {"psm", "plain"}
    assert fill_middle.fill_middle(brute.frame(spark, [])).collect() == []


def test_marker_over_pieces():
    places = fill_middle.Places("psm")
    got = [x for piece in (b"<", b"P>ab<", b"S", b">c", b"d<x<", b"M", b">", b"ef") for x in places(piece)] + [*places(b"", last=True)]
    assert {s: b"".join(b for t, b in got if t == s) for s in (0, 1, 2)} == {0: b"ab", 2: b"cd<x", 1: b"ef"}


def test_fill_middle_equals_its_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    got = QUERIES["op12_fill_in_middle"](spark, sf_small)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLE_SQL['op12_fill_in_middle']})").fetchall()
    assert sorted((tuple(r) for r in got.select(names).collect()), key=key) == sorted(want, key=key)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(1)
    some = ["", "a" * 1000, "a" * 1001, " " * 5000, "ab" * 700, "abc" * 500, "é" * 900, "日本語" * 400, "\n" * 3000 + "x", "=-" * 2000,
            "don't I'll WE'VE", "<|endoftext|>", "a\x00b\x1c\x1d c​d　e", "x" * 300_000]
    some += ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (255, 256, 257, 3000)]
    some += ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(1, 400))) for _ in range(150)]
    return some + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x3000), rng.randrange(0xE000, 0x1FFFF)]))
                           for _ in range(200)) for _ in range(100)]


def test_bpe_equals_the_library(library):
    work = byte_bpe.Encoder(byte_bpe.Vocabulary.load(BPE, public_tokenizers.PATTERN))
    back = byte_bpe.Decoder(work.vocabulary)
    for memory in (1 << 18, 10):
        work.MEMORY = memory
        for _ in range(2):
            for text, ids in zip(odd_texts(), work(odd_texts())):
                assert ids.tolist() == library.encode_ordinary(text)
                assert back(ids) == text.encode()


def test_matrix_merges_equal_one_by_one():
    rng = random.Random(2)
    ranks = {bytes([b]): b for b in range(256)}
    for k in range(60):  # a made-up vocabulary, where merged tokens may rank before their parts
        ranks.setdefault(bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 5))), 300 + (k * 37) % 60)
    vocabulary = byte_bpe.Vocabulary.of(ranks, r"\S+")

    def plain(piece):
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    pieces = [bytes(rng.choice(b"abbac") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    assert [x.tolist() for x in byte_bpe.merge_pieces(pieces, vocabulary)] == [plain(p) for p in pieces]
    for p in pieces:
        assert byte_bpe.merge_wide(vocabulary.single[np.frombuffer(p, dtype=np.uint8)], vocabulary.pairs).tolist() == plain(p)


def test_bpe_query_and_odd_rows(spark, sf_small, library):
    def want(rows):
        out = []
        for k, text in rows:
            ids = library.encode_ordinary(text or "")
            out.append((k, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                        hashlib.sha256((text or "").encode()).hexdigest()))
        return sorted(out, key=key)

    got = QUERIES["op13_byte_bpe"](spark, sf_small)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    given = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in got.collect()), key=key) == want(given)
    rows = brute.documents()
    found = byte_bpe.round_trip(brute.frame(spark, rows).repartition(3), BPE, public_tokenizers.PATTERN).collect()
    assert sorted((tuple(r) for r in found), key=key) == want([r[:2] for r in rows])
    assert byte_bpe.round_trip(brute.frame(spark, []), BPE, public_tokenizers.PATTERN).collect() == []
    bad = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF62') AS string) AS text")
    assert byte_bpe.round_trip(bad, BPE, public_tokenizers.PATTERN).collect()[0]["n_tokens"] == len(library.encode_ordinary("a�b"))
    lone = spark.createDataFrame([(1, None), (2, bytearray(struct.pack("<3I", 0, 2**32 - 1, 1)))], "id int, ids binary")
    assert [len(r["bytes"]) for r in byte_bpe.decode(lone, BPE, public_tokenizers.PATTERN).orderBy("id").collect()] == [0, 2]
