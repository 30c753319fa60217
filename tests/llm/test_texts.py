"""Words, personal data, pages and the language model."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from kestrel.llm import language_model, pii
from kestrel.llm import words as W
from kestrel.llm.pages import extract, main_text

from . import brute


def test_words_and_their_hashes():
    texts = [x[1].encode() for x in brute.documents() if x[1] is not None] + [b"A b a B", b"x " * 200_000, "É é".encode()]
    seen = {}
    for at, starts, ends, h in W.each_text(texts):
        spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", texts[at])]
        assert spans == list(zip(starts.tolist(), ends.tolist()))
        for (a, b), x in zip(spans, h.tolist()):
            assert seen.setdefault(x, re.sub(rb"[A-Z]", lambda m: m[0].lower(), texts[at][a:b])) == re.sub(
                rb"[A-Z]", lambda m: m[0].lower(), texts[at][a:b])
    assert len(set(seen.values())) == len(seen)


def test_run_hashes():
    h = W.hash_words(b"a b c a b c d")[2]
    runs = W.Runs(h)
    x = runs.hash(np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert x[0] == x[1] != x[2]
    rest = W.Runs(np.delete(h, 2))
    assert runs.without_each(7)[2] == rest.hash(np.array([0]), np.array([6]), 7)[0]


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def ok(kind, x):
        d = re.sub("[^0-9]", "", x)
        if kind == "ip":
            return all(int(p) <= 255 for p in x.split("."))
        if kind == "card":
            return 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
        return kind == "email" or 8 <= len(d) <= 15
    return {k: [m.span() for m in re.finditer(p, text) if ok(k, m[0])] for k, p in BASE.items()}


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    for k in range(8000):
        text = "".join(rng.choice("ab1 .@-+(%4é" if k % 2 else "0123456789.. -+@a") for _ in range(rng.randint(0, 45)))
        assert pii.base_spans(text) == plain_spans(text)
    for text in ("a" * 10**6, "1" * 10**6, "1." * 200_000, "+1" + " " * 10**6, "@" * 10**5):
        pii.base_spans(text)


def test_contexts_find_what_the_base_has_not(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [(k, f"{word()} please write to u{k}@mail{k}.org for {word()} help", "en", "s") for k in range(12)]
    rows += [(50, "you may please write to root@localhost for more", "en", "s"), (51, "see root2@localhost there", "en", "s"),
             (52, None, None, None), (53, "", None, None), (None, "a@b.cd", None, None)]
    got = {r["id"]: r for r in pii.find_pii(brute.frame(spark, rows + rows[:1])).collect()}
    text = rows[12][1]
    at = text.index("root@")
    assert got[50]["base"] == "" and got[50]["added"] == f"context_email:{at}:{at + len('root@localhost')}"
    assert got[51]["added"] == "" and got[52]["base"] == got[53]["base"] == "" and got[None]["base"] == "email:0:6"
    assert got[3]["n_email"] == 1 and got[3]["added"] == ""
    assert pii.find_pii(brute.frame(spark, [])).count() == 0


def test_main_text():
    page = ("<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href='/x'>Menu</a>"
            "<li><a>Two</a></ul></nav><div class='ad'>Buy this, now.</div><header>Site</header><article><h1>A &amp; B</h1><p><b>First  part,\n of it.<br>"
            "Still.<p>Second part.</p><div class=\"share\"><a>Share</a></div></article><div id=comments><p>I like it, really.</p></div>"
            "<form><p>Mail, please.</p></form><aside>Side.</aside><footer>&copy; x</footer>")
    assert main_text(page) == "A & B\nFirst part, of it. Still.\nSecond part."
    plain = "<body><div id=menu><a>x</a></div><div><p>Some text, long enough.</p><p>More text here.</p></div>"
    assert main_text(plain) == "Some text, long enough.\nMore text here."
    assert main_text("") == "" and main_text("<nav>only menu</nav>") == "" and main_text("a < b") == "a < b"
    assert main_text("<div>" * 5000 + "deep, text.") == "deep, text."
    assert main_text("<p>x, " + "y " * 200_000).startswith("x, y y")
    for broken in ("<a '" * 5000, "<!--" * 5000, "<script>", "<p><table><tr><td>a, b.<tr><td>c."):
        main_text(broken)


def test_every_page_comes_back(spark):
    rows = [(1, "u", "<p>Hi, you.</p>", 1), (1, "u", "<p>Hi, you.</p>", 1), (2, None, None, 2), (None, "u", "", 3)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted((r["id"] or 0, r["url"] or "", r["text"]) for r in got) == [(0, "u", ""), (1, "u", "Hi, you."), (1, "u", "Hi, you."), (2, "", "")]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def kneser_ney(texts):
    pairs, uni = Counter(), Counter()
    for w in texts:
        line = [0, *w, 1]
        pairs.update(zip(line, line[1:]))
        uni.update(line[1:])

    def cuts(counts):
        n = Counter(counts)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        return [0] + [min(k, max(0, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0 for k in (1, 2, 3)]
    before, follow, kinds = Counter(w for _, w in pairs), Counter(), defaultdict(lambda: [0] * 4)
    for (v, _), c in pairs.items():
        follow[v] += c
        kinds[v][min(c, 3)] += 1
    d, e = cuts(pairs.values()), cuts(before.values())
    free = sum(e[min(c, 3)] for c in before.values()) / len(pairs)

    def p(v, w):
        lower = max(before[w] - e[min(before[w], 3)], 0) / len(pairs) + free / (len(uni) + 1)
        if not follow[v]:
            return lower
        c = pairs[v, w]
        return (c - d[min(c, 3)]) / follow[v] + sum(a * b for a, b in zip(d, kinds[v])) / follow[v] * lower
    return p, uni


def test_language_model_equals_plain_one(spark, monkeypatch):
    monkeypatch.setattr(language_model, "PAIR_TOKENS", 3000)  # several shards, and words too frequent for one
    monkeypatch.setattr(language_model, "WORD_TOKENS", 9000)
    rows = brute.documents()
    held = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2
    p, uni = kneser_ney([brute.words(r[1]) for r in rows if not held(r)])
    total, size = sum(uni.values()), len(uni)
    assert abs(sum(p("abae", w) for w in uni) + p("abae", "unknown") - 1) < 1e-9
    want = []
    for r in rows:
        line = [0, *brute.words(r[1]), 1]
        want.append((r[0] if r[0] is not None else -1, held(r), len(line) - 1, sum(uni[w] > 0 for w in line[1:]), total,
                     sum(math.log10((uni[w] + 1) / (total + size + 1)) for w in line[1:]),
                     sum(math.log10(p(a, b)) for a, b in zip(line, line[1:]))))
    got = [(r["id"] if r["id"] is not None else -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
           for r in language_model.score_documents(brute.frame(spark, rows)).collect()]
    key = lambda x: (x[0], x[2], round(x[6], 3))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def test_language_model_without_rows(spark):
    assert language_model.score_documents(brute.frame(spark, [])).count() == 0
    only = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 7 == 2)
    got = language_model.score_documents(brute.frame(spark, [(only, "a b", "en", "s")])).first()
    assert got["train_tokens"] == 0 and got["n_known"] == 0 and got["n_tokens"] == 3 and got["score"] == 0.0
