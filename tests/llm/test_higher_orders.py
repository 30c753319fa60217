"""Models of order 2 to 4 against a plain version, counts beyond 32 bits, few mapped arrays at a time."""

import math
import zlib
from collections import Counter, OrderedDict, defaultdict

import numpy as np
import pytest

from kestrel.llm import language_model as L

from . import brute


def plain_model(texts, order):
    """P(word | words before) by the definition: counts of occurrences at the top and from a text's start, else of distinct words before."""
    adjusted, distinct, uni = {k: Counter() for k in range(1, order + 1)}, {k: defaultdict(set) for k in range(1, order)}, Counter()
    for words in texts:
        line = ["<s>", *words, "</s>"]
        for i in range(1, len(line)):
            uni[line[i]] += 1
            gram = tuple(line[max(0, i - order + 1):i + 1])
            adjusted[len(gram)][gram] += 1
            for k in range(1, min(len(gram), order)):
                distinct[k][gram[-k:]].add(gram[-k - 1])
    for k in range(1, order):
        for gram, left in distinct[k].items():
            assert gram not in adjusted[k] or k > 1
            adjusted[k][gram] += len(left)

    def cuts(counts):
        n = Counter(counts)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        return [0] + [min(k, max(0, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0 for k in (1, 2, 3)]
    d = {k: cuts(x.values()) for k, x in adjusted.items()}
    total, kinds = defaultdict(int), defaultdict(lambda: [0] * 4)
    for k, x in adjusted.items():
        for gram, c in x.items():
            total[gram[:-1]] += c
            kinds[gram[:-1]][min(c, 3)] += 1

    def p(context, w):
        gram = (*context, w)
        lower = p(context[1:], w) if context else 1 / (len(uni) + 1)
        if not total[context]:
            return lower
        cut, c = d[len(gram)], adjusted[len(gram)][gram]
        return (c - cut[min(c, 3)]) / total[context] + sum(a * b for a, b in zip(cut, kinds[context])) / total[context] * lower
    return p, uni


@pytest.mark.parametrize("order, tokens", [(2, 3000), (3, 1 << 21), (3, 4000), (4, 9000)])
def test_every_order_equals_the_plain_version(spark, monkeypatch, order, tokens):
    monkeypatch.setattr(L, "PAIR_TOKENS", tokens)
    monkeypatch.setattr(L, "WORD_TOKENS", 2 * tokens)
    monkeypatch.setattr(L, "OPEN", 3)
    rows = [r for r in brute.documents() if r[0] != 107]
    held = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2
    p, uni = plain_model([brute.words(r[1]) for r in rows if not held(r)], order)
    some = brute.words(rows[1][1])[:order - 1]
    assert abs(sum(p(tuple(some), w) for w in uni) + p(tuple(some), "unknown") - 1) < 1e-9
    want = []
    for r in rows:
        line = ["<s>", *brute.words(r[1]), "</s>"]
        logs = sum(math.log10(p(tuple(line[max(0, i - order + 1):i]), line[i])) for i in range(1, len(line)))
        want.append((r[0] if r[0] is not None else -1, len(line) - 1, sum(uni[w] > 0 for w in line[1:]), logs))
    got = [(r["id"] if r["id"] is not None else -1, r["n_tokens"], r["n_known"], r["score"])
           for r in L.score_documents(brute.frame(spark, rows).repartition(4), order=order).collect()]
    key = lambda x: (x[0], x[1], round(x[3], 3))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9)


def test_longer_contexts_score_better(spark):
    rows = [(k, "the cat sat on the mat . the dog sat on the log . a cat saw a dog".split()) for k in range(40)]
    docs = brute.frame(spark, [(k, " ".join(w), "en", "s") for k, w in rows])
    two, three = (sum(r["score"] for r in L.score_documents(docs, order=n).collect() if r["held_out"]) for n in (2, 3))
    assert three > two
    with pytest.raises(ValueError):
        L.fit(docs, 1)


def test_counts_beyond_32_bits(tmp_path):
    """Patched arrays: a word and a pair that occur more than 2^32 times come back whole."""
    h = L.W.hash_words(b"often seldom")[2]
    many = 7 * 2**33 + 5
    model = L.Model(str(tmp_path), 2, 1, 1, np.empty(0, np.uint64), tokens=many + 3, vocabulary=2, pairs=3,
                    discount={1: np.zeros(4), 2: np.zeros(4)})
    words = np.sort(np.array([h[0], h[1], L.END], dtype=np.uint64))
    count = np.where(words == h[0], many, 1).astype(np.uint64)
    L.save(f"{tmp_path}/words-0", {"key": words, "count": count, "before": count, "follow": count, **{f"n{k}": np.ones(3, np.uint64) for k in (1, 2, 3)}})
    key = L.pair_key(h[:1], h[:1])
    L.save(f"{tmp_path}/grams2-0", {"key": key, "count": np.array([many - 1], dtype=np.uint64)})
    reader = L.Reader(model)
    logs, seen = reader.log10([L.line_of(np.array([h[0], h[0]]))])
    assert seen.tolist() == [many, many, 1] and math.isclose(logs[1], math.log10((many - 1) / many), abs_tol=1e-12)
    assert isinstance(reader.open, OrderedDict)
