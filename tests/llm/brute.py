"""Plain Python versions of the operators, and awkward documents to hold both against."""

import random
import re
from collections import defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")


def low(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def words(text):
    return [low(w) for w in WORD.findall(text or "")]


class Parts:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def sentence(rng, n):
    return " ".join(rng.choice(["ab", "cd", "Ef", "gh", "ij", "kl", "mn", "op", "qr", "st", "uv", "wx", "yz"]) + rng.choice("aeiou") for _ in range(n)) + "."


def documents(seed=5):
    """(doc_id, text, lang, source): copies, edited copies, shared lines and passages, odd texts, repeated rows."""
    rng = random.Random(seed)
    rows, passage = [], sentence(rng, 30) + " " + sentence(rng, 34) + " " + sentence(rng, 9)
    base = [" ".join(sentence(rng, rng.randint(4, 20)) for _ in range(6)) for _ in range(8)]
    for k in range(60):
        text = "\n".join(sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 6)))
        if k % 5 == 0:
            w = base[k % 8].split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(["new", "Other", "third"])
            text = " ".join(w)
        if k % 7 == 0:
            text = text + "\n" + passage + "\n" + sentence(rng, 6)
        rows.append((k, text, rng.choice(["en", "de"]), rng.choice(["s1", "s2", "s3"])))
    rows += [(100, None, None, None), (101, "", "en", "s1"), (102, " \n\t ", "en", None), (103, "One", "en", "s2"), (104, "one", None, "s2"),
             (105, "two words", "en", "s1"), (106, "Zwei Wörter é ñ", "de", "s9"), (107, "x" * 300_000, "en", "s2"),
             (108, "\n".join(sentence(rng, 12) for _ in range(3000)), "en", "s2"), (None, base[1], "en", "s1"), (None, None, None, None)]
    rows += [rows[0], rows[0], rows[15], (7, "another text of seven that is long enough to count as a line", "en", "s1")]
    return rows


def frame(spark, rows=None, **more):
    """The documents with extra columns whose names clash with what operators may use inside."""
    rows = documents() if rows is None else rows
    kind = "doc_id long, text string, lang string, source string, row string, key long, id long, th long, score double, __row int"
    return spark.createDataFrame([(*r, "r", 1, 2, 3, 0.5, 9) for r in rows], kind)


def shingles(text, n):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def jaccard(rows, n, num, den):
    """[(id, n_shingles, n_links, component)] of rows without null ids."""
    sets = [(r[0], shingles(r[1], n)) for r in rows]
    parts, links = Parts(), [0] * len(sets)
    for i, (a, x) in enumerate(sets):
        parts.find(a)
        for j in range(i):
            b, y = sets[j]
            both = len(x & y)
            if x and y and den * both >= num * (len(x) + len(y) - both):
                links[i] += 1
                links[j] += 1
                parts.join(a, b)
    return [(a, len(x), k, parts.find(a)) for (a, x), k in zip(sets, links)]


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def dropped_lines(rows, min_words=5, near_words=10):
    """{(id, line)} that go, for rows of distinct ids."""
    seen, gone = [], set()
    for r in sorted(rows):
        for at, line in enumerate((r[1] or "").split("\n")):
            w = tuple(words(line))
            if len(w) < min_words:
                continue
            if any(x == w or min(len(x), len(w)) >= near_words and one_edit(x, w) for x in seen):
                gone.add((r[0], at))
            seen.append(w)
    return gone


def sentences(text):
    out = []
    for line in (text or "").split("\n"):
        new = True
        for w in WORD.findall(line):
            if new:
                out.append([])
            out[-1].append(low(w))
            new = w[-1] in ".!?"
    return out


def covered(rows, least=2, min_words=16):
    seen, gone = set(), defaultdict(set)
    for r in sorted(rows):
        s = sentences(r[1])
        for i in range(len(s)):
            run, j = [], i
            while j < len(s) and (j - i < least or len(run) < min_words):
                run += s[j]
                j += 1
            if j - i >= least and len(run) >= min_words:
                if tuple(run) in seen:
                    gone[r[0]].update(range(i, j))
                seen.add(tuple(run))
    return dict(gone)


def unique_ids(rows):
    got, seen = [], set()
    for r in rows:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            got.append(r)
    return got
