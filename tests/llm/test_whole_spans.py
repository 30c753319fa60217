"""Every repeated run of sentences goes, whichever of them are short."""

from collections import defaultdict

import pytest

from kestrel.llm import queries
from kestrel.llm.sentences import covered, repeated_spans

from . import brute


def all_runs(rows, least=2, min_words=16):
    """Sentences covered by later occurrences of any run of several sentences."""
    seen, gone = set(), defaultdict(set)
    for r in sorted(rows):
        s = brute.sentences(r[1])
        for i in range(len(s)):
            for j in range(i + least, len(s) + 1):
                run = tuple(w for x in s[i:j] for w in x)
                if len(run) >= min_words:
                    if run in seen:
                        gone[r[0]].update(range(i, j))
                    seen.add(run)
    return dict(gone)


def awkward():
    rows = [r for r in brute.unique_ids(brute.documents()) if r[0] < 107]
    s = [" ".join(f"{c}{k}" for k in range(n)) + "." for c, n in (("a", 10), ("b", 10), ("c", 10), ("d", 3))]
    return rows + [(300, " ".join(s) + " One end.", "en", "s1"), (301, " ".join(s) + " Another end of it.", "en", "s1"),
                   (302, "Short one. Short two. Third here.", "en", "s1"), (303, "Before. Short one. Short two.", "en", "s1"),
                   (304, "Again. Again. Again. Again.", "en", "s1")]


@pytest.mark.parametrize("least, min_words", [(2, 16), (2, 1), (3, 25)])
def test_spans_equal_all_runs(spark, least, min_words):
    rows = awkward()
    want = all_runs(rows, least, min_words)
    got = covered(repeated_spans(brute.frame(spark, rows), sentences=least, min_words=min_words))
    assert {r["id"]: set(r["gone"]) for r in got.collect()} == want
    assert want[301] == {0, 1, 2, 3}


def test_query_takes_short_runs(spark, tmp_path):
    rows = awkward()
    brute.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: {int(x) for x in r["sentences"].split(",")} for r in queries.op4_sentence_span_dedup(spark, str(tmp_path)).collect()}
    assert got == all_runs(rows, 2, 1) and got[303] == {1, 2} and got[304] == {1, 2, 3}
