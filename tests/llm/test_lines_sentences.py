from collections import Counter

from kestrel.llm.lines import dedup_lines, dropped_lines
from kestrel.llm import words as W
from kestrel.llm.sentences import covered, dedup_spans, repeated_spans, sentence_starts

from . import brute


def test_dropped_lines_equal_plain_comparison(spark):
    rows = brute.unique_ids(brute.documents())
    extra = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    w = extra.split()
    rows += [(200, extra, "en", "s1"), (201, extra.upper(), "en", "s1"), (202, " ".join(w[:5] + ["new"] + w[5:]), "en", "s1"),
             (203, " ".join(w[:-1]), "en", "s1"), (204, " ".join(w[:3] + ["x"] + w[4:]), "en", "s1"),
             (205, " ".join(w[:3] + ["x", "y"] + w[5:]), "en", "s1"), (206, " ".join(w[1:] + w[:1]), "en", "s1"),
             (207, "a b c d e\na b c d e\na b c d f\na b c", "en", "s1")]
    got = {(r["id"], r["line"]) for r in dropped_lines(brute.frame(spark, rows)).collect()}
    want = brute.dropped_lines(rows)
    assert got == want
    assert {(201, 0), (202, 0), (203, 0), (204, 0), (205, 0), (207, 1)} <= want and (206, 0) not in want and (207, 2) not in want


def test_line_dedup_rewrites_texts_only(spark):
    rows = brute.documents()
    frame = brute.frame(spark, rows)
    out = dedup_lines(frame)
    assert out.dtypes == frame.dtypes
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    unique = brute.unique_ids(rows)
    alone = brute.unique_ids([r for r in rows if r[0] not in (None, 7)])
    gone = {(r["id"], r["line"]) for r in dropped_lines(frame).collect()}
    for r in alone:
        times = sum(x[:2] == r[:2] for x in rows)
        keep = [x for i, x in enumerate((r[1] or "").split("\n")) if (r[0], i) not in gone]
        text = "\n".join(keep) if r[1] is not None else None
        stays = not any(a == r[0] for a, _ in gone) or (text or "").strip()
        assert got[(r[0], text)] == (times if stays else 0)
    assert got[(None, None)] == 1 and got[(100, None)] == 1 and got[(101, "")] == 1
    assert len(unique) > 60


QUOTED = "He said: (it ends here.) And “there.” «Or here!» but not.this one \x27so.\x27 Yes."


def test_marks_after_a_sentence():
    raw = QUOTED.encode()
    starts, ends, _ = W.hash_words(raw)
    first = sentence_starts(raw, starts, ends)
    cut = [*starts[first].tolist(), len(raw)]
    assert [raw[a:b].decode().strip() for a, b in zip(cut, cut[1:])] == ["He said: (it ends here.)", "And “there.”", "«Or here!»", "but not.this one \x27so.\x27", "Yes."]


def test_spans_equal_plain_comparison(spark):
    rows = brute.unique_ids(brute.documents())
    frame = brute.frame(spark, rows)
    want = brute.covered(rows)
    assert {r["id"]: set(r["gone"]) for r in covered(repeated_spans(frame)).collect()} == want and want
    out = dedup_spans(frame)
    assert out.dtypes == frame.dtypes
    for r in out.collect():
        before = next(x for x in rows if x[0] == r["doc_id"])[1]
        if r["doc_id"] not in want:
            assert r["text"] == before
        else:
            left = [w for i, s in enumerate(brute.sentences(before)) if i not in want[r["doc_id"]] for w in s]
            assert brute.words(r["text"]) == left


def test_repeated_and_null_rows(spark):
    frame = brute.frame(spark)
    assert dedup_spans(frame).count() == frame.count()
    text = "one two three four five six seven eight nine. ten eleven twelve thirteen fourteen fifteen sixteen seventeen."
    again = covered(repeated_spans(brute.frame(spark, [(None, text, None, None), (3, text + " More.", None, None), (2, text, None, None)]))).collect()
    assert {(r["id"], tuple(r["kept_ids"])) for r in again} == {(2, ()), (3, ())}  # a null id comes first


def test_empty(spark):
    frame = brute.frame(spark, [])
    assert dropped_lines(frame).count() == dedup_lines(frame).count() == dedup_spans(frame).count() == repeated_spans(frame).count() == 0
