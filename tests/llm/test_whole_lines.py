"""Equal lines go in the query and the pipeline's stage, however short they are."""

import corpus_pipeline
from kestrel.llm import queries

from . import brute


def test_short_equal_lines_go(spark, tmp_path):
    rows = [r for r in brute.unique_ids(brute.documents()) if r[0] < 107]
    rows += [(300, "Share\nThe first of these lines is long enough\nRead more", "en", "s1"), (301, "read  More\n\nA line of its own", "en", "s1"),
             (302, "share", "en", "s1"), (303, "Share this", "en", "s1")]
    brute.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute.dropped_lines(rows, min_words=1, near_words=5)
    assert {(301, 0), (302, 0)} <= want and (303, 0) not in want
    got = queries.op7_deletion_line_dedup(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], int(x)) for r in got for x in r["lines"].split(",")} == want
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, brute.frame(spark, rows), str(tmp_path)).collect()}
    assert kept[301] == "\nA line of its own" and 302 not in kept and kept[303] == "Share this"


def test_near_lines_of_five_words_go(spark, tmp_path):
    rows = [(1, "one two three four five\na b c d e f g h i\np q r s", "en", "s1"), (2, "one two THREE new five\na b c d e f g h i j\np q r t", "en", "s1"),
            (3, "one two three four\na b x d e f g h\ntwo three four five", "en", "s1"), (4, "b c d e f g h i\none two three four five six", "en", "s1")]
    brute.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], int(x)) for r in queries.op7_deletion_line_dedup(spark, str(tmp_path)).collect() for x in r["lines"].split(",")}
    assert got == brute.dropped_lines(rows, min_words=1, near_words=5) == {(2, 0), (2, 1), (4, 0), (4, 1)}
