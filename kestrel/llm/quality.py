"""Quality rules with adaptive thresholds, in DataFrame operations only.

Each measure of a document is a bin of a histogram of at most 1,001 bins. The histogram of a language
and source is a quantile sketch that merges by adding counts: partitions merge into groups, groups
into languages, languages into the whole. A group's thresholds are fences around its median; a group
with too few rows takes those of its language, or of all documents. The documents are then joined
with the thresholds of their group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

BLANK, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
BINS = 1000


@dataclass(frozen=True)
class Rule:
    """A fence ``reach`` spreads above (and, two-sided, below) the median; a spread is the distance of
    the quartile on the other side from the median, ``floor`` bins at least."""

    measure: str
    floor: int
    two_sided: bool = False


#: Bins of the first three are thousandths of a ratio, those of the last twentieths of a character.
RULES = (Rule("symbols", 20), Rule("dup_lines", 200), Rule("repeats", 150), Rule("word_length", 10, True))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more."""
    def covered(windows: Column) -> Column:
        def around(q: Column) -> Column:
            same = lambda x, i: F.coalesce(F.get(q, i)["h"] == x["h"], F.lit(False))
            again = F.filter(q, lambda x, i: same(x, i - 1) | same(x, i + 1))
            return _let(F.sort_array(F.transform(again, lambda x: x["i"])), lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1), x + 3) - x)),
                F.lit(0).cast("long"), lambda a, x: a + x))

        rows = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            _let(F.sort_array(rows), around))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_let(windows, covered))


def measures(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.regexp_replace("text", BLANK, "")
    with_word = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    return (docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), text.alias("text"))
            .select("id", "lang", "source",
                    F.struct(F.array_remove(F.split("text", BLANK), "").alias("words"), with_word.alias("lines"),
                             F.length(bare).cast("long").alias("word_chars"),
                             (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols")).alias("t"))
            .select("id", "lang", "source", F.size("t.words").cast("long").alias("n_words"), "t.word_chars", "t.n_symbols",
                    (F.size("t.lines") - F.size(F.array_distinct("t.lines"))).cast("long").alias("n_dup_lines"),
                    repeat_words(F.col("t.words")).alias("n_repeat_words"), F.size("t.lines").cast("long").alias("n_lines")))


def bins() -> dict[str, Column]:
    ratio = lambda a, b: F.expr(f"least({BINS}, {a} div greatest({b}, 1))")
    return {"symbols": ratio("1000 * n_symbols", "word_chars"), "dup_lines": ratio("1000 * n_dup_lines", "n_lines"),
            "repeats": ratio("1000 * n_repeat_words", "n_words"), "word_length": ratio("20 * word_chars", "n_words")}


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): the histograms of each language and source."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("bin")) for k, v in bins().items()]))
    return (measured.select("lang", "source", pairs.alias("m"))
            .groupBy("lang", "source", "m.measure", "m.bin").agg(F.count("*").alias("n")))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of the groups by ``keys``, from sketches of finer groups."""
    return parts.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def quartiles(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, rows, q1, q2, q3) of each sketch: the least bins that hold a quarter, half, three quarters."""
    group = Window.partitionBy(*keys, "measure")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    got = parts.withColumn("upto", F.sum("n").over(upto)).withColumn("rows", F.sum("n").over(group))
    return got.groupBy(*keys, "measure").agg(F.max("rows").alias("rows"), *[
        F.min(F.when(F.col("upto") * 4 >= F.col("rows") * q, F.col("bin"))).alias(f"q{q}") for q in (1, 2, 3)])


def thresholds(parts: DataFrame, min_rows: int, reach: int) -> DataFrame:
    """(lang, source, <measure>_lo, <measure>_hi): one row for each language and source of the sketches."""
    rules = {r.measure: r for r in RULES}
    floor = F.element_at(F.create_map(*[F.lit(x) for r in RULES for x in (r.measure, r.floor)]), F.col("measure"))
    two = F.col("measure").isin([r.measure for r in RULES if r.two_sided])
    hi = F.col("q2") + reach * F.greatest(F.col("q2") - F.col("q1"), floor)
    lo = F.when(two, F.col("q2") - reach * F.greatest(F.col("q3") - F.col("q2"), floor)).otherwise(F.lit(0))

    def fences(keys: list[str], name: str) -> DataFrame:
        return quartiles(merged(parts, keys), keys).select(
            *[F.col(k).alias(f"{name}_{k}") for k in keys], F.col("measure").alias(f"{name}_measure"),
            F.when(F.lit(name == "all") | (F.col("rows") >= min_rows), F.struct(lo.alias("lo"), hi.alias("hi"))).alias(name))

    own, lang, every = fences(["lang", "source"], "own"), fences(["lang"], "lang"), fences([], "all")
    got = (own.join(lang, F.col("own_lang").eqNullSafe(F.col("lang_lang")) & (F.col("own_measure") == F.col("lang_measure")))
           .join(every, F.col("own_measure") == F.col("all_measure"))
           .select("own_lang", "own_source", "own_measure", F.coalesce("own", "lang", "all").alias("f")))
    return got.groupBy("own_lang", "own_source").agg(*[
        F.max(F.when(F.col("own_measure") == m, F.col(f"f.{x}"))).alias(f"{m}_{x}") for m in rules for x in ("lo", "hi")])


def quality_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source", min_rows: int = 100, reach: int = 3) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for each row of ``docs``.

    A document fails the base with fewer than 50 words or with more than half of its words in
    repeated 3-word windows. The sketches are of the documents that pass it; of these, one is kept if
    each measure lies within the fences of its language and source.

    A null or empty text has no words and fails the base. A null language or source is a group like
    any other. Repeated rows each count and come back each. An empty table gives an empty table.
    """
    measured = written(measures(docs, id_col, text_col, lang_col, source_col), "measures")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fences = thresholds(sketches(measured.where(~failed)), min_rows, reach)
    placed = measured.select("*", failed.alias("base_failed"), *[v.alias(f"bin_{k}") for k, v in bins().items()])
    # a language and source of which every document fails the base has no fences, and none is needed
    joined = placed.join(fences, F.col("lang").eqNullSafe(F.col("own_lang")) & F.col("source").eqNullSafe(F.col("own_source")), "left")
    inside = [F.col(f"bin_{r.measure}").between(F.col(f"{r.measure}_lo"), F.col(f"{r.measure}_hi")) for r in RULES]
    ok = inside[0]
    for x in inside[1:]:
        ok = ok & x
    return joined.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(ok, F.lit(False))).alias("kept"))


#: The same by plain SQL: windows are grouped as words, quartiles come from sorted bins.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
u AS (
  SELECT row, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g, i
  FROM (SELECT row, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (
  SELECT row, count(DISTINCT p) AS n FROM (
    SELECT row, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY row, g) AS c FROM u) WHERE c > 1)
  GROUP BY row),
l AS (
  SELECT row, count(*) AS n, count(DISTINCT x) AS k
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY row),
m AS (
  SELECT d.row, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n - l.k, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(l.n, 0) AS n_lines
  FROM d JOIN w USING (row) LEFT JOIN r USING (row) LEFT JOIN l USING (row)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         least(1000, 1000 * n_symbols // greatest(word_chars, 1)) AS b1, least(1000, 1000 * n_dup_lines // greatest(n_lines, 1)) AS b2,
         least(1000, 1000 * n_repeat_words // greatest(n_words, 1)) AS b3, least(1000, 20 * word_chars // greatest(n_words, 1)) AS b4
  FROM m),
v AS (
  SELECT lang, source, unnest([1, 2, 3, 4]) AS k, unnest([b1, b2, b3, b4]) AS b, unnest([20, 200, 150, 10]) AS fl
  FROM f WHERE NOT base_failed),
o AS (
  SELECT lang, source, k, fl, count(*) AS n, list_sort(list(b)) AS s,
         GROUPING(source) AS gs, GROUPING(lang) AS gl
  FROM v GROUP BY GROUPING SETS ((lang, source, k, fl), (lang, k, fl), (k, fl))),
q AS (SELECT *, s[(n + 3) // 4] AS q1, s[(2 * n + 3) // 4] AS q2, s[(3 * n + 3) // 4] AS q3 FROM o),
e AS (SELECT *, q2 + 3 * greatest(q2 - q1, fl) AS hi, CASE WHEN k = 4 THEN q2 - 3 * greatest(q3 - q2, fl) ELSE 0 END AS lo FROM q),
t AS (
  SELECT a.lang, a.source, a.k, CASE WHEN a.n >= 100 THEN a.lo WHEN b.n >= 100 THEN b.lo ELSE c.lo END AS lo,
         CASE WHEN a.n >= 100 THEN a.hi WHEN b.n >= 100 THEN b.hi ELSE c.hi END AS hi
  FROM e a JOIN e b ON a.gs = 0 AND a.gl = 0 AND b.gs = 1 AND b.gl = 0 AND a.lang IS NOT DISTINCT FROM b.lang AND a.k = b.k
  JOIN e c ON c.gl = 1 AND c.gs = 1 AND a.k = c.k),
j AS (
  SELECT f.row, bool_and(CASE t.k WHEN 1 THEN b1 WHEN 2 THEN b2 WHEN 3 THEN b3 ELSE b4 END BETWEEN t.lo AND t.hi) AS ok
  FROM f JOIN t ON f.lang IS NOT DISTINCT FROM t.lang AND f.source IS NOT DISTINCT FROM t.source GROUP BY f.row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(ok, false) AS kept
FROM f LEFT JOIN j USING (row)
"""
