"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

A slot i of the mix is the golden-ratio point frac(i / phi), kept as an exact integer on a lattice of
2^40 points. The unit interval is divided among the sources in proportion to their targets, so slot i
goes to the source whose interval holds its point: every stretch of the mix comes close to the
targets. The r-th slot of a source takes the r-th of the source's blocks, which are runs of equally
many words of its documents in shuffled order; after the last block the next pass begins.

By the three-gap theorem any interval of length 1/Q holds one of each 2.62 Q consecutive points, so a
schedule of 3 Q slots, Q the blocks wanted in all, gives every source its share; slots beyond a
source's target are left out, and the last one is cut to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

WORD = r"[^\x20\x09-\x0D]+"
#: The lattice of slot points, and an odd number near 2^40 / phi: i * STEP mod 2^40 is a golden-ratio sequence.
LATTICE, STEP = 1 << 40, 679535554133
#: Ranges of the shuffled order in which words are summed before the sums are added up.
PARTS = 4096
#: Slots whose ranks are counted together.
CHUNK = 4096


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (skey, source_size) with each source's target: its part of ``share`` times all sizes.

    Sources weigh ``weights`` in turn, by code point, null last. No target exceeds ``most`` times the
    source's size; what is cut off goes to the others by weight, until none is above. That is the
    level L at which sum(least(most * size, L * weight)) is the total: filling the sources in the
    order of most * size / weight, L is the largest of the levels met on the way.
    """
    order = Window.orderBy("skey")  # one row for each source
    fill = Window.orderBy((F.col("cap") / F.col("weight")), "skey")
    before, every = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return (sizes.withColumn("weight", F.element_at(turn, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
            .withColumn("cap", F.col("source_size").cast("double") * most)
            .withColumn("level", (F.sum("source_size").over(every).cast("double") * share
                                  - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
            .withColumn("target", F.least("cap", F.max("level").over(every) * F.col("weight")))
            .select("skey", "source_size", "target"))


def schedule(plan: DataFrame, block: int) -> DataFrame:
    """(skey, block, slot, stop): the slots of the mix; a slot takes its block's words before ``stop``.

    ``plan`` is the output of ``targets``.
    """
    total = Window.orderBy("skey")
    quota = (plan.withColumn("want", F.floor("target").cast("long"))
             .withColumn("quota", F.ceil(F.col("want") / block).cast("long"))
             .withColumn("to", F.sum("quota").over(total)))
    wanted = int(quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    scale = lambda c: F.floor(c.cast("double") / F.lit(float(max(1, wanted))) * F.lit(float(LATTICE))).cast("long")
    cell = LATTICE // 1024
    # an interval is dealt to the cells it touches, so that slots and intervals meet by an equal key
    share = (quota.where("quota > 0")
             .select("skey", "source_size", "want", scale(F.col("to") - F.col("quota")).alias("lo"), scale(F.col("to")).alias("hi"))
             .withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell)))))
    low, high = F.col("slot") % (1 << 20), F.floor(F.col("slot") / (1 << 20)).cast("long")
    slots = (plan.sparkSession.range(3 * wanted).withColumnRenamed("id", "slot")
             .withColumn("point", (low * F.lit(STEP) + (high * F.lit(STEP)) % (1 << 20) * F.lit(1 << 20)) % F.lit(LATTICE))
             .withColumn("cell", F.floor(F.col("point") / cell)))
    dealt = (slots.join(share, "cell").where("lo <= point and point < hi")
             .select("skey", "source_size", "want", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk")))
    # the rank of a slot in its source: those of earlier chunks, and those before it in its chunk
    counts = dealt.groupBy("skey", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("skey").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("skey", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("skey", "chunk").orderBy("slot")
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    return (dealt.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["skey", "chunk"])
            .withColumn("rank", F.col("rank") + F.col("start"))
            .withColumn("block", F.col("rank") % blocks)
            .withColumn("passed", F.floor(F.col("rank") / blocks).cast("long") * F.col("source_size"))
            .withColumn("stop", F.least((F.col("block") + 1) * block, "source_size", F.col("want") - F.col("passed")))
            .where(F.col("stop") > F.col("block") * block)
            .select("skey", "block", "slot", "stop"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                block: int = 1024, seed: int = 0) -> DataFrame:
    """(id, source, size, source_size, target, taken, first_slot): one row for each row of ``docs``.

    ``taken`` counts the words that the mix takes of the document, repeats included; ``first_slot`` is
    the first slot that takes any of them, null if none does. A source's taken words are its target
    rounded down. Documents of a source are shuffled by the MD5 of seed and id, so runs agree.

    A null or empty text has size 0 and is taken 0 times; a null source is a source of its own. Rows
    that repeat an id stand side by side in the order, each with its own words. A null id is
    shuffled like the id "". An empty table gives an empty table.
    """
    # a source holds any share of the rows: its order is cut into PARTS ranges that are summed apart
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    sized = written(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"),
        F.struct(F.col(source_col).isNull().alias("no"), F.coalesce(F.col(source_col), F.lit("")).alias("name")).alias("skey"),
        order.alias("at"), F.conv(F.substring(order, 1, 3), 16, 10).cast("int").alias("part")), "sized")
    parts = sized.groupBy("skey", "part").agg(F.sum("size").alias("n"))
    plan = written(targets(parts.groupBy("skey").agg(F.sum("n").alias("source_size"))), "targets")

    earlier = Window.partitionBy("skey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("skey", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("skey", "part").orderBy("at", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (sized.withColumn("upto", F.sum("size").over(inside)).join(starts, ["skey", "part"])
              .withColumn("stop", F.col("start") + F.col("upto")).withColumn("begin", F.col("stop") - F.col("size")))
    placed = written(placed.select("id", "source", "skey", "size", "begin", "stop"), "placed")

    pieces = (placed.where("size > 0").select(
        "skey", "begin", "stop",
        F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("stop") - 1) / block))).alias("block")))
    slots = schedule(plan, block).select("skey", "block", "slot", F.col("stop").alias("until"))
    first = F.greatest("begin", F.col("block") * block)
    taken = (pieces.join(slots, ["skey", "block"])
             .withColumn("words", F.least("stop", "until") - first).where("words > 0")
             .groupBy("skey", "begin").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot")))
    # a position in a source belongs to one document that has words
    spot = F.when(F.col("size") > 0, F.col("begin")).alias("spot")
    return (placed.select("*", spot).join(taken.withColumnRenamed("begin", "spot"), ["skey", "spot"], "left")
            .join(plan, "skey")
            .select("id", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_slot"))


#: The same result by plain windows over all rows; the schedule's slots are laid out in full.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, (source IS NULL) AS nil, coalesce(source, '') AS nm,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS pos
  FROM documents),
p AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY nil, nm ORDER BY pos, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM d),
s AS (SELECT nil, nm, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY nil, nm),
w AS (
  SELECT *, CAST(source_size AS DOUBLE) * 2.0 AS cap,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY nil, nm) - 1) % 3 + 1] AS DOUBLE) AS weight FROM s),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, nil, nm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, nil, nm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM w),
t AS (SELECT nil, nm, source_size, least(cap, max(level) OVER () * weight) AS target FROM l),
q AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS want, CAST(ceil(floor(target) / 1024) AS BIGINT) AS quota FROM t),
c AS (
  SELECT *, CAST(sum(quota) OVER (ORDER BY nil, nm) AS BIGINT) AS upto, CAST(sum(quota) OVER () AS BIGINT) AS total FROM q),
i AS (
  SELECT *, CAST(floor((upto - quota)::DOUBLE / total::DOUBLE * 1099511627776.0) AS BIGINT) AS lo,
         CAST(floor(upto::DOUBLE / total::DOUBLE * 1099511627776.0) AS BIGINT) AS hi FROM c WHERE quota > 0),
g AS (
  SELECT slot, CAST((slot::HUGEINT * 679535554133) % 1099511627776 AS BIGINT) AS point
  FROM range((SELECT coalesce(3 * max(total), 0) FROM c)) AS r(slot)),
k AS (
  SELECT i.nil, i.nm, source_size, want, slot,
         row_number() OVER (PARTITION BY i.nil, i.nm ORDER BY slot) - 1 AS rank
  FROM g JOIN i ON point >= lo AND point < hi),
b AS (
  SELECT nil, nm, slot, rank % CAST(ceil(source_size / 1024) AS BIGINT) * 1024 AS pos,
         least((rank % CAST(ceil(source_size / 1024) AS BIGINT) + 1) * 1024, source_size,
               want - rank // CAST(ceil(source_size / 1024) AS BIGINT) * source_size) AS until
  FROM k),
x AS (
  SELECT p.nil, p.nm, p.stop, p.size, CAST(sum(least(p.stop, b.until) - greatest(p.stop - p.size, b.pos)) AS BIGINT) AS taken,
         min(slot) AS first_slot
  FROM p JOIN b ON p.nil = b.nil AND p.nm = b.nm AND b.pos < p.stop AND b.until > p.stop - p.size AND b.until > b.pos
  WHERE p.size > 0 GROUP BY ALL)
SELECT p.doc_id, p.source, p.size, t.source_size, t.target, coalesce(x.taken, 0) AS taken, x.first_slot
FROM p JOIN t ON p.nil = t.nil AND p.nm = t.nm
LEFT JOIN x ON p.nil = x.nil AND p.nm = x.nm AND p.stop = x.stop AND p.size = x.size AND p.size > 0
"""
