"""Mixing of sources to target weights by a low-discrepancy schedule.

1. Targets. A source's words are counted; sources in order of code points (none comes last) have the ``WEIGHTS`` in turn and share the words of all by weight. A target stops at
   ``REPEATS`` times its source's own words, and the excess is shared by the others until none is above: the level of water in vessels of these widths and heights.
2. Blocks. A source's documents are shuffled by a hash of doc_id and text and laid end to end, up to REPEATS times over; every ``BLOCK`` words are a block, of which
   the source gives as many as its target fills, the last one cut at the target. So what is taken of a source is its target, rounded.
3. Schedule. A slot for each block of all sources: slot n has the golden-ratio point ``frac(n / phi)``, in 40 bits, and belongs to the source in whose part of the cumulative numbers of blocks
   it lies. The slots of a source are ranked, and its r-th slot takes its r-th block, an equality join. The sequence gives a source a few slots too many or too few: the blocks
   that still have none take the surplus ones.

Every running number, of words, slots and sources, is a sum within one of at most ``BUCKETS`` buckets of a source, by hash or place, plus that of the buckets before, so a source of any share
of the rows is dealt out evenly. Only rows without texts are shuffled; sums of few numbers come to the driver.

Defined results: a null text has no words; rows without a source are one source, those that share a doc_id or have none are documents of their own, and equal rows are interchangeable; a text of any
length is cut into as many pieces as it has blocks; documents without words take nothing; without any words all targets are 0. Other columns are left alone, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainfold.functions.scalars import numbered
from rainfold.llm.common import Scratch, table

WEIGHTS, REPEATS, BLOCK = (5, 2, 1), 3, 1024
BITS, BUCKETS = 40, 4096
#: 2**40 divided by the golden ratio, made odd.
GOLDEN = int((1 << BITS) * (5**0.5 - 1) / 2) | 1
WORDS = r"[^\x20\x09-\x0D]+"


def running(df: DataFrame, keys: list[str], bucket: str, order: str | Column, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the same keys before a row, in order of ``bucket`` and within it of ``order``."""
    ahead = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    before = sums.select(*keys, bucket, F.coalesce(F.sum("_sum").over(ahead(*keys).orderBy(bucket)), F.lit(0)).alias("_before"))
    within = F.coalesce(F.sum(value).over(ahead(*keys, bucket).orderBy(order)), F.lit(0))
    return df.join(before, [*keys, bucket]).withColumn(name, F.col("_before") + within).drop("_before")


def sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, place)``: words of each document and its place in the shuffle."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    place = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"), place.alias("place"))


def targets(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(src, source, source_size, target, quota, blocks)`` of sized documents; ``src`` numbers the sources from 0, quota is the target in whole words."""
    sums = numbered(docs.groupBy("source").agg(F.sum("size").alias("source_size")), [F.col("source").asc_nulls_last()], "src").withColumn("src", F.col("src") - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("src") % len(WEIGHTS)).cast("int") + 1)
    sums = scratch.write(sums.withColumns({"weight": weight, "most": REPEATS * F.col("source_size")}))
    total, level, full = sums.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], 0.0, -1
    while True:  # each pass fills the sources that the last level exceeds; the level only rises
        at = F.col("most") <= level * F.col("weight") if full >= 0 else F.lit(False)
        row = sums.agg(F.count_if(at).alias("full"), F.sum(F.when(at, F.col("most"))).alias("most"), F.sum(F.when(~at, F.col("weight"))).alias("weight")).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (total - (row["most"] or 0)) / row["weight"]
    target = F.least(F.col("most").cast("double"), level * F.col("weight"))
    out = sums.withColumn("target", target).withColumn("quota", F.least("most", F.round("target").cast("long")))
    return scratch.write(out.select("src", "source", "source_size", "target", "quota", F.ceil(F.col("quota") / BLOCK).alias("blocks")))


def schedule(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``(slot, src, block)``: each block of every source once, in the order of the mix."""
    n = sources.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    if n >> BITS:
        raise ValueError(f"{n} blocks are more than there are points; raise BLOCK")
    bits = max(12, sources.count().bit_length() + 2)
    part = lambda blocks: F.floor(blocks.cast("decimal(38,0)") * (1 << BITS) / max(n, 1)).cast("long")
    parts = running(sources.select("src", "blocks", F.shiftright("src", 12).alias("bucket")), [], "bucket", "src", "blocks", "before")
    parts = parts.select("src", "blocks", part(F.col("before")).alias("low"), part(F.col("before") + F.col("blocks")).alias("high")).where("low < high")
    cells = scratch.write(parts.withColumn("cell", F.explode(F.sequence(F.shiftright("low", BITS - bits), F.shiftright(F.col("high") - 1, BITS - bits)))))
    # The product modulo 2**40, in two halves that fit a long.
    mask, half = (1 << BITS) - 1, BITS // 2
    number = F.col("slot") + 1
    high = (F.shiftright(number, half) * GOLDEN).bitwiseAND((1 << half) - 1)
    point = (F.shiftleft(high, half) + number.bitwiseAND((1 << half) - 1) * GOLDEN).bitwiseAND(mask)
    slots = sources.sparkSession.range(n).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.shiftright("point", BITS - bits))
    slots = slots.join(scratch.sized(cells), "cell").where("low <= point and point < high")
    slots = scratch.write(slots.select("slot", "src", "blocks", F.floor(F.col("slot") / max(1, -(-n // BUCKETS))).alias("bucket"), F.lit(1).cast("long").alias("one")))
    ranked = scratch.write(running(slots, ["src"], "bucket", "slot", "one", "block"))
    spare = scratch.write(ranked.where("block >= blocks").select("slot", "src", "one", F.shiftright("src", 12).alias("bucket")))
    spare = running(spare, [], "bucket", F.struct("src", "slot"), "one", "nth").select("nth", "slot")
    have = slots.groupBy("src").agg(F.count("*").alias("have"))
    short = sources.join(have, "src", "left").withColumn("have", F.coalesce("have", F.lit(0))).withColumn("short", F.col("blocks") - F.col("have")).where("short > 0")
    short = scratch.write(short.select("src", "have", "short", F.shiftright("src", 12).alias("bucket")))
    late = running(short, [], "bucket", "src", "short", "before").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("short") - 1)))
    late = late.select("src", (F.col("have") + F.col("i")).alias("block"), (F.col("before") + F.col("i")).alias("nth")).join(spare, "nth")
    return ranked.where("block < blocks").select("slot", "src", "block").unionByName(late.select("slot", "src", "block"))


def mix(docs: DataFrame) -> DataFrame:
    """Pieces of documents in the mix: ``doc`` tells documents apart, of which those that give nothing have one piece of length 0 without slot.

    ``(doc, doc_id, source, size, source_size, target, slot, offset, start, length)``: words from ``start`` of the document, which stand at ``offset`` in the slot.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    own = scratch.write(sized(docs))
    sources = targets(own, scratch)
    slots = schedule(sources, scratch)
    small = scratch.sized(sources.withColumnRenamed("source", "name"))
    own = own.join(small, F.col("source").eqNullSafe(F.col("name"))).drop("name").withColumn("bucket", F.conv(F.left("place", F.lit(3)), 16, 10).cast("long"))
    own = own.withColumn("row", F.row_number().over(Window.partitionBy("src", "bucket").orderBy("place", "doc_id", "size")).cast("long"))
    own = running(scratch.write(own), ["src"], "bucket", "row", "size", "at")
    starts = F.filter(F.array(*(F.col("at") + i * F.col("source_size") for i in range(REPEATS))), lambda s: (s < F.col("quota")) & (F.col("size") > 0))
    laid = own.withColumn("from", F.explode_outer(starts)).withColumn("to", F.least(F.col("from") + F.col("size"), "quota"))
    block = lambda c: F.floor(c / BLOCK).cast("long")
    # A document that gives nothing has a key of its own in the join, not the same one as all such.
    laid = laid.withColumn("block", F.explode_outer(F.sequence(block(F.col("from")), block(F.col("to") - 1)))).withColumn("block", F.coalesce("block", -F.col("row")))
    begin = F.when(F.col("from").isNotNull(), F.greatest("from", F.col("block") * BLOCK))
    pieces = laid.join(slots, ["src", "block"], "left")
    return pieces.select(
        F.struct("src", "bucket", "row").alias("doc"), "doc_id", "source", "size", "source_size", "target", "slot", (begin - F.col("block") * BLOCK).alias("offset"),
        (begin - F.col("from")).alias("start"), F.coalesce(F.least("to", (F.col("block") + 1) * BLOCK) - begin, F.lit(0)).alias("length"),
    )


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = mix(table(spark, sf_dir, "documents"))
    return pieces.groupBy("doc", "doc_id", "size", "source_size", "target").agg(F.sum("length").alias("taken"), F.min("slot").alias("first_slot")).drop("doc")


#: Positions by one window a source; a block's slot by a full join of slots and sources.
OP12_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS place FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM d GROUP BY source
), w AS (SELECT *, 3 * n AS most, [5, 2, 1][src % 3 + 1] AS weight, sum(n) OVER () AS total FROM s),
r AS (
  SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / CAST(sum(weight) OVER (ORDER BY most / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM w
), t AS MATERIALIZED (
  SELECT src, source, n, q.target, q.quota, CAST(ceil(q.quota / {BLOCK}) AS BIGINT) AS blocks FROM (
    SELECT *, least(CAST(round(target) AS BIGINT), most) AS quota FROM (SELECT src, source, n, most, least(CAST(most AS DOUBLE), weight * (SELECT min_by(level, most / weight) FROM r WHERE most / weight >= level)) AS target FROM w)
  ) q
), p AS (
  SELECT src, blocks, (before * {1 << BITS}) // greatest(1, every) AS low, ((before + blocks) * {1 << BITS}) // greatest(1, every) AS high FROM (
    SELECT src, CAST(blocks AS HUGEINT) AS blocks, coalesce(sum(blocks) OVER (ORDER BY src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(blocks) OVER () AS every FROM t)
), z AS MATERIALIZED (
  SELECT slot, src, blocks, row_number() OVER (PARTITION BY src ORDER BY slot) - 1 AS block FROM (
    SELECT i AS slot, (CAST(i + 1 AS HUGEINT) * {GOLDEN}) % {1 << BITS} AS point FROM range((SELECT CAST(sum(blocks) AS BIGINT) FROM t)) x(i)
  ) JOIN p ON low <= point AND point < high
), short AS (
  SELECT src, have, blocks - have AS short, coalesce(sum(blocks - have) OVER (ORDER BY src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
    SELECT t.src, t.blocks, coalesce(h.have, 0) AS have FROM t LEFT JOIN (SELECT src, count(*) AS have FROM z GROUP BY src) h USING (src)) WHERE blocks > have
), slots AS MATERIALIZED (
  SELECT slot, src, block FROM z WHERE block < blocks
  UNION ALL SELECT y.slot, x.src, x.have + x.i FROM (SELECT *, unnest(range(CAST(short AS BIGINT))) AS i FROM short) x
    JOIN (SELECT slot, row_number() OVER (ORDER BY src, slot) - 1 AS nth FROM z WHERE block >= blocks) y ON y.nth = x.before + x.i
), o AS (
  SELECT row_number() OVER () AS id, d.*, t.src, t.n, t.target, t.quota,
    coalesce(sum(size) OVER (PARTITION BY t.src ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), u AS (
  SELECT id, src, k.a, least(k.a + size, quota) AS b FROM (SELECT *, unnest([CAST(pos + e * n AS BIGINT) FOR e IN [0, 1, 2]]) AS a FROM o WHERE size > 0) k WHERE k.a < quota
), g AS (SELECT id, sum(b - a) AS taken FROM u GROUP BY id),
f AS (
  SELECT id, min(slot) AS first_slot FROM (SELECT id, src, unnest(range(CAST(a // {BLOCK} AS BIGINT), CAST((b - 1) // {BLOCK} + 1 AS BIGINT))) AS block FROM u) JOIN slots USING (src, block) GROUP BY id
)
SELECT doc_id, size, n AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, CAST(first_slot AS BIGINT) AS first_slot
FROM o LEFT JOIN g USING (id) LEFT JOIN f USING (id)
"""
