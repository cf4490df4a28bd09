"""Operator 8: mix sources to target weights by Pareto order sampling.

Every source gets a target of words: its weight's share of ``share`` times all words, at most
``max_repeat`` times what it has, what is above going to the others by weight. Inside a source a
document is expected in e = least(max_repeat, level * k) copies, where k grows with the binary
logarithm of its size (1 for a word, CLASSES from 2 ** (CLASSES - 1) words on: a short text is
worth fewer repeats) and the level is the one at which the source's words add up to its target.

The whole part of e is given for certain. The fraction p is the document's inclusion
probability in a Pareto sample: it draws U from a hash of its id, and documents are taken in the
order of the odds of U over the odds of p until the words are there. So probabilities differ
inside a source and the size is fixed: it misses the target by half a document at most.

Cases. Null text and texts without words have size 0 and are taken 0 words. A null source is
a source of its own, the last in order. Rows with the same id draw the same U and stand next to
each other, ordered by size. A table without words has targets of 0. Input columns are passed on
by ``repeat_rows``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import joins, scratch
from .words import count_words

#: The sources' weights in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Classes of sizes; a document's class is its weight inside its source.
CLASSES = 11
#: Ranks are cut into so many slices, evenly below 2, as the target is reached near a rank of 1.
#: Only the slice in which a source's target is reached is sorted. A power of 4.
SLICES = 4096
SEED = "mix:"


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``s`` (source, never null), ``size``, its class ``k`` and the draw ``u`` in (0, 1)."""
    key = F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = (F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 48))
    source = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    held = docs.select("*", source.alias("s"), count_words(F.col("text")).alias("size"), draw.alias("u"))
    return held.withColumn("k", F.least(F.length(F.bin("size")), F.lit(CLASSES)))


def measured_sources(sizes: DataFrame) -> DataFrame:
    """s, k, n (rows) and words of every class of every source, written."""
    return scratch.save(sizes.groupBy("s", "k").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix_classes")


def numbered(by_source: DataFrame) -> DataFrame:
    """``by_source`` with ``place``, its number in the order of ``s``, counted over range partitions."""
    ordered = by_source.repartitionByRange("s").sortWithinPartitions("s").withColumn("at", F.monotonically_increasing_id())
    held = scratch.save(ordered, "mix_sources").withColumn("part", F.shiftright("at", 33))
    counts = sorted(held.groupBy("part").agg(F.count("*")).collect())  # a row per partition of one shuffle
    starts = [(part, sum(n for _, n in counts[:k])) for k, (part, _) in enumerate(counts)]
    starts = by_source.sparkSession.createDataFrame(starts, "part long, start long")
    place = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return held.join(F.broadcast(starts), "part").withColumn("place", place).drop("part", "at", "start")


def targets(classes: DataFrame, share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """One row per source: ``s``, ``source_size``, ``target``.

    Filling up by weight: a level is what is left for the sources that have room, per weight.
    Sources without that much room are full, the level rises for the others, and so on until no
    more are full. Each round only brings two sums to the driver.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    fill = numbered(classes.groupBy("s").agg(F.sum("words").alias("source_size"))).withColumn("w", weight.cast("long"))
    fill = fill.withColumn("room", max_repeat * F.col("source_size") / F.col("w"))
    sums = F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))
    total, weights = fill.agg(*sums).first()
    level, full, room_for = None, 0, weights
    while room_for:
        level = (share * total - max_repeat * full) / room_for
        full, filled = fill.filter(F.col("room") < level).agg(*sums).first()
        if weights - filled == room_for:
            break
        room_for = weights - filled
    cap = max_repeat * F.col("source_size")
    target = F.least(cap, F.lit(level) * F.col("w")) if room_for else cap
    return fill.select("s", "source_size", target.cast("double").alias("target"))


def copies_of(classes: DataFrame, target: DataFrame, max_repeat: float = 2.0) -> DataFrame:
    """``classes`` with source_size, target, ``whole`` copies, ``p`` and the source's ``rest``."""
    met = classes.join(target, "s")
    by_room = Window.partitionBy("s").orderBy(F.desc("k"))  # CLASSES rows at most
    fuller = F.coalesce(F.sum("words").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = F.sum(F.col("k") * F.col("words")).over(by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    met = met.withColumn("level", F.try_divide(F.col("target") - max_repeat * fuller, shares.cast("double")))
    fits = F.when(F.col("level") <= F.lit(max_repeat) / F.col("k"), F.col("level"))
    met = met.withColumn("level", F.max(fits).over(Window.partitionBy("s")))
    copies = F.least(F.lit(max_repeat), F.coalesce(F.col("level") * F.col("k"), F.lit(max_repeat)))
    met = met.withColumn("whole", F.floor(copies).cast("long")).withColumn("p", copies - F.floor(copies))
    met = met.withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(Window.partitionBy("s")))
    return met.drop("words", "level")


def ranked(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """``sizes`` with the columns of ``plan`` and, for those with a fraction, ``rank`` and ``slice``."""
    met = joins.weighted_join(sizes, plan, ["s", "k"], "n", "inner")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    met = met.drop("n").withColumn("rank", F.when(F.col("p") > 0, odds))
    return met.withColumn("slice", F.least(F.col("rank") * (SLICES // 2), F.lit(SLICES - 1.0)).cast("int"))


def edges_of(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """s, ``edge`` and ``start``: the slice that does not fit whole, and the words before it.

    Slices are summed in two steps, so that no key has more than the root of SLICES rows.
    """
    sums = ranked(sizes, plan).filter("p > 0").groupBy("s", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    step = round(SLICES**0.5)
    sums = sums.withColumn("band", F.floor(F.col("slice") / step).cast("int"))
    rows = Window.unboundedPreceding, -1
    bands = sums.groupBy("s", "band").agg(F.sum("words").alias("words"))
    bands = bands.select("s", "band", F.coalesce(F.sum("words").over(Window.partitionBy("s").orderBy("band").rowsBetween(*rows)), F.lit(0)).alias("below"))
    inside = F.coalesce(F.sum("words").over(Window.partitionBy("s", "band").orderBy("slice").rowsBetween(*rows)), F.lit(0))
    placed = sums.join(bands, ["s", "band"]).withColumn("start", F.col("below") + inside)
    first = placed.filter(F.col("start") + F.col("words") > F.col("rest")).groupBy("s").agg(F.min(F.struct("slice", "start")).alias("at"))
    return first.select("s", F.col("at.slice").alias("edge"), F.col("at.start").alias("start"))


def at_edge() -> Column:
    return F.coalesce(F.col("slice") == F.col("edge"), F.lit(False))


def extra() -> Column:
    """What is decided without sorting: slices before the edge are taken, those after it not."""
    return F.when(F.col("p") > 0, F.coalesce(F.col("slice") < F.col("edge"), F.lit(True)).cast("long")).otherwise(F.lit(0))


def decided_edges(met: DataFrame) -> DataFrame:
    """The rows of ``met`` in their source's edge slice, with ``extra``, by sorting each slice."""
    inside = Window.partitionBy("s").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    sorted_part = met.filter(at_edge()).withColumn("gone", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # take a document if that brings the sum nearer to the target
    return sorted_part.withColumn("extra", (F.col("gone") + F.col("size") / 2 <= F.col("rest")).cast("long")).drop("gone")


def plan_of(sizes: DataFrame, share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """What every class of every source gets, one row each, with its source's edge; written."""
    classes = measured_sources(sizes)
    plan = scratch.save(copies_of(classes, targets(classes, share, max_repeat), max_repeat), "mix_copies")
    return scratch.save(plan.join(edges_of(sizes, plan), "s", "left"), "mix_plan")


def allocate(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """``sizes`` (a written table) with ``source_size``, ``target``, ``copies`` and ``taken``."""
    met = ranked(sizes, plan)
    both = met.filter(~at_edge()).withColumn("extra", extra()).unionByName(decided_edges(met))
    out = both.withColumn("copies", F.col("whole") + F.col("extra"))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("whole", "p", "rest", "rank", "slice", "edge", "start", "extra")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    sizes = scratch.save(sized(docs).drop("text", "source"), "mix_sizes")
    return allocate(sizes, plan_of(sizes)).select("doc_id", "size", "source_size", "target", "taken")


def repeat_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a document with two copies comes twice, one with none goes.

    A document's rank follows from its id, its source and its size, so texts stay where they are:
    only the narrow rows in the edge slices are sorted, and only their decisions are looked up.
    Rows that repeat an id, a source and a size share the decision of the first. Documents
    without words have nothing to sample and stay once.
    """
    sizes = scratch.save(sized(docs.select("doc_id", "source", "text")).drop("text", "source"), "mix_sizes")
    plan = plan_of(sizes)
    name = [F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("s"), F.col("size")]
    keys = ["none", "id", "s", "size"]
    sorted_part = decided_edges(ranked(sizes, plan)).groupBy(*name).agg(F.max("extra").alias("found"))
    sorted_part = scratch.save(sorted_part, "mix_edge_rows")
    whole = F.struct(*docs.columns).alias("row")
    met = ranked(sized(docs.select("doc_id", "source", "text", whole)).drop("text", "source"), plan).withColumns({"none": name[0], "id": name[1]})
    met = joins.keyed_filter(met, sorted_part, keys, "left")
    copies = F.col("whole") + F.when(at_edge(), F.coalesce("found", F.lit(0))).otherwise(extra())
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(copies).cast("int")
    again = met.select("row", copies.alias("copies")).filter("copies > 0")
    return again.select("row", F.explode(F.array_repeat(F.lit(True), F.col("copies")))).select("row.*")


SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  (('0x' || md5('mix:' || doc_id)[1:12])::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u FROM documents),
z AS (SELECT *, least(length(bin(size)), 11) AS k FROM d),
g AS (SELECT source, sum(size)::DOUBLE AS ss, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(i - 1) % 3 + 1] AS w FROM g),
r AS (SELECT *, 2.0::DOUBLE * ss / w AS room FROM w),
f AS (SELECT *, coalesce(sum(ss) OVER (ORDER BY room, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ful,
             sum(w) OVER (ORDER BY room, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS op, sum(ss) OVER () AS total FROM r),
l AS (SELECT *, (1.5::DOUBLE * total - 2.0::DOUBLE * ful) / op AS lv FROM f),
t AS (SELECT *, least(2.0::DOUBLE * ss, coalesce((max(lv) FILTER (lv <= room) OVER ()) * w, 2.0::DOUBLE * ss)) AS target FROM l),
c AS (SELECT source, k, sum(size)::DOUBLE AS words FROM z GROUP BY ALL),
e AS (SELECT c.*, i, ss, target, (target - 2.0::DOUBLE * coalesce(sum(words) OVER (PARTITION BY i ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / nullif(sum(k * words) OVER (PARTITION BY i ORDER BY k DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS lv
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, least(2.0::DOUBLE, coalesce((max(lv) FILTER (lv <= 2.0::DOUBLE / k) OVER (PARTITION BY i)) * k, 2.0::DOUBLE)) AS copies FROM e),
p AS (SELECT *, floor(copies) AS whole, copies - floor(copies) AS p, target - sum(floor(copies) * words) OVER (PARTITION BY i) AS rest FROM x),
q AS (SELECT doc_id, size, ss, target, whole, p, rest, i, (u / (1 - u)) / nullif(p / (1 - p), 0) AS rank
      FROM z JOIN p ON z.source IS NOT DISTINCT FROM p.source AND z.k = p.k),
o AS (SELECT *, coalesce(sum(size) FILTER (p > 0) OVER (PARTITION BY i ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM q)
SELECT doc_id, size, ss::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN p > 0 AND gone + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM o
"""
