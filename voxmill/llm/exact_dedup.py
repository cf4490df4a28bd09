"""Operator 3: exact dedup by a 128-bit content hash, with a comparison of the bytes.

Texts are equal when identical after each run of ASCII white space became one space. Documents
meet by the MD5 of that text, and rows carry (MD5, SHA-256) as the name of their text. The texts
behind every MD5 that two or more rows have are then grouped by their bytes: should two texts
ever have the same name, their rows get the text itself as a third part of it.

Cases. Null text counts as empty. The smallest ``doc_id`` stays, null ids come last. Of rows
that repeat both id and text exactly one stays (any, as they are the same document). An empty
table gives an empty result. Other columns, whatever their names, are passed on by
``keep_first``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import joins, scratch
from .words import SPACES

#: The parts of a text's name.
NAME = ["h", "sha", "more"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def md5_of(text: Column) -> Column:
    """The content hash, 128 bits."""
    return F.unhex(F.md5(text))


def sha_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


HASHES: tuple[Callable[[Column], Column], ...] = (md5_of, sha_of)


def named(rows: DataFrame, clashing: DataFrame | None, hashes=HASHES) -> DataFrame:
    """``rows`` with NAME instead of their text ``t``. ``clashing``: h, sha of several texts."""
    rows = rows.withColumns({"h": hashes[0](F.col("t")), "sha": hashes[1](F.col("t"))})
    if clashing is None:
        return rows.withColumn("more", F.lit("")).drop("t")
    met = joins.keyed_filter(rows, clashing.withColumn("clash", F.lit(True)), ["h", "sha"], "left")
    return met.withColumn("more", F.when(F.col("clash"), F.col("t")).otherwise(F.lit(""))).drop("t", "clash")


def clashes(docs: DataFrame, narrow: DataFrame, hashes=HASHES) -> DataFrame | None:
    """h, sha of names that several texts have, by their bytes; None if there are none.

    Only the texts behind a shared hash are moved. Equal ones are combined before the shuffle, so
    a text that a third of the rows share crosses it once per task.
    """
    shared = scratch.save(narrow.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "shared_hashes")
    t = normalised(F.col("text"))
    met = joins.keyed_filter(docs.select(hashes[0](t).alias("h"), t.alias("t")), shared, ["h"], "left_semi")
    texts = met.groupBy("h", "t").agg(F.count("*").alias("n")).select("h", hashes[1](F.col("t")).alias("sha"))
    found = scratch.save(texts.groupBy("h", "sha").agg(F.count("*").alias("n")).filter("n > 1").select("h", "sha"), "clashes")
    return found if found.limit(1).count() else None


def judged(docs: DataFrame, hashes=HASHES) -> tuple[DataFrame, DataFrame | None]:
    """The verdict on every row of ``docs`` (doc_id, text) with NAME, and the clashing names."""
    rows = docs.select("doc_id", normalised(F.col("text")).alias("t"), F.monotonically_increasing_id().alias("tag"))
    # the tag tells apart rows with the same id and text; it is fixed by being written
    narrow = scratch.save(named(rows, None, hashes), "fingerprints")
    clashing = clashes(docs, narrow, hashes)
    if clashing is not None:
        narrow = scratch.save(named(rows, clashing, hashes), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("first")
    groups = scratch.save(narrow.groupBy(*NAME).agg(F.count("*").alias("n"), first).filter("n > 1"), "copies")
    met = joins.weighted_join(narrow, groups, NAME, "n")
    alone = F.col("n").isNull()
    verdict = met.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("tag") == F.col("first.tag"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *NAME,
    )
    return verdict, clashing


def verdicts(docs: DataFrame, hashes=HASHES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept and text_sha256."""
    return judged(docs, hashes)[0].drop(*NAME)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def keep_first(spark: SparkSession, docs: DataFrame, hashes=HASHES) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns.

    The dropped rows, by id and name, are the narrow side of an anti join. Rows that repeat the
    id and text of the one that stays share both: they are taken apart from the rest and one of
    each is kept.
    """
    verdict, clashing = judged(docs.select("doc_id", "text"), hashes)
    verdict = scratch.save(verdict, "dedup")
    who = [F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")]
    key = ["none", "id", *NAME]
    gone = scratch.save(verdict.filter("not kept").select(*who, *NAME).distinct(), "dropped_rows")
    again = verdict.filter("group_size > 1").groupBy(*who, *NAME).agg(F.count("*").alias("n"), F.max("kept").alias("stays"))
    again = scratch.save(again.filter("n > 1 and stays").select(*key), "repeated_rows")
    rows = named(docs.select(F.struct(*docs.columns).alias("row"), *who, normalised(F.col("text")).alias("t")), clashing, hashes)
    left = joins.keyed_filter(rows, gone, key, "left_anti").select("row")
    if again.limit(1).count():
        left = left.unionByName(joins.keyed_filter(rows, again, key, "left_semi").dropDuplicates(key).select("row"))
    return left.select("row.*")


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""
