"""How much of a text's word n-grams occur in a corpus of our own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import workspace
from ..functions import text as tx
from ..functions.windows import run_hashes

#: Distinct n-grams that every task may know; more are met in a shuffle.
FEW_GRAMS = 200_000
#: An n-gram with more than one in HOT_SHARE rows of the index is met in PIECES tasks. There are fewer
#: than HOT_SHARE of these, so every task may know them.
HOT_SHARE, PIECES = 1000, 64
#: Words that a task hashes at once, whatever the length of a text.
WORDS_AT_ONCE = 1 << 17


def tokenised(rows: DataFrame, key: Column, text: Column) -> DataFrame:
    """key, text and its words.

    The fence is not deterministic, so no later filter is moved below it to make words anew. Texts,
    and later their words, go to Python in small batches.
    """
    workspace.bound_batches(rows.sparkSession)
    held = rows.select(key.alias("key"), text.alias("text"), tx.words(text).alias("words"), F.monotonically_increasing_id().alias("fence"))
    return held.filter("fence >= 0").drop("fence")


def index(ours: DataFrame, n: int, wanted: DataFrame | None = None) -> DataFrame:
    """gram, key: each n-gram of each text once, or of ``wanted`` (gram) only; written in that case.

    Texts of fewer words have none. The n-grams that are asked for are few beside all of a
    corpus: they are counted and, up to FEW_GRAMS, known to every task, so that only those found
    in a text are ever made or leave its task.
    """
    if wanted is None:
        return ours.select("key", F.explode(tx.shingles(F.col("words"), n)).alias("gram")).distinct()
    wanted = workspace.saved(wanted.select("gram").distinct(), "wanted_grams")
    if wanted.limit(FEW_GRAMS + 1).count() <= FEW_GRAMS:
        grams = _found(ours, n, [r.gram for r in wanted.collect()]).join(F.broadcast(wanted), "gram", "left_semi")
    else:
        grams = ours.select("key", F.explode(tx.shingles(F.col("words"), n)).alias("gram")).join(wanted, "gram", "left_semi")
    return workspace.saved(grams.select("key", "gram").distinct(), "gram_index")


def _found(ours: DataFrame, n: int, wanted: list[str]) -> DataFrame:
    """key, gram of the n-grams whose hash is that of a wanted one."""
    words = pa.array([w for gram in wanted for w in gram.split(" ")], pa.string())
    known = np.unique(run_hashes(words, n)[::n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words").flatten()
            ends = np.cumsum(batch.column("words").value_lengths().to_numpy())
            for start in range(0, len(words), WORDS_AT_ONCE):
                hashes = run_hashes(words.slice(start, WORDS_AT_ONCE + n - 1), n)
                at = start + np.flatnonzero(np.isin(hashes, known))
                text = np.searchsorted(ends, at, side="right")
                inside = at + n <= ends[text]  # of one text
                grams = [" ".join(words.slice(k, n).to_pylist()) for k in at[inside].tolist()]
                yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(text[inside])), pa.array(grams, pa.string())], names=["key", "gram"])

    return ours.select("key", "words").mapInArrow(run, f"key {ours.schema['key'].dataType.simpleString()}, gram string")


def probe_grams(theirs: DataFrame, n: int, min_words: int) -> DataFrame:
    """key, gram with multiplicity, of texts with at least ``min_words`` words."""
    return theirs.filter(F.size("words") >= max(n, min_words)).select("key", F.explode(tx.shingles(F.col("words"), n)).alias("gram"))


def fractions(grams: DataFrame, grams_of_ours: DataFrame) -> DataFrame:
    """key, n_grams, n_found, frac: the share of n-grams, counted as often as they come.

    Equal n-grams of both sides are counted before the join, so each side has one row per
    n-gram and key, and the index has one per n-gram.
    """
    counted = grams.groupBy("gram", "key").agg(F.count("*").alias("times"))
    known = grams_of_ours.select("gram").distinct().withColumn("known", F.lit(True))
    met = counted.join(known, "gram", "left")
    sums = met.groupBy("key").agg(F.sum("times").alias("n_grams"), F.sum(F.when(F.col("known"), F.col("times")).otherwise(0)).alias("n_found"))
    return sums.withColumn("frac", F.try_divide("n_found", "n_grams"))


def in_pieces(counted: DataFrame, ours: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides (with ``gram``; ours with ``ours``) with ``piece``: 0, or for a hot n-gram of ours one of PIECES.

    Rows of ours go to a piece by their text, rows of the other side to all pieces.
    """
    least = ours.count() // HOT_SHARE
    hot = ours.groupBy("gram").count().filter(F.col("count") > least).select("gram", F.lit(True).alias("hot"))
    hot = F.broadcast(workspace.saved(hot, "hot_grams"))
    split = ours.join(hot, "gram", "left").withColumn("piece", F.when(F.col("hot"), F.pmod(F.xxhash64("ours"), F.lit(PIECES)).cast("int")).otherwise(0)).drop("hot")
    pieces = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PIECES - 1))).otherwise(F.array(F.lit(0)))
    return counted.join(hot, "gram", "left").withColumn("piece", F.explode(pieces)).drop("hot"), split


def best_matches(hits: DataFrame, grams: DataFrame, grams_of_ours: DataFrame, k: int = 3) -> DataFrame:
    """key, ours, common, place: the ``k`` texts of ours with most n-grams in common, by hit.

    An n-gram that very many texts of ours have is met in pieces, each of some of these texts.
    """
    counted = grams.join(hits.select("key"), "key", "left_semi").groupBy("gram", "key").agg(F.count("*").alias("times"))
    counted, ours = in_pieces(counted, grams_of_ours.select("gram", F.col("key").alias("ours")))
    common = counted.join(ours, ["gram", "piece"]).groupBy("key", "ours").agg(F.sum("times").alias("common"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("common"), "ours"))
    return common.withColumn("place", place).filter(F.col("place") <= k)
