"""Quality tiers, what is kept, leak-free splits, and the reports over them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids

REJECTED = "C"
SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class Tier:
    """The bounds of one tier; all of them must hold."""

    name: str
    max_cer: float
    min_snr_db: float
    min_dnsmos: float
    max_clipping: float
    min_seconds: float
    max_seconds: float
    allow_multi_speaker: bool

    def holds(self) -> Column:
        """Null CER never passes, null clipping and SNR count as 0, MOS only counts if known."""
        mos = F.when(F.col("dnsmos").isNotNull(), F.col("dnsmos") >= self.min_dnsmos).otherwise(F.coalesce("snr_db", F.lit(0.0)) >= self.min_snr_db)
        alone = F.lit(True) if self.allow_multi_speaker else ~F.coalesce("multi_speaker", F.lit(False))
        parts = (
            F.coalesce(F.col("cer") <= self.max_cer, F.lit(False)),
            F.coalesce(F.col("duration").between(self.min_seconds, self.max_seconds), F.lit(False)),
            F.coalesce("clipping", F.lit(0.0)) <= self.max_clipping,
            alone,
            mos,
            F.coalesce(F.trim("text") != "", F.lit(False)),
        )
        out = F.lit(True)
        for part in parts:
            out = out & part
        return out


#: The two tiers of speech data, in the order in which they are tried.
DEFAULT_TIERS = (
    Tier("A", 0.02, 20.0, 3.0, 0.001, 2.0, 13.0, False),
    Tier("B", 0.15, 10.0, 2.5, 0.01, 1.0, 30.0, True),
)


def tier_of(tiers: Sequence[Tier] = DEFAULT_TIERS) -> Column:
    """The first tier whose bounds hold, else the rejected one; one CASE expression."""
    out = F.when(F.lit(False), F.lit(REJECTED))
    for tier in tiers:
        out = out.when(tier.holds(), F.lit(tier.name))
    return out.otherwise(F.lit(REJECTED))


def is_kept(tier: Column, keep: Sequence[str] | None = None) -> Column:
    """Rejected rows never are; of the others those in ``keep``, or all."""
    return (tier != REJECTED) & (tier.isin(*keep) if keep is not None else F.lit(True))


def split_of(key: Column, val: float, test: float, seed: int = 42) -> Column:
    """The same split for every row of a key."""
    u = ids.uniform(key, seed)
    return F.when(u < test, "test").when(u < test + val, "val").otherwise("train")


def by_tier(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tier").agg(
        F.count("*").alias("n"),
        (F.sum("duration") / 3600).alias("hours"),
        F.avg("cer").alias("avg_cer"),
        F.avg("snr_db").alias("avg_snr_db"),
    )


def by_split(kept: DataFrame) -> DataFrame:
    """All three splits, also those without rows."""
    spark = kept.sparkSession
    names = spark.createDataFrame([(s,) for s in SPLITS], "split string")
    sums = kept.groupBy("split").agg(F.count("*").alias("n"), (F.sum("duration") / 3600).alias("hours"))
    return F.broadcast(names).join(sums, "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("hours", F.lit(0.0)).alias("hours"))


def totals(rows: DataFrame) -> DataFrame:
    """Rows, hours, and speakers; rows without a speaker count as one more speaker."""
    unknown = F.max(F.col("speaker_id").isNull().cast("int"))
    return rows.agg(F.count("*").alias("n"), (F.sum("duration") / 3600).alias("hours"), (F.countDistinct("speaker_id") + F.coalesce(unknown, F.lit(0))).alias("n_speakers"))


def card_stats(metadata: DataFrame) -> DataFrame:
    """What a dataset card says, from metadata whose columns may be text."""
    seconds = F.coalesce(F.col("duration").cast("string").try_cast("double"), F.lit(0.0))
    return metadata.agg(
        F.count("*").alias("n"),
        (F.sum(seconds) / 3600).alias("hours"),
        F.countDistinct(F.coalesce("speaker_id", F.lit(""))).alias("n_speakers"),
        F.count_if(F.col("tier") == "A").alias("n_a"),
        F.count_if(F.col("tier") == "B").alias("n_b"),
    )
