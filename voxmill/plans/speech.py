"""Queries on speech segments: tiers, splits, reports. Events stand in for segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..operators import tiering

VAL, TEST, SEED = 0.1, 0.1, 42

SEGMENTS_SQL = """
seg AS (SELECT event_id AS id, user_id AS file_id, epoch(ts)::DOUBLE AS start, 1 + value / 6.0::DOUBLE AS duration,
  json_extract(props, '$.k')::DOUBLE / 400.0::DOUBLE AS cer, 5 + value / 2.0::DOUBLE AS snr_db,
  CASE WHEN event_id % 3 = 0 THEN 2 + value / 40.0::DOUBLE END AS dnsmos, (event_id % 20) / 10000.0::DOUBLE AS clipping,
  event_type = 'error' AS multi_speaker, user_id || '_spk' || (event_id % 3) AS speaker_id, event_type AS text FROM events),
tiered AS (SELECT *, CASE
  WHEN cer <= 0.02e0 AND duration BETWEEN 2 AND 13 AND clipping <= 0.001e0 AND NOT multi_speaker
   AND (CASE WHEN dnsmos IS NOT NULL THEN dnsmos >= 3e0 ELSE snr_db >= 20e0 END) AND trim(text) <> '' THEN 'A'
  WHEN cer <= 0.15e0 AND duration BETWEEN 1 AND 30 AND clipping <= 0.01e0
   AND (CASE WHEN dnsmos IS NOT NULL THEN dnsmos >= 2.5e0 ELSE snr_db >= 10e0 END) AND trim(text) <> '' THEN 'B'
  ELSE 'C' END AS tier FROM seg),
u AS (SELECT *, ('0x' || substr(sha1('42:' || speaker_id), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE AS u FROM tiered),
split AS (SELECT *, CASE WHEN u < 0.1e0 THEN 'test' WHEN u < 0.2e0 THEN 'val' ELSE 'train' END AS split FROM u)
"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as measured speech segments."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    eid, value = F.col("event_id"), F.col("value")
    return e.select(
        eid.alias("id"),
        F.col("user_id").alias("file_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("_us"),
        (1 + value / 6).alias("duration"),
        (F.get_json_object("props", "$.k").cast("double") / 400).alias("cer"),
        (5 + value / 2).alias("snr_db"),
        F.when(eid % 3 == 0, 2 + value / 40).alias("dnsmos"),
        ((eid % 20) / 10000).alias("clipping"),
        (F.col("event_type") == "error").alias("multi_speaker"),
        F.concat(F.col("user_id").cast("string"), F.lit("_spk"), (eid % 3).cast("string")).alias("speaker_id"),
        F.col("event_type").alias("text"),
    ).withColumn("start", F.col("_us") / 1e6).drop("_us")


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).withColumn("tier", tiering.tier_of())


def packaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.coalesce("speaker_id", F.col("file_id").cast("string"))
    return tiered(spark, sf_dir).withColumn("split", tiering.split_of(key, VAL, TEST, SEED))


def tier_assign(spark, sf_dir):
    return tiered(spark, sf_dir).select("id", "tier")


def keep_filter(spark, sf_dir):
    return tiered(spark, sf_dir).filter(tiering.is_kept(F.col("tier"), ["A", "C"])).select("id", "tier")


def split_assign(spark, sf_dir):
    return packaged(spark, sf_dir).select("id", "speaker_id", "split")


def report_by_tier(spark, sf_dir):
    return tiering.by_tier(tiered(spark, sf_dir)).orderBy("tier")


def report_by_split(spark, sf_dir):
    return tiering.by_split(packaged(spark, sf_dir).filter(tiering.is_kept(F.col("tier"))))


def report_totals(spark, sf_dir):
    return tiering.totals(tiered(spark, sf_dir))


def card_stats(spark, sf_dir):
    return tiering.card_stats(tiered(spark, sf_dir).filter(tiering.is_kept(F.col("tier"))))


def metadata_rows(spark, sf_dir):
    kept = packaged(spark, sf_dir).filter(tiering.is_kept(F.col("tier")))
    name = F.concat(F.lit("wav/"), F.col("split"), F.lit("/"), F.col("id").cast("string"), F.lit(".wav"))
    return kept.select(name.alias("file_name"), "text", "speaker_id", "duration", "snr_db", "cer", "tier", "split")


def dominant_speaker(spark, sf_dir):
    from ..operators.speakers import dominant

    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return dominant(e.select(F.col("user_id").alias("segment"), F.col("event_type").alias("speaker"), F.col("value").alias("seconds")))


def segment_ids(spark, sf_dir):
    s = segments(spark, sf_dir)
    start = F.col("duration") * 10
    return s.select("id", ids.segment_id(F.col("file_id").cast("string"), start, start + F.col("duration")).alias("segment_id"))


QUERIES = {f.__name__: f for f in (tier_assign, keep_filter, split_assign, report_by_tier, report_by_split, report_totals, card_stats, metadata_rows, dominant_speaker, segment_ids)}
SQL = {
    "tier_assign": f"WITH {SEGMENTS_SQL} SELECT id, tier FROM tiered",
    "keep_filter": f"WITH {SEGMENTS_SQL} SELECT id, tier FROM tiered WHERE tier = 'A'",
    "split_assign": f"WITH {SEGMENTS_SQL} SELECT id, speaker_id, split FROM split",
    "report_by_tier": f"WITH {SEGMENTS_SQL} SELECT tier, count(*) AS n, sum(duration) / 3600 AS hours, avg(cer) AS avg_cer, avg(snr_db) AS avg_snr_db FROM tiered GROUP BY tier",
    "report_by_split": f"WITH {SEGMENTS_SQL} SELECT s.split, count(id) AS n, coalesce(sum(duration), 0) / 3600 AS hours FROM (SELECT unnest(['train', 'val', 'test']) AS split) s LEFT JOIN (SELECT * FROM split WHERE tier <> 'C') k USING (split) GROUP BY s.split",
    "report_totals": f"WITH {SEGMENTS_SQL} SELECT count(*) AS n, sum(duration) / 3600 AS hours, count(DISTINCT speaker_id) + max((speaker_id IS NULL)::INT) AS n_speakers FROM tiered",
    "card_stats": f"WITH {SEGMENTS_SQL} SELECT count(*) AS n, sum(duration) / 3600 AS hours, count(DISTINCT speaker_id) AS n_speakers, count(*) FILTER (tier = 'A') AS n_a, count(*) FILTER (tier = 'B') AS n_b FROM tiered WHERE tier <> 'C'",
    "metadata_rows": f"WITH {SEGMENTS_SQL} SELECT 'wav/' || split || '/' || id || '.wav' AS file_name, text, speaker_id, duration, snr_db, cer, tier, split FROM split WHERE tier <> 'C'",
    "dominant_speaker": "WITH t AS (SELECT user_id AS segment, event_type AS speaker, sum(value) AS s FROM events GROUP BY ALL) SELECT segment, arg_max(speaker, s) AS speaker, count(*) > 1 AS multi_speaker FROM t GROUP BY segment",
    "segment_ids": f"WITH {SEGMENTS_SQL} SELECT id, printf('%d_%08d_%08d', file_id, trunc(duration * 10 * 1000)::BIGINT, trunc((duration * 10 + duration) * 1000)::BIGINT) AS segment_id FROM seg",
}
