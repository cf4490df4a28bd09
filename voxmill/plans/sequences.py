"""Queries on ordered folds, vectors and short signals."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import vectors as vec
from ..operators import clips, segments, shards, signals, speakers

RATE, FRAME, HOP = 64, 16, 8


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _intervals(spark, sf_dir):
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return _read(spark, sf_dir, "events").select(F.col("user_id").alias("file_id"), start.alias("start"), (start + F.col("value")).alias("end"))


def interval_merge(spark, sf_dir):
    return segments.segments_of(_intervals(spark, sf_dir), 60.0, 3600.0, 0.5).select("file_id", "seg_index", "n_segments", "start", "end", "duration")


def interval_cut(spark, sf_dir):
    return segments.segments_of(_intervals(spark, sf_dir), 1.0, 30.0, 0.0).select("file_id", "seg_index", "n_segments", "start", "end", "duration")


def chunk_plan(spark, sf_dir):
    files = _read(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") / 15).alias("duration"))
    return segments.chunk_plan(files, 60.0).select("doc_id", "n_chunks", "chunk", "chunk_start", "chunk_seconds")


def shard_assign(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("lang", F.floor(F.col("doc_id") / 2000).alias("batch"), "doc_id", "n_chars")
    return shards.assign(docs, ["lang", "batch"], "doc_id", "n_chars", 20_000)


def shard_sizes(spark, sf_dir):
    rows = shard_assign(spark, sf_dir)
    return rows.groupBy("lang", "batch", "shard").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def cosine_pairs(spark, sf_dir):
    """The cosine distance of each vector to the next of its label."""
    e = _read(spark, sf_dir, "embeddings")
    after = F.lead("embedding").over(Window.partitionBy("label").orderBy("vec_id"))
    return e.withColumn("next", after).filter("next is not null").select("vec_id", F.round(vec.cosine_distance(F.col("embedding"), F.col("next")), 6).alias("distance"))


def half_distance_flag(spark, sf_dir):
    first, second = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    seconds = F.col("vec_id") % 5
    return _read(spark, sf_dir, "embeddings").select("vec_id", speakers.has_two_voices(first, second, seconds).alias("multi_speaker"))


def clip_ratio(spark, sf_dir):
    return _read(spark, sf_dir, "embeddings").select("vec_id", vec.clipping_ratio(F.col("embedding"), 0.2).alias("clipping"))


def peak_norm(spark, sf_dir):
    x = vec.peak_normalised(F.col("embedding"))
    return _read(spark, sf_dir, "embeddings").select("vec_id", F.round(F.array_max(F.transform(x, F.abs)), 9).alias("peak"), F.round(vec.rms(x), 6).alias("rms"))


def vector_cut(spark, sf_dir):
    """A quarter of a second of each vector, from a place that its number tells."""
    part = clips.cut(F.col("embedding"), RATE, (F.col("vec_id") % 16) / 16, F.lit(0.25))
    return _read(spark, sf_dir, "embeddings").select("vec_id", F.size(part).alias("n"), F.element_at(part, 1).cast("double").alias("first"), F.element_at(part, -1).cast("double").alias("last"))


def vector_concat(spark, sf_dir):
    """Vectors in runs of four, one after the other."""
    parts = _read(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 4).alias("run"), "vec_id", "embedding")
    x = F.col("embedding")
    return clips.joined(parts, "run", "vec_id", "embedding").select("run", F.size(x).alias("n"), F.element_at(x, 1).cast("double").alias("first"), F.element_at(x, -1).cast("double").alias("last"))


def separation_gate(spark, sf_dir):
    x = F.col("embedding")
    ratio = vec.level_ratio(F.slice(x, 33, 16), x)
    return _read(spark, sf_dir, "embeddings").select("vec_id", F.round(ratio, 6).alias("ratio"), vec.needs_separation(ratio, threshold=1.0).alias("separate"), F.round(vec.windowed_mean(x, 9), 6).alias("mos"))


def snr_frames(spark, sf_dir):
    frames = _read(spark, sf_dir, "embeddings").select("vec_id", F.explode(vec.frame_energies(F.col("embedding"), FRAME, HOP)).alias("db"))
    return frames.groupBy("vec_id").agg(F.round(F.percentile("db", F.lit(0.9)) - F.percentile("db", F.lit(0.1)), 2).alias("snr_db"))


def rolloff(spark, sf_dir):
    return _read(spark, sf_dir, "embeddings").select("vec_id", signals.bandwidth_udf(RATE)("embedding").alias("bandwidth_hz"))


def speaker_clusters(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings").select(F.col("label").cast("string").alias("file_id"), F.col("vec_id").alias("id"), "embedding")
    return speakers.clusters(rows, 0.85)


QUERIES = {f.__name__: f for f in (interval_merge, interval_cut, chunk_plan, shard_assign, shard_sizes, cosine_pairs, half_distance_flag, clip_ratio, peak_norm, vector_cut, vector_concat, separation_gate, snr_frames, rolloff, speaker_clusters)}


def _merge_sql(min_s: float, max_s: float, pad: float) -> str:
    return f"""
WITH RECURSIVE c AS (SELECT user_id AS f, epoch(ts)::DOUBLE AS s, epoch(ts)::DOUBLE + value AS e, row_number() OVER (PARTITION BY user_id ORDER BY epoch(ts)::DOUBLE, epoch(ts)::DOUBLE + value) AS i FROM events),
r AS (SELECT f, 1::BIGINT AS i, s, e, NULL::DOUBLE AS os, NULL::DOUBLE AS oe, false AS done, 0 AS step FROM c WHERE i = 1
UNION ALL
SELECT r.f, CASE WHEN r.e - r.s > {max_s} THEN r.i ELSE r.i + 1 END,
  CASE WHEN r.e - r.s > {max_s} THEN r.s + {max_s} WHEN c.f IS NULL OR c.e - r.s <= {max_s} THEN r.s ELSE c.s END,
  CASE WHEN r.e - r.s > {max_s} OR c.f IS NULL THEN r.e ELSE c.e END,
  CASE WHEN r.e - r.s > {max_s} OR c.f IS NULL OR c.e - r.s > {max_s} THEN r.s END,
  CASE WHEN r.e - r.s > {max_s} THEN r.s + {max_s} WHEN c.f IS NULL OR c.e - r.s > {max_s} THEN r.e END,
  r.e - r.s <= {max_s} AND c.f IS NULL, r.step + 1
FROM r LEFT JOIN c ON c.f = r.f AND c.i = r.i + 1 WHERE NOT r.done),
o AS (SELECT f, step, greatest(os - {pad}, 0) AS s, oe + {pad} AS e FROM r WHERE os IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY step) - 1 AS k, count(*) OVER (PARTITION BY f) AS n FROM o WHERE e - s >= {min_s})
SELECT f AS file_id, k::INT AS seg_index, n::INT AS n_segments, s AS start, e AS "end", e - s AS duration FROM k"""


_SHARDS = """
WITH RECURSIVE d AS (SELECT lang, doc_id // 2000 AS batch, doc_id, n_chars, row_number() OVER (PARTITION BY lang, doc_id // 2000 ORDER BY doc_id) AS i FROM documents),
r AS (SELECT lang, batch, doc_id, n_chars, i, 0 AS shard, n_chars AS total FROM d WHERE i = 1
UNION ALL SELECT d.lang, d.batch, d.doc_id, d.n_chars, d.i, r.shard + (r.total >= 20000)::INT, CASE WHEN r.total >= 20000 THEN d.n_chars ELSE r.total + d.n_chars END
FROM r JOIN d ON d.lang = r.lang AND d.batch = r.batch AND d.i = r.i + 1)
"""
_D = "list_transform(embedding, lambda x: x::DOUBLE)"


def _cos(a: str, b: str) -> str:
    return f"1 - list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2])) / (sqrt(list_sum(list_transform({a}, lambda x: x * x))) * sqrt(list_sum(list_transform({b}, lambda x: x * x))) + 1e-9)"


SQL = {
    "interval_merge": _merge_sql(60.0, 3600.0, 0.5),
    "interval_cut": _merge_sql(1.0, 30.0, 0.0),
    "chunk_plan": "WITH d AS (SELECT doc_id, n_chars / 15e0 AS d FROM documents), n AS (SELECT *, (floor(d / 60e0) + (d - floor(d / 60e0) * 60e0 > 0.5e0)::INT)::INT AS n FROM d), k AS (SELECT *, unnest(range(0, n)) AS k FROM n) SELECT doc_id, n AS n_chunks, k::INT AS chunk, k * 60e0 AS chunk_start, least(60e0, d - k * 60e0) AS chunk_seconds FROM k",
    "shard_assign": f"{_SHARDS} SELECT lang, batch, doc_id, n_chars, shard FROM r",
    "shard_sizes": f"{_SHARDS} SELECT lang, batch, shard, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM r GROUP BY ALL",
    "cosine_pairs": f"WITH e AS (SELECT vec_id, label, {_D} AS x FROM embeddings), p AS (SELECT vec_id, x, lead(x) OVER (PARTITION BY label ORDER BY vec_id) AS y FROM e) SELECT vec_id, round({_cos('x', 'y')}, 6) AS distance FROM p WHERE y IS NOT NULL",
    "half_distance_flag": f"WITH e AS (SELECT vec_id, {_D} AS x FROM embeddings) SELECT vec_id, CASE WHEN vec_id % 5 >= 2 THEN {_cos('x[1:32]', 'x[33:64]')} > 0.45e0 END AS multi_speaker FROM e",
    "clip_ratio": f"SELECT vec_id, len(list_filter({_D}, lambda x: abs(x) >= 0.2e0)) / len(embedding)::DOUBLE AS clipping FROM embeddings",
    "vector_cut": "WITH e AS (SELECT vec_id, embedding[vec_id % 16 * 4 + 1:vec_id % 16 * 4 + 16] AS x FROM embeddings) SELECT vec_id, len(x)::INT AS n, x[1]::DOUBLE AS first, x[-1]::DOUBLE AS last FROM e",
    "vector_concat": "SELECT vec_id // 4 AS run, sum(len(embedding))::INT AS n, arg_min(embedding[1], vec_id)::DOUBLE AS first, arg_max(embedding[-1], vec_id)::DOUBLE AS last FROM embeddings GROUP BY 1",
    "peak_norm": f"WITH e AS (SELECT vec_id, {_D} AS x FROM embeddings), p AS (SELECT vec_id, list_transform(x, lambda v: v * (pow(10e0, -3 / 20e0) / list_max(list_transform(x, lambda w: abs(w))))) AS y FROM e) SELECT vec_id, round(list_max(list_transform(y, lambda v: abs(v))), 9) AS peak, round(sqrt(list_sum(list_transform(y, lambda v: v * v)) / len(y)), 6) AS rms FROM p",
    "separation_gate": f"WITH e AS (SELECT vec_id, {_D} AS x FROM embeddings), r AS (SELECT vec_id, x, sqrt(list_sum(list_transform(x[33:48], lambda v: v * v)) / 16) / (sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)) + 1e-9) AS r FROM e) SELECT vec_id, round(r, 6) AS ratio, r >= 1 AS separate, round(list_avg(list_transform(range(0, 7), lambda i: list_sum(x[i * 9 + 1:i * 9 + 9]) / 9)), 6) AS mos FROM r",
    "snr_frames": f"WITH e AS (SELECT vec_id, {_D} AS x FROM embeddings), f AS (SELECT vec_id, unnest(range(0, (len(x) - 16) // 8 + 1)) AS i, x FROM e), d AS (SELECT vec_id, 10 * log10(list_sum(list_transform(x[i * 8 + 1:i * 8 + 16], lambda v: v * v)) / 16 + 1e-12) AS db FROM f) SELECT vec_id, round(quantile_cont(db, 0.9) - quantile_cont(db, 0.1), 2) AS snr_db FROM d GROUP BY vec_id",
}
