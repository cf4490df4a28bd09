"""Queries on signals that Spark makes from the tables: speech, turns, loudness, headers, hosts, recordings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from .. import workspace
from ..functions import text as tx
from ..operators import clips, extraction, hosts, loudness, signals, speakers
from ..providers import OutOfMemory, energy_gate
from ..sources import feeds, headers

RATE = 1000


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _loud_parts(x, rate):
    return energy_gate(x, rate, 30, 10.0)


def speech_intervals(spark, sf_dir):
    """Each vector's numbers as 30 ms of sound; stretches within 10 dB of the loudest."""
    x = F.flatten(F.transform("embedding", lambda v: F.array_repeat(v, 30)))
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", x.alias("samples"))
    found = hosts.speech_intervals(rows, "samples", F.lit(RATE), _loud_parts)
    return found.select("vec_id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


def _tone(hz, seconds):
    return F.transform(F.sequence(F.lit(0), (seconds * RATE - 1).cast("int")), lambda i: F.sin(2 * np.pi * hz * i / RATE))


def _bands():
    """An embedder without a model: the energy in eight bands."""
    return lambda x, rate: np.array([b.sum() for b in np.array_split(np.abs(np.fft.rfft(x)) ** 2, 8)])


def diarised_segments(spark, sf_dir):
    """Two voices in turn, as long as a vector's number says; who speaks most, and whether two do."""
    first, second, third = (F.col("vec_id") % 3) + 1, F.col("vec_id") % 5, F.col("vec_id") % 2
    none = F.array().cast("array<double>")
    x = F.concat(_tone(100, first), F.when(second > 0, _tone(330, second)).otherwise(none), F.when(third > 0, _tone(100, third)).otherwise(none))
    rows = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"), x.alias("samples"))
    turns = hosts.diarised(rows, "id", "samples", RATE, "bands", _bands, 1.0, 1.0)
    best = speakers.dominant(turns.withColumn("seconds", F.round("seconds", 3)))
    return best.select(F.col("segment").cast("long").alias("vec_id"), F.regexp_extract("speaker", "(spk.*)", 1).alias("speaker"), "multi_speaker")


def loudness_levels(spark, sf_dir):
    """Tones of a known loudness: measured, and measured again after they were brought to -23 LUFS."""
    rate = 16_000
    level = 10 + F.col("vec_id") % 30
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", F.pow(F.lit(10.0), (3.01 - level) / 20).alias("amp"))
    x = F.transform(F.sequence(F.lit(0), F.lit(rate)), lambda i: F.col("amp") * F.sin(2 * np.pi * 997 * i / rate))
    rows = rows.select("vec_id", x.alias("x"))
    after = loudness.measures(rate)(loudness.array_normalised(rate)("x"))
    found = rows.select("vec_id", loudness.measures(rate)("x").alias("before"), after.alias("after"))
    return found.select("vec_id", F.round("before.lufs").cast("int").alias("lufs"), F.round("after.lufs").cast("int").alias("after"))


def _wav(spark, sf_dir):
    """Each vector as WAV bytes, as often as its number says."""
    encode = F.pandas_udf(lambda xs: xs.map(lambda x: signals.encode_wav(np.asarray(x), 8000)), "binary")
    x = F.flatten(F.array_repeat("embedding", (F.col("vec_id") % 50 + 1).cast("int")))
    return _read(spark, sf_dir, "embeddings").select("vec_id", encode(x).alias("content"))


def header_durations(spark, sf_dir):
    return _wav(spark, sf_dir).select("vec_id", headers.content_duration("content").alias("seconds"))


def recordings_written(spark, sf_dir):
    """Runs of eight WAVs written as one file each and measured by the files' headers."""
    parts = _wav(spark, sf_dir).withColumn("run", F.floor(F.col("vec_id") / 8))
    out = workspace.new_folder(spark, "recordings")
    done = workspace.saved(clips.recordings_written(parts, out, "run", "vec_id"), "written")
    return done.select("run", "parts", F.round("seconds", 6).alias("seconds"), F.round(headers.file_duration("path"), 6).alias("by_header"))


def _shouts():
    """A model without weights that fails on some items and has room for 4,000 characters a batch."""

    def run(texts):
        if sum(map(len, texts)) > 4000 and len(texts) > 1:
            raise OutOfMemory
        if any("§" in t for t in texts):
            raise ValueError("unreadable")
        return [t[:20].strip().upper() for t in texts]

    return run


def hosted_model(spark, sf_dir):
    """Turns through a model in batches of 64 that fails on every thirteenth and runs out of memory."""
    text = F.when((F.col("conv_id") + F.col("turn")) % 13 == 0, F.concat(F.lit("§"), "text")).otherwise(F.translate("text", "§", ""))
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", F.regexp_replace(text, "[^ -~§]", "").alias("said"))
    return hosts.hosted(rows, "shouts", _shouts, ["said"], "out", "string", 64).select("conv_id", "turn", "out")


def extracted_media(spark, sf_dir):
    """Vectors as WAVs in rows that share a hundred names, written as files; the metadata that names them."""
    rows = _wav(spark, sf_dir).select(F.struct(F.col("content").alias("bytes"), F.format_string("in/clip %02d.wav", F.col("vec_id") % 100).alias("path")).alias("audio"), F.col("vec_id").cast("string").alias("text"), (F.col("vec_id") % 7).alias("shard"), F.col("vec_id").alias("row"))
    out = workspace.new_folder(spark, "extracted")
    extraction.extract(rows, out)
    return spark.read.schema("file_name string, text string").option("header", True).option("escape", '"').csv(f"{out}/metadata.csv")


PATTERN = "/[a-m][^/]*$"


def detail_links(spark, sf_dir):
    """Links of pages and of the detail pages they lead to; each page is stored where its first link leads."""
    pages = _read(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), "url", "html")
    at = tx.resolved(F.col("url"), F.get(tx.hrefs(F.col("html")), F.lit(0)))
    return feeds.followed_audio(pages, pages.select(at.alias("url"), "html"), PATTERN, 5).select("url", "listing_page", F.col("place.pos").alias("pos"), (F.col("place.detail") >= 0).alias("followed"))


QUERIES = {f.__name__: f for f in (speech_intervals, diarised_segments, loudness_levels, header_durations, recordings_written, hosted_model, extracted_media, detail_links)}
_HREFS = r"""regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1)"""
SQL = {
    "speech_intervals": """WITH f AS (SELECT vec_id, i, 10 * log10(embedding[i]::DOUBLE * embedding[i]::DOUBLE + 1e-12) AS db FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)),
l AS (SELECT vec_id, i, i - row_number() OVER (PARTITION BY vec_id ORDER BY i) AS run FROM (SELECT *, max(db) OVER (PARTITION BY vec_id) AS top FROM f) WHERE db > top - 10 AND top > -100)
SELECT vec_id, round((min(i) - 1) * 30 / 1000e0, 3) AS start, round(max(i) * 30 / 1000e0, 3) AS "end" FROM l GROUP BY vec_id, run""",
    "diarised_segments": "SELECT vec_id, CASE WHEN vec_id % 5 >= vec_id % 3 + 1 + vec_id % 2 THEN 'spk1' ELSE 'spk0' END AS speaker, vec_id % 5 > 0 AS multi_speaker FROM embeddings",
    "loudness_levels": "SELECT vec_id, (-10 - vec_id % 30)::INT AS lufs, -23::INT AS after FROM embeddings",
    "header_durations": "SELECT vec_id, 64 * (vec_id % 50 + 1) / 8000e0 AS seconds FROM embeddings",
    "recordings_written": "SELECT vec_id // 8 AS run, count(*) AS parts, round(sum(64 * (vec_id % 50 + 1)) / 8000e0, 6) AS seconds, round(sum(64 * (vec_id % 50 + 1)) / 8000e0, 6) AS by_header FROM embeddings GROUP BY 1",
    "extracted_media": """SELECT printf('clip_%02d', vec_id % 100) || CASE WHEN row_number() OVER (PARTITION BY vec_id % 100 ORDER BY vec_id % 7, vec_id) > 1 THEN printf('_shard%05d_row%06d', vec_id % 7, vec_id) ELSE '' END || '.wav' AS file_name, vec_id::VARCHAR AS text FROM embeddings""",
    "hosted_model": "SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 13 <> 0 THEN upper(trim(left(regexp_replace(text, '[^ -~]', '', 'g'), 20))) END AS out FROM conversations",
    "detail_links": f"""WITH p AS (SELECT page_id AS pos, url, list_transform({_HREFS}, lambda h: regexp_extract(url, '^[a-z]+://[^/]+') || h) AS links FROM pages),
l AS (SELECT pos, url, links, i, links[i] AS link, regexp_matches(links[i], '(?i){PATTERN}') AS hit FROM (SELECT *, unnest(range(1, len(links) + 1)) AS i FROM p)),
d AS (SELECT pos, link, row_number() OVER (PARTITION BY pos ORDER BY i) - 1 AS detail FROM l WHERE NOT hit),
s AS (SELECT page, html FROM (SELECT regexp_extract(url, '^[a-z]+://[^/]+') || {_HREFS}[1] AS page, min(html) AS html FROM pages GROUP BY 1)),
i AS (SELECT page, unnest(range(1, len(h) + 1)) AS i, h FROM (SELECT page, {_HREFS} AS h FROM s)),
f AS (SELECT link AS url, pos, -1 AS detail, i - 1 AS place, url AS page FROM l WHERE hit
      UNION ALL SELECT regexp_extract(page, '^[a-z]+://[^/]+') || h[i], pos, detail, i - 1, page FROM d JOIN i ON page = d.link WHERE detail < 5 AND regexp_matches(regexp_extract(page, '^[a-z]+://[^/]+') || h[i], '(?i){PATTERN}')),
m AS (SELECT url, min(struct_pack(pos := pos, detail := detail, place := place, page := page)) AS m FROM f GROUP BY url)
SELECT url, m.page AS listing_page, m.pos AS pos, m.detail >= 0 AS followed FROM m""",
}
