"""Queries on records: dedup, pending work, completeness, reports on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as tx
from ..operators import cleanup
from ..operators import incremental as inc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _deduped(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    return inc.first_by(docs, F.sha1(F.coalesce("text", F.lit(""))), ["doc_id"])


def content_dedup(spark, sf_dir):
    return _deduped(spark, sf_dir).filter("is_first").select("doc_id", F.substring("key", 1, 12).alias("id"), "key")


def dedup_rejects(spark, sf_dir):
    return _deduped(spark, sf_dir).filter("not is_first").select("doc_id", F.lit("dup").alias("reason"))


def pending_anti(spark, sf_dir):
    return inc.pending(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


def file_semi(spark, sf_dir):
    """All lines of orders that still have a line without a return flag of its own."""
    lines = _read(spark, sf_dir, "lineitem").withColumn("id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    done = lines.filter("l_linestatus = 'F'").select("id")
    return inc.of_pending_files(lines, done, "id", "l_orderkey").select("l_orderkey", "l_linenumber")


def ledger_anti(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", ids.key_id(F.col("url")).alias("id"))
    ledger = pages.filter(F.col("url").startswith("https://")).select("id")
    return inc.pending(pages, ledger).select("page_id", "id")


def sidecar_left(spark, sf_dir):
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select("doc_id", "quality", "toxic")


def file_completeness(spark, sf_dir):
    """Orders with all their lines; an order expects what its last line in order says."""
    lines = _read(spark, sf_dir, "lineitem").filter("l_quantity > 5")
    wanted = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").cast("int").alias("n_segments"))
    rows = lines.join(wanted, "l_orderkey").select(F.col("l_orderkey").alias("file_id"), F.col("l_linenumber").alias("seg_index"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"), "n_segments")
    return inc.complete_files(rows)


def done_by_file(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    label = F.when(F.col("event_id") % 4 != 0, F.concat(F.col("user_id").cast("string"), F.lit("_spk"), (F.col("event_id") % 7).cast("string"))).otherwise(F.lit("off"))
    return inc.done_by_file(e.select(F.col("user_id").alias("file_id"), label.alias("speaker_id")))


def seen_union(spark, sf_dir):
    """Ids that were taken or rejected before: manifest and skip log together."""
    return _deduped(spark, sf_dir).filter("is_first").select("doc_id").union(_read(spark, sf_dir, "labels").select("doc_id")).distinct()


def stale_difference(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("source").distinct().exceptAll(_read(spark, sf_dir, "documents").filter("lang = 'en' and n_chars > 20000").select("source").distinct())


def distinct_targets(spark, sf_dir):
    """Target lists one after the other, each target once, in the order of first sight."""
    docs = _read(spark, sf_dir, "documents")
    both = docs.select(F.col("source").alias("target"), F.col("doc_id").alias("position")).unionByName(docs.select(F.col("lang").alias("target"), (F.col("doc_id") + 1_000_000_000).alias("position")))
    return inc.unique_in_order(both, "target", "position")


def first_per_source(spark, sf_dir):
    return inc.first_n(_read(spark, sf_dir, "documents"), "source", ["doc_id"], 3).select("source", "doc_id")


def upload_order(spark, sf_dir):
    """Shards already committed first, then by name; the first hundred go out."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source")
    done = _read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct().withColumn("up", F.lit(True))
    rows = docs.join(done, "doc_id", "left").select("doc_id", "source", F.coalesce("up", F.lit(False)).alias("uploaded"))
    return rows.orderBy(~F.col("uploaded"), "source", "doc_id").limit(100)


def stage_counts(spark, sf_dir):
    parts = [_read(spark, sf_dir, t).agg(F.lit(t).alias("stage"), F.count("*").alias("n")) for t in TABLES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def bytes_by_category(spark, sf_dir):
    """What a cleanup would free: bytes of documents by category, each by its own semi join."""
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    size = F.octet_length(F.coalesce("text", F.lit(""))).alias("bytes")
    raw = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").select(F.lit("raw").alias("category"), size)
    toxic = docs.join(labels.filter("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi").select(F.lit("tier_c").alias("category"), size)
    copies = _deduped(spark, sf_dir).filter("not is_first").select(F.lit("s2").alias("category"), size)
    return raw.unionByName(toxic).unionByName(copies).groupBy("category").agg(F.sum("bytes").cast("long").alias("bytes"), F.count("*").alias("files"))


def finalise_ledger(spark, sf_dir):
    """Documents with a label that no toxic label took before: media there, not in the ledger."""
    docs, labels = _read(spark, sf_dir, "documents").select("doc_id", "source"), _read(spark, sf_dir, "labels")
    return inc.finalised(docs, labels, labels.filter("toxic = 1"), "doc_id").select("doc_id", "source")


def rejected_media(spark, sf_dir):
    """Media of documents of low quality, inside the folder of one language."""
    docs, labels = _read(spark, sf_dir, "documents").select("doc_id", "lang"), _read(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id").withColumn("tier", F.when(F.col("quality") == 0, "C").otherwise("A"))
    return cleanup.rejected_files(rows.withColumn("audio_path", F.concat(F.lit("/data/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".wav"))), "/data/en")


def batch_cleanup(spark, sf_dir):
    """What a batch of documents leaves behind: its page downloads, its wavs and its segments."""
    docs, lines = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "lineitem")
    ingested = docs.select(F.col("doc_id").alias("id"), F.concat(F.lit("/in/"), "source", F.lit("-"), F.col("doc_id").cast("string")).alias("source_path"))
    staged = docs.filter("lang = 'en'").select(F.concat("source", F.lit("-"), F.col("doc_id").cast("string")).alias("name"))
    segments = lines.select(F.col("l_orderkey").alias("file_id"), F.concat_ws("_", F.lit("/w/s2_segment/audio/"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("path"))
    raw = _read(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return cleanup.batch_files(ingested, staged, raw, segments, "/w").groupBy("category").agg(F.count("*").alias("n"), F.countDistinct("path").alias("paths"))


def verified_texts(spark, sf_dir):
    """Turns with the next turn as their second transcript: which have one, and which agree."""
    talk = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    first = talk.select(F.concat_ws("/", "conv_id", "turn").alias("id"), "text")
    second = talk.select(F.concat_ws("/", "conv_id", F.col("turn") - 1).alias("id"), "text")
    met = inc.verified(first, second, lambda a, b: tx.character_error_rate(tx.comparable(a), tx.comparable(b)))
    return met.select("id", F.col("text_verify").isNotNull().alias("has_verify"), (F.coalesce("cer", F.lit(1.0)) == 0).alias("agrees"))


QUERIES = {f.__name__: f for f in (content_dedup, dedup_rejects, pending_anti, file_semi, ledger_anti, sidecar_left, file_completeness, done_by_file, seen_union, stale_difference, distinct_targets, first_per_source, upload_order, stage_counts, bytes_by_category, finalise_ledger, rejected_media, batch_cleanup, verified_texts)}
_RANKED = "r AS (SELECT *, sha1(coalesce(text, '')) AS key, row_number() OVER (PARTITION BY sha1(coalesce(text, '')) ORDER BY doc_id) AS k FROM documents)"
_COMPARABLE = r"trim(regexp_replace(regexp_replace(lower(nfc_normalize(coalesce(text, ''))), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
SQL = {
    "content_dedup": f"WITH {_RANKED} SELECT doc_id, substr(key, 1, 12) AS id, key FROM r WHERE k = 1",
    "dedup_rejects": f"WITH {_RANKED} SELECT doc_id, 'dup' AS reason FROM r WHERE k > 1",
    "pending_anti": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "file_semi": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_linestatus = 'F' AND b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber))",
    "ledger_anti": "SELECT page_id, substr(sha1(url), 1, 16) AS id FROM pages WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = pages.url AND starts_with(p.url, 'https://'))",
    "sidecar_left": "SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)",
    "file_completeness": "WITH w AS (SELECT l_orderkey, count(*)::INT AS e FROM lineitem GROUP BY 1) SELECT l_orderkey AS file_id, count(*) AS n, max(e) AS expected FROM lineitem JOIN w USING (l_orderkey) WHERE l_quantity > 5 GROUP BY 1 HAVING count(*) >= max(e)",
    "done_by_file": "SELECT user_id AS file_id, count(*) AS n_done, coalesce(max(CASE WHEN event_id % 4 <> 0 THEN (event_id % 7)::INT END), -1) AS max_label FROM events GROUP BY user_id",
    "seen_union": f"WITH {_RANKED} SELECT doc_id FROM r WHERE k = 1 UNION SELECT doc_id FROM labels",
    "stale_difference": "SELECT DISTINCT source FROM documents EXCEPT SELECT source FROM documents WHERE lang = 'en' AND n_chars > 20000",
    "distinct_targets": "SELECT target, min(position) AS position FROM (SELECT source AS target, doc_id AS position FROM documents UNION ALL SELECT lang, doc_id + 1000000000 FROM documents) WHERE target IS NOT NULL GROUP BY target",
    "first_per_source": "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3",
    "upload_order": "WITH u AS (SELECT doc_id, source, l.up IS NOT NULL AS uploaded FROM documents LEFT JOIN (SELECT DISTINCT doc_id, true AS up FROM labels WHERE quality = 1) l USING (doc_id)) SELECT doc_id, source, uploaded FROM u ORDER BY NOT uploaded, source, doc_id LIMIT 100",
    "stage_counts": " UNION ALL ".join(f"SELECT '{t}' AS stage, count(*) AS n FROM {t}" for t in TABLES),
    "finalise_ledger": "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "rejected_media": "SELECT 'tier_c' AS category, '/data/en/' || doc_id || '.wav' AS path FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' AND quality = 0",
    "batch_cleanup": "WITH e AS (SELECT doc_id FROM documents WHERE lang = 'en'), a AS (SELECT 'raw' AS category, url AS path FROM pages UNION ALL SELECT 'work', s || doc_id FROM e, (SELECT unnest(['s0/', 's1/']) AS s) UNION ALL SELECT 'work', l_orderkey || '_' || l_linenumber FROM lineitem WHERE l_orderkey IN (FROM e)) SELECT category, count(*) AS n, count(DISTINCT path) AS paths FROM a GROUP BY category",
    "verified_texts": rf"WITH t AS (SELECT conv_id, turn, text, {_COMPARABLE} AS c FROM conversations) SELECT a.conv_id || '/' || a.turn AS id, b.text IS NOT NULL AS has_verify, coalesce(b.text IS NOT NULL AND a.c = b.c, false) AS agrees FROM t a LEFT JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1",
    "bytes_by_category": f"WITH {_RANKED}, l AS (SELECT DISTINCT doc_id FROM labels), x AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1), a AS (SELECT 'raw' AS category, text FROM documents WHERE doc_id IN (FROM l) UNION ALL SELECT 'tier_c', text FROM documents WHERE doc_id IN (FROM x) UNION ALL SELECT 's2', text FROM r WHERE k > 1) SELECT category, sum(strlen(coalesce(text, '')))::BIGINT AS bytes, count(*) AS files FROM a GROUP BY category",
}
