"""Queries on texts, names and links, and the n-gram overlap of two corpora."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import ids
from ..functions import text as tx
from ..operators import overlap

GRAM, MIN_WORDS, MIN_FRACTION = 8, 12, 0.6


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def safe_names(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", tx.safe_filename(F.col("text")).alias("name"))


def url_parts(spark, sf_dir):
    u = F.col("url")
    return _read(spark, sf_dir, "pages").select("page_id", ids.key_id(u).alias("id"), tx.feed_slug(u).alias("slug"), tx.extension_of(u).alias("ext"), tx.archive_identifier(u).alias("identifier"))


def page_expand(spark, sf_dir):
    """A page template with {page} for each of its pages, the number taken from the site."""
    pages = _read(spark, sf_dir, "pages").withColumn("page", F.explode(F.sequence(F.lit(1), (F.col("page_id") % 4 + 1).cast("int"))))
    return pages.select("page_id", "page", F.replace(F.concat(F.lit("http://host/list-{page}?from="), F.col("page_id").cast("string")), F.lit("{page}"), F.col("page").cast("string")).alias("url"))


def href_extract(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", F.posexplode(tx.hrefs(F.col("html"))).alias("pos", "href"))


def page_links(spark, sf_dir):
    """Absolute links that look like numbered pages, each once, where it was first seen."""
    found = _read(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(tx.hrefs(F.col("html"))).alias("pos", "href")).filter(tx.is_audio_link(F.col("href"), r"^/[a-z]"))
    return found.groupBy("href").agg(F.min(F.struct("page_id", "pos")).alias("at"), F.count("*").alias("n")).select("href", F.col("at.page_id").alias("page_id"), F.col("at.pos").alias("pos"), "n")


def source_paths(spark, sf_dir):
    path = F.concat_ws("__", "lang", "source", F.col("doc_id").cast("string"))
    flat = F.when(F.col("doc_id") % 5 == 0, F.concat_ws("/", "lang", "source")).otherwise(path)
    return _read(spark, sf_dir, "documents").select("doc_id", tx.source_path(flat).alias("source_path"), tx.relocated(F.concat(F.lit("/"), F.replace(flat, F.lit("__"), F.lit("/"))), "/en", "/data/en").alias("moved"), tx.stem(F.concat(flat, F.lit(".tar.gz"))).alias("stem"))


def durations(spark, sf_dir):
    """Feed durations in seconds: hours and minutes, minutes only, plain, or no number."""
    h, m = (F.col("event_id") % 7).cast("string"), (F.col("event_id") % 60).cast("string")
    s = F.format_string("%02d", F.col("event_id") % 60)
    made = F.when(F.col("event_id") % 4 == 0, F.concat_ws(":", h, m, s)).when(F.col("event_id") % 4 == 1, F.concat_ws(":", m, s)).when(F.col("event_id") % 4 == 2, F.col("value").cast("int").cast("string")).otherwise(F.col("event_type"))
    return _read(spark, sf_dir, "events").select("event_id", ids.seconds_of(made).alias("seconds"))


def numbers_in_words(spark, sf_dir):
    found = _read(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[0-9]{1,15}"), F.lit(0))).alias("n")).distinct()
    lines = _read(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * F.col("l_partkey")).cast("string").alias("n")).distinct()
    n = F.col("n").cast("bigint")
    return found.union(lines).distinct().select("n", tx.number_in_words(n).alias("words"))


def spoken_texts(spark, sf_dir):
    # the fence is not deterministic, so the form is not made again for each of its uses
    said = _read(spark, sf_dir, "documents").select("doc_id", tx.spoken_form(F.col("text")).alias("said"), F.monotonically_increasing_id().alias("fence"))
    return said.filter("fence >= 0").select("doc_id", F.sha1("said").alias("sha1"), F.length("said").alias("n_chars"))


def normalised_turns(spark, sf_dir):
    """Turns in spoken form by the way that is there, with its name."""
    run, name = tx.normaliser("auto")
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", run(F.col("text")).alias("text_norm"), F.lit(name).alias("backend"))


def cer_pairs(spark, sf_dir):
    """The character error rate of each turn against the one before it."""
    talk = _read(spark, sf_dir, "conversations").withColumn("c", tx.comparable(F.col("text")))
    before = F.lag("c").over(Window.partitionBy("conv_id").orderBy("turn"))
    pairs = talk.withColumn("b", before).filter("b is not null")
    return pairs.select("conv_id", "turn", F.round(tx.character_error_rate(F.col("b"), F.col("c")), 4).alias("cer"))


def _overlap(spark, sf_dir):
    docs, probes = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    ours = overlap.tokenised(docs.filter("text is not null"), F.col("doc_id"), F.col("text"))
    theirs = overlap.tokenised(probes, F.col("item_id"), F.col("text"))
    grams = overlap.probe_grams(theirs, GRAM, MIN_WORDS)
    return theirs, overlap.index(ours, GRAM, grams), grams


def ngram_overlap(spark, sf_dir):
    _, index, grams = _overlap(spark, sf_dir)
    return overlap.fractions(grams, index).select(F.col("key").alias("item_id"), "n_grams", "n_found", F.round("frac", 2).alias("frac"))


def overlap_hits(spark, sf_dir):
    _, index, grams = _overlap(spark, sf_dir)
    hits = overlap.fractions(grams, index).filter(F.col("frac") >= MIN_FRACTION)
    return overlap.best_matches(hits, grams, index).select(F.col("key").alias("item_id"), F.col("ours").alias("doc_id"), "common", "place")


def overlap_summary(spark, sf_dir):
    """Utterances, hits and their ratio by the first letter of the text, the keys of a report."""
    theirs, index, grams = _overlap(spark, sf_dir)
    hits = overlap.fractions(grams, index).filter(F.col("frac") >= MIN_FRACTION).select("key", F.lit(1).alias("hit"))
    rows = theirs.join(hits, "key", "left").groupBy(F.substring("text", 1, 1).alias("letter")).agg(F.count("*").alias("utterances"), F.sum(F.coalesce("hit", F.lit(0))).cast("long").alias("hits"))
    return rows.withColumn("hit_ratio", F.round(F.col("hits") / F.col("utterances"), 5)).orderBy(F.desc("hits"), "letter").limit(15)


def overlap_examples(spark, sf_dir):
    """The ten hits with the largest rounded fraction, with the start of both texts."""
    theirs, index, grams = _overlap(spark, sf_dir)
    hits = overlap.fractions(grams, index).filter(F.col("frac") >= MIN_FRACTION).withColumn("frac", F.round("frac", 2))
    top = hits.orderBy(F.desc("frac"), "key").limit(10)
    best = overlap.best_matches(top, grams, index, 1)
    ours = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("ours"), F.left("text", F.lit(120)).alias("our_text"))
    return top.join(best, "key").join(ours, "ours").join(theirs.select("key", F.left("text", F.lit(120)).alias("their_text")), "key").select(F.col("key").alias("item_id"), "frac", "their_text", "our_text")


def overlap_files(spark, sf_dir):
    """The fifteen sources of ours that are the best match of most hits."""
    _, index, grams = _overlap(spark, sf_dir)
    hits = overlap.fractions(grams, index).filter(F.col("frac") >= MIN_FRACTION)
    best = overlap.best_matches(hits, grams, index, 1).select(F.col("ours").alias("doc_id"))
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source")
    return best.join(docs, "doc_id").groupBy("source").agg(F.count("*").alias("hits")).orderBy(F.desc("hits"), "source").limit(15)


QUERIES = {f.__name__: f for f in (safe_names, url_parts, page_expand, href_extract, page_links, source_paths, durations, numbers_in_words, spoken_texts, normalised_turns, cer_pairs, ngram_overlap, overlap_hits, overlap_summary, overlap_examples, overlap_files)}


def _said_sql(n: str) -> str:
    """The words of a number, as SQL."""
    d = "['không', 'một', 'hai', 'ba', 'bốn', 'năm', 'sáu', 'bảy', 'tám', 'chín']"
    parts = []
    for k, unit in reversed(list(enumerate(tx.UNIT_WORDS))):
        g, full = f"(({n} // {1000**k}) % 1000)", f"({n} // {1000 ** (k + 1)} > 0)" if k < 5 else "false"
        h, t, o = f"({g} // 100)", f"({g} // 10 % 10)", f"({g} % 10)"
        hundred = f"CASE WHEN {h} > 0 OR {full} THEN {d}[{h} + 1] || ' trăm' END"
        ten = f"CASE WHEN {t} = 0 AND {o} > 0 AND ({h} > 0 OR {full}) THEN 'lẻ' WHEN {t} = 1 THEN 'mười' WHEN {t} > 1 THEN {d}[{t} + 1] || ' mươi' END"
        one = f"CASE WHEN {o} = 5 AND {t} >= 1 THEN 'lăm' WHEN {o} = 1 AND {t} > 1 THEN 'mốt' WHEN {o} > 0 THEN {d}[{o} + 1] END"
        parts.append(f"CASE WHEN {g} > 0 THEN concat_ws(' ', {hundred}, {ten}, {one}, {repr(unit) if unit else 'NULL'}) END")
    return f"CASE WHEN {n} = 0 THEN 'không' ELSE concat_ws(' ', {', '.join(parts)}) END"


_SPOKEN = f"""trim(regexp_replace(array_to_string(list_transform(regexp_extract_all(nfc_normalize(coalesce(text, '')), '\\p{{Nd}}{{1,15}}|\\P{{Nd}}+'),
lambda p: CASE WHEN regexp_matches(p, '^[0-9]') THEN {_said_sql("try_cast(p AS BIGINT)")} ELSE p END), ''), '\\s+', ' ', 'g'))"""
_WORDS = r"list_filter(string_split(regexp_replace(nfc_normalize(lower(coalesce(text, ''))), '[^\p{L}\p{N}_]+', ' ', 'g'), ' '), lambda x: x <> '')"
_OVERLAP = f"""
o AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
oi AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM o)),
t AS (SELECT item_id, text, {_WORDS} AS w FROM benchmark),
tg AS (SELECT item_id, array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT item_id, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 12)),
f AS (SELECT item_id, count(*) AS n_grams, count(k.gram) AS n_found, count(k.gram) / count(*)::DOUBLE AS frac FROM tg LEFT JOIN (SELECT DISTINCT gram FROM oi) k USING (gram) GROUP BY item_id),
m AS (SELECT item_id, doc_id, count(*) AS common FROM tg JOIN oi USING (gram) WHERE item_id IN (SELECT item_id FROM f WHERE frac >= 0.6e0) GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY common DESC, doc_id) AS place FROM m)
"""
_FLAT = "CASE WHEN doc_id % 5 = 0 THEN concat_ws('/', lang, source) ELSE concat_ws('__', lang, source, doc_id::VARCHAR) END"
SQL = {
    "safe_names": r"SELECT doc_id, coalesce(nullif(left(trim(regexp_replace(text, '[^\p{L}\p{N}_\-.]+', '_', 'g'), '_.'), 120), ''), 'untitled') AS name FROM documents",
    "url_parts": r"""WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, substr(sha1(url), 1, 16) AS id, coalesce(nullif(left(trim(regexp_replace(host || rtrim(path, '/'), '[^\p{L}\p{N}_\-.]+', '_', 'g'), '_.'), 80), ''), 'untitled') AS slug,
CASE WHEN lower(regexp_extract(path, '(\.[^./]+)$', 1)) IN ('.mp3', '.m4a', '.wav', '.flac', '.ogg', '.opus', '.aac', '.wma') THEN lower(regexp_extract(path, '(\.[^./]+)$', 1)) ELSE '.mp3' END AS ext,
CASE WHEN regexp_matches(url, 'archive\.org/(?:details|download|metadata)/([^/?#]+)') THEN regexp_extract(url, 'archive\.org/(?:details|download|metadata)/([^/?#]+)', 1) ELSE trim(trim(url), '/') END AS identifier FROM p""",
    "page_expand": "SELECT page_id, page::INT AS page, 'http://host/list-' || page || '?from=' || page_id AS url FROM (SELECT page_id, unnest(range(1, page_id % 4 + 2)) AS page FROM pages)",
    "href_extract": r"""SELECT page_id, (k - 1)::INT AS pos, l[k] AS href FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS k FROM (SELECT page_id, regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1) AS l FROM pages))""",
    "page_links": r"""WITH h AS (SELECT page_id, (k - 1)::INT AS pos, l[k] AS href FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS k FROM (SELECT page_id, regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1) AS l FROM pages)))
SELECT href, min({'p': page_id, 'o': pos}).p AS page_id, min({'p': page_id, 'o': pos}).o AS pos, count(*) AS n FROM h WHERE regexp_matches(href, '(?i)^/[a-z]') GROUP BY href""",
    "source_paths": f"""WITH d AS (SELECT doc_id, {_FLAT} AS p FROM documents)
SELECT doc_id, CASE WHEN contains(p, '/') THEN p ELSE array_to_string(string_split(p, '__')[2:], '/') END AS source_path,
CASE WHEN starts_with('/' || replace(p, '__', '/'), '/en/') THEN '/data' || '/' || replace(p, '__', '/') ELSE '/' || replace(p, '__', '/') END AS moved,
string_split(p, '/')[-1] || '.tar' AS stem FROM d""",
    "durations": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id % 7 * 3600e0 + event_id % 60 * 60 + event_id % 60 WHEN 1 THEN event_id % 60 * 60e0 + event_id % 60 WHEN 2 THEN trunc(value) END::DOUBLE AS seconds FROM events",
    "numbers_in_words": f"WITH n AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[0-9]{{1,15}}')) AS n FROM documents UNION SELECT DISTINCT (l_orderkey * l_partkey)::VARCHAR FROM lineitem) SELECT n, {_said_sql('n::BIGINT')} AS words FROM n",
    "normalised_turns": f"SELECT conv_id, turn, {_SPOKEN} AS text_norm, 'basic' AS backend FROM conversations",
    "spoken_texts": f"""WITH s AS (SELECT doc_id, {_SPOKEN} AS s FROM documents) SELECT doc_id, sha1(s) AS sha1, length(s)::INT AS n_chars FROM s""",
    "ngram_overlap": f"WITH {_OVERLAP} SELECT item_id, n_grams, n_found, round(frac, 2) AS frac FROM f",
    "overlap_hits": f"WITH {_OVERLAP} SELECT item_id, doc_id, common, place::INT AS place FROM b WHERE place <= 3",
    "overlap_summary": f"WITH {_OVERLAP} SELECT text[1] AS letter, count(*) AS utterances, count(h.item_id) AS hits, round(count(h.item_id) / count(*)::DOUBLE, 5) AS hit_ratio FROM t LEFT JOIN (SELECT item_id FROM f WHERE frac >= 0.6e0) h USING (item_id) GROUP BY 1 ORDER BY hits DESC, letter LIMIT 15",
    "overlap_files": f"WITH {_OVERLAP} SELECT source, count(*) AS hits FROM b JOIN documents USING (doc_id) WHERE place = 1 GROUP BY source ORDER BY hits DESC, source LIMIT 15",
    "overlap_examples": f"WITH {_OVERLAP}, top AS (SELECT item_id, round(frac, 2) AS frac FROM f WHERE frac >= 0.6e0 ORDER BY round(frac, 2) DESC, item_id LIMIT 10) SELECT item_id, frac, left(t.text, 120) AS their_text, left(d.text, 120) AS our_text FROM top JOIN b USING (item_id) JOIN documents d USING (doc_id) JOIN t USING (item_id) WHERE place = 1",
}
