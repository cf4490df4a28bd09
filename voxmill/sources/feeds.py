"""Episodes and items from stored feed, archive and page payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as tx

ITEM = "title string, pubDate string, description string, enclosure struct<_url: string>, `itunes:duration` string"
ARCHIVE = "metadata struct<title: string>, files array<struct<name: string, source: string, length: string, title: string>>"


def episodes(feeds: DataFrame, max_items: int | None = None) -> DataFrame:
    """feed, pos, title, audio_url, pub_date, description, duration of RSS text in ``xml``.

    Items without an enclosure are left out, and each feed gives its first ``max_items``.
    """
    items = F.regexp_extract_all("xml", F.lit(r"(?s)<item\b.*?</item>"), F.lit(0))
    rows = feeds.select("feed", F.posexplode(items).alias("pos", "item")).withColumn("i", F.from_xml("item", ITEM))
    rows = rows.filter(F.col("i.enclosure._url") != "")
    rows = rows.select("feed", "pos", F.trim("i.title").alias("title"), F.trim("i.enclosure._url").alias("audio_url"), F.trim("i.pubDate").alias("pub_date"), F.left(F.trim("i.description"), F.lit(500)).alias("description"), ids.seconds_of(F.col("i.`itunes:duration`")).alias("duration"))
    if max_items is None:
        return rows
    from ..operators.incremental import first_n

    return first_n(rows, "feed", ["pos"], max_items)


def archive_files(items: DataFrame) -> DataFrame:
    """key, identifier, name, title, duration of the original audio files in ``payload``."""
    rows = items.select("identifier", F.explode(F.from_json("payload", ARCHIVE)["files"]).alias("f"))
    ext = F.lower(F.regexp_extract("f.name", r"(\.[^./]+)$", 1))
    kept = rows.filter((F.col("f.source") == "original") & ext.isin(*tx.AUDIO_EXTENSIONS))
    key = F.concat(F.lit("archive.org/"), F.col("identifier"), F.lit("/"), F.col("f.name"))
    return kept.select(key.alias("key"), "identifier", F.col("f.name").alias("name"), F.coalesce("f.title", "f.name").alias("title"), F.col("f.length").try_cast("double").alias("duration"))


def page_audio(pages: DataFrame, pattern: str = tx.AUDIO_LINK) -> DataFrame:
    """url, page_url, pos: audio links of HTML pages (url, html), absolute, each once, first seen first."""
    rows = pages.select("url", F.posexplode(tx.hrefs(F.col("html"))).alias("pos", "href"))
    links = rows.withColumn("link", tx.resolved(F.col("url"), F.col("href"))).filter(tx.is_audio_link(F.col("link"), pattern))
    return links.groupBy("link").agg(F.min(F.struct("url", "pos")).alias("at")).select(F.col("link").alias("url"), F.col("at.url").alias("page_url"), F.col("at.pos").alias("pos"))


def followed_audio(listing: DataFrame, stored: DataFrame, pattern: str = tx.AUDIO_LINK, limit: int = 30) -> DataFrame:
    """url, listing_page, title: audio links of listing pages and of the detail pages they lead to.

    ``listing``: pos, url, html; pages are taken in the order of ``pos``. A page's own audio links come
    first, then those of its detail pages: its first ``limit`` links to http pages that are no audio,
    as often as they stand there. ``stored``: url, html of the pages that can be had; links to others
    are passed over. A link belongs to the page where it was first met.
    """
    http = F.filter("links", lambda u: F.startswith(u, F.lit("http")) & ~tx.is_audio_link(u, pattern))
    own = F.filter(F.transform("links", lambda u, i: F.struct(i.alias("at"), u.alias("url"))), lambda x: tx.is_audio_link(x["url"], pattern))
    pages = _linked(listing.select("pos", "url", "html"))
    first = pages.select("pos", F.col("url").alias("page"), F.explode(own).alias("l")).select(F.struct("pos", F.lit(-1).alias("detail"), F.col("l.at").alias("at")).alias("place"), F.col("l.url").alias("url"), "page")
    details = pages.select("pos", F.posexplode(F.slice(http, 1, limit)).alias("detail", "url"))
    wanted = details.select("url").distinct()
    known = _linked(stored.join(wanted, "url", "left_semi").groupBy("url").agg(F.min("html").alias("html")))
    inside = known.select(F.col("url").alias("page"), own.alias("found")).filter(F.size("found") > 0)
    met = details.withColumnRenamed("url", "page").groupBy("page").agg(F.min(F.struct("pos", "detail")).alias("p")).join(inside, "page")
    second = met.select("page", "p", F.explode("found").alias("l")).select(F.struct(F.col("p.pos").alias("pos"), F.col("p.detail").alias("detail"), F.col("l.at").alias("at")).alias("place"), F.col("l.url").alias("url"), "page")
    found = first.unionByName(second).groupBy("url").agg(F.min(F.struct("place", "page")).alias("m"))
    return found.select("url", F.col("m.page").alias("listing_page"), tx.basename(F.col("url")).alias("title"), F.col("m.place").alias("place"))


def _linked(pages: DataFrame) -> DataFrame:
    """``pages`` with their links, absolute and in order, instead of the HTML."""
    return pages.withColumn("links", tx.all_resolved(F.col("url"), tx.hrefs(F.col("html")))).drop("html")


def needs_probe(duration, max_seconds: float):
    """Whether a length must be asked for: unknown, or above the limit."""
    return duration.isNull() | (duration > max_seconds)


def trimmed(items: DataFrame, max_seconds: float) -> DataFrame:
    """``items`` with the cut of recordings that are too long; an unknown length is too long."""
    seconds = F.coalesce("duration", F.lit(float("inf")))
    long = seconds > max_seconds
    known = F.col("duration").isNotNull() & (F.col("duration") < float("inf"))
    return items.withColumns({"truncated_to_seconds": F.when(long, F.lit(int(max_seconds))), "duration_original": F.when(long & known, F.round("duration", 1))})
