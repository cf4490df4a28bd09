"""Text expressions: normal forms, words and n-grams, numbers in words, names and links."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What is neither letter, digit, underscore nor white space, in Unicode's sense.
PUNCTUATION = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]"
WHITE_SPACE = r"(?U)[\s\x1c-\x1f]+"

# The words of Vietnamese numbers, the audio extensions and container names, and
# the patterns of links.
DIGIT_WORDS = ("không", "một", "hai", "ba", "bốn", "năm", "sáu", "bảy", "tám", "chín")
UNIT_WORDS = ("", "nghìn", "triệu", "tỷ", "nghìn tỷ", "triệu tỷ")
AUDIO_EXTENSIONS = (".mp3", ".m4a", ".wav", ".flac", ".ogg", ".opus", ".aac", ".wma")
CONTAINERS = {"mp3": ".mp3", "mov": ".m4a", "mp4": ".m4a", "m4a": ".m4a", "ogg": ".ogg", "opus": ".opus", "flac": ".flac", "wav": ".wav", "aac": ".aac", "asf": ".wma"}
AUDIO_LINK = r"\.(mp3|m4a|wav|flac|ogg|opus|aac)(\?|$)"
HREF = r"""(?i)href=["']([^"']+)["']"""
ARCHIVE_URL = r"archive\.org/(?:details|download|metadata)/([^/?#]+)"


@F.pandas_udf(T.StringType())
def _composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def nfc(text: Column) -> Column:
    """Unicode form NFC, which Spark has no function for."""
    return _composed(text)


def without_punctuation(text: Column) -> Column:
    """Punctuation as spaces, runs of white space as one, none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, PUNCTUATION, " "), WHITE_SPACE, " "))


def comparable(text: Column) -> Column:
    """The form in which transcripts are compared: NFC, then lower case, then no punctuation."""
    return without_punctuation(F.lower(nfc(F.coalesce(text, F.lit("")))))


def words(text: Column) -> Column:
    """Words for n-grams, between punctuation and white space: lower case first, then NFC; no empty ones."""
    return F.filter(F.split(nfc(F.lower(F.coalesce(text, F.lit("")))), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def shingles(tokens: Column, n: int) -> Column:
    """All runs of ``n`` tokens in order; none if there are fewer. ``tokens`` must be a column."""
    places = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.array_join(F.slice(tokens, i, n), " "))


def character_error_rate(reference: Column, other: Column) -> Column:
    """Edit distance of the comparable forms over the reference's length."""
    distance = F.levenshtein(reference, other) / F.char_length(reference)
    return F.when((reference == "") & (other == ""), 0.0).when((reference == "") | (other == ""), 1.0).otherwise(distance)


def _said(d: Column) -> Column:
    """A group of three digits (h, t, o) and its unit; ``full`` also says hundreds that are zero."""
    digit = F.array(*[F.lit(w) for w in DIGIT_WORDS])

    def word(k: Column) -> Column:
        return F.element_at(digit, k.cast("int") + 1)

    hundreds = F.when((d.h > 0) | d.full, F.concat(word(d.h), F.lit(" trăm")))
    tens = F.when((d.t == 0) & (d.o > 0) & ((d.h > 0) | d.full), F.lit("lẻ")).when(d.t == 1, F.lit("mười")).when(d.t > 1, F.concat(word(d.t), F.lit(" mươi")))
    ones = F.when((d.o == 5) & (d.t >= 1), F.lit("lăm")).when((d.o == 1) & (d.t > 1), F.lit("mốt")).when(d.o > 0, word(d.o))
    return F.concat_ws(" ", hundreds, tens, ones, F.nullif(d.unit, F.lit("")))


def number_in_words(n: Column) -> Column:
    """A whole number of up to 18 digits in Vietnamese words.

    Groups and digits are variables of nested transforms, so that each is stated once in the plan.
    """
    units = F.array(*[F.struct(F.lit(1000**k).alias("scale"), F.lit(UNIT_WORDS[k]).alias("unit")) for k in range(len(UNIT_WORDS) - 1, -1, -1)])
    upto = F.transform(units, lambda u: F.struct(_div(F.abs(n), u.scale).alias("n"), u.unit.alias("unit")))
    groups = F.transform(upto, lambda u: F.struct((u.n % 1000).alias("g"), (u.n >= 1000).alias("full"), u.unit.alias("unit")))
    digits = F.transform(F.filter(groups, lambda u: u.g > 0), lambda u: F.struct(_div(u.g, F.lit(100)).alias("h"), (_div(u.g, F.lit(10)) % 10).alias("t"), (u.g % 10).alias("o"), u.full.alias("full"), u.unit.alias("unit")))
    spoken = F.array_join(F.transform(digits, _said), " ")
    return F.when(n == 0, F.lit(DIGIT_WORDS[0])).when(n < 0, F.concat(F.lit("âm "), spoken)).otherwise(spoken)


#: The decimal digits of all scripts, ten in a row each, and the ASCII digits they stand for.
DIGITS = tuple("".join(c) for c in zip(*[(chr(c), str(unicodedata.digit(chr(c)))) for c in range(128, 0x1FFFF) if unicodedata.category(chr(c)) == "Nd"], strict=True))


def _div(n: Column, by: Column) -> Column:
    """Whole division."""
    return F.call_function("div", n, by)


def spoken_form(text: Column) -> Column:
    """NFC, numbers (cut every 15 digits of any script) in words, white space collapsed; null is empty."""
    parts = F.regexp_extract_all(nfc(F.coalesce(text, F.lit(""))), F.lit(r"\p{Nd}{1,15}|\P{Nd}+"), F.lit(0))
    numbered = F.transform(parts, lambda p: F.struct(p.alias("part"), F.when(p.rlike(r"^\p{Nd}"), F.translate(p, *DIGITS).try_cast("bigint")).alias("n")))
    said = F.transform(numbered, lambda p: F.when(p.n.isNull(), p.part).otherwise(number_in_words(p.n)))
    return F.trim(F.regexp_replace(F.array_join(said, ""), WHITE_SPACE, " "))


#: Ways to bring a text into its spoken form. A package for it registers its own column function.
NORMALISERS: dict[str, Callable[[Column], Column]] = {"basic": spoken_form}


def normaliser(wanted: str = "auto") -> tuple[Callable[[Column], Column], str]:
    """The way of that name and its name; ``auto`` takes a registered one before the basic one."""
    name = next((n for n in NORMALISERS if n != "basic"), "basic") if wanted == "auto" else wanted
    if name not in NORMALISERS:
        raise KeyError(f"no text normaliser {name!r}; known: {', '.join(sorted(NORMALISERS))}")
    return NORMALISERS[name], name


def safe_filename(name: Column, max_len: int = 120) -> Column:
    """Unsafe characters as underscores, none at the ends, cut, never empty."""
    clean = F.btrim(F.regexp_replace(name, r"[^\p{L}\p{N}_\-.]+", "_"), F.lit("_."))
    return F.coalesce(F.nullif(F.left(clean, F.lit(max_len)), F.lit("")), F.lit("untitled"))


def feed_slug(url: Column) -> Column:
    """Host and path of a feed as a name of up to 80 characters."""
    path = F.rtrim(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/"))
    return safe_filename(F.concat(F.coalesce(F.parse_url(url, F.lit("AUTHORITY")), F.lit("")), path), 80)


def extension_of(url: Column, default: str = ".mp3") -> Column:
    """The audio extension of a URL's path in lower case, or the default."""
    found = F.lower(F.regexp_extract(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), r"(\.[^./]+)$", 1))
    return F.when(found.isin(*AUDIO_EXTENSIONS), found).otherwise(F.lit(default))


def extension_of_container(names: Column) -> Column:
    """The extension of the first known name in a comma-separated list, or that of MP3."""
    table = F.create_map(*[F.lit(x) for pair in CONTAINERS.items() for x in pair])
    known = F.filter(F.transform(F.split(names, ","), lambda n: table[F.trim(n)]), lambda e: e.isNotNull())
    return F.coalesce(F.get(known, F.lit(0)), F.lit(".mp3"))


def source_path(path: Column) -> Column:
    """``source__feed__name`` as ``feed/name``; paths with a slash stay as they are."""
    parts = F.split(path, "__")
    flat = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "/")
    return F.when(F.contains(path, F.lit("/")) | ~F.contains(path, F.lit("__")), path).otherwise(flat)


def relocated(path: Column, old: str, new: str) -> Column:
    """``path`` under ``new`` if it lies under ``old``, whole segments only."""
    old, new = old.rstrip("/") + "/", new.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(old)), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 30))).otherwise(path)


def archive_identifier(item: Column) -> Column:
    """The identifier in an archive's URL, or the text itself without outer slashes."""
    found = F.regexp_extract(item, ARCHIVE_URL, 1)
    return F.when(found != "", found).otherwise(F.btrim(F.trim(item), F.lit("/")))


def hrefs(html: Column) -> Column:
    """The targets of all links in order."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(HREF), F.lit(1))


@F.pandas_udf(T.StringType())
def _resolved(base: pd.Series, link: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else urljoin(b or "", x) for b, x in zip(base, link, strict=True)])


def resolved(base: Column, link: Column) -> Column:
    """A link as an absolute URL."""
    return _resolved(base, link)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _all_resolved(base: pd.Series, links: pd.Series) -> pd.Series:
    return pd.Series([[urljoin(b or "", x) for x in found] for b, found in zip(base, links, strict=True)])


def all_resolved(base: Column, links: Column) -> Column:
    """A page's links as absolute URLs, in order."""
    return _all_resolved(base, links)


def is_audio_link(url: Column, pattern: str = AUDIO_LINK) -> Column:
    """Whether the pattern occurs in the URL, whatever the case."""
    return url.rlike(f"(?i){pattern}")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The base name without its last extension; a leading dot is part of the name."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")
