"""Identity: content and key hashes, ids of segments, and hashes as uniform numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(content: Column) -> Column:
    """The first 12 hex digits of the content's SHA-1."""
    return F.substring(F.sha1(content), 1, 12)


def key_id(key: Column) -> Column:
    """The first 16 hex digits of the key's SHA-1."""
    return F.substring(F.sha1(key), 1, 16)


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 64 bits of the SHA-1 of ``seed:key``."""
    digest = F.sha1(F.concat(F.lit(f"{seed}:"), key))
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("double") / F.lit(2.0**64)


def segment_id(file_id: Column, start: Column, end: Column) -> Column:
    """``file_start_end`` with eight-digit whole milliseconds, cut and not rounded."""
    return F.format_string("%s_%08d_%08d", file_id, (start * 1000).cast("long"), (end * 1000).cast("long"))


def seconds_of(duration: Column) -> Column:
    """Seconds of ``h:m:s``, ``m:s`` or ``s``, each part with decimals; null if a part is none."""
    parts = F.reverse(F.transform(F.split(duration, ":"), lambda p: F.trim(p).try_cast("double")))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("unit"))
    return F.aggregate(parts, start, lambda a, p: F.struct((a["sum"] + p * a["unit"]).alias("sum"), (a["unit"] * 60).alias("unit")), lambda a: a["sum"])
