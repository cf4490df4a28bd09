"""A Spark data source that reads feeds, one partition each, and a table of source types."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEADERS_ONLY = re.compile(r"^\s*$|^\s*#")


def read_targets(text: str) -> list[str]:
    """Targets in a list file: one a line, blank lines and comments left out."""
    return [line.split(" #")[0].strip() for line in text.splitlines() if not HEADERS_ONLY.match(line)]


def resolve_targets(url: str | None, urls: list[str] | None, listed: str | None) -> list[str]:
    """A single target, a list and a list file together, each once and in order."""
    found = list(dict.fromkeys([*([url] if url else []), *(urls or []), *(read_targets(listed) if listed else [])]))
    if not found:
        raise ValueError("no targets")
    return found


class Feed(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class FeedReader(DataSourceReader):
    """Reads stored payloads; a feed that can't be read is skipped, as others go on."""

    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[Feed]:
        return [Feed(p) for p in self.paths]

    def read(self, partition: Feed):
        path = Path(partition.path)
        if path.is_file():
            yield partition.path, path.read_text(encoding="utf-8", errors="replace")


class FeedSource(DataSource):
    """``spark.read.format("stored_feeds").option("paths", "a,b").load()``: feed, xml."""

    @classmethod
    def name(cls) -> str:
        return "stored_feeds"

    def schema(self) -> str:
        return "feed string, xml string"

    def reader(self, schema) -> FeedReader:
        return FeedReader([p for p in self.options.get("paths", "").split(",") if p])


SOURCES: dict[str, type[DataSource]] = {"rss": FeedSource}


def register(spark: SparkSession, kind: str) -> str:
    """Register a source type; the format's name."""
    if kind not in SOURCES:
        raise KeyError(f"unknown source {kind!r}; known: {', '.join(sorted(SOURCES))}")
    spark.dataSource.register(SOURCES[kind])
    return SOURCES[kind].name()
