"""Growing files of lines as a stream, and the sink that makes them grow.

Spark's own file source reads a file once. This source remembers how many bytes of each file it
has handed on: a trigger takes what was appended since, up to the last newline, so a line that is
still being written waits for its end. The offsets are in the query's checkpoint, files only grow,
and so every line comes exactly once, also after a restart. Large growth is read in pieces of
PIECE bytes by several tasks; a piece has the lines that start in it.

The sink appends lines to a file of each task's own. A file whose last line has no end (its writer
was killed) gets a newline first, so that only that line is corrupt. A task that is tried again
appends again: the sink is at least once, as a written row is a mark that it's done, and readers
drop repeated keys.

Paths are URIs that pyarrow knows (files, HDFS, object stores; appending needs a store that can).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from pathlib import PurePosixPath
from urllib.parse import unquote, urlparse

from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

# workers that plan and read know pyspark, and not always this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that one task reads, and bytes that are looked at together for a newline.
PIECE, STEP = 64 << 20, 1 << 20


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path of a URI or a plain path."""
    if urlparse(uri).scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(urlparse(uri).path) if uri.startswith("file:") else uri
    return pafs.FileSystem.from_uri(uri)


def last_line_end(store: pafs.FileSystem, path: str, start: int, size: int) -> int:
    """The place behind the last newline between ``start`` and ``size``; ``start`` if there is none."""
    with store.open_input_file(path) as f:
        while size > start:
            a = max(start, size - STEP)
            found = f.read_at(size - a, a).rfind(b"\n")
            if found >= 0:
                return a + found + 1
            size = a
    return start


class Piece(InputPartition):
    def __init__(self, path: str, start: int, end: int, first: bool) -> None:
        self.path, self.start, self.end, self.first = path, start, end, first


class LineTailReader(DataSourceStreamReader):
    """Offsets are the bytes read of each file, by its path."""

    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.name = options["path"].rstrip("/"), options.get("name")
        self.piece = int(options.get("piece", PIECE))
        self.known: dict[str, tuple[int, int]] = {}

    def files(self) -> list[pafs.FileInfo]:
        """The file itself, or those called ``name`` in the folder and in its direct subfolders."""
        store, path = opened(self.root)
        if self.name is None:
            return [i for i in store.get_file_info([path]) if i.is_file]
        inside = store.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        places = [path, *sorted(i.path for i in inside if i.type == pafs.FileType.Directory)]
        return [i for i in store.get_file_info([f"{p}/{self.name}" for p in places]) if i.is_file]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, _ = opened(self.root)
        for info in self.files():
            size, end = self.known.get(info.path, (0, 0))
            if info.size > size:  # only what grew is looked at
                self.known[info.path] = info.size, last_line_end(store, info.path, end, info.size)
        return {path: end for path, (_, end) in self.known.items() if end}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        for path, at in {**start, **end}.items():  # after a restart nothing before these is looked at again
            if at > self.known.get(path, (0, 0))[1]:
                self.known[path] = at, at
        grown = [(path, start.get(path, 0), to) for path, to in sorted(end.items()) if to > start.get(path, 0)]
        return [Piece(path, a, min(a + self.piece, to), a == at) for path, at, to in grown for a in range(at, to, self.piece)]

    def read(self, partition: Piece) -> Iterator[tuple]:
        store, _ = opened(self.root)
        with store.open_input_file(partition.path) as f:
            # a line that began in the piece before belongs to it
            at = partition.start if partition.first else partition.start - 1
            f.seek(at)
            if not partition.first:
                at += len(_line(f))
            while at < partition.end:
                line = _line(f)
                if not line:
                    return
                text = line.decode("utf-8", errors="replace").strip()
                if text:
                    yield partition.path, at, text
                at += len(line)

    def commit(self, end: dict) -> None:
        pass


def _line(f) -> bytes:
    """The rest of a line with its newline, however long."""
    parts = []
    while True:
        here = f.tell()
        part = f.read(1 << 16)
        cut = part.find(b"\n") + 1
        if cut or not part:
            f.seek(here + cut)
            return b"".join([*parts, part[:cut]]) if cut else b""
        parts.append(part)


class Appended(WriterCommitMessage):
    def __init__(self, lines: int) -> None:
        self.lines = lines


class LineAppender(DataSourceWriter):
    """Appends the first column's texts as lines; ``{task}`` in ``name`` is the task's number."""

    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.name, self.open_line = options["path"].rstrip("/"), options["name"], options.get("unfinished", "")

    def write(self, iterator: Iterator) -> Appended:
        from pyspark import TaskContext

        store, root = opened(self.root)
        path = f"{root}/{self.name.replace('{task}', str(TaskContext.get().partitionId()))}"
        count, held = 0, []
        for row in iterator:
            held.append(row[0] + "\n")
            count += 1
            if len(held) >= 10_000:
                self.append(store, path, "".join(held))
                held = []
        if held:
            self.append(store, path, "".join(held) + self.open_line)
        return Appended(count)

    def append(self, store: pafs.FileSystem, path: str, text: str) -> None:
        """One write of whole lines, behind the end of whatever line is there."""
        store.create_dir(str(PurePosixPath(path).parent), recursive=True)
        info = store.get_file_info([path])[0]
        if info.is_file and info.size:
            with store.open_input_file(path) as f:
                text = text if f.read_at(1, info.size - 1) == b"\n" else "\n" + text
        with store.open_append_stream(path, compression=None) as out:
            out.write(text.encode())


class LineTail(DataSource):
    """``spark.readStream.format("line_tail")``: path, at (its first byte), value of each line."""

    @classmethod
    def name(cls) -> str:
        return "line_tail"

    def schema(self) -> str:
        return "path string, at long, value string"

    def streamReader(self, schema) -> LineTailReader:
        return LineTailReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> LineAppender:
        if overwrite:
            raise ValueError("lines are appended; nothing is overwritten")
        return LineAppender(dict(self.options))


def lines(spark: SparkSession, path: str, name: str | None = None, piece: int = PIECE) -> DataFrame:
    """The lines of a growing file, or of those called ``name`` in a folder and its direct subfolders."""
    spark.dataSource.register(LineTail)
    reader = spark.readStream.format("line_tail").option("path", path).option("piece", piece)
    return (reader.option("name", name) if name else reader).load()


def records(stream: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The records of ``lines``; what is no JSON object is left out, fields that don't fit are null."""
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    good = stream.filter(F.try_parse_json("value").isNotNull() & F.startswith("value", F.lit("{")))
    return good.withColumn("record", F.from_json("value", shape)).select(F.col("path").alias("_file"), F.col("at").alias("_at"), "record.*")


def ledgers(spark: SparkSession, root: str, schema: T.StructType, name: str = "ledger.jsonl") -> DataFrame:
    """New entries of the ledgers of a folder and its subfolders; relative paths become absolute."""
    base = root.rstrip("/")
    rows = records(lines(spark, base, name), schema)
    base = opened(base)[1] if urlparse(base).scheme == "file" else base
    return rows.withColumn("path", F.when(F.startswith("path", F.lit("/")), F.col("path")).otherwise(F.concat(F.lit(base + "/"), F.col("path"))))


def append(rows: DataFrame, path: str, name: str, unfinished: str = "") -> None:
    """Append ``rows`` as JSON lines below ``path``; each task writes the file ``name`` tells it, one a task.

    ``unfinished`` is a text without an end behind the last line, as a writer that is killed leaves.
    """
    rows.sparkSession.dataSource.register(LineTail)
    told = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    told.write.format("line_tail").option("path", path).option("name", name).option("unfinished", unfinished).mode("append").save()
