"""Operator 9: byte-level BPE encoding and decoding.

Text is cut by the vocabulary's pattern; each match is encoded alone. The tokens that start at
each byte of a match come from one Aho-Corasick pass over the bytes read as Latin-1. The
encoding then goes from the longest token at a place to shorter ones, going back when none
fits: a row of tokens is what the merges give exactly if every two neighbours are what the
merges give for their joined bytes. Whether two tokens may be neighbours is remembered, as are
whole matches; a place that turned out to lead nowhere is never tried again, so the work is
linear in the length of the match.

Cases. Null and empty texts give no ids and decode to nothing. Ties and repeated rows are
encoded row by row. Other columns are passed on; a column named like an output is replaced.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scratch

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Entries that a worker remembers of each kind before it starts afresh.
MEMO_SIZE = 400_000
#: Matches longer than this are not remembered, as they hardly come again.
MEMO_LENGTH = 64


class Codec:
    """Encodes and decodes by one rank file."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.tokens = pa.array([self.bytes_of.get(rank) for rank in range(max(self.bytes_of) + 1)], pa.large_binary())
        self.pattern = regex.compile(pattern)
        self.starts = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            if len(token) > 1:
                self.starts.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.one_byte = [self.ranks[bytes([b])] for b in range(256)]
        self.starts.make_automaton()
        self.size_of = {rank: len(token) for token, rank in self.ranks.items()}
        self.sound: dict[int, bool] = {}
        self.fits: dict[int, bool] = {}
        self.shorter: dict[int, int] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, piece: bytes) -> list[int]:
        """What the merges give, one after the other; for short pieces."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def is_sound(self, token: int) -> bool:
        """Whether the merges of a token's own bytes give that token."""
        self.sound[token] = told = self.merged(self.bytes_of[token]) == [token]
        return told

    def fit(self, left: int, right: int) -> bool:
        """Whether the merges of the joined bytes give these two tokens."""
        if len(self.fits) >= MEMO_SIZE:
            self.fits.clear()
        self.fits[left << 32 | right] = told = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return told

    def next_shorter(self, token: int) -> int:
        """The longest other token that begins this one; -1 if there is none."""
        if token not in self.shorter:
            own = self.bytes_of[token]
            self.shorter[token] = next((self.ranks[own[:n]] for n in range(len(own) - 1, 0, -1) if own[:n] in self.ranks), -1)
        return self.shorter[token]

    def encode_piece(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        length, size_of, sound, fits = len(piece), self.size_of, self.sound.get, self.fits.get
        longest = list(map(self.one_byte.__getitem__, piece))
        for end, (rank, back) in self.starts.iter(piece.decode("latin-1")):
            longest[end - back] = rank  # ends grow, so the last token found at a place is its longest
        out: list[int] = []
        dead = bytearray(length + 1)
        at, token, last = 0, longest[0], -1
        while at < length:
            while token >= 0:
                end = at + size_of[token]
                if not dead[end]:
                    good = sound(token)
                    if good is None:
                        good = self.is_sound(token)
                    if good and last >= 0:
                        good = fits(last << 32 | token)
                        if good is None:
                            good = self.fit(last, token)
                    if good:
                        break
                token = self.next_shorter(token)
            if token >= 0:
                out.append(token)
                at, last = end, token
                token = longest[at] if at < length else -1
            else:  # no token goes on from here, so no encoding passes through this place
                dead[at] = 1
                token = out.pop()
                last = out[-1] if out else -1
                at -= size_of[token]
        return out

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids_of(self, piece: str) -> bytes:
        """The ids of one match as little-endian unsigned 32-bit integers."""
        found = self.known.get(piece)
        if found is None:
            found = self.packed(self.encode_piece(piece.encode()))
            if len(piece) <= MEMO_LENGTH:
                if len(self.known) >= MEMO_SIZE:
                    self.known.clear()
                self.known[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        known, new = self.known.get, self.ids_of
        return b"".join([known(piece) or new(piece) for piece in self.pattern.findall(text)])

    def decode_all(self, rows: list[bytes]) -> pa.Array:
        """The bytes that each row of ids stands for."""
        ids = np.frombuffer(b"".join(rows), dtype="<u4")
        told = self.tokens.take(pa.array(ids))
        if told.null_count:
            raise KeyError("an id that the vocabulary doesn't have")
        ends = np.frombuffer(told.buffers()[1], dtype=np.int64, count=len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        at = np.cumsum([0, *map(len, rows)]) // 4
        return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends[at]), told.buffers()[2]]).cast(pa.binary())


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and vocabulary."""
    return Codec(path)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], values], names=[*kept, name])


def _extended(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """``df`` with the ids of each whole text, as little-endian unsigned 32-bit integers."""

    scratch.bound_batches(df.sparkSession)

    def run(batches):
        own = codec(path)
        for batch in batches:
            yield _with_column(batch, ids, pa.array([own.encode(t.as_py() or "") for t in batch.column(text)], pa.binary()))

    return df.mapInArrow(run, _extended(df, ids, T.BinaryType()))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str = VOCABULARY) -> DataFrame:
    """``df`` with the bytes that each row of ids stands for."""

    def run(batches):
        own = codec(path)
        for batch in batches:
            yield _with_column(batch, out, own.decode_all([i.as_py() or b"" for i in batch.column(ids)]))

    return df.mapInArrow(run, _extended(df, out, T.BinaryType()))


def round_trip(df: DataFrame, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``df`` without the text, with its ``ids`` and the bytes ``decoded`` from them.

    What ``encode`` and ``decode`` give one after the other, in one pass of one worker.
    """
    scratch.bound_batches(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in (text, "ids", "decoded")]
    names = [f.name for f in kept]

    def run(batches):
        own = codec(path)
        for batch in batches:
            ids = [own.encode(t.as_py() or "") for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(ids, pa.binary()), own.decode_all(ids)], names=[*names, "ids", "decoded"])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    coded = round_trip(docs.select("doc_id", "text"))
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
