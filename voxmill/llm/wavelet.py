"""Operator 4: token ids in wavelet matrix files, one per shard.

A shard holds the ids of documents with consecutive ids as a wavelet matrix: bit-plane by
bit-plane from the highest bit, each plane in the order that the planes above it leave (rows
with bit 0 first, then those with bit 1). The planes are cut into blocks, each compressed for
itself, with the number of ones before it beside it; so access, rank, count and select read a
block or two of each plane. The file ends with a directory and the document table.

Documents are sorted by ``doc_id`` over range partitions, so shards in the order of (partition,
number) hold all ids in ascending order and one pass over the shards' totals gives each its
start. A task writes a new file under its own attempt's name, so a repeated task harms nothing;
the manifest names those that count.

Cases. Null and empty texts have the end id alone. Null ids come first. Rows with the same id
stand side by side in the order of their texts. Ids of documents are whole numbers. An empty
table makes no files.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import scratch

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
#: A shard is closed when it has so many ids; a longer document is never cut.
SHARD_IDS = 4_000_000
BLOCK_BYTES = 4096
MAGIC = b"WVM1"
#: Words whose ids a worker remembers before they become its older half and the one before goes.
MEMO_SIZE = 600_000
#: Bytes of texts that are encoded together; words that they share are looked up once.
GROUP_BYTES = 16 << 20
#: Punctuation that may end a word, and words that are one match of the vocabulary's pattern.
TAIL = ".,!?;:#$%&*|"
LETTERS = "^[a-zªµºÀ-ÖØ-öø-ÿ]+$"


def runs_of(row: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``row`` from ``start`` in a row, and where each begins there (and the last ends)."""
    until = np.concatenate([[0], np.cumsum(size)])
    return row[np.repeat(start - until[:-1], size) + np.arange(until[-1])], until


class Memory:
    """The ids of words: each word has a number, and its ids are a run of ``row``."""

    def __init__(self) -> None:
        self.words = pa.array([""])
        self.start, self.size = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.row = np.zeros(0, dtype="<u4")

    def find(self, words: pa.Array) -> np.ndarray:
        """The words' numbers, -1 for those that aren't here."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)

    def add(self, words: pa.Array, row: np.ndarray, size: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.start = np.concatenate([self.start, len(self.row) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.row = np.concatenate([self.row, row])


class WordIds:
    """The tokenizer with a memory of words.

    White space ends every token of this vocabulary and its texts are lower-cased, so the ids of
    a text are those of its white-space-separated words in lower case, and the ids of a group of
    texts are gathered from those of its distinct words. Punctuation behind an ASCII letter or
    digit is a match of its own, so such a tail is looked up apart. A word of Latin-1 letters is
    one match, and its last token one that ends a word: many such words go to the tokenizer as one
    text and are told apart by that; other words go alone. A text in which an added token stands,
    in whatever case, goes as a whole: such a token is found before anything is lower-cased.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.known, self.older = Memory(), Memory()

    def whole(self, text: str) -> np.ndarray:
        """The ids of a text as the tokenizer gives them."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def learn(self, words: pa.Array) -> None:
        """Remember the ids of ``words``, all in lower case."""
        plain = pc.match_substring_regex(words, LETTERS)
        letters, others = words.filter(plain), words.filter(pc.invert(plain))
        rows, ends, at = [np.zeros(0, dtype="<u4")], [np.zeros(1, dtype=np.int64)], 0
        for k in range(0, len(letters), 200):
            part = letters.slice(k, 200).to_pylist()
            ids = self.whole(" ".join(part))
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(part):
                raise ValueError("words can't be told apart")
            rows.append(ids)
            ends.append(last + at)
            at += len(ids)
        self.known.add(letters, np.concatenate(rows), np.diff(np.concatenate(ends)))
        alone = [self.whole(word) for word in others.to_pylist()]
        self.known.add(others, np.concatenate([rows[0], *alone]), np.array([len(ids) for ids in alone], dtype=np.int64))

    def remember(self, words: pa.Array) -> np.ndarray:
        """The numbers of distinct ``words`` in memory, after what is new was learnt."""
        numbers = self.known.find(words)
        if (numbers < 0).sum() + len(self.known.words) > MEMO_SIZE:
            self.older, self.known = self.known, Memory()
            numbers = self.known.find(words)
        new = words.filter(pa.array(numbers < 0))
        if len(new):
            place = self.older.find(new)
            held = place >= 0
            size = self.older.size[place[held]]
            self.known.add(new.filter(pa.array(held)), runs_of(self.older.row, self.older.start[place[held]], size)[0], size)
            self.learn(new.filter(pa.array(~held)))
            numbers = self.known.find(words)
        return numbers

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null has none."""
        lower = pc.ascii_lower(pc.fill_null(texts, ""))
        apart = pa.array(np.zeros(len(texts), dtype=bool))
        for token in self.added:
            apart = pc.or_(apart, pc.match_substring(lower, token))
        lists = pc.ascii_split_whitespace(pc.if_else(apart, "", lower))
        found = lists.flatten().dictionary_encode()
        words = found.dictionary
        core = pc.ascii_rtrim(words, characters=TAIL)
        core = pc.if_else(pc.match_substring_regex(core, "[a-z0-9]$"), core, words)
        tails = pc.replace_substring_regex(words.filter(pc.not_equal(core, words)), "^.*[a-z0-9]", "")
        parts = pa.concat_arrays([core, tails]).dictionary_encode()
        numbers = self.remember(parts.dictionary)[parts.indices.to_numpy()]
        # the parts of a word stand side by side; the empty word has number 0
        pairs = np.zeros((len(words), 2), dtype=np.int64)
        pairs[:, 0] = numbers[: len(words)]
        pairs[pc.not_equal(core, words).to_numpy(zero_copy_only=False), 1] = numbers[len(words) :]
        memory = self.known
        row, ends = runs_of(memory.row, memory.start[pairs.ravel()], memory.size[pairs.ravel()])
        start = ends[:-1:2]
        index = found.indices.to_numpy()
        ids, until = runs_of(row, start[index], np.diff(np.append(start, len(row)))[index])
        cuts, raw = (4 * until[lists.offsets.to_numpy()]).tolist(), ids.tobytes()
        coded = [raw[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        for k in np.flatnonzero(apart.to_numpy(zero_copy_only=False)).tolist():
            coded[k] = self.whole(texts[k].as_py()).tobytes()
        return coded

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text]))[0]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def build(ids: np.ndarray, docs: list[tuple[int | None, int]]) -> bytes:
    """The file of one shard: ``ids`` and its documents' (doc_id, number of ids)."""
    bits = max(1, int(ids.max(initial=0)).bit_length())
    out, planes, at = [MAGIC], [], len(MAGIC)
    pack = zstandard.ZstdCompressor(level=3)
    kind = np.uint16 if bits <= 16 else np.uint32
    row = ids.astype(kind)
    for level in range(bits - 1, -1, -1):
        bit = (row & kind(1 << level)).astype(bool)
        raw = np.packbits(bit).tobytes()
        ones, sizes, seen = [], [], 0
        for k in range(0, len(raw), BLOCK_BYTES):
            ones.append(seen)
            seen += int(np.count_nonzero(bit[k * 8 : (k + BLOCK_BYTES) * 8]))
            block = pack.compress(raw[k : k + BLOCK_BYTES])
            sizes.append(len(block))
            out.append(block)
        planes.append({"at": at, "zeros": len(row) - seen, "ones": ones, "sizes": sizes})
        at += sum(sizes)
        row = np.concatenate([row[~bit], row[bit]])
    table = {"n": len(ids), "bits": bits, "planes": planes, "docs": [d for d, _ in docs], "lengths": [n for _, n in docs]}
    tail = pack.compress(json.dumps(table).encode())
    return b"".join([*out, tail, struct.pack("<Q", len(tail)), MAGIC])


class WaveletFile:
    """Reads one shard; ``source`` is a random-access file."""

    def __init__(self, source) -> None:
        self.source = source
        end = source.size()
        source.seek(end - 12)
        (size,) = struct.unpack("<Q", source.read(8))
        if source.read(4) != MAGIC:
            raise ValueError("not a wavelet matrix file")
        source.seek(end - 12 - size)
        table = json.loads(zstandard.ZstdDecompressor().decompress(source.read(size)))
        self.n, self.bits, self.planes = table["n"], table["bits"], table["planes"]
        self.docs, self.lengths = table["docs"], table["lengths"]
        for plane in self.planes:
            plane["starts"] = [plane["at"], *(plane["at"] + np.cumsum(plane["sizes"])).tolist()]
        self.blocks: dict[tuple[int, int], np.ndarray] = {}

    def block(self, level: int, k: int) -> np.ndarray:
        """The bits of one block."""
        if (level, k) not in self.blocks:
            if len(self.blocks) >= 256:
                self.blocks.clear()
            plane = self.planes[level]
            self.source.seek(plane["starts"][k])
            raw = zstandard.ZstdDecompressor().decompress(self.source.read(plane["sizes"][k]), max_output_size=BLOCK_BYTES)
            self.blocks[level, k] = np.unpackbits(np.frombuffer(raw, dtype=np.uint8))
        return self.blocks[level, k]

    def bit(self, level: int, i: int) -> int:
        return int(self.block(level, i // (8 * BLOCK_BYTES))[i % (8 * BLOCK_BYTES)])

    def ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if i <= 0:
            return 0
        k, r = divmod(i, 8 * BLOCK_BYTES)
        if r == 0:
            k, r = k - 1, 8 * BLOCK_BYTES
        return self.planes[level]["ones"][k] + int(np.count_nonzero(self.block(level, k)[:r]))

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for level in range(self.bits):
            one, ones = self.bit(level, i), self.ones(level, i)
            value = value << 1 | one
            i = self.planes[level]["zeros"] + ones if one else i - ones
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """The places of ``value`` below ``end``, as they stand after the last plane."""
        low, high = 0, min(end, self.n)
        if value >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self.ones(level, low), self.ones(level, high)
            if value >> (self.bits - 1 - level) & 1:
                low, high = self.planes[level]["zeros"] + a, self.planes[level]["zeros"] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, value: int, end: int) -> int:
        """How often ``value`` stands before place ``end``."""
        low, high = self._range(value, end)
        return high - low

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _select_bit(self, level: int, one: int, k: int) -> int:
        """The place of the ``k``-th bit (from 0) of a plane that is ``one``."""
        plane = self.planes[level]
        before = np.asarray(plane["ones"]) if one else np.arange(len(plane["ones"])) * 8 * BLOCK_BYTES - np.asarray(plane["ones"])
        at = int(np.searchsorted(before, k, side="right")) - 1
        return at * 8 * BLOCK_BYTES + int(np.flatnonzero(self.block(level, at) == one)[k - int(before[at])])

    def select(self, value: int, k: int) -> int:
        """The place of the ``k``-th occurrence (from 0) of ``value``; -1 if there is none."""
        low, high = self._range(value, self.n)
        if not 0 <= k < high - low:
            return -1
        i = low + k
        for level in range(self.bits - 1, -1, -1):
            one = value >> (self.bits - 1 - level) & 1
            i = self._select_bit(level, one, i - self.planes[level]["zeros"] if one else i)
        return i

    def all_ids(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        row = np.zeros(self.n, dtype=kind)
        unpack = zstandard.ZstdDecompressor()
        for level in range(self.bits - 1, -1, -1):
            plane = self.planes[level]
            self.source.seek(plane["at"])
            whole, at, parts = self.source.read(sum(plane["sizes"])), 0, []
            for size in plane["sizes"]:
                parts.append(unpack.decompress(whole[at : at + size], max_output_size=BLOCK_BYTES))
                at += size
            bit = np.unpackbits(np.frombuffer(b"".join(parts), dtype=np.uint8), count=self.n).astype(bool)
            before = np.empty_like(row)
            before[~bit] = row[: plane["zeros"]]
            before[bit] = row[plane["zeros"] :] | kind(1 << (self.bits - 1 - level))
            row = before
        return row


def open_shard(path: str) -> WaveletFile:
    where, name = fs.FileSystem.from_uri(path)
    return WaveletFile(where.open_input_file(name))


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of ``batches`` in groups of GROUP_BYTES; a batch is never cut."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GROUP_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


MANIFEST = "part int, number int, path string, n_ids long, n_docs long"


def write_shards(docs: DataFrame, folder: str, path: str = VOCABULARY, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``docs`` and write the shards to ``folder``; the manifest, one row per file."""

    def run(batches):
        own = word_ids(path)
        task = TaskContext.get()
        end = np.array([end_id], dtype="<u4").tobytes()
        where, name = fs.FileSystem.from_uri(folder)
        where.create_dir(name, recursive=True)
        held, ids, total, number = [], [], 0, 0

        def close():
            file = f"part-{task.partitionId():06d}-{number:05d}-{task.taskAttemptId()}.wvm"
            with where.open_output_stream(f"{name}/{file}") as out:
                out.write(build(np.frombuffer(b"".join(ids), dtype="<u4"), held))
            row = {"part": [task.partitionId()], "number": [number], "path": [f"{folder}/{file}"], "n_ids": [total], "n_docs": [len(held)]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())]))

        for group in grouped(batches):
            for doc_id, coded in zip(group.column("doc_id").to_pylist(), own.encode_all(group.column("text").combine_chunks()), strict=True):
                coded += end
                held.append((doc_id, len(coded) // 4))
                ids.append(coded)
                total += len(coded) // 4
                if total >= shard_ids:
                    yield close()
                    held, ids, total, number = [], [], 0, number + 1
        if held:
            yield close()

    scratch.bound_batches(docs.sparkSession)
    in_order = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return scratch.save(in_order.mapInArrow(run, MANIFEST), "shards")


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary) of every document, from the files."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))  # a row per shard

    def run(batches):
        kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                shard = open_shard(path)
                whole = shard.all_ids().astype("<u4").tobytes()
                ends = np.concatenate([[0], np.cumsum(shard.lengths)]).astype(np.int64)
                for k in range(0, len(shard.docs), 2000):
                    at = ends[k : k + 2001]
                    ids = [whole[4 * a : 4 * b] for a, b in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(shard.docs[k : k + 2000], pa.int64()), pa.array(at[:-1] + start), pa.array(np.diff(at)), pa.array(ids, pa.binary())], schema=kinds)

    spread = files.select("path", "start").repartition(max(1, manifest.count()), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    back = read_shards(write_shards(docs, scratch.new_folder(spark, "wavelet")))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
