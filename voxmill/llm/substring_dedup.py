"""Operator 5: remove word spans that occurred before, by a De Bruijn graph of word windows.

An edge is a window of 20 consecutive words, known by 96 hash bits; its source is its first
place in the corpus, by ``doc_id`` and then by place. Edges are gathered in steps, so that only
those that can repeat are ever shuffled:

1. Of documents with the same words, all but the first are removed whole and left out.
2. Every window is covered by a minimizer, the k-mer with the least hash in it. Equal windows
   have equal minimizers, so only windows whose minimizer occurs twice become edges.
3. Edges are grouped to find repeated ones with their sources and degrees: whether the same edge
   follows, and the same comes before, wherever an edge stands.
4. Repeated edges are joined with those that come before them at the source. Two edges of which
   each is the only neighbour of the other are on one nonbranching path; wherever its first edge
   stands, all of it does. So paths are compacted to their first edges, with their lengths.
5. First edges meet all places where they stand: every place but the source is a repeated span.
6. The words at both coordinates are compared by a digest; a span that does not agree stays.

Cases. Null and empty texts have no words. Texts of fewer than 20 words lose none. Rows that
repeat id and text are one document and lose the same words. Rows that share an id and differ
each have their windows at that id's places: a window goes if its words start at a smaller id, or
at a smaller place of any text of its own id. A source is then known by its text too (``tid``, 64
bits of the words' digest; 0 where an id has one text). Rows without an id have no place in the
order: they lose nothing and are no source. Ids are whole numbers. An empty table gives an empty
result. Other columns are not used.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import joins, scratch
from .shingles import mixed, window_hashes, word_hashes

#: Words of a window, and of the k-mers that its minimizer is chosen from.
WINDOW, KMER = 20, 8


def minimizers(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k-mer hashes of a text and, for each window, the place of its least k-mer."""
    kmers = window_hashes(hashes, KMER)
    runs = sliding_window_view(kmers, WINDOW - KMER + 1)
    return kmers, runs.argmin(axis=1) + np.arange(len(runs))


def words_in(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def text_id(digest: bytes) -> int:
    """A text's number from the SHA-256 of its words; never 0, which stands for an id's only text."""
    return int.from_bytes(digest[:8], "little", signed=True) or 1


def digest_of(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, n, words (their digest), tid and anchors (minimizers) of texts with a window; written."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("words", pa.binary()), ("tid", pa.int64()), ("anchors", pa.list_(pa.int64()))])
        for batch in batches:
            ids, counts, digests, found = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = words_in(text.as_py())
                if len(words) >= WINDOW:
                    kmers, at = minimizers(word_hashes(words))
                    ids.append(doc_id)
                    counts.append(len(words))
                    digests.append(digest_of(words))
                    found.append(kmers[np.unique(at)].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int32()), pa.array(digests, pa.binary()), pa.array([text_id(d) for d in digests], pa.int64()), pa.array(found, pa.list_(pa.int64()))], schema=schema)

    return scratch.save(docs.mapInArrow(run, "doc_id long, n int, words binary, tid long, anchors array<long>"), "measured")


def with_several(docs: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``several``, whether the id has different texts, and the table of such ids if there are any."""
    ids = own.groupBy("doc_id").agg((F.min("tid") != F.max("tid")).alias("several")).filter("several")
    ids = scratch.save(ids, "shared_ids")
    if not ids.limit(1).count():
        return docs.withColumn("several", F.lit(False)), None
    return joins.keyed_filter(docs, ids, ["doc_id"], "left").withColumn("several", F.coalesce("several", F.lit(False))), ids


def same_sequences(own: DataFrame) -> DataFrame:
    """doc_id, words, src, n, tid of documents whose whole word sequence an earlier document has; written."""
    first = own.groupBy("words").agg(F.min("doc_id").alias("src"), F.count("*").alias("rows")).filter("rows > 1")
    met = joins.weighted_join(own.select("doc_id", "n", "words", "tid"), scratch.save(first, "first_sequences"), ["words"], "rows", "inner")
    return scratch.save(met.filter("doc_id <> src").select("doc_id", "words", "src", "n", "tid").distinct(), "same_sequences")


def repeated_minimizers(own: DataFrame) -> DataFrame:
    """doc_id and anchors: of each document, the minimizers that occur twice or more anywhere."""
    rows = own.select("doc_id", F.explode("anchors").alias("anchor"))
    twice = scratch.save(rows.groupBy("anchor").agg(F.count("*").alias("rows")).filter("rows > 1"), "repeated_minimizers")
    met = joins.weighted_join(rows, twice, ["anchor"], "rows", "inner")
    return scratch.save(met.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors")), "anchors")


def edges_of(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """h, g (96 hash bits), doc_id, tid, pos, before, after of windows whose minimizer is repeated; written.

    ``before`` and ``after`` are the ``h`` of the windows next to it, 0 at an end of the text.
    """

    def run(batches):
        schema = pa.schema([("h", pa.int64()), ("g", pa.int32()), ("doc_id", pa.int64()), ("tid", pa.int64()), ("pos", pa.int32()), ("before", pa.int64()), ("after", pa.int64())])
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("anchors"), batch.column("several").to_pylist(), strict=True)
            parts = []
            for doc_id, text, known, several in rows:
                words = words_in(text.as_py())
                hashes = word_hashes(words)
                if len(hashes) < WINDOW:
                    continue
                kmers, at = minimizers(hashes)
                pos = np.flatnonzero(np.isin(kmers[at], known.values.to_numpy().view(np.uint64)))
                h = np.concatenate([[0], window_hashes(hashes, WINDOW).view(np.int64), [0]])
                g = (window_hashes(mixed(~hashes), WINDOW)[pos] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                tid = text_id(digest_of(words)) if several else 0
                parts.append((h[pos + 1], g, np.full(len(pos), doc_id), np.full(len(pos), tid), pos.astype(np.int32), h[pos], h[pos + 2]))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], schema=schema)

    met = docs.join(anchors.hint("shuffle_merge"), "doc_id").select("doc_id", "text", "anchors", "several")
    return scratch.save(met.mapInArrow(run, "h long, g int, doc_id long, tid long, pos int, before long, after long"), "edges")


def only(column: str) -> Column:
    """The value that all rows of a group have; 0 if they differ."""
    return F.when(F.min(column) == F.max(column), F.min(column)).otherwise(F.lit(0))


def place_bits(own: DataFrame) -> int:
    """Bits that a place in a text needs if it fits into one whole number with the id; else 0."""
    low, high, longest = own.agg(F.coalesce(F.min("doc_id"), F.lit(0)), F.coalesce(F.max("doc_id"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    bits = max(1, longest.bit_length())
    return bits if low >= 0 and high.bit_length() + bits <= 63 else 0


def first_edges(edges: DataFrame, bits: int) -> DataFrame:
    """h, g, rows, src, tid, src_start, n: the first edge of each nonbranching path of ``n`` edges; written.

    Id and place in one number of ``bits`` for the place are compared without a sort; with 0 bits
    id, place and text are compared one after the other, which gives the same where each id has one text.

    A path's places are those of any of its edges, in the same order, so the source of an edge
    stands next to that of its neighbour and one join by source coordinates links them all.
    """
    if bits:
        first = F.min(F.shiftleft("doc_id", bits).bitwiseOR(F.col("pos").cast("long"))).alias("first")
        src, at, tid = F.shiftright("first", bits), F.col("first").bitwiseAND(F.lit((1 << bits) - 1)).cast("int"), F.lit(0).cast("long")
    else:
        first = F.min(F.struct("doc_id", "pos", "tid")).alias("first")
        src, at, tid = F.col("first.doc_id"), F.col("first.pos"), F.col("first.tid")
    repeated = edges.groupBy("h", "g").agg(first, F.count("*").alias("rows"), only("before").alias("before"), only("after").alias("after")).filter("rows > 1")
    repeated = scratch.save(repeated.select("h", "g", "rows", src.alias("src"), tid.alias("tid"), at.alias("src_start"), "before", "after"), "repeated_edges")
    previous = repeated.select("src", "tid", (F.col("src_start") + 1).alias("src_start"), F.col("after").alias("h"), F.col("h").alias("before"), F.lit(False).alias("starts"))
    linked = repeated.join(previous, ["src", "tid", "src_start", "h", "before"], "left").withColumn("starts", F.coalesce("starts", F.lit(True)))
    # the edges of one text up to each: at most as many as it has words
    so_far = Window.partitionBy("src", "tid").orderBy("src_start", "h", "g").rowsBetween(Window.unboundedPreceding, 0)
    path = linked.withColumn("path", F.sum(F.col("starts").cast("int")).over(so_far))
    head = F.min(F.when(F.col("starts"), F.struct("src_start", "h", "g", "rows"))).alias("head")
    return scratch.save(path.groupBy("src", "tid", "path").agg(head, F.count("*").cast("int").alias("n")).select("head.*", "src", "tid", "n"), "first_edges")


def repeated_paths(edges: DataFrame, bits: int) -> DataFrame:
    """doc_id, start, n, src, tid, src_start: runs of ``n`` words whose windows occurred before."""
    met = joins.weighted_join(edges.select("h", "g", "doc_id", "pos"), first_edges(edges, bits), ["h", "g"], "rows", "inner")
    met = met.filter("doc_id <> src or pos <> src_start")
    return met.select("doc_id", F.col("pos").alias("start"), (F.col("n") + (WINDOW - 1)).alias("n"), "src", "tid", "src_start")


def digest(words: list[bytes], start: int, n: int) -> bytes | None:
    """Of ``n`` words from ``start``; none if the text ends before."""
    return hashlib.blake2b(b" ".join(words[start : start + n]), digest_size=16).digest() if start + n <= len(words) else None


def with_digests(docs: DataFrame, paths: DataFrame) -> DataFrame:
    """``paths`` with the digest of the words at the source."""
    place = ["src", "tid", "src_start", "n"]
    asked = scratch.save(paths.groupBy(*place).agg(F.count("*").alias("rows")), "sources")
    by_doc = asked.groupBy(F.col("src").alias("doc_id")).agg(F.collect_list(F.struct("tid", "src_start", "n", "rows")).alias("asked"))

    def run(batches):
        schema = pa.schema([("src", pa.int64()), ("tid", pa.int64()), ("src_start", pa.int32()), ("n", pa.int32()), ("rows", pa.int64()), ("digest", pa.binary())])
        for batch in batches:
            for doc_id, text, several, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("several").to_pylist(), batch.column("asked"), strict=True):
                words, places = words_in(text.as_py()), wanted.values
                if several:  # the places of this one of the id's texts
                    places = places.filter(pc.equal(places.field("tid"), text_id(digest_of(words))))
                start, n = places.field("src_start").to_numpy(), places.field("n").to_numpy()
                told = pa.array([digest(words, a, k) for a, k in zip(start.tolist(), n.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), doc_id)), places.field("tid"), pa.array(start), pa.array(n), places.field("rows"), told], schema=schema)

    met = docs.join(by_doc.hint("shuffle_merge"), "doc_id").select("doc_id", "text", "several", "asked").mapInArrow(run, "src long, tid long, src_start int, n int, rows long, digest binary")
    told = scratch.save(met.filter("digest is not null").dropDuplicates(place), "source_digests")
    return joins.weighted_join(paths, told, place, "rows", "inner").drop("rows")


def spans_of(docs: DataFrame) -> DataFrame:
    """doc_id, start, n, digest: all spans to remove from ``docs`` (doc_id, text), unverified."""
    known = docs.filter("doc_id is not null")
    own = measured(known)
    same = same_sequences(own)
    known, shared = with_several(known, own)
    single = joins.keyed_filter(own, same.select("doc_id", "words"), ["doc_id", "words"], "left_anti")
    edges = edges_of(known, repeated_minimizers(single))
    whole = same.select("doc_id", F.lit(0).alias("start"), "n", "src", "tid", F.lit(0).alias("src_start"))
    if shared is None:
        whole = whole.withColumn("tid", F.lit(0).cast("long"))
    else:
        met = joins.keyed_filter(whole, shared.withColumnRenamed("doc_id", "src"), ["src"], "left")
        whole = met.withColumn("tid", F.when(F.col("several"), F.col("tid")).otherwise(0)).drop("several")
    paths = scratch.save(repeated_paths(edges, place_bits(own) if shared is None else 0).unionByName(whole), "spans")
    scratch.drop(edges)
    scratch.drop(own)
    return scratch.save(with_digests(known, paths).select("doc_id", "start", "n", "digest"), "verified")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (binary; the words that stay, joined by a space)."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])
        for batch in batches:
            ids, counts, removed, kept = batch.column("doc_id"), [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = words_in(text.as_py())
                gone = np.zeros(len(words), dtype=bool)
                for span in spans.as_py() or ():
                    if digest(words, span["start"], span["n"]) == span["digest"]:
                        gone[span["start"] : span["start"] + span["n"]] = True
                counts.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if removed[-1] else b" ".join(words))
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], schema=schema)

    scratch.bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    spans = spans_of(docs).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "digest")).alias("spans"))
    met = docs.join(spans.hint("shuffle_merge"), "doc_id", "left").select("doc_id", "text", "spans")
    return met.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
