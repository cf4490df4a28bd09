"""Operator 13: spelling variants by blocked Gram matrices of letter counts.

Two words are near if one inserted, deleted or replaced code point leads from one to the other.
Then their letter counts differ by a squared distance of at most two, and their lengths by at
most one. Words of one length and of the next are compared in blocks: a Gram matrix of the letter
counts gives all squared distances of a block at once, pairs at most two apart are candidates,
and these are verified letter by letter.

A length's block is cut further by what near words must share. With a word of n letters, cut at
n // 2, a near one of n or n + 1 letters shares the first part as its beginning or the second as
its end. So a word enters four blocks (as one of n and as one of n + 1 letters, by beginning and
by end), and no pair is lost; a pair that meets by both counts in the block of the beginning.
Blocks of more than BLOCK words are cut into chunks by hash, and each chunk meets each; the matrix
of two chunks is the largest thing a task holds.

What leaves a block is one row per word: how many near words it found there and the best of them.
Roots follow forms by doubling: a form is ten times as frequent as its word, so chains are short.

Cases. Null texts have no words, a null ``doc_id`` counts as an empty one. Repeated documents count
each time. Empty tables give empty results. ``variants`` reads ``word`` and ``n`` alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import joins, scratch

#: Words of a chunk: its letter counts and the matrix of two chunks are a few dozen MB. Words of more
#: than LONG letters count for as many as they are longer.
BLOCK, LONG = 2048, 64
#: Letters that are compared at once; sums up to EXACT are whole numbers as 32-bit floats.
SLICE, EXACT = 1 << 22, 1 << 24
#: Letters are counted modulo so many code points; more than one letter in a place only adds candidates.
PLACES = 32
FEWEST, SHORTEST, TIMES = 2, 7, 10
FOUND = "word string, n_near long, best_n long, best string"


# pairs inside a block


def letters_of(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    place = (letters % PLACES + PLACES * np.arange(len(letters), dtype=np.uint32)[:, None]).ravel()
    small = 4 * letters.shape[1] ** 2 < EXACT
    return np.bincount(place, minlength=PLACES * len(letters)).reshape(-1, PLACES).astype(np.float32 if small else np.float64)


def close_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words whose letter counts are at a squared distance of at most two, by a Gram matrix."""
    x, y = letter_counts(a), letter_counts(b)
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.nonzero(distance <= 2)


def near_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at one edit, of words of equal length or with one letter more in ``b``."""
    i, j = close_pairs(a, b)
    size, step = a.shape[1], max(1, SLICE // b.shape[1])
    near = np.zeros(len(i), dtype=bool)
    for k in range(0, len(i), step):
        x, y = a[i[k : k + step]], b[j[k : k + step]]
        if b.shape[1] == size:
            near[k : k + step] = (x != y).sum(1) == 1
        else:
            head = np.logical_and.accumulate(x == y[:, :size], axis=1).sum(1)
            tail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
            near[k : k + step] = head + tail >= size
    return i[near], j[near]


def block_pairs(ends: bool, short: list[str], more_short: list[str] | None, long: list[str]) -> Iterator[tuple[str, str]]:
    """Near pairs of a block: within ``short`` or between it and ``more_short``, and to ``long``, one letter longer.

    In blocks by end, pairs that share the beginning too are left to that block.
    """
    if not short:
        return
    a, half = letters_of(short), len(short[0]) // 2
    for other, inner in ((short if more_short is None else more_short, more_short is None), (long, False)):
        if not other:
            continue
        b = letters_of(other)
        i, j = near_pairs(a, b)
        if inner:
            i, j = i[i < j], j[i < j]
        if ends:
            apart = (a[i, :half] != b[j, :half]).any(1)
            i, j = i[apart], j[apart]
        yield from zip([short[k] for k in i], [other[k] for k in j], strict=True)


def _best(pairs: list[tuple[str, str]], counts: dict[str, int]) -> pa.RecordBatch:
    """Per word of ``pairs``: how many words it is near to, and the most frequent of them."""
    found: dict[str, list] = {}
    for pair in pairs:
        for word, near in (pair, pair[::-1]):
            n, held = counts[near], found.get(word)
            if held is None:
                found[word] = [1, n, near]
                continue
            held[0] += 1
            if n > held[1] or n == held[1] and near < held[2]:
                held[1:] = n, near
    rows = [(w, *v) for w, v in found.items()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "best_n", "best"])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs, counts = [], {}
        rows = batch.to_pydict()
        for ends, short, more, long in zip(rows["ends"], rows["short"], rows["more"], rows["long"], strict=True):
            for part in (short, more, long):
                counts.update((w["word"], w["n"]) for w in part or ())
            pairs.extend(block_pairs(ends, *[p if p is None else [w["word"] for w in p] for p in (short, more, long)]))
        yield _best(pairs, counts)


# blocks


def _places(word: Column) -> Column:
    """The four blocks of a word as (ends, size, part, longer)."""

    def place(ends: bool, size: Column, longer: bool) -> Column:
        half = F.floor(size / 2).cast("int")
        first = F.substring(word, F.lit(1), half)
        last = F.substring(word, F.length(word) - (size - half) + 1, size - half)
        return F.struct(F.lit(ends).alias("ends"), size.alias("size"), (last if ends else first).alias("part"), F.lit(longer).alias("longer"))

    n = F.length(word)
    return F.array(*[place(ends, n - 1 if longer else n, longer) for ends in (False, True) for longer in (False, True)])


KEY = ["ends", "size", "part"]


def blocks_of(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of KEY, short, more, long: word lists whose near pairs are to be found."""
    placed = words.select("word", "n", F.explode(_places(F.col("word"))).alias("p")).select("p.*", F.struct("word", "n").alias("w"))
    counts = placed.groupBy(*KEY).agg(F.count("*").alias("c"), F.sum((~F.col("longer")).cast("long")).alias("shorts")).filter("c > 1 and shorts > 0").drop("shorts")
    counts = scratch.save(counts, "block_counts")
    chunks = F.ceil(F.col("c") * F.greatest(F.lit(1.0), F.col("size") / LONG) / block)
    large = counts.withColumn("chunks", chunks).filter("chunks > 1")
    # a block with few words is one list; larger ones are dealt into chunks by hash
    met = joins.weighted_join(placed, large, KEY, "c").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    met = met.withColumn("chunk", F.pmod(F.xxhash64("w.word"), F.col("chunks")))
    lists = met.groupBy(*KEY, "chunks", "chunk").agg(F.collect_list(F.when(~F.col("longer"), F.col("w"))).alias("short"), F.collect_list(F.when(F.col("longer"), F.col("w"))).alias("long"))
    lists = scratch.save(lists.filter((F.size("short") > 0) & (F.size("short") + F.size("long") > 1) | (F.col("chunks") > 1)), "blocks")
    none = F.lit(None).cast(dict(lists.dtypes)["short"])
    alone = lists.select(*KEY, "short", none.alias("more"), "long")
    cut = lists.filter("chunks > 1")
    other = cut.select(*KEY, F.col("chunk").alias("at"), F.col("short").alias("more"), F.col("long").alias("far"))
    empty = F.array().cast(dict(lists.dtypes)["short"])
    both = cut.drop("long").join(other, KEY).filter("chunk <> at")
    both = both.select(*KEY, "short", F.when(F.col("chunk") < F.col("at"), F.col("more")).otherwise(empty).alias("more"), F.col("far").alias("long"))
    return alone.unionByName(both)


def variants(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``words`` (word, n; a word once) as word, form, root, n, n_near, form_n."""
    scratch.bound_batches(words.sparkSession)
    words = words.select("word", "n")
    found = blocks_of(words, block).select("ends", "short", "more", "long").mapInArrow(_search, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    met = words.join(near, "word", "left")
    strong = -F.col("best.n") >= TIMES * F.col("n")
    met = met.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best.word")).alias("form"), F.when(strong, -F.col("best.n")).alias("form_n"))
    met = scratch.save(met, "forms")
    roots = roots_of(met.filter("form is not null").select("word", F.col("form").alias("root")))
    return met.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots_of(links: DataFrame) -> DataFrame:
    """word, root of each word that has a form; every round doubles the steps that a link spans."""
    held, before = scratch.save(links, "roots"), None
    while True:
        further = held.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not held.join(further, "root", "left_semi").limit(1).count():
            return held
        before, held = held, scratch.save(held.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        scratch.drop(before)


# words of documents


def counted_words(docs: DataFrame) -> DataFrame:
    """word, n: the runs of letters of all texts, some damaged by their crc32, with SHORTEST and FEWEST."""
    runs = F.regexp_extract_all("text", F.lit(rf"[A-Za-zÀ-ÿ]{{{SHORTEST},}}"), F.lit(0))
    run = F.col("run")
    plain = F.length(run) == F.octet_length(run)
    low = F.when(plain, F.lower(run)).otherwise(F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("run")).select("d", low.alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat_ws(":", "d", "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    damaged = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    word = F.when(F.col("h") % 31 == 0, damaged).otherwise(run)
    return rows.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter((F.col("n") >= FEWEST) & (F.length("word") >= SHORTEST))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return variants(scratch.save(counted_words(docs), "words"))


SQL = r"""
WITH RECURSIVE
k AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
t AS (SELECT DISTINCT d, run FROM r WHERE length(run) >= 7),
p AS (SELECT d, run, list_transform(string_split(d || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END) AS b FROM t),
h AS (SELECT d, run, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(b)), lambda x, y: xor(x >> 8, tbl[(xor(x, y) & 255) + 1])), 4294967295) AS h FROM p, k),
w AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM r JOIN h USING (d, run)),
c AS (SELECT word, count(*) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
x AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS v FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM c)),
e AS (SELECT a.word, b.word AS near, b.n AS m FROM x a JOIN x b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM x a JOIN c b ON a.v = b.word UNION SELECT b.word, a.word, a.n FROM x a JOIN c b ON a.v = b.word),
s AS (SELECT word, count(*) AS n_near, min(struct_pack(m := -m, near := near)) AS best FROM e GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 10 * n THEN best.near END AS form, CASE WHEN -best.m >= 10 * n THEN -best.m END AS form_n FROM c LEFT JOIN s USING (word)),
g AS (SELECT word, word AS root FROM f UNION ALL SELECT g.word, f.form FROM g JOIN f ON f.word = g.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, g.root, f.n, f.n_near, f.form_n FROM f JOIN g ON g.word = f.word JOIN f AS last ON last.word = g.root AND last.form IS NULL
"""
