"""Operator 5 where rows share an id and differ in text."""

import random

from pyspark.sql import functions as F

from voxmill.llm import substring_dedup

WINDOW = substring_dedup.WINDOW


def brute(rows):
    """Kept words of each row: a window goes if its words start at a smaller (id, place)."""
    first = {}
    for doc_id, text in rows:
        ws = text.split()
        for k in range(len(ws) - WINDOW + 1):
            window = tuple(ws[k : k + WINDOW])
            first[window] = min(first.get(window, (doc_id, k)), (doc_id, k))
    out = []
    for doc_id, text in rows:
        ws = text.split()
        gone = set()
        for k in range(len(ws) - WINDOW + 1):
            if first[tuple(ws[k : k + WINDOW])] < (doc_id, k):
                gone.update(range(k, k + WINDOW))
        out.append((doc_id, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return out


def table(seed, base):
    """A few rows with words of their own; ids repeat, texts share passages at places that move."""
    rng = random.Random(seed)
    word = lambda: f"c{seed}w{rng.randrange(300)}"
    passages = [[word() for _ in range(rng.randrange(20, 45))] for _ in range(3)]
    rows = []
    for _ in range(rng.randrange(3, 9)):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            p = rng.choice(passages)
            parts += p[rng.randrange(5) : len(p) - rng.randrange(5)] if rng.random() < 0.7 else [word() for _ in range(rng.randrange(30))]
        rows.append((base + rng.randrange(4), " ".join(parts)))
    return rows + [rng.choice(rows)] * rng.randrange(2)


def test_repeated_ids_with_several_texts(spark):
    """The case of two texts under one id, and 1,000 random tables of their own words in one."""
    a, b = ([f"{x}{k}" for k in range(60)] for x in "ab")
    rows = [(7, " ".join(a)), (7, " ".join(b)), (8, " ".join(["x"] + a[10:50])), (9, " ".join(b[5:55]))]
    assert sorted(r[2] for r in brute(rows)) == [0, 0, 40, 50]
    for seed in range(1000):
        rows += table(seed, 100 + 10 * seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = substring_dedup.without_repeats(docs).select("doc_id", "n_words", "n_removed", F.col("kept").cast("string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))
