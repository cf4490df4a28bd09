"""The pipeline's stages against brute force."""

import hashlib
from collections import Counter

import corpus_pipeline as pipeline
from pyspark.sql import functions as F
from test_llm_operators import brute_components, brute_metrics, brute_mix, docs_of, words

from voxmill.llm import byte_bpe


def test_stages_equal_brute_force(spark):
    rows = [(k, " ".join(words(60 + k % 7, k, 400)), f"s{k % 3}") for k in range(40)]
    rows += [(100 + k, rows[k][1].replace(" ", "  ", 3), "s1") for k in range(10)]
    rows += [(200 + k, rows[k][1] + " more", "s2") for k in range(5, 15)]
    rows += [(300, "short", "s0"), (301, None, "s0"), (302, "again and " * 60, None)]
    docs, columns = docs_of(spark, rows), docs_of(spark, rows).columns
    left = []
    for doc_id, text, _ in rows:
        n, _, _, _, repeated = brute_metrics(text)
        if n >= 50 and 100 * repeated <= 50 * n:
            left.append((doc_id, text))
    out = pipeline.STAGES[0][1](spark, docs, "")
    assert out.columns == columns and sorted(r.doc_id for r in out.collect()) == sorted(d for d, _ in left)
    first = {}
    for doc_id, text in sorted(left):
        first.setdefault(" ".join(text.split()), (doc_id, text))
    out = pipeline.STAGES[1][1](spark, out, "")
    assert out.columns == columns and sorted(r.doc_id for r in out.collect()) == sorted(d for d, _ in first.values())
    component, _ = brute_components(list(first.values()))
    out = pipeline.STAGES[2][1](spark, out, "")
    kept = sorted(d for d, c in component.items() if d == c)
    assert out.columns == columns and sorted(r.doc_id for r in out.collect()) == kept
    out = pipeline.STAGES[3][1](spark, out, "")
    copies = Counter(r.doc_id for r in out.collect())
    mixed = [r for r in rows if r[0] in set(kept)]
    assert out.columns == columns and copies == Counter({r[0]: c for r, c in zip(mixed, brute_mix(mixed)[0], strict=True) if c})
    texts, own = dict(left), byte_bpe.codec(byte_bpe.VOCABULARY)
    got = pipeline.STAGES[4][1](spark, out, "").collect()
    assert Counter(r.doc_id for r in got) == copies
    assert all(r.ids_sha256 == hashlib.sha256(own.encode(texts[r.doc_id])).hexdigest() and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)


def test_run_of_hard_and_of_empty_tables(spark, tmp_path):
    """All stages with nulls, repeated rows, ids of no row, and columns with the operators' own names."""
    long = " ".join(words(400, 3, 300))
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, long + " x"), (4, " ".join(words(90, 4))), (5, long + " more", None), (6, "short")]
    docs = docs_of(spark, rows).withColumns({c: F.lit("mine") for c in ("row", "s", "size", "h", "n_words", "copies", "_id", "id")})
    for turn, part in enumerate((docs, docs.filter("doc_id > 100"))):
        part.write.parquet(f"{tmp_path}/{turn}/documents.parquet")
        left = part
        for _, stage in pipeline.STAGES[:-1]:
            left = stage(spark, left, "")
            assert left.columns == docs.columns and left.filter("row <> 'mine' or s <> 'mine' or h <> 'mine' or copies <> 'mine'").count() == 0
        got = Counter(r.doc_id for r in pipeline.run(spark, f"{tmp_path}/{turn}").collect())
        assert got == Counter(r.doc_id for r in left.collect()) and set(got) <= {None, 3, 4}
