"""The registered queries of operators 4, 5, 9 and 10, all columns of their contracts, against brute force."""

import hashlib
import re
import struct
import zlib

import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe
from tokenizers import Tokenizer

from voxmill.llm import registry

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return [(r.doc_id, r.text or "") for r in rows]


def rows_of(spark, small, name):
    return {r.doc_id: r for r in registry.QUERIES[name](spark, small).collect()}


def test_op4(spark, small, texts):
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = rows_of(spark, small, "op4_wavelet_shards")
    assert set(got) == {d for d, _ in texts}
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_op5(spark, small, texts):
    got, seen = rows_of(spark, small, "op5_substring_dedup"), set()
    for doc_id, text in texts:
        ws = WORDS.findall(text)
        gone = set()
        for k in range(len(ws) - 19):
            window = tuple(ws[k : k + 20])
            if window in seen:
                gone.update(range(k, k + 20))
            seen.add(window)
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        assert (got[doc_id].n_words, got[doc_id].n_removed, got[doc_id].kept_sha256) == (len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_op9(spark, small, texts):
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows_of(spark, small, "op9_byte_bpe")
    for doc_id, text in texts:
        ids = encoding.encode_ordinary(text)
        r = got[doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_op10(spark, small, texts):
    sets, root = {}, {d: d for d, _ in texts}
    for doc_id, text in texts:
        ws = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        sets[doc_id] = {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = rows_of(spark, small, "op10_ngram_tree_join")
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == {d: (len(sets[d]), find(d)) for d in ids}
