"""Operators 11 to 13 against brute force: nulls, ties, repeated rows, hot keys, empty tables."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill.llm import conversation_repair, registry, spelling, url_rules

# 11: conversation repair

TURNS = "conv_id long, turn long, role string, text string"
VALID = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\x0b\x0c\r"


def brute_repair(rows):
    """Least (cost, audit) of one conversation by a forward search over whole audits, state by state."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        last = text.strip(SPACE)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    after_insert = {"": "u", "s": "u", "u": "a", "a": "u"}
    kept = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    best = {"": (0, "", ())}

    def better(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                to = after_insert[state]
                better(table, to, (cost + 3, audit + "I", (*lines, ({"u": "user", "a": "assistant"}[to], ""))))
        return table

    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for state, (cost, audit, lines) in inserted(dict(best)).items():
            better(new, state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            if (state, role[:1]) in kept:
                better(new, role[0], (cost + more, audit + "K", (*lines, (role, text))))
            to = after_insert[state]
            better(new, to, (cost + 3 + more, audit + "R", (*lines, ({"u": "user", "a": "assistant"}[to], text))))
        best = new
    cost, audit, lines = min(v for s, v in inserted(dict(best)).items() if s in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest(),
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
    }


def random_turns(rng, size):
    texts = ["Yes.", "No!", "Why?", "well", "", " \n", "Long one. ", "x" * 3000 + ".", None, "é.\x85"]
    roles = ["user", "assistant", "system", "tool", "", None, "unknown"]
    rows = [(rng.choice([None, *range(size)]) if rng.random() < 0.2 else k, rng.choice(roles[:3] if rng.random() < 0.8 else roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(3 * size)}" + rng.choice(".!x")) for k in range(size)]
    return rows + [rng.choice(rows) for _ in range(rng.randrange(3))] if rows else rows


def checked(spark, table, rows):
    audits, repaired = conversation_repair.repair(rows)
    got = {r.conv_id: r.asDict() for r in conversation_repair._by_conversation(audits, conversation_repair.digests(repaired)).collect()}
    assert set(got) == set(table)
    for conv, turns in table.items():
        want = brute_repair(turns)
        found = got[conv] | {"repaired_sha256": got[conv]["repaired_sha256"] or hashlib.sha256(b"").hexdigest()}
        assert {k: found[k] for k in want} == want, (conv, turns[:10])
    return audits, repaired


def test_repair_equals_brute_force(spark):
    rng = random.Random(3)
    table = {k: random_turns(rng, rng.randrange(1, 9)) for k in range(300)} | {None: random_turns(rng, 5)}
    rows = spark.createDataFrame([(c, *t) for c, turns in table.items() for t in turns], TURNS)
    audits, repaired = checked(spark, table, rows.withColumns({c: F.lit("mine") for c in ("id", "t", "m", "pid", "symbol", "audit")}))
    by = {}
    for r in repaired.collect():
        by.setdefault(r.conv_id, []).append(r)
    for lines in by.values():
        lines.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.old_role, r.t, r.k))
        assert VALID.match("".join(r.role[:1] for r in lines))


def test_one_conversation_over_many_partitions(spark):
    """A third of all rows and more in one conversation: it is cut, and its pieces are composed."""
    rng = random.Random(4)
    table = {7: random_turns(rng, 3000), 8: random_turns(rng, 40), 6: random_turns(rng, 2), 9: [(1, "user", "the same.")] * 400}
    rows = spark.createDataFrame([(c, *t) for c, turns in table.items() for t in turns], TURNS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        coded = conversation_repair.symbols_of(conversation_repair._named(rows))
        assert coded.filter("conv_id = 7").select("pid").distinct().count() > 2
        assert conversation_repair.cut_pieces(coded).filter("conv_id = 7").count() > 2
        checked(spark, table, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_blocks_equal_single_steps():
    """Every block's entry is what its symbols do one by one, and a cut anywhere changes nothing."""
    t, rng = conversation_repair.Tables(2), np.random.default_rng(5)
    for block in itertools.product(range(conversation_repair.SYMBOLS), repeat=2):
        number = block[0] * conversation_repair.SYMBOLS + block[1]
        for v in range(len(t.vectors)):
            assert t.blocks[v, number] == t.step[t.step[v, block[1]], block[0]]
    for _ in range(50):
        symbols = rng.integers(0, 12, rng.integers(2, 40))
        at = int(rng.integers(1, len(symbols)))
        whole = t.repaired(symbols)
        behind = t.effect(symbols[at:])[0][0]
        first, state = t.repaired(symbols[:at], behind)
        second, end = t.repaired(symbols[at:], 0, state)
        assert (first + second, end) == whole
        assert t.effect(symbols[:at])[1][behind][0] == state


def test_repair_of_no_rows(spark):
    audits, repaired = conversation_repair.repair(spark.createDataFrame([], TURNS))
    assert audits.count() == 0 and conversation_repair.digests(repaired).count() == 0


def test_damage_and_empty_conversations(spark, tmp_path):
    """Damage by crc32, and conversations that lose every row are still there."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {c} {t}.") for c in range(200) for t in range(c % 3 + 1)] + [(None, None, None, None)]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r.asDict() for r in conversation_repair.query(spark, str(tmp_path)).collect()}
    hurt = {}
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        hurt.setdefault(c, [])
        if fate:
            row = (t, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            hurt[c] += [row] * (2 if fate == 3 else 1)
    assert set(got) == set(hurt) and any(not v for v in hurt.values())
    for c, turns in hurt.items():
        want = brute_repair(turns) if turns else conversation_repair.NONE
        assert {k: got[c][k] for k in want} == want


# 12: URL rules

URLS = [
    "http://example.com/en/x", "https://a.EXAMPLE.com/en/", "http://example.com/en", "http://www.example.com/en/1?q=/en/", "http://m.www.example.com/en/#a", "http://notexample.com/en/a", "http://a.net/es/", "http://net/fr/x",
    "http://a.net/de/", "http://xnet/es/1", "ftp://a.com", "ftp://a.com/", "http://a.com?x=/", "no scheme", "", None, "x://", "http:///es/", "http://Casino-win.org/", "http://my.cheap-pills.org", "http://ads.net/es/a", "http://\u212aa.com/", "a://b://c.net/fr/",
    "http://ex.org/" + "/a" * 5000 + "/cart/", "http://x.org/wp-login.php", "http://a.net/ES/", "http://a.com\n.net/es/1", "http://a.net\n/es/1", "http://x.com:80/en/",
]


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(v, h, p) for v, h, p in (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def judged(df):
    return sorted(tuple(map(str, r)) for r in df.select("page_id", *url_rules.OUT).collect())


def test_url_rules_equal_brute_force(spark):
    rows = [(k, u) for k, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("mine") for c in ("row", "key", "m", "n", "token")})
    out = url_rules.judge(pages)
    assert [c for c in out.columns if c not in url_rules.OUT] == pages.columns
    for r in out.collect():
        host, path, rule, verdict = brute_url(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        assert r.verdict == (verdict or ("block" if r.pattern else "allow")) and (r.pattern is None or rule is None)
        assert r.key == "mine"
    by = {r.url: r.pattern for r in out.collect()}
    assert by["http://Casino-win.org/"] == "casino" and by["http://my.cheap-pills.org"] == "cheap pills" and by["http://x.org/wp-login.php"] == "login"
    assert by[URLS[23]] == "cart" and by["http://ads.net/es/a"] is None
    assert judged(url_rules.judge(pages, inline=0)) == judged(out)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(empty).count() == 0 and url_rules.judge(empty, inline=0).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, ()).collect()} == {"allow"}


def test_many_url_rules(spark):
    """Hundreds of random rules as a table give what the inline index and a plain search give."""
    rng = random.Random(6)
    labels, parts = ["a", "b", "com", "x-y", "é"], ["en", "e", "x1", "z"]
    rules = tuple({url_rules.host_rule(rng.choice(["allow", "block"]), ".".join(rng.choices(labels, k=rng.randrange(1, 4))), "/".join(["", *rng.choices(parts, k=rng.randrange(3))]) + rng.choice(["", "/"])) for _ in range(120)})
    rules = tuple({r.name: r for r in rules}.values())
    urls = [(k, "http://" + ".".join(rng.choices(labels, k=rng.randrange(1, 5))) + "/" + "/".join(rng.choices(parts, k=rng.randrange(4)))) for k in range(300)] + [(k, "http://a.com/") for k in range(300, 600)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    inline, table = judged(url_rules.judge(pages, rules, inline=1000)), judged(url_rules.judge(pages, rules, inline=0))
    assert inline == table and len({r[3] for r in inline}) > 10
    for k, url in urls[:300]:
        host, path, _, _ = brute_url(url)
        fits = [r for r in rules for h, p in [(r.name.split("/", 1)[0], r.name[len(r.name.split("/", 1)[0]) :])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = min((r.name for r in fits), key=lambda n: (-len(n), n), default=None)
        assert next(r[3] for r in inline if r[0] == str(k)) == str(want)


def test_rarest_token_leads_to_a_rule():
    rule = url_rules.host_rule("block", "big.example.com", "/en/rest")
    assert rule.tokens == ("big", "example", "com", "en")  # "rest" may go on
    assert list(url_rules.index_of((rule,), {"big": 9, "example": 9, "com": 90, "en": 2})) == ["en"]


# 13: spelling variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    out, forms = {}, {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * n else None
        out[w] = [forms[w], None, n, len(near), counts[forms[w]] if forms[w] else None]
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def random_words(rng, size):
    parts = ["th", "er", "on", "é", "an", "ß", "t"]
    counts = {}
    while len(counts) < size:
        w = "".join(rng.choices(parts, k=rng.randrange(4, 9)))
        if len(w) >= 7:
            counts[w] = rng.choice([2, 3, 5, 40, 400, 5000])
    return counts


@pytest.mark.parametrize("block", [spelling.BLOCK, 8])
def test_variants_equal_brute_force(spark, block):
    counts = random_words(random.Random(8), 500) | {"aaaaaaa": 3, "aaaaaaaa": 40, "aaaaaaaaa": 5000, "x" * 30000: 2, "x" * 29999 + "y": 20, "\U0001f600" + "z" * 7: 2, "z" * 7: 99}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("part", F.lit("mine")).withColumn("c", F.lit(1))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(words, block).collect()}
    assert got == brute_variants(counts)
    assert got["aaaaaaa"][1] == "a" * 9


def test_words_are_counted(spark):
    texts = [(1, "Tionsher tionsher"), (1, "Tionsher tionsher"), (2, None), (3, ""), (None, "Éclairée×7 éclairée_abcdefg"), (4, "short words only"), *[(k, "abcdefgh ABCDEFGH ÀBCDEFGÞ") for k in range(10, 80)]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit("x"))
    want = {}
    for d, text in texts:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{low}".encode())
            word = low[: h % len(low)] + low[h % len(low) + 1 :] if h % 31 == 0 else low
            want[word] = want.get(word, 0) + 1
    got = {r.word: r.n for r in spelling.counted_words(docs).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2 and len(w) >= 7}
    assert any(len(w) == 7 for w in got)


def test_variants_of_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0


# all three, as registered


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_url_rules", "op13_spelling_variants"])
def test_registered_query_equals_its_sql(spark, small, name):
    got = registry.QUERIES[name](spark, small).toPandas()
    con = duckdb.connect()
    for table in ("conversations", "pages", "documents"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    want = con.sql(registry.ORACLE_SQL[name]).df()[list(got.columns)]
    key = [c for c in got.columns if c in ("conv_id", "page_id", "word")]
    a, b = (x.sort_values(key).astype(object).where(x.notna(), None).reset_index(drop=True) for x in (got, want))
    assert a.map(str).replace(r"\.0$", "", regex=True).equals(b.map(str).replace(r"\.0$", "", regex=True))
