"""Operator 12: URL filters, with rules found by their rarest literal token.

A rule is a regular expression over ``host + path`` with the tokens (runs of ``[a-z0-9]``, A-Z
lower-cased) that every URL it can match has whole. The URLs' own token counts choose each rule's
rarest token, and the index leads from it to the rule. A URL's tokens fetch its candidate rules
and only those run their expressions; the strongest that matches decides. Rules by host and path
go before patterns, longer ones before shorter, equal ones by name; without a match a URL is
allowed.

Up to INLINE_RULES rules the index is a literal map, so URLs are judged where they are read. Larger
lists are a table: distinct URLs meet it by token, hot tokens by broadcast of their few rows, and
verdicts go back by URL. Both ways are columns and joins only, and both give the same rows.

Cases. A null URL, or one without ``://``, has an empty host and path and is judged by the rules
that need no token, else allowed. Repeated rows are judged each. An empty table gives an empty
result, no rules allow everything. Columns beside the URL are passed on, whatever their names;
only OUT is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import joins, scratch

INLINE_RULES = 100
OUT = ("host", "path", "rule", "verdict", "pattern")
ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = str.maketrans(UPPER, LOWER)
MATCH = "struct<place:int,name:string,verdict:string,expression:string,listed:boolean>"


@dataclass(frozen=True)
class Rule:
    """``expression`` over host + path, a Java regular expression; ``tokens`` stand whole in all it matches."""

    name: str
    verdict: str
    expression: str
    tokens: tuple[str, ...] = ()
    listed: bool = False


def tokens_in(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(_ASCII_LOWER))


def host_rule(verdict: str, host: str, path: str = "") -> Rule:
    """Fits ``host`` (lower case) and its subdomains, if the URL's path starts with ``path``."""
    end = "" if path else r"(?:/|\z)"
    whole = tokens_in(host) + tokens_in(re.sub("[a-zA-Z0-9]+$", "", path))  # the path's last token may go on
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host + path)}{end}", tuple(whole), True)


def host_words(verdict: str, *words: str) -> Rule:
    """Fits hosts with these words one behind another."""
    inner = "[^a-z0-9/]+".join(words)
    return Rule(" ".join(words), verdict, rf"^(?:[^/]*[^/a-z0-9])?{inner}(?:[^a-z0-9]|\z)", words)


#: The list of the contract.
RULES = (host_rule(ALLOW, "com", "/"), host_rule(BLOCK, "example.com", "/en/"), host_rule(ALLOW, "www.example.com", "/en/"), host_rule(BLOCK, "net", "/es/"), host_rule(BLOCK, "net", "/fr/"))
#: Hosts that no corpus wants, judged where no listed rule fits.
PATTERNS = (
    *(host_words(BLOCK, *w.split()) for w in ("cheap pills", "casino", "free bets", "adult", "porn", "spam", "ads", "viagra", "escort", "torrent")),
    Rule("login", BLOCK, r"/(?:wp-login|xmlrpc|signin)\.php(?:[^a-z0-9]|\z)", ("php",)),
    Rule("cart", BLOCK, r"/(?:cart|checkout|basket)(?:/|\z)", ()),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    both = F.coalesce(F.regexp_extract(rest, r"^[^?#]*", 0), F.lit(""))
    host = F.regexp_extract(both, "^[^/]*", 0)
    return F.translate(host, UPPER, LOWER), F.substring(both, F.length(host) + 1, F.length(both))


def _tokens(key: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(key, UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0)))


def ordered(rules: tuple[Rule, ...]) -> list[Rule]:
    """The strongest rule first: its place decides between rules that match."""
    return sorted(rules, key=lambda r: (not r.listed, -len(r.name) if r.listed else 0, r.name))


def token_counts(keys: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """How many keys have each of the rules' tokens; as many numbers as the rules have tokens."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    table = keys.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    tokens = keys.select(F.explode(_tokens(F.col("key"))).alias("token"))
    if len(wanted) <= joins.BROADCAST_ROWS:
        found = tokens.join(F.broadcast(table), "token", "left_semi").groupBy("token").count()
    else:  # what the tasks have counted meets the table, so no token is hot
        found = tokens.groupBy("token").count().join(table, "token", "left_semi")
    return dict(map(tuple, found.collect()))


def index_of(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str | None, list[tuple]]:
    """Rarest token -> rules as (place, name, verdict, expression, listed); None has those without a token."""
    index: dict[str | None, list[tuple]] = {}
    for place, r in enumerate(ordered(rules)):
        token = min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
        index.setdefault(token, []).append((place, r.name, r.verdict, r.expression, r.listed))
    return index


def _literal(rules: list[tuple]) -> Column:
    names = ("place", "name", "verdict", "expression", "listed")
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rules]).cast(f"array<{MATCH}>")


def _strongest(candidates: Column, key: Column) -> Column:
    """The match with the smallest place of those candidates whose expression fits."""
    return F.array_min(F.filter(candidates, lambda r: F.regexp_like(key, r["expression"])))


def inline_match(key: Column, tokens: Column, index: dict[str | None, list[tuple]]) -> Column:
    """The strongest matching rule, from an index that is part of the expression."""
    none = _literal([])
    always, keyed = _literal(index.get(None, [])), [(t, r) for t, r in index.items() if t is not None]
    if not keyed:
        return _strongest(always, key)
    table = F.create_map(*[x for t, r in keyed for x in (F.lit(t), _literal(r))])
    fetched = F.flatten(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, t), none)))
    return _strongest(F.concat(fetched, always), key)


def joined_matches(keys: DataFrame, index: dict[str | None, list[tuple]]) -> DataFrame:
    """``keys`` (key, n rows) with the strongest matching rule ``m``; keys without a match are left out."""
    rows = [(t, *r) for t, held in index.items() if t is not None for r in held]
    spark = keys.sparkSession
    entry = F.struct("place", "name", "verdict", "expression", "listed").cast(MATCH)
    table = spark.createDataFrame(rows, "token string, place int, name string, verdict string, expression string, listed boolean").groupBy("token").agg(F.collect_list(entry).alias("rules"))
    tokens = scratch.save(keys.select("key", F.explode(_tokens(F.col("key"))).alias("token")), "url_tokens")
    table = scratch.save(tokens.groupBy("token").agg(F.count("*").alias("n")).join(table, "token"), "url_rules")
    met = joins.weighted_join(tokens, table, ["token"], "n", "inner").select("key", _strongest(F.col("rules"), F.col("key")).alias("m"))
    always = keys.select("key", _strongest(_literal(index.get(None, [])), F.col("key")).alias("m"))
    best = met.unionByName(always).filter("m is not null").groupBy("key").agg(F.min("m").alias("m"))
    return best.join(keys, "key")


def judge(urls: DataFrame, rules: tuple[Rule, ...] = RULES + PATTERNS, url: str = "url", inline: int = INLINE_RULES) -> DataFrame:
    """``urls`` with OUT: ``rule`` is the listed rule that decided, ``pattern`` the pattern."""
    host, path = host_and_path(F.col(url))
    kept = [c for c in urls.columns if c.lower() not in OUT]
    rows = urls.select(F.struct(*kept).alias("row"), host.alias("host"), path.alias("path")).withColumn("key", F.concat("host", "path"))
    index = index_of(rules, token_counts(rows.select("key"), rules))
    if len(rules) <= inline:
        rows = rows.withColumn("m", inline_match(F.col("key"), _tokens(F.col("key")), index))
    else:
        keys = scratch.save(rows.groupBy("key").agg(F.count("*").alias("n")), "urls")
        matches = scratch.save(joined_matches(keys, index), "url_matches")
        rows = joins.weighted_join(rows, matches, ["key"], "n", "left")
    listed = F.col("m.listed")
    return rows.select(
        "row.*", "host", "path",
        F.when(listed, F.col("m.name")).alias("rule"), F.coalesce("m.verdict", F.lit(ALLOW)).alias("verdict"), F.when(~listed, F.col("m.name")).alias("pattern"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", *OUT)


def _sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    patterns = ", ".join(f"({i}, {text(r.name)}, {text(r.verdict)}, {text(r.expression)})" for i, r in enumerate(ordered(PATTERNS)))
    return rf"""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*', 0) ELSE '' END AS b FROM pages),
h AS (SELECT row_number() OVER () AS id, page_id, translate(regexp_extract(b, '^[^/]*', 0), '{UPPER}', '{LOWER}') AS host, substr(b, length(regexp_extract(b, '^[^/]*', 0)) + 1) AS path FROM u),
rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
listed AS (SELECT id, min(struct_pack(a := -length(r.host || r.path), name := r.host || r.path, verdict := r.verdict)) AS m
           FROM h JOIN rules r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path) GROUP BY id),
words(place, name, verdict, e) AS (VALUES {patterns}),
other AS (SELECT id, min(struct_pack(place := place, name := name, verdict := verdict)) AS w FROM h JOIN words ON regexp_matches(host || path, e) GROUP BY id)
SELECT page_id, host, path, m.name AS rule, coalesce(m.verdict, w.verdict, 'allow') AS verdict, CASE WHEN m IS NULL THEN w.name END AS pattern
FROM h LEFT JOIN listed USING (id) LEFT JOIN other USING (id)
"""


SQL = _sql()
