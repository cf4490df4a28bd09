"""Operator 2: quality rules judged by text and by host.

Each document gets counts over its whole text and two base rules. The failures are summed by
host (``source``) and each host's failure rate is shrunk by a beta prior fitted to all hosts. A
host loses all its documents if its shrunk rate stands out from the prior: more than DEVIATIONS
of the prior's standard deviations above its mean. The limit is never below MIN_RATE, so that a
host of mostly good documents stays however alike the others are, and never above MAX_RATE.

Cases. Null text counts as empty: no words, so the base rules reject it. A null host is no
host: such documents are judged by the base rules alone and have no part in the prior.
Repeated rows and repeated ids are judged row by row. An empty table gives an empty result.
With one host, or if no or every document fails, the prior has no spread: every rate is then
shrunk towards the common rate with the largest strength. Columns that the input has beside
``text`` and the host are passed on, whatever their names; only METRICS and ``base_failed`` are
replaced, and nothing is by ``keep_good``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import joins, scratch
from .words import SPACE_CHARS, words_of

SYMBOLS = "#*$%&|<>"
#: Lower bits of a sorted window that hold its place; longer texts sort whole hashes at once.
PLACE_BITS = 24
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Limits of the intra-class correlation that the moments give; 1/r - 1 is the prior's strength.
MIN_CORRELATION, MAX_CORRELATION = 1e-4, 0.99
#: When a host's shrunk failure rate stands out.
DEVIATIONS, MIN_RATE, MAX_RATE = 3.0, 0.25, 0.5


def repeated_line_count(text: Column) -> Column:
    """Lines that have a word and equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def with_repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """``df`` with the words inside 3-word windows that the text has twice or more.

    A window is known by a 64-bit hash of its words' hashes. The hashes' upper bits, each with its
    place in the lower ones, are sorted as plain numbers; only windows that agree with a
    neighbour there are sorted again with their whole hash. What is left are the places of
    repeated windows, and a pass over them in order adds up the words they cover. Each array is
    a column that several expressions use, so that no plan computes one inside a lambda.
    """
    low = (1 << PLACE_BITS) - 1
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    windows = F.transform("_h", lambda h, i: F.xxhash64(h, F.get("_h", i + 1), F.get("_h", i + 2)))
    df = df.withColumn("_g", F.slice(windows, 1, F.greatest(F.size("_h") - 2, F.lit(0))))
    df = df.withColumn("_k", F.sort_array(F.transform("_g", lambda g, i: g.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))))

    def upper(x: Column) -> Column:
        return F.shiftright(x, PLACE_BITS)

    near = F.filter("_k", lambda k, i: F.coalesce(upper(k) == upper(F.get("_k", i + 1)), F.lit(False)) | F.coalesce(upper(k) == upper(F.get("_k", i - 1)), F.lit(False)))
    some = F.transform(near, lambda k: k.bitwiseAND(F.lit(low)).cast("int"))
    places = F.when(F.size("_g") <= low, some).otherwise(F.sequence(F.lit(0), F.size("_g") - 1))
    df = df.withColumn("_c", F.when(F.size("_g") > 1, places).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_e", F.sort_array(F.transform("_c", lambda i: F.struct(F.get("_g", i).alias("h"), i.alias("i")))))
    twice = F.filter("_e", lambda e, i: F.coalesce(e["h"] == F.get("_e", i + 1)["h"], F.lit(False)) | F.coalesce(e["h"] == F.get("_e", i - 1)["h"], F.lit(False)))
    start = F.struct(F.lit(0).alias("covered"), F.lit(-3).alias("end"))
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda e: e["i"])),
        start,
        lambda a, i: F.struct((a["covered"] + 3 - F.greatest(a["end"] - i, F.lit(0))).alias("covered"), (i + 3).alias("end")),
        lambda a: a["covered"],
    )
    return df.withColumn(out, covered.cast("long")).drop("_h", "_g", "_k", "_c", "_e")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with METRICS and ``base_failed``; all native expressions over the whole text."""
    others = [c for c in docs.columns if c.lower() not in (*METRICS, "base_failed")]
    held = docs.select(F.struct(*others).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    held = held.withColumn("_w", words_of(F.col("_t")))
    held = held.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace("_t", f"[^{SYMBOLS}]+", "")).cast("long"),
        "n_dup_lines": repeated_line_count(F.col("_t")),
    })
    held = with_repeated_words(held, "_w", "n_repeat_words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # the fence is not deterministic, so no later filter is moved below it and computed there anew
    held = held.withColumns({"base_failed": failed, "_fence": F.monotonically_increasing_id()})
    return held.filter("_fence >= 0").select("_row.*", *METRICS, "base_failed")


def judge_hosts(measured: DataFrame, host: str = "source", deviations: float = DEVIATIONS, min_rate: float = MIN_RATE, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: ``host_docs``, ``host_failed``, ``host_rate`` (shrunk), ``host_kept``.

    The prior comes from the moments of the hosts' rates, weighted by their documents; only its
    numbers come to the driver.
    """
    hosts = measured.filter(F.col(host).isNotNull()).groupBy(F.col(host)).agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    d, f = F.col("host_docs"), F.col("host_failed")
    sums = hosts.agg(F.count("*").alias("k"), F.sum(d).alias("n"), F.sum(f).alias("f"), F.sum((f * f) / d).alias("ff"), F.sum((d * d).cast("double")).alias("nn"))
    mean = F.try_divide(F.col("f"), F.col("n"))
    noise = mean * (1 - mean)
    spread = F.col("ff") - F.col("f") * mean
    free = F.col("n") - F.try_divide(F.col("nn"), F.col("n")) - (F.col("k") - 1)
    raw = F.when((noise > 0) & (free > 0), (spread / noise - (F.col("k") - 1)) / free).otherwise(F.lit(0.0))
    kept = F.greatest(F.lit(MIN_CORRELATION), F.least(F.lit(MAX_CORRELATION), raw))
    outlier = F.coalesce(mean + deviations * F.sqrt(noise * kept), F.lit(0.0))  # a beta prior of size 1/r - 1
    limit = F.greatest(F.lit(min_rate), F.least(F.lit(max_rate), outlier))
    prior = sums.select(F.coalesce(mean, F.lit(0.0)).alias("mean"), (1 / kept - 1).alias("size"), limit.alias("limit")).first()  # three numbers
    rate = F.round((f + F.lit(prior["mean"]) * F.lit(prior["size"])) / (d + F.lit(prior["size"])), 6)
    judged = hosts.withColumn("host_rate", rate)
    return judged.select(host, "host_docs", "host_failed", "host_rate", (F.col("host_rate") <= F.lit(prior["limit"])).alias("host_kept"))


def apply_verdicts(measured: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """``measured`` with ``host_rate`` and ``kept``; null hosts have no verdict against them."""
    none = measured.filter(F.col(host).isNull()).withColumns({"host_rate": F.lit(None).cast("double"), "host_kept": F.lit(True)})
    some = joins.weighted_join(measured.filter(F.col(host).isNotNull()), hosts.select(host, "host_docs", "host_rate", "host_kept"), [host], "host_docs", "inner")
    both = some.drop("host_docs").unionByName(none)
    return both.withColumn("kept", ~F.col("base_failed") & F.col("host_kept")).drop("host_kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the metrics are written once, without the texts; hosts and verdicts come from there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    measured = scratch.save(measure(docs).drop("text"), "host_rules")
    hosts = scratch.save(judge_hosts(measured), "hosts")
    return apply_verdicts(measured, hosts).select("doc_id", *METRICS, "base_failed", "kept", "host_rate")


def keep_good(spark: SparkSession, docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that pass, with their own columns.

    Each text is measured once: the rows that pass are written beside the verdict on all, the
    hosts are judged from the narrow columns of that table, and rejected hosts meet its rows in
    a join that broadcasts them if they are few.
    """
    rows = measure(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"), F.col(host).alias("host")))
    rows = rows.select("host", "base_failed", F.when(~F.col("base_failed"), F.col("row")).alias("row"))
    held = scratch.save(rows, "measured")
    hosts = scratch.save(judge_hosts(held.select("host", "base_failed"), "host"), "hosts")
    return joins.keyed_filter(held.filter("not base_failed"), hosts.filter("not host_kept").select("host"), ["host"], "left_anti").select("row.*")


SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM g),
p AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM r, (SELECT unnest([0, 1, 2]) AS o) WHERE c >= 2 GROUP BY doc_id),
m AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN p USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*)::DOUBLE AS d, sum(base_failed::INT)::DOUBLE AS f FROM b WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT count(*) AS k, sum(d) AS n, sum(f) AS f, sum(f * f / d) AS ff, sum(d * d) AS nn FROM h),
c AS (SELECT *, greatest(0.25::DOUBLE, least(0.5::DOUBLE, mean + 3 * sqrt(mean * (1 - mean) * r))) AS lim FROM (SELECT f / n AS mean, greatest(0.0001, least(0.99, CASE WHEN f / n * (1 - f / n) > 0 AND n - nn / n - (k - 1) > 0
             THEN ((ff - f * (f / n)) / (f / n * (1 - f / n)) - (k - 1)) / (n - nn / n - (k - 1)) ELSE 0 END)) AS r FROM s)),
v AS (SELECT source, lim, round((h.f + mean * (1 / r - 1)) / (d + (1 / r - 1)), 6) AS host_rate FROM h, c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(host_rate <= lim, true) AS kept, host_rate
FROM b LEFT JOIN v USING (source)
"""
