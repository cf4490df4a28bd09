"""Operator 6: personal data by anchors that local parsers expand.

One Aho-Corasick pass over the whole text finds anchors: at-signs, plus-signs, digits, URL
schemes and cues of identifiers. At each anchor a parser expands to both sides, as far as the
grammar of its kind goes, and validates what it found. The four base kinds give exactly the
leftmost non-overlapping matches of their patterns; ``url`` and ``account`` spans come on top.

Cases. Null and empty texts have no spans. Spans of different kinds may overlap, those of one
kind never do. Rows are judged one by one, so ties and repeats need no rule. Other columns are
passed on; a column named ``spans`` is replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scratch

#: The base kinds in their order, then those that the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("account", "acct", "iban", "ssn", "passport", "token", "api_key", "apikey", "secret", "password")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL = re.compile(r"[^\x00-\x20<>\"'`{}|\\^]+")
HOST_SIGN = r"[^\x00-\x20<>\"'`{}|\\^/?#@"  # ends at the next slash, so no two hosts share a sign
HOST = re.compile(rf"(?:{HOST_SIGN}]*@)?{HOST_SIGN}:.]+(?:\.{HOST_SIGN}:.]+)+")
IDENTIFIER = re.compile(r"[\x20]{0,3}(?:number|no\.?|nr\.?)?[\x20]{0,3}[=:#]?[\x20]{0,3}[\"']?([A-Za-z0-9][A-Za-z0-9-]{5,})")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    """What starts a parser; schemes and cues in lower, upper and title case."""
    found = ahocorasick.Automaton()
    for sign in "@+0123456789":
        found.add_word(sign, ("digit" if sign.isdigit() else sign, 1))
    for kind, words in (("scheme", SCHEMES), ("cue", CUES)):
        for word in words:
            for form in {word, word.upper(), word.title(), word.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


class Spans:
    """The spans of one text, gathered anchor by anchor from left to right."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
        self.free = dict.fromkeys((*KINDS, "dotted", "chain"), 0)
        parsers = {"@": self.email, "+": self.phone, "digit": self.digit, "scheme": self.url, "cue": self.account}
        for end, (kind, size) in anchors().iter(text):
            parsers[kind](end - size + 1, end + 1)

    def add(self, kind: str, start: int, end: int) -> None:
        self.found[kind].append((start, end))

    def email(self, at: int, after: int) -> None:
        """To the left the local part, to the right labels and dots."""
        start = at
        while start > self.free["email"] and self.text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(self.text, after) if start < at else None
        if domain:
            self.free["email"] = domain.end()
            self.add("email", start, domain.end())

    def phone(self, at: int, after: int) -> None:
        match = PHONE.match(self.text, at)
        if match and 8 <= sum(c in "0123456789" for c in match[0]) <= 15:
            self.add("phone", at, match.end())

    def digit(self, at: int, after: int) -> None:
        """The first digit of a dotted row of numbers, of a chain of digits, or of both."""
        if at >= self.free["dotted"]:
            self.dotted(at)
        if at >= self.free["chain"]:
            chain = CHAIN.match(self.text, at)
            self.free["chain"] = chain.end()
            digits = chain[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                self.add("card", at, chain.end())

    def dotted(self, at: int) -> None:
        """Four numbers at a time; what fails the bound of 255 is dropped whole."""
        row = DOTTED.match(self.text, at)
        self.free["dotted"] = row.end()
        if "." not in row[0]:
            return
        numbers = list(DIGITS.finditer(self.text, at, row.end()))
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k : k + 4]
            if all(len(n) <= 3 and int(n) <= 255 for n in (m[0].lstrip("0") or "0" for m in four)):
                self.add("ip", four[0].start(), four[3].end())

    def url(self, at: int, after: int) -> None:
        """From the scheme to the last character that is not closing punctuation."""
        if at >= self.free["url"] and HOST.match(self.text, after):
            end = after + len(URL.match(self.text, after)[0].rstrip(".,;:!?)]"))
            self.free["url"] = end
            self.add("url", at, end)

    def account(self, at: int, after: int) -> None:
        """An identifier with at least four digits that stands right behind a whole cue."""
        if at < self.free["account"] or (at and self.text[at - 1].isalnum()):
            return
        match = IDENTIFIER.match(self.text, after)
        if match and match.start(1) > after and sum(c in "0123456789" for c in match[1]) >= 4:
            self.free["account"] = match.end(1)
            self.add("account", match.start(1), match.end(1))

    def rows(self) -> list[tuple[str, int, int]]:
        return [(kind, *span) for kind in KINDS for span in self.found[kind]]


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``spans``: kind, start, end in code points, end exclusive."""
    names = [n for n in docs.columns if n not in (text, "spans")]
    schema = T.StructType([*[docs.schema[n] for n in names], T.StructField("spans", SPAN)])

    scratch.bound_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), row, strict=True)) for row in Spans(t.as_py() or "").rows()] for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(spans, ARROW_SPAN)], names=[*names, "spans"])

    return docs.mapInArrow(run, schema)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    spans = F.col("spans")
    counts = [count_of(spans, kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))
