"""Operators of a training-data pipeline: scoring, rules, dedup, tokens, PII, WARC, mixing."""
