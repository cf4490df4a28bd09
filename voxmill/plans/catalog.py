"""The library's own queries by name, with the SQL of those that SQL can express."""

from __future__ import annotations

from . import records, sequences, sounds, speech, streams, texts

QUERIES = speech.QUERIES | records.QUERIES | texts.QUERIES | sequences.QUERIES | streams.QUERIES | sounds.QUERIES
ORACLE_SQL = speech.SQL | records.SQL | texts.SQL | sequences.SQL | streams.SQL | sounds.SQL
