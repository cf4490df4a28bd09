"""Manifests in JSON lines: what is no JSON goes, and moved paths are rewritten in their lines."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import workspace

#: The fields that hold paths of a manifest and of a ledger.
FIELDS = ("audio_path", "path")


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``value``: every non-blank line; ``good``: whether it is JSON, whatever its fields and their types."""
    rows = spark.read.text(path).filter(F.trim("value") != "")
    return rows.withColumn("good", F.try_parse_json("value").isNotNull())


def records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The good lines' records; a field that does not fit the schema is null, and the rest stays."""
    return lines.filter("good").select(F.from_json("value", schema).alias("r")).select("r.*")


def _moves(relocate: tuple[str, str] | None, fields: tuple[str, ...]) -> Column:
    """Whether a good line has a path below the old root."""
    found = F.lit(False)
    for name in fields if relocate else ():
        place = F.get_json_object("value", f"$['{name}']")
        found = found | F.coalesce(F.startswith(place, F.lit(relocate[0].rstrip("/") + "/")), F.lit(False))
    return F.col("good") & found


def _rewritten(relocate: tuple[str, str], fields: tuple[str, ...]):
    """A column function over (line, whether it moves): the line with its paths below the new root, all else as it was."""
    old, new = (root.rstrip("/") + "/" for root in relocate)

    def one(line: str, moves: bool) -> str:
        record = json.loads(line) if moves else None
        if not isinstance(record, dict):
            return line
        for name in fields:
            if isinstance(record.get(name), str) and record[name].startswith(old):
                record[name] = new + record[name][len(old) :]
        return json.dumps(record, ensure_ascii=False)

    @F.pandas_udf(T.StringType())
    def run(lines: pd.Series, moves: pd.Series) -> pd.Series:
        return pd.Series([one(*x) for x in zip(lines, moves, strict=True)], dtype=object)

    return run


def repaired(lines: DataFrame, relocate: tuple[str, str] | None = None, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The good lines, with ``moved`` where a path was rewritten; the others are as they stood."""
    good = lines.filter("good").withColumn("moved", _moves(relocate, fields))
    return good.select((_rewritten(relocate, fields)("value", "moved") if relocate else F.col("value")).alias("value"), "moved")


def counts(lines: DataFrame, relocate: tuple[str, str] | None = None, fields: tuple[str, ...] = FIELDS) -> tuple[int, int, int]:
    """Kept, bad and moved, in one pass."""
    return tuple(lines.agg(F.count_if("good"), F.count_if(~F.col("good")), F.count_if(_moves(relocate, fields))).first())


def rewrite(spark: SparkSession, path: str, relocate: tuple[str, str] | None = None, fields: tuple[str, ...] = FIELDS, dry_run: bool = False) -> tuple[int, int, int]:
    """Put a manifest without corrupt lines, and with moved paths, in the place of the old one.

    Kept, bad and moved, as ``counts``. Only what is no JSON is dropped, and lines keep all their
    fields. No file is nothing to do, nor is a manifest without faults, nor a dry run.
    """
    workspace.recover(spark, path)
    if not workspace.exists(spark, path):
        return 0, 0, 0
    lines = lines_of(spark, path)
    kept, bad, moved = counts(lines, relocate, fields)
    if (bad or moved) and not dry_run:
        repaired(lines, relocate, fields).select("value").write.mode("overwrite").text(f"{path}.repair")
        workspace.replace(spark, f"{path}.repair", path)
    return kept, bad, moved
