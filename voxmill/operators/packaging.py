"""Datasets on disk: built whole, or appended to batch by batch with exact resume.

A dataset is a folder with ``data`` (parquet by split and batch), ``metadata`` (csv by batch),
``manifest`` (what was decided for every row, kept or not) and the hash of its configuration.
A batch is committed in the order data, metadata, manifest; its key comes from its ids, so a
batch that broke off is written to the same places again.
"""

from __future__ import annotations

import html
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import workspace
from ..config import config_hash
from . import shards, tiering

METADATA = ("file_name", "id", "text", "speaker_id", "duration", "snr_db", "cer", "tier", "split")


#: Bytes of media after which a parquet shard is full.
SHARD_BYTES = 500 << 20


class ConfigChanged(ValueError):
    """The dataset was built with another configuration."""


def decided(rows: DataFrame, tiers: Sequence[tiering.Tier], val: float, test: float, seed: int) -> DataFrame:
    """``rows`` with tier, split and file name."""
    key = F.coalesce("speaker_id", F.col("file_id").cast("string"))
    held = rows.withColumn("tier", tiering.tier_of(tiers)).withColumn("split", tiering.split_of(key, val, test, seed))
    return held.withColumn("file_name", F.concat(F.lit("wav/"), F.col("split"), F.lit("/"), F.col("id").cast("string"), F.lit(".wav")))


def batch_key(rows: DataFrame) -> str:
    """The same for the same ids, in whatever order."""
    n, mixed = rows.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("id")), F.lit(0))).first()
    return f"{n}-{mixed & (1 << 64) - 1:016x}"


class Dataset:
    """A packaged dataset at ``path``."""

    def __init__(self, spark: SparkSession, path: str, tiers: Sequence[tiering.Tier] = tiering.DEFAULT_TIERS, keep: Sequence[str] | None = None, val: float = 0.0, test: float = 0.0, seed: int = 42, media: str = "audio", shard_bytes: int = SHARD_BYTES) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.tiers, self.keep, self.val, self.test, self.seed = tuple(tiers), keep, val, test, seed
        self.media, self.shard_bytes = media, shard_bytes
        self.hash = config_hash([[t.__dict__ for t in self.tiers], list(keep or ()), val, test, seed])

    def part(self, name: str) -> str:
        return f"{self.path}/{name}"

    def check_config(self) -> None:
        """Refuse to append to a dataset that other rules made; remember ours if there is none."""
        workspace.recover(self.spark, self.path)
        workspace.recover(self.spark, self.part("metadata"))
        if workspace.exists(self.spark, self.part("config")):
            if self.spark.read.text(self.part("config")).first()[0] != self.hash:
                raise ConfigChanged("tiers, keep or split differ from those of the dataset")
        else:
            self.spark.createDataFrame([(self.hash,)], "value string").coalesce(1).write.text(self.part("config"))

    def manifest(self) -> DataFrame | None:
        return self.spark.read.parquet(self.part("manifest")) if workspace.exists(self.spark, self.part("manifest")) else None

    def metadata(self) -> DataFrame:
        """Metadata of committed batches; what a broken-off batch left has no manifest."""
        rows = self.spark.read.option("header", True).csv(self.part("metadata"))
        done = self.manifest().select("batch").distinct()
        return rows.join(done, "batch", "left_semi")

    def reconcile(self) -> int:
        """Remove metadata of ids that no manifest row names; how many went.

        Rows of a batch that broke off before its manifest, or whose ids were taken from the manifest
        since, go; the rest are written beside the old metadata and take their place when they are whole.
        """
        place = self.part("metadata")
        workspace.recover(self.spark, place)
        if not workspace.exists(self.spark, place):
            return 0
        rows, manifest = self.spark.read.option("header", True).csv(place), self.manifest()
        if "batch" not in rows.columns:  # no batch has a row
            return 0
        done = rows.select("id").limit(0) if manifest is None else manifest.select(F.col("id").cast("string"))
        removed = rows.join(done, "id", "left_anti").count()
        if removed:
            fresh = f"{place}.rewrite-{uuid.uuid4().hex}"
            rows.join(done, "id", "left_semi").select(*METADATA, "batch").write.partitionBy("batch").option("header", True).csv(fresh)
            workspace.replace(self.spark, fresh, place)
        return removed

    def append(self, rows: DataFrame, missing: DataFrame | None = None) -> dict[str, int]:
        """Package what is not packaged yet; rows in ``missing`` (id) wait for their media."""
        self.check_config()
        manifest = self.manifest()
        new = rows if manifest is None else rows.join(manifest.select("id"), "id", "left_anti")
        waiting = 0
        if missing is not None:
            waiting = new.join(missing.select("id").distinct(), "id", "left_semi").count()
            new = new.join(missing.select("id").distinct(), "id", "left_anti")
        new = decided(new.dropDuplicates(["id"]), self.tiers, self.val, self.test, self.seed)
        batch = batch_key(new)
        if batch.startswith("0-"):
            return {"new": 0, "kept": 0, "skipped_missing": waiting}
        kept = self.sharded(new.filter(tiering.is_kept(F.col("tier"), self.keep)).withColumn("batch", F.lit(batch)))
        place = ["split", "batch", "shard"]
        kept.repartition(*place).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*place).parquet(self.part("data"))
        kept.select(*METADATA).write.mode("overwrite").option("header", True).csv(f"{self.part('metadata')}/batch={batch}")
        new.select("id", "tier", "split").write.mode("overwrite").parquet(f"{self.part('manifest')}/batch={batch}")
        n, n_kept = self.spark.read.parquet(f"{self.part('manifest')}/batch={batch}").agg(F.count("*"), F.coalesce(F.sum(tiering.is_kept(F.col("tier"), self.keep).cast("int")), F.lit(0))).first()
        return {"new": n, "kept": n_kept, "skipped_missing": waiting}

    def sharded(self, kept: DataFrame) -> DataFrame:
        """``kept`` with its shard: rows in the order of ids, cut when they have SHARD_BYTES.

        Shards are cut on ids and sizes alone. What goes back to the rows are the shards' first ids, one
        array for each split of a batch and one id for every SHARD_BYTES, so media are not moved here
        and cross one shuffle in all, that of the write.
        """
        size = F.octet_length(self.media) if self.media in kept.columns else F.octet_length(F.coalesce("text", F.lit("")))
        narrow = kept.select("split", "batch", "id", size.alias("bytes"))
        cut = shards.assign(narrow, ["split", "batch"], "id", "bytes", self.shard_bytes)
        firsts = cut.groupBy("split", "batch", "shard").agg(F.min("id").alias("first")).groupBy("split", "batch").agg(F.array_sort(F.collect_list("first")).alias("_firsts"))
        firsts = workspace.saved(firsts, "shard_firsts")
        shard = (F.size(F.filter("_firsts", lambda first: first <= F.col("id"))) - 1).cast(dict(cut.dtypes)["shard"])
        return kept.join(F.broadcast(firsts), ["split", "batch"]).withColumn("shard", shard).drop("_firsts")

    def rebuild(self, rows: DataFrame, missing: DataFrame | None = None) -> dict[str, int]:
        """Package everything anew by the rules that hold now, whatever was there before.

        The new dataset is built beside the old one and takes its place when it is whole.
        """
        fresh = Dataset(self.spark, f"{self.path}.rebuild-{uuid.uuid4().hex}", self.tiers, self.keep, self.val, self.test, self.seed, self.media, self.shard_bytes)
        done = fresh.append(rows, missing)
        workspace.replace(self.spark, fresh.path, self.path)
        return done

    def report(self, rows: DataFrame) -> str:
        """An HTML page with the totals of what is kept and the tables by tier and by split."""
        held = decided(rows, self.tiers, self.val, self.test, self.seed)
        kept = held.filter(tiering.is_kept(F.col("tier"), self.keep))
        tables = {"Totals": tiering.totals(kept), "By tier": tiering.by_tier(held).orderBy("tier"), "By split": tiering.by_split(kept)}
        parts = []
        for name, df in tables.items():  # a handful of rows each
            cells = "".join("<tr>" + "".join(f"<td>{'-' if v is None else f'{v:.2f}' if isinstance(v, float) else html.escape(str(v))}</td>" for v in row) + "</tr>" for row in df.collect())
            parts.append(f"<h2>{name}</h2><table><tr>{''.join(f'<th>{c}</th>' for c in df.columns)}</tr>{cells}</table>")
        return f"<html><body>{''.join(parts)}</body></html>"

    def write_report(self, rows: DataFrame) -> str:
        """Write the report beside the data, in place of an earlier one; its folder."""
        place = self.part("report")
        fresh = f"{place}.new-{uuid.uuid4().hex}"
        self.spark.createDataFrame([(self.report(rows),)], "value string").coalesce(1).write.text(fresh)
        workspace.replace(self.spark, fresh, place)
        return place
