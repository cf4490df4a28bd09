"""Streaming replays of whole tables; each equals its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import workspace
from ..operators import packaging
from ..sources import tail
from ..streaming import batches, stages
from . import speech


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stream(spark, sf_dir, name):
    path = f"{sf_dir}/{name}.parquet"
    # as a pattern the path may name a file or a folder
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _finish(spark, stream, name):
    """Run a stream to its end and read what it wrote."""
    out = workspace.new_folder(spark, name)
    query = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def stream_dedup(spark, sf_dir):
    """The content hashes that a stream of documents has, each once."""
    keys = _stream(spark, sf_dir, "documents").select(F.sha1(F.coalesce("text", F.lit(""))).alias("key"))
    return _finish(spark, keys.dropDuplicates(["key"]), "stream_dedup")


def stream_barrier(spark, sf_dir):
    """Lines of orders that are complete: as many lines as the order's own number allows."""
    lines = _stream(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("file_id"), F.col("l_linenumber").cast("long").alias("id"), (F.col("l_orderkey") % 6 + 1).cast("long").alias("n_segments"))
    return _finish(spark, stages.barrier(lines), "stream_barrier")


def stream_stages(spark, sf_dir):
    """Events through two stages with checkpoints, run twice: the second run adds nothing."""
    source = _stream(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type", "value")
    path = workspace.new_folder(spark, "stream_stages")
    first = stages.Stage(spark, f"{path}/s0", lambda d: d.withColumn("seconds", 1 + F.col("value") / 6))
    second = stages.Stage(spark, f"{path}/s1", lambda d: d.withColumn("long", F.col("seconds") > 10))
    stages.run_chain(source, [first, second])
    return stages.run_chain(source, [first, second]).select("id", "seconds", "long")


def _replayed(spark, name, make, parts):
    """Run a stream over a growing folder, once after each part is there, from one checkpoint.

    Each run is one batch: with timers there always is another one to come, so a run for all that is
    available would not end.
    """
    out, schema = workspace.new_folder(spark, name), parts[0].schema
    for part in parts:
        part.write.mode("append").parquet(f"{out}/in")
        stream = make(spark.readStream.schema(schema).parquet(f"{out}/in"))
        query = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").outputMode("append").trigger(once=True).start()
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def ledger_tail(spark, sf_dir):
    """Events appended to growing ledgers in two rounds, read by a stream that starts again in between.

    After the first round each ledger ends in a line without an end, as a killed writer leaves it.
    """
    out = workspace.new_folder(spark, "ledger_tail")
    events = _read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.concat_ws("/", "event_type", F.col("event_id").cast("string")).alias("path"), F.col("user_id").cast("string").alias("source"))
    for part in (0, 1):
        tail.append(events.filter(F.col("id") % 2 == part), f"{out}/ledgers", "writer-{task}/ledger.jsonl", '{"id": 1, "pa' if part == 0 else "")
        stream = tail.ledgers(spark, f"{out}/ledgers", "id long, path string, source string")
        query = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    rows = spark.read.schema(stream.schema).parquet(f"{out}/rows")
    # the sink is at least once: a task that was tried again has written its lines twice
    return rows.dropDuplicates(["id"]).select("id", F.regexp_extract("path", "/ledgers/(.*)$", 1).alias("path"), "source")


def stream_barrier_end(spark, sf_dir):
    """Lines of orders through the barrier, rows of the first round again, and then the upstream's end."""
    lines = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("file_id"), F.col("l_linenumber").cast("long").alias("id"), (F.col("l_orderkey") % 6 + 1).cast("long").alias("n_segments"), F.lit(False).alias("end"))
    return _replayed(spark, "stream_barrier_end", stages.barrier, [lines, lines.filter("id < 3").unionByName(stages.file_ends(lines))])


def stream_batches(spark, sf_dir):
    """Events in batches of 32 by slot; the rest of each slot comes out at the upstream's end."""
    events = _read(spark, sf_dir, "events").select((F.col("event_id") % 16).alias("slot"), F.col("event_id").alias("id"), F.lit(False).alias("end"))
    rows = _replayed(spark, "stream_batches", lambda s: batches.micro_batches(s, 32, 3600), [events, batches.slot_ends(events, events.schema)])
    return rows.groupBy("slot", "batch").agg(F.count("*").alias("n"), F.count_if(F.col("id") % 16 == F.col("slot")).alias("own"))


def package_incremental(spark, sf_dir):
    """Segments packaged in two appends and a third that finds nothing; the manifest."""
    rows = speech.segments(spark, sf_dir)
    data = packaging.Dataset(spark, workspace.new_folder(spark, "package"), val=speech.VAL, test=speech.TEST, seed=speech.SEED)
    data.append(rows.filter("id % 2 = 0"))
    data.append(rows)
    data.append(rows)
    return data.manifest().select("id", "tier", "split")


def package_metadata(spark, sf_dir):
    """Counts by split and tier in the metadata of a packaged dataset."""
    data = packaging.Dataset(spark, workspace.new_folder(spark, "package"), val=speech.VAL, test=speech.TEST, seed=speech.SEED)
    data.append(speech.segments(spark, sf_dir))
    return data.metadata().groupBy("split", "tier").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (stream_dedup, stream_barrier, stream_barrier_end, stream_stages, stream_batches, ledger_tail, package_incremental, package_metadata)}
SQL = {
    "stream_dedup": "SELECT DISTINCT sha1(coalesce(text, '')) AS key FROM documents",
    "stream_barrier": "WITH o AS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) >= l_orderkey % 6 + 1) SELECT DISTINCT l_orderkey AS file_id, l_linenumber::BIGINT AS id FROM lineitem JOIN o USING (l_orderkey)",
    "stream_barrier_end": "SELECT DISTINCT l_orderkey AS file_id, l_linenumber::BIGINT AS id FROM lineitem",
    "stream_batches": "WITH s AS (SELECT event_id % 16 AS slot, (row_number() OVER (PARTITION BY event_id % 16 ORDER BY event_id) - 1) // 32 AS batch FROM events) SELECT slot, batch, count(*) AS n, count(*) AS own FROM s GROUP BY ALL",
    "ledger_tail": "SELECT event_id AS id, event_type || '/' || event_id AS path, user_id::VARCHAR AS source FROM events",
    "stream_stages": "SELECT event_id AS id, 1 + value / 6 AS seconds, 1 + value / 6 > 10 AS long FROM events",
    "package_incremental": f"WITH {speech.SEGMENTS_SQL} SELECT id, tier, split FROM split",
    "package_metadata": f"WITH {speech.SEGMENTS_SQL} SELECT split, tier, count(*) AS n FROM split WHERE tier <> 'C' GROUP BY ALL",
}
