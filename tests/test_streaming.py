"""Growing files, micro-batches by count or age, and the end of an upstream."""

import json
import time

import pytest
from pyspark.sql import functions as F

from voxmill.sources import tail
from voxmill.streaming import batches, stages


def drained(stream, out):
    query = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/rows").collect()


@pytest.mark.parametrize("piece", [tail.PIECE, 7])
def test_appended_lines_come_once(spark, tmp_path, piece):
    """Partial lines wait, corrupt ones go, and a stream that starts again goes on where it was."""
    path, out = tmp_path / "manifest.jsonl", tmp_path / "out"
    say = lambda k: json.dumps({"id": f"é{k}", "x": k}, ensure_ascii=False) + "\n"
    read = lambda: sorted(r.id for r in drained(tail.records(tail.lines(spark, str(path), piece=piece), "id string, x long"), out))
    path.write_text(say(1) + "\n" + say(2) + "{broken\n[1]\n7\n" + say(3)[:9], encoding="utf-8")
    assert read() == ["é1", "é2"]
    with path.open("a", encoding="utf-8") as f:
        f.write(say(3)[9:] + say(4) + '{"id": "')
    assert read() == ["é1", "é2", "é3", "é4"]
    assert read() == ["é1", "é2", "é3", "é4"]
    with path.open("a", encoding="utf-8") as f:
        f.write("é5" + "y" * 200_000 + '"}\n')
    assert [len(x) for x in read()] == [2, 2, 2, 2, 200_002]


def test_ledgers_of_subfolders(spark, tmp_path):
    """Ledgers of the folder and its direct subfolders, also those that come later; deeper ones don't count."""
    out, entry = tmp_path / "out", lambda i: json.dumps({"id": i, "path": f"{i}.mp3" if i % 2 else f"/abs/{i}.mp3"}) + "\n"
    read = lambda: {(r.id, r.path) for r in drained(tail.ledgers(spark, f"file://{tmp_path}/crawl", "id long, path string"), out)}
    (tmp_path / "crawl/a/b").mkdir(parents=True)
    assert read() == set()
    (tmp_path / "crawl/ledger.jsonl").write_text(entry(1))
    (tmp_path / "crawl/a/ledger.jsonl").write_text(entry(2))
    (tmp_path / "crawl/a/b/ledger.jsonl").write_text(entry(3))
    assert read() == {(1, f"{tmp_path}/crawl/1.mp3"), (2, "/abs/2.mp3")}
    (tmp_path / "crawl/c").mkdir()
    (tmp_path / "crawl/c/ledger.jsonl").write_text(entry(5))
    assert read() == {(1, f"{tmp_path}/crawl/1.mp3"), (2, "/abs/2.mp3"), (5, f"{tmp_path}/crawl/5.mp3")}


def test_append_heals_the_last_line(spark, tmp_path):
    rows = spark.range(10).coalesce(1)
    tail.append(rows, str(tmp_path), "all.jsonl", '{"id": 99')
    tail.append(rows, str(tmp_path), "all.jsonl")
    lines = (tmp_path / "all.jsonl").read_text().splitlines()
    assert lines[10] == '{"id": 99' and [json.loads(x)["id"] for x in lines[:10] + lines[11:]] == [*range(10), *range(10)]


def test_files_without_new_lines_are_not_read(tmp_path):
    reader = tail.LineTailReader({"path": str(tmp_path / "x")})
    assert reader.latestOffset() == {}
    (tmp_path / "x").write_bytes(b"a" * 3_000_000)
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []
    (tmp_path / "x").write_bytes(b"a" * 3_000_000 + b"\nb")
    assert list(reader.latestOffset().values()) == [3_000_001]


class Clock:
    """The state of one key under a clock that the test sets."""

    def __init__(self):
        self.held, self.now, self.timer = None, 0, None

    exists = property(lambda self: self.held is not None)
    get = property(lambda self: self.held)

    def update(self, value):
        self.held = value

    def getCurrentProcessingTimeMs(self):
        return self.now

    def setTimeoutDuration(self, ms):
        self.timer = self.now + ms


def test_batches_by_count_or_age():
    """Batches of three or after half a second: 3, then 1 by the timer, then 1 at the end."""
    import pandas as pd

    clock, sizes = Clock(), []

    def feed(now, *rows, end=False):
        clock.now = now
        part = pd.DataFrame({"row": [*rows, *(["end"] if end else [])], "end": [False] * len(rows) + [True] * end})
        sizes.extend((int(b["batch"].iloc[0]), b["row"].tolist()) for b in batches.step((0,), iter([part] if len(part) else []), clock, 3, 0.5))

    feed(0, "a", "b")
    assert sizes == [] and clock.timer == 500
    feed(100, "c", "d")
    assert sizes == [(0, ["a", "b", "c"])] and clock.timer == 600
    feed(599)
    assert len(sizes) == 1 and clock.timer == 600
    feed(600)
    assert sizes[1:] == [(1, ["d"])]
    feed(700, *"efghijk")
    assert sizes[2:] == [(2, ["e", "f", "g"]), (3, ["h", "i", "j"])] and clock.timer == 1200
    feed(800, end=True)
    assert sizes[4:] == [(4, ["k"])]
    feed(900, "l")
    assert sizes[5:] == [(5, ["l"])]


def test_timer_lets_rows_out(spark, tmp_path):
    """Two rows, far from a full batch, come out by the real timer of a running stream."""
    rows = spark.createDataFrame([(0, "x", 1.5), (0, None, None)], "slot long, name string, value double")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = batches.micro_batches(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), 10, 1.0)
    query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/rows").option("checkpointLocation", f"{tmp_path}/c").outputMode("append").trigger(processingTime="500 milliseconds").start()
    try:
        until = time.time() + 60
        while time.time() < until:
            found = spark.read.schema(stream.schema).parquet(f"{tmp_path}/rows").collect() if (tmp_path / "rows/_spark_metadata").exists() else []
            if found:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted((r.slot, r.batch, r.name or "", r.value or 0.0) for r in found) == [(0, 0, "", 0.0), (0, 0, "x", 1.5)]


def test_barrier_and_the_end_of_the_upstream(spark, tmp_path):
    schema = "file_id long, id long, n_segments long, end boolean"
    rounds = [
        [(1, 1, 2, False), (1, 2, None, False), (2, 1, 3, False), (3, 1, None, False), (4, None, 5, False), (4, 1, 5, False)],
        [(1, 2, 2, False), (2, 1, 3, False), (2, 2, None, False), (3, 1, None, False), (3, 2, 4, False)],
        [(2, 3, None, False), (4, 1, 5, False)],
    ]
    want = [{(1, 1), (1, 2), (3, 1)}, {(1, 1), (1, 2), (3, 1)}, {(1, 1), (1, 2), (3, 1), (2, 1), (2, 2), (2, 3)}]
    for rows, expected in zip(rounds, want, strict=True):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        got = [(r.file_id, r.id) for r in drained(stages.barrier(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")), tmp_path)]
        assert len(got) == len(set(got)) and set(got) == expected
    ends = stages.file_ends(spark.createDataFrame(sum(rounds, []), schema)).unionByName(spark.createDataFrame([(1, 1, 2, False), (2, 4, None, False)], schema))
    ends.write.mode("append").parquet(f"{tmp_path}/in")
    got = [(r.file_id, r.id) for r in drained(stages.barrier(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")), tmp_path)]
    assert len(got) == len(set(got)) and set(got) == want[-1] | {(3, 2), (4, 1), (2, 4)}


def test_barrier_calls_python_for_groups_of_files(spark, tmp_path, monkeypatch):
    """Files of one group keep apart, null's too, over restarts; states (and so calls) are as many as groups, not files."""
    monkeypatch.setattr(stages, "GROUPS", 2)
    schema, big = "file_id long, id long, n_segments long, end boolean", 2**60 + 1
    rounds = [
        [(f, i, f % 3 + 1, False) for f in range(300) for i in (1, 1, 2)] + [(None, big, 2, None), (big, big, None, None), (7, None, None, False)],
        [(f, 3, 1, False) for f in range(300) if f % 3 == 2] + [(None, big, 9, False), (None, 1, 9, False), (big, 1, 5, False)],
        [(big, 2, None, False), (None, None, None, True), (None, 5, None, False), (big, None, None, True), (5, 1, 3, False)],
    ]
    seen, known = {}, []
    for rows in rounds:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        got = [(r.file_id, r.id) for r in drained(stages.barrier(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")), tmp_path)]
        for f, i, n, end in rows:
            ids, number, ended = seen.get(f, (set(), None, False))
            if i is not None and not end:
                ids, number = ids | {i}, n if number is None else number
            seen[f] = ids, number, ended or bool(end)
        known += [(f, i) for f, (ids, number, ended) in seen.items() for i in ids if (ended or number is None or len(ids) >= number) and (f, i) not in known]
        assert len(got) == len(set(got)) and set(got) == set(known)
    states = spark.read.format("statestore").load(f"{tmp_path}/checkpoint")
    assert states.count() == 3


def test_barrier_makes_few_calls_and_keeps_its_groups(spark, tmp_path, monkeypatch):
    """Many files are dealt to no more than 512 states, and a checkpoint is not resumed with another number of groups."""
    files = spark.range(20_000).selectExpr("id AS file_id", "CAST(1 AS LONG) AS id", "CAST(1 + id % 2 AS LONG) AS n_segments", "false AS end")
    files.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(files.schema).parquet(f"{tmp_path}/in")
    assert len(drained(stages.barrier(stream), tmp_path)) == 10_000
    assert spark.read.format("statestore").load(f"{tmp_path}/checkpoint").count() <= 512
    monkeypatch.setattr(stages, "GROUPS", 7)
    files.limit(100).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    with pytest.raises(Exception, match="began with"):
        drained(stages.barrier(stream), tmp_path)
