"""Tiers, folds, incremental work, packaging, repair and streams against literal expectations."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill import config, workspace
from voxmill.operators import cleanup, incremental, overlap, packaging, repair, segments, shards, speakers, tiering
from voxmill.sources import jsonl, media
from voxmill.streaming import stages

TIERS = (tiering.Tier("A", 0.05, 20.0, 3.0, 0.001, 1.0, 20.0, False), tiering.Tier("B", 0.15, 10.0, 2.5, 0.01, 1.0, 30.0, True))
SEGMENT = "cer double, duration double, clipping double, multi_speaker boolean, snr_db double, dnsmos double, text string"
BASE = {"cer": 0.01, "duration": 5.0, "clipping": 0.0, "multi_speaker": False, "snr_db": 30.0, "dnsmos": None, "text": "xin chào"}
CASES = [({}, "A"), ({"cer": 0.10}, "B"), ({"cer": 0.5}, "C"), ({"cer": None}, "C"), ({"multi_speaker": True}, "B"), ({"dnsmos": 2.0, "snr_db": 99.0}, "C"), ({"dnsmos": 3.5}, "A"), ({"duration": 25.0}, "B"), ({"text": " "}, "C"), ({"text": None}, "C"), ({"clipping": None}, "A")]


def test_tiers(spark):
    rows = [tuple({**BASE, **change}.values()) for change, _ in CASES]
    got = spark.createDataFrame(rows, SEGMENT).select(tiering.tier_of(TIERS).alias("t")).collect()
    assert [r.t for r in got] == [tier for _, tier in CASES]


def test_keep_and_split(spark):
    t = spark.createDataFrame([("A",), ("B",), ("C",)], "tier string")
    assert [r.tier for r in t.filter(tiering.is_kept(F.col("tier"))).collect()] == ["A", "B"]
    assert [r.tier for r in t.filter(tiering.is_kept(F.col("tier"), ["A"])).collect()] == ["A"]
    assert [r.tier for r in t.filter(tiering.is_kept(F.col("tier"), ["A", "B", "C"])).collect()] == ["A", "B"]
    names = spark.range(200).select(tiering.split_of(F.concat(F.lit("spk"), F.col("id").cast("string")), 0.1, 0.1).alias("s"))
    assert {r.s for r in names.distinct().collect()} == {"train", "val", "test"}


def test_totals_count_unknown_speakers_once(spark):
    rows = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 3.0)], "speaker_id string, duration double")
    assert tiering.totals(rows).first().n_speakers == 2


@pytest.mark.parametrize(("chunks", "want"), [([(0, 2), (2.5, 4)], [(0, 4)]), ([(0, 8), (9, 15)], [(0, 8), (9, 15)]), ([(0, 25)], [(0, 10), (10, 20), (20, 25)]), ([(0, 0.3)], []), ([(0, 25), (26, 29)], [(0, 10), (10, 20), (20, 29)])])
def test_merged_speech(spark, chunks, want):
    df = spark.createDataFrame([(1, float(a), float(b)) for a, b in chunks], "file_id int, start double, end double")
    got = segments.segments_of(df, 1.0, 10.0, 0.0).orderBy("seg_index").collect()
    assert [(r.start, r.end) for r in got] == want
    assert all(r.n_segments == len(want) for r in got)


def test_segments_of_many_and_of_unknown_intervals(spark, monkeypatch):
    monkeypatch.setattr(segments, "BATCH", 3)
    rows = [("a", float(2 * k), 2.0 * k + 1) for k in range(5000)] + [("b", 0.0, 25.0), ("b", None, 4.0), ("c", 1.0, float("inf")), (None, 0.0, 2.0)]
    got = segments.segments_of(spark.createDataFrame(rows, "file_id string, start double, end double"), 1.0, 10.0, 0.0).collect()
    a = sorted((r.seg_index, r.start, r.end, r.n_segments) for r in got if r.file_id == "a")
    assert a == [(k, 10.0 * k, 10.0 * k + 9, 1000) for k in range(1000)]
    assert sorted((r.file_id or "", r.seg_index, r.end, r.n_segments) for r in got if r.file_id != "a") == [("", 0, 2.0, 1), ("b", 0, 10.0, 3), ("b", 1, 20.0, 3), ("b", 2, 25.0, 3)]


def test_padding_and_ids(spark):
    df = spark.createDataFrame([("f", 0.05, 2.0)], "file_id string, start double, end double")
    r = segments.segments_of(df, 1.0, 10.0, 0.1).first()
    assert (r.start, r.id) == (0.0, "f_00000000_00002100")


def test_chunk_plan(spark):
    got = segments.chunk_plan(spark.createDataFrame([(10.0,), (8.4,), (0.2,)], "duration double"), 4.0).collect()
    assert sorted(r.chunk_seconds for r in got if r.duration == 10.0) == [2.0, 4.0, 4.0]
    assert sum(r.duration == 8.4 for r in got) == 2 and not any(r.duration == 0.2 for r in got)


def test_complete_files(spark):
    rows = [("1", "f1", 0, 3), ("2", "f1", 1, 3), ("3", "f1", 2, 3), ("4", "f2", 0, 2), ("5", "f3", 0, None)]
    df = spark.createDataFrame(rows, "id string, file_id string, seg_index int, n_segments int")
    assert {r.file_id for r in incremental.complete_files(df).collect()} == {"f1", "f3"}
    pending = df.filter("id <> '1'").select("id", "file_id", "n_segments")
    done = df.filter("id = '1'").groupBy("file_id").agg(F.count("*").alias("n_done"))
    assert {r.id for r in stages.ready_rows(pending, done).collect()} == {"2", "3", "5"}
    assert stages.ready_rows(pending, done, True).count() == 4


def test_first_by(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None)], "n int, t string")
    got = {(r.n, r.is_first) for r in incremental.first_by(df, F.sha1(F.coalesce("t", F.lit(""))), ["n"]).collect()}
    assert got == {(1, True), (2, False), (3, True), (4, True)}


def test_shards_restart_from_zero(spark):
    df = spark.createDataFrame([("a", k, 6) for k in range(5)] + [("b", 0, 50), ("b", 1, None)], "g string, n int, size int")
    got = {(r.g, r.n): r.shard for r in shards.assign(df, ["g"], "n", "size", 10).collect()}
    assert got == {("a", 0): 0, ("a", 1): 0, ("a", 2): 1, ("a", 3): 1, ("a", 4): 2, ("b", 0): 0, ("b", 1): 1}


def test_speakers(spark):
    rows = [("f", 1, [1.0, 0.0]), ("f", 2, [0.0, 1.0]), ("f", 3, [1.0, 0.05]), ("g", 9, [1.0, 1.0])]
    got = {r.id: r.speaker_id for r in speakers.clusters(spark.createDataFrame(rows, "file_id string, id int, embedding array<float>")).collect()}
    assert got == {1: "f_spk0", 2: "f_spk1", 3: "f_spk0", 9: "g_spk0"}
    turns = spark.createDataFrame([("s", "a", 1.0), ("s", "b", 3.0), ("s", "a", 1.5), ("t", "a", 1.0)], "segment string, speaker string, seconds double")
    assert {(r.segment, r.speaker, r.multi_speaker) for r in speakers.dominant(turns).collect()} == {("s", "b", True), ("t", "a", False)}


def test_speakers_of_large_files(spark, monkeypatch):
    monkeypatch.setattr(speakers, "TASK_ROWS", 12)
    rng = np.random.default_rng(3)
    files = {"a": rng.normal(size=(50, 8)), "b": rng.normal(size=(9, 8)), "c": rng.normal(size=(14, 8))}
    rows = [(f, 100 - k, [float(v) for v in x]) for f, xs in files.items() for k, x in enumerate(xs)]
    got = speakers.clusters(spark.createDataFrame(rows, "file_id string, id int, embedding array<float>"), 0.7).collect()
    want = {(f, 100 - k): f"{f}_spk{label}" for f, xs in files.items() for k, label in zip(range(len(xs))[::-1], speakers.average_linkage(xs[::-1].astype(np.float32).astype(float), 0.7), strict=True)}
    assert {(r.file_id, r.id): r.speaker_id for r in got} == want and len(got) == len(rows)


def test_speakers_of_several_blocks(spark, monkeypatch):
    """A block has several strips, a file several blocks, of more rows than a task clusters."""
    for name, rows in (("TASK_ROWS", 12), ("BLOCK_ROWS", 20), ("STRIP_ROWS", 6)):
        monkeypatch.setattr(speakers, name, rows)
    x = np.random.default_rng(5).normal(size=(70, 8)).astype(np.float32)
    rows = [("a", k, [float(v) for v in r]) for k, r in enumerate(x)]
    got = {r.id: r.speaker_id for r in speakers.clusters(spark.createDataFrame(rows, "file_id string, id int, embedding array<float>"), 0.7).collect()}
    assert got == {k: f"a_spk{label}" for k, label in enumerate(_literal_linkage(x.astype(float), 0.7))}


def _literal_linkage(x, threshold):
    """Labels by merging the nearest pair of the whole matrix again and again."""
    unit = speakers.units(x)
    apart, size, owner = 1 - unit @ unit.T, np.ones(len(x)), np.arange(len(x))
    np.fill_diagonal(apart, np.inf)
    while (least := apart.min()) < threshold:
        i, j = sorted(np.unravel_index(apart.argmin(), apart.shape))
        row = (apart[i] * size[i] + apart[j] * size[j]) / (size[i] + size[j])
        apart[i], apart[:, i], apart[i, i] = row, row, np.inf
        apart[j], apart[:, j] = np.inf, np.inf
        size[i], owner[owner == j] = size[i] + size[j], i
    assert least >= threshold
    names = {}
    return [names.setdefault(o, len(names)) for o in owner.tolist()]


def test_linkage_searches_no_whole_matrix():
    """The labels of the plain way, also among equal distances, without a search of all distances a step."""
    rng = np.random.default_rng(1)
    for n, kind in ((60, "plain"), (60, "grid"), (40, "copies")):
        x = rng.normal(size=(n, 6)) if kind == "plain" else rng.integers(-1, 2, size=(n, 3)).astype(float) + 0.0
        x = np.repeat(x[: n // 4], 4, axis=0) if kind == "copies" else x
        for threshold in (0.05, 0.5, 0.9):
            assert speakers.average_linkage(x, threshold).tolist() == _literal_linkage(x, threshold), (kind, threshold)


def test_overlap(spark):
    ours = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "x y")], "k int, t string")
    theirs = spark.createDataFrame([(7, "A, b c d e f! g h z"), (8, "q w e r t y u i o")], "k int, t string")
    index = overlap.index(overlap.tokenised(ours, F.col("k"), F.col("t")), 3)
    grams = overlap.probe_grams(overlap.tokenised(theirs, F.col("k"), F.col("t")), 3, 5)
    got = {r.key: (r.n_found, r.n_grams) for r in overlap.fractions(grams, index).collect()}
    assert got == {7: (6, 7), 8: (0, 7)}
    assert overlap.best_matches(overlap.fractions(grams, index).filter("frac > 0.5"), grams, index).first().ours == 1


@pytest.mark.parametrize("share", [1, 4, 1000])
def test_best_matches_of_hot_grams(spark, monkeypatch, share):
    """One n-gram that all texts of ours have, met whole or in pieces, against counting by hand."""
    monkeypatch.setattr(overlap, "HOT_SHARE", share)
    ours = [(k, "hot") for k in range(60)] + [(k, f"g{k % 7}") for k in range(60)] + [(3, "rare")]
    theirs = [(100, "hot"), (100, "hot"), (100, "g3"), (101, "g5"), (101, "rare"), (102, "none"), (103, "hot")]
    grams = spark.createDataFrame(theirs, "key int, gram string")
    index = spark.createDataFrame(ours, "key int, gram string")
    got = [tuple(r) for r in overlap.best_matches(grams.select("key").distinct(), grams, index, 3).select("key", "ours", "common", "place").collect()]
    want = []
    for key in range(100, 104):
        common = {}
        for gram in [g for k, g in theirs if k == key]:
            for text in [k for k, g in ours if g == gram]:
                common[text] = common.get(text, 0) + 1
        best = sorted(common.items(), key=lambda c: (-c[1], c[0]))[:3]
        want += [(key, text, n, place) for place, (text, n) in enumerate(best, 1)]
    assert sorted(got) == want
    hot = overlap.in_pieces(grams.select("gram", "key"), index.select("gram", F.col("key").alias("ours")))[1]
    assert hot.filter("gram = 'hot'").select("piece").distinct().count() > 1 or share == 1


@pytest.mark.parametrize("few", [0, 200_000])
def test_overlap_index_of_wanted_grams(spark, monkeypatch, few):
    monkeypatch.setattr(overlap, "FEW_GRAMS", few)
    ours = overlap.tokenised(spark.createDataFrame([(1, "a b c d a b c"), (2, "x y"), (3, None), (4, "c d e"), (5, "b c")], "k int, t string"), F.col("k"), F.col("t"))
    wanted = spark.createDataFrame([("a b c",), ("c d e",), ("d a x",), ("a b c",)], "gram string")
    assert {(r.key, r.gram) for r in overlap.index(ours, 3, wanted).collect()} == {(1, "a b c"), (4, "c d e")}
    assert overlap.index(ours, 3).count() == 5
    assert overlap.index(ours, 3, wanted.filter("false")).count() == 0


def packaged_rows(spark, n, first=0):
    rows = [(f"s{k:03d}", "f", f"spk{k % 5}", 0.01, 5.0, 0.0, False, 30.0, None, "chữ") for k in range(first, first + n)]
    return spark.createDataFrame(rows, "id string, file_id string, speaker_id string, " + SEGMENT)



def test_overlap_hands_little_to_python_at_once(spark, monkeypatch):
    """Batches of texts are small, and words are hashed in parts without losing an n-gram at a seam or taking one over two texts."""
    monkeypatch.setattr(overlap, "WORDS_AT_ONCE", 5)
    before = spark.conf.get(workspace.BATCH_CONF)
    try:
        spark.conf.set(workspace.BATCH_CONF, "64000000b")
        ours = {k: [f"w{(7 * k + j * j) % 23}" for j in range(size)] for k, size in enumerate((0, 2, 3, 17, 1, 40, 8))}
        rows = spark.createDataFrame([(k, " ".join(words)) for k, words in ours.items()], "k int, t string").coalesce(1)
        held = overlap.tokenised(rows, F.col("k"), F.col("t"))
        assert int(spark.conf.get(workspace.BATCH_CONF).rstrip("b")) <= workspace.BATCH_BYTES
        every = [w for words in ours.values() for w in words]
        asked = sorted({" ".join(every[k : k + 3]) for k in range(len(every) - 2)})  # those over two texts too
        got = overlap.index(held, 3, spark.createDataFrame([(g,) for g in asked], "gram string")).collect()
    finally:
        spark.conf.set(workspace.BATCH_CONF, before)
    want = {(k, " ".join(words[j : j + 3])) for k, words in ours.items() for j in range(len(words) - 2)}
    assert len(got) == len(want) and {(r.key, r.gram) for r in got} == want


def test_incremental_packaging(spark, tmp_path):
    data = packaging.Dataset(spark, f"file://{tmp_path}/d", TIERS)
    assert data.append(packaged_rows(spark, 3))["new"] == 3
    missing = spark.createDataFrame([("s003",)], "id string")
    assert data.append(packaged_rows(spark, 5), missing) == {"new": 1, "kept": 1, "skipped_missing": 1}
    assert data.append(packaged_rows(spark, 5))["new"] == 1
    assert data.append(packaged_rows(spark, 5)) == {"new": 0, "kept": 0, "skipped_missing": 0}
    assert data.manifest().count() == data.manifest().select("id").distinct().count() == data.metadata().count() == 5
    with pytest.raises(packaging.ConfigChanged):
        packaging.Dataset(spark, f"file://{tmp_path}/d", TIERS[:1]).append(packaged_rows(spark, 6))
    assert "By tier" in data.report(packaged_rows(spark, 5))


def test_crash_before_the_manifest(spark, tmp_path):
    import shutil

    data = packaging.Dataset(spark, f"file://{tmp_path}/d", TIERS)
    data.append(packaged_rows(spark, 3))
    shutil.rmtree(tmp_path / "d" / "manifest")
    assert data.append(packaged_rows(spark, 3))["new"] == 3
    assert data.metadata().count() == spark.read.parquet(data.part("data")).count() == 3


def test_reconciled_metadata_and_written_report(spark, tmp_path):
    import shutil

    data = packaging.Dataset(spark, f"file://{tmp_path}/d", TIERS)
    assert data.reconcile() == 0
    data.append(packaged_rows(spark, 3))
    first = next(p.name for p in (tmp_path / "d" / "manifest").iterdir() if p.name.startswith("batch="))
    data.append(packaged_rows(spark, 5))
    assert data.reconcile() == 0
    shutil.rmtree(tmp_path / "d" / "manifest" / first)  # these three are no longer done
    assert data.reconcile() == 3 and data.reconcile() == 0
    rows = spark.read.option("header", True).csv(data.part("metadata"))
    assert sorted((r.id, r.text, r.file_name) for r in rows.collect()) == [(f"s00{k}", "chữ", f"wav/train/s00{k}.wav") for k in (3, 4)]
    assert data.append(packaged_rows(spark, 5))["new"] == 3 and data.metadata().count() == 5
    for n in (5, 2):
        page = spark.read.text(data.write_report(packaged_rows(spark, n))).first()[0]
        assert f"<h2>Totals</h2><table><tr><th>n</th><th>hours</th><th>n_speakers</th></tr><tr><td>{n}</td>" in page
    shutil.rmtree(tmp_path / "d" / "manifest")
    assert data.reconcile() == 5


def test_rebuild_and_shards(spark, tmp_path):
    data = packaging.Dataset(spark, f"file://{tmp_path}/d", TIERS, shard_bytes=6)
    data.append(packaged_rows(spark, 5))
    files = spark.read.parquet(data.part("data")).withColumn("file", F.input_file_name()).groupBy("shard", "file").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert sorted((r.shard, r.n) for r in files) == [(0, 10), (1, 10), (2, 5)]  # texts of five bytes
    strict = packaging.Dataset(spark, f"file://{tmp_path}/d", TIERS, keep=["B"], shard_bytes=6)
    assert strict.rebuild(packaged_rows(spark, 7)) == {"new": 7, "kept": 0, "skipped_missing": 0}
    assert strict.manifest().count() == 7 and strict.append(packaged_rows(spark, 7))["new"] == 0
    assert [p.name for p in tmp_path.iterdir()] == ["d"]


def test_rewritten_manifest(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text('{"id": "a", "audio_path": "/old/a.wav"}\n{bad\n\n{"id": "c", "audio_path": "rel.wav", "more": 1}\n')
    where = f"file://{path}"
    assert repair.rewrite(spark, f"file://{tmp_path}/none") == (0, 0, 0)
    assert repair.rewrite(spark, where, ("/old", "/new")) == (2, 1, 1)
    assert {r.value for r in spark.read.text(where).collect()} == {'{"id": "a", "audio_path": "/new/a.wav"}', '{"id": "c", "audio_path": "rel.wav", "more": 1}'}
    assert repair.rewrite(spark, where, ("/old", "/new")) == (2, 0, 0)


def test_segments_of_times_too_large_to_cut(spark):
    """Nanoseconds since 1970: adding half a minute's number changes nothing, which is refused and does not hang."""
    rows = spark.createDataFrame([(1, 1.7e18, 1.7e18 + 1e6)], "file_id int, start double, end double")
    with pytest.raises(Exception, match="too coarse"):
        segments.segments_of(rows, 1.0, 30.0).collect()
    assert segments.segments_of(rows.select("file_id", (F.col("start") - 1.7e18).alias("start"), (F.col("end") - 1.7e18).alias("end")), 1.0, 30_000.0, 0.0).count() == 34


def test_repair_keeps_every_record(spark, tmp_path):
    """Only what is no JSON goes: a number written as text and fields of no schema stay, as they stood."""
    path, where = tmp_path / "m.jsonl", f"file://{tmp_path}/m.jsonl"
    lines = ['{"id": "a", "path": "/old/x\\u00e9", "extra": {"path": "/old/in", "n": [1, 2.50]}}', '{"id":"b","path":"/older/y","dur":"12s"}', "{broken", '{"id":  "c", "path": null}', '{"id": "d", "path": 7}']
    path.write_text("\n".join(lines) + "\n")
    assert repair.rewrite(spark, where, ("/old/", "/new"), dry_run=True) == (4, 1, 1) and path.read_text() == "\n".join(lines) + "\n"
    assert repair.rewrite(spark, where, ("/old/", "/new")) == (4, 1, 1)
    moved = '{"id": "a", "path": "/new/xé", "extra": {"path": "/old/in", "n": [1, 2.5]}}'
    assert [r.value for r in spark.read.text(where).collect()] == [moved, lines[1], lines[3], lines[4]]
    found = {r.id: r.dur for r in repair.records(repair.lines_of(spark, where), T.StructType([T.StructField("id", T.StringType()), T.StructField("dur", T.DoubleType())])).collect()}
    assert found == {"a": None, "b": None, "c": None, "d": None}


def test_replacement_that_breaks_off(spark, tmp_path, monkeypatch):
    """Whatever step fails, the old table or the new one is there whole, and the next start ends the work."""
    old, new = f"file://{tmp_path}/table", f"file://{tmp_path}/fresh"
    spark.range(3).write.parquet(old)
    spark.range(5).write.parquet(new)
    whole, steps = workspace._renamed, []

    def failing(store, source, target):
        steps.append(str(source))
        if str(source).endswith("fresh"):
            raise OSError("the rename failed")
        whole(store, source, target)

    monkeypatch.setattr(workspace, "_renamed", failing)
    with pytest.raises(OSError, match="rename failed"):
        workspace.replace(spark, new, old)
    assert spark.read.parquet(old).count() == 3 and spark.read.parquet(new).count() == 5 and not (tmp_path / "table.replaced").exists()
    monkeypatch.setattr(workspace, "recover", lambda *a: None)  # as if the process had died there
    with pytest.raises(OSError):
        workspace.replace(spark, new, old)
    assert not (tmp_path / "table").exists() and (tmp_path / "table.replaced").exists()
    monkeypatch.undo()
    workspace.recover(spark, old)
    assert spark.read.parquet(old).count() == 3
    workspace.replace(spark, new, old)
    assert spark.read.parquet(old).count() == 5 and sorted(p.name for p in tmp_path.iterdir()) == ["table"]


def test_ledgers_of_a_folder_and_its_subfolders(spark, tmp_path):
    for k, name in enumerate(("ledger.jsonl", "a/ledger.jsonl", "a/b/ledger.jsonl", "a/ledger2.jsonl")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f'{{"key": "k{k}", "path": "x{k}"}}\n{{bad\n{{"key": "m{k}", "path": "/y{k}"}}\n')
    got = {(r.key, r.path) for r in jsonl.ledgers(spark, f"file://{tmp_path}/", "key string, path string").collect()}
    assert got == {("k0", f"file://{tmp_path}/x0"), ("m0", "/y0"), ("k1", f"file://{tmp_path}/x1"), ("m1", "/y1")}
    assert jsonl.ledgers(spark, f"file://{tmp_path}/none", "key string, path string").count() == 0


def test_barrier_without_a_number(spark, tmp_path):
    schema = "file_id long, id long, n_segments long"
    spark.createDataFrame([(1, 1, 2), (1, 2, 2), (2, 3, 2), (3, 4, None)], schema).write.parquet(f"{tmp_path}/in")
    stream = stages.barrier(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r.file_id, r.id) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {(1, 1), (1, 2), (3, 4)}


def test_cleanup(spark, tmp_path):
    for name in ("a.wav", "b.wav"):
        (tmp_path / name).write_text("x")
    packaged = spark.createDataFrame([("C", f"file://{tmp_path}/a.wav"), ("A", f"file://{tmp_path}/b.wav"), ("C", "file:///elsewhere/c.wav"), ("C", f"file://{tmp_path}/gone.wav")], "tier string, audio_path string")
    files = cleanup.rejected_files(packaged, f"file://{tmp_path}")
    assert [(r.category, r.n) for r in cleanup.remove(files).collect()] == [("tier_c", 1)]
    assert [p.name for p in tmp_path.iterdir()] == ["b.wav"]


def test_finalised_and_verified(spark):
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id string")
    assert {r.id for r in incremental.finalised(ids("a", "b", "c"), ids("a", "b", "b"), ids("b")).collect()} == {"a"}
    first = spark.createDataFrame([("a", "xin chào"), ("b", "x")], "id string, text string")
    second = spark.createDataFrame([("a", "xin chề")], "id string, text string")
    rate = lambda x, y: F.levenshtein(x, y) / F.char_length(x)
    assert {r.id: (r.text_verify, r.cer) for r in incremental.verified(first, second, rate).collect()} == {"a": ("xin chề", 0.25), "b": (None, None)}
    assert [r.cer for r in incremental.verified(first, None, rate).collect()] == [None, None]


def test_config():
    assert config.merged({"a": {"x": 1, "y": 2}, "b": [1]}, {"a": {"y": 3}, "b": [2]}) == {"a": {"x": 1, "y": 3}, "b": [2]}
    assert config.config_hash({"A": 1, "B": 2}) != config.config_hash({"B": 2, "A": 1})


MANIFEST = T.StructType([T.StructField("id", T.StringType()), T.StructField("audio_path", T.StringType())])


def test_corrupt_manifests(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text('{"id": "a", "audio_path": "/old/a.wav"}\n{bad\n\n{"id": "c", "audio_path": "rel.wav"}\n{"id": "d"')
    assert [r.id for r in jsonl.read(spark, f"file://{path}", MANIFEST).orderBy("id").collect()] == ["a", "c"]
    assert jsonl.read(spark, f"file://{tmp_path}/none.jsonl", MANIFEST).count() == 0
    lines = repair.lines_of(spark, f"file://{path}")
    assert repair.counts(lines) == (2, 2, 0)
    assert repair.counts(lines, ("/old", "/new")) == (2, 2, 1)
    assert {r.audio_path for r in repair.records(repair.repaired(lines, ("/old", "/new")).withColumn("good", F.lit(True)), MANIFEST).collect()} == {"/new/a.wav", "rel.wav"}


def test_media_scan(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.MP3").write_bytes(b"one")
    (tmp_path / "a" / "x.json").write_text('{"feed": "f"}')
    (tmp_path / "y.wav").write_bytes(b"two")
    (tmp_path / "z.txt").write_bytes(b"no")
    rows = {r.source_path.rsplit("/", 1)[1]: r.source_meta for r in media.ingest(spark, f"file://{tmp_path}").collect()}
    assert rows == {"x.MP3": '{"feed": "f"}', "y.wav": None}
    assert [r.source_path.rsplit("/", 1)[1] for r in media.ingest(spark, f"file://{tmp_path}", 3600).collect()] == ["x.MP3"]
    assert media.directory_bytes(spark, f"file://{tmp_path}").first().bytes == 3 + 13 + 3 + 2


def test_stage_resumes(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"file://{tmp_path}/out"
    schema = "id long, v long"
    spark.createDataFrame([(1, 1), (2, 2), (2, 2)], schema).write.parquet(f"{source}/a")
    calls = []

    def double(df):
        calls.append(df.count())
        return df.withColumn("v", F.col("v") * 2)

    stage = stages.Stage(spark, out, double)
    stream = lambda: spark.readStream.schema(schema).parquet(f"{source}/*")
    stage.run(stream())
    spark.createDataFrame([(2, 9), (3, 3)], schema).write.parquet(f"{source}/b")
    stage.run(stream())
    stage.run(stream())
    assert calls == [2, 1]
    assert {(r.id, r.v) for r in stage.table().collect()} == {(1, 2), (2, 4), (3, 6)}


def test_gate():
    gate = stages.Gate(50, 10)
    assert [gate.blocked(x) for x in (20, 55, 30, 9, 20)] == [False, True, True, False, False]
