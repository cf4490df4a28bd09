"""Media extraction and sidecars."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill.operators import extraction, signals


def test_extraction(spark, tmp_path):
    schema = "id int, audio struct<bytes:binary,path:string>, sentence string, shard int, row int"
    rows = [(1, (b"RIFFxxxx", "/a/Tập 1.wav"), "một", 0, 0), (2, (b"\xff\xfbzz", None), None, 0, 1), (3, (b"", "x"), "no", 0, 2), (4, None, "no", 0, 3)]
    df = spark.createDataFrame(rows, schema)
    meta = extraction.write_files(extraction.planned(df), f"file://{tmp_path}/wav").collect()
    assert {(r.file_name, r.text) for r in meta} == {("Tập_1.wav", "một"), ("shard00000_row000001.mp3", "")}
    assert (tmp_path / "wav" / "Tập_1.wav").read_bytes() == b"RIFFxxxx"
    with pytest.raises(ValueError):
        extraction.audio_column(df.drop("audio").schema)


def test_names_that_clash_limits_and_metadata(spark, tmp_path):
    """Equal names are told apart by their place, failures are counted, and metadata.csv names what is there."""
    wav = signals.encode_wav(np.full(100, 0.5), 8000)
    schema = "audio struct<bytes:binary,path:string>, text string, shard int, row int"
    rows = [((wav, f"/x{k}/same.wav"), f'say "{k}", twice', 0, k) for k in range(5)] + [((b"RIFFbad", "bad.wav"), "no", 1, 0), ((b"", "empty"), "no", 1, 1), (None, "no", 1, 2), ((wav, "last.wav"), None, 1, 3)]
    df = spark.createDataFrame(rows, schema)
    resampled = lambda content: signals.encode_wav(signals.decode_wav(content)[0][:10], 8000)
    assert extraction.extract(df, f"file://{tmp_path}/all", encode=resampled) == {"files": 6, "errors": 3}
    names = {"same.wav", "last.wav", *(f"same_shard00000_row00000{k}.wav" for k in range(1, 5))}
    assert {p.name for p in (tmp_path / "all").glob("*.wav")} == names and not list((tmp_path / "all").glob("*.part"))
    meta = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/all/metadata.csv").collect()
    assert {r.file_name for r in meta} == names and {r.text for r in meta if r.file_name == "same.wav"} == {'say "0", twice'}
    assert extraction.extract(df, f"file://{tmp_path}/few", limit=3) == {"files": 3, "errors": 0}
    assert {p.name for p in (tmp_path / "few").glob("*.wav")} == {"same.wav", "same_shard00000_row000001.wav", "same_shard00000_row000002.wav"}
    (tmp_path / "in/b").mkdir(parents=True)
    for name in ("z.parquet", "b/a.parquet", "b/c.json"):
        (tmp_path / "in" / name).write_bytes(b"x")
    assert [r.path.rsplit("/in/", 1)[1] for r in extraction.parquet_files(spark, f"file://{tmp_path}/in").collect()] == ["b/a.parquet", "z.parquet"]
    assert extraction.parquet_files(spark, f"file://{tmp_path}/in", 1).count() == 1


def test_sidecar(spark):
    info = json.dumps({"id": "v1", "title": "", "uploader": "u", "duration": 12, "description": "d" * 900})
    got = json.loads(spark.createDataFrame([(info,)], "i string").select(extraction.video_sidecar(F.col("i"), "yt").alias("x")).first().x)
    assert (got["title"], got["url"], got["channel"], got["duration"], len(got["description"])) == ("v1", "https://www.youtube.com/watch?v=v1", "u", 12.0, 500)
