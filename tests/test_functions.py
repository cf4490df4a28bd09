"""Text, id, vector and signal functions against literal expectations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill.functions import ids, vectors
from voxmill.functions import text as tx
from voxmill.operators import clips, signals
from voxmill.providers import OutOfMemory, energy_gate, in_batches
from voxmill.sources import feeds, registry


def one(spark, column, *values, names=("a", "b")):
    schema = ", ".join(f"{n} string" for n, _ in zip(names, values, strict=False))
    return spark.createDataFrame([values], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(("n", "said"), [(0, "không"), (15, "mười lăm"), (21, "hai mươi mốt"), (105, "một trăm lẻ năm"), (1234, "một nghìn hai trăm ba mươi bốn"), (2000000, "hai triệu"), (-7, "âm bảy"), (1000005, "một triệu không trăm lẻ năm")])
def test_numbers_in_words(spark, n, said):
    assert one(spark, tx.number_in_words(F.col("a").cast("bigint")), str(n)) == said


@pytest.mark.parametrize(("text", "said"), [("có  5 người", "có năm người"), ("\u0665\u0661", "năm mươi mốt"), ("\uff12", "hai"), (None, ""), ("1234567890123456", "một trăm hai mươi ba nghìn tỷ bốn trăm năm mươi sáu tỷ bảy trăm tám mươi chín triệu không trăm mười hai nghìn ba trăm bốn mươi lămsáu")])
def test_spoken_form(spark, text, said):
    assert one(spark, tx.spoken_form(F.col("a")), text) == said


@pytest.mark.parametrize(("a", "b", "low", "high"), [("xin chào Việt Nam", "Xin chào, Việt Nam!", 0, 0), ("", "", 0, 0), ("abc", "", 1, 1), ("xin chào", "xin chề", 0.01, 0.5)])
def test_character_error_rate(spark, a, b, low, high):
    assert low <= one(spark, tx.character_error_rate(tx.comparable(F.col("a")), tx.comparable(F.col("b"))), a, b) <= high


@pytest.mark.parametrize(("name", "safe"), [("Tập 1: Xin chào / thế giới!", "Tập_1_Xin_chào_thế_giới"), ("", "untitled"), ("x" * 300, "x" * 120)])
def test_safe_filename(spark, name, safe):
    assert one(spark, tx.safe_filename(F.col("a")), name) == safe


@pytest.mark.parametrize(("url", "ext"), [("http://h/f.MP3?x=1", ".mp3"), ("http://h/none", ".mp3"), ("http://h/a.m4a", ".m4a")])
def test_extension(spark, url, ext):
    assert one(spark, tx.extension_of(F.col("a")), url) == ext


def test_names_and_paths(spark):
    assert one(spark, tx.source_path(F.col("a")), "src__feed__Tập_1.mp3") == "feed/Tập_1.mp3"
    assert one(spark, tx.source_path(F.col("a")), "a/b__c") == "a/b__c"
    assert one(spark, tx.source_path(F.col("a")), None) is None
    assert one(spark, tx.relocated(F.col("a"), "/old", "/new/"), "/old/x.wav") == "/new/x.wav"
    assert one(spark, tx.relocated(F.col("a"), "/old", "/new"), "/older/x.wav") == "/older/x.wav"
    assert one(spark, tx.feed_slug(F.col("a")), "https://x.com/") == "x.com"
    assert one(spark, tx.archive_identifier(F.col("a")), "https://archive.org/details/item-1?x") == "item-1"
    assert one(spark, tx.archive_identifier(F.col("a")), " item-1/ ") == "item-1"
    assert one(spark, tx.extension_of_container(F.col("a")), "mov,mp4,m4a") == ".m4a"
    assert one(spark, tx.stem(F.col("a")), "/x/.hidden") == ".hidden"


@pytest.mark.parametrize(("text", "seconds"), [("01:02:03", 3723.0), ("12:30", 750.0), ("3600", 3600.0), ("", None), ("abc", None)])
def test_durations(spark, text, seconds):
    assert one(spark, ids.seconds_of(F.col("a")), text) == seconds


def test_uniform_is_exact(spark):
    import hashlib

    for key in ("a", "Nguyễn", "x" * 50):
        want = int(hashlib.sha1(f"42:{key}".encode()).hexdigest()[:16], 16) / 2**64
        assert one(spark, ids.uniform(F.col("a"), 42), key) == want


def test_vectors(spark):
    df = spark.createDataFrame([([0.0] * 90 + [1.0] * 10, [0.1, -0.5, 0.25])], "x array<float>, y array<float>")
    r = df.select(vectors.clipping_ratio(F.col("x")).alias("clip"), F.array_max(F.transform(vectors.peak_normalised(F.col("y")), F.abs)).alias("peak"), vectors.cosine_distance(F.col("y"), F.col("y")).alias("same")).first()
    assert r.clip == 0.1 and r.peak == pytest.approx(10 ** (-3 / 20)) and abs(r.same) < 1e-6


def test_clips(spark):
    x = np.arange(800, dtype=np.float32) / 1600
    wav = signals.encode_wav(x, 400)
    rows = spark.createDataFrame([("a", wav, 0.5, 0.25), ("b", wav, 1.9, 5.0), ("c", wav, 3.0, 1.0), ("d", b"no wav", 0.0, 1.0), ("e", None, 0.0, 1.0), ("f", wav, None, 1.0)], "source_path string, content binary, start double, seconds double")
    got = {r.source_path: r.c for r in rows.select("source_path", clips.wav_cut("content", "start", "seconds").alias("c")).collect()}
    part, rate = signals.decode_wav(bytes(got["a"]))
    assert rate == 400 and np.allclose(part, x[200:300], atol=1e-4)
    assert len(signals.decode_wav(bytes(got["b"]))[0]) == 40 and len(signals.decode_wav(bytes(got["c"]))[0]) == 0
    assert got["d"] is None and got["e"] is None and got["f"] is None
    done, rejects = clips.converted(rows, 200)
    assert {len(signals.decode_wav(bytes(r.content))[0]) for r in done.collect()} == {400}
    assert {(r.source_path, r.reason) for r in rejects.collect()} == {("d", "convert"), ("e", "convert")}
    halves = [("k", 1, signals.encode_wav(x[400:], 400)), ("k", 0, signals.encode_wav(x[:400], 400)), ("m", 0, wav), ("m", 1, signals.encode_wav(x, 200)), ("n", 0, b"")]
    chain = {r.key: r.content for r in clips.wav_joined(spark.createDataFrame(halves, "key string, part int, content binary"), "key", "part").collect()}
    assert bytes(chain["k"]) == wav and chain["m"] is None and chain["n"] is None


def test_normaliser(monkeypatch):
    assert tx.normaliser() == (tx.spoken_form, "basic") == tx.normaliser("basic")
    with pytest.raises(KeyError):
        tx.normaliser("other")
    monkeypatch.setitem(tx.NORMALISERS, "other", F.lower)
    assert tx.normaliser("auto") == (F.lower, "other") and tx.normaliser("basic")[1] == "basic"


def test_signals():
    rate = 16000
    t = np.arange(rate) / rate
    gated = np.sin(2 * np.pi * 220 * t) * (np.sin(2 * np.pi * 2 * t) > 0)
    noise = np.random.default_rng(0).normal(0, 0.2, rate)
    assert signals.snr_db(gated, rate) > signals.snr_db(gated + noise, rate)
    assert signals.bandwidth_hz(np.sin(2 * np.pi * 500 * np.arange(24000) / 24000), 24000) < 1000
    assert signals.snr_db(gated[:10], rate) == 0 and signals.bandwidth_hz(np.zeros(0), rate) == 0
    x, r = signals.decode_wav(signals.encode_wav(gated * 0.5, rate))
    assert r == rate and np.abs(x - gated * 0.5).max() < 1e-3
    assert len(signals.resample(gated, rate, 8000)) == 8000
    assert energy_gate(np.concatenate([np.zeros(4800), gated[:4800], np.zeros(4800)]), rate)


def test_batches_are_halved():
    calls = []

    def run(part):
        calls.append(len(part))
        if len(part) > 2:
            raise OutOfMemory
        if "bad" in part:
            raise ValueError
        return [p.upper() for p in part]

    assert in_batches(run, ["a", "b", "c", "d"], 8) == ["A", "B", "C", "D"]
    assert calls == [4, 4, 2, 2] or calls[-2:] == [2, 2]
    assert in_batches(run, ["a", "bad"], 2) == ["A", None]


RSS = """<rss xmlns:itunes="http://x"><channel><title>t</title>
<item><title> One </title><enclosure url="http://h/1.mp3" type="a"/><pubDate>d</pubDate><description>x</description><itunes:duration>01:00</itunes:duration></item>
<item><title>No audio</title></item>
<item><title>Two</title><enclosure url="http://h/2.mp3"/></item></channel></rss>"""


def test_feeds(spark):
    rows = feeds.episodes(spark.createDataFrame([("f", RSS)], "feed string, xml string")).orderBy("pos").collect()
    assert [(r.title, r.audio_url, r.duration) for r in rows] == [("One", "http://h/1.mp3", 60.0), ("Two", "http://h/2.mp3", None)]
    assert feeds.episodes(spark.createDataFrame([("f", RSS)], "feed string, xml string"), 1).count() == 1


def test_archive_and_pages(spark):
    payload = '{"files": [{"name": "a.mp3", "source": "original", "length": "12.5"}, {"name": "b.mp3", "source": "derivative"}, {"name": "c.txt", "source": "original"}, {"name": "d.MP3", "source": "original", "length": "bad"}]}'
    rows = feeds.archive_files(spark.createDataFrame([("it", payload)], "identifier string, payload string")).orderBy("name").collect()
    assert [(r.key, r.duration) for r in rows] == [("archive.org/it/a.mp3", 12.5), ("archive.org/it/d.MP3", None)]
    html = "<a HREF='/x/a.MP3'>1</a><a href=\"b.m4a?q=1\">2</a><a href='c.html'>3</a><a href='/x/a.MP3'>1</a>"
    links = feeds.page_audio(spark.createDataFrame([("http://h/p/", html)], "url string, html string")).collect()
    assert sorted(r.url for r in links) == ["http://h/p/b.m4a?q=1", "http://h/x/a.MP3"]
    r = feeds.trimmed(spark.createDataFrame([(50.0,), (None,), (99999.5,)], "duration double"), 100.0).orderBy("duration").collect()
    assert [(x.truncated_to_seconds, x.duration_original) for x in r] == [(100, None), (None, None), (100, 99999.5)]


def test_targets_and_data_source(spark, tmp_path):
    assert registry.resolve_targets("a", ["b", "c"], "c\n# no\n\na\nd") == ["a", "b", "c", "d"]
    with pytest.raises(ValueError):
        registry.resolve_targets(None, None, None)
    with pytest.raises(KeyError):
        registry.register(spark, "nope")
    (tmp_path / "f.xml").write_text(RSS)
    df = spark.read.format(registry.register(spark, "rss")).option("paths", f"{tmp_path}/f.xml,{tmp_path}/gone.xml").load()
    assert feeds.episodes(df).count() == 2


def test_plan_of_the_spoken_form(spark):
    plans = spark.createDataFrame([("1",)], "a string").select(tx.spoken_form(F.col("a")))._jdf.queryExecution()
    sizes = [len(p.toString()) for p in (plans.analyzed(), plans.optimizedPlan(), plans.executedPlan())]
    assert max(sizes) < 20_000, sizes
