"""Loudness, headers, hosts, diarisation, recordings and detail pages on known inputs."""

import io
import struct
import tracemalloc
import wave

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxmill import providers
from voxmill.operators import clips, hosts, loudness, signals, speakers
from voxmill.sources import feeds, headers


def tone(hz, seconds, rate, amp=1.0):
    return amp * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)


# loudness


@pytest.mark.parametrize("rate", [8000, 16000, 44100, 48000])
def test_loudness_of_known_tones(rate):
    """A full-scale sine of 997 Hz in one channel has -3.01 LUFS; half the amplitude has 6.02 less."""
    assert abs(loudness.integrated(tone(997, 5, rate), rate) + 3.01) < 0.1
    assert abs(loudness.integrated(tone(997, 5, rate, 0.5), rate) + 9.03) < 0.1
    # low tones count for less, high ones for more
    assert loudness.integrated(tone(30, 5, rate), rate) < -6 and loudness.integrated(tone(3500, 5, rate), rate) > -1


def test_gates_leave_out_pauses():
    """Silence, and parts more than 10 LU below the rest, do not lower the loudness."""
    rate, loud = 16000, tone(997, 4, 16000, 0.1)
    quiet, silent = tone(997, 40, rate, 0.1 * 10 ** (-25 / 20)), np.zeros(40 * rate)
    whole = loudness.integrated(loud, rate)
    assert abs(loudness.integrated(np.concatenate([loud, silent]), rate) - whole) < 0.2
    assert abs(loudness.integrated(np.concatenate([loud, quiet]), rate) - whole) < 0.2
    assert loudness.integrated(silent, rate) is None and loudness.integrated(loud[:1000], rate) is None and loudness.integrated(np.zeros(0), rate) is None


def test_filter_in_pieces_equals_step_by_step(monkeypatch):
    rate, x = 8000, np.random.default_rng(1).normal(size=9000)
    want = x
    for b, a in loudness._filters(rate):
        y = np.zeros(len(want))
        for n in range(len(want)):
            y[n] = b @ [want[n - k] if n >= k else 0 for k in range(3)] - a[1:] @ [y[n - k] if n >= k else 0 for k in (1, 2)]
        want = y
    assert np.allclose(loudness.weighted(x, rate), want, atol=1e-9)
    monkeypatch.setattr(loudness, "PIECE", 1000)
    assert np.allclose(loudness.weighted(x, rate), want, atol=1e-9)


def test_true_peak_limits_the_gain():
    """Samples at 45 degrees hide 3 dB of peak; the target yields to the peak's limit."""
    rate = 16000
    hidden = np.sin(2 * np.pi * (rate / 4) * np.arange(rate) / rate + np.pi / 4)
    assert abs(20 * np.log10(np.abs(hidden).max()) + 3.01) < 0.01 and abs(loudness.true_peak_db(hidden)) < 0.2
    out = loudness.normalised(tone(997, 3, rate, 0.02), rate, -16, -2)
    assert abs(loudness.integrated(out, rate) + 16) < 0.1
    spiky = tone(997, 3, rate, 0.02)
    spiky[20000] = 0.9
    out = loudness.normalised(spiky, rate, -16, -2)
    assert abs(loudness.true_peak_db(out) + 2) < 0.1 and loudness.integrated(out, rate) < -20
    assert not loudness.normalised(np.zeros(rate), rate).any() and loudness.true_peak_db(np.zeros(0)) is None


def test_wavs_come_to_the_target(spark):
    wavs = [(1, signals.encode_wav(tone(997, 2, 16000, 0.3), 16000)), (2, b"no wav"), (3, None), (4, signals.encode_wav(np.zeros(0), 16000))]
    got = {r.id: r.wav for r in spark.createDataFrame(wavs, "id int, content binary").select("id", loudness.wav_normalised(-20, rate=8000)("content").alias("wav")).collect()}
    x, rate = signals.decode_wav(got[1])
    assert rate == 8000 and abs(loudness.integrated(x, rate) + 20) < 0.2
    assert got[2] is None and got[3] is None and signals.decode_wav(got[4])[0].size == 0


# headers


def wav_of(frames, rate=8000, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels), w.setsampwidth(2), w.setframerate(rate), w.writeframes(b"\0" * (2 * channels * frames))
    return out.getvalue()


def boxes(*parts):
    return b"".join(struct.pack(">I4s", 8 + len(body), name) + body for name, body in parts)


def page(granule, body, serial=7):
    return b"OggS\0\0" + struct.pack("<qIII", granule, serial, 0, 0) + bytes([1, len(body)]) + body


FLAC = b"fLaC\0\0\0\x22" + b"\0" * 10 + ((44100 << 44) + (15 << 36) + 441000).to_bytes(8, "big") + b"\0" * 16
VORBIS = b"\x01vorbis" + struct.pack("<IBI", 0, 1, 22050) + b"\0" * 14
OPUS = b"OpusHead\x01\x01" + struct.pack("<HI", 312, 48000) + b"\0" * 3
MVHD0 = boxes((b"mvhd", b"\0" * 12 + struct.pack(">II", 1000, 12_345) + b"\0" * 80))
MVHD1 = boxes((b"mvhd", b"\1" + b"\0" * 19 + struct.pack(">IQ", 600, 600 * 7200) + b"\0" * 80))
MP3_FRAME = b"\xff\xfb\x90\x00" + b"\0" * 413  # MPEG-1 layer 3, 128 kbit/s, 44.1 kHz
XING = b"\xff\xfb\x90\x00" + b"\0" * 32 + b"Xing" + struct.pack(">II", 1, 10_000) + b"\0" * 369
V2_FRAME = b"\xff\xf3\x40\xc0" + b"\0" * 100  # MPEG-2 layer 3, 32 kbit/s, 22.05 kHz, mono
CASES = {
    "wav": (wav_of(12345), 12345 / 8000),
    "stereo": (wav_of(12345, 44100, 2), 12345 / 44100),
    "unfinished wav": (wav_of(0)[:-4] + b"\xff" * 4 + b"\0" * 16000, 1.0),
    "no wav data": (wav_of(5)[:36], None),
    "flac": (FLAC, 10.0),
    "vorbis": (page(0, VORBIS) + page(22050 * 3, b"x") + b"OggS junk", 3.0),
    "opus": (page(0, OPUS) + page(48000 * 2 + 312, b"x") + page(-1, b"y") + page(5, b"z", serial=8), 2.0),
    "m4a": (boxes((b"ftyp", b"M4A "), (b"mdat", b"\0" * 70_000), (b"moov", boxes((b"free", b"")) + MVHD0)), 12.345),
    "long mp4": (boxes((b"ftyp", b"isom")) + struct.pack(">I4sQ", 1, b"mdat", 16 + 100) + b"\0" * 100 + boxes((b"moov", MVHD1)), 7200.0),
    "mp3": (b"ID3\4\0\0\0\0\1\0" + b"\xff" * 128 + MP3_FRAME * 100, 100 * 417 * 8 / 128_000),
    "vbr": (XING + MP3_FRAME * 3, 10_000 * 1152 / 44100),
    "mpeg-2": (V2_FRAME * 50 + b"TAG" + b"\0" * 125, 50 * 104 * 8 / 32_000),
    "text": (b"no media at all", None),
    "empty": (b"", None),
}


@pytest.mark.parametrize("name", CASES)
def test_duration_of_headers(name):
    content, want = CASES[name]
    read = []

    def part(at, n):
        read.append(n)
        return content[max(0, at) : max(0, at) + n]

    got = headers.duration(part, len(content))
    assert got is None and want is None or abs(got - want) < 0.01, got


def test_headers_of_large_files_by_few_bytes(spark, tmp_path):
    """A file of 200 MB is told by some hundred bytes, and what is decoded says the same."""
    with wave.open(str(tmp_path / "big.wav"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(24000)
        for _ in range(100):
            w.writeframes(b"\0" * 2_000_000)
    read = []
    with open(tmp_path / "big.wav", "rb") as f:

        def part(at, n):
            f.seek(at)
            found = f.read(n)
            read.append(len(found))
            return found

        assert headers.duration(part, 200_000_044) == pytest.approx(100_000_000 / 24000)
    assert sum(read) < 500
    for k, (name, (content, _)) in enumerate(CASES.items()):
        (tmp_path / f"{k} {name}.bin").write_bytes(content)
    paths = spark.createDataFrame([(n, f"file://{tmp_path}/{k} {n}.bin") for k, n in enumerate(CASES)] + [("gone", f"{tmp_path}/gone"), ("none", None)], "name string, uri string")
    got = {r.name: r.s for r in paths.select("name", headers.file_duration(F.replace("uri", F.lit(" "), F.lit("%20"))).alias("s")).collect()}
    for name, (_, want) in CASES.items():
        assert got[name] is None and want is None or got[name] == pytest.approx(want, abs=0.01)
    assert got["gone"] is None and got["none"] is None
    x, rate = signals.decode_wav(CASES["wav"][0])
    assert len(x) / rate == pytest.approx(got["wav"])


# hosts


def counting_model(limit):
    """A model that counts its loads and batches, fails on planted items and has room for ``limit``."""

    def make():
        log = {"batches": []}

        def run(items):
            log["batches"].append(len(items))
            if len(items) > limit:
                raise providers.OutOfMemory
            if any(i % 97 == 0 for i in items):
                raise ValueError("planted")
            return [i * 10 + (0 if len(log["batches"]) else 1) for i in items]

        return run

    return make


@pytest.mark.parametrize(("size", "limit"), [(1, 1), (16, 16), (64, 5), (3000, 700)])
def test_host_gives_what_one_by_one_gives(spark, size, limit):
    """1,000 rows with planted failures and exhausted memory, over Arrow batches of 7 rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(1000).select(F.when(F.col("id") % 10 != 3, F.col("id")).alias("x"), "id", F.col("id").cast("string").alias("other"))
        out = hosts.hosted(rows.coalesce(2), f"counting {size} {limit}", counting_model(limit), ["x"], "y", "long", size).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.id, r.other) for r in out} == {(k, str(k)) for k in range(1000)} and len(out) == 1000
    for r in out:
        assert r.y == (None if r.id % 10 == 3 or r.id % 97 == 0 else r.id * 10)


def test_batches_cross_arrow_batches_and_shrink(monkeypatch):
    """The model sees full batches whatever Arrow's are, and a halved size stays."""
    sizes = []

    def run(items):
        sizes.append(len(items))
        if len(items) > 2:
            raise providers.OutOfMemory
        return list(items)

    feed = providers.Batches(run, 8)
    assert feed([1, 2, 3, 4]) == [1, 2, 3, 4] and sizes == [4, 2, 2]
    assert feed([5, 6, 7]) == [5, 6, 7] and sizes[3:] == [2, 1]
    with pytest.raises(ValueError, match="1 results for 2"):
        providers.Batches(lambda items: items[:1], 2, strict=True)([1, 2])
    with pytest.raises(ZeroDivisionError):
        providers.Batches(lambda items: 1 / 0, 2, strict=True)([1])
    assert providers.Batches(lambda items: 1 / 0, 2)([1, 2]) == [None, None]


def test_scorer_embedder_and_transcriber(spark):
    """Windows of nine seconds, padded, the rest left out; embeddings; trimmed texts; nulls through all."""
    rows = spark.createDataFrame([(1, [1.0] * 50, 10), (2, [1.0] * 90 + [3.0] * 90 + [100.0] * 50, 10), (3, None, 10), (4, [], 10)], "id int, x array<double>, rate int")
    mos = {r.id: r.mos for r in hosts.scored(rows, "mean", lambda: lambda w: float(w.mean()), "x", "rate", model_rate=10).collect()}
    assert mos[1] == round(50 / 90, 3) and mos[2] == 2.0 and mos[4] == 0.0
    found = {r.id: r.embedding for r in hosts.embedded(rows, "ends", lambda: lambda x, rate: np.array([x[0], x[-1], rate]), "x", "rate").collect()}
    assert found[2] == [1.0, 100.0, 10.0] and found[4] is None
    said = {r.id: r.text for r in hosts.transcribed(rows, "len", lambda: lambda xs: [f" {len(x)} " if len(x) else None for x in xs], "x").collect()}
    assert said == {1: "50", 2: "230", 3: None, 4: ""}


def test_speech_is_a_table_function(spark):
    rate = 1000
    x = np.concatenate([np.zeros(300), tone(100, 0.6, rate), np.zeros(300), tone(100, 0.3, rate)])
    rows = spark.createDataFrame([(1, x.tolist(), "kept"), (2, np.zeros(500).tolist(), "kept"), (3, None, "kept"), (4, [], "kept")], "id int, x array<double>, other string")
    got = hosts.speech_intervals(rows, "x", F.lit(rate))
    assert [(r.id, round(r.start, 2), round(r.end, 2), r.other) for r in got.orderBy("id", "start").collect()] == [(1, 0.3, 0.9, "kept"), (1, 1.2, 1.5, "kept")]
    left = hosts.speech_intervals(rows, "x", F.lit(rate), keep=True)
    assert sorted(r.id for r in left.collect()) == [1, 1, 2, 3, 4]
    spark.udtf.register("speech_intervals", hosts.speech_function())
    rows.createOrReplaceTempView("signals_with_speech")
    assert spark.sql(f"SELECT id, start FROM signals_with_speech, LATERAL speech_intervals(x, {rate})").count() == 2


# diarisation


def brute_turns(windows, change, same):
    """Turns of one segment: cut where neighbours are apart, named by clusters of their means."""

    def apart(a, b):
        return 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b) + 1e-9)

    runs = [[windows[0]]]
    for w in windows[1:]:
        if apart(runs[-1][-1][2], w[2]) > change:
            runs.append([])
        runs[-1].append(w)
    names = speakers.average_linkage(np.stack([np.mean([w[2] for w in r], axis=0) for r in runs]), same)
    out = []
    for k, r in enumerate(runs):
        end = max(w[1] for w in r)
        out.append((f"spk{names[k]}", r[0][0], min(end, runs[k + 1][0][0]) if k + 1 < len(runs) else end))
    return out


def test_turns_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    voices, rows, table = rng.normal(size=(6, 16)), [], {}
    for s in range(30):
        who = rng.choice(6, size=rng.integers(1, 4), replace=False)
        plan = np.repeat(rng.choice(who, size=6), rng.integers(1, 5, size=6))
        table[f"s{s}"] = [(0.75 * k, 0.75 * k + 1.5, voices[v] + 0.1 * rng.normal(size=16)) for k, v in enumerate(plan)]
        rows += [(f"s{s}", k, a, b, e.tolist()) for k, (a, b, e) in enumerate(table[f"s{s}"])]
    found = hosts.turns(spark.createDataFrame(rows, "id string, k int, start double, end double, embedding array<double>"), "id")
    got = {}
    for r in found.collect():
        got.setdefault(r.segment, []).append((r.speaker.removeprefix(r.segment + "_"), r.start, r.end))
    assert set(got) == set(table)
    for s, windows in table.items():
        assert sorted(got[s], key=lambda t: t[1]) == brute_turns(windows, 0.45, 0.35)
    multi = {r.segment: r.multi_speaker for r in speakers.dominant(found).collect()}
    assert multi == {s: len({t[0] for t in got[s]}) > 1 for s in table} and len(set(multi.values())) == 2


def test_windows_of_signals(spark):
    rows = spark.createDataFrame([(1, list(range(10))), (2, [1, 2]), (3, [])], "id int, x array<int>")
    got = sorted((r.id, r.k, r.start, r.end, r.x) for r in hosts.windows(rows, "x", 1, 4, 3).collect())
    assert got == [(1, 0, 0.0, 4.0, [0, 1, 2, 3]), (1, 1, 3.0, 7.0, [3, 4, 5, 6]), (1, 2, 6.0, 10.0, [6, 7, 8, 9]), (2, 0, 0.0, 2.0, [1, 2]), (3, 0, 0.0, 0.0, [])]


# recordings


def test_recordings_equal_joining_in_memory(spark, tmp_path):
    part = lambda n, rate=8000: signals.encode_wav(np.full(n, 0.25), rate)
    rows = [("a", k, part(100 + k)) for k in range(30)] + [("b", 1, part(5)), ("b", 2, part(5, 16000)), ("c", 1, part(5)), ("c", 2, b"junk"), ("d", 1, None), ("e é", 1, part(0))]
    parts = spark.createDataFrame(rows, "rec string, k int, content binary")
    got = {r.rec: r for r in clips.recordings_written(parts, f"file://{tmp_path}/out", "rec", "k").collect()}
    want = {r.rec: r.content for r in clips.wav_joined(parts, "rec", "k").collect()}
    assert {k: r.reason for k, r in got.items()} == {"a": None, "b": "formats differ", "c": "unreadable", "d": "unreadable", "e é": None}
    for k in ("a", "e é"):
        assert signals.decode_wav(open(got[k].path, "rb").read())[0].tolist() == signals.decode_wav(want[k])[0].tolist()
    assert got["a"].parts == 30 and got["a"].seconds == sum(100 + k for k in range(30)) / 8000
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.wav", "e é.wav"]


def test_recording_larger_than_what_is_held(tmp_path):
    """200 MB of one recording pass through a task that holds a few of its parts at most."""
    frames = signals.encode_wav(np.zeros(500_000, dtype=np.float32), 24000)
    tracemalloc.start()
    out = clips._Recording(str(tmp_path), "long", 200 * 1_000_000)
    for _ in range(200):
        out.add(frames)
    path = out.close()
    assert tracemalloc.get_traced_memory()[1] < 20_000_000
    tracemalloc.stop()
    with wave.open(path) as w:
        assert w.getnframes() == 100_000_000 and out.seconds == 100_000_000 / 24000


# detail pages


def test_detail_pages_are_followed(spark):
    """A listing's own audio first, then that of its first details; first met wins; missing pages are passed over."""
    a = lambda *links: "".join(f"<a href='{u}'>" for u in links)
    listing = [
        (1, "http://x.org/1", a("/d1", "/own.mp3", "mailto:me", "/gone", "/d2", "/d3")),
        (2, "http://x.org/2", a("/own.mp3", "/two.MP3?x=1", "/d1", "/d3")),
        (3, "http://x.org/3", None),
    ]
    stored = [("http://x.org/d1", a("in1.mp3", "own.mp3", "in2.mp3")), ("http://x.org/d2", a("in1.mp3", "in3.ogg")), ("http://x.org/d3", a("in4.mp3")), ("http://x.org/never", a("never.mp3"))]
    got = feeds.followed_audio(spark.createDataFrame(listing, "pos int, url string, html string"), spark.createDataFrame(stored, "url string, html string"), limit=3)
    assert {(r.title, r.listing_page[-2:]) for r in got.collect()} == {("own.mp3", "/1"), ("in1.mp3", "d1"), ("in2.mp3", "d1"), ("in3.ogg", "d2"), ("two.MP3?x=1", "/2"), ("in4.mp3", "d3")}
    assert [r.place.pos for r in got.filter("title = 'in4.mp3'").collect()] == [2]
