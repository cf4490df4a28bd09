"""Signals in WAV bytes or arrays: decoding, resampling, SNR and bandwidth; Arrow batches."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

WAV_QUALITY = T.StructType([T.StructField(n, T.DoubleType()) for n in ("seconds", "clipping", "snr_db", "bandwidth_hz")])


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """Samples (mean of the channels, -1 to 1) and rate of 16-bit PCM."""
    with wave.open(io.BytesIO(content)) as w:
        raw = np.frombuffer(w.readframes(w.getnframes()), dtype="<i2").astype(np.float32) / 32768
        return raw.reshape(-1, w.getnchannels()).mean(axis=1), w.getframerate()


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """16-bit mono PCM."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation between the first and the last sample."""
    if rate == target or not len(x):
        return x
    n = round(len(x) * target / rate)
    return np.interp(np.linspace(0, len(x) - 1, n), np.arange(len(x)), x).astype(x.dtype)


def snr_db(x: np.ndarray, rate: int, frame_ms: int = 30, hop_ms: int = 10) -> float:
    """The 90th less the 10th percentile of the frames' energies."""
    frame, hop = rate * frame_ms // 1000, rate * hop_ms // 1000
    if len(x) < frame or not frame:
        return 0.0
    frames = np.lib.stride_tricks.sliding_window_view(np.asarray(x, dtype=np.float64), frame)[::hop]
    low, high = np.percentile(10 * np.log10((frames**2).mean(axis=1) + 1e-12), [10, 90])
    return float(high - low)


def bandwidth_hz(x: np.ndarray, rate: int, share: float = 0.99) -> float:
    """The frequency below which ``share`` of the energy lies."""
    if not len(x):
        return 0.0
    power = np.cumsum(np.abs(np.fft.rfft(np.asarray(x, dtype=np.float64))) ** 2)
    if power[-1] <= 0:
        return 0.0
    k = min(int(np.searchsorted(power, share * power[-1])), len(power) - 1)
    return float(np.fft.rfftfreq(len(x), 1 / rate)[k])


def bandwidth_udf(rate: int):
    """A column function over arrays of samples."""

    @F.pandas_udf(T.DoubleType())
    def run(signals: pd.Series) -> pd.Series:
        return signals.map(lambda x: bandwidth_hz(x, rate), na_action="ignore")

    return run


@F.pandas_udf(WAV_QUALITY)
def wav_quality(contents: pd.Series) -> pd.DataFrame:
    """Measures of WAV bytes, rounded as they are stored."""
    rows = []
    for content in contents:
        x, rate = decode_wav(content)
        rows.append((len(x) / rate, round(float(np.mean(np.abs(x) >= 0.999)) if len(x) else 0.0, 5), round(snr_db(x, rate), 2), round(bandwidth_hz(x, rate), 1)))
    return pd.DataFrame(rows, columns=WAV_QUALITY.names)
