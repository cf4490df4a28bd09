"""Loudness after ITU-R BS.1770: K-weighting, gated blocks, true peaks, and gain to a target.

The gain is one number for a recording, so its dynamics stay; it is less than the target asks for
where the true peak would pass its limit.
"""

from __future__ import annotations

import wave
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from . import signals

# Fixed values of the recommendation: the two filters as analogue prototypes, gates and offset.
SHELF_HZ, SHELF_DB, SHELF_Q, SHELF_BAND = 1681.974450955533, 3.999843853973347, 0.7071752369554196, 0.4996667741545416
PASS_HZ, PASS_Q = 38.13547087602444, 0.5003270373238773
OFFSET_DB, ABSOLUTE_GATE, RELATIVE_GATE = -0.691, -70.0, -10.0
BLOCK_S, STEP_S = 0.4, 0.1
#: Seconds after which the filters' answer to a pulse has died away, and samples filtered at once.
ANSWER_S, PIECE = 0.4, 1 << 18
OVERSAMPLING, TAPS = 4, 24


def _filters(rate: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Both filters at a rate, by the bilinear transform."""
    k, high, q = np.tan(np.pi * SHELF_HZ / rate), 10 ** (SHELF_DB / 20), SHELF_Q
    band = high**SHELF_BAND
    a0 = 1 + k / q + k * k
    shelf = np.array([high + band * k / q + k * k, 2 * (k * k - high), high - band * k / q + k * k]) / a0, np.array([1, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0])
    k, q = np.tan(np.pi * PASS_HZ / rate), PASS_Q
    a0 = 1 + k / q + k * k
    return [shelf, (np.array([1.0, -2.0, 1.0]), np.array([1, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0]))]


@lru_cache(maxsize=8)
def _answer(rate: int) -> np.ndarray:
    """What both filters make of one pulse."""
    x = np.zeros(int(ANSWER_S * rate))
    x[0] = 1.0
    for b, a in _filters(rate):
        y = np.zeros_like(x)
        for n in range(len(x)):
            y[n] = b[0] * x[n] + (b[1] * x[n - 1] - a[1] * y[n - 1] if n > 0 else 0) + (b[2] * x[n - 2] - a[2] * y[n - 2] if n > 1 else 0)
        x = y
    return x


def weighted(x: np.ndarray, rate: int) -> np.ndarray:
    """K-weighted samples: the filters' answers added up, piece by piece."""
    answer, out = _answer(rate), np.zeros(len(x) + int(ANSWER_S * rate))
    size = 1 << (min(PIECE, max(len(x), 1)) + len(answer) - 1).bit_length()
    spectrum = np.fft.rfft(answer, size)
    for at in range(0, len(x), PIECE):
        part = np.fft.irfft(np.fft.rfft(x[at : at + PIECE], size) * spectrum, size)[: len(x[at : at + PIECE]) + len(answer)]
        out[at : at + len(part)] += part[: len(out) - at]
    return out[: len(x)]


def _lufs(power: np.ndarray | float) -> np.ndarray | float:
    return OFFSET_DB + 10 * np.log10(power)


def integrated(x: np.ndarray, rate: int) -> float | None:
    """LUFS of one channel; None for what is silent or shorter than a block."""
    block, step = round(BLOCK_S * rate), round(STEP_S * rate)
    if len(x) < block:
        return None
    sums = np.concatenate([[0.0], np.cumsum(weighted(np.asarray(x, dtype=np.float64), rate) ** 2)])
    at = np.arange(0, len(x) - block + 1, step)
    power = np.maximum(sums[at + block] - sums[at], 0) / block
    power = power[power > 10 ** ((ABSOLUTE_GATE - OFFSET_DB) / 10)]
    if not len(power):
        return None
    power = power[_lufs(power) > _lufs(power.mean()) + RELATIVE_GATE]
    return float(_lufs(power.mean()))


@lru_cache(maxsize=1)
def _phases() -> np.ndarray:
    """Interpolation between two samples at each quarter: a windowed sinc."""
    at = np.arange(-TAPS // 2 + 1, TAPS // 2 + 1)[None, :] - np.arange(OVERSAMPLING)[:, None] / OVERSAMPLING
    return np.sinc(at) * np.cos(np.pi * at / (TAPS + 1)) ** 2


def true_peak_db(x: np.ndarray) -> float | None:
    """The peak between samples too, in dB of full scale; None for silence."""
    if not len(x):
        return None
    wide = np.pad(np.asarray(x, dtype=np.float64), TAPS)
    peak = max(float(np.abs(np.convolve(wide, phase[::-1], "same")).max()) for phase in _phases())
    return float(20 * np.log10(peak)) if peak > 0 else None


def normalised(x: np.ndarray, rate: int, target: float = -23.0, peak: float = -2.0) -> np.ndarray:
    """``x`` at the target's loudness, or as near to it as its true peak allows; silence stays."""
    loud, top = integrated(x, rate), true_peak_db(x)
    if loud is None or top is None:
        return x
    return x * 10 ** (min(target - loud, peak - top) / 20)


def measures(rate: int):
    """A column function over arrays of samples: lufs and true_peak_db."""

    @F.pandas_udf("lufs double, true_peak_db double")
    def run(samples: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if x is None else (integrated(x, rate), true_peak_db(x)) for x in samples]
        return pd.DataFrame(rows, columns=["lufs", "true_peak_db"], dtype="float64")

    return run


def wav_normalised(target: float = -23.0, peak: float = -2.0, rate: int | None = None):
    """A column function that brings 16-bit WAVs to the target, in one channel and at ``rate`` where given; null where it can't."""

    @F.pandas_udf("binary")
    def run(contents: pd.Series) -> pd.Series:
        def one(content):
            try:
                x, own = signals.decode_wav(content)
            except (wave.Error, EOFError):
                return None
            x = normalised(x, own, target, peak)
            return signals.encode_wav(signals.resample(x, own, rate or own), rate or own)

        return contents.map(one, na_action="ignore")

    return run


def array_normalised(rate: int, target: float = -23.0, peak: float = -2.0):
    """A column function that brings arrays of samples to the target."""

    @F.pandas_udf("array<double>")
    def run(samples: pd.Series) -> pd.Series:
        return samples.map(lambda x: normalised(np.asarray(x, dtype=np.float64), rate, target, peak), na_action="ignore")

    return run
