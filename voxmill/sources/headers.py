"""Durations of media files from their headers, by ranged reads.

A parser asks for the few bytes it needs: ``read(at, n)`` gives up to ``n`` bytes from ``at``. Known
are RIFF and RF64 WAV, FLAC, Ogg (Vorbis, Opus, Speex, FLAC), MP4 and M4A, and MPEG audio. What is
none of them, or too short, has no duration.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tail

Read = Callable[[int, int], bytes]
#: Bytes at the end of an Ogg file in which its last page begins, and those in which MPEG's first frame is sought.
OGG_TAIL, MPEG_HEAD = 1 << 17, 1 << 16
# Fixed values of the MPEG audio header: bitrates in kbit/s by (MPEG-1?, layer), rates of MPEG-1.
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = (44100, 48000, 32000)


def _riff(read: Read, size: int) -> float | None:
    at, rate, large = 12, None, None
    while at + 8 <= size:
        name, length = struct.unpack("<4sI", read(at, 8))
        if name == b"ds64":
            large = struct.unpack("<Q", read(at + 16, 8))[0]
        if name == b"fmt ":
            rate = struct.unpack("<I", read(at + 16, 4))[0]  # bytes a second
        if name == b"data":
            if not rate:
                return None
            if length == 0xFFFFFFFF:
                length = large or size
            return min(length or size, size - at - 8) / rate  # a writer that was killed left no length
        at += 8 + length + length % 2
    return None


def _flac(head: bytes) -> float | None:
    rate = int.from_bytes(head[18:21], "big") >> 4
    total = int.from_bytes(head[21:26], "big") & (1 << 36) - 1
    return total / rate if rate and total else None


def _ogg(read: Read, size: int) -> float | None:
    first = read(0, 512)
    serial, body = first[14:18], first[27 + first[26] :]
    skipped = 0
    if body[:7] == b"\x01vorbis":
        rate = struct.unpack("<I", body[12:16])[0]
    elif body[:8] == b"OpusHead":
        rate, skipped = 48000, struct.unpack("<H", body[10:12])[0]
    elif body[:8] == b"Speex   ":
        rate = struct.unpack("<I", body[36:40])[0]
    elif body[:5] == b"\x7fFLAC":
        rate = int.from_bytes(body[27:30], "big") >> 4
    else:
        return None
    start = max(0, size - OGG_TAIL)
    end = read(start, OGG_TAIL)
    at = len(end)
    while (at := end.rfind(b"OggS\x00", 0, at)) >= 0:
        granule = end[at + 6 : at + 14]
        if end[at + 14 : at + 18] == serial and len(granule) == 8 and granule != b"\xff" * 8:
            return max(0, struct.unpack("<q", granule)[0] - skipped) / rate if rate else None
    return None


def _mp4(read: Read, start: int, end: int) -> float | None:
    """The length that the movie header tells, wherever it is."""
    at = start
    while at + 8 <= end:
        length, name = struct.unpack(">I4s", read(at, 8))
        body = at + 8
        if length == 1:
            length, body = struct.unpack(">Q", read(at + 8, 8))[0], at + 16
        length = length or end - at
        if length < 8:
            return None
        if name == b"moov":
            return _mp4(read, body, min(at + length, end))
        if name == b"mvhd":
            long = read(body, 1) == b"\x01"
            scale, total = struct.unpack(">IQ", read(body + 20, 12)) if long else struct.unpack(">II", read(body + 12, 8))
            return total / scale if scale else None
        at += length
    return None


def _mpeg_frame(head: bytes) -> tuple[int, int, int, int, bool] | None:
    """Samples, rate, bitrate, side information's end and whether it's MPEG-1, of a frame's header."""
    if len(head) < 4 or head[0] != 0xFF or head[1] & 0xE0 != 0xE0:
        return None
    version, layer, bits, rate = head[1] >> 3 & 3, 4 - (head[1] >> 1 & 3), head[2] >> 4, head[2] >> 2 & 3
    if version == 1 or layer == 4 or bits in (0, 15) or rate == 3:
        return None
    new = version == 3
    samples = 384 if layer == 1 else 1152 if layer == 2 or new else 576
    mono = head[3] >> 6 == 3
    side = (17 if mono else 32) if new else (9 if mono else 17)
    return samples, RATES[rate] // (1 if new else 2 if version == 2 else 4), BITRATES[new, layer][bits] * 1000, 4 + side, new


def _mpeg_length(samples: int, rate: int, bitrate: int, padded: int) -> int:
    slot = 4 if samples == 384 else 1
    return (samples // 8 // slot * bitrate // rate + padded) * slot


def _mpeg(read: Read, size: int) -> float | None:
    start = 0
    head = read(0, 10)
    if head[:3] == b"ID3":
        start = 10 + sum(b << 7 * k for k, b in enumerate(reversed(head[6:10]))) + (10 if head[5] & 0x10 else 0)
    data = read(start, MPEG_HEAD)
    at = -1
    while (at := data.find(b"\xff", at + 1)) >= 0:
        frame = _mpeg_frame(data[at : at + 4])
        if frame is None:
            continue
        samples, rate, bitrate, side, _ = frame
        behind = at + _mpeg_length(samples, rate, bitrate, data[at + 2] >> 1 & 1)
        if start + behind + 4 <= size and _mpeg_frame(read(start + behind, 4)) is None:
            continue  # these bytes only look like a frame
        tag = data[at + side : at + side + 12]
        if tag[:4] in (b"Xing", b"Info") and tag[7] & 1:
            return struct.unpack(">I", tag[8:12])[0] * samples / rate
        if data[at + 36 : at + 40] == b"VBRI":
            return struct.unpack(">I", data[at + 50 : at + 54])[0] * samples / rate
        end = size - (128 if read(size - 128, 3) == b"TAG" else 0)
        return (end - start - at) * 8 / bitrate
    return None


def duration(read: Read, size: int) -> float | None:
    """Seconds of a file of ``size`` bytes; None if its header doesn't tell."""
    try:
        head = read(0, 64)
        if head[:4] in (b"RIFF", b"RF64") and head[8:12] == b"WAVE":
            return _riff(read, size)
        if head[:4] == b"fLaC":
            return _flac(head)
        if head[:4] == b"OggS":
            return _ogg(read, size)
        if head[4:8] in (b"ftyp", b"moov", b"mdat", b"free", b"wide"):
            return _mp4(read, 0, size)
        return _mpeg(read, size)
    except (struct.error, IndexError):
        return None


@F.pandas_udf(T.DoubleType())
def content_duration(contents: pd.Series) -> pd.Series:
    """Seconds of media bytes."""
    return contents.map(lambda c: None if c is None else duration(lambda at, n: c[max(0, at) : max(0, at) + n], len(c))).astype("float64")


@F.pandas_udf(T.DoubleType())
def file_duration(paths: pd.Series) -> pd.Series:
    """Seconds of the media files at these URIs, of which only headers are read; null if there is none."""

    def one(uri):
        if uri is None:
            return None
        store, path = tail.opened(uri)
        try:
            with store.open_input_file(path) as f:
                return duration(lambda at, n: f.read_at(n, max(0, at)), f.size())
        except OSError:
            return None

    return paths.map(one).astype("float64")
