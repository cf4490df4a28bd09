"""What models and codecs must offer, and how batches are fed to them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Protocol, TypeVar

import numpy as np

In, Out = TypeVar("In"), TypeVar("Out")


class Transcriber(Protocol):
    def __call__(self, signals: Sequence[np.ndarray]) -> list[str]: ...


class SpeechDetector(Protocol):
    def __call__(self, signal: np.ndarray, rate: int) -> list[tuple[float, float]]: ...


class Embedder(Protocol):
    def __call__(self, signal: np.ndarray, rate: int) -> np.ndarray: ...


class OutOfMemory(RuntimeError):
    """A model's memory is exhausted by a batch."""


class Batches:
    """Runs a model on items in order, ``size`` at a time.

    A batch too large for memory is halved, for this batch and all later ones. One that fails for
    another reason is run item by item, and an item that fails alone gives None; with ``strict`` such
    a failure, and an item too large for memory alone, is raised.
    """

    def __init__(self, run: Callable[[list[In]], list[Out]], size: int, strict: bool = False) -> None:
        self.run, self.size, self.strict = run, size, strict

    def __call__(self, items: Sequence[In]) -> list[Out | None]:
        out: list[Out | None] = []
        while len(out) < len(items):
            part = list(items[len(out) : len(out) + self.size])
            try:
                out += self._checked(part)
            except OutOfMemory:
                if len(part) == 1:
                    if self.strict:
                        raise
                    out.append(None)
                self.size = max(1, len(part) // 2)
            except Exception:  # noqa: BLE001  the bad item is found alone
                if self.strict:
                    raise
                out += [self._alone(item) for item in part]
        return out

    def _alone(self, item: In) -> Out | None:
        try:
            return self._checked([item])[0]
        except Exception:  # noqa: BLE001
            return None

    def _checked(self, part: list[In]) -> list[Out]:
        found = self.run(part)
        if len(found) != len(part):
            raise ValueError(f"a model gave {len(found)} results for {len(part)} items")
        return list(found)


def in_batches(run: Callable[[list[In]], list[Out]], items: Sequence[In], size: int) -> list[Out | None]:
    """Results in order, as ``Batches`` gives them."""
    return Batches(run, size)(items)


def energy_gate(signal: np.ndarray, rate: int, frame_ms: int = 30, floor_db: float = 30.0) -> list[tuple[float, float]]:
    """Speech where frames are within ``floor_db`` of the loudest: a detector without a model."""
    frame = max(1, rate * frame_ms // 1000)
    n = len(signal) // frame
    if not n:
        return []
    db = 10 * np.log10((signal[: n * frame].reshape(n, frame).astype(np.float64) ** 2).mean(axis=1) + 1e-12)
    loud = np.concatenate([[False], db > db.max() - floor_db, [False]]) & (db.max() > -100)
    edges = np.flatnonzero(loud[1:] != loud[:-1])
    return [(float(a * frame / rate), float(b * frame / rate)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
