"""Configuration: merged YAML files and an order-sensitive hash that guards appends."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any


def merged(base: Mapping[str, Any], override: Mapping[str, Any]) -> dict[str, Any]:
    """``base`` with ``override`` on top: mappings merge, everything else is replaced."""
    out = dict(base)
    for key, value in override.items():
        both = isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
        out[key] = merged(out[key], value) if both else value
    return out


def load(paths: Sequence[str]) -> dict[str, Any]:
    """YAML files merged in order, later ones win."""
    import yaml

    out: dict[str, Any] = {}
    for path in paths:
        out = merged(out, yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
    return out


def config_hash(config: Any) -> str:
    """A digest in which the order of tiers counts, as it decides results."""
    return hashlib.sha1(json.dumps(config, ensure_ascii=False, default=str).encode()).hexdigest()[:16]
