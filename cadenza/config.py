"""Run settings, with ``key=value`` overrides cast to each field's type."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from typing import Any


@dataclass(frozen=True)
class Settings:
    shard_rows: int = 25_000
    batch: int = 128
    attempts: int = 3
    pad: float = 0.0
    least_clip: float = 0.2
    keep_silence: bool = False
    language_weights: str = '{"en": 0.5, "zh": 0.5}'
    style_weights: str = '{"paragraph": 0.5, "sections": 0.5}'
    harmony_weights: str = '{"basic": 0.5, "degree": 0.5}'
    hide_path: bool = False
    thinking: bool = False


def _cast(text: str, like: Any) -> Any:
    if isinstance(like, bool):
        low = text.strip().lower()
        if low not in {"true", "false", "1", "0", "yes", "no"}:
            raise ValueError(f"not a truth value: {text}")
        return low in {"true", "1", "yes"}
    return type(like)(text)


def override(settings: Settings, changes: list[str]) -> Settings:
    """``settings`` with each ``key=value`` applied; an unknown key is an error."""
    known = {f.name for f in fields(settings)}
    new: dict[str, Any] = {}
    for change in changes:
        key, sep, value = change.partition("=")
        if not sep or key.strip() not in known:
            raise ValueError(f"no such setting: {change}")
        new[key.strip()] = _cast(value, getattr(settings, key.strip()))
    return replace(settings, **new)
