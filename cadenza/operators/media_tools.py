"""Media work by command-line tools (probe, transcode, cut, decode), as backends of ``run_backend``.

The tool's name is a parameter; the commands are plain functions of their arguments. An output is written under another name and
renamed, so a task that runs again finds it whole or not at all.
"""

from __future__ import annotations

import os
import subprocess
import uuid
from collections.abc import Callable
from typing import Any

import numpy as np

PROBE, CODER = "ffprobe", "ffmpeg"


def run_tool(command: list[str], timeout: float) -> bytes:
    """What the command prints; a failure carries the beginning of its complaint."""
    done = subprocess.run(command, capture_output=True, timeout=timeout)
    if done.returncode:
        raise RuntimeError(f"{os.path.basename(command[0])}: {done.stderr.decode(errors='replace').strip()[:200]}")
    return done.stdout


def whole_file(command: Callable[[str], list[str]], path: str, timeout: float) -> None:
    """Runs ``command`` of a temporary name beside ``path`` and renames what it wrote; an empty file is a failure."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    stem, dot, suffix = path.rpartition(".")
    part = f"{stem}.{uuid.uuid4().hex[:8]}.part{dot}{suffix}"
    try:
        run_tool(command(part), timeout)
        if not os.path.exists(part) or not os.path.getsize(part):
            raise RuntimeError("nothing was written")
        os.replace(part, path)
    finally:
        if os.path.exists(part):
            os.unlink(part)


def probe_command(path: str, tool: str = PROBE) -> list[str]:
    return [tool, "-v", "error", "-show_entries", "format=duration", "-of", "default=noprint_wrappers=1:nokey=1", path]


def transcode_command(source: str, target: str, bitrate: str = "192k", tool: str = CODER) -> list[str]:
    return [tool, "-hide_banner", "-loglevel", "error", "-y", "-i", source, "-vn", "-map", "a:0?", "-acodec", "libmp3lame", "-b:a", bitrate, target]


def cut_command(source: str, target: str, start: float, end: float, accurate: bool = False, mono: bool = False, rate: int | None = None, threads: int = 1, tool: str = CODER) -> list[str]:
    """Accurate cuts decode from the beginning; fast ones seek before they open the input."""
    head = [tool, "-y", "-v", "error", "-threads", str(threads)]
    seek = ["-i", source, "-ss", f"{start:.6f}", "-to", f"{end:.6f}"] if accurate else ["-ss", f"{start:.6f}", "-t", f"{max(0.0, end - start):.6f}", "-i", source]
    form = (["-ac", "1"] if mono else []) + (["-ar", str(rate)] if rate else []) + ["-c:a", "flac" if target.endswith(".flac") else "pcm_s16le"]
    return [*head, *seek, *form, target]


def decode_command(source: str, start: float, end: float, rate: int = 16_000, tool: str = CODER) -> list[str]:
    return [tool, "-loglevel", "error", "-ss", f"{start:.9f}", "-i", source, "-af", f"aresample={rate},atrim=duration={max(0.0, end - start):.9f},asetpts=PTS-STARTPTS", "-f", "f32le", "-acodec", "pcm_f32le", "-ac", "1", "-ar", str(rate), "pipe:"]


class _Tool:
    def __init__(self, tool: str, timeout: float):
        self.tool, self.timeout = tool, timeout

    def load(self) -> None:
        pass

    def one(self, row: dict[str, Any]) -> dict[str, Any]:
        raise NotImplementedError

    def generate(self, rows: list[dict[str, Any]]) -> list[dict[str, Any]]:
        return [self.one(r) for r in rows]


class Probe(_Tool):
    """duration of ``audio_path`` in seconds; one that isn't a positive number is a failure."""

    def __init__(self, key: str = "audio_path", tool: str = PROBE, timeout: float = 60.0):
        super().__init__(tool, timeout)
        self.key = key

    def one(self, row: dict[str, Any]) -> dict[str, Any]:
        found = float(run_tool(probe_command(row[self.key], self.tool), self.timeout))
        if not found > 0:
            raise ValueError("duration_fail")
        return {"duration": found}


class Transcode(_Tool):
    """mp3_path and status (``reused`` or ``converted``) of a video's sound, beside it."""

    def __init__(self, key: str = "video_path", bitrate: str = "192k", overwrite: bool = False, tool: str = CODER, timeout: float = 6 * 3600.0):
        super().__init__(tool, timeout)
        self.key, self.bitrate, self.overwrite = key, bitrate, overwrite

    def one(self, row: dict[str, Any]) -> dict[str, Any]:
        source = row[self.key]
        target = os.path.splitext(source)[0] + ".mp3"
        if os.path.exists(target) and not self.overwrite:
            return {"mp3_path": target, "status": "reused"}
        whole_file(lambda part: transcode_command(source, part, self.bitrate, self.tool), target, self.timeout)
        return {"mp3_path": target, "status": "converted"}


class CutClip(_Tool):
    """clip_path of the clip ``clip`` (its name), from ``clip_start`` to ``clip_end`` of ``audio_path``, below ``out``."""

    def __init__(self, out: str, accurate: bool = False, mono: bool = False, rate: int | None = None, tool: str = CODER, timeout: float = 3600.0):
        super().__init__(tool, timeout)
        self.out, self.form = out, {"accurate": accurate, "mono": mono, "rate": rate, "tool": tool}

    def one(self, row: dict[str, Any]) -> dict[str, Any]:
        target = os.path.join(self.out, row["clip"])
        whole_file(lambda part: cut_command(row["audio_path"], part, row["clip_start"], row["clip_end"], **self.form), target, self.timeout)
        return {"clip_path": target}


class Decode(_Tool):
    """samples (mono, 32-bit) of a part of ``bucket`` and ``object_key``, or of ``audio_path``; ``sign`` makes the URL of bucket and key, with credentials of its own."""

    def __init__(self, sign: Callable[[str, str], str] | None = None, rate: int = 16_000, tool: str = CODER, timeout: float = 1800.0):
        super().__init__(tool, timeout)
        self.sign, self.rate = sign, rate

    def one(self, row: dict[str, Any]) -> dict[str, Any]:
        source = self.sign(row["bucket"], row["object_key"]) if self.sign and row.get("bucket") else row["audio_path"]
        raw = run_tool(decode_command(source, float(row.get("start") or 0), float(row.get("end") or 0), self.rate, self.tool), self.timeout)
        return {"samples": np.frombuffer(raw[: len(raw) // 4 * 4], dtype="<f4").tolist()}
