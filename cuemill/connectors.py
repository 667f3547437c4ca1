"""Acquisition stays outside of the engine: what it needs from the outside is these calls."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Acquisition(Protocol):
    def describe(self, url: str, flat: bool, end: int | None) -> dict: ...

    def subtitle(self, url: str, lang: str, folder: str) -> str: ...

    def audio(self, url: str, folder: str) -> str: ...

    def cut(self, audio: str, start: float, end: float, target: str) -> bool: ...


def run_command(command: list[str], timeout: float = 45.0) -> tuple[int, str, str]:
    """Exit code (124 on timeout), output and errors."""
    try:
        p = subprocess.run(command, capture_output=True, text=True, timeout=timeout, check=False)
    except subprocess.TimeoutExpired:
        return 124, "", f"timeout after {timeout:g}s"
    return p.returncode, p.stdout, p.stderr


def with_retries(call: Callable[[], dict], retries: int = 2, backoff: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> tuple[dict | None, str]:
    """The first mapping that call returns in retries + 1 attempts, or the last error; waits grow linearly."""
    error = ""
    for n in range(retries + 1):
        try:
            got = call()
            if isinstance(got, dict):
                return got, ""
            error = "not a JSON object"
        except Exception as e:  # noqa: BLE001
            error = str(e)
        if n < retries:
            sleep(backoff * (n + 1))
    return None, error


@dataclass(frozen=True)
class Programs:
    """Acquisition by two external programs: a downloader and a cutter. Folders must be shared by all executors."""

    downloader: str = "yt-dlp"
    cutter: str = "ffmpeg"
    proxy: str = ""
    timeout: float = 45.0
    retries: int = 2
    backoff: float = 2.0
    sample_rate: int = 16000

    def missing(self, audio: bool) -> list[str]:
        return [p for p in (self.downloader, *([self.cutter] if audio else [])) if shutil.which(p) is None]

    def _download(self, *options: str, timeout: float | None = None) -> tuple[int, str, str]:
        proxy = ["--proxy", self.proxy] if self.proxy else []
        return run_command([self.downloader, "--no-warnings", *proxy, *options], timeout or self.timeout)

    def describe(self, url: str, flat: bool, end: int | None) -> dict:
        code, out, err = self._download("--dump-single-json", *(["--flat-playlist"] if flat else []), *(["--playlist-end", str(end)] if end else []), url)
        if code:
            raise RuntimeError(err or f"exit code {code}")
        return json.loads(out)

    def subtitle(self, url: str, lang: str, folder: str) -> str:
        self._download("--skip-download", "--write-subs", "--sub-langs", lang, "--sub-format", "vtt/srt/best", "-o", f"{folder}/%(id)s.%(ext)s", url, timeout=120)
        return folder

    def audio(self, url: str, folder: str) -> str:
        self._download("-x", "--audio-format", "wav", "-o", f"{folder}/%(id)s.%(ext)s", url, timeout=900)
        return folder

    def cut(self, audio: str, start: float, end: float, target: str) -> bool:
        code, _, _ = run_command([self.cutter, "-y", "-loglevel", "error", "-ss", f"{start:.3f}", "-to", f"{end:.3f}", "-i", audio, "-ac", "1", "-ar", str(self.sample_rate), target], 120)
        return code == 0 and os.path.exists(target)


def _map(rows: DataFrame, columns: list[str], call: Callable[..., list], schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """call for each row, where the row is read: executors work side by side, one row at a time in each task."""
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(call(*row), kinds, strict=True)], names)

    return rows.select(*columns).mapInArrow(run, schema)


def describe_urls(urls: DataFrame, programs: Programs, *, flat: bool = False, end: int | None = None) -> DataFrame:
    """url, json, error of each row's url; retried with growing waits."""

    def call(url: str) -> list:
        found, error = with_retries(lambda: programs.describe(url, flat, end), programs.retries, programs.backoff)
        return [url, None if found is None else json.dumps(found), error or None]

    return _map(urls, ["url"], call, "url string, json string, error string", [pa.string()] * 3)


def fetch_subtitles(videos: DataFrame, programs: Programs, folder: str) -> DataFrame:
    """url, folder of each row's subtitle (url, lang), written to the folder."""
    return _map(videos, ["url", "lang"], lambda url, lang: [url, programs.subtitle(url, lang, folder)], "url string, folder string", [pa.string()] * 2)


def cut_clips(programs: Programs, out_dir: str, keep_audio: bool = False) -> Callable[[DataFrame], DataFrame]:
    """A function that makes the clips of selected segments and returns the item_ids whose clip failed. A video's
    segments go to one task, which fetches its audio once; a clip that is there is not cut again."""
    from .functions.text import clip_name

    full, clips = f"{out_dir}/full_audio", f"{out_dir}/clips_wav"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(full, exist_ok=True)
        os.makedirs(clips, exist_ok=True)
        now = None
        for batch in batches:
            failed = []
            for item, video, url, start, end, name in zip(*(batch.column(c).to_pylist() for c in ("item_id", "video_id", "URL_", "start", "end", "clip")), strict=True):
                source, target = f"{full}/{video}.wav", f"{clips}/{name}"
                if now not in (None, video) and not keep_audio and os.path.exists(f"{full}/{now}.wav"):
                    os.remove(f"{full}/{now}.wav")
                now = video
                if os.path.exists(target):
                    continue
                if not os.path.exists(source):
                    programs.audio(url, full)
                if not os.path.exists(source) or not programs.cut(source, start, end, target):
                    failed.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(failed, pa.int64())], ["item_id"])
        if now is not None and not keep_audio and os.path.exists(f"{full}/{now}.wav"):
            os.remove(f"{full}/{now}.wav")

    def make(selected: DataFrame) -> DataFrame:
        rows = selected.withColumn("clip", clip_name(F.col("video_id"), F.col("start"), F.col("end")))
        return rows.select("item_id", "video_id", "URL_", "start", "end", "clip").repartition("video_id").sortWithinPartitions("video_id", "start").mapInArrow(run, "item_id long")

    return make


def present_files(paths: DataFrame) -> DataFrame:
    """path of each row's audio_path that is a file, looked up by the executors."""
    found = _map(paths, ["audio_path"], lambda p: [p, os.path.isfile(p.removeprefix("file://"))], "path string, present boolean", [pa.string(), pa.bool_()])
    return found.filter("present").select("path")


def alive(session: str, pattern: str, folder: str) -> tuple[bool, bool]:
    """Whether the terminal session and a process with both texts in its command run on this machine."""
    terminal = shutil.which("tmux") is not None and run_command(["tmux", "has-session", "-t", session], 10)[0] == 0
    _, listed, _ = run_command(["ps", "-eo", "args"], 10)
    return terminal, any(pattern in x and folder in x and "monitor" not in x for x in listed.splitlines())
