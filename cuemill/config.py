"""Settings of the miners, the packager and the monitor."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SegmentConfig:
    min_duration: float = 5.0
    max_duration: float = 30.0
    max_gap: float = 1.2


@dataclass(frozen=True)
class RareWordConfig:
    target_count: int = 10_000
    max_per_video: int = 30
    max_per_domain: int = 0
    max_rare_words: int = 3
    require_keyword: bool = True
    require_entity: bool = False
    dedup_key: str = "text"  # none, segment or text
    path_mode: str = "absolute"
    save_every: int = 200


@dataclass(frozen=True)
class AbbreviationConfig:
    target_count: int = 2_000
    max_per_video: int = 10
    max_per_abbr: int = 3
    max_abbrs_per_sentence: int = 2
    dedup_key: str = "text"
    save_every: int = 100


@dataclass(frozen=True)
class SourceConfig:
    max_videos_per_source: int = 400
    cap_webpage_urls: bool = False
    prefer_lang: str = "en"
