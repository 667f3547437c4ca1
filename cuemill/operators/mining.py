"""The three miners: sources to manifest.

Videos come in the order of sources and listings, segments in their order inside a video. Everything before the
selection runs on all executors; the selection gets narrow rows of the segments that passed scoring, and the records
are joined back to what it takes. Scored segments and what is selected are staged: selection, records and counters read
them, and no file is parsed twice. Selections are resumed from the records of an earlier manifest: its highest uid, its
counts by video, domain, abbreviation, type and tier, and its dedup keys.

Acquisition is data here: `listings` (source_url, entries), `infos` (url, id, webpage_url, subtitles) and `subtitles`
(video_id, lang, path, body) come from files or from the connectors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AbbreviationConfig, RareWordConfig, SegmentConfig, SourceConfig
from ..functions import patterns as P
from ..functions import text as X
from ..sources import subtitles as S
from ..sources.rules import Rule, quota_plan
from ..staging import staged
from . import abbr, score, segment, stats
from .select import Quotas, binding, ranked, sequential


@dataclass(frozen=True)
class Found:
    """videos: one row for each inspected video of each source, failed ones too. sources: all of them, expanded or not."""

    sources: DataFrame
    videos: DataFrame
    segments: DataFrame


@dataclass
class Mined:
    records: DataFrame
    stats: dict = field(default_factory=dict)


def find(sources: DataFrame, listings: DataFrame, infos: DataFrame, subtitles: DataFrame, *, source: SourceConfig = SourceConfig(), cut: SegmentConfig = SegmentConfig()) -> Found:
    """Videos with a manual subtitle of the preferred language and their segments.

    A source without a video is a failure, a video without an info is one; videos without a language, an id, a
    subtitle, cues or segments have no rows in segments. Lineage (domain and note of the source) travels along."""
    urls = S.expand_urls(sources, listings, source)
    known = infos.select("url", F.struct("id", "webpage_url", S.manual_language(F.col("subtitles"), source.prefer_lang).alias("lang")).alias("info")).filter("url is not null")
    videos = urls.join(known.dropDuplicates(["url"]), "url", "left")
    videos = videos.select("source_idx", "video_idx", "url", "domain", "note", F.nullif("info.id", F.lit("")).alias("video_id"), F.coalesce(F.nullif("info.webpage_url", F.lit("")), "url").alias("URL_"), F.col("info.lang").alias("lang"), F.col("info").isNull().alias("failed"))
    videos = staged(videos, "mine-videos")
    files = subtitles.select("video_id", "lang", F.col("path").alias("subtitle_path"), "body").filter(has_text("body"))
    wanted = videos.filter(F.col("video_id").isNotNull() & F.col("lang").isNotNull())
    # each file is parsed once, however many sources list its video
    own = files.join(wanted.select("video_id", "lang").distinct(), ["video_id", "lang"], "left_semi").withColumn("file", F.struct("video_id", "lang", "subtitle_path"))
    cues = S.parse_cues(own.select(F.col("file").alias("video_id"), "body"))
    parts = segment.segments(cues, cut).select("video_id.*", "seg_ord", "start", "end", "text")
    placed = parts.join(wanted, ["video_id", "lang"])
    return Found(sources, videos, placed.withColumn("item_id", item_id()))


def has_text(name: str) -> Column:
    return F.coalesce(X.strip(F.col(name)), F.lit("")) != ""


def item_id() -> Column:
    """A number that is the place of a segment: its source, video and order (20 bits each for the last two)."""
    return F.shiftleft(F.col("source_idx").cast("long"), 40) + F.shiftleft(F.col("video_idx").cast("long"), 20) + F.col("seg_ord")


def paths(out_dir: str, mode: str, audio: bool) -> tuple[Column, Column]:
    """audio_path and subtitle_path of a record."""
    clip = X.clip_name(F.col("video_id"), F.col("start"), F.col("end"))
    clip = X.manifest_path(F.concat(F.lit("clips_wav/"), clip), out_dir, mode) if audio else F.lit("")
    base = out_dir.rstrip("/") + "/"
    name = F.regexp_replace("subtitle_path", r"\Afile:(//)?(?=/)", "")
    sub = F.when(name.startswith(base), F.substr(name, F.lit(len(base) + 1))).otherwise(name) if mode == "relative" else name
    return clip, sub


def _resumed(existing: DataFrame | None, field_counts: dict[str, Callable[[DataFrame], DataFrame]]) -> tuple[int, Counter, dict[str, Counter]]:
    """Highest uid, records by video, and the counts asked for. What is collected are counters of a manifest, which its target bounds."""
    if existing is None:
        return 0, Counter(), {k: Counter() for k in field_counts}
    uid, _ = stats.resume_state(existing)
    videos = Counter({r[0]: r["n"] for r in stats.counter(existing.filter(has_text("video_id")), "video_id").collect()})
    return uid, videos, {k: Counter({r[0]: r["n"] for r in f(existing).collect() if r[0]}) for k, f in field_counts.items()}


def _select(items: DataFrame, wide: DataFrame, order: list[str], quotas: Quotas, uid: int, mode: str, cut: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """item_id and uid. Ranks select where no cap can bind but that of a video and keys (of the mode) repeat only inside a
    video, else a fold. cut makes the clips of what is selected (rows of wide) and returns the item_ids that failed; those are left
    out and the selection is made anew, until none fails: the same as trying each clip when it is selected."""
    pick = sequential if mode == "text" or binding(quotas, items.count()) else ranked
    while True:
        chosen = pick(items, order, quotas, uid + 1)
        if cut is None:
            return staged(chosen, "mine-chosen")
        rows = [tuple(r) for r in chosen.collect()]  # at most the target
        chosen = items.sparkSession.createDataFrame(rows, "item_id long, uid long")
        failed = [r[0] for r in cut(wide.join(F.broadcast(chosen), "item_id")).select("item_id").collect()]
        if not failed:
            return chosen
        items = items.join(F.broadcast(items.sparkSession.createDataFrame([(x,) for x in failed], "item_id long")), "item_id", "left_anti")


def _open(found: Found, existing: DataFrame | None, per_video: int, mode: str) -> DataFrame:
    """Segments of videos below their quota, with the dedup key, without those whose key a record has."""
    rows = found.segments.withColumn("dedup_key", X.dedup_key(mode, *[F.col(c) for c in ("video_id", "start", "end", "text")]))
    if existing is None:
        return rows
    rows = stats.open_videos(rows, existing, per_video)
    return rows if mode == "none" else stats.not_seen(rows, existing, mode)


def _counts(found: Found, chosen: DataFrame, uid: int, target: int, before: dict) -> dict:
    """Counters of the run up to the video with which the target was reached, added to those of the run before."""
    place = F.struct(F.shiftright("item_id", 40).cast("int").alias("source_idx"), (F.shiftright("item_id", 20) % (1 << 20)).cast("int").alias("video_idx"))
    taken = chosen.agg(F.count("*").alias("n"), F.max("uid").alias("uid"), F.count_distinct(place).alias("kept"), F.max_by(place, "uid").alias("last")).first()
    videos = found.videos.select("source_idx", "video_idx", "failed")
    sources = found.sources.select("source_idx")
    if (taken["uid"] or uid) >= target and taken["last"] is not None:
        last = taken["last"]
        videos = videos.filter(F.struct("source_idx", "video_idx") <= F.struct(F.lit(last["source_idx"]), F.lit(last["video_idx"])))
        sources = sources.filter(F.col("source_idx") <= last["source_idx"])
    seen = videos.agg(F.count("*").alias("n"), F.count_if("failed").alias("failed")).first()
    empty = sources.join(found.videos.select("source_idx").distinct(), "source_idx", "left_anti").count()
    add = {"inspected_videos": seen["n"], "kept_videos": taken["kept"], "source_expand_failures": empty, "video_info_failures": seen["failed"]}
    return {k: int(before.get(k) or 0) + int(v) for k, v in add.items()}


def _sorted_map(counts: Counter) -> dict:
    return {k: counts[k] for k in sorted(counts)}


def mine_rare_words(found: Found, vocab: DataFrame, *, config: RareWordConfig = RareWordConfig(), out_dir: str = "", existing: DataFrame | None = None, before: dict | None = None, lexicon: dict | None = None, cut: Callable[[DataFrame], DataFrame] | None = None) -> Mined:
    """The manifest of segments with one to max_rare_words rare or unknown words (vocab: word, in_low, in_high)."""
    uid, videos, counts = _resumed(existing, {"domain": lambda m: stats.counter(m, "domain")})
    items = staged(_open(found, existing, config.max_per_video, config.dedup_key), "mine-segments")
    words = score.rare_words(items, vocab, "item_id")
    kept = score.gate(items.join(words, "item_id"), config, lexicon)
    kept = staged(kept.withColumn("found_domain", score.assign_domain(F.col("domain"), F.col("domains"))), "mine-kept")
    narrow = kept.select("item_id", "video_id", "dedup_key", F.array("found_domain").alias("domain"), "start", "end")
    cap = {"domain": config.max_per_domain} if config.max_per_domain else {}
    quotas = Quotas(target=config.target_count, per_video=config.max_per_video, caps=cap, taken=uid, videos=videos, counts=counts)
    chosen = _select(narrow, kept, ["item_id"], quotas, uid, config.dedup_key, cut)
    audio, sub = paths(out_dir, config.path_mode, True)
    new = kept.join(chosen, "item_id").select(
        F.col("uid"), F.col("URL_").alias("URL"), F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "text", audio.alias("audio_path"), "video_id", F.col("lang").alias("subtitle_lang"),
        F.col("found_domain").alias("domain"), "rare_words", "freq_1_9_words", "oov_words", "entities", sub.alias("subtitle_path"), F.col("domain").alias("source_domain"), F.col("note").alias("source_note"),
    )
    return Mined(new if existing is None else stats.append(existing, new), _counts(found, chosen, uid, config.target_count, before or {}))


def _mine_abbreviations(found: Found, rules: list[Rule] | None, config: AbbreviationConfig, out_dir: str, existing: DataFrame | None, before: dict | None, audio: bool, cut: Callable | None, path_mode: str) -> Mined:
    classes = {"abbr": "abbr", "pron": "pron_type"} | ({"tier": "confidence_tier"} if rules is not None else {})
    uid, videos, counts = _resumed(existing, {k: (lambda m, f=f: stats.hit_counter(m, f)) for k, f in classes.items()})
    items = _open(found, existing, config.max_per_video, config.dedup_key)
    kept = abbr.score(items, rules, config.max_abbrs_per_sentence, key="item_id")
    kept = staged(kept.withColumn("n_candidates", F.size(X.abbreviation_candidates(F.col("text")))), "mine-kept")
    values = lambda f: F.array_distinct(F.transform("abbreviations", lambda h: h[f]))
    narrow = kept.select("item_id", "video_id", "dedup_key", *[values(f).alias(k) for k, f in classes.items()], F.col("primary_pron_type").alias("primary_pron"), F.col("primary_confidence_tier").alias("primary_tier"), "source_idx", "video_idx", "n_candidates", "start", "end", "seg_ord")
    quotas = Quotas(target=config.target_count, per_video=config.max_per_video, caps={"abbr": config.max_per_abbr}, taken=uid, videos=videos, counts=counts)
    if rules is not None:
        pron, tier = quota_plan(rules, config.target_count)
        quotas = replace(quotas, primary={"pron": pron, "tier": tier})
    chosen = _select(narrow, kept, ["source_idx", "video_idx", "n_candidates", "start", "seg_ord"], quotas, uid, config.dedup_key, cut)
    clip, sub = paths(out_dir, path_mode, audio)
    extra = ["match_mode"] if rules is None else []
    new = kept.join(chosen, "item_id").select("uid", F.col("URL_").alias("URL"), "video_id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), clip.alias("audio_path"), sub.alias("subtitle_path"), "text", "text_expanded", "abbreviations", "primary_abbr", "primary_pron_type", "primary_confidence_tier", F.col("domain").alias("source_domain"), F.col("note").alias("source_note"), *extra)
    return Mined(new if existing is None else stats.append(existing, new), _counts(found, chosen, uid, config.target_count, before or {}))


def mine_abbreviations(found: Found, rules: list[Rule], *, config: AbbreviationConfig = AbbreviationConfig(), out_dir: str = "", existing: DataFrame | None = None, before: dict | None = None, audio: bool = False, cut: Callable[[DataFrame], DataFrame] | None = None, path_mode: str = "absolute") -> Mined:
    """The manifest of segments with rule-confirmed abbreviations, under quotas by pronunciation type and tier."""
    return _mine_abbreviations(found, rules, config, out_dir, existing, before, audio, cut, path_mode)


def mine_candidates(found: Found, *, config: AbbreviationConfig = AbbreviationConfig(), out_dir: str = "", existing: DataFrame | None = None, before: dict | None = None, audio: bool = False, cut: Callable[[DataFrame], DataFrame] | None = None, path_mode: str = "absolute") -> Mined:
    """The manifest of segments with anything that looks like an abbreviation, without rules."""
    return _mine_abbreviations(found, None, config, out_dir, existing, before, audio, cut, path_mode)


def stats_document(mined: Mined, kind: str, target: int) -> dict:
    """The run's statistics: kind is rare_words, abbreviations or candidates. Counters are bounded by the manifest."""
    n = mined.records.count()
    out = {"target_count": target, "final_count": n, **{k: mined.stats.get(k, 0) for k in ("inspected_videos", "kept_videos", "source_expand_failures", "video_info_failures")}}
    hits = lambda f: _sorted_map(Counter({r[0]: r["n"] for r in stats.hit_counter(mined.records, f).collect()}))
    if kind == "rare_words":
        first = mined.records.filter(has_text("domain")).groupBy("domain").agg(F.count("*").alias("n"), F.min("uid").alias("uid"))
        return out | {"domain_counter": {r["domain"]: r["n"] for r in sorted(first.collect(), key=lambda r: r["uid"])}}
    if kind == "candidates":
        out["match_mode"] = P.CANDIDATE_ONLY
    out |= {"abbr_counter": hits("abbr"), "pron_type_counter": hits("pron_type")}
    return out | ({"confidence_tier_counter": hits("confidence_tier")} if kind == "abbreviations" else {})
