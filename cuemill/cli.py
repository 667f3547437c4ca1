"""Commands: python -m cuemill.cli {mine-rare,mine-abbreviations,mine-candidates,package,refine,monitor} ...

The miners read what was acquired (listings, infos, subtitles) from files; with --acquire the external programs fetch
it first. Sources are mined in groups; a group's records are saved once save_every new ones have come, and --resume
goes on from the saved manifest.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import connectors, schemas, sinks
from .config import AbbreviationConfig, RareWordConfig, SegmentConfig, SourceConfig
from .operators import abbr, mining, package
from .sources import files, rules, subtitles
from .streaming import monitor

KINDS = {"mine-rare": "rare_words", "mine-abbreviations": "abbreviations", "mine-candidates": "candidates"}
SCHEMAS = {"rare_words": schemas.RARE_MANIFEST, "abbreviations": schemas.ABBR_MANIFEST, "candidates": schemas.CANDIDATE_MANIFEST}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="cuemill")
    commands = out.add_subparsers(dest="command", required=True)
    flag = {"action": "store_true", "default": False}
    for name, target, per_video, save in (("mine-rare", 10_000, 30, 200), ("mine-abbreviations", 2000, 10, 100), ("mine-candidates", 2000, 10, 100)):
        p = commands.add_parser(name)
        p.add_argument("--seed-file", required=True)
        p.add_argument("--out-dir", required=True)
        p.add_argument("--listings", help="JSON lines: source_url, entries, error (out-dir/listings)")
        p.add_argument("--infos", help="JSON lines: url, id, webpage_url, subtitles, error (out-dir/infos)")
        p.add_argument("--subtitles", help="folder of <id>.<lang>.<vtt|srt> (out-dir/subtitles)")
        p.add_argument("--acquire", help="fetch listings, infos and subtitles with the external programs first", **flag)
        p.add_argument("--target-count", type=int, default=target)
        p.add_argument("--lang", default="en")
        p.add_argument("--max-videos-per-source", type=int, default=400)
        p.add_argument("--max-segments-per-video", type=int, default=per_video)
        p.add_argument("--min-duration", type=float, default=5.0)
        p.add_argument("--max-duration", type=float, default=30.0)
        p.add_argument("--max-gap", type=float, default=1.2)
        p.add_argument("--download-audio", **flag)
        p.add_argument("--sample-rate", type=int, default=16000, choices=[16000, 22050, 24000])
        p.add_argument("--keep-full-audio", **flag)
        p.add_argument("--cmd-timeout", type=float, default=45.0)
        p.add_argument("--proxy", default="")
        p.add_argument("--expand-retries", type=int, default=2)
        p.add_argument("--expand-backoff", type=float, default=2.0)
        p.add_argument("--fail-on-source-expand-error", **flag)
        p.add_argument("--save-every", type=int, default=save, help="0: only at the end")
        p.add_argument("--sources-at-once", type=int, default=64, help="sources that are mined between two saves at most")
        p.add_argument("--resume", **flag)
        p.add_argument("--path-mode", choices=["absolute", "relative"], default="absolute")
        p.add_argument("--dedup-key", choices=["text", "segment", "none"], default="text")
        if name == "mine-rare":
            p.add_argument("--vocab-min1", required=True)
            p.add_argument("--vocab-min10", required=True)
            p.add_argument("--max-rare-per-sentence", type=int, default=3)
            p.add_argument("--require-science-keyword", action=argparse.BooleanOptionalAction, default=True)
            p.add_argument("--require-entity", **flag)
            p.add_argument("--max-per-domain", type=int, default=0)
        else:
            p.add_argument("--max-per-abbr", type=int, default=3)
            p.add_argument("--max-abbrs-per-sentence", type=int, default=2)
        if name == "mine-abbreviations":
            p.add_argument("--rule-file", required=True)
    p = commands.add_parser("package")
    p.add_argument("--input-manifest", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--forbidden-chars", default=":[]")
    p.add_argument("--zip-name", default="audio.zip")
    p = commands.add_parser("refine")
    p.add_argument("--input-metadata", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--denylist-file", required=True)
    p.add_argument("--zip-name", default="audio.zip")
    p = commands.add_parser("monitor")
    p.add_argument("--run-dir", required=True)
    p.add_argument("--session-name", required=True)
    p.add_argument("--source-pool", required=True, choices=["stable_ted", "stable_direct", "broad_pool"])
    p.add_argument("--source-config", required=True)
    p.add_argument("--process-pattern", default="cuemill.cli")
    p.add_argument("--interval-sec", type=int, default=600)
    p.add_argument("--loop", **flag)
    return out


def _say(text: str) -> None:
    print(text, file=sys.stderr, flush=True)


def _acquire(spark: SparkSession, a: argparse.Namespace, sources: DataFrame, programs: connectors.Programs) -> None:
    """Listings of the sources, infos of their videos and subtitles of those, each written before the next begins."""
    raw = "id string, webpage_url string, subtitles map<string,array<struct<ext:string,url:string>>>, entries array<struct<webpage_url:string,url:string>>"
    spread = lambda df: df.repartition(max(1, min(256, df.count())))  # noqa: E731  programs wait more than they work
    wide = sources.filter(~subtitles.is_direct_url(F.col("url"))).select("url").distinct()
    found = connectors.describe_urls(spread(wide), programs, flat=True, end=a.max_videos_per_source)
    found.select(F.col("url").alias("source_url"), F.from_json("json", raw)["entries"].alias("entries"), "error").write.mode("overwrite").json(a.listings)
    urls = subtitles.expand_urls(sources, files.listings(spark, a.listings), SourceConfig(a.max_videos_per_source, a.command != "mine-rare", a.lang)).select("url").distinct()
    infos = connectors.describe_urls(spread(urls), programs)
    infos.select("url", F.from_json("json", raw).alias("i"), "error").select("url", "i.id", "i.webpage_url", "i.subtitles", "error").write.mode("overwrite").json(a.infos)
    wanted = files.infos(spark, a.infos).select("url", subtitles.manual_language(F.col("subtitles"), a.lang).alias("lang")).filter("lang is not null")
    Path(a.subtitles).mkdir(parents=True, exist_ok=True)
    connectors.fetch_subtitles(spread(wanted), programs, a.subtitles).count()


def mine(spark: SparkSession, a: argparse.Namespace) -> dict:
    kind, out = KINDS[a.command], a.out_dir.rstrip("/")
    out = out if "://" in out else str(Path(out).resolve())
    a.listings, a.infos, a.subtitles = a.listings or f"{out}/listings", a.infos or f"{out}/infos", a.subtitles or f"{out}/subtitles"
    programs = connectors.Programs(proxy=a.proxy.strip(), timeout=a.cmd_timeout, retries=max(0, a.expand_retries), backoff=max(0.0, a.expand_backoff), sample_rate=a.sample_rate)
    if (a.acquire or a.download_audio) and (lost := programs.missing(a.download_audio)):
        raise RuntimeError(f"not found in PATH: {', '.join(lost)}")
    source = SourceConfig(a.max_videos_per_source, kind != "rare_words", a.lang)
    sources = files.seed_sources(spark, a.seed_file)
    order = sorted(r[0] for r in sources.select("source_idx").collect())  # one small file
    if not order:
        raise RuntimeError(f"no sources in {a.seed_file}")
    if a.acquire:
        _acquire(spark, a, sources, programs)
    cut = connectors.cut_clips(programs, out, a.keep_full_audio) if a.download_audio else None
    run = _miner(spark, a, kind, out, cut)
    saved = f"{out}/manifest.jsonl"
    existing, before = (files.records(spark, saved, SCHEMAS[kind]), files.stored_stats(f"{out}/stats.json") if kind == "rare_words" else {}) if a.resume and files.exists(spark, saved) else (None, {})
    if existing is not None:
        existing = _held(spark, existing.filter("uid is not null"), SCHEMAS[kind])
        _say(f"[INFO] resume loaded records={existing.count()}")
    listings = files.listings(spark, a.listings) if files.exists(spark, a.listings) else spark.createDataFrame([], "source_url string, entries array<struct<webpage_url:string,url:string>>, error string")
    for r in subtitles.unexpanded(sources, listings, source).orderBy("source_idx").collect():
        if a.fail_on_source_expand_error:
            raise RuntimeError(f"expand failed url={r['url']} err={r['problem']}")
        _say(f"[WARN] expand failed url={r['url']} err={r['problem']}")
    infos, texts = files.infos(spark, a.infos), subtitles.read_subtitles(spark, a.subtitles)
    limits = SegmentConfig(a.min_duration, a.max_duration, a.max_gap)
    state = mining.Mined(existing if existing is not None else spark.createDataFrame([], SCHEMAS[kind]), dict(before))
    uid, unsaved, group = _top(existing), 0, a.sources_at_once if a.save_every > 0 else len(order)
    for i in range(0, len(order), group):
        if uid >= a.target_count:
            break
        own = sources.filter(F.col("source_idx").between(order[i], order[min(i + group, len(order)) - 1]))
        for r in own.orderBy("source_idx").collect():
            _say(f"[INFO] source={r['url']}")
        found = mining.find(own, listings, infos, texts, source=source, cut=limits)
        state = run(found, existing, state.stats)
        existing = _held(spark, state.records, SCHEMAS[kind])
        state.records = existing
        top = _top(existing)
        unsaved, uid = unsaved + top - uid, top
        if a.save_every > 0 and unsaved >= a.save_every:
            _save(state, kind, a, out)
            _say(f"[INFO] checkpoint saved records={existing.count()}")
            unsaved = 0
    return _save(state, kind, a, out)


def _top(records: DataFrame | None) -> int:
    return 0 if records is None else records.agg(F.coalesce(F.max("uid"), F.lit(0))).first()[0]


def _held(spark: SparkSession, records: DataFrame, schema: str) -> DataFrame:
    """Records as a table of their own, without the plan that made them. The target bounds a manifest."""
    return spark.createDataFrame(records.toArrow(), schema)


def _miner(spark: SparkSession, a: argparse.Namespace, kind: str, out: str, cut: Callable | None) -> Callable:
    if kind == "rare_words":
        vocab = files.vocabulary(spark, a.vocab_min1, a.vocab_min10)
        config = RareWordConfig(a.target_count, a.max_segments_per_video, a.max_per_domain, a.max_rare_per_sentence, a.require_science_keyword, a.require_entity, a.dedup_key, a.path_mode, a.save_every)
        return lambda found, existing, before: mining.mine_rare_words(found, vocab, config=config, out_dir=out, existing=existing, before=before, cut=cut)
    config = AbbreviationConfig(a.target_count, a.max_segments_per_video, a.max_per_abbr, a.max_abbrs_per_sentence, a.dedup_key, a.save_every)
    more = {"config": config, "out_dir": out, "audio": a.download_audio, "cut": cut, "path_mode": a.path_mode}
    if kind == "candidates":
        return lambda found, existing, before: mining.mine_candidates(found, existing=existing, before=before, **more)
    known = rules.load_rules(spark, a.rule_file)
    return lambda found, existing, before: mining.mine_abbreviations(found, known, existing=existing, before=before, **more)


def _save(state: mining.Mined, kind: str, a: argparse.Namespace, out: str) -> dict:
    sinks.write_manifest(state.records, f"{out}/manifest.json", f"{out}/manifest.jsonl")
    if kind != "rare_words":
        sinks.write_lines(abbr.audit(state.records), f"{out}/rule_audit.jsonl", ["uid"])
        sinks.write_sheet(abbr.review(state.records), f"{out}/sample_review.tsv", ["uid"])
    document = mining.stats_document(state, kind, a.target_count)
    sinks.write_document(document, f"{out}/stats.json")
    return document


def _now() -> str:
    return datetime.now().astimezone().strftime("%Y-%m-%d %H:%M:%S %Z").strip()


def package_command(spark: SparkSession, a: argparse.Namespace) -> dict:
    manifest = files.records(spark, a.input_manifest, schemas.CANDIDATE_MANIFEST)
    at = manifest.select("audio_path").filter(mining.has_text("audio_path")).distinct()
    present = connectors.present_files(at)
    items = package.metadata(package.best_per_abbr(manifest, present, a.forbidden_chars), a.forbidden_chars)
    zipped, metadata = f"{a.output_dir}/{a.zip_name}", f"{a.output_dir}/metadata.json"
    document = package.package_document(items, a.input_manifest, _now(), a.forbidden_chars)
    Path(a.output_dir).mkdir(parents=True, exist_ok=True)
    sinks.write_zip([(x["original_audio_path"], x["audio_file"]) for x in document["items"]], zipped)
    sinks.write_document(document, metadata)
    report = package.report_document(package.selection_report(manifest, present, a.forbidden_chars), zipped, metadata)
    sinks.write_document(report, f"{a.output_dir}/selection_report.json")
    return report


def refine_command(spark: SparkSession, a: argparse.Namespace) -> dict:
    raw = spark.read.json(a.input_metadata, multiLine=True, schema=f"items array<{schemas.ITEM}>").select(F.explode("items").alias("i")).select("i.*")
    deny = files.denylist(spark, a.denylist_file)
    kept, totals = package.refine(raw, deny), package.refine_report(raw, deny)
    zipped, metadata = f"{a.output_dir}/{a.zip_name}", f"{a.output_dir}/metadata.json"
    report = package.refine_document(totals, zipped, metadata)
    document = package.refined_document(kept, report["removed_unique_abbr"], a.input_metadata, a.denylist_file, _now())
    Path(a.output_dir).mkdir(parents=True, exist_ok=True)
    sinks.write_zip([(x["original_audio_path"], x["audio_file"]) for x in document["items"]], zipped)
    sinks.write_document(document, metadata)
    sinks.write_document(report, f"{a.output_dir}/selection_report.json")
    return report


def monitor_command(spark: SparkSession, a: argparse.Namespace) -> dict | None:
    run = monitor.Run(a.run_dir, a.source_pool, files.pool_config(spark, a.source_config), a.session_name, lambda: connectors.alive(a.session_name, a.process_pattern, a.run_dir))
    if not a.loop:
        return monitor.run_once(spark, run)
    monitor.watch(spark, run, checkpoint=f"{run.monitoring}/checkpoint", every=a.interval_sec).awaitTermination()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("cuemill").getOrCreate()
    do = {"package": package_command, "refine": refine_command, "monitor": monitor_command}.get(a.command, mine)
    try:
        print(json.dumps(do(spark, a), ensure_ascii=False, indent=2))
    except Exception as e:  # noqa: BLE001
        _say(f"[ERROR] {e}")
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
