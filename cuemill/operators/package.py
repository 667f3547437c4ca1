"""Packaging: the best record of each abbreviation, item metadata, refinement by a denylist, reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X

IDEAL_WORDS = 12


def record_rank(forbidden: str = P.FORBIDDEN_CHARS) -> list[Column]:
    """What makes a record better, first things first. Records whose audio is missing are dropped before."""
    text, expanded = F.coalesce("text", F.lit("")), F.coalesce("text_expanded", F.lit(""))
    clean = X.clean_text(text, forbidden)
    dirty = (clean != text) | (X.clean_text(expanded, forbidden) != expanded)
    return [dirty, F.coalesce(F.size("abbreviations"), F.lit(0)) != 1, X.bad_punctuation(text) + X.bad_punctuation(expanded), F.abs(X.word_count(clean) - IDEAL_WORDS), F.length(clean), F.coalesce("uid", F.lit(10**9))]


def usable(records: DataFrame, audio: DataFrame | None = None) -> DataFrame:
    """Records with a primary abbreviation and, given a table of paths (path), with audio; an empty path is missing."""
    out = records.withColumn("primary_abbr", X.strip(F.col("primary_abbr"))).filter(F.coalesce("primary_abbr", F.lit("")) != "")
    if audio is not None:
        out = out.filter(F.coalesce("audio_path", F.lit("")) != "").join(audio.select(F.col("path").alias("audio_path")).distinct(), "audio_path", "left_semi")
    return out


def best_per_abbr(records: DataFrame, audio: DataFrame | None = None, forbidden: str = P.FORBIDDEN_CHARS) -> DataFrame:
    """One record for each primary abbreviation. A minimum by struct with map-side combine: no group meets in a task."""
    ranked = X.once(usable(records, audio), "_rank", F.struct(*[c.alias(f"r{i}") for i, c in enumerate(record_rank(forbidden))]))
    best = ranked.groupBy("primary_abbr").agg(F.min_by(F.struct(*records.columns), "_rank").alias("r"))
    return best.select("r.*")


def package_document(items: DataFrame, source: str, generated_at: str, forbidden: str = P.FORBIDDEN_CHARS) -> dict:
    """The package's metadata. It has one item for each abbreviation, read row by row."""
    rows = list(_documents(items))
    return {"generated_at": generated_at, "input_manifest": source, "num_items": len(rows), "forbidden_chars_removed": forbidden, "items": rows}


def refined_document(items: DataFrame, removed_abbr: int, source: str, denylist: str, generated_at: str) -> dict:
    rows = list(_documents(items))
    return {"generated_at": generated_at, "source_metadata": source, "num_items": len(rows), "denylist_file": denylist, "removed_abbr_count": removed_abbr, "items": rows}


def _documents(items: DataFrame):
    for row in items.orderBy("id").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator():
        yield json.loads(row[0])


def report_document(report: DataFrame, zip_path: str, metadata_path: str) -> dict:
    """The selection's report: totals, and the counts of what was chosen from."""
    r = report.first().asDict()
    inner = ("groups", "skipped_missing_primary", "skipped_missing_audio", "with_forbidden_available", "without_forbidden_selected")
    return {"input_records": r["input_records"], "selected_records": r["selected_records"], "unique_primary_abbr": r["unique_abbr"], "score_stats": {k: r[k] for k in inner}, "zip_path": zip_path, "metadata_path": metadata_path}


def refine_document(report: DataFrame, zip_path: str, metadata_path: str) -> dict:
    return report.first().asDict() | {"zip_path": zip_path, "metadata_path": metadata_path}


def primary_of(hits: Column, abbr: Column) -> Column:
    """The first hit for the primary abbreviation, else the first hit."""
    return F.coalesce(F.try_element_at(F.filter(hits, lambda h: h["abbr"] == abbr), F.lit(1)), F.try_element_at(hits, F.lit(1)))


def metadata(selected: DataFrame, forbidden: str = P.FORBIDDEN_CHARS) -> DataFrame:
    """Items of the package, numbered from 1 by (primary_abbr, uid). The selection has one row for each abbreviation."""
    h = primary_of(F.col("abbreviations"), F.col("primary_abbr"))
    x = selected.withColumn("_h", h).withColumn("id", F.row_number().over(Window.orderBy("primary_abbr", F.coalesce("uid", F.lit(10**9)))))
    abbr = F.coalesce(F.nullif("primary_abbr", F.lit("")), F.col("_h.abbr"), F.lit(""))
    surface = F.coalesce("_h.surface", abbr)
    hit = F.struct(F.coalesce("_h.abbr", abbr).alias("abbr"), surface.alias("surface"), *[F.col(f"_h.{f}").alias(f) for f in ("span_start", "span_end", "pron_type", "confidence_tier")], *[F.coalesce(f"_h.{f}", F.lit("")).alias(f) for f in ("canonical_reading", "rule_id")], F.coalesce("_h.is_rule_confirmed", F.lit(False)).alias("is_rule_confirmed"))
    mode = F.col("match_mode") if "match_mode" in selected.columns else F.lit(None).cast("string").alias("match_mode")
    return x.select("id", abbr.alias("abbr"), surface.alias("surface"), X.clean_text(F.coalesce("text", F.lit("")), forbidden).alias("text"), X.clean_text(F.coalesce("text_expanded", F.lit("")), forbidden).alias("text_expanded"), audio_name("id", abbr, F.coalesce("video_id", F.lit("video"))).alias("audio_file"), F.col("uid").alias("original_uid"), "video_id", "URL", "start", "end", "source_domain", "source_note", "primary_pron_type", "primary_confidence_tier", mode, hit.alias("abbreviation"), F.col("audio_path").alias("original_audio_path"))


def audio_name(number: str, abbr: Column, video: Column) -> Column:
    return F.format_string("audio/%05d_%s_%s.wav", number, X.safe_name(abbr), X.safe_name(video))


def selection_report(records: DataFrame, audio: DataFrame | None = None, forbidden: str = P.FORBIDDEN_CHARS) -> DataFrame:
    dirty = lambda t: X.clean_text(F.coalesce(t, F.lit("")), forbidden) != F.coalesce(t, F.lit(""))
    ok = usable(records, audio)
    rank = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(record_rank(forbidden))])
    groups = ok.groupBy("primary_abbr").agg(F.max(dirty(F.col("text"))).alias("any_dirty"), F.min_by(dirty(F.col("text")), rank).alias("best_dirty"))
    found = groups.agg(F.count("*").alias("groups"), F.count_if("any_dirty").alias("with_forbidden_available"), F.count_if(~F.col("best_dirty")).alias("without_forbidden_selected"))
    counts = records.agg(F.count("*").alias("input_records"), F.count_if(F.coalesce(X.strip(F.col("primary_abbr")), F.lit("")) == "").alias("skipped_missing_primary"))
    kept = ok.agg(F.count("*").alias("_kept"))
    one = lambda df: df.withColumn("_one", F.lit(1))  # noqa: E731  each side is a single row of totals
    return one(counts).join(one(found), "_one").join(one(kept), "_one").select("input_records", F.col("groups").alias("selected_records"), F.col("groups").alias("unique_abbr"), "groups", "skipped_missing_primary", (F.col("input_records") - F.col("skipped_missing_primary") - F.col("_kept")).alias("skipped_missing_audio"), "with_forbidden_available", "without_forbidden_selected")


def refine(items: DataFrame, denylist: DataFrame) -> DataFrame:
    """Items whose abbreviation the denylist (abbr) lacks, renumbered; a second number goes before the file's name."""
    kept = items.join(denylist.select(F.col("abbr").alias("_deny")).distinct(), F.coalesce(X.strip(F.col("abbr")), F.lit("")) == F.col("_deny"), "left_anti")
    kept = kept.withColumn("_new", F.row_number().over(Window.orderBy("id")))
    return kept.withColumn("audio_file", F.format_string("audio/%05d_%s", "_new", F.substring_index("audio_file", "/", -1))).withColumn("id", F.col("_new")).drop("_new")


def refine_report(items: DataFrame, denylist: DataFrame) -> DataFrame:
    deny = denylist.select(F.col("abbr").alias("_deny")).distinct().withColumn("_hit", F.lit(True))
    x = items.join(deny, F.coalesce(X.strip(F.col("abbr")), F.lit("")) == F.col("_deny"), "left").withColumn("_gone", F.col("_hit").isNotNull())
    gone = F.when(F.col("_gone"), F.col("abbr"))
    return x.agg(F.count("*").alias("input_items"), F.count_if(~F.col("_gone")).alias("kept_items"), F.count_if("_gone").alias("removed_items"), F.count_distinct(gone).alias("removed_unique_abbr"), F.slice(F.array_sort(F.collect_set(gone)), 1, 100).alias("removed_examples"))
