"""Counters and reports over manifests, and what a resumed run starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def counter(records: DataFrame, column: str) -> DataFrame:
    return records.groupBy(column).agg(F.count("*").alias("n"))


def hit_counter(records: DataFrame, hit_field: str) -> DataFrame:
    """Records with each distinct value of a field of their hits: a record counts once for a value."""
    return records.select(F.explode(F.array_distinct(F.transform("abbreviations", lambda h: h[hit_field]))).alias(hit_field)).groupBy(hit_field).agg(F.count("*").alias("n"))


def as_map(counts: DataFrame, key: str) -> DataFrame:
    """One row with the counter as a map, sorted by key."""
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias("counter"))


def manifest_stats(manifest: DataFrame, target: int) -> DataFrame:
    return manifest.agg(F.lit(target).cast("long").alias("target_count"), F.count("*").alias("final_count"), F.count_distinct("video_id").alias("videos"), F.coalesce(F.max("uid"), F.lit(0)).cast("long").alias("max_uid"), F.round(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0.0)), 3).alias("seconds"))


def resume_state(existing: DataFrame) -> tuple[int, int]:
    """Highest uid and number of records of a manifest."""
    r = existing.agg(F.coalesce(F.max("uid"), F.lit(0)).alias("u"), F.count("*").alias("n")).first()
    return int(r["u"]), int(r["n"])


def not_seen(items: DataFrame, existing: DataFrame, mode: str) -> DataFrame:
    """Items whose dedup key no record of the manifest has."""
    keys = existing.select(X.dedup_key(mode, *[F.col(c) for c in ("video_id", "start", "end", "text")]).alias("dedup_key")).filter("dedup_key is not null").distinct()
    return items.join(keys, "dedup_key", "left_anti")


def open_videos(videos: DataFrame, existing: DataFrame, per_video: int) -> DataFrame:
    """Videos that haven't reached their quota."""
    counts = existing.groupBy("video_id").agg(F.count("*").alias("_n"))
    return videos.join(counts, "video_id", "left").filter(F.coalesce("_n", F.lit(0)) < per_video).drop("_n")


def append(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new, allowMissingColumns=True)


def classify_speed(delta: Column) -> Column:
    from ..functions.patterns import BASELINE, SPEED

    return F.when(delta.isNull(), BASELINE).when(delta >= 20, SPEED["normal"]).when(delta >= 5, SPEED["slow"]).otherwise(SPEED["abnormal"])


def classify_failures(lines: Column) -> Column:
    from ..functions.patterns import FAILURE_LEVEL

    return F.when(lines < 10, FAILURE_LEVEL["fine"]).when(lines <= 30, FAILURE_LEVEL["high"]).otherwise(FAILURE_LEVEL["abnormal"])


def failure_counts(lines: DataFrame, by: list[str], line: str = "line") -> DataFrame:
    """Lines that match each failure pattern, and lines that match any."""
    from ..functions.patterns import FAILURES

    hit = {name: F.col(line).rlike(p) for name, p in FAILURES.items()}
    any_hit = F.lit(False)
    for c in hit.values():
        any_hit = any_hit | c
    return lines.groupBy(*by).agg(*[F.count_if(c).alias(name) for name, c in hit.items()], F.count_if(any_hit).alias("failure_lines"))
