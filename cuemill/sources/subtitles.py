"""Subtitle files (VTT, SRT) and video descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SourceConfig
from ..functions import patterns as P
from ..functions import text as X

#: Fixed value: the form of a bare video id.
VIDEO_ID = r"\A[A-Za-z0-9_-]{11}\z"
_CUE = "\ue000"  # marks a line that opens a cue


def read_subtitles(spark: SparkSession, path: str) -> DataFrame:
    """video_id, lang, body of the newest file <video_id>.<lang>.<vtt|srt> of each video and language below path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{vtt,srt}").load(path)
    name = F.split(F.substring_index("path", "/", -1), r"\.")
    named = files.withColumn("video_id", F.get(name, F.lit(0))).withColumn("lang", F.get(name, F.lit(1)))
    newest = named.groupBy("video_id", "lang").agg(F.max_by("path", "modificationTime").alias("path"))
    # paths first, so that only the newest contents are shuffled
    return files.select("path", "content").join(newest, "path").select("video_id", "lang", "path", F.decode(F.col("content"), "UTF-8").alias("body"))


def cue_parts(body: Column) -> Column:
    """array<struct<header, text>>: one for each line with a time span, with the lines after it up to a blank one.

    The body is cut before the lines that open a cue, so that no array grows line by line; a cue's text is what stands
    before the first blank line of its own piece."""
    lines = F.transform(F.split(F.translate(body, _CUE, "\ufffd"), P.LINE_BREAK), X.strip)
    marked = F.transform(lines, lambda x: F.when(x.rlike(P.TIMESPAN), F.concat(F.lit(_CUE), x)).otherwise(x))
    pieces = F.split(F.concat(F.lit("\n"), F.array_join(marked, "\n")), "\n" + _CUE)
    noise = "(?:" + "|".join(P.CUE_NOISE) + ")"

    def piece(p: Column) -> Column:
        own = F.substring_index(p, "\n\n", 1)
        text = F.regexp_replace(F.concat(F.lit("\n"), F.substr(own, F.length(F.substring_index(own, "\n", 1)) + 2, F.length(own))), rf"\n{noise}[^\n]*", "")
        return F.struct(F.substring_index(own, "\n", 1).alias("header"), F.btrim(F.translate(text, "\n", " ")).alias("text"))

    return F.transform(F.slice(pieces, 2, F.size(pieces)), piece)


def parse_cues(files: DataFrame) -> DataFrame:
    """video_id, cue_idx, start, end, text of files (video_id, body). No shuffle: a file is parsed where it is read."""
    found = files.select("video_id", F.posexplode(cue_parts(F.col("body"))).alias("cue_idx", "c"))
    time = lambda i: X.seconds(F.regexp_extract("c.header", P.TIMESPAN, i))
    cues = found.select("video_id", "cue_idx", time(1).alias("start"), time(2).alias("end"), F.col("c.text").alias("raw"))
    cues = X.once(cues, "text", X.normalize_caption(F.col("raw"))).drop("raw")
    return cues.filter((F.col("text") != "") & ~F.col("text").rlike(P.SOUND_CUE))


def manual_language(subtitles: Column, prefer: str = "en") -> Column:
    """The key of `subtitles` to use: exact, else the last that is equal without case, else the first of the language's family."""
    langs = F.transform(subtitles, lambda s: s["lang"])
    p = prefer.lower()
    exact = F.filter(langs, lambda x: x == prefer)
    same = F.filter(langs, lambda x: F.lower(x) == p)
    family = F.filter(langs, lambda x: F.lower(x).startswith(f"{p}-") | F.lower(x).startswith(f"{p}_"))
    return F.coalesce(F.get(exact, F.lit(0)), F.try_element_at(same, F.lit(-1)), F.get(family, F.lit(0)))


def is_direct_url(url: Column) -> Column:
    return F.contains(url, F.lit("watch?v=")) | F.contains(url, F.lit("youtu.be/")) | F.contains(url, F.lit("/talks/"))


def expand_urls(sources: DataFrame, listings: DataFrame, config: SourceConfig = SourceConfig()) -> DataFrame:
    """source_idx, video_idx, url, domain, note: direct URLs themselves, else the entries of the source's listing
    (source_url, entries), capped, first occurrences only. listings come from the acquisition connector."""
    x = sources.join(listings.select(F.col("source_url").alias("url"), "entries").filter("url is not null").dropDuplicates(["url"]), "url", "left")
    direct = is_direct_url(F.col("url"))
    entries = F.coalesce("entries", F.expr("cast(array() as array<struct<webpage_url:string,url:string>>)"))
    page = lambda e: F.nullif(e["webpage_url"], F.lit(""))
    made = F.transform(entries, lambda e: F.struct(F.coalesce(page(e), F.when(e["url"].rlike(VIDEO_ID), F.concat(F.lit("https://www.youtube.com/watch?v="), e["url"])), F.when(e["url"].startswith("http"), e["url"])).alias("u"), page(e).isNotNull().alias("page")))
    listed = F.filter(made, lambda e: e["u"].isNotNull())
    cap = config.max_videos_per_source
    if config.cap_webpage_urls:
        urls = F.transform(F.slice(listed, 1, cap), lambda e: e["u"])
    else:  # only entries that aren't pages stop at the cap
        kept = F.filter(listed, lambda e, i: e["page"] | (i < cap))
        urls = F.transform(kept, lambda e: e["u"])
    one = F.when(direct, F.array("url")).otherwise(F.array_distinct(urls))
    return x.select("source_idx", "domain", "note", F.posexplode(one).alias("video_idx", "video_url")).withColumnRenamed("video_url", "url")


def unexpanded(sources: DataFrame, listings: DataFrame, config: SourceConfig = SourceConfig()) -> DataFrame:
    """source_idx, url, problem of the sources from which no video comes."""
    made = expand_urls(sources, listings, config).select("source_idx").distinct()
    errors = listings.groupBy(F.col("source_url").alias("url")).agg(F.max("error").alias("error"), F.count("*").alias("_n"))
    x = sources.join(made, "source_idx", "left_anti").join(errors, "url", "left")
    return x.select("source_idx", "url", F.coalesce("error", F.when(F.col("_n").isNull(), "no listing").otherwise("no videos")).alias("problem"))
