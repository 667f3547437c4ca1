"""The engine's inputs as they are drawn from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import abbr, mining
from ..sources.rules import Rule, check

CUE_WORDS, WORD_MS, PAUSE_MS = 8, 300, 700

#: A lexicon of function words, one domain for each language.
LEXICON = {
    "english": ["the", "of", "and", "that", "with", "this", "are"],
    "french": ["le", "les", "des", "qui", "dans", "pour", "sur"],
    "german": ["der", "die", "und", "den", "das", "mit", "ist"],
    "spanish": ["el", "los", "del", "por", "con", "para", "las"],
}

#: Rules for the capital words that the texts hold.
RULES = [
    ("THE", "t h e", "spell_out", "high_conf", "spell_the", "", ""),
    ("OF", "o f", "spell_out", "high_conf", "spell_of", "", ""),
    ("AND", "and", "lexicalized", "low_conf", "lex_and", "ANDS", ""),
    ("DER", "der", "lexicalized", "low_conf", "lex_der", "", ""),
    ("LA", "l a", "spell_out", "low_conf", "spell_la", "", ""),
    ("ER", "e r", "spell_out", "high_conf", "spell_er", "ER-positive", ""),
    ("GNU", "gnu", "lexicalized", "high_conf", "lex_gnu", "", ""),
    ("MIT", "m i t", "spell_out", "high_conf", "spell_mit", "", ""),
]
DENYLIST = ["AND", "LA", "GNU"]


def rules() -> list[Rule]:
    names = ("abbr", "canonical_reading", "pron_type", "confidence_tier", "rule_id", "variants", "notes")
    return check([dict(zip(names, r, strict=True)) for r in RULES])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Words that stand in capitals in the subtitles of the abbreviation miners, where the texts have no abbreviations.
LOUD = ["of", "the", "and", "der", "la", "er", "mit"]
SOURCES = [("unknown", "https://example.org/list/0", ""), ("multi", "https://example.org/list/1", "two"), ("talks", "https://example.org/list/2", ""), ("news", "https://example.org/list/3", "four"), ("unknown", "https://example.org/list/4", "")]


def subtitle_files(spark: SparkSession, sf_dir: str, loud: bool = False) -> DataFrame:
    """Conversations written as subtitle files: video_id, lang, path, body."""
    time = lambda c: F.format_string("%02d:%02d:%02d.%03d", F.floor(c / 3600000), F.floor(c / 60000) % 60, F.floor(c / 1000) % 60, c % 1000)
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    block = F.concat(time(ms("start")), F.lit(" --> "), time(ms("end")), F.lit("\n"), F.col("text"), F.lit("\n"))
    files = cues(spark, sf_dir, loud).groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cue_idx", block.alias("b")))), lambda x: x["b"]), "\n").alias("b"))
    return files.select("video_id", F.lit("en").alias("lang"), F.concat(F.lit("/subtitles/"), "video_id", F.lit(".en.vtt")).alias("path"), F.concat(F.lit("WEBVTT\n\nNOTE made from turns\n\n"), F.col("b")).alias("body"))


def found(spark: SparkSession, sf_dir: str, loud: bool = False) -> mining.Found:
    """Conversations as videos of five sources, listed by number, with one English subtitle each."""
    sources = spark.createDataFrame([(i, *s) for i, s in enumerate(SOURCES)], "source_idx int, domain string, url string, note string")
    videos = table(spark, sf_dir, "conversations").select("conv_id").filter("conv_id is not null").distinct().select("conv_id", F.concat(F.lit("https://example.org/talks/"), F.col("conv_id").cast("string")).alias("url"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("conv_id", "url"))), lambda v: F.struct(v["url"].alias("webpage_url"), F.lit("").alias("url")))
    listings = videos.groupBy(F.concat(F.lit("https://example.org/list/"), (F.col("conv_id") % len(SOURCES)).cast("string")).alias("source_url")).agg(ordered.alias("entries"))
    infos = videos.select("url", F.col("conv_id").cast("string").alias("id"), F.col("url").alias("webpage_url"), F.array(F.struct(F.lit("en").alias("lang"))).alias("subtitles"))
    return mining.find(sources, listings, infos, subtitle_files(spark, sf_dir, loud))


def cues(spark: SparkSession, sf_dir: str, loud: bool = False) -> DataFrame:
    """Cues of eight words from each turn of a conversation; a video is a conversation, its turns are 0.7 s apart, every third one 2.1 s."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"))
    if loud:
        turns = turns.withColumn("words", F.transform("words", lambda w: F.when(w.isin(*LOUD), F.upper(w)).otherwise(w)))
    by = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    pause = F.when(F.col("turn") % 3 == 2, 3 * PAUSE_MS).otherwise(PAUSE_MS)
    at = turns.withColumn("ms", F.coalesce(F.sum(F.size("words") * WORD_MS + pause).over(by), F.lit(0)))
    parts = at.filter(F.size("words") > 0).withColumn("k", F.explode(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / CUE_WORDS).cast("int"))))
    own = F.slice("words", F.col("k") * CUE_WORDS + 1, F.lit(CUE_WORDS))
    start = F.col("ms") + F.col("k") * CUE_WORDS * WORD_MS
    return parts.select(F.col("conv_id").cast("string").alias("video_id"), (F.col("turn") * 100_000 + F.col("k")).alias("cue_idx"), (start / 1000.0).alias("start"), ((start + F.size(own) * WORD_MS - 20) / 1000.0).alias("end"), F.array_join(own, " ").alias("text"))


def abbr_items(spark: SparkSession, sf_dir: str, max_hits: int | None = 3) -> DataFrame:
    """Documents as segments, with rule-confirmed hits: item_id, video_id (the source), start, end, text and hits."""
    docs = table(spark, sf_dir, "documents")
    base = docs.select(F.col("doc_id").alias("item_id"), F.coalesce("source", F.lit("")).alias("video_id"), F.coalesce("lang", F.lit("")).alias("source_domain"), (F.col("doc_id") * 10.0).alias("start"), (F.col("doc_id") * 10.0 + 5.0).alias("end"), F.coalesce("text", F.lit("")).alias("text"))
    return abbr.score(base, rules(), max_hits)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of all rule-confirmed documents."""
    items = abbr_items(spark, sf_dir)
    return items.select(F.col("item_id").alias("uid"), F.concat(F.lit("https://example.org/"), F.col("item_id").cast("string")).alias("URL"), "video_id", "start", "end", X.clip_name(F.col("video_id"), F.col("start"), F.col("end")).alias("audio_path"), F.lit("").alias("subtitle_path"), "text", "text_expanded", "abbreviations", "primary_abbr", "primary_pron_type", "primary_confidence_tier", "source_domain", F.lit("").alias("source_note"))


def md5(text: Column) -> Column:
    return F.md5(text.cast("binary"))
