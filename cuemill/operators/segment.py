"""Cues to segments: an ordered fold over each video's cues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SegmentConfig
from ..functions import patterns as P
from ..functions.text import normalize_caption

_SEGMENT = "struct<start:double,end:double,text:string>"


def fold_cues(cues: Column, config: SegmentConfig = SegmentConfig()) -> Column:
    """array<struct<start, end, texts>> of an ordered array of cues. The cue that opens a segment is tested neither for
    a sentence end nor for length; gaps are compared as doubles, as they come."""
    empty = F.expr("cast(array() as array<struct<start:double,end:double,text:string>>)")
    none = F.expr(f"cast(null as {_SEGMENT})")

    def flushed(acc: Column) -> Column:
        return F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))

    def step(acc: Column, cue: Column) -> Column:
        fresh = F.struct(cue["start"].alias("start"), cue["end"].alias("end"), cue["text"].alias("text"))
        opens = acc["open"].isNull() | (cue["start"] - acc["open"]["end"] > config.max_gap)
        grown = F.struct(acc["open"]["start"].alias("start"), F.greatest(acc["open"]["end"], cue["end"]).alias("end"), F.concat_ws(" ", acc["open"]["text"], cue["text"]).alias("text"))
        ends = ~opens & ((grown["end"] - grown["start"] >= config.max_duration) | F.regexp(cue["text"], F.lit(P.SENTENCE_END)))
        done = F.when(opens, flushed(acc)).when(ends, F.concat(acc["done"], F.array(grown))).otherwise(acc["done"])
        return F.struct(F.when(opens, fresh).when(ends, none).otherwise(grown).alias("open"), done.alias("done"))

    return F.aggregate(cues, F.struct(none.alias("open"), empty.alias("done")), step, flushed)


def segments(cues: DataFrame, config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """video_id, seg_ord, start, end, text of cues (video_id, cue_idx, start, end, text); one shuffle, by video."""
    ordered = cues.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("cue_idx", "start", "end", "text"))).alias("cues"))
    split = ordered.select("video_id", F.posexplode(fold_cues(F.col("cues"), config)).alias("seg_ord", "s"))
    out = split.select("video_id", "seg_ord", "s.start", "s.end", normalize_caption(F.col("s.text")).alias("text"))
    return out.filter((F.col("text") != "") & (F.col("end") - F.col("start")).between(config.min_duration, config.max_duration))
