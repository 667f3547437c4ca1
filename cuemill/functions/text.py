"""Text functions as columns: everything runs inside the JVM but for full HTML entity decoding."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P

_OPEN, _CLOSE, _OTHER = "\ue000", "\ue001", "\ufffd"  # private characters, not kept from the text


def _let(value: Column, body) -> Column:
    """body of value, with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with value as a column that is computed once, whatever filters and projections use it: those of the planner
    don't go through a generator."""
    return df.withColumn(name, F.explode(F.array(value)))


def strip(text: Column) -> Column:
    """Text without white space at its ends."""
    return F.regexp_replace(text, rf"\A{P.WHITESPACE}|{P.WHITESPACE}\z", "")


def squeeze(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, P.WHITESPACE, " "))


def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape(text: Column) -> Column:
    """HTML entities decoded. Only texts with an ampersand are sent to Python; the others go as nulls."""
    decode = F.pandas_udf(_unescape, "string")
    return F.coalesce(decode(F.when(F.contains(text, F.lit("&")), text)), text)


def named_entities(text: Column) -> Column:
    """P.NAMED_ENTITIES decoded, with their semicolon only; what decoding makes is not decoded again."""
    for entity, char in P.NAMED_ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def normalize_caption(text: Column, decode: Callable[[Column], Column] = unescape) -> Column:
    """Tags to spaces, then entities, then white space; not idempotent, on purpose."""
    return squeeze(decode(F.regexp_replace(text, P.TAG, " ")))


def seconds(timecode: Column) -> Column:
    parts = F.split(F.translate(timecode, ",", "."), ":")
    number = lambda i: F.element_at(parts, i).cast("double")
    return F.when(F.size(parts) == 3, number(1) * 3600 + number(2) * 60 + number(3)).otherwise(number(1) * 60 + number(2))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(P.WORD), F.lit(0))


def lowercase_tokens(toks: Column) -> Column:
    return F.filter(toks, lambda t: (t == F.lower(t)) & t.rlike("[a-z]"))


def entities(text: Column) -> Column:
    found = F.filter(F.regexp_extract_all(text, F.lit(P.ENTITY), F.lit(0)), lambda e: (F.length(e) >= 2) & ~F.lower(e).isin(*P.ENTITY_STOPWORDS))
    return _let(found, lambda own: F.filter(own, lambda e, i: F.array_position(F.transform(own, F.lower), F.lower(e)) == i + 1))


def normalize_abbreviation(surface: Column) -> Column:
    head = F.substring_index(surface, "-", 1)
    plural = (F.length(head) > 2) & head.endswith("s") & F.regexp_replace(head, "s$", "").rlike("^(?:" + P.ABBREVIATION.removeprefix("(?U)") + ")$")
    return F.when(plural, F.regexp_replace(head, "s$", "")).otherwise(head)


def abbreviation_candidates(text: Column) -> Column:
    """array<struct<surface, span_start, span_end, normalized>>; spans are code points, from 0, end exclusive.

    Matches are fenced in with two private characters, and the lengths of the pieces give the spans."""
    fenced = F.regexp_replace(F.translate(text, _OPEN + _CLOSE, _OTHER * 2), P.ABBREVIATION, f"{_OPEN}$1{_CLOSE}")
    empty = F.expr("cast(array() as array<struct<surface:string,span_start:int,span_end:int,normalized:string>>)")

    def walk(parts: Column) -> Column:
        def step(acc: Column, part: Column) -> Column:
            surface = F.substring_index(part, _CLOSE, 1)
            end = acc["at"] + F.length(surface)
            hit = F.struct(surface.alias("surface"), acc["at"].alias("span_start"), end.alias("span_end"), normalize_abbreviation(surface).alias("normalized"))
            return F.struct((acc["at"] + F.length(part) - 1).alias("at"), F.concat(acc["hits"], F.array(hit)).alias("hits"))

        begin = F.struct(F.length(F.element_at(parts, 1)).alias("at"), empty.alias("hits"))
        return F.aggregate(F.slice(parts, 2, F.size(parts)), begin, step, lambda acc: acc["hits"])

    return _let(F.split(fenced, _OPEN), walk)


def infer_pron_type(surface: Column) -> Column:
    digit, lower, upper = (surface.rlike(p) for p in (r"\p{Nd}", r"\p{Ll}", r"\p{Lu}"))
    return F.when(digit & surface.rlike(r"\p{L}"), "mixed_alnum").when(lower & upper, "camel_case").when(upper & ~lower, "spell_out").otherwise("other")


def expand_readings(text: Column, hits: Column) -> Column:
    """Readings put in place of the hits' spans, from right to left; null where a span doesn't hold its surface."""
    replaced = F.aggregate(
        F.reverse(F.array_sort(F.transform(hits, lambda h: F.struct(h["span_start"].alias("a"), h["span_end"].alias("b"), h["surface"].alias("s"), h["canonical_reading"].alias("r"))))),
        text,
        lambda acc, h: F.when(F.substr(acc, h["a"] + 1, h["b"] - h["a"]) == h["s"], F.concat(F.substr(acc, F.lit(1), h["a"]), h["r"], F.substr(acc, h["b"] + 1, F.length(acc)))),
    )
    return normalize_caption(replaced)


def clean_text(text: Column, forbidden: str = P.FORBIDDEN_CHARS) -> Column:
    return F.regexp_replace(squeeze(F.translate(text, forbidden, "")), r"\s+([,.;!?])", "$1")


def bad_punctuation(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, P.BAD_PUNCTUATION, ""))


def safe_name(text: Column) -> Column:
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(text, "[^A-Za-z0-9._-]+", "_"), F.lit("._-")), F.lit("")), F.lit("item"))


def clip_name(video_id: Column, start: Column, end: Column) -> Column:
    """Named by the times as a record has them: the sum that a timecode makes can fall short of them (60 + 33.48 < 93.48)."""
    ms = lambda t: (F.round(t, 3) * 1000).cast("long")
    return F.format_string("%s_%09d_%09d.wav", video_id, ms(start), ms(end))


def dedup_key(mode: str, video_id: Column, start: Column, end: Column, text: Column) -> Column:
    if mode == "none":
        return F.lit(None).cast("string")
    if mode == "segment":
        return F.format_string("%s:%.3f:%.3f", video_id, start, end)
    if mode == "text":
        return F.lower(strip(text))
    raise ValueError(f"unknown dedup key {mode!r}")


def manifest_path(name: Column, out_dir: str, mode: str) -> Column:
    return name if mode == "relative" else F.concat(F.lit(out_dir.rstrip("/") + "/"), name)


def summarize_stderr(text: Column, most: int = 300) -> Column:
    return _let(squeeze(text), lambda t: F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 3), F.lit("..."))).otherwise(t))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, P.WHITESPACE), lambda w: w != ""))


def domain_scores(toks: Column, lexicon: dict[str, list[str]] | None = None) -> Column:
    """array<struct<domain, score>> of the domains with a keyword, most distinct keywords first, ties in the lexicon's order."""
    lexicon = P.KEYWORDS if lexicon is None else lexicon

    def score(own: Column) -> Column:
        rows = [F.struct((-F.size(F.array_intersect(own, F.array(*map(F.lit, words))))).alias("minus"), F.lit(i).alias("ord"), F.lit(domain).alias("domain")) for i, (domain, words) in enumerate(lexicon.items())]
        return F.transform(F.filter(F.array_sort(F.array(*rows)), lambda r: r["minus"] < 0), lambda r: F.struct(r["domain"].alias("domain"), (-r["minus"]).alias("score")))

    return _let(F.array_distinct(F.transform(toks, F.lower)), score)
