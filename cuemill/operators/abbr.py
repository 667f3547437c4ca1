"""Abbreviation hits: rule-confirmed and rule-free."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X
from ..sources.rules import Rule, variant_table

#: Variants beyond which the rule table is joined instead of written into the plan.
LITERAL_VARIANTS = 2000
_FIELDS = ("abbr", "canonical_reading", "pron_type", "confidence_tier", "rule_id")


def _rule_map(rules: list[Rule]) -> Column:
    entries = [F.struct(F.lit(v).alias("k"), F.struct(*[F.lit(getattr(r, f)).alias(f) for f in _FIELDS]).alias("v")) for r in rules for v in r.surfaces]
    if len(entries) > LITERAL_VARIANTS:
        raise ValueError(f"{len(entries)} variants; score and match_rules_joined take any number")
    return F.map_from_entries(F.array(*entries))


def _hit(c: Column, r: Column, confirmed: bool) -> Column:
    return F.struct(c["surface"].alias("surface"), *[r[f].alias(f) for f in _FIELDS], c["span_start"].alias("span_start"), c["span_end"].alias("span_end"), F.lit(confirmed).alias("is_rule_confirmed"))


def match_rules(candidates: Column, rules: list[Rule]) -> Column:
    """Hits of the candidates, by surface or else by normalized form, in the order of their spans. No shuffle: the
    checked rule table is part of the plan."""
    if not rules:
        return F.filter(candidate_hits(candidates), lambda h: F.lit(False))
    table = _rule_map(rules)
    hits = F.transform(candidates, lambda c: _hit(c, F.coalesce(F.try_element_at(table, c["surface"]), F.try_element_at(table, c["normalized"])), True))
    return F.filter(hits, lambda h: h["abbr"].isNotNull())


def match_rules_joined(rows: DataFrame, key: str, candidates: str, rules: DataFrame) -> DataFrame:
    """key, hits: the same for a rule table of any size (variant and the rule's fields), by two joins and a regroup."""
    rule = F.struct(*[F.col(f) for f in _FIELDS])
    one, two = (rules.select(F.col("variant").alias(n), rule.alias(f"_{n}")) for n in ("surface", "normalized"))
    c = rows.select(key, F.explode(candidates).alias("c")).select(key, "c", F.col("c.surface").alias("surface"), F.col("c.normalized").alias("normalized"))
    matched = c.join(one, "surface", "left").join(two, "normalized", "left").withColumn("r", F.coalesce("_surface", "_normalized")).filter("r is not null")
    hit = _hit(F.col("c"), F.col("r"), True)
    return matched.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("c.span_start").alias("at"), hit.alias("h")))), lambda x: x["h"]).alias("hits"))


def candidate_hits(candidates: Column) -> Column:
    """Rule-free hits."""
    text = lambda v: F.lit(v).cast("string")
    return F.transform(candidates, lambda c: F.struct(c["surface"].alias("surface"), c["normalized"].alias("abbr"), text("").alias("canonical_reading"), X.infer_pron_type(c["surface"]).alias("pron_type"), text(P.CANDIDATE_ONLY).alias("confidence_tier"), text("").alias("rule_id"), c["span_start"].alias("span_start"), c["span_end"].alias("span_end"), F.lit(False).alias("is_rule_confirmed")))


def primary_hit(hits: Column, with_tier: bool = True) -> Column:
    """The first hit by (tier, spelled-out last, abbr, span); rule-free hits have no tier to go by."""
    keyed = F.transform(hits, lambda h: F.struct(*([F.when(h["confidence_tier"] == "high_conf", 0).otherwise(1).alias("tier")] if with_tier else []), F.when(h["pron_type"] != "spell_out", 0).otherwise(1).alias("spelled"), h["abbr"].alias("a"), h["span_start"].alias("at"), h.alias("h")))
    return F.try_element_at(F.array_sort(keyed), F.lit(1))["h"]


def score(rows: DataFrame, rules: list[Rule] | None, max_hits: int | None = 2, text: str = "text", key: str = "item_id") -> DataFrame:
    """Rows with 1 to max_hits hits (None: no limit): abbreviations, text_expanded, primary_*, and match_mode for rule-free mining.

    Texts without a match of the pattern go first; of the others hits are found once, and only rows that stay are
    expanded. key: a column that tells rows apart, used where the rule table is too large for the plan."""
    some = rows.filter(F.col(text).rlike(P.ABBREVIATION))
    found = X.abbreviation_candidates(F.col(text))
    if rules is not None and sum(len(r.surfaces) for r in rules) > LITERAL_VARIANTS:
        table = variant_table(rows.sparkSession, rules)
        out = some.join(match_rules_joined(some.withColumn("_c", found), key, "_c", table).withColumnRenamed("hits", "abbreviations"), key)
    else:
        out = X.once(some, "abbreviations", candidate_hits(found) if rules is None else match_rules(found, rules))
    out = out.filter(F.size("abbreviations") >= 1 if max_hits is None else F.size("abbreviations").between(1, max_hits))
    if rules is None:
        out = out.withColumn("text_expanded", F.col(text))
    else:
        out = X.once(out, "text_expanded", X.expand_readings(F.col(text), F.col("abbreviations"))).filter(F.coalesce("text_expanded", F.lit("")) != "")
    out = X.once(out, "_p", primary_hit(F.col("abbreviations"), rules is not None))
    out = out.withColumns({"primary_abbr": F.col("_p.abbr"), "primary_pron_type": F.col("_p.pron_type"), "primary_confidence_tier": F.col("_p.confidence_tier")}).drop("_p")
    return out.withColumn("match_mode", F.lit(P.CANDIDATE_ONLY)) if rules is None else out


def audit(manifest: DataFrame) -> DataFrame:
    """A row for each hit of each record."""
    h = manifest.select("*", F.explode("abbreviations").alias("h"))
    return h.select("uid", "video_id", *[F.col(f"h.{f}").alias(f) for f in ("surface", "abbr", "canonical_reading", "pron_type", "confidence_tier", "rule_id")], F.col("text").alias("context_text"), *(["match_mode"] if "match_mode" in manifest.columns else []))


def review(manifest: DataFrame) -> DataFrame:
    """The columns of the review sheet, a row for each hit: eight with rules, seven for rule-free manifests."""
    h = manifest.select("*", F.explode("abbreviations").alias("h"))
    own = lambda *names: [F.col(f"h.{n}").alias(n) for n in names]
    if "match_mode" in manifest.columns:
        return h.select("uid", *own("abbr", "surface", "pron_type"), "text", "audio_path", "source_domain")
    return h.select("uid", *own("abbr", "surface", "canonical_reading", "pron_type", "confidence_tier"), "text", "audio_path")
