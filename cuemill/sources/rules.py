"""The abbreviation rule table: read, check, expand variants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P


class RuleError(ValueError):
    pass


@dataclass(frozen=True)
class Rule:
    abbr: str
    canonical_reading: str
    pron_type: str
    confidence_tier: str
    rule_id: str
    variants: tuple[str, ...] = ()
    notes: str = ""

    @property
    def surfaces(self) -> list[str]:
        return list(dict.fromkeys((self.abbr, *self.variants)))


def check(rows: list[dict]) -> list[Rule]:
    """Rules of the rows, in order; RuleError names the row at fault (rows count from 2, after the header)."""
    rules: dict[str, Rule] = {}
    owner: dict[str, str] = {}
    for line, row in enumerate(rows, start=2):
        x = {k: (row.get(k) or "").strip() for k in P.RULE_COLUMNS}
        problem = (
            "abbr is empty" if not x["abbr"]
            else "canonical_reading is empty" if not x["canonical_reading"]
            else f"pron_type {x['pron_type']!r}" if x["pron_type"] not in P.PRON_TYPES
            else f"confidence_tier {x['confidence_tier']!r}" if x["confidence_tier"] not in P.CONFIDENCE_TIERS
            else f"abbr {x['abbr']!r} repeats" if x["abbr"] in rules
            else ""
        )
        if problem:
            raise RuleError(f"row {line}: {problem}")
        variants = tuple(v for v in map(str.strip, x["variants"].split(",")) if v)
        rule = Rule(x["abbr"], x["canonical_reading"], x["pron_type"], x["confidence_tier"], x["rule_id"] or x["abbr"], variants, x["notes"])
        for surface in rule.surfaces:
            if owner.setdefault(surface, rule.rule_id) != rule.rule_id:
                raise RuleError(f"row {line}: variant {surface!r} belongs to rule {owner[surface]!r}")
        rules[rule.abbr] = rule
    return list(rules.values())


def load_rules(spark: SparkSession, path: str) -> list[Rule]:
    """A configuration file: TAB separated, or by commas where its name ends in .csv."""
    table = spark.read.csv(path, sep="," if path.lower().endswith(".csv") else "\t", header=True, quote='"')
    if missing := [c for c in P.RULE_COLUMNS if c not in table.columns]:
        raise RuleError(f"columns are missing: {', '.join(missing)}")
    return check([r.asDict() for r in table.select(*P.RULE_COLUMNS).coalesce(1).toLocalIterator()])


def variant_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(v, r.abbr, r.canonical_reading, r.pron_type, r.confidence_tier, r.rule_id) for r in rules for v in r.surfaces], "variant string, abbr string, canonical_reading string, pron_type string, confidence_tier string, rule_id string")


def dead_variants(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Variants that the candidate pattern can never produce as a whole."""
    table = variant_table(spark, rules)
    return table.filter(~F.col("variant").rlike("^(?:" + P.ABBREVIATION.removeprefix("(?U)") + ")$")).select("variant", "abbr", "rule_id")


def quota_plan(rules: list[Rule], target: int) -> tuple[dict[str, int], dict[str, int]]:
    """An equal share of the target for each pronunciation type and each tier in use, one at least."""
    share = lambda names: {n: max(1, target // max(1, len(names))) for n in sorted(names)}
    return share({r.pron_type for r in rules}), share({r.confidence_tier for r in rules})
