"""Rare-word scoring: vocabulary flags, domains, entities, and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RareWordConfig
from ..functions import text as X


def vocabulary(words: DataFrame, low: int = 1, high: int = 10) -> DataFrame:
    """word, in_low, in_high: words (column word, repeats counted) seen low and high times at least."""
    counts = words.groupBy("word").count()
    return counts.filter(F.col("count") >= low).select("word", F.lit(True).alias("in_low"), (F.col("count") >= high).alias("in_high"))


def lowercase_words(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.explode(X.lowercase_tokens(X.tokens(F.col(text)))).alias("word"))


def rare_words(docs: DataFrame, vocab: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, freq_1_9_words, oov_words, rare_words, sorted, of each row that has such words.

    A word is of low frequency if the vocabulary has it below its high mark, unknown if it lacks it. Words are made
    distinct row by row before the join, and pairs (key, word) are what moves; the join is left to the planner,
    which broadcasts the vocabulary where its size at run time allows.
    """
    pairs = docs.select(key, F.explode(F.array_distinct(X.lowercase_tokens(X.tokens(F.col(text))))).alias("word"))
    flagged = pairs.join(vocab, "word", "left").filter(F.col("in_high").isNull() | ~F.col("in_high"))
    sets = flagged.groupBy(key).agg(*[F.array_sort(F.collect_set(F.when(c, F.col("word")))).alias(n) for n, c in (("freq_1_9_words", F.col("in_low").isNotNull()), ("oov_words", F.col("in_low").isNull()))])
    return sets.withColumn("rare_words", F.array_sort(F.array_union("freq_1_9_words", "oov_words")))


def gate_features(rows: DataFrame, lexicon: dict[str, list[str]] | None = None, text: str = "text") -> DataFrame:
    """rows with n_tokens, domains and entities of the text, each computed once."""
    toks = X.tokens(F.col(text))
    made = X.once(rows, "_g", F.struct(F.size(toks).alias("n"), X.domain_scores(toks, lexicon).alias("d"), X.entities(F.col(text)).alias("e")))
    return made.withColumns({"n_tokens": F.col("_g.n"), "domains": F.col("_g.d"), "entities": F.col("_g.e")}).drop("_g")


def passes(rows: DataFrame, config: RareWordConfig = RareWordConfig()) -> DataFrame:
    """Rows (with rare_words and gate_features) that have tokens, 1 to max_rare_words rare words, and a domain and an
    entity where required."""
    keep: Column = (F.col("n_tokens") > 0) & F.size("rare_words").between(1, config.max_rare_words)
    if config.require_keyword:
        keep &= F.size("domains") > 0
    if config.require_entity:
        keep &= F.size("entities") > 0
    return rows.filter(keep)


def gate(rows: DataFrame, config: RareWordConfig = RareWordConfig(), lexicon: dict[str, list[str]] | None = None, text: str = "text") -> DataFrame:
    return passes(gate_features(rows, lexicon, text), config)


def assign_domain(source_domain: Column, domains: Column) -> Column:
    """The source's domain if it names one; else the best detected one; else the source's or `unknown`."""
    known = ~F.coalesce(source_domain, F.lit("unknown")).isin("unknown", "multi", "")
    detected = F.when(F.size(domains) > 0, F.element_at(domains, 1)["domain"])
    return F.when(known, source_domain).otherwise(F.coalesce(detected, F.nullif(source_domain, F.lit("")), F.lit("unknown")))
