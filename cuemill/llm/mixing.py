"""Mixing sources to target weights by capped water-filling.

A source's share of the mix is its weight's share of all words, held at `max_epochs` times what the source
has; what the held sources cannot give goes to the others in proportion to their weights until no target
exceeds its cap. A source then repeats every document a whole number of times and adds one more repetition
for a seeded sample of documents, chosen in the order of a hash, whose words come nearest to the fraction.

Nothing larger than the list of sources meets in one task: the order by hash is cut into about sqrt(n) ranges
of a source's documents, the ranges' sums are accumulated, and only the range in which the fraction ends is
ordered by document.

Cases: null text has size 0 and is taken 0 words; a null source is a source of its own, after all others; an
empty table gives an empty mix; repeated rows are documents of their own; a very long text counts like any other;
other columns pass through `mix`, whatever their names, but for the five that it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_join, free_names, staged, word_count

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
_KEY, _HASH, _SIZE = "_mix_source", "_mix_hash", "_mix_size"
_GIVEN = ("source_size", "target", "whole", "ranges", "end_range", "rest")


def source_key(source: str) -> Column:
    """A key without nulls that orders sources by code point, null last."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source).cast("string")))


def order_hash(doc_id: str, seed: int) -> Column:
    """60 bits of an MD5 digest of seed and id: the seeded order in which fractions are sampled."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sizes: key, source_size, n, one row for each source. Adds weight and target.

    A source is held at its cap as long as cap / weight is at most the level at which the rest is shared;
    in that order, running sums give the level at every cut, so no iteration is needed.
    """
    everything = Window.partitionBy()
    by_key = Window.orderBy("key")
    by_level = Window.orderBy("_ratio", "key").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_key) - 1) % len(weights) + 1).cast("int"))
    x = (
        sizes.withColumn("weight", weight.cast("long"))
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_weights", F.sum("weight").over(everything))
        .withColumn("_held", F.coalesce(F.sum("_cap").over(by_level), F.lit(0)))
        .withColumn("_held_weight", F.coalesce(F.sum("weight").over(by_level), F.lit(0)))
        .withColumn("_level", (F.col("_total") - F.col("_held")) / (F.col("_weights") - F.col("_held_weight")))
        # the first source, by ratio, whose cap is above the level of those from it on sets the level
        .withColumn("_final", F.min(F.when(F.col("_ratio") > F.col("_level"), F.struct("_ratio", "_level"))).over(everything))
    )
    target = F.when(F.col("_final").isNull() | (F.col("_ratio") < F.col("_final._ratio")), F.col("_cap").cast("double")).otherwise(F.col("_final._level") * F.col("weight"))
    return x.withColumn("target", target).select("key", "source_size", "n", "weight", "target")


def plan(narrow: DataFrame, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """narrow: the key, hash and size columns. For each source: target, whole repetitions, and the range and
    rest of words in it at which the further repetition ends."""
    sizes = narrow.groupBy(F.col(_KEY).alias("key")).agg(F.sum(_SIZE).alias("source_size"), F.count(F.lit(1)).alias("n"))
    x = targets(sizes, max_epochs, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    x = x.withColumn("whole", F.least(whole, F.lit(max_epochs).cast("long")))
    x = x.withColumn("part", F.greatest(F.lit(0.0), F.when(F.col("whole") >= max_epochs, 0.0).otherwise(F.col("target") - F.col("whole") * F.col("source_size"))))
    x = staged(x.withColumn("ranges", F.greatest(F.lit(64), F.ceil(F.sqrt("n"))).cast("long")), "mix-sources")
    sums = bounded_join(narrow, x.select(F.col("key").alias(_KEY), "ranges"), [_KEY], "inner").groupBy(F.col(_KEY).alias("key"), _range().alias("range")).agg(F.sum(_SIZE).alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = sums.withColumn("before", before).join(x.select("key", "part"), "key").filter((F.col("before") < F.col("part")) & (F.col("before") + F.col("words") >= F.col("part")))
    ends = ends.groupBy("key").agg(F.min(F.struct("range", "before")).alias("end"))
    return staged(
        x.join(ends, "key", "left").select("*", F.coalesce("end.range", F.when(F.col("part") > 0, F.col("ranges")).otherwise(-1)).alias("end_range"), (F.col("part") - F.coalesce("end.before", F.lit(0))).alias("rest")).drop("end"), "mix-plan"
    )


def _range() -> Column:
    return F.floor(F.col(_HASH) / F.lit(float(1 << 60)) * F.col("ranges")).cast("long")


def mix(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: int = 42, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS, carry_text: bool = True) -> DataFrame:
    """docs with size, source_size, target, copies and taken (= copies * size), one row for each row of docs.

    Columns of docs with these names are replaced. carry_text=False leaves the text out, so that it isn't moved.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    names = [c for c in docs.columns if carry_text or c != text]
    # all columns of docs travel in one struct, so that none of theirs can clash with a helper's
    row, held = "_mix_row", F.struct(*[F.col(f"`{c}`") for c in names])
    keyed = docs.select(held.alias(row), F.col(doc_id).alias("_mix_id"), source_key(source).alias(_KEY), order_hash(doc_id, seed).alias(_HASH), word_count(text).alias(_SIZE))
    if not carry_text:
        keyed = staged(keyed, "mix-docs")
        narrow = keyed.select(_KEY, _HASH, _SIZE)
    else:
        narrow = staged(keyed.select(_KEY, _HASH, _SIZE), "mix-sizes")
    sources = plan(narrow, max_epochs, weights).withColumnRenamed("key", _KEY).select(_KEY, *_GIVEN)
    x = bounded_join(keyed, sources, [_KEY], "inner").withColumn("_mix_range", _range())
    # Only the rows of the range in which a source's fraction ends are ordered. Other rows stay where they are.
    at_end = F.col("_mix_range") == F.col("end_range")
    inner = x.filter(at_end)
    running = Window.partitionBy(_KEY).orderBy(_HASH, "_mix_id", _SIZE).rowsBetween(Window.unboundedPreceding, -1)
    extra = F.coalesce(F.sum(_SIZE).over(running), F.lit(0)) + F.col(_SIZE) / 2 <= F.col("rest")
    outer = x.filter(~at_end).withColumn("_mix_more", (F.col("_mix_range") < F.col("end_range")).cast("long"))
    both = inner.withColumn("_mix_more", extra.cast("long")).unionByName(outer)
    copies = F.col("whole") + F.col("_mix_more")
    return both.select(*[F.col(f"{row}.`{c}`").alias(c) for c in names], F.col(_SIZE).alias("size"), "source_size", "target", copies.alias("copies"), (copies * F.col(_SIZE)).alias("taken"))


def repeat(mixed: DataFrame) -> DataFrame:
    """One row for every repetition that the mix takes; rows with no copies go."""
    names = [c for c in mixed.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    (copy,) = free_names(mixed.columns, "copy")
    return mixed.filter("copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*[F.col(f"`{c}`") for c in names])
