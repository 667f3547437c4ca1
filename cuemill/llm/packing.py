"""Best-fit packing with bins of several permitted lengths.

Documents longer than the longest bin are cut into pieces of that length and a rest. Pieces are dealt by a hash
into shards of bounded size; a shard is packed by best-fit decreasing, once for each permitted length taken as
the longest that may be opened (pieces above it open the least length that holds them). A piece goes to the
open bin with the least room that holds it; else a new bin is opened, of the length whose cost for each token
still to be packed is least. At the end each bin shrinks to the least length that holds its contents, and the
plan with the least total cost stays. The cost of a bin is its length plus `overhead`.

Cases: null or empty texts have no tokens and come back as one row with null bin; repeated rows are packed each
for itself; ties go by size, id and piece, so reruns agree; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, word_count

LENGTHS = (512, 1024, 2048, 4096)
SHARD_ROWS = 1024
OVERHEAD = 8


def _pack_with(sizes: list[int], lengths: tuple[int, ...], longest: int, overhead: int) -> tuple[int, list[int], list[int], list[int]]:
    """sizes: descending. Cost, bin of each piece, offset of each piece, and length of each bin."""
    left = sum(sizes)
    room: list[tuple[int, int]] = []  # (room, bin), ascending
    used: list[int] = []
    bins, offsets = [], []
    for size in sizes:
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            fit = [c for c in lengths if size <= c <= longest] or [min(c for c in lengths if c >= size)]
            free = min(fit, key=lambda c: ((c + overhead) / min(c, left), c))
            b = len(used)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        left -= size
        if free > size:
            insort(room, (free - size, b))
    shrunk = [lengths[bisect_left(lengths, u)] for u in used]
    return sum(shrunk) + overhead * len(shrunk), bins, offsets, shrunk


def best_plan(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> tuple[int, list[int], list[int], list[int]]:
    """The least-cost plan over all choices of the longest length that may be opened."""
    lengths = tuple(sorted(lengths))
    return min((_pack_with(sizes, lengths, longest, overhead) for longest in lengths), key=lambda x: x[0])


def pack(docs: DataFrame, *, doc_id: str = "doc_id", text: str | None = "text", size: str | None = None, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, size, piece, start, length, bin_id, bin_size, bin_offset: a row for each piece of each row of docs.

    size: column with the number of tokens; without it the words of `text` are counted.
    """
    lengths = tuple(sorted(lengths))
    n = F.coalesce(F.col(size), F.lit(0)).cast("long") if size else word_count(text)
    top = lengths[-1]
    no_id = -(1 << 63)  # pandas has no null in a column of integers
    rows = staged(docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(no_id)).alias("doc_id"), n.alias("size")), "pack-sizes")
    pieces = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(top))).cast("int")
    whole = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).withColumn("start", F.col("piece").cast("long") * top).withColumn("length", F.least(F.lit(top), F.col("size") - F.col("start")))
    total = rows.agg(F.sum(pieces)).first()[0] or 0
    shards = max(1, -(-total // shard_rows))
    dealt = whole.filter("length > 0").withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "size"), F.lit(shards)).cast("long"))

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", na_position="first")
        _, bins, offsets, sizes = best_plan(pdf["length"].tolist(), lengths, overhead)
        pdf["bin_id"] = [int(pdf["shard"].iloc[0]) << 24 | b for b in bins]
        pdf["bin_size"] = [sizes[b] for b in bins]
        pdf["bin_offset"] = offsets
        return pdf.drop(columns="shard")

    out = "doc_id long, size long, piece int, start long, length long, bin_id long, bin_size long, bin_offset long"
    packed = dealt.groupBy("shard").applyInPandas(shard, out)
    empty = whole.filter("length <= 0").select("doc_id", "size", "piece", "start", "length", *[F.lit(None).cast("long").alias(c) for c in ("bin_id", "bin_size", "bin_offset")])
    return packed.unionByName(empty).withColumn("doc_id", F.nullif("doc_id", F.lit(no_id)))
