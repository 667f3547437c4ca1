"""Constrained greedy selection.

Items are tried in order and taken while the target, their video's and their class's caps, and their dedup key
allow it; keys and counts are recorded only for items that are taken. Where every video lies in one class and keys
repeat only inside a video, ranks give the same result and run everywhere (`windowed`; `ranked` where the caps of classes
can't bind at all, which `binding` tells); otherwise a fold over the
ordered survivors decides (`sequential`): one task that streams narrow rows and holds counters only. That stage is
serial by its nature: an acceptance depends on all acceptances before it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged


def first_of_key(items: DataFrame, order: list[str], key: str = "dedup_key") -> DataFrame:
    """Of items with the same key the first; items without a key all stay. Aggregation with map-side combine, no window."""
    fixed = items.withColumn("_o", F.struct(*order))
    first = fixed.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("_o").alias("_first"))
    return fixed.join(first, key, "left").filter(F.col("_first").isNull() | (F.col("_o") == F.col("_first"))).drop("_o", "_first")


def windowed(items: DataFrame, order: list[str], *, target: int | None, per_video: int | None, per_domain: int = 0) -> DataFrame:
    """items (video_id, domain, dedup_key, order columns) that are selected, with uid from 1. None is no limit."""
    by = [F.col(c) for c in order]
    out = first_of_key(items, order)
    if per_video is not None:
        out = out.withColumn("_v", F.row_number().over(Window.partitionBy("video_id").orderBy(*by))).filter(F.col("_v") <= per_video).drop("_v")
    if per_domain:
        out = out.withColumn("_d", F.row_number().over(Window.partitionBy("domain").orderBy(*by))).filter(F.col("_d") <= per_domain).drop("_d")
    top = out if target is None else out.orderBy(*by).limit(target)
    return top.withColumn("uid", F.row_number().over(Window.orderBy(*by)).cast("long"))


@dataclass
class Quotas:
    """State of the fold. per_video: None is no limit. classes: the name of each class column and its cap for any of an item's values of it;
    primary: the name of each class column and quotas that bind an item's primary value until all are filled."""

    target: int
    per_video: int | None = None
    caps: dict[str, int] = field(default_factory=dict)
    primary: dict[str, dict[str, int]] = field(default_factory=dict)
    taken: int = 0
    videos: Counter = field(default_factory=Counter)
    counts: dict[str, Counter] = field(default_factory=dict)
    keys: set = field(default_factory=set)

    @property
    def classes(self) -> list[str]:
        return [*dict.fromkeys((*self.caps, *self.primary))]

    def allows(self, item: dict) -> bool:
        if self.taken >= self.target or self.per_video is not None and self.videos[item["video_id"]] >= self.per_video:
            return False
        if item.get("dedup_key") is not None and item["dedup_key"] in self.keys:
            return False
        for name, cap in self.caps.items():
            own = self.counts.setdefault(name, Counter())
            if any(own[v] >= cap for v in item[name]):
                return False
        for name, quota in self.primary.items():
            own, value = self.counts.setdefault(name, Counter()), item[f"primary_{name}"]
            if 0 < quota.get(value, 0) <= own[value] and any(own[k] < q for k, q in quota.items() if q > 0):
                return False
        return True

    def take(self, item: dict) -> None:
        self.taken += 1
        self.videos[item["video_id"]] += 1
        if item.get("dedup_key") is not None:
            self.keys.add(item["dedup_key"])
        for name in self.classes:
            self.counts.setdefault(name, Counter()).update(set(item[name]))


def sequential(items: DataFrame, order: list[str], quotas: Quotas, first_uid: int = 1) -> DataFrame:
    """item_id, uid of the items taken. items: item_id, video_id, dedup_key, the class columns (arrays of strings),
    primary_<class> and the order columns; carry no wide columns, join them back."""
    names = ["item_id", "video_id", "dedup_key", *quotas.classes, *(f"primary_{c}" for c in quotas.primary)]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from copy import deepcopy

        state = deepcopy(quotas)
        for batch in batches:
            ids, uids = [], []
            for item in batch.select(names).to_pylist():
                if state.allows(item):
                    state.take(item)
                    ids.append(item["item_id"])
                    uids.append(first_uid + state.taken - 1 - quotas.taken)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(uids, pa.int64())], ["item_id", "uid"])
            if state.taken >= state.target:
                return

    narrow = items.select(*names, *[c for c in order if c not in names])
    return narrow.repartition(1).sortWithinPartitions(*order).mapInArrow(fold, "item_id long, uid long")


def binding(quotas: Quotas, items: int) -> bool:
    """Whether a cap or quota of a class could turn down one of so many items. While an item is tried, fewer than all
    items and fewer than the target are taken; records of an earlier run are held to count in any class."""
    if quotas.taken or quotas.videos or any(quotas.counts.values()):
        return True
    most = min(quotas.target, items)
    return any(cap < most for cap in quotas.caps.values()) or any(0 < q < most for quota in quotas.primary.values() for q in quota.values())


def numbered(rows: DataFrame, order: list[str], first: int = 1) -> DataFrame:
    """rows with uid in the order, from first: each range of the order numbers its own rows from where the one before ends."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = staged(sorted_rows, "numbered").withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = placed.groupBy("_range").agg(F.count("*").alias("n")).select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_range").withColumn("uid", F.col("_start") + F.col("_at") % (1 << 33) + first).drop("_at", "_range", "_start")


def ranked(items: DataFrame, order: list[str], quotas: Quotas, first_uid: int = 1) -> DataFrame:
    """item_id, uid as `sequential` gives them, without a fold: for quotas that aren't `binding` and keys that repeat only
    inside a video."""
    names = ["item_id", "video_id", "dedup_key"]
    out = first_of_key(items.select(*names, *[c for c in order if c not in names]), order)
    if quotas.per_video is not None:
        out = out.withColumn("_v", F.row_number().over(Window.partitionBy("video_id").orderBy(*order))).filter(F.col("_v") <= quotas.per_video).drop("_v")
    out = numbered(out.select("item_id", *[c for c in order if c != "item_id"]), order, first_uid)
    return out.filter(F.col("uid") < first_uid + quotas.target).select("item_id", "uid")
