"""Exact Jaccard join of word n-gram sets by vertical partitioning.

The global order of n-grams goes by document frequency, then hash. It is cut into fragments by hash; a fragment
holds the segments of all sets, counts frequencies and drops what no two sets share, so that only shared n-grams
travel on. Where there are more sets than a task should hold, a fragment is salted by class into cells. Sets so cut are gathered again: a set of n n-grams that has more unshared ones than the prefix filter
allows (n - ceil(t n)) has no partner. The rest are indexed by the prefix of the global order. For a candidate
pair the partial overlaps are counted fragment by fragment and summed.

Large groups aren't multiplied out. Documents with equal sets are one class from the start (a digest of the set).
First each class is compared with one pivot only, the one that most of its prefix n-grams name; the links found
give provisional components. Then, n-gram by n-gram, the members outside of the n-gram's largest component are
compared with the members of other components: every pair that could still join two components, and no other.
They meet by n-gram and band of size, the smaller set of a pair by the shorter prefix that the overlap with a set no smaller
than itself leaves, so that a template's n-grams pair only sets that could link.
No candidate is dropped: the result is the exact set of components, and a spanning set of verified links.

n-grams are 64-bit hashes of lower-cased words (45 bits within fragments, which an unshared pair of n-grams of a
pair of documents hits with odds of about 1e-8), classes 64-bit digests.

Cases: null and empty texts have no n-grams and link with nothing; shorter texts than n words are one n-gram;
repeated rows are linked; other columns aren't read; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, release_memory, staged, text_slices
from .components import components

#: n-grams in a fragment, on average, n-grams of gathered sets in a task, and sets of a fragment in a task.
FRAGMENT, GATHER, SETS = 2_000_000, 1_000_000, 8_000_000
#: n-grams packed at once, and classes a task remembers, so as to send equal sets once (the next step drops the rest).
PACK, SEEN = 600_000, 150_000
#: Segments of a cell whose numbers fit below an n-gram in 64 bits.
OWNERS = 1 << 24
_PARTS = 8  # fragments in which overlaps of pairs are counted

_U = np.uint64
_R = 0x9E3779B97F4A7C15 | 1
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.zeros(256, bool)
_space[[32, *range(9, 14)]] = True
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64 and their inverses."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        n = max(n + n // 8, 1 << 16)
        inverse = pow(_R, -1, 1 << 64)
        with np.errstate(over="ignore"):
            steps = [np.full(n, base, np.uint64) for base in (_R, inverse)]
            for x in steps:
                x[0] = 1
            _powers = tuple(np.multiply.accumulate(x) for x in steps)
    return _powers


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and how many words each text has."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _lower[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)]
    gap = _space[data]
    start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    end = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    power, inverse = _power_table(len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + _U(1)) * power[: len(data)], out=sums[1:])
        words = _mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    ends = np.cumsum([len(r) + 1 for r in raw]) + 1
    return words, np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))


def gram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    words, count = word_hashes(texts)
    with np.errstate(over="ignore"):
        grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for j in range(n):
            grams = _mix(grams * _U(3) + words[j : j + len(grams)])
    out, at = [], 0
    for m in count.tolist():
        if m >= n:
            x = np.sort(grams[at : at + m - n + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(words[at : at + m].tobytes(), m)] if m else [], np.uint64))
        at += m
    return out


def _class(x: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63)


def classes(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, class of each row; class is null for a set without n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            sets = gram_sets(texts, n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array([_class(x) if len(x) else None for x in sets], pa.int64())], ["doc_id", "n_shingles", "class"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, class long")


def _segments(docs: DataFrame, n: int, bits: int, salts: int) -> DataFrame:
    """cell (fragment * salts + salt of the class), classes, sizes, counts, grams: packed segments of distinct sets;
    grams are 40 bits below the fragment's."""
    low, mask = _U(24 - bits), _U((1 << 40) - 1)

    def pack(sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cls, size = np.array([_class(x) for x in sets], np.int64), np.array([len(x) for x in sets], np.uint32)
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), size)
        key = (every >> _U(64 - bits)).view(np.int64)  # the cell, then the owner
        key *= salts
        if salts > 1:
            key += (cls % salts)[owner]
        key *= len(sets)
        key += owner
        del owner
        order = np.argsort(key, kind="stable")
        key, tail = key[order], every[order]
        del every, order
        tail >>= low
        tail &= mask
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(at, len(key))).astype(np.uint32)
        own, f = key[at] % len(sets), key[at] // len(sets)
        packed = np.ascontiguousarray(tail.view(np.uint8).reshape(-1, 8)[:, :5])
        cut, ends = np.searchsorted(f, np.arange((salts << bits) + 1)), np.append(at, len(key))
        rows = [(i, cls[own[a:b]].tobytes(), size[own[a:b]].tobytes(), count[a:b].tobytes(), packed[ends[a] : ends[b]].tobytes()) for i, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)], ["cell", "classes", "sizes", "counts", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        mass = 0
        for _, texts in text_slices(batches, "text"):
            for x in gram_sets(texts, n):
                if len(x) and (c := _class(x)) not in seen:
                    seen.add(c)
                    held.append(x)
                    mass += len(x)
            if mass > PACK:
                yield from pack(held)
                held, mass = [], 0
            if len(seen) > SEEN:
                seen.clear()
        if held:
            yield from pack(held)

    return docs.select("text").mapInArrow(run, "cell int, classes binary, sizes binary, counts binary, grams binary")


def _wide(packed: pa.ChunkedArray) -> np.ndarray:
    """The 5-byte n-grams of a binary column, read where Arrow holds them."""
    held = []
    for c in packed.chunks:
        ends = np.frombuffer(c.buffers()[1], np.int64 if pa.types.is_large_binary(c.type) else np.int32)[c.offset : c.offset + len(c) + 1] if len(c) else [0]
        if ends[0] < ends[-1]:
            held.append(np.frombuffer(c.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, 5))
    x = np.zeros((sum(map(len, held)), 8), np.uint8)
    at = 0
    for p in held:
        x[at : at + len(p), :5] = p
        at += len(p)
    return x.view(np.uint64).ravel()


_SHARED = "part int, classes binary, sizes binary, counts binary, grams binary, ranks binary"


def _column(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _cell(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Classes and sizes of a cell's segments, its n-grams (ascending, each class once) and their owners."""
    cls, size, count = _column(table, "classes", np.int64), _column(table, "sizes", np.uint32), _column(table, "counts", np.uint32)
    gram = _wide(table.column("grams"))
    owner = np.repeat(np.arange(len(cls), dtype=np.uint32), count)
    first = np.zeros(len(cls), bool)
    first[np.unique(cls, return_index=True)[1]] = True
    if not first.all():
        keep = first[owner]
        gram, owner = gram[keep], owner[keep]
    if len(cls) > OWNERS:
        order = np.argsort(gram, kind="stable")
        return cls, size, gram[order], owner[order].view(np.int32)
    # an n-gram has 40 bits, so that its owner goes below it and one sort in place orders both
    gram <<= _U(24)
    np.bitwise_or(gram, owner, out=gram)
    del owner
    gram.sort()
    owner = gram.view(np.uint32)[::2] & np.uint32(0xFFFFFF)
    gram >>= _U(24)
    return cls, size, gram, owner.view(np.int32)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.array([], np.int64)
    return at, np.diff(np.append(at, len(x)))


def _rank(frequency: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.ceil(8 * np.log2(np.maximum(frequency, 1)))).astype(np.uint8)


def _shared(cells: DataFrame, parts: int, salts: int) -> DataFrame:
    """Of each cell what two sets or more share, with the n-gram's rank (its frequency on a scale of logarithms).

    With one salt a cell is a fragment and counts its n-grams itself. With more, the cells' counts are summed by
    fragment, at most one row for each cell and n-gram, and the shared n-grams go back to the fragment's cells, so
    that sets with a very frequent n-gram never meet in one task.
    """

    def cut_up(which: int, cls: np.ndarray, size: np.ndarray, gram: np.ndarray, owner: np.ndarray, rank: np.ndarray) -> pa.Table:
        gram = gram | _U(which) << _U(40)
        part = (cls[owner] % parts) if len(owner) else owner
        order = np.lexsort((owner, part))
        gram, owner, rank, part = gram[order], owner[order], rank[order], part[order]
        at, n = _runs(owner)
        ends, own, n = np.append(at, len(owner)), owner[at], n.astype(np.uint32)
        cut = np.searchsorted(part[at], np.arange(parts + 1))
        rows = [(p, cls[own[a:b]].tobytes(), size[own[a:b]].tobytes(), n[a:b].tobytes(), gram[ends[a] : ends[b]].tobytes(), rank[ends[a] : ends[b]].tobytes()) for p, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
        kinds = (pa.int32(), *[pa.binary()] * 5)
        names = [x.split(" ")[0] for x in _SHARED.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], names=names)

    def alone(table: pa.Table) -> pa.Table:
        release_memory()
        cls, size, gram, owner = _cell(table)
        keep, same = np.zeros(len(gram), bool), gram[1:] == gram[:-1]
        keep[1:] = same
        keep[:-1] |= same
        gram, owner = gram[keep], owner[keep]
        _, df = _runs(gram)
        return cut_up(table.column("cell")[0].as_py(), cls, size, gram, owner, np.repeat(_rank(df), df))

    def tally(table: pa.Table) -> pa.Table:
        release_memory()
        _, _, gram, _ = _cell(table)
        at, df = _runs(gram)
        return pa.table({"fragment": pa.array([table.column("cell")[0].as_py() // salts], pa.int32()), "grams": pa.array([gram[at].tobytes()], pa.binary()), "counts": pa.array([df.astype(np.uint32).tobytes()], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        fragment = table.column("fragment")[0].as_py()
        gram, back = np.unique(_column(table, "grams", np.uint64), return_inverse=True)
        df = np.bincount(back, weights=_column(table, "counts", np.uint32), minlength=len(gram))
        gram, rank = gram[df > 1], _rank(df[df > 1])
        return pa.table({"cell": pa.array([fragment * salts + i for i in range(salts)], pa.int32()), "grams": pa.array([gram.tobytes()] * salts, pa.binary()), "ranks": pa.array([rank.tobytes()] * salts, pa.binary())})

    def look_up(table: pa.Table, known: pa.Table) -> pa.Table:
        if not len(table):
            return pa.schema([(x.split(" ")[0], pa.int32() if x.endswith("int") else pa.binary()) for x in _SHARED.split(", ")]).empty_table()
        cls, size, gram, owner = _cell(table)
        held, rank = _column(known, "grams", np.uint64), _column(known, "ranks", np.uint8)
        if not len(held):
            held, rank = np.array([(1 << 64) - 1], np.uint64), np.zeros(1, np.uint8)  # no n-gram has more than 40 bits here
        at = np.minimum(np.searchsorted(held, gram), len(held) - 1)
        keep = held[at] == gram
        return cut_up(table.column("cell")[0].as_py() // salts, cls, size, gram[keep], owner[keep], rank[at][keep])

    if salts == 1:
        return cells.groupBy("cell").applyInArrow(alone, _SHARED)
    cells = staged(cells, "jaccard-cells")
    sums = cells.groupBy("cell").applyInArrow(tally, "fragment int, grams binary, counts binary")
    known = sums.groupBy("fragment").applyInArrow(total, "cell int, grams binary, ranks binary")
    return cells.groupBy("cell").cogroup(known.groupBy("cell")).applyInArrow(look_up, _SHARED)


def least_overlap(t: float, n: Column | int, m: Column | int) -> Column:
    return F.ceil(F.lit(t) / (1 + t) * (n + m) - 1e-9)


def _records(shared: DataFrame, percent: int) -> DataFrame:
    """class, n, free (unshared n-grams), grams in the global order, and how many are the prefix, for the sets that may have partners."""

    def gather(table: pa.Table) -> pa.Table:
        release_memory()
        cls, size, count = _column(table, "classes", np.int64), _column(table, "sizes", np.uint32).astype(np.int64), _column(table, "counts", np.uint32)
        gram, rank = _column(table, "grams", np.uint64), _column(table, "ranks", np.uint8)
        ids, back = np.unique(cls, return_inverse=True)
        n = np.zeros(len(ids), np.int64)
        n[back] = size
        owner = np.repeat(back, count)
        free = n - np.bincount(owner, minlength=len(ids))
        prefix = n - -(-percent * n // 100) + 1 - free
        keep = (prefix > 0)[owner]
        owner, gram, rank = owner[keep], gram[keep], rank[keep]
        order = np.lexsort((gram, rank, owner))
        owner, gram = owner[order], gram[order]
        own = np.flatnonzero(prefix > 0)
        ends = np.searchsorted(owner, np.append(own, len(ids)))
        ends[-1] = len(owner)
        grams = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(gram.astype(np.int64)))
        return pa.table([pa.array(ids[own]), pa.array(n[own]), pa.array(free[own]), pa.array(prefix[own].astype(np.int32)), grams], names=["class", "n", "free", "prefix", "grams"])

    return shared.groupBy("part").applyInArrow(gather, "class long, n long, free long, prefix int, grams array<long>")


def _link(n: Column, m: Column, overlap: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (n + m - overlap)


def _verified(pairs: DataFrame, records: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Overlaps are counted in fragments of the n-grams' hashes and summed."""
    fragment = lambda k: F.filter("grams", lambda g: F.pmod(g, F.lit(_PARTS)) == k)
    cut = records.select("class", "n", F.posexplode(F.array(*[fragment(k) for k in range(_PARTS)])).alias("fragment", "segment")).filter(F.size("segment") > 0)
    left = pairs.join(cut.select(F.col("class").alias("a"), F.col("n").alias("na"), "fragment", F.col("segment").alias("sa")), "a")
    both = left.join(cut.select(F.col("class").alias("b"), F.col("n").alias("nb"), "fragment", F.col("segment").alias("sb")), ["b", "fragment"])
    partial = both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).cast("long").alias("c"))
    sums = partial.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("c").alias("c"))
    return sums.filter(_link(F.col("na"), F.col("nb"), F.col("c"), percent)).select("a", "b")


def _roles(entries: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The smaller and the larger sets of the pairs to compare: s_ and l_ columns with gram, band and side to meet by.

    entries: gram, class, n, place, component, largest. The first n-gram that two linked sets of n <= m n-grams share
    has the whole overlap, 2 t n / (1 + t) or more, from it to the end of the smaller set, so the smaller one is
    found by fewer n-grams than the prefix has. Sets that link differ in size by a factor of 1 / t at most, so that the larger
    one is in the same band of size or the next. Side 0 is for smaller sets outside of the n-gram's largest component,
    which meet all; side 1 for those inside, which meet only sets outside.
    """
    of = lambda letter: [F.col(c).alias(f"{letter}_{c}") for c in ("class", "n", "place", "component")]
    band = F.floor(F.log("n") * ((1 - 1e-9) / max(-math.log(percent / 100), 0.01))).cast("int")
    outside = F.col("component") != F.col("largest")
    short = (F.col("n") - F.col("place")) * (100 + percent) >= 2 * percent * F.col("n")
    small = entries.filter(short).select("gram", F.explode(F.array(band, band + 1)).alias("band"), F.when(outside, 0).otherwise(1).alias("side"), *of("s"))
    large = entries.select("gram", band.alias("band"), F.explode(F.when(outside, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("side"), *of("l"))
    return small, large


def class_links(docs: DataFrame, n: int, percent: int, grams: int, sets: int) -> DataFrame | None:
    """Links (a, b) between classes that hold every component together, or None if there is no candidate."""
    bits = max(3, min(20, math.ceil(math.log2(max(1, grams / FRAGMENT)))))
    parts = max(8, -(-grams // GATHER))
    salts = max(1, -(-sets // SETS))
    records = staged(_records(_shared(_segments(docs, n, bits, salts), parts, salts), percent), "jaccard-sets")
    postings = records.select("class", "n", "free", F.posexplode(F.slice("grams", F.lit(1), F.col("prefix"))).alias("place", "gram")).withColumn("place", F.col("free") + F.col("place"))
    postings = staged(postings.select("gram", "class", "n", "place", "free"), "jaccard-index")
    # the pivot of an n-gram: the member with the smallest share of unshared n-grams
    pivots = postings.groupBy("gram").agg(F.min(F.struct((F.col("free") / F.col("n")).alias("share"), "class", "n")).alias("p"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("gram", F.col("p.class").alias("pivot"), F.col("p.n").alias("pn"))
    pivots = staged(pivots, "jaccard-pivots")  # staged, like `largest`: between two plain shuffles a skewed join can be split
    may = lambda n, m: (100 * F.least(n, m) >= percent * F.greatest(n, m))
    votes = postings.join(pivots, "gram").filter((F.col("class") != F.col("pivot")) & may(F.col("n"), F.col("pn"))).groupBy("class", "pivot").count()
    chosen = votes.groupBy("class").agg(F.max(F.struct("count", "pivot")).alias("v")).select(F.least("class", "v.pivot").alias("a"), F.greatest("class", "v.pivot").alias("b")).distinct()
    first = staged(_verified(chosen, records, percent), "jaccard-links")
    group = staged(components(first), "jaccard-groups")
    held = postings.join(group.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    held = staged(held.select("gram", "class", "n", "place", "component"), "jaccard-held")
    sizes = held.groupBy("gram", "component").count()
    largest = sizes.groupBy("gram").agg(F.max(F.struct("count", "component")).alias("top"), F.count(F.lit(1)).alias("groups")).filter("groups > 1").select("gram", F.col("top.component").alias("largest"))
    largest = staged(largest, "jaccard-largest")
    open_ = staged(held.join(largest, "gram"), "jaccard-open")
    small, large = _roles(open_, percent)
    room = 1 + F.least(F.col("s_n") - F.col("s_place"), F.col("l_n") - F.col("l_place")) - 1
    pairs = small.join(large, ["gram", "band", "side"]).filter((F.col("s_component") != F.col("l_component")) & (F.col("s_n") <= F.col("l_n")) & may(F.col("s_n"), F.col("l_n")) & (room >= least_overlap(percent / 100, F.col("s_n"), F.col("l_n"))))
    pairs = pairs.select(F.least("s_class", "l_class").alias("a"), F.greatest("s_class", "l_class").alias("b")).distinct()
    second = staged(_verified(staged(pairs, "jaccard-pairs"), records, percent), "jaccard-links")
    drop_staged(postings, pivots, held, largest, open_, records)
    return first.unionByName(second)


def near_duplicates(docs: DataFrame, *, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of docs (doc_id, text). Documents link when the Jaccard
    similarity of their n-gram sets is at least percent / 100; component_id is the smallest doc_id reachable."""
    own = staged(classes(docs, n), "jaccard-docs")
    grams, sets = own.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("class")).first()
    grouped = own.withColumn("component", F.col("class"))
    if grams:
        found = components(class_links(docs, n, percent, grams, sets))
        grouped = own.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = staged(grouped.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least")), "jaccard-least")
    return grouped.join(least, "component", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
