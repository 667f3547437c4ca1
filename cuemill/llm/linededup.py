"""Line deduplication by winnowing over line hashes.

A document is the sequence of its lines with words. A window is a run of lines that has `min_words` words and would
not without its last line (counted from its first line) or without its first line (counted back from its last).
Of every window the line with the least hash is selected (of equal ones the last), each line once however many windows
select it: these are the fingerprints. A run of `min_words` words or more that two places share contains a whole window,
and both places select the same line of it, so they meet in a fingerprint: detection is guaranteed.

Positions are joined by the selected line's hash. Where a hash has at most `PAIRS` positions, every later one meets every
earlier one that a window of equal content selected; meetings of the same two documents at the same distance are one
match, which is extended both ways over the documents' line hashes, and kept as a run if it has `min_words` words. Hashes with more positions (a common line,
thousands of copies) would give pairs without end. There the windows that selected the line stand for it: windows are
joined by the hash of their whole content to the first place that has it, and windows that overlap make up the run.
Every line of a run lies in a window inside the run, so both ways delete the same lines: those of all runs that an
earlier place has, whichever place that is. Lines outside such runs stay, however often they repeat.

What is joined is positions and line hashes. Texts don't move for it; one join at the end brings the lines to delete to
the documents, as a broadcast where they are few.

Cases: null and empty texts stay as they are; blank lines match nothing and stay; documents are ordered by doc_id
(null first), then by text hash; equal rows (id and text) are one document, so repeated rows keep the same
lines; a document that is wholly repeated becomes an empty text; a very long text is one row of line hashes; an empty
table gives an empty one; other columns pass through, whatever their names, but for n_lines and n_removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_join, drop_staged, free_names, row_slices, staged, text_slices

MIN_WORDS = 50
#: Most positions of a line hash that are paired with one another; beyond it windows are joined instead, with the same result.
PAIRS = 8
_KEYS = ["_doc", "_text"]


def line_rows(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """Number, hash and word count of each line with words."""
    at, hashes, words = [], [], []
    for i, line in enumerate((text or "").split("\n")):
        line = line.strip().encode("utf-8", "surrogatepass")  # equal hashes go with equal counts
        n = len(line.split())
        if n:
            at.append(i)
            hashes.append(xxhash.xxh3_64_intdigest(line) - (1 << 63))
            words.append(n)
    return at, hashes, words


def windows(words: list[int], least: int) -> list[tuple[int, int]]:
    """(first line, last line) of each window."""
    out = []
    end, held = 0, 0
    for start in range(len(words)):
        while end < len(words) and held < least:
            held += words[end]
            end += 1
        if held < least:
            break
        out.append((start, end - 1))
        held -= words[start]
    start, held = 0, 0
    for end, n in enumerate(words, 1):
        held += n
        while start + 1 < end and held - words[start] >= least:
            held -= words[start]
            start += 1
        if held - n >= least:  # else it is a window from its start, or too short
            out.append((start, end - 1))
    return out


def winnow(hashes: list[int], words: list[int], least: int) -> dict[int, list[tuple[int, int]]]:
    """The selected lines, and the windows that selected each."""
    out: dict[int, list[tuple[int, int]]] = {}
    for a, b in windows(words, least):
        chosen = min(range(b, a - 1, -1), key=hashes.__getitem__)
        out.setdefault(chosen, []).append((a, b))
    return out


def extend(later: list[int], words: list[int], earlier: list[int], shift: int, places: list[int], least: int) -> list[tuple[int, int]]:
    """Runs of `later` around the places that equal the lines `shift` before in `earlier` and have the words needed."""
    out: list[tuple[int, int]] = []
    for p in sorted(places):
        if out and p <= out[-1][1]:
            continue
        a = b = p
        while a and a > shift and later[a - 1] == earlier[a - 1 - shift]:
            a -= 1
        while b + 1 < len(later) and b + 1 - shift < len(earlier) and later[b + 1] == earlier[b + 1 - shift]:
            b += 1
        out.append((a, b))
    return [(a, b) for a, b in out if sum(words[a : b + 1]) >= least]


def gone_lines(runs: list[tuple[int, int]], at: list[int]) -> list[bool]:
    """For each line of the text up to the last one that goes: whether it does."""
    cut = {at[i] for a, b in runs for i in range(a, b + 1)}
    return [i in cut for i in range(max(cut, default=-1) + 1)]


def repeated_lines(docs: DataFrame, *, min_words: int = MIN_WORDS, pairs: int = PAIRS) -> DataFrame:
    """_doc, _text (the keys of a document) and _gone, which of its lines repeat an earlier run."""
    keyed = docs.select(*_key_columns(), "text")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            rows = [(d, t, *x) for d, t, x in zip(batch.column("_doc").to_pylist(), batch.column("_text").to_pylist(), map(line_rows, texts), strict=True) if sum(x[2]) >= min_words]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], [*_KEYS, "at", "h", "w"])

    # documents with fewer words have no window; equal rows are one document
    own = staged(keyed.mapInArrow(lines, "_doc long, _text long, at array<int>, h array<long>, w array<int>").dropDuplicates(_KEYS), "lines")

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            rows = []
            for d, t, h, w in zip(*(batch.column(c).to_pylist() for c in ("_doc", "_text", "h", "w")), strict=True):
                packed = np.array(h, np.int64).tobytes()
                for p, own in winnow(h, w, min_words).items():
                    rows.append((h[p], d, t, p, [xxhash.xxh3_64_intdigest(packed[8 * a : 8 * b + 8]) - (1 << 63) for a, b in own], [a for a, _ in own], [b for _, b in own]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], ["key", *_KEYS, "p", "windows", "starts", "ends"])

    prints = staged(own.select(*_KEYS, "h", "w").mapInArrow(select, "key long, _doc long, _text long, p int, windows array<long>, starts array<int>, ends array<int>"), "fingerprints")
    # tables that are joined to hot keys are staged: between two plain shuffles a skewed join can be split
    counts = staged(prints.groupBy("key").count().filter("count > 1"), "positions")
    # what is joined here grows with the corpus and is never broadcast; a merge join can be split where a key is hot
    shared = staged(prints.join(counts.hint("merge"), "key"), "shared-lines")

    few = shared.filter(F.col("count") <= pairs).select("key", *_KEYS, "p", "windows")
    met = few.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(*_KEYS, "p", "windows"))).alias("x"))
    # a run holds a whole window, which both places have among those that selected the line
    earlier = F.filter(F.slice("x", F.lit(1), F.col("i")), lambda e: F.arrays_overlap(e["windows"], F.col("later.windows")))
    each = met.select(F.posexplode("x").alias("i", "later"), "x").select("later", F.explode(earlier).alias("earlier"))
    shift = (F.col("later.p") - F.col("earlier.p")).alias("shift")
    matches = each.groupBy(F.col("later._doc").alias("_doc"), F.col("later._text").alias("_text"), F.col("earlier._doc").alias("e_doc"), F.col("earlier._text").alias("e_text"), shift).agg(F.collect_set("later.p").alias("places"))
    early = own.select(F.col("_doc").alias("e_doc"), F.col("_text").alias("e_text"), F.col("h").alias("e"))
    both = matches.join(early, ["e_doc", "e_text"]).join(own.select(*_KEYS, "h", "w"), _KEYS).select(*_KEYS, "shift", "places", "h", "w", "e")

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            rows = [(d, t, a, b) for d, t, s, p, h, w, e in zip(*(batch.column(c).to_pylist() for c in (*_KEYS, "shift", "places", "h", "w", "e")), strict=True) for a, b in extend(h, w, e, s, p, min_words)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)], [*_KEYS, "start", "end"])

    extended = both.mapInArrow(stretch, "_doc long, _text long, start int, end int")

    many = shared.filter(F.col("count") > pairs).select(*_KEYS, F.explode(F.arrays_zip("windows", "starts", "ends")).alias("x"))
    many = staged(many.select(F.col("x.windows").alias("window"), *_KEYS, F.col("x.starts").alias("start"), F.col("x.ends").alias("end")), "windows")
    first = staged(many.groupBy("window").agg(F.min(F.struct(*_KEYS, "start")).alias("s"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("window", "s"), "first-places")
    again = many.join(first, "window").filter(F.struct(*_KEYS, "start") != F.col("s")).select(*_KEYS, "start", "end")

    found = staged(extended.unionByName(again).groupBy(*_KEYS).agg(F.collect_set(F.struct("start", "end")).alias("runs")), "line-matches")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            gone = [gone_lines([(x["start"], x["end"]) for x in runs], at) for runs, at in zip(*(batch.column(c).to_pylist() for c in ("runs", "at")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("_text"), pa.array(gone, pa.list_(pa.bool_()))], [*_KEYS, "_gone"])

    out = staged(found.join(own.select(*_KEYS, "at").hint("merge"), _KEYS).select(*_KEYS, "runs", "at").mapInArrow(gather, "_doc long, _text long, _gone array<boolean>"), "gone-lines")
    drop_staged(prints, counts, shared, own, many, first, found)
    return out


def _key_columns() -> list:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_doc"), F.xxhash64("text").alias("_text")]


def dedup_lines(docs: DataFrame, *, min_words: int = MIN_WORDS, pairs: int = PAIRS) -> DataFrame:
    """docs with the text that stays, n_lines of the text before and n_removed."""
    docs = docs.drop("n_lines", "n_removed")
    doc, text, gone = free_names(docs.columns, "doc", "text", "gone")
    cut = repeated_lines(docs, min_words=min_words, pairs=pairs).withColumnsRenamed({"_doc": doc, "_text": text, "_gone": gone})
    joined = bounded_join(docs.withColumns(dict(zip((doc, text), _key_columns(), strict=True))), cut, [doc, text], "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.zip_with(lines, gone, lambda x, g: F.when(~F.coalesce(g, F.lit(False)), x)), "\n")  # without nulls
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_removed = F.when(F.col(gone).isNull(), 0).otherwise(F.size(F.filter(gone, lambda g: g))).cast("long")
    kept = F.when(F.col(gone).isNotNull(), kept).otherwise(F.col("text"))
    return joined.select(*[kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns], n_lines.alias("n_lines"), n_removed.alias("n_removed"))
