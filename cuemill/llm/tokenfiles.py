"""Token ids as Parquet list columns.

Documents are dealt by ranges of doc_id, encoded, and written in ascending doc_id order by Spark's own Parquet
writer: ids are a list column, delta or dictionary encoded (`encoding`), in row groups of `row_group_bytes` with
pages of at most `page_rows` rows, so that the page index that the writer adds lets a reader of some documents
skip the pages of all others; n_tokens, part and local_start are columns of their own, read without the ids.

Encoding a text whole is slow, so pieces are cached. Byte-level BPE first splits a text into pieces by a pattern, and
no piece depends on its neighbours. A slice of texts is split at once, by classes of code points; its different pieces
are looked up by two 64-bit hashes in a worker's sorted cache of bounded size; new ones go to the tokenizer's BPE
model; what has not been used lately makes room. This holds only for a tokenizer file of that kind
(`_cuts_by_pieces`); with any other file, for texts with a special token's string, and should two pieces ever share one
of their hashes but not the other, texts are encoded whole.

`select_documents` reads the tokens of stated documents: their ids are pushed down to the page index, and `metadata`
reads no ids at all.

Cases: null text is empty and gets the end id alone; repeated ids keep all their rows, ordered by text; a null
doc_id comes first; an empty table gives files without rows; a very long text is one row of one slice, and its ids
are cut out of one buffer; other columns, whatever their names, aren't read.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, text_slices

#: Most cached pieces of a worker (about 50 bytes each).
CACHE = 2_000_000
_SPACE, _LETTER, _NUMBER, _OTHER, _NONE = range(5)
_classes: np.ndarray | None = None
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _class_table() -> np.ndarray:
    global _classes
    if _classes is None:
        kind = {"L": _LETTER, "N": _NUMBER}
        _classes = np.frombuffer(bytes(kind.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(sys.maxunicode + 1)), np.uint8).copy()
        # white space as Unicode's property has it
        _classes[[*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return _classes


def split_pieces(c: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where pieces start in the code points c of several texts, each of which starts at one of begin.

    The pattern's alternatives: a short form (such as 's), runs of letters, of numbers, of other signs, each with a
    space before it if there is one; white space up to the last of it that something follows; white space."""
    n = len(c)
    kind = _class_table()[c]
    before = np.concatenate([[_NONE], kind[:-1]]).astype(np.uint8)
    before[begin[begin < n]] = _NONE
    start = kind != before
    after_space = np.flatnonzero(start & (before == _SPACE))
    start[after_space - 1] = True
    start[after_space[c[after_space - 1] == 32]] = False
    end = np.append(begin, n)
    sign = np.flatnonzero((c == 39) & start & (before != _OTHER))
    if len(sign):
        left = end[np.searchsorted(end, sign, side="right")] - sign  # code points up to the text's end
        padded = np.concatenate([c, [0, 0]])
        a, b = padded[sign + 1], padded[sign + 2]
        short = np.isin(a, [ord(x) for x in "stmd"]) & (left > 1)
        long = (left > 2) & np.logical_or.reduce([(a == ord(x[0])) & (b == ord(x[1])) for x in ("re", "ve", "ll")])
        for which, size in ((short, 2), (long & ~short, 3)):
            at = sign[which]
            start[at + 1] = False
            after = at + size
            start[after[after < n]] = True
    return np.flatnonzero(start)


def _piece_hashes(c: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each piece."""
    size = np.diff(np.append(start, len(c)))
    place = np.arange(len(c)) - np.repeat(start, size)
    most = int(size.max())
    out = []
    with np.errstate(over="ignore"):
        for i, base in enumerate(_BASES):
            if len(_powers[i]) < most:
                steps = np.full(max(most, 4096), base, np.uint64)
                steps[0] = 1
                _powers[i] = np.multiply.accumulate(steps)
            x = np.add.reduceat((c + np.uint64(1)) * _powers[i][place], start) ^ (size.astype(np.uint64) << np.uint64(40))
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append(x ^ (x >> np.uint64(29)))
    return out


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin[0] .. begin[0] + size[0] - 1, begin[1] .. and so on."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size - begin, size)


def _byte_signs() -> dict[int, str]:
    """The sign by which byte-level BPE writes each byte, as a table for str.translate of Latin-1 texts."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _cuts_by_pieces(settings: dict) -> bool:
    """Whether ids of a text are those of its pieces, as `split_pieces` has them, side by side."""
    pre, model = settings.get("pre_tokenizer") or {}, settings.get("model") or {}
    return (
        settings.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and model.get("type", "BPE") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and settings.get("truncation") is None
        and settings.get("padding") is None
    )


class _Cache:
    """ids of pieces by hash: sorted keys with a second hash to check, and the place of their ids in a pool."""

    def __init__(self, dtype: np.dtype, most: int) -> None:
        self.most, self.clock, self.purged = most, 0, 0
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.begin, self.size, self.used = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
        self.pool = np.empty(0, dtype)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys (ascending), and which are there."""
        self.clock += 1
        at = np.searchsorted(self.key, key)
        there = at < len(self.key)
        there[there] = self.key[at[there]] == key[there]
        self.used[at[there]] = self.clock
        return at, there

    def add(self, at: np.ndarray, key: np.ndarray, check: np.ndarray, ids: list[list[int]]) -> None:
        size = np.fromiter(map(len, ids), np.int32, len(ids))
        begin = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, np.fromiter((x for y in ids for x in y), self.pool.dtype, int(size.sum()))])
        self.key, self.check = np.insert(self.key, at, key), np.insert(self.check, at, check)
        self.begin, self.size = np.insert(self.begin, at, begin), np.insert(self.size, at, size)
        self.used = np.insert(self.used, at, self.clock)

    def make_room(self) -> None:
        if len(self.key) <= self.most:
            return
        keep = self.used > np.partition(self.used, len(self.used) // 2)[len(self.used) // 2]
        places = _ragged(self.begin[keep], self.size[keep])
        self.pool = self.pool[places]
        self.key, self.check, self.size, self.used = self.key[keep], self.check[keep], self.size[keep], self.used[keep]
        self.begin = np.cumsum(self.size, dtype=np.int64) - self.size


class PieceCachedEncoder:
    """ids of texts by a file of the tokenizers library, the same as encode(text, add_special_tokens=False)."""

    def __init__(self, path: str, cache: int = CACHE) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library would start a thread for each of the machine's
        self.tokenizer = Tokenizer.from_file(path)
        self.by_pieces = _cuts_by_pieces(json.loads(self.tokenizer.to_str()))
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype(np.uint32 if self.tokenizer.get_vocab_size(with_added_tokens=True) > 65536 else np.uint16)
        self.signs = _byte_signs()
        self.cache = _Cache(self.dtype, cache)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bpe(self, piece: str) -> list[int]:
        return [t.id for t in self.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.signs))]

    def _pieces(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """ids of texts without special tokens, and which of them must be encoded whole."""
        joined = "".join(texts)
        if not joined:
            return [np.empty(0, self.dtype)] * len(texts), np.zeros(len(texts), bool)
        c = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        start = split_pieces(c, begin[:-1])
        end = np.append(start[1:], len(c))
        key, check = _piece_hashes(c, start)
        distinct, first, back = np.unique(key, return_index=True, return_inverse=True)
        cache = self.cache
        at, there = cache.find(distinct)
        new = first[~there]
        if len(new):
            bpe = self._bpe
            cache.add(at[~there], distinct[~there], check[new], [bpe(joined[a:b]) for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
            at = np.searchsorted(cache.key, distinct)
        place = at[back]
        size = cache.size[place].astype(np.int64)
        ids = cache.pool[_ragged(cache.begin[place], size)]
        # pieces before each text, and so ids before it
        ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, begin)]
        wrong = np.zeros(len(texts), bool)
        wrong[np.searchsorted(begin, start[cache.check[place] != check], side="right") - 1] = True
        cache.make_room()
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)], wrong

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        plain = ["" if not x or not self.by_pieces or any(s in x for s in self.special) else x for x in texts]
        out, wrong = self._pieces(plain)
        whole = [i for i, x in enumerate(texts) if x and (wrong[i] or not plain[i])]
        for i, x in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
            out[i] = x
        return out


_encoders: dict[str, PieceCachedEncoder] = {}


def encoder(path: str) -> PieceCachedEncoder:
    if path not in _encoders:
        _encoders[path] = PieceCachedEncoder(path)
    return _encoders[path]


def encode(docs: DataFrame, tokenizer: str, end_id: int | None = 0) -> DataFrame:
    """doc_id, ids, n_tokens of each row of docs (doc_id, text), in the rows' order, end_id appended; part is the
    task that read the row, and local_start the number of ids before it in that task."""
    end = [] if end_id is None else [end_id]
    names = ["doc_id", "ids", "n_tokens", "part", "local_start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, at = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch, texts in text_slices(batches, "text"):
            rows = [x for ids in enc.encode(texts) for x in (ids, end)]
            sizes = np.fromiter(map(len, rows), np.int64, len(rows)).reshape(len(texts), -1).sum(1)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(rows).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(sizes), pa.array(np.full(len(sizes), part, np.int32)), pa.array(at + offsets[:-1])], names)
            at += int(offsets[-1])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, part int, local_start long")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, end_id: int | None = 0, parts: int | None = None, encoding: str = "delta", row_group_bytes: int = 32 << 20, page_rows: int = 2000, codec: str = "zstd") -> None:
    """Write doc_id, ids, n_tokens, part and local_start (ids of the part before this document) to path."""
    if encoding not in ("delta", "dictionary"):
        raise ValueError(f"unknown encoding {encoding!r}")
    spark = docs.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = docs.select("doc_id", "text").repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    options = {"compression": codec, "parquet.block.size": str(row_group_bytes), "parquet.page.row.count.limit": str(page_rows)}
    if encoding == "delta":
        options |= {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}
    encode(dealt, tokenizer, end_id).write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with start, the number of ids of all documents before. One row for each part is summed."""
    files = spark.read.parquet(path)
    before = F.coalesce(F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = files.groupBy("part").agg(F.sum("n_tokens").alias("held")).select("part", before.alias("base"))
    return files.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("local_start"))  # as many rows as files


def select_documents(tokens: DataFrame, doc_ids: list[int]) -> DataFrame:
    """The rows of the stated documents. The ids are a filter on the files' doc_id column, by which row groups and
    pages that can't hold them are skipped."""
    return tokens.filter(F.col("doc_id").isin([int(x) for x in doc_ids]))


def metadata(tokens: DataFrame) -> DataFrame:
    """doc_id, start and n_tokens, without a read of the ids."""
    return tokens.select("doc_id", "start", "n_tokens")


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of each row's ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            data, offsets = ids.values.to_numpy().astype("<u4").view(np.uint8).data, (ids.offsets.to_numpy().astype(np.int64) * 4).tolist()
            crcs = [zlib.crc32(data[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]
            sizes = np.diff(offsets) // 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer: str, **options: object) -> DataFrame:
    """Write docs' tokens to the shared folder and read them back."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, **options)
    return read_tokens(docs.sparkSession, path)
