"""Helpers shared by the training-data operators: staged tables, text batches, bounded joins."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import drop_staged, new_path, shared_folder, staged  # noqa: F401

#: A word: a run of anything but space and the ASCII controls TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows below which a staged table is broadcast in bounded_join.
BROADCAST_ROWS = 200_000


def bounded_join(big: DataFrame, small: DataFrame, on: list[str], how: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join `small`, a staged table, to `big`: broadcast if a count shows that it has at most `rows` rows,
    else a shuffled hash join on the keys. The result is the same either way."""
    if small.limit(rows + 1).count() <= rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small.hint("shuffle_hash"), on, how)


def word_count(text: Column | str) -> Column:
    """Number of words; null text counts 0."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def doc_crc(doc_id: str = "doc_id") -> Column:
    """Unsigned CRC-32 of the id written as decimal text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def release_memory() -> None:
    """Give freed memory of this Python worker back to the system: workers are reused, and what one stage has freed
    would else count on top of what the next one needs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def row_slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many rows, for rows that may hold long lists."""
    release_memory()
    for batch in batches:
        for begin in range(0, len(batch), rows):
            yield batch.slice(begin, rows)
    release_memory()


def text_slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches whose texts hold about `most` bytes together (one text at least)."""
    release_memory()
    for batch in batches:
        begin, held = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for i, n in enumerate([*sizes, most + 1]):
            if i > begin and held + n > most:
                part = batch.slice(begin, i - begin)
                yield part, part.column(column).to_pylist()
                begin, held = i, 0
            held += n
    release_memory()


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, with as many underscores before them as make them differ from all taken ones, whatever their case."""
    held, out = {x.lower() for x in taken}, []
    for name in names:
        name = f"_{name}"
        while name.lower() in held:
            name = f"_{name}"
        out.append(name)
    return out
