"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle, 1994).

Letters are lower-cased, every run of other characters is one space, and the n-grams of 1 to 3 characters are
counted. A profile holds the TOP most frequent n-grams in order. A document's distance to a profile is the sum,
over the document's own TOP n-grams, of how far each is out of place; one that the profile lacks costs TOP.
The nearest profile wins, ties to the smaller name. n-grams are exact: up to three code points in 63 bits.

Profiles come from a bounded sample for each language (about SAMPLE documents, taken by a hash below a share
that follows from the language's count); prediction is one pass over all texts with no shuffle.

Cases: null texts and texts without a letter are `und` with score 0; without any profile all are; null
languages aren't learned; of more than `languages` different values those with most documents are, ties to the smaller;
ties in counts go by n-gram; repeated rows count each; a very long text is read whole, by one task; an empty table gives
an empty result; columns of docs pass through, whatever their names, but for lang_pred and score.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_crc, staged, text_slices

TOP = 300
#: Expected number of documents for each language in the training sample.
SAMPLE = 1500
#: Most languages that get a profile.
LANGUAGES = 1000
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.frombuffer(bytes(chr(c).isalpha() for c in range(sys.maxunicode + 1)), np.bool_)
    return _letters


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct n-grams and their counts, or None where there is no letter."""
    if not text:
        return None
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[c]
    if not letter.any():
        return None
    keep = letter | np.concatenate([[False], letter[:-1]])  # of other characters the first after a letter
    c = np.concatenate([[32], np.where(letter, c, 32)[keep]]).astype(np.uint64)
    if c[-1] != 32:
        c = np.append(c, np.uint64(32))
    two = c[:-1] << np.uint64(21) | c[1:]
    three = two[:-1] << np.uint64(21) | c[2:]
    every = np.sort(np.concatenate([c[c != 32], two, three]))
    at = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[at], np.diff(np.append(at, len(every)))


def ranked(keys: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The top n-grams by falling count, then by n-gram (keys ascend)."""
    if len(keys) > 4 * top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    def __init__(self, profiles: dict[str, np.ndarray], top: int = TOP) -> None:
        self.names = sorted(profiles)
        self.top = top
        self.vocabulary = np.unique(np.concatenate([profiles[n] for n in self.names])) if self.names else np.array([], np.uint64)
        self.places = np.full((len(self.names), len(self.vocabulary) + 1), -1, np.int64)
        for i, n in enumerate(self.names):
            self.places[i, np.searchsorted(self.vocabulary, profiles[n])] = np.arange(len(profiles[n]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and how much nearer than the farthest possible distance it is."""
        found = grams(text) if self.names else None
        if found is None:
            return "und", 0.0
        own = ranked(*found, self.top)
        at = np.searchsorted(self.vocabulary, own)
        at[(at < len(self.vocabulary)) & (self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] != own)] = len(self.vocabulary)
        places = self.places[:, at]
        out = np.where(places < 0, self.top, np.abs(places - np.arange(len(own)))).sum(1)
        best = int(out.argmin())
        return self.names[best], float(1 - out[best] / (self.top * len(own)))


def fit(docs: DataFrame, *, train: Column | None = None, sample: int = SAMPLE, top: int = TOP, languages: int = LANGUAGES) -> Profiles:
    """docs: doc_id, text, lang. train: condition on the rows to learn from."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows if train is None else rows.filter(train)
    shares = staged(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang", (F.lit(float(sample)) / F.col("count")).alias("share")), "language-shares")
    u = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.join(F.broadcast(shares), "lang").filter(u < F.col("share")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[int, int]] = {}
        for batch, texts in text_slices(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                if (found := grams(text)) is not None:
                    own = held.setdefault(lang, {})
                    for k, n in zip(found[0].tolist(), found[1].tolist(), strict=True):
                        own[k] = own.get(k, 0) + n
        for lang, own in held.items():
            keys = list(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys, pa.int64()), pa.array(list(own.values()), pa.int64())], ["lang", "gram", "n"])

    sums = picked.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    table = sums.withColumn("place", place).filter(F.col("place") <= top)
    found: dict[str, list] = {}
    for r in table.orderBy("lang", "place").collect():  # at most top rows for each language
        found.setdefault(r["lang"], []).append(r["gram"])
    return Profiles({k: np.array(v, np.uint64) for k, v in found.items()}, top)


def predict(docs: DataFrame, profiles: Profiles, *, text: str = "text") -> DataFrame:
    """docs with lang_pred and score."""
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            found = [profiles.predict(x) for x in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def held_out() -> Column:
    return doc_crc() % 4 == 2
