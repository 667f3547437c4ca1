"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; unlabelled ones are a sample of web text whose labels, if any,
aren't looked at, and no label of a bad document is. A linear scorer minimises the non-negative unbiased risk
    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))
under the sigmoid loss (Kiryo et al., 2017). The class prior pi is estimated from the two samples alone: the least ratio
of the shares of unlabelled and of positive rows that lie above a threshold of a score that tells the two samples
apart (Scott, 2015), on rows that this score wasn't fitted to. Features are counts of a whole text: shares of byte
classes and of each ASCII sign, lengths of words and lines, repetition of words and lines. Nothing but the text enters
a score.

Fitting reads a bounded sample (SAMPLE rows of either kind, in the order of a hash; of ids that repeat, rows and not ids
are counted); scoring is one pass over all texts with no shuffle.

Cases: null texts are scored like empty ones; without any positives every score is 0.5, which keeps documents;
repeated rows get equal scores; a very long text is read whole, by one task; empty tables give empty results; columns of
docs pass through `score`, whatever their names, but for score and predicted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_crc, staged, text_slices

#: Most rows in the training sample, of positives and of unlabelled rows each.
SAMPLE = 6000

_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]


def features(text: str | None) -> list[float]:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    seen = np.bincount(data, minlength=256)
    n = max(1, len(data))
    signs = seen[_SIGNS]
    upper, lower, digits, high = (int(seen[a:b].sum()) for a, b in ((65, 91), (97, 123), (48, 58), (128, 256)))
    out = [np.log1p(len(data)), *np.sqrt(signs / n), np.sqrt(upper / n), np.sqrt(lower / n), np.sqrt(digits / n), np.sqrt(high / n), np.sqrt(seen[32] / n), np.sqrt(seen[10] / n), upper / max(1, upper + lower), np.sqrt(signs.sum() / n)]
    words = (text or "").split()
    m = max(1, len(words))
    counts = Counter(words)
    top = counts.most_common(1)[0][1] if counts else 0
    same = sum(map(str.__eq__, words, words[1:]))
    lines = (text or "").split("\n")
    return [*out, np.log1p(len(words)), len(data) / m, len(counts) / m, len(counts) / np.sqrt(m), np.sqrt(top / m), top / m, np.sqrt(same / m), same / m, len(set(lines)) / len(lines), m / len(lines)]


def feature_rows(texts: list[str | None]) -> np.ndarray:
    return np.array([features(x) for x in texts], dtype=np.float64).reshape(len(texts), -1)


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800, rate: float = 0.03, decay: float = 1e-4) -> dict:
    """Centre, scale, weights and bias, by Adam on the whole of the non-negative risk; a step that would push the
    negative part below 0 ascends it instead."""
    both = np.concatenate([positive, unlabelled])
    centre, scale = both.mean(0), both.std(0) + 1e-6
    p, u = (np.clip((x - centre) / scale, -6, 6) for x in (positive, unlabelled))
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        sp, su = sigmoid(p @ w + b), sigmoid(u @ w + b)
        dp, du = sp * (1 - sp), su * (1 - su)
        # sigmoid loss: l(z, +1) = sigmoid(-z), l(z, -1) = sigmoid(z)
        plus = np.append(-(dp @ p), -dp.sum()) / len(p)
        minus_p, minus_u = np.append(dp @ p, dp.sum()) / len(p), np.append(du @ u, du.sum()) / len(u)
        rest = su.mean() - prior * sp.mean()
        grad = prior * plus + (minus_u - prior * minus_p) if rest >= 0 else -(minus_u - prior * minus_p)
        grad[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return {"centre": centre, "scale": scale, "w": w, "b": float(b)}


def risk(model: dict, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The non-negative risk of a model."""
    p, u = (1 / (1 + np.exp(-_margin(model, x))) for x in (positive, unlabelled))
    return float(prior * (1 - p).mean() + max(0.0, u.mean() - prior * p.mean()))


def _margin(model: dict, x: np.ndarray) -> np.ndarray:
    return np.clip(np.clip((x - model["centre"]) / model["scale"], -6, 6) @ model["w"] + model["b"], -30, 30)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.3) -> float:
    """The share of positives among the unlabelled rows. Thresholds leave at least `least` of the positives above."""
    apart = fit_pu(positive[::2], unlabelled[::2], 0.5, steps=300)
    p, u = (np.sort(_margin(apart, x[1::2] if len(x) > 1 else x)) for x in (positive, unlabelled))
    cut = p[: max(1, int(len(p) * (1 - least)))]
    above_p = 1 - np.searchsorted(p, cut) / len(p)
    above_u = 1 - np.searchsorted(u, cut) / len(u)
    return float(min(0.98, max(0.02, (above_u / above_p).min())))


def _sample(rows: DataFrame, n: int) -> DataFrame:
    """At most n ids, spread by a hash: the same ones in every run."""
    return rows.groupBy("doc_id").count().select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(n)


def training_rows(docs: DataFrame, labels: DataFrame, train: Column, sample: int) -> DataFrame:
    """positive, x: features of at most `sample` rows of documents labelled good, and of as many of any documents."""
    good = labels.select(F.col("doc_id").cast("long"), "quality").filter(train & (F.col("quality") == 1))
    web = docs.select(F.col("doc_id").cast("long")).filter(train & F.col("doc_id").isNotNull())
    wanted = _sample(good.filter("doc_id is not null"), sample).withColumn("positive", F.lit(1)).unionByName(_sample(web, sample).withColumn("positive", F.lit(0)))
    picked = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(wanted), "doc_id")  # at most 2 * sample ids
    picked = picked.withColumn("h", F.xxhash64("doc_id", "text", F.lit(7)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("positive"), pa.array(list(feature_rows(texts)), pa.list_(pa.float64()))], ["h", "positive", "x"])

    rows = picked.mapInArrow(run, "h long, positive int, x array<double>")
    first = lambda kind: rows.filter(F.col("positive") == kind).orderBy("h", "x").limit(sample)
    return first(1).unionByName(first(0))


def fit(docs: DataFrame, labels: DataFrame, *, train: Column | None = None, sample: int = SAMPLE) -> dict | None:
    """docs: doc_id, text. labels: doc_id, quality. train: condition on doc_id for rows to learn from (all)."""
    rows = staged(training_rows(docs, labels, F.lit(True) if train is None else train, sample), "quality-sample")
    table = rows.orderBy("positive", "h", "x").toArrow()  # at most 2 * sample rows
    x, kind = np.array(table.column("x").to_pylist()), np.array(table.column("positive").to_pylist())
    if not (kind == 1).any():
        return None
    positive, unlabelled = x[kind == 1], x[kind == 0]
    return fit_pu(positive, unlabelled, class_prior(positive, unlabelled))


def score(docs: DataFrame, model: dict | None, *, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from 0.5)."""
    docs = docs.drop("score", "predicted")
    if model is None:
        return docs.withColumn("score", F.lit(0.5)).withColumn("predicted", F.lit(1))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            s = 1 / (1 + np.exp(-_margin(model, feature_rows(texts))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, schema)


def held_out() -> Column:
    return doc_crc() % 3 == 1
