"""Nearest neighbours by additive quantisation.

A vector is the sum of one codeword from each of several full-dimensional codebooks. Codebooks are fitted one
after another to the residuals of a bounded sample (k-means); encoding is a beam search over the codebooks that
keeps the `beam` partial sums nearest to the vector. Codes are stored for every row, with the ratio of the vector's norm
to that of the coded vector. A query's inner products with all codewords make a lookup table; a candidate's score is
the sum of its codewords' entries times that ratio, for a coded vector points the right way but is too short. The best
share `rerank` of a block's candidates (not fewer than 3 k) is reranked with exact inner products in double precision;
being a share, it leaves the same part of the choice to the codes at any size.

Layout: rows and query rows are dealt by hashes into blocks of bounded size, and every block of queries meets every
block of rows in a task of its own (a stated query set against all rows, in blocks). Query blocks hold eight times as
many rows as the others, since queries are few, so that rows are copied once for every 65,536 queries. Equal vectors of
a block count as one candidate, so a vector that repeats thousands of times can't crowd out others. Each block gives its
best k for each query, exactly scored; these meet by query in a max-k aggregation. Work grows with rows times queries: a
coarse partition would have to visit nearly half of its lists for nine in ten of the neighbours of vectors without
clusters (README), so there is none.

Cases: vectors that are null, of another length than most (of lengths that are as frequent, than the one with the
smallest id), zero, or with null or non-finite components take no part as query or row; a row is never its own neighbour; ties go to the smaller id; fewer
rows than k give all of them; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Rows in the training sample, codebooks, codewords, and partial sums kept by the beam search.
SAMPLE, BOOKS, WORDS, BEAM = 4096, 12, 128, 4
#: Most rows and query rows of a task, on average, and the share of a block's candidates reranked for each query.
BLOCK_ROWS, QUERY_ROWS, RERANK = 8192, 65536, 0.1


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 6) -> np.ndarray:
    k = min(k, len(x))
    c = x[np.sort(rng.choice(len(x), k, replace=False))].copy()
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.choice(len(x), k)])
    return c


def fit(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, seed: int = 5) -> np.ndarray:
    """Codebooks (books, words, dim), each fitted to what the ones before it leave."""
    rng = np.random.default_rng(seed)
    left = sample.astype(np.float32)
    out = []
    for _ in range(books):
        c = _kmeans(left, words, rng)
        if len(c) < words:
            c = np.concatenate([c, np.zeros((words - len(c), c.shape[1]), c.dtype)])
        out.append(c)
        left = left - c[(left @ c.T - 0.5 * (c * c).sum(1)).argmax(1)]
    return np.array(out, np.float32)


def encode(x: np.ndarray, codebooks: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n, books) and squared norms of the coded vectors."""
    n, (books, words, _) = len(x), codebooks.shape
    flat = codebooks.reshape(books * words, -1)
    gram = flat @ flat.T
    codes = np.zeros((n, 1, 0), np.int64)
    cost = np.zeros((n, 1), np.float32)  # |sum|^2 - 2 x.sum of each partial sum
    for m in range(books):
        own = slice(m * words, (m + 1) * words)
        step = gram.diagonal()[own] - 2 * (x @ flat[own].T)
        total = cost[:, :, None] + step[:, None, :]
        for j in range(m):
            total += 2 * gram[own, j * words : (j + 1) * words].T[codes[:, :, j]]
        total = total.reshape(n, -1)
        keep = min(beam, total.shape[1])
        best = np.argpartition(total, keep - 1, axis=1)[:, :keep]
        cost = np.take_along_axis(total, best, 1)
        codes = np.concatenate([np.take_along_axis(codes, (best // words)[:, :, None], 1), (best % words)[:, :, None]], 2)
    at = cost.argmin(1)
    codes = codes[np.arange(n), at]
    coded = sum(codebooks[m][codes[:, m]] for m in range(books))
    return codes.astype(np.uint8 if words <= 256 else np.uint16), (coded * coded).sum(1)


def table_scores(queries: np.ndarray, codes: np.ndarray, codebooks: np.ndarray) -> np.ndarray:
    """Inner products of queries with coded rows, by lookup tables."""
    out = np.zeros((len(queries), len(codes)), np.float32)
    for m, book in enumerate(codebooks):
        out += np.take(queries @ book.T, codes[:, m], axis=1)
    return out


def sound(vector: str) -> Column:
    v = F.col(vector)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)


def search(rows: DataFrame, is_query: Column, *, k: int = 20, row_id: str = "vec_id", vector: str = "embedding", rerank: float = RERANK, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, sample: int = SAMPLE, books: int = BOOKS, words: int = WORDS, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each query row."""
    spark = rows.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    base = rows.select(F.col(row_id).cast("long").alias("vec_id"), F.col(vector).cast("array<float>").alias("v")).filter(F.col("vec_id").isNotNull() & sound("v"))
    dims = base.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    most = dims.orderBy(F.desc("n"), "first").first()
    if most is None:
        return spark.createDataFrame([], out)
    dim, n = most["dim"], most["n"]
    base = base.filter(F.size("v") == dim)
    drawn = base.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(sample).select("v").toArrow().column("v").to_pylist()
    codebooks = fit(np.array(drawn, np.float32), books, words)
    blocks = -(-n // block_rows)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)
            codes, norms = zip(*(encode(x[i : i + 1024], codebooks, beam) for i in range(0, len(x), 1024)), strict=True)
            stretch = np.sqrt((x.astype(np.float64) ** 2).sum(1) / np.maximum(np.concatenate(norms), 1e-30))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array([c.tobytes() for c in np.concatenate(codes)], pa.binary()), pa.array(stretch.astype(np.float32)), batch.column("q")], ["vec_id", "v", "code", "stretch", "q"])

    coded = base.withColumn("q", F.coalesce(is_query, F.lit(False))).mapInArrow(index, "vec_id long, v array<float>, code binary, stretch float, q boolean")
    coded = staged(coded, "ann-index")
    query_blocks = max(1, -(-coded.filter("q").count() // query_rows))
    place = lambda seed, n: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    pair = ["block", "query_block"]
    dealt = coded.drop("q").withColumn("block", place(1, blocks)).withColumn("query_block", every(query_blocks))
    queries = coded.filter("q").select("vec_id", "v").withColumn("query_block", place(2, query_blocks)).withColumn("block", every(blocks))

    def block(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(asked) or not len(held):
            return pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        held = held.sort_values("vec_id", kind="stable")
        x = np.stack(held["v"].to_numpy()).astype(np.float32)
        ids = held["vec_id"].to_numpy()
        _, at, same = np.unique(x.view(f"V{4 * dim}").ravel(), return_index=True, return_inverse=True)
        by = np.argsort(same, kind="stable")  # ids ascend inside each distinct vector
        begin = np.concatenate([[0], np.cumsum(np.bincount(same, minlength=len(at)))])
        codes = np.stack([np.frombuffer(c, np.uint8 if words <= 256 else np.uint16) for c in held["code"].to_numpy()[at]])
        exact = x[at].astype(np.float64)
        found = []
        stretch = held["stretch"].to_numpy()[at]
        keep = min(len(at), max(math.ceil(rerank * len(at)), 3 * k))
        for i in range(0, len(asked), 256):
            q = np.stack(asked["v"].to_numpy()[i : i + 256]).astype(np.float32)
            rough = table_scores(q, codes, codebooks) * stretch
            near = np.argpartition(-rough, keep - 1, axis=1)[:, :keep] if keep < len(at) else np.tile(np.arange(len(at)), (len(q), 1))
            for own, v, c in zip(asked["vec_id"].to_numpy()[i : i + 256], q.astype(np.float64), near, strict=True):
                s = exact[c] @ v
                top = c[np.argsort(-s, kind="stable")[: k + 1]]
                least = np.sort(s)[::-1][min(k, len(s) - 1)]
                top = c[s >= least]  # with all distinct vectors that tie
                pick = np.concatenate([by[begin[t] : begin[t + 1]][: k + 1] for t in top])
                score = exact[same[pick]] @ v
                pick, score = pick[ids[pick] != own], score[ids[pick] != own]
                best = np.lexsort((ids[pick], -score))[:k]
                found.append((np.full(len(best), own), ids[pick[best]], score[best]))
        return pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*found, strict=True)), strict=True)))

    near = queries.groupBy(*pair).cogroup(dealt.groupBy(*pair)).applyInPandas(block, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
