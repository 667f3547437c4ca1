import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from cuemill.llm import quality
from test_operators import repeated, water, words

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    """rows: doc_id, text."""
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], ROWS)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    rng = random.Random(4)
    text = lambda: [f"w{rng.randint(0, 9999)}" for _ in range(60)]
    a, b, c, d, e = (text() for _ in range(5))
    near = lambda w: " ".join([*w[:-1], "other"])
    a, b, c, d, e, a2, b2 = *map(" ".join, (a, b, c, d, e)), near(a), near(b)
    rows = [(1, a), (1, a), (7, a2)]  # repeated rows and a near copy
    rows += [(None, b), (None, b), (9, b2), (None, b2)]  # null ids, of each other and of a document with an id
    rows += [(5, a2), (5, c)]  # two texts with one id, one a near copy
    rows += [(None, d), (None, d), (None, e), (None, d)]  # null ids only
    rows += [(20, None), (20, None), (None, "")]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, table(spark, rows), "").collect()]
    want = [(1, a), (9, b2), (5, c), (None, d), (None, e), (20, None), (20, None), (None, "")]
    assert sorted(got, key=str) == sorted(want, key=str)


def corpus(seed=6):
    """Rows of every kind: null and repeated ids, repeated rows, near copies, repeated runs, texts without words."""
    rng = random.Random(seed)
    line = lambda n: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))
    run = [line(30), line(30), line(12)]
    rows = [(i, "\n".join([line(20), line(9)])) for i in range(30)]
    rows += [(40 + i, "\n".join([line(9 + i), *run, line(8)])) for i in range(4)]
    rows += [(50, rows[3][1]), (51, rows[4][1] + " more"), (5, rows[5][1]), (6, line(25)), (None, rows[7][1]), (None, line(21)), (60, "\n".join(run))]
    return [*rows, rows[-2], (61, None), (62, ""), (None, " \n")]


def by_id(rows):
    return sorted(((r[0], r[1]) for r in rows), key=str)


def near_kept(rows):
    """One row of each group of near copies."""
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := words(t)) else None for _, t in rows]
    group = [*range(len(rows))]
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    return [min((rows[i] for i in range(len(rows)) if group[i] == g), key=lambda r: (r[0] is None, r[0] or 0)) for g in {*group}]


def lines_kept(rows):
    """Rows without repeated lines; equal rows and the order of documents are as linededup has them."""
    ordered = sorted({*rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    cut = repeated([(k, t) for k, (_, t) in enumerate(ordered)])
    text = {r: None if r[1] is None else "\n".join(x for n, x in enumerate(r[1].split("\n")) if n not in cut[k]) for k, r in enumerate(ordered)}
    return [(r[0], text[r]) for r in rows if text[r] == r[1] or text[r].strip()]


def test_line_and_near_dedup_against_brute_force(spark):
    rows = corpus()
    got = corpus_pipeline.line_dedup(spark, table(spark, rows), "").collect()
    assert by_id(got) == by_id(lines_kept(rows)) and 60 not in {r.doc_id for r in got}
    assert all(r.n_chars == len(r.text or "") for r in got)
    assert by_id(corpus_pipeline.near_dedup(spark, table(spark, rows), "").collect()) == by_id(near_kept(rows))


def test_quality_mixing_packing(spark, tmp_path):
    rows = corpus()
    docs = table(spark, rows)
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert by_id(corpus_pipeline.good_quality(spark, docs, str(tmp_path)).collect()) == by_id(rows)  # nothing is known
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    # one source: its target is all of its words, each row once
    assert by_id(mixed.collect()) == by_id(rows)
    packed = corpus_pipeline.pack_bins(spark, docs, "").collect()
    assert sorted((r.doc_id, r.length) for r in packed if r.doc_id is not None) == sorted((i, len(words(t))) for i, t in rows if i is not None)
    assert sum(r.length for r in packed) == sum(len(words(t)) for _, t in rows)


def test_mixing_of_several_sources(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, i]), "w " * rng.randint(0, 40), "en", rng.choice([None, "a", "b", "b", "b", "c"]), 0) for i in range(300)]
    rows += rows[:5]
    size, taken = Counter(), Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    want = water(dict(size), {s: i % 3 + 1 for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}, 3)
    got = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, ROWS), "").collect()
    for r in got:
        taken[r.source] += len(words(r.text))
    assert all(abs(taken[s] - want[s]) <= 40 for s in want)
    assert {(r.doc_id, r.text, r.source) for r in got} <= {(r[0], r[1], r[3]) for r in rows}


def test_quality_with_labels(spark, tmp_path):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["the", "river", "was", "and", "quiet", "people", "of", "house"]) for _ in range(60)) + "."
    junk = lambda: " ".join(rng.choice(["$$$", "CLICK", "!!!", "0000", "###", "BUY"]) for _ in range(60))
    rows = [(i, good() if i % 2 else junk()) for i in range(80)] + [(None, good()), (None, junk()), (3, None), (4, ""), (5, good())]
    docs, labels = table(spark, [*rows, rows[1]]), spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    model = quality.fit(docs, labels)
    x = (np.array(list(quality.feature_rows([t for _, t in [*rows, rows[1]]]))) - model["centre"]) / model["scale"]
    z = np.clip(x, -6, 6) @ model["w"] + model["b"]
    want = [r for r, v in zip([*rows, rows[1]], z, strict=True) if v >= 0]
    got = by_id(corpus_pipeline.good_quality(spark, docs, str(tmp_path)).collect())
    assert got == by_id(want) and 0 < len(want) < len(rows)


def test_run_against_brute_force(spark, tmp_path):
    rows = corpus()
    docs = table(spark, rows).withColumns({c: F.lit(7) for c in ("_row", "_doc", "n_lines", "predicted", "copies", "size")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = near_kept(lines_kept(rows))
    assert sorted(((r.doc_id, r.size) for r in got), key=str) == sorted(((i, len(words(t))) for i, t in want), key=str)


def test_run_on_empty_tables(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
