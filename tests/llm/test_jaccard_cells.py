import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from cuemill.llm import jaccard


def packed_cell(sets, per, twice):
    """n-grams of so many sets, and a cell's table of them, in rows of up to 300 sets; `twice` are there a second time."""
    rng, rows = np.random.default_rng(5), []
    grams = np.sort([rng.choice(10 * per, per, replace=False) for _ in range(sets)], axis=1).astype(np.uint64) << np.uint64(20)
    ids = np.concatenate([np.arange(sets), twice]).astype(np.int64)
    for part in np.array_split(ids, -(-len(ids) // 300)):
        tail = np.ascontiguousarray(grams[part].ravel().view(np.uint8).reshape(-1, 8)[:, :5])
        n = np.full(len(part), per, np.uint32).tobytes()
        rows.append((0, part.tobytes(), n, n, tail.tobytes()))
    kinds = (pa.int32(), *[pa.binary()] * 4)
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["cell", "classes", "sizes", "counts", "grams"])
    return grams, pa.concat_tables([table.slice(1), table.slice(0, 1), table.slice(0, 0)])


@pytest.mark.parametrize("few", [False, True])
def test_cell_holds_each_class_once_in_order(monkeypatch, few):
    if few:
        monkeypatch.setattr(jaccard, "OWNERS", 0)
    grams, table = packed_cell(700, 30, np.arange(0, 700, 10))
    cls, size, gram, owner = jaccard._cell(table)
    assert (gram[1:] >= gram[:-1]).all() and (size == 30).all()
    assert sorted(zip(gram.tolist(), cls[owner].tolist(), strict=True)) == sorted((g, c) for c, row in enumerate(grams.tolist()) for g in row)


def test_cell_of_nothing():
    _, table = packed_cell(2, 3, [])
    cls, size, gram, owner = jaccard._cell(table.slice(0, 0))
    assert len(cls) == len(size) == len(gram) == len(owner) == 0


def test_cell_memory():
    _, table = packed_cell(3000, 200, [])
    tracemalloc.start()
    try:
        _, _, gram, _ = jaccard._cell(table)
        assert tracemalloc.get_traced_memory()[1] < 20 * len(gram)
    finally:
        tracemalloc.stop()
