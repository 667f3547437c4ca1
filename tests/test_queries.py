import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def _names():
    from cuemill.plans.oracles import ORACLES

    return sorted(ORACLES)


def _rows(table):
    cell = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((repr(tuple(cell(r[c]) for c in sorted(r))) for r in table.to_pylist()))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", _names())
def test_matches_sql(spark, duck, name):
    from cuemill.plans.oracles import ORACLES
    from cuemill.plans.queries import QUERIES

    got, want = QUERIES[name](spark, SF).toArrow(), duck.sql(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert _rows(got) == _rows(want)


def test_caption_normalize_entities(spark, tmp_path):
    """Entities cut short, unknown to the SQL, run together, or made by decoding."""
    import duckdb

    from cuemill.plans.oracles import ORACLES
    from cuemill.plans.queries import QUERIES

    texts = ["<p>ver&amp</p> x", "a&am&a&&quot b", "a &amp;quot; &amp;amp; b", "&copy;&middot;&quot;&amp;", "&copy2 &ampx; &lt;b&gt; &#38; &nbsp;", " &amp; ", "", None]
    spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").coalesce(1).write.parquet(path := str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    got, want = QUERIES["caption_normalize"](spark, str(tmp_path)).toArrow(), con.sql(ORACLES["caption_normalize"]).to_arrow_table()
    assert _rows(got) == _rows(want)


def test_registry():
    import __spark_entry__ as entry

    assert {*entry.oracle_sql()} <= {*entry.queries()}
