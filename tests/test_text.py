import pytest
from pyspark.sql import functions as F

from cuemill.functions import text as X
from cuemill.operators import abbr
from cuemill.sources.rules import RuleError, check, quota_plan


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("<i>Hello</i>&amp;  world", "Hello & world"), ("a &lt;b&gt; c", "a <b> c"), ("x&nbsp;y", "x y"), ("", ""), (None, None)],
)
def test_normalize_caption(spark, text, want):
    assert one(spark, X.normalize_caption, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("mRNAs and BRCA2", [("mRNAs", 0, 5, "mRNA"), ("BRCA2", 10, 15, "BRCA2")]),
        ("DNAs ER-positive", [("ER", 5, 7, "ER")]),
        ("COVID-19 in 2015, H1N1 3D", [("COVID", 0, 5, "COVID"), ("H1N1", 18, 22, "H1N1"), ("3D", 23, 25, "3D")]),
        ("éDNA DNA", [("DNA", 5, 8, "DNA")]),
        ("", []),
    ],
)
def test_candidates(spark, text, want):
    assert [tuple(r) for r in one(spark, X.abbreviation_candidates, text)] == want


@pytest.mark.parametrize(("text", "want"), [("[Music]: hi  there , ok", "Music hi there, ok"), ("a [b] : c !", "a b c!")])
def test_clean_text(spark, text, want):
    assert one(spark, X.clean_text, text) == want


@pytest.mark.parametrize(("text", "want"), [("mRNA/β", "mRNA"), ("...", "item"), ("a b", "a_b")])
def test_safe_name(spark, text, want):
    assert one(spark, X.safe_name, text) == want


def own_rules():
    kinds = [("DNA", "d n a", "spell_out", "high_conf"), ("mRNA", "m r n a", "camel_case", "high_conf"), ("CRISPR", "crisper", "lexicalized", "low_conf"), ("H5N1", "h five n one", "mixed_alnum", "low_conf")]
    return check([{"abbr": a, "canonical_reading": r, "pron_type": p, "confidence_tier": t, "rule_id": "", "variants": "", "notes": ""} for a, r, p, t in kinds])


def test_expand_readings(spark):
    got = one(spark, lambda c: X.expand_readings(c, abbr.match_rules(X.abbreviation_candidates(c), own_rules())), "mRNA and DNA")
    assert got == "m r n a and d n a"


def test_pron_types(spark):
    want = {"DNA": "spell_out", "mRNA": "camel_case", "H1N1": "mixed_alnum", "12": "other"}
    assert {k: one(spark, X.infer_pron_type, k) for k in want} == want


def test_entities_keep_the_first_surface(spark):
    assert one(spark, X.entities, "Baby Sequencing Project and NASA, Nasa Labs, THE baby Sequencing project NASA I WE") == ["Baby Sequencing Project", "NASA", "Nasa Labs"]


def test_seconds_and_clip(spark):
    assert one(spark, X.seconds, "01:02:03,500") == 3723.5
    assert one(spark, X.seconds, "02:03.25") == 123.25
    assert one(spark, lambda c: X.clip_name(c, F.lit(0.564), F.lit(28.258)), "155035") == "155035_000000564_000028258.wav"


def test_clips_are_named_by_the_times_of_the_record(spark):
    t = F.col("id")
    code = F.format_string("%02d:%02d:%02d.%03d", F.floor(t / 3600000), F.floor(t / 60000) % 60, F.floor(t / 1000) % 60, t % 1000)
    rows = spark.range(0, 7_200_000, 20).select("id", X.seconds(code).alias("s"))
    got = {r.id: (r.s, r.clip) for r in rows.select("id", "s", X.clip_name(F.lit("v"), F.col("s"), F.col("s")).alias("clip")).collect()}
    assert got[93480] == (60 + 33.48, "v_000093480_000093480.wav")
    assert [i for i, (s, clip) in got.items() if clip != f"v_{int(i / 1000 * 1000):09d}_{int(i / 1000 * 1000):09d}.wav"] == []
    assert any(int(s * 1000) != int(i / 1000 * 1000) for i, (s, clip) in got.items())  # unrounded sums would differ


def test_summarize(spark):
    assert one(spark, X.summarize_stderr, "a  b\nc") == "a b c"
    assert len(one(spark, X.summarize_stderr, "x" * 400)) == 300


GOOD = {"abbr": "AB", "canonical_reading": "a b", "pron_type": "spell_out", "confidence_tier": "high_conf", "rule_id": "r1", "variants": "ABs", "notes": ""}


@pytest.mark.parametrize("change", [{"abbr": ""}, {"canonical_reading": " "}, {"pron_type": "x"}, {"confidence_tier": "x"}])
def test_bad_rules(change):
    with pytest.raises(RuleError, match="row 2"):
        check([GOOD | change])


def test_rule_conflicts():
    with pytest.raises(RuleError, match="repeats"):
        check([GOOD, GOOD | {"rule_id": "r2", "variants": ""}])
    with pytest.raises(RuleError, match="belongs"):
        check([GOOD, GOOD | {"abbr": "CD", "rule_id": "r2"}])
    assert len(check([GOOD, GOOD | {"abbr": "CD"}])) == 2
    assert quota_plan(own_rules(), 2000) == ({"camel_case": 500, "lexicalized": 500, "mixed_alnum": 500, "spell_out": 500}, {"high_conf": 1000, "low_conf": 1000})
