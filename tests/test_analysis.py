"""Strict validation of model output: the outcome of each case is written
out by hand from the annotation contract (one JSON object, a summary that is
not blank, 3 to 7 different topics once stripped and lower-cased)."""

from pyspark.sql import functions as F

from quarry.functions.analysis import build_prompt, validate_analysis
from quarry.operators.annotate import meets_contract

XYZ = ["x", "y", "z"]
CASES = {
    '{"summary":"a","topics":["x","y","z"]}': ("a", XYZ),
    '{"summary":"a","topics":["x","y","z"]} trailing': None,
    '```json\n{"summary":"a","topics":["x","y","z"]}\n```': None,
    '{"summary":1,"topics":["x","y","z"]}': None,
    '{"summary":"a","topics":["x",1,"z"]}': None,
    '{"summary":"a","topics":["x",null,"z"]}': None,
    '{"summary":"  ","topics":["x","y","z"]}': None,
    '{"summary":"a","topics":["x","y"]}': None,
    '{"summary":"a","topics":["a","b","c","d","e","f","g"]}': ("a", ["a", "b", "c", "d", "e", "f", "g"]),
    '{"summary":"a","topics":["a","b","c","d","e","f","g","h"]}': None,
    '{"summary":"a","topics":["A"," a","b","B ","c"]}': ("a", ["a", "b", "c"]),
    '[{"summary":"a","topics":["x","y","z"]}]': None,
    "": None,
    '{"summary":"a","topics":["x","y","z"]}], x': None,
    '{"summary":"a","topics":["x","y","z"]}}, x': None,
    '{"summary":"a","topics":["x","y","z"]}{"a":1}': None,
    '{"topics":["x","y","z"]}': None,
    '{"summary":"a","topics":"xyz"}': None,
    ' {"summary":" é ","topics":["X","y","z",""],"extra":1} ': ("é", XYZ),
}


def test_cases(spark):
    rows = spark.createDataFrame([(c,) for c in CASES], "r string").select("r", validate_analysis(F.col("r")).alias("v")).collect()
    for r in rows:
        expected = CASES[r["r"]]
        assert r["v"]["valid"] == (expected is not None), r["r"]
        assert (r["v"]["error"] is None) == (expected is not None)
        if expected:
            assert (r["v"]["summary"], r["v"]["topics"]) == expected


def test_the_worker_agrees_with_the_validation():
    assert {c: meets_contract(c) for c in CASES} == {c: x is not None for c, x in CASES.items()}
    assert not meets_contract(None)


def test_prompt_renders_missing_title_as_none(spark):
    df = spark.createDataFrame([(None, "Body text.")], "title string, text string")
    p = df.select(build_prompt(F.col("title"), F.col("text")).alias("p")).first()["p"]
    assert p.startswith("Analyze the following news article")
    assert "Article title:\nNone\n\nArticle text:\nBody text." in p
    assert p == p.strip()
