"""Titles, character references and URL validity against hand-written
expectations (from the HTML and URL specifications, not from our patterns)."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.html import decode_entities, extract_text, extract_title
from quarry.functions.urls import url_is_valid

TITLES = {
    '<meta property="og:title" content="Don\'t panic"><title>x</title>': "Don't panic",
    "<meta property='og:title' content='Say \"yes\"'><title>x</title>": 'Say "yes"',
    '<meta content="Before the name" property="og:title">': "Before the name",
    "<meta content='It is \"so\"' property='og:title'>": 'It is "so"',
    '<meta name="d" content="Description"><meta property="og:title" content="Right">': "Right",
    '<meta property="og:image" content="i.png"><title>Only &amp; title</title>': "Only & title",
    '<meta property="og:title" content=""><title> Spaced </title>': "Spaced",
    "<h1>Just <b>a</b> heading</h1>": "Just a heading",
    "<p>none</p>": None,
}
REFERENCES = {
    "it&#8217;s &rsquo;so&rsquo; &mdash; caf&eacute;": "it’s ’so’ — café",
    "&#x2019;&#X1F600;&#0065;": "’😀A",
    "&amp;lt; stays &amp;amp;": "&lt; stays &amp;",
    "AT&T &unknown; &; & &#; &#x;": "AT&T &unknown; &; & &#; &#x;",
    "&#0;&#xD800;&#1114112;": "\ufffd\ufffd\ufffd",
    "&lt;b&gt;&quot;&apos;&nbsp;&copy;&Auml;&euro;": "<b>\"'\u00a0©Ä€",
    "plain": "plain",
}
VALID = ["http://example.com", "https://example.com:8080/a?b#c", "http://user:pw@h.example/", "http://[::1]:80/x", "http://127.0.0.1?q",
         "http://x:/", "HTTPS://EXAMPLE.COM/", "http://bücher.example/"]
INVALID = ["http://exa mple.com/", "http://:80/", "http://[bad/", "http://x:99999/", "http://x:65536", "ftp://x/", "http:///a", "//x/a", "x",
           "http://x:8a/", "http://a<b>/", "http://" + "a" * 2100]


def test_titles(spark):
    rows = spark.createDataFrame([(h,) for h in TITLES], "h string").select(extract_title(F.col("h"))).collect()
    assert [r[0] for r in rows] == list(TITLES.values())


def test_references(spark):
    rows = spark.createDataFrame([(h,) for h in REFERENCES], "h string").select(decode_entities(F.col("h"))).collect()
    assert [r[0] for r in rows] == list(REFERENCES.values())
    text = spark.createDataFrame([("<article><p>It&rsquo;s 5&#37; &hellip;</p></article>",)], "h string").select(extract_text(F.col("h"))).first()[0]
    assert text == "It’s 5% …"


@pytest.mark.parametrize("urls,expected", [(VALID, True), (INVALID, False)])
def test_validity(spark, urls, expected):
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", url_is_valid(F.col("u")).alias("v")).collect()
    assert [r.u for r in rows if r.v is not expected] == []
