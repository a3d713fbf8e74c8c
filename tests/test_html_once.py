"""Each step of the extraction is in the expression once: a step that is read
twice (for its test and its value) would run the whole chain before it again."""

import re

from pyspark.sql import functions as F

from quarry.functions import html as H


def written(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_text_steps_are_evaluated_once(spark):
    plan = written(spark.createDataFrame([("<p>a</p>",)], "html string").select(H.extract_text(F.col("html")).alias("t")))
    for step in (H.COMMENT_RE, H.BREAK_RE, H.TAG_RE, *map(H.container_re, H.CONTAINER_TAGS)):
        assert plan.count(step) == 1, step


def test_title_steps_are_evaluated_once(spark):
    plan = written(spark.createDataFrame([("<p>a</p>",)], "html string").select(H.extract_title(F.col("html")).alias("t")))
    for step in (*H.OG_TITLE_RES, H.TITLE_RE, H.H1_RE):
        assert plan.count(step) == 1, step


def test_boilerplate_patterns_match_alike(spark):
    pages = ["<nav>a</nav>b", "<nav><header>a</nav>b</header>c", "<NAV\nx='1'>a</nav >b<style>c", "<navy>a</navy><nav", "<form><table>a</form></table>",
             "a<script>if (a<b) '</p>'</script>b<aside/>c</aside>", "<<nav>>a</nav>>", ""]
    rows = spark.createDataFrame([(p,) for p in pages], "h string").select(
        "h", *[F.regexp_replace("h", F.lit(r), "-").alias(n) for n, r in (("old", H.BOILERPLATE_RE), ("new", H.BOILERPLATE_AT_TAG_RE))]).collect()
    for r in rows:
        assert r["new"] == r["old"] == re.sub(H.BOILERPLATE_RE, "-", r["h"])
