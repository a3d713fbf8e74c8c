"""Prompt construction and strict validation of model output, as Catalyst
expressions over the VARIANT type (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import bind, strip

# The instruction texts sent with every article.  They must be
# identical to the reference's for the same model behaviour.
PROMPT_HEAD = """Analyze the following news article and return a JSON object with this exact structure:

{
  "summary": "3–5 sentence concise summary",
  "topics": ["topic1", "topic2", "topic3"]
}

Rules:
- Output ONLY JSON
- No markdown
- No trailing text
- Topics must be 3–7 short lowercase strings

Article title:
"""
PROMPT_TEXT_LABEL = "\n\nArticle text:\n"

# Topic count bounds of the annotation contract.
MIN_TOPICS = 3
MAX_TOPICS = 7


def build_prompt(title: Column, text: Column) -> Column:
    """Prompt for one article; a missing title or text renders as ``None``."""
    return strip(F.concat(F.lit(PROMPT_HEAD), F.coalesce(title, F.lit("None")),
                          F.lit(PROMPT_TEXT_LABEL), F.coalesce(text, F.lit("None"))))


def strict_json(raw: Column) -> Column:
    """VARIANT of ``raw`` when the whole string is exactly one JSON value,
    else null.  ``try_parse_json`` alone tolerates trailing text, so the value
    is also parsed inside an object and inside an array; both wrappers fail
    on any trailing or second value."""
    in_obj = F.try_parse_json(F.concat(F.lit('{"r":'), raw, F.lit("}")))
    in_arr = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    arr_ok = F.coalesce(F.size(F.try_variant_get(in_arr, "$", "array<variant>")) == 1, F.lit(False))
    return F.when(in_obj.isNotNull() & arr_ok, F.try_parse_json(raw))


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def validate_analysis(raw: Column) -> Column:
    """Struct ``(valid, error, summary, topics)`` for one raw response.

    Rules: the text is one JSON object; ``summary`` is a string that is not
    blank (stored stripped); ``topics`` is a list of strings which, after
    strip + lower, dropping empties and first-seen de-duplication, has 3..7
    items.  Unknown keys are ignored.  Every intermediate is bound once."""

    def parts(v: Column) -> Column:
        topics_v = F.try_variant_get(v, "$.topics", "array<variant>")
        topics_raw = F.transform(topics_v, lambda x: F.try_variant_get(x, "$", "string"))
        cleaned = F.array_distinct(F.filter(F.transform(topics_raw, lambda t: F.lower(strip(t))),
                                            lambda t: t != ""))
        summary_v = F.try_variant_get(v, "$.summary", "variant")
        return F.struct(
            v.isNull().alias("bad_json"),
            _vtype(v).alias("top"),
            summary_v.isNull().alias("no_summary"),
            _vtype(summary_v).alias("summary_t"),
            strip(F.try_variant_get(v, "$.summary", "string")).alias("summary"),
            topics_v.isNull().alias("no_topics"),
            F.forall(topics_v, lambda x: F.coalesce(_vtype(x) == "STRING", F.lit(False))).alias("all_str"),
            cleaned.alias("topics"),
        )

    def verdict(p: Column) -> Column:
        n = F.size(p["topics"])
        error = (F.when(raw.isNull(), F.lit("RuntimeError: no model output"))
                 .when(p["bad_json"], F.lit("ValueError: Invalid JSON from LLM"))
                 .when(~p["top"].startswith("OBJECT"), F.lit("ValidationError: output is not an object"))
                 .when(p["no_summary"], F.lit("ValidationError: summary: Field required"))
                 .when(p["summary_t"] != "STRING", F.lit("ValidationError: summary must be a string"))
                 .when(p["summary"] == "", F.lit("ValidationError: summary must not be empty"))
                 .when(p["no_topics"], F.lit("ValidationError: topics must be a list"))
                 .when(~p["all_str"], F.lit("ValidationError: topics must be strings"))
                 .when((n < MIN_TOPICS) | (n > MAX_TOPICS),
                       F.lit("ValidationError: topics must contain between 3 and 7 items")))
        return bind(error, lambda e: F.struct(
            e.isNull().alias("valid"), e.alias("error"),
            F.when(e.isNull(), p["summary"]).alias("summary"),
            F.when(e.isNull(), p["topics"]).alias("topics")))

    return bind(bind(strict_json(raw), parts), verdict)
