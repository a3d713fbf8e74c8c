"""Annotation: model responses as data, validated natively.

An *annotator* turns ``(key, prompt, title, text)`` rows into response rows
``(key, attempt, raw_text, call_error)``.  Two kinds are supported:

* a DataFrame -> DataFrame function (the default offline annotator below is
  one: word counts inside each row);
* a Python batch function ``list[str] -> list[str]`` (e.g. a remote model
  client) wrapped by :func:`batch_annotator`, which runs it in
  ``mapInPandas`` over Arrow batches with up to three attempts per row.

Validation of the raw text (strict JSON, types, topic cleaning) is always the
native :func:`quarry.functions.analysis.validate_analysis`.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.analysis import MAX_TOPICS, MIN_TOPICS, validate_analysis
from quarry.functions.text import runs_of, strip
from quarry.operators.model_calls import MAX_CHARS, MAX_TEXTS, Calls
from quarry.schemas import RESPONSE

# Fixed values of the default offline annotator (our stand-in for a remote
# model; it meets the output contract, not a model's quality).
DEFAULT_MODEL = "offline-extractive-1"
SUMMARY_RE = r"^[^.!?]*[.!?]*[^.!?]*[.!?]*[^.!?]*[.!?]*"   # first three sentences
TOPIC_TOKEN_RE = r"\p{L}{4,}"                                 # words of 4+ letters
TOPIC_CHARS, TOPIC_LETTERS = r"\p{L}", 4                      # the same, for one text after another
TOPIC_COUNT = 5
TOPIC_TEXTS = 64      # texts whose words are found at once
MAX_ATTEMPTS = 3

Annotator = Callable[[DataFrame], DataFrame]


def offline_summary(text):
    return strip(F.regexp_extract(text, SUMMARY_RE, 0))


def _most_frequent(counts: Counter) -> list[str]:
    """The ``TOPIC_COUNT`` most frequent words, ties by word; only words as
    frequent as the last of them are put in order."""
    least = sorted(counts.values())[-TOPIC_COUNT:][:1] or [0]
    return sorted((w for w, n in counts.items() if n >= least[0]), key=lambda w: (-counts[w], w))[:TOPIC_COUNT]


@F.arrow_udf(T.ArrayType(T.StringType()))
def _top_words(texts: pa.Array) -> pa.Array:
    """The most frequent topic words of each lower-cased text, ties by word."""
    out = []
    for s in range(0, len(texts), TOPIC_TEXTS):
        for words in runs_of(TOPIC_CHARS).of([t or "" for t in texts[s:s + TOPIC_TEXTS].to_pylist()]):
            out.append(_most_frequent(Counter([w for w in words if len(w) >= TOPIC_LETTERS])))
    return pa.array(out, pa.list_(pa.string()))


def offline_annotator(df: DataFrame) -> DataFrame:
    """Extractive annotation: summary = first three sentences; topics = the
    five most frequent words of four or more letters (ties by word).  A
    document is one row, so its words are counted inside the row: no exchange
    and no join, one Arrow stage."""
    raw = F.to_json(F.struct(offline_summary(F.col("text")).alias("summary"), _top_words(F.lower(F.col("text"))).alias("topics")))
    return df.select("key", F.lit(1).alias("attempt"), raw.alias("raw_text"), F.lit(None).cast("string").alias("call_error"))


def batch_annotator(call: Callable[[list[str]], list[str]], attempts: int = MAX_ATTEMPTS, *,
                    max_texts: int = MAX_TEXTS, max_chars: int = MAX_CHARS) -> Annotator:
    """Wrap a batch model call.  Prompts are sent in bounded calls; one that
    raises or gives another number of answers is halved down to single prompts
    (see ``model_calls``), so its failure is that of the prompts that cause it.
    A prompt that fails alone, or whose answer breaks the contract, is tried up
    to ``attempts`` times; every attempt is kept as a response row."""

    def run(batches):
        calls = Calls(call, "answers", max_texts, max_chars)
        for pdf in batches:
            keys, prompts = pdf["key"].tolist(), pdf["prompt"].tolist()
            pending, lone = list(range(len(keys))), set()
            for attempt in range(1, attempts + 1):
                if not pending:
                    break
                together = [i for i in pending if i not in lone]
                answers = {together[n]: (a, e) for n, a, e in calls.each([prompts[i] for i in together])}
                for i in lone & set(pending):
                    got, error = calls.once([prompts[i]])
                    answers[i] = (got[0] if error is None else None, error)
                lone |= {i for i, (_, e) in answers.items() if e is not None}
                yield pd.DataFrame({"key": [keys[i] for i in pending], "attempt": attempt,
                                    "raw_text": pd.Series([answers[i][0] for i in pending], dtype=object),
                                    "call_error": pd.Series([answers[i][1] for i in pending], dtype=object)})
                pending = [i for i in pending if not meets_contract(answers[i][0])]

    def annotate(df: DataFrame) -> DataFrame:
        return df.select("key", "prompt").mapInPandas(run, RESPONSE)

    return annotate


def replay_annotator(recorded: DataFrame) -> Annotator:
    """Serve recorded responses ``(key, attempt, raw_text, call_error)``
    for the keys asked for (a semi join, so only requested keys flow on)."""
    def annotate(df: DataFrame) -> DataFrame:
        return recorded.join(df.select("key"), "key", "left_semi")
    return annotate


def meets_contract(answer) -> bool:
    """The contract of ``validate_analysis`` for the worker's decision to try
    again: a JSON object, a summary that is not blank, and 3 to 7 different
    topics once stripped and lower-cased."""
    import json
    try:
        value = json.loads(answer)
    except (TypeError, ValueError):
        return False
    if not isinstance(value, dict):
        return False
    summary, topics = value.get("summary"), value.get("topics")
    if not (isinstance(summary, str) and summary.strip() and isinstance(topics, list) and all(isinstance(t, str) for t in topics)):
        return False
    return MIN_TOPICS <= len({t.strip().lower() for t in topics} - {""}) <= MAX_TOPICS


def validate_responses(responses: DataFrame) -> DataFrame:
    """``(key, attempt, valid, error, summary, topics)`` per response row.
    Validation runs once per row in its own projection (Catalyst keeps an
    expensive projection separate when its result is read several times)."""
    v = responses.select("key", "attempt", "call_error", validate_analysis(F.col("raw_text")).alias("v"))
    ok = F.col("v.valid") & F.col("call_error").isNull()
    return v.select("key", "attempt", ok.alias("valid"),
                    F.when(~ok, F.coalesce(F.col("call_error"), F.col("v.error"))).alias("error"),
                    F.col("v.summary").alias("summary"), F.col("v.topics").alias("topics"))


def first_valid_attempt(validated: DataFrame) -> DataFrame:
    """Per key: the first valid attempt's analysis; when no attempt is valid,
    the error of the last attempt.  Attempts after the first valid one are
    ignored, as a retry loop would never have made them."""
    ok_rank = F.when(F.col("valid"), F.col("attempt"))
    return (validated.groupBy("key")
            .agg(F.min_by(F.struct("summary", "topics"), ok_rank).alias("ok"),
                 F.min(ok_rank).alias("ok_attempt"),
                 F.max_by(F.col("error"), F.col("attempt")).alias("last_error"))
            .select("key", F.col("ok_attempt").isNotNull().alias("valid"),
                    F.col("ok_attempt").alias("attempt"),
                    F.when(F.col("ok_attempt").isNull(), F.col("last_error")).alias("error"),
                    F.col("ok.summary").alias("summary"), F.col("ok.topics").alias("topics")))
