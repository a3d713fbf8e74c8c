"""Scrape records: one audit row per URL, success or failure.

Input rows carry the URL key and the fetched snapshot columns
(``final_url, http_status, content_type, html, fetch_error`` and
``snap_found``).  Output rows follow the RAW schema.  Everything is one
projection of native expressions; the extracted text is computed once in a
child projection and referenced by the status, text and length columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.html import char_count, extract_text, extract_title
from quarry.functions.urls import source_domain, url_is_valid
from quarry.schemas import RAW_FIELDS

# Failure messages of the audit record.
EMPTY_HTML = "Empty HTML response"
TOO_SHORT = "Extraction too short (<{n} chars)"
INVALID_URL = "invalid url"
NO_SNAPSHOT = "ConnectError: no page snapshot for URL"


def scrape_records(fetched: DataFrame, min_chars: int, run_ts: str,
                   key_col: str = "url_key", keep: tuple[str, ...] = ("ord",)) -> DataFrame:
    """RAW records for fetched URLs (plus the ``keep`` columns)."""
    valid = url_is_valid(F.col(key_col))
    found = F.coalesce(F.col("snap_found"), F.lit(False))
    fetch_ok = valid & found & F.col("fetch_error").isNull()
    has_html = fetch_ok & (F.coalesce(F.col("html"), F.lit("")) != "")
    stage1 = fetched.select(
        *[F.col(c) for c in keep], F.col(key_col).alias("url"),
        fetch_ok.alias("_fetch_ok"), has_html.alias("_has_html"),
        F.col("fetch_error"), valid.alias("_valid"), found.alias("_found"),
        F.when(fetch_ok, F.col("http_status")).alias("http_status"),
        F.when(fetch_ok, F.col("content_type")).alias("content_type"),
        F.when(has_html, source_domain(F.col("final_url"))).alias("source"),
        F.when(has_html, extract_title(F.col("html"))).alias("title"),
        F.when(has_html, extract_text(F.col("html"))).alias("_text"),
    )
    chars = char_count(F.col("_text"))
    long_enough = chars >= F.lit(min_chars)
    error = (F.when(~F.col("_valid"), F.lit(INVALID_URL))
              .when(~F.col("_found"), F.lit("http error: " + NO_SNAPSHOT))
              .when(F.col("fetch_error").isNotNull(), F.concat(F.lit("http error: "), F.col("fetch_error")))
              .when(~F.col("_has_html"), F.lit(EMPTY_HTML))
              .when(~long_enough, F.lit(TOO_SHORT.format(n=min_chars))))
    out = stage1.select(
        *[F.col(c) for c in keep],
        F.col("url"), F.col("source"), F.col("title"),
        F.when(F.col("_has_html") & long_enough, F.col("_text")).alias("text"),
        F.lit(run_ts).alias("fetched_at"),
        F.when(error.isNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
        error.alias("error"),
        F.col("http_status").cast("int").alias("http_status"),
        F.col("content_type"),
        F.when(F.col("_has_html"), chars).otherwise(F.lit(0)).cast("int").alias("chars"),
    )
    return out.select(*[F.col(c) for c in keep], *RAW_FIELDS)
