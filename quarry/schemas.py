"""Record schemas, declared once.  Reads always use these; never inference."""

from pyspark.sql import types as T

# Raw article: one record per input URL, failures included.
RAW = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    # ISO-8601 UTC text, as written by the run (a parameter, never now()).
    T.StructField("fetched_at", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("chars", T.IntegerType()),
])

RAW_FIELDS = [f.name for f in RAW.fields]

# Enriched article: raw columns plus the validated annotation.
ENRICHED = T.StructType(RAW.fields + [
    T.StructField("summary", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("llm_model", T.StringType()),
])

ENRICHED_FIELDS = [f.name for f in ENRICHED.fields]

# Scalar metadata stored next to every vector.
VECTOR_METADATA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("topics", T.StringType()),
    T.StructField("topic_count", T.IntegerType()),
])

VECTOR_DOC = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("metadata", VECTOR_METADATA),
])

# Rows of a vector collection (Parquet).
VECTOR_ROW = T.StructType(VECTOR_DOC.fields + [
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

# Search hit; query_id identifies the query inside a batch.
HIT = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("id", T.StringType()),
    T.StructField("document", T.StringType()),
    T.StructField("metadata", VECTOR_METADATA),
])

# Fetched page snapshot: what an HTTP fetch of one URL returned.
PAGE_SNAPSHOT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("final_url", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("fetch_error", T.StringType()),
])

# Model responses as data: one row per (key, attempt).
RESPONSE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("call_error", T.StringType()),
])
