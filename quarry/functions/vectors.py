"""Vector-document expressions: embedding text, scalar metadata, previews,
and the native hashed term-frequency embedder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import bind, strip

# Metadata summary cap, preview length and marker, score format.
SUMMARY_CAP = 2000
PREVIEW_CHARS = 500
PREVIEW_MARK = "..."
SCORE_FORMAT = "%.4f"
PART_SEP = "\n\n"
TOPIC_SEP = ", "
TOPICS_LABEL = "Topics: "

# Fixed values of the default offline embedder: 64 hashed buckets.
EMBED_DIM = 64
TOKEN_SPLIT_RE = r"[^\p{L}\p{N}]+"
TOKEN_CHARS = r"[\p{L}\p{N}]"
_CODE_BASE = 48   # bucket i is encoded as the character chr(48 + i)


def _truthy_str(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def topics_size(topics: Column) -> Column:
    return F.when(topics.isNull(), F.lit(0)).otherwise(F.size(topics))


def embedding_text(title: Column, summary: Column, topics: Column) -> Column:
    """Title, summary and ``Topics: a, b`` joined by blank lines; each part
    only when present (a whitespace-only title still adds an empty part)."""
    return F.concat_ws(
        PART_SEP,
        F.when(_truthy_str(title), strip(title)),
        F.when(_truthy_str(summary), strip(summary)),
        F.when(topics_size(topics) > 0, F.concat(F.lit(TOPICS_LABEL), F.array_join(topics, TOPIC_SEP))),
    )


def vector_metadata(url: Column, title: Column, source: Column, summary: Column, topics: Column) -> Column:
    """Scalar-only metadata stored with each vector."""
    return F.struct(
        url.alias("url"),
        F.coalesce(title, F.lit("")).alias("title"),
        F.coalesce(source, F.lit("")).alias("source"),
        F.substring(F.coalesce(summary, F.lit("")), 1, SUMMARY_CAP).alias("summary"),
        F.coalesce(F.array_join(topics, TOPIC_SEP), F.lit("")).alias("topics"),
        topics_size(topics).cast("int").alias("topic_count"),
    )


def preview(document: Column) -> Column:
    """Document shortened for display."""
    return F.when(F.length(document) > PREVIEW_CHARS,
                  F.concat(F.substring(document, 1, PREVIEW_CHARS), F.lit(PREVIEW_MARK))).otherwise(document)


def score_text(score: Column) -> Column:
    return F.format_string(SCORE_FORMAT, score)


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT_RE), lambda t: t != "")


def bucket_counts(text: Column, dim: int = EMBED_DIM) -> Column:
    """Term counts hashed into ``dim`` buckets: bucket = first 8 hex digits of
    md5(token) mod dim.  Each token becomes one character coding its bucket,
    and each bucket is counted with a native string replace, so the work per
    document is linear in its tokens (no per-bucket scan of the token list)."""
    if not 1 <= dim <= 200:
        raise ValueError("dim must be in 1..200")
    codes = F.array_join(F.transform(tokens(text), lambda t: F.chr(
        F.lit(_CODE_BASE) + F.pmod(F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint"), F.lit(dim)))), "")
    return bind(codes, lambda c: F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.length(c) - F.length(F.replace(c, F.chr(F.lit(_CODE_BASE) + i), F.lit("")))))


def l2_normalize(counts: Column) -> Column:
    """Unit-length float vector; null when all counts are zero."""
    def body(cs):
        sumsq = F.aggregate(cs, F.lit(0).cast("bigint"), lambda a, c: a + c.cast("bigint") * c.cast("bigint"))
        return bind(F.sqrt(sumsq.cast("double")), lambda norm: F.when(
            norm > 0, F.transform(cs, lambda c: (c.cast("double") / norm).cast("float"))))
    return bind(counts, body)


def hashed_embedding(text: Column, dim: int = EMBED_DIM) -> Column:
    return l2_normalize(bucket_counts(text, dim))


def vector_ok(vec: Column, dim: int = EMBED_DIM) -> Column:
    """Every document needs exactly one vector of the expected size."""
    return F.coalesce(vec.isNotNull() & (F.size(vec) == dim), F.lit(False))


def flatten_metadata(meta: Column, schema) -> Column:
    """Scalar-only copy of a struct: lists become ``", "``-joined text,
    nested structs and maps become JSON text, scalars stay as they are."""
    from pyspark.sql import types as T
    fields = []
    for f in schema.fields:
        c = meta[f.name]
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), TOPIC_SEP)
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            c = F.to_json(c)
        fields.append(c.alias(f.name))
    return F.struct(*fields)
