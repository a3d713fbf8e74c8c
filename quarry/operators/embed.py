"""Embedding: text -> float vector.

An *embedder* maps a DataFrame with a ``text`` column to the same rows plus
an ``embedding`` column.  The default is a hashed term-frequency embedder.
:func:`batch_embedder` wraps a Python batch model call
(``list[str] -> list[list[float]]``) as an iterator-of-batches Arrow UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

try:
    from _md5 import md5  # far less to set up for a short token
except ImportError:
    from hashlib import md5

from quarry.functions.text import is_blank, runs_of
from quarry.operators.model_calls import MAX_CHARS, MAX_TEXTS, Calls
from quarry.functions.vectors import EMBED_DIM, TOKEN_CHARS, hashed_embedding, vector_ok

#: A Column function.  Its attribute ``answers``, if there is one, does the same
#: to an iterator of lists of texts: lists of (vector, error).
Embedder = Callable[[Column], Column]

# The messages for texts that cannot be embedded and for wrong vectors.
EMPTY_TEXT = "ValueError: Cannot embed empty text"
INVALID_VECTOR = "RuntimeError: Invalid embedding response"


def native_hashed_embedder(dim: int = EMBED_DIM) -> Embedder:
    """Catalyst-only hashed embedder.  Exact, but Spark evaluates the
    per-token lambda interpretively, so it costs microseconds per token."""
    return lambda text: hashed_embedding(text, dim)


class _Buckets(dict):
    """Bucket of each token: first 8 hex digits of md5(token) mod dim."""

    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, token: str) -> int:
        bucket = int.from_bytes(md5(token.encode("utf-8")).digest()[:4], "big") % self.dim
        self[token] = bucket
        return bucket


#: Texts whose tokens are counted at once, and tokens whose buckets a worker keeps.
EMBED_TEXTS, KEPT_TOKENS = 256, 1 << 17
_kept: dict[int, _Buckets] = {}


def _hashed_matrix(texts: list[str | None], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Same definition as :func:`quarry.functions.vectors.hashed_embedding`:
    lower-case, split on non letters/digits, bucket = first 8 hex digits of
    md5(token) mod dim, L2-normalised float32; and which texts have a vector.
    A worker keeps the buckets of many tokens, so md5 runs seldom twice for one."""
    out, held = np.zeros((len(texts), dim), np.float32), np.zeros(len(texts), bool)
    for s in range(0, len(texts), EMBED_TEXTS):
        buckets = _kept.setdefault(dim, _Buckets(dim))
        if len(buckets) > KEPT_TOKENS:
            buckets.clear()
        tokens = runs_of(TOKEN_CHARS).of([(t or "").lower() for t in texts[s:s + EMBED_TEXTS]])
        places = np.fromiter(map(buckets.__getitem__, chain.from_iterable(tokens)), np.int64)
        row = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
        counts = np.bincount(row * dim + places, minlength=len(tokens) * dim).reshape(-1, dim)
        norm = np.sqrt((counts.astype(np.int64) ** 2).sum(1).astype(np.float64))
        full = norm > 0
        out[s:s + EMBED_TEXTS][full] = (counts[full] / norm[full, None]).astype(np.float32)
        held[s:s + EMBED_TEXTS] = full
    return out, held


def _hashed_vectors(texts: pd.Series, dim: int) -> pd.Series:
    vectors, held = _hashed_matrix(list(texts), dim)
    return pd.Series([v if h else None for v, h in zip(vectors, held)], dtype=object)


def hashed_embedder(dim: int = EMBED_DIM) -> Embedder:
    """Default offline embedder: hashed term frequencies, as an Arrow-batched
    UDF (the model stage of the plan; no shuffle, no per-row dispatch)."""

    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        vectors, held = _hashed_matrix(texts.to_pylist(), dim)
        ends = np.concatenate([[0], np.cumsum(held)]).astype(np.int32) * np.int32(dim)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors[held].ravel()), mask=pa.array(~held))

    def answers(batches: Iterator[list[str | None]]) -> Iterator[list[tuple]]:
        for texts in batches:
            yield [(v, None) for v in _hashed_vectors(texts, dim)]

    run.answers = answers
    return run


MAX_ATTEMPTS = 3
VECTOR_OR_ERROR = "struct<embedding:array<float>,error:string>"


def batch_embedder(call: Callable[[list[str]], list[list[float]]], attempts: int = MAX_ATTEMPTS, *,
                   max_texts: int = MAX_TEXTS, max_chars: int = MAX_CHARS) -> Embedder:
    """Wrap a batch embedding call.  Only texts that are not null reach it
    (``embed`` makes blank ones null), in bounded calls that are halved when
    they fail (see ``model_calls``); a text that fails alone is tried up to
    ``attempts`` times, then the failure is recorded in its row."""

    def answers(batches: Iterator[list[str | None]]) -> Iterator[list[tuple]]:
        calls = Calls(call, "vectors", max_texts, max_chars)
        for texts in batches:
            asked = [i for i, t in enumerate(texts) if t is not None]
            out: list[tuple] = [(None, None)] * len(texts)
            for i, answer in zip(asked, calls.settled([texts[i] for i in asked], attempts)):
                out[i] = answer
            yield out

    @pandas_udf(VECTOR_OR_ERROR)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for out in answers(batch.tolist() for batch in batches):
            yield pd.DataFrame({"embedding": pd.Series([v for v, _ in out], dtype=object), "error": pd.Series([e for _, e in out], dtype=object)})

    run.answers = answers
    return run


def embed(df: DataFrame, text_col: str = "text", embedder: Embedder | None = None,
          dim: int = EMBED_DIM) -> DataFrame:
    """Adds ``embedding`` and ``embed_error``.  Blank texts are made null
    before the embedder, which passes nulls on without a model call; a failed
    call and a missing or wrongly sized vector are errors of their row.

    The model runs in one projection; store the result before reading it more
    than once (see ``session.materialize``)."""
    embedder = embedder or hashed_embedder(dim)
    text = F.col(text_col)
    guarded = df.withColumn("_text", F.when(~is_blank(text), text))
    out = guarded.withColumn("_out", embedder(F.col("_text")))
    if isinstance(out.schema["_out"].dataType, T.StructType):
        vector, failed = F.col("_out.embedding"), F.col("_out.error")
    else:
        vector, failed = F.col("_out"), F.lit(None).cast("string")
    err = (F.when(F.col("_text").isNull(), F.lit(EMPTY_TEXT)).when(failed.isNotNull(), failed)
            .when(~vector_ok(vector, dim), F.lit(INVALID_VECTOR)))
    return out.withColumns({"embedding": F.when(F.col("_text").isNotNull(), vector), "embed_error": err}).drop("_text", "_out")
