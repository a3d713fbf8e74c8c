"""Registered workloads: each callable takes ``(spark, table_dir)`` and
returns a DataFrame over the whole given tables (or data derived from them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.html import char_count, extract_text, extract_title
from quarry.functions.urls import source_domain, url_is_valid, url_key
from quarry.operators.dedup import first_wins, seen_keys, url_list
from quarry.operators.incremental import flag_existing, only_new
from quarry.operators.knn import knn, knn_one
from quarry.operators.scrape import scrape_records
from quarry.plans.scrape import keyed_urls, scrape, scrape_each
from quarry.sources import derived as D, keyed
from quarry.sources.pages import fetch, page_snapshots
from quarry.sources.tables import files_of, load
from quarry.functions.analysis import build_prompt as _build_prompt, strict_json
from quarry.operators.annotate import (batch_annotator, first_valid_attempt as _first_valid,
                                       offline_annotator, validate_responses)
from quarry.plans.analyze import analyze as _analyze, annotate_records, candidates
from quarry.plans.analyze import eligible_for_analysis as _eligible
from quarry.functions.text import is_blank as _is_blank
from quarry.functions.vectors import (EMBED_DIM, flatten_metadata,
                                      preview, score_text, tokens, vector_ok)
from quarry.operators.embed import EMPTY_TEXT
from quarry.plans.index import eligible_for_index as _elig_index, index as _index
from quarry.plans.index import vector_documents
from quarry.plans.search import search as _search
from quarry.operators.dedup import latest_matching
from quarry.operators.incremental import append as _append
from quarry.plans.ingest import ingest as _ingest
from quarry.schemas import RAW as _RAW, VECTOR_ROW as _VROW
from quarry.session import scratch_path
from quarry.sources.jsonl import read_jsonl, valid_rows, write_jsonl
from quarry.sources.urls import read_url_lines
from quarry.sources.vectors import append_vectors, read_vectors
from quarry.streaming import ingest as _stream

RUN_TS = D.RUN_TS
W: dict = {}


def register(name):
    def deco(fn):
        W[name] = fn
        return fn
    return deco


# ------------------------------------------------------------ vector search

@register("knn_batch")
def knn_batch(spark: SparkSession, d: str) -> DataFrame:
    """Every vector of the collection as a query, top 5 by (score, id)."""
    emb = load(spark, d, "embeddings")
    return knn(emb, emb, 5, dim=EMBED_DIM, id_col="vec_id", query_id_col="vec_id")


@register("knn_single")
def knn_single(spark: SparkSession, d: str) -> DataFrame:
    """One query vector (element-wise maximum of the whole collection, an
    exact aggregate), top 5."""
    emb = load(spark, d, "embeddings")
    per_dim = emb.select(F.posexplode("embedding").alias("pos", "x")).groupBy("pos").agg(F.max("x").alias("x"))
    query = [r["x"] for r in per_dim.orderBy("pos").collect()]   # one number per dimension
    return knn_one(emb, query, 5, id_col="vec_id").select("rank", "score", F.col("id").alias("vec_id"))


# ------------------------------------------------------------ URLs and lists

def _keyed(spark, d, limit=None):
    return keyed_urls(D.url_lines(spark, d), limit)


@register("url_list_scan")
def url_list_scan(spark, d):
    return url_list(D.url_lines(spark, d))


@register("normalize_url")
def normalize_url(spark, d):
    return D.url_lines(spark, d).select("ord", "line", url_key(F.col("line")).alias("url_key"))


@register("source_domain")
def source_domain_q(spark, d):
    return load(spark, d, "pages").select("page_id", "url", source_domain(F.col("url")).alias("source"))


@register("url_validity")
def url_validity(spark, d):
    k = D.url_lines(spark, d).select("ord", url_key(F.col("line")).alias("url_key"))
    return k.select("ord", "url_key", url_is_valid(F.col("url_key")).alias("valid"))


@register("seen_keys")
def seen_keys_q(spark, d):
    return seen_keys(D.raw_prior(spark, d))


@register("dedup_first")
def dedup_first(spark, d):
    return first_wins(_keyed(spark, d), "url_key", "ord").select("url_key", "ord", "url")


@register("contains_url")
def contains_url(spark, d):
    k = _keyed(spark, d).select("ord", "url_key")
    return flag_existing(k, seen_keys(D.raw_prior(spark, d)), "url_key", "present") \
        .select("ord", "url_key", "present")


@register("scrape_limit")
def scrape_limit(spark, d):
    return _keyed(spark, d, limit=100).select("ord", "url", "url_key")


@register("scrape_incremental")
def scrape_incremental(spark, d):
    first = _keyed(spark, d).groupBy("url_key").agg(F.min("ord").alias("ord"))
    return only_new(first, seen_keys(D.raw_prior(spark, d)), "url_key")


# ------------------------------------------------------------ pages / extraction

def _snapshots(spark, d):
    return page_snapshots(D.snapshot_rows(spark, d))


@register("page_scan")
def page_scan(spark, d):
    return _snapshots(spark, d)


@register("extract_title")
def extract_title_q(spark, d):
    return load(spark, d, "pages").select("page_id", extract_title(F.col("html")).alias("title"))


@register("extract_text")
def extract_text_q(spark, d):
    return load(spark, d, "pages").select("page_id", extract_text(F.col("html")).alias("text"))


@register("text_length")
def text_length(spark, d):
    return load(spark, d, "pages").select("page_id", char_count(extract_text(F.col("html"))).alias("chars"))


@register("min_chars_gate")
def min_chars_gate(spark, d):
    x = load(spark, d, "pages").select("page_id", extract_text(F.col("html")).alias("t"))
    x = x.select("page_id", "t", char_count(F.col("t")).alias("chars"))
    gates = [x.select("page_id", F.lit(n).alias("min_chars"),
                      F.when(F.col("chars") >= n, F.col("t")).alias("text"), "chars") for n in (300, 500)]
    return gates[0].unionByName(gates[1])


@register("scrape_records")
def scrape_records_q(spark, d):
    todo = _keyed(spark, d).groupBy("url_key").agg(F.min("ord").alias("ord"))
    return scrape_records(fetch(todo, D.snapshot_rows(spark, d)), 500, RUN_TS)


def _scrape_run(spark, d):
    return scrape(D.url_lines(spark, d), D.snapshot_rows(spark, d), D.raw_prior(spark, d),
                  min_chars=500, run_ts=RUN_TS)


@register("scrape_run")
def scrape_run(spark, d):
    return _scrape_run(spark, d).records


@register("scrape_summary")
def scrape_summary(spark, d):
    return _scrape_run(spark, d).summary


@register("scrape_single")
def scrape_single(spark, d):
    urls = url_list(D.url_lines(spark, d))
    return scrape_each(urls, D.snapshot_rows(spark, d), D.raw_prior(spark, d), min_chars=300, run_ts=RUN_TS)


# ------------------------------------------------------------ annotation


def _joined(col):
    return F.array_join(col, ", ")


def _enriched_out(df):
    """ENRICHED records with topics shown joined (", "), as stored in vector
    metadata; arrays are compared through this text form."""
    return df.withColumn("topics", _joined(F.col("topics")))


def _responses(spark, d):
    return D.responses(spark, d).select(F.col("doc_id").alias("key"), "attempt", "raw_text",
                                        F.lit(None).cast("string").alias("call_error"))


@register("build_prompt")
def build_prompt_q(spark, d):
    raw = D.raw_docs(spark, d)
    return raw.select("ord", _build_prompt(F.col("title"), F.col("text")).alias("prompt"))


@register("parse_response")
def parse_response(spark, d):
    r = D.responses(spark, d)
    return r.select("doc_id", "attempt", strict_json(F.col("raw_text")).isNotNull().alias("json_ok"))


@register("validate_response")
def validate_response(spark, d):
    v = validate_responses(_responses(spark, d))
    return v.select(F.col("key").alias("doc_id"), "attempt", "valid", "error", "summary")


@register("clean_topics")
def clean_topics(spark, d):
    v = validate_responses(_responses(spark, d)).where("valid")
    return v.select(F.col("key").alias("doc_id"), "attempt", F.size("topics").alias("n_topics"),
                    _joined(F.col("topics")).alias("topics"))


@register("first_valid_attempt")
def first_valid_attempt_q(spark, d):
    o = _first_valid(validate_responses(_responses(spark, d)))
    return o.select(F.col("key").alias("doc_id"), "valid", "attempt", "error", "summary",
                    _joined(F.col("topics")).alias("topics"))


@register("annotate_batch")
def annotate_batch(spark, d):
    docs = load(spark, d, "documents").select(F.col("doc_id").alias("key"), "text")
    o = _first_valid(validate_responses(offline_annotator(docs)))
    return o.select(F.col("key").alias("doc_id"), "valid", "error", "summary",
                    _joined(F.col("topics")).alias("topics"))


REFUSED_LENGTHS, REFUSED_LENGTH = 50, 7


@register("annotate_isolated")
def annotate_isolated(spark, d):
    """Every document through a batch model that raises whenever a call holds
    a text of certain lengths: only those documents fail, after three tries."""
    def model(prompts):
        if any(len(p) % REFUSED_LENGTHS == REFUSED_LENGTH for p in prompts):
            raise RuntimeError("refused")
        return [f'{{"summary": "{len(p)} characters", "topics": ["a", "b", "c"]}}' for p in prompts]

    docs = load(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), F.coalesce("text", F.lit("")).alias("prompt"))
    o = _first_valid(validate_responses(batch_annotator(model)(docs)))
    return o.select(F.col("key").cast("long").alias("doc_id"), "valid", "attempt", "error", "summary", _joined(F.col("topics")).alias("topics"))


@register("embed_isolated")
def embed_isolated(spark, d):
    """Every document through a batch embedder that takes 40 texts at most and
    raises for texts of certain lengths: only those documents fail."""
    from quarry.operators.embed import batch_embedder, embed as _embed

    def model(texts):
        if len(texts) > 40 or any(len(t) % REFUSED_LENGTHS == REFUSED_LENGTH for t in texts):
            raise RuntimeError("refused")
        return [[float(len(t) % 11)] * EMBED_DIM for t in texts]

    docs = load(spark, d, "documents").select("doc_id", "text")
    return _embed(docs, "text", batch_embedder(model)).select("doc_id", _emb_sum(F.col("embedding")).alias("emb_sum"), "embed_error")


@register("index_retry")
def index_retry(spark, d):
    """Index of records that share ids (one id for each source), with an
    embedder that refuses texts of certain lengths: the records of an id are
    tried in order up to the first success."""
    from quarry.operators.embed import batch_embedder

    def model(texts):
        if any(len(t) % 40 for t in texts):
            raise RuntimeError("refused")
        return [[float(len(t) % 11)] * EMBED_DIM for t in texts]

    rec = load(spark, d, "documents").select(
        F.col("doc_id").alias("ord"), F.coalesce("source", F.lit("")).alias("url"), F.lit(None).cast("string").alias("title"),
        F.lit("").alias("source"), F.coalesce("text", F.lit("")).alias("summary"), F.array().cast("array<string>").alias("topics"),
        F.lit("ok").alias("status"))
    rows = _index(rec, embedder=batch_embedder(model)).rows
    return rows.select("ord", "id", "status", "error", _emb_sum(F.col("embedding")).alias("emb_sum"))


@register("eligible_for_analysis")
def eligible_for_analysis(spark, d):
    return _eligible(D.raw_docs(spark, d)).select("ord", "url")


@register("analyze_incremental")
def analyze_incremental(spark, d):
    _, firsts = candidates(D.raw_docs(spark, d), D.enriched_prior(spark, d))
    return firsts.select("url_key", "ord")


@register("enrich")
def enrich(spark, d):
    _, firsts = candidates(D.raw_docs(spark, d), None)
    return _enriched_out(annotate_records(firsts))


@register("enrich_failures")
def enrich_failures(spark, d):
    """Failure records (P17) with recorded model responses replayed as the
    annotator: keys whose three attempts all failed validation."""
    from quarry.operators.annotate import replay_annotator
    recorded = D.responses(spark, d).select(
        F.concat(F.lit(D.DOC_URL_PREFIX), F.col("doc_id").cast("string")).alias("key"),
        "attempt", "raw_text", F.lit(None).cast("string").alias("call_error"))
    _, firsts = candidates(D.raw_docs(spark, d), None)
    rec = annotate_records(firsts, replay_annotator(recorded), model="replayed")
    return rec.where(F.col("status") == "failed").select("ord", "url", "status", "error", "summary",
                                                          _joined(F.col("topics")).alias("topics"),
                                                          "llm_model")


def _analyze_run(spark, d, limit=None):
    return _analyze(D.raw_docs(spark, d), D.enriched_prior(spark, d), limit=limit)


@register("analyze_run")
def analyze_run(spark, d):
    return _enriched_out(_analyze_run(spark, d).records)


@register("analyze_summary")
def analyze_summary(spark, d):
    return _analyze_run(spark, d).summary


@register("analyze_limit")
def analyze_limit(spark, d):
    return _enriched_out(_analyze_run(spark, d, limit=100).records)


@register("success_limit")
def success_limit(spark, d):
    from quarry.operators.limits import until_successes
    labels = load(spark, d, "labels").select("doc_id", "quality", F.col("doc_id").alias("ord"))
    return until_successes(labels, 100, F.col("quality") == 1).select("doc_id", "quality")


# ------------------------------------------------------------ vectors


def _emb_sum(col):
    return F.aggregate(col, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double"))


def _enriched_all(spark, d):
    """The enriched table as the analyse step stores it (materialised once;
    the index step reads it several times).  So are the first records of the
    keys, which the annotator and the join with its answers both read."""
    from quarry.session import materialize
    _, firsts = candidates(D.raw_docs(spark, d), None)
    return materialize(annotate_records(materialize(firsts)))


def _meta_cols(m="metadata"):
    return [F.col(f"{m}.{c}").alias(c) for c in ("url", "title", "source", "summary", "topics", "topic_count")]


@register("embedding_text")
def embedding_text_q(spark, d):
    return vector_documents(_enriched_all(spark, d)).select("ord", "id", "text")


@register("vector_document")
def vector_document_q(spark, d):
    return vector_documents(_enriched_all(spark, d)).select("ord", "id", "text", *_meta_cols())


@register("flatten_metadata")
def flatten_metadata_q(spark, d):
    e = _enriched_all(spark, d)
    s = e.select("ord", F.struct("url", "title", "topics", "chars", "status").alias("m"))
    flat = flatten_metadata(F.col("m"), s.schema["m"].dataType)
    return s.select("ord", flat.alias("f")).select("ord", "f.*")


@register("result_preview")
def result_preview(spark, d):
    docs = load(spark, d, "documents")
    return docs.select("doc_id", preview(F.col("text")).alias("preview"),
                       score_text(F.col("n_chars").cast("double") / F.lit(7.0)).alias("score_text"))


@register("embedding_guard")
def embedding_guard(spark, d):
    v = vector_documents(_enriched_all(spark, d))
    return v.select("ord", "id", _is_blank(F.col("text")).alias("blank"),
                    F.when(_is_blank(F.col("text")), F.lit(EMPTY_TEXT)).alias("error"))


@register("vector_validity")
def vector_validity(spark, d):
    emb = load(spark, d, "embeddings")
    return emb.select("vec_id", vector_ok(F.col("embedding")).alias("ok"))


@register("embed_batch")
def embed_batch(spark, d):
    from quarry.operators.embed import embed as _embed
    docs = load(spark, d, "documents").select("doc_id", "text")
    x = _embed(docs, "text").select("doc_id", F.size(tokens(F.col("text"))).alias("n_tokens"),
                                     _emb_sum(F.col("embedding")).alias("emb_sum"), "embed_error")
    return x


@register("eligible_for_index")
def eligible_for_index_q(spark, d):
    return _elig_index(_enriched_all(spark, d)).select("ord", "url")


@register("index_incremental")
def index_incremental(spark, d):
    docs = vector_documents(_elig_index(_enriched_all(spark, d)))
    firsts = first_wins(docs.where(~_is_blank(F.col("text"))), "id", "ord")
    return only_new(firsts, D.vector_prior(spark, d), "id").select("id", "ord")


def _index_run(spark, d, prior=True, limit=None):
    return _index(_enriched_all(spark, d), D.vector_prior(spark, d) if prior else None, limit=limit)


def _vector_rows_out(rows):
    return rows.select("ord", "id", "text", "status", "error", *_meta_cols(), _emb_sum(F.col("embedding")).alias("emb_sum"))


@register("index_run")
def index_run(spark, d):
    return _vector_rows_out(_index_run(spark, d).rows)


@register("index_summary")
def index_summary(spark, d):
    return _index_run(spark, d).summary


@register("index_limit")
def index_limit(spark, d):
    return _vector_rows_out(_index_run(spark, d, limit=100).rows)


def _queries(spark, d):
    return D.raw_docs(spark, d).select(F.col("ord").alias("query_id"), F.col("title").alias("query"))


@register("query_guard")
def query_guard(spark, d):
    q = _queries(spark, d)
    return q.where(_is_blank(F.col("query"))).select("query_id", F.lit("ValueError: Query must not be empty").alias("error"))


def _search_run(spark, d):
    """Index the collection into a Parquet vector table (as E3 does), then
    search it with every document title as a query."""
    from quarry.session import scratch_path
    from quarry.sources.vectors import append_vectors, read_vectors
    path = scratch_path(spark, "index")
    append_vectors(_index_run(spark, d, prior=False).rows.where(F.col("status") == "ok"), path)
    return _search(read_vectors(spark, path), _queries(spark, d), 5)


@register("search_run")
def search_run(spark, d):
    hits = _search_run(spark, d).hits
    return hits.select("query_id", "rank", "score", "id", "score_text", "preview",
                       F.col("metadata.title").alias("title"), F.col("metadata.topics").alias("topics"))


# ------------------------------------------------------------ ingest, lookups, unions


@register("latest_ok")
def latest_ok(spark, d):
    v = D.versions(spark, d).withColumn("url_key", url_key(F.col("url")))
    pred = (F.col("status") == "ok") & ~_is_blank(F.col("text"))
    return latest_matching(v, "url_key", pred).select("url_key", "ord", "text")


@register("classify_outcome")
def classify_outcome(spark, d):
    """Outcome of every listed URL in a scrape run: new_ok, new_failed,
    skipped_existing (scraped earlier) or duplicate (earlier in the list)."""
    keyed = _keyed(spark, d).select("ord", "url_key")
    run = _scrape_run(spark, d).records.select("ord", F.col("status").alias("new_status"))
    prior = seen_keys(D.raw_prior(spark, d))
    x = flag_existing(keyed, prior, "url_key", "in_prior").join(run, "ord", "left")
    outcome = (F.when(F.col("new_status") == "ok", "new_ok")
                .when(F.col("new_status") == "failed", "new_failed")
                .when(F.col("in_prior"), "skipped_existing")
                .otherwise("duplicate"))
    return x.select("ord", "url_key", outcome.alias("outcome"))


@register("append_union")
def append_union(spark, d):
    prior = D.raw_prior(spark, d).select("ord", "url", "status")
    new = _scrape_run(spark, d).records.select((F.col("ord") + F.lit(1 << 40)).alias("ord"), "url", "status")
    return _append(prior, new)


@register("ingest_run")
def ingest_run(spark, d):
    keys = _keyed(spark, d).groupBy("url_key").agg(F.min("ord").alias("ord"))
    return _ingest(keys, D.snapshot_rows(spark, d), D.raw_prior(spark, d), D.ingest_ai_prior(spark, d),
                   D.ingest_vector_prior(spark, d), min_chars=300, run_ts=RUN_TS).status


def _stored(spark, base):
    """The committed rows of the three tables of an ingest, as one."""
    from quarry.plans.ingest import TABLES, read_table
    raw, enriched, vectors = (read_table(spark, base, name, schema) for name, schema in TABLES.items())
    none = F.lit(None).cast("string")
    parts = [
        raw.select(F.lit("raw").alias("stored"), "url", "status", "error", "title", "chars", none.alias("summary"), none.alias("topics"),
                   F.lit(None).cast("double").alias("emb_sum")),
        enriched.select(F.lit("enriched").alias("stored"), "url", "status", "error", "title", "chars", "summary",
                        _joined(F.col("topics")).alias("topics"), F.lit(None).cast("double").alias("emb_sum")),
        vectors.select(F.lit("vectors").alias("stored"), F.col("id").alias("url"), none.alias("status"), none.alias("error"),
                       F.col("metadata.title").alias("title"), F.lit(None).cast("int").alias("chars"), F.col("metadata.summary").alias("summary"),
                       F.col("metadata.topics").alias("topics"), _emb_sum(F.col("embedding")).alias("emb_sum"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("ingest_stored")
def ingest_stored(spark, d):
    """Every listed URL ingested twice into the tables of a folder; the stored
    rows, to which the second run adds nothing."""
    from quarry.plans.ingest import ingest_into
    base = scratch_path(spark, "ingest")
    keys = _keyed(spark, d).groupBy("url_key").agg(F.min("ord").alias("ord"))
    for _ in range(2):
        ingest_into(spark, keys, D.snapshot_rows(spark, d), base, min_chars=300, run_ts=RUN_TS)
    return _stored(spark, base)


@register("stream_pipeline")
def stream_pipeline(spark, d):
    """All pages as a stream through scrape, analysis and index; the stored
    rows.  A second stream over the same pages adds nothing."""
    base = scratch_path(spark, "stream")
    for run in ("first", "again"):
        _stream.ingest_stream(spark, *files_of(spark, d, "pages"), base, scratch_path(spark, f"stream-{run}"),
                              to_snapshot_rows=lambda b: b.selectExpr(*D.SNAPSHOT_EXPRS), min_chars=300, run_ts=RUN_TS)
    return _stored(spark, base)


# ------------------------------------------------------------ sources, sinks, streaming


@register("jsonl_scan")
def jsonl_scan(spark, d):
    """Scrape records written as JSON Lines (with a blank and a malformed
    line added) and read back with the RAW schema; the malformed line is
    quarantined, valid records come back unchanged."""
    from pyspark.sql import types as T
    path = scratch_path(spark, "jsonl")
    write_jsonl(_scrape_run(spark, d).records, path)
    spark.createDataFrame([("",), ('{"url": "broken', )], "value string").coalesce(1).write.mode("append").text(path)
    schema = T.StructType([T.StructField("ord", T.LongType())] + list(_RAW.fields))
    return valid_rows(read_jsonl(spark, path, schema))


@register("url_file_scan")
def url_file_scan(spark, d):
    """URL-list semantics on real text files written from the derived lines
    (a sorted write: part files follow the line order, and the reader orders
    lines by file, split and position)."""
    path = scratch_path(spark, "urls")
    D.url_lines(spark, d).orderBy("ord").select(F.col("line").alias("value")).write.text(path)
    return url_list(read_url_lines(spark, path)).select("url")


@register("url_file_limit")
def url_file_limit(spark, d):
    """The first 100 URLs of several text files, in file order."""
    path = scratch_path(spark, "urls")
    D.url_lines(spark, d).repartitionByRange(5, "ord").sortWithinPartitions("ord").select(F.col("line").alias("value")).write.text(path)
    return keyed_urls(read_url_lines(spark, path), 100).select("ord", "url", "url_key")


@register("vector_append")
def vector_append(spark, d):
    """Two runs appending the collection's vectors to a Parquet vector table
    (the first run with even ids only); the second run adds only ids not
    stored yet, so every id is stored once."""
    emb = load(spark, d, "embeddings")
    rows = emb.select(
        F.concat(F.lit("vec-"), F.col("vec_id").cast("string")).alias("id"),
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("text"),
        F.struct(F.concat(F.lit("vec-"), F.col("vec_id").cast("string")).alias("url"),
                 F.lit("").alias("title"), F.lit("").alias("source"), F.lit("").alias("summary"),
                 F.lit("").alias("topics"), F.lit(0).alias("topic_count")).cast(_VROW["metadata"].dataType).alias("metadata"),
        "embedding", "vec_id")
    path = scratch_path(spark, "vectors")
    append_vectors(rows.where(F.col("vec_id") % 2 == 0), path)
    append_vectors(rows, path)
    return read_vectors(spark, path).select("id", "text", _emb_sum(F.col("embedding")).alias("emb_sum"))


@register("stream_ingest")
def stream_ingest(spark, d):
    target, ckpt = scratch_path(spark, "t1"), scratch_path(spark, "t1ckpt")
    _stream.ingest_pages(spark, *files_of(spark, d, "pages"), target, ckpt)
    # a second run from a fresh checkpoint replays every file: adds nothing
    _stream.ingest_pages(spark, *files_of(spark, d, "pages"), target, scratch_path(spark, "t1ckpt2"))
    return keyed.read(spark, target, "url_key string, ord long").select("url_key", F.col("ord").alias("page_id"))


@register("stream_dedup")
def stream_dedup(spark, d):
    target, ckpt = scratch_path(spark, "t2"), scratch_path(spark, "t2ckpt")
    _stream.dedup_stream(spark, *files_of(spark, d, "pages"), target, ckpt)
    return spark.read.parquet(target).select("url_key")


@register("stream_flow")
def stream_flow(spark, d):
    target, ckpt = scratch_path(spark, "t3"), scratch_path(spark, "t3ckpt")
    _stream.scrape_stream(spark, *files_of(spark, d, "pages"), target, ckpt,
                          to_snapshot_rows=lambda b: b.selectExpr(*D.SNAPSHOT_EXPRS),
                          min_chars=500, run_ts=RUN_TS)
    return keyed.read(spark, target, _RAW).select("url", "status", "error", "title", "chars")
