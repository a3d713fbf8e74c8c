"""Physical-plan properties: native operators stay in the JVM, unused
columns are not read, top-k uses a group limit."""

from pyspark.sql import functions as F

from quarry.functions.html import extract_text
from quarry.functions.urls import url_key
from quarry.operators.dedup import first_wins, latest_matching
from quarry.sources.tables import load

from conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_operators_have_no_python(spark):
    pages = load(spark, SF_SMALL, "pages")
    df = pages.select(url_key(F.col("url")).alias("k"), extract_text(F.col("html")).alias("t"))
    p = plan(df)
    assert not any(n in p for n in PY_NODES)


def test_dedup_does_not_read_html(spark):
    pages = load(spark, SF_SMALL, "pages")
    df = first_wins(pages.select(url_key(F.col("url")).alias("k"), "page_id"), "k", "page_id")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "html" not in p.split("ReadSchema")[-1].split("\n")[0]


def test_filters_reach_the_scan(spark):
    labels = load(spark, SF_SMALL, "labels").where((F.col("quality") == 1) & (F.col("toxic") == 0))
    p = plan(labels)
    assert "PushedFilters" in p and "quality" in p.split("PushedFilters")[1]


def test_knn_final_rank_is_a_group_limit(spark):
    import __spark_entry__ as E
    df = E.queries()["knn_batch"](spark, SF_SMALL)
    df.collect()
    p = plan(df)
    assert "WindowGroupLimit" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_pages_are_read_for_winners_only(spark):
    """No HTML below the choice of each key's snapshot."""
    from quarry.sources.pages import fetch
    rows = load(spark, SF_SMALL, "pages").selectExpr("page_id", "url AS page_url", "url AS final_url", "200 AS http_status",
                                                     "'text/html' AS content_type", "html", "CAST(NULL AS string) AS fetch_error")
    todo = rows.select(url_key(F.col("page_url")).alias("url_key"), F.lit(1).alias("ord")).distinct()
    out = fetch(todo, rows)
    scans = [x for x in plan(out).split("\n") if "ReadSchema" in x]
    assert sum("html" in x.split("ReadSchema")[1] for x in scans) == 1 and len(scans) >= 3
    assert out.where("snap_found").count() == todo.count()


def _nodes(node):
    yield node
    for i in range(node.children().size()):
        yield from _nodes(node.children().apply(i))


def _exchanged(spark, df, column):
    """Exchanges, with adaptive execution off and no broadcast, whose rows hold ``column``."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        root = df.select("*")._jdf.queryExecution().executedPlan()
        return sum(n.nodeName() == "Exchange" and f" {column}#" in f" {n.output().mkString(' ')}" for n in _nodes(root))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_html_crosses_one_exchange(spark, tmp_path):
    from quarry.sources.pages import fetch, page_snapshots
    path = str(tmp_path / "pages")
    spark.read.parquet(f"{SF_SMALL}/pages.parquet").selectExpr(
        "page_id", "url AS page_url", "url AS final_url", "200 AS http_status", "'text/html' AS content_type", "html",
        "CAST(NULL AS string) AS fetch_error").write.parquet(path)
    rows = spark.read.parquet(path)
    todo = rows.select(url_key(F.col("page_url")).alias("url_key")).distinct()
    assert _exchanged(spark, fetch(todo, rows), "html") == 1
    assert _exchanged(spark, page_snapshots(rows), "html") == 1


def test_winners_are_chosen_on_narrow_rows(spark, tmp_path):
    """No aggregate over a packed row; the wide columns move once, spread by key and ordinal."""
    path = str(tmp_path / "versions")
    spark.range(300).selectExpr("CAST(id % 3 AS string) k", "id ord", "repeat('x', 100) wide", "id % 2 = 0 good").write.parquet(path)
    df = spark.read.parquet(path)
    for out in (first_wins(df, "k"), latest_matching(df, "k", F.col("good"))):
        p = plan(out)
        assert "min_by" not in p and "max_by" not in p
        assert _exchanged(spark, out, "wide") == 1
        assert out.count() == 3


def test_one_model_node_in_search_and_index(spark):
    from quarry.plans.index import _embed_rows
    from quarry.operators.embed import batch_embedder
    docs = spark.createDataFrame([("a", "text", 1)], "id string, text string, ord long")
    p = plan(_embed_rows(docs, batch_embedder(lambda t: [[1.0] * 64 for _ in t])))
    assert p.count("ArrowEvalPython") == 1


def test_hot_key_is_combined_before_the_shuffle(spark):
    """One key holds a third of the rows: first-wins must reduce it map-side
    (partial aggregate below the exchange) and still pick the first row."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (n - F.col("id")).alias("ord"), F.col("id").alias("v")).repartition(6)
    out = first_wins(df, "k", "ord")
    p = plan(out)
    assert "CartesianProduct" not in p
    phys = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in phys
    assert phys.index("Exchange") < phys.rindex("Aggregate")   # an aggregate sits below the exchange
    hot = out.where("k = 'hot'").first()
    assert hot["ord"] == n - max(i for i in range(n) if i % 3 == 0)
    assert out.count() == 1 + sum(1 for i in range(n) if i % 3)


def test_stored_stages_leave_no_shuffle_files(spark):
    """What a stored stage shuffled goes when it is stored, and the session's
    setting is as before."""
    from quarry.session import REMOVE_SHUFFLES, materialize
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_") and n.endswith(".data")}
    before, setting = shuffled(), spark.conf.get(REMOVE_SHUFFLES, None)
    stored = materialize(spark.range(5000).repartition(5, "id").groupBy((F.col("id") % 700).alias("k")).count())
    assert shuffled() <= before and spark.conf.get(REMOVE_SHUFFLES, None) == setting
    assert stored.count() == 700


def test_enriched_table_reads_the_documents_texts_once(spark, monkeypatch):
    """The annotator and the join with its answers read the stored winners."""
    from quarry.plans import workloads
    cands = []
    monkeypatch.setattr(workloads, "annotate_records", lambda c: cands.append(c) or c.select("ord"))
    workloads._enriched_all(spark, SF_SMALL)
    assert "documents.parquet" not in cands[0]._jdf.queryExecution().optimizedPlan().toString() + str(cands[0].inputFiles())
