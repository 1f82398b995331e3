"""Queries on whole-corpus profiles and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.operators import annotate, corpus, records
from leafwork.plans.registry import Registry
from leafwork.sources.tables import table

registry = Registry()

_FIRST = "SELECT * FROM manifest WHERE nct_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY nct_id ORDER BY registered_at, record_id) = 1"


@registry.add("first_registrations", f"SELECT nct_id, record_id, sponsor FROM ({_FIRST})")
def first_registrations(spark: SparkSession, root: str) -> DataFrame:
    return corpus.first_registration(table(spark, root, "manifest")).select("nct_id", "record_id", "sponsor")


@registry.add(
    "corpus_profile",
    """SELECT stratum, count(*) AS n, min(n_pages) AS min_pages, median(n_pages) AS median_pages, max(n_pages) AS max_pages, CAST(sum(n_pages) AS BIGINT) AS sum_pages,
    round(avg(redaction_area_fraction), 6) AS mean_redaction, CAST(sum(size_kb) AS BIGINT) AS sum_kb FROM manifest GROUP BY stratum""",
)
def corpus_profile(spark: SparkSession, root: str) -> DataFrame:
    return corpus.page_profile(table(spark, root, "manifest"), "stratum")


@registry.add(
    "quality_gate",
    """WITH p AS (SELECT doc_id, page_num, coalesce(sum(length(trim(text, ' '))), 0) AS n FROM extracted_blocks GROUP BY ALL), e AS (SELECT doc_id AS nct_id, count(*) FILTER (WHERE n = 0) AS blank FROM p GROUP BY ALL)
    SELECT record_id, CASE WHEN n_pages IS NULL OR n_pages < 40 THEN 'too_short' WHEN n_pages > 600 THEN 'too_long' WHEN coalesce(blank, 0) / greatest(n_pages, 1) > 0.05 THEN 'blank' WHEN redaction_area_fraction > 0.1 THEN 'redacted' END AS reason
    FROM manifest LEFT JOIN e USING (nct_id)""",
)
def quality_gate(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "extracted_blocks").groupBy("doc_id", "page_num").agg(F.coalesce(F.sum(F.length(F.trim("text"))), F.lit(0)).alias("n"))
    blank = pages.groupBy(F.col("doc_id").alias("nct_id")).agg(F.count_if(F.col("n") == 0).alias("blank_pages"))
    return corpus.quality_gate(table(spark, root, "manifest").join(blank, "nct_id", "left").fillna(0, ["blank_pages"])).select("record_id", "reason")


@registry.add(
    "estimated_tables",
    """WITH p AS (SELECT doc_id, page_num, count(*) FILTER (WHERE block_type = 'table') AS tables FROM extracted_blocks GROUP BY ALL)
    SELECT doc_id, count(*) AS n_pages, CAST(floor(coalesce(sum(tables) FILTER (WHERE page_num < 30), 0) * CASE WHEN count(*) FILTER (WHERE page_num < 30) > 0 THEN count(*) / count(*) FILTER (WHERE page_num < 30) ELSE 1 END) AS BIGINT) AS estimate
    FROM p GROUP BY doc_id""",
)
def estimated_tables(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "extracted_blocks").groupBy("doc_id", "page_num").agg(F.count_if(F.col("block_type") == "table").alias("tables"))
    return records.extrapolated(pages, "tables")


@registry.add(
    "steady_averages",
    """WITH r AS (SELECT n_pages_requested, convert_duration_ms AS ms, row_number() OVER (PARTITION BY n_pages_requested ORDER BY received_at, response_id) AS k, count(convert_duration_ms) OVER (PARTITION BY n_pages_requested) AS of FROM mineru_responses)
    SELECT n_pages_requested, count(ms) AS n, round(avg(ms), 4) AS average FROM (SELECT * REPLACE (CASE WHEN n_pages_requested % 2 = 0 AND of > 1 AND k = 1 THEN NULL ELSE ms END AS ms) FROM r) GROUP BY ALL""",
)
def steady_averages(spark: SparkSession, root: str) -> DataFrame:
    calls = table(spark, root, "mineru_responses")
    found = records.steady_averages(calls, "n_pages_requested", ["received_at", "response_id"], "convert_duration_ms", F.col("n_pages_requested") % 2 == 0)
    return found.select("n_pages_requested", "n", F.round("average", 4).alias("average"))


_OUTCOME = "CASE WHEN payload IS NULL OR payload = '' THEN 'skipped' WHEN payload LIKE '%}' THEN 'ok' ELSE 'failed' END"


@registry.add(
    "run_summary",
    f"""WITH r AS (SELECT {_OUTCOME} AS outcome, n_pages_requested, convert_duration_ms / 1000 AS seconds FROM mineru_responses)
    SELECT count(*) AS documents, count(*) FILTER (WHERE outcome = 'ok') AS ok, count(*) FILTER (WHERE outcome = 'skipped') AS skipped, count(*) FILTER (WHERE outcome = 'failed') AS failed,
    CAST(coalesce(sum(n_pages_requested) FILTER (WHERE outcome = 'ok'), 0) AS BIGINT) AS pages, round(coalesce(sum(seconds), 0), 1) AS seconds FROM r""",
)
def run_summary(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "mineru_responses")
    return records.run_summary(rows.select(F.expr(_OUTCOME).alias("outcome"), F.col("n_pages_requested").alias("n_pages"), (F.col("convert_duration_ms") / 1000).alias("seconds")))


_SURE = "CASE WHEN starts_with(kind, 'paren') THEN 0.95 WHEN kind = 'bullet' THEN 0.9 WHEN kind IS NOT NULL THEN 0.6 END"
_KIND_SQL = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{kind}'" for kind, p in T.LIST_MARKERS)


@registry.add(
    "rule_first",
    f"""WITH k AS (SELECT gold_id, CASE {_KIND_SQL} END AS kind FROM gold_eligibility), c AS (SELECT *, coalesce({_SURE}, 0) >= 0.9 AS sure, {_SURE} AS confidence FROM k)
    SELECT gold_id, CASE WHEN sure THEN kind ELSE 'unknown' END AS role, CAST(CASE WHEN sure THEN confidence ELSE 0 END AS DOUBLE) AS confidence, sure AS by_rule FROM c""",
)
def rule_first(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "gold_eligibility").select("gold_id", T.list_marker(F.col("text"))["kind"].alias("kind"))
    return records.rule_first(rows, F.col("kind"), F.expr(_SURE.replace("starts_with", "startswith")).cast("double")).select("gold_id", "role", "confidence", "by_rule")


@registry.add(
    "design_rates",
    """WITH h AS (SELECT m.nct_id, m.condition, coalesce(bool_or(contains(lower(b.text), lower(m.condition))), false) AS hit FROM (SELECT DISTINCT nct_id, condition, stratum FROM manifest WHERE condition <> '') m LEFT JOIN extracted_blocks b ON b.doc_id = m.nct_id GROUP BY ALL)
    SELECT condition, count(*) AS n, round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 6) AS rate FROM h GROUP BY condition""",
)
def design_rates(spark: SparkSession, root: str) -> DataFrame:
    values = table(spark, root, "manifest").select(F.col("nct_id").alias("key"), F.col("condition").alias("value"))
    hits = annotate.mentioned(values, table(spark, root, "extracted_blocks").select(F.col("doc_id").alias("key"), "block_id", "text"))
    return hits.groupBy(F.col("value").alias("condition")).agg(F.count("*").alias("n"), F.round(F.avg(F.col("hit").cast("double")), 6).alias("rate"))


@registry.add(
    "censored_documents",
    """WITH p AS (SELECT doc_id, page_num, coalesce(sum(length(trim(text, ' '))), 0) AS n FROM extracted_blocks GROUP BY ALL)
    SELECT doc_id, round(avg(CASE WHEN n < 20 THEN 1.0 ELSE 0.0 END), 6) AS empty_share, avg(CASE WHEN n < 20 THEN 1.0 ELSE 0.0 END) > 0.3 AS censored FROM p GROUP BY doc_id""",
)
def censored_documents(spark: SparkSession, root: str) -> DataFrame:
    return corpus.censored(table(spark, root, "extracted_blocks")).withColumn("empty_share", F.round("empty_share", 6))


@registry.add(
    "round_robin",
    f"""WITH f AS ({_FIRST}), t AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY size_kb, nct_id) AS turn FROM f WHERE stratum IS NOT NULL)
    SELECT stratum, nct_id, CAST(turn AS INTEGER) AS turn FROM t ORDER BY turn, stratum LIMIT 20""",
)
def round_robin(spark: SparkSession, root: str) -> DataFrame:
    rows = corpus.first_registration(table(spark, root, "manifest"))
    return corpus.round_robin(rows, "stratum", [F.col("size_kb").asc_nulls_last()], "nct_id", 20).select("stratum", "nct_id", "turn")


@registry.add("start_years", "SELECT record_id, start_year >= 2015 AS recent, try_cast(left(CAST(start_year AS VARCHAR), 4) AS INTEGER) AS year FROM manifest")
def start_years(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "manifest").select("record_id", (F.col("start_year") >= 2015).alias("recent"), corpus.start_year(F.col("start_year").cast("string")).alias("year"))


_DOT = "list_sum(list_transform(range(1, 65), lambda i: {0}[i]::DOUBLE * {1}[i]::DOUBLE))"


@registry.add(
    "knn_cosine",
    f"""WITH v AS (SELECT vec_id, embedding AS e, sqrt({_DOT.format("embedding", "embedding")}) AS n FROM embeddings WHERE len(embedding) > 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, {_DOT.format("q.e", "v.e")} / (q.n * v.n) AS score FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0 AND q.n > 0 AND v.n > 0)
    SELECT query_id, vec_id, round(score, 5) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 10""",
)
def knn_cosine(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "embeddings")
    return corpus.nearest(rows, rows.where("vec_id % 20 = 0")).withColumn("score", F.round("score", 5))


@registry.add(
    "events_rollup",
    "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
)
def events_rollup(spark: SparkSession, root: str) -> DataFrame:
    return corpus.events_rollup(table(spark, root, "events"))


@registry.add(
    "coverage_join",
    """SELECT m.record_id, m.nct_id, count(DISTINCT b.page_num) AS pages_found, m.n_pages FROM manifest m LEFT JOIN extracted_blocks b ON b.doc_id = m.nct_id GROUP BY ALL""",
)
def coverage_join(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "extracted_blocks").groupBy(F.col("doc_id").alias("nct_id")).agg(F.count_distinct("page_num").alias("pages_found"))
    rows = table(spark, root, "manifest").select("record_id", "nct_id", "n_pages")
    return rows.join(pages, "nct_id", "left").fillna(0, ["pages_found"]).select("record_id", "nct_id", "pages_found", "n_pages")
