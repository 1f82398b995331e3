"""Records around the documents: saved results, runs, timings, rules with a fallback, and what is read in advance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.functions import lookups


def repaired_types(blocks: DataFrame, layout_type: Column) -> DataFrame:
    """Saved blocks with the block types their layout types stand for."""
    return blocks.withColumn("block_type", lookups.repaired_type(F.col("block_type"), layout_type))


def prefetch_plan(routes: DataFrame, pages: int = 64) -> DataFrame:
    """doc_id, route, batch, pages: the pages of each document to ask a route for at once, `pages` at most in a batch.

    `routes` has doc_id, page_num and primary_route; a row per batch is what a remote client is called with.
    """
    batch = F.floor(F.col("page_num") / pages).cast("int").alias("batch")
    return routes.groupBy("doc_id", F.col("primary_route").alias("route"), batch).agg(F.array_sort(F.collect_set("page_num")).alias("pages"))


def prefetched(routes: DataFrame, answers: DataFrame) -> DataFrame:
    """Every page with the answer (doc_id, page_num, answer) it has, null where the batch left it out."""
    return routes.join(answers, ["doc_id", "page_num"], "left")


def with_item_text(criteria: DataFrame, items: DataFrame, on: list[str], order: str, missing: str = "(no text)") -> DataFrame:
    """`criteria` and text: that of the item they refer to, the last by `order` where several have the key."""
    last = items.groupBy(*on).agg(F.max_by("text", order).alias("text"))
    return criteria.join(last, on, "left").withColumn("text", F.coalesce("text", F.lit(missing)))


def steady_averages(calls: DataFrame, by: str, order: list[str], value: str, cold: Column) -> DataFrame:
    """by, n, average: the mean of `value` per group; where `cold`, the first call, which loads a model, is left out if
    there are others. One aggregate with a partial step, no sort of a group."""
    first = F.min_by(F.struct(value), F.struct(*order))[value].alias("first")
    per = calls.groupBy(by).agg(F.count(value).alias("n"), F.sum(value).alias("s"), first, F.max(cold).alias("cold"))
    skip = F.col("cold") & (F.col("n") > 1) & F.col("first").isNotNull()
    n = F.col("n") - F.when(skip, 1).otherwise(0)
    total = F.col("s") - F.when(skip, F.col("first")).otherwise(0.0)
    return per.select(by, n.alias("n"), F.when(n > 0, total / n).alias("average"))


def run_summary(documents: DataFrame) -> DataFrame:
    """One row: documents, ok, skipped, failed, pages and seconds of a run (outcome, n_pages, seconds per document)."""
    outcome = lambda kind: F.count_if(F.col("outcome") == kind)
    return documents.agg(
        F.count("*").alias("documents"), outcome("ok").alias("ok"), outcome("skipped").alias("skipped"), outcome("failed").alias("failed"),
        F.coalesce(F.sum(F.when(F.col("outcome") == "ok", F.col("n_pages"))), F.lit(0)).alias("pages"), F.round(F.coalesce(F.sum("seconds"), F.lit(0.0)), 1).alias("seconds"),
    )


def rule_first(rows: DataFrame, role: Column, confidence: Column, fallback: Callable[[DataFrame], DataFrame] | None = None, least: float = 0.9, unknown: str = "unknown") -> DataFrame:
    """`rows` with role, confidence and by_rule: what a rule is sure of stays, the rest goes to the fallback.

    `fallback` gets the rows without these columns and gives them back with role and confidence; without one they are
    unknown with confidence 0. Both sides come from one plan.
    """
    told = rows.withColumns({"role": role, "confidence": confidence})
    sure = F.coalesce(F.col("confidence") >= least, F.lit(False)) & F.col("role").isNotNull()
    if fallback is None:
        return told.withColumns({"role": F.when(sure, F.col("role")).otherwise(unknown), "confidence": F.when(sure, F.col("confidence")).otherwise(0.0), "by_rule": sure})
    rest = fallback(told.where(~sure).drop("role", "confidence")).withColumn("by_rule", F.lit(False))
    return told.where(sure).withColumn("by_rule", F.lit(True)).unionByName(rest)


def head_sample(pages: DataFrame, n: int = 30) -> DataFrame:
    """The first n pages of every document."""
    return pages.where(F.col("page_num") < n)


def extrapolated(pages: DataFrame, count: str, n: int = 30) -> DataFrame:
    """doc_id, n_pages, estimate: a count over the first n pages of a document, scaled to all its pages and cut to a whole."""
    inside = F.col("page_num") < n
    per = pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"), F.count_if(inside).alias("read"), F.coalesce(F.sum(F.when(inside, F.col(count))), F.lit(0)).alias("c"))
    scale = F.when(F.col("read") > 0, F.col("n_pages") / F.col("read")).otherwise(1.0)
    return per.select("doc_id", "n_pages", F.floor(F.col("c") * scale).alias("estimate"))
