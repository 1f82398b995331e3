"""Whole-corpus operators: profiles, gates, stratified picks, nearest neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_registration(manifest: DataFrame, key: str = "nct_id") -> DataFrame:
    """One row per key: the earliest registered, ties to the least record_id."""
    order = F.struct(F.col("registered_at"), F.col("record_id"))
    columns = [c for c in manifest.columns if c != key]
    return manifest.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in columns))


def page_profile(manifest: DataFrame, *by: str) -> DataFrame:
    """Least, median, greatest and total pages, mean redaction and total size, by the columns given (nulls left out)."""
    return manifest.groupBy(*by).agg(
        F.count("*").alias("n"), F.min("n_pages").alias("min_pages"), F.median("n_pages").alias("median_pages"), F.max("n_pages").alias("max_pages"), F.sum("n_pages").alias("sum_pages"),
        F.round(F.avg("redaction_area_fraction"), 6).alias("mean_redaction"), F.sum("size_kb").alias("sum_kb"),
    )


def quality_gate(rows: DataFrame, least: int = 40, most: int = 600, redaction: float = 0.1, blank: float = 0.05) -> DataFrame:
    """`rows` and reason: why the first failing test of pages, blank pages and redaction fails; null for those that pass.

    blank_pages is tested where the rows have it; unknown values fail only the test of pages.
    """
    pages, share = F.col("n_pages"), F.col("redaction_area_fraction")
    empty = F.col("blank_pages") / F.greatest(pages, F.lit(1)) > blank if "blank_pages" in rows.columns else F.lit(False)
    return rows.withColumn("reason", F.when(pages.isNull() | (pages < least), "too_short").when(pages > most, "too_long").when(empty, "blank").when(share > redaction, "redacted"))


def censored(blocks: DataFrame, characters: int = 20, share: float = 0.3) -> DataFrame:
    """doc_id, empty_share, censored: the share of pages with fewer than `characters` of text."""
    pages = blocks.groupBy("doc_id", "page_num").agg(F.coalesce(F.sum(F.length(F.trim("text"))), F.lit(0)).alias("n"))
    out = pages.groupBy("doc_id").agg(F.avg((F.col("n") < characters).cast("double")).alias("empty_share"))
    return out.withColumn("censored", F.col("empty_share") > share)


def start_year(date: Column) -> Column:
    """Year of a partial date text such as 2027-05; null if it has none."""
    return F.substring(date, 1, 4).try_cast("int")


def round_robin(rows: DataFrame, stratum: str, order: list[Column], key: str, n: int) -> DataFrame:
    """The first n rows when strata take turns, each giving its rows in order.

    No stratum can give more than n rows, so every task keeps its n first of a stratum before the shuffle.
    """
    turn = F.row_number().over(Window.partitionBy(stratum).orderBy(*order, key))
    return rows.where(F.col(stratum).isNotNull()).withColumn("turn", turn).where(F.col("turn") <= n).orderBy("turn", stratum).limit(n)


def events_rollup(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """window_start, event_type, n, total: a tumbling rollup (an extra beside the document operators)."""
    return events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


#: Query vectors that are broadcast at a time.
QUERY_BLOCK = 4096


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, key, score, rank: the k rows of greatest cosine for each query, itself left out; exact.

    The query set is stated and meets all rows in blocks of QUERY_BLOCK vectors, so that each broadcast has a fixed bound.
    Every partition keeps its own k best per query before the shuffle. Ties go to the lesser id; null and zero vectors
    have no neighbours.
    """
    spark = vectors.sparkSession
    total = queries.count()
    parts = None
    blocks = max(1, -(-total // QUERY_BLOCK))
    slim = vectors.where(F.size(vector) > 0).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = queries.where(F.size(vector) > 0).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        if not rows:
            continue
        matrix = np.array([r.v for r in rows])
        norm = np.linalg.norm(matrix, axis=1, keepdims=True)
        shared = spark.sparkContext.broadcast((np.array([r.id for r in rows]), np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0), norm[:, 0] > 0))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ids, matrix, valid = shared.value
            best: list[list[tuple[float, int]]] = [[] for _ in ids]
            for batch in batches:
                own, found = batch["id"].to_numpy(), np.stack(batch["v"].to_numpy())
                length = np.linalg.norm(found, axis=1)
                scores = matrix @ np.divide(found, length[:, None], out=np.zeros_like(found), where=length[:, None] > 0).T
                scores[:, length == 0] = -np.inf
                for i in np.flatnonzero(valid):
                    row = np.where(own == ids[i], -np.inf, scores[i])
                    top = np.lexsort((own, -row))[:k]
                    best[i] = sorted(best[i] + [(-row[j], int(own[j])) for j in top if row[j] > -np.inf])[:k]
            out = [(int(ids[i]), other, -score) for i, found in enumerate(best) for score, other in found]
            yield pd.DataFrame(out, columns=["query_id", "id", "score"])

        some = slim.mapInPandas(run, "query_id bigint, id bigint, score double")
        parts = some if parts is None else parts.unionByName(some)
    if parts is None:
        parts = slim.where("false").select(F.lit(0).cast("bigint").alias("query_id"), "id", F.lit(0.0).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return parts.withColumn("rank", rank).where(F.col("rank") <= k).withColumnRenamed("id", key)
