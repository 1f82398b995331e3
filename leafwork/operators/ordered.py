"""Ordered operators over documents of any length.

A plain window over a document puts all its rows in one task. Here a document is cut into segments of consecutive
pages; windows run within segments, and what crosses their borders (the last value, the neighbour, the running total)
is carried over a table with one row per segment, which is smaller by the size of a segment. Results equal those of the
plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_PAGES = 64
ORDER = ("page_num", "order_index")


def segmented(frame: DataFrame, key: str = "doc_id", page: str = "page_num", pages: int = SEGMENT_PAGES) -> DataFrame:
    """`frame` with the column seg, hash partitioned by (key, seg): the one shuffle that the operators here share."""
    return frame.withColumn("seg", F.floor(F.coalesce(F.col(page), F.lit(0)) / pages).cast("int")).repartition(key, "seg")


def distinct_blocks(blocks: DataFrame) -> DataFrame:
    """Segmented blocks, one per (doc_id, page_num, order_index): of repeated deliveries the least block_id stays.

    Rows without a document are left out, as they have no order; null pages and positions sort first.
    """
    rows = segmented(blocks.where(F.col("doc_id").isNotNull()))
    first = F.row_number().over(Window.partitionBy("doc_id", "seg", *ORDER).orderBy("block_id"))
    return rows.withColumn("__n", first).where("__n = 1").drop("__n")


def _within(key: str, order: tuple[str, ...]) -> Window:
    return Window.partitionBy(key, "seg").orderBy(*order)


def _place(order: tuple[str, ...]) -> Column:
    return F.struct(*order)


def carry_last(frame: DataFrame, values: dict[str, Column], key: str = "doc_id", order: tuple[str, ...] = ORDER, own: bool = True) -> DataFrame:
    """Each value's last non-null occurrence up to the row (or before it, unless `own`), as columns named by `values`."""
    window = _within(key, order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    raw = frame.withColumns({f"__v_{n}": v for n, v in values.items()})
    local = raw.withColumns({f"__l_{n}": F.last(f"__v_{n}", ignorenulls=True).over(window) for n in values})
    place = _place(order)
    tails = raw.groupBy(key, "seg").agg(*(F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), place)).alias(f"__t_{n}") for n in values))
    before = Window.partitionBy(key).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(key, "seg", *(F.last(f"__t_{n}", ignorenulls=True).over(before).alias(f"__c_{n}") for n in values))
    joined = local.join(carried, [key, "seg"], "left")
    out = joined.withColumns({n: F.coalesce(f"__l_{n}", f"__c_{n}") for n in values})
    return out.drop(*(f"__{p}_{n}" for n in values for p in "vlc"))


def neighbour(frame: DataFrame, values: dict[str, Column], offset: int, key: str = "doc_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """Each value on the next (offset 1) or the previous (offset -1) row of the document; null at its ends."""
    if offset not in (1, -1):
        raise ValueError("offset must be 1 or -1")
    step = F.lead if offset > 0 else F.lag
    packed = F.struct(*(v.alias(n) for n, v in values.items()))
    raw = frame.withColumn("__v", packed)
    local = raw.withColumn("__l", step("__v").over(_within(key, order)))
    edge = (F.min_by if offset > 0 else F.max_by)("__v", _place(order))
    edges = raw.groupBy(key, "seg").agg(edge.alias("__e"))
    across = edges.select(key, "seg", step("__e").over(Window.partitionBy(key).orderBy("seg")).alias("__c"))
    joined = local.join(across, [key, "seg"], "left").withColumn("__n", F.coalesce("__l", "__c"))
    return joined.withColumns({n: F.col(f"__n.{n}") for n in values}).drop("__v", "__l", "__c", "__n")


def running_sum(frame: DataFrame, name: str, value: Column, key: str = "doc_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """Sum of the non-null values up to and including the row."""
    raw = frame.withColumn("__v", F.coalesce(value, F.lit(0)))
    window = _within(key, order).rowsBetween(Window.unboundedPreceding, 0)
    local = raw.withColumn("__l", F.sum("__v").over(window))
    totals = raw.groupBy(key, "seg").agg(F.sum("__v").alias("__t"))
    before = Window.partitionBy(key).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(key, "seg", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__c"))
    joined = local.join(carried, [key, "seg"], "left")
    return joined.withColumn(name, F.col("__l") + F.col("__c")).drop("__v", "__l", "__c")


def reading_position(frame: DataFrame, name: str = "pos", key: str = "doc_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """0-based position of the row in its document."""
    return running_sum(frame, name, F.lit(1).cast("bigint"), key, order).withColumn(name, F.col(name) - 1)
