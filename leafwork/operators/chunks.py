"""Chunks of documents: identity, parents and children, footnotes, table continuations, neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.operators.ordered import neighbour

CHROME = ("header", "footer", "other")


def chunk_id(doc: str = "doc_id", page: str = "page_num", order: str = "order_index") -> Column:
    return F.concat(F.col(doc), F.lit("_p"), F.col(page), F.lit("_b"), F.col(order))


def parent_links(blocks: DataFrame, parent: str = "parent_block_id") -> DataFrame:
    """doc_id, page_num, order_index, parent_index: blocks whose named parent is another block of their page."""
    own = blocks.where(F.col(parent).isNotNull() & (F.col(parent) != F.col("order_index"))).select("doc_id", "page_num", "order_index", F.col(parent).alias("parent_index"))
    present = blocks.select("doc_id", "page_num", F.col("order_index").alias("parent_index")).distinct()
    return own.join(present, ["doc_id", "page_num", "parent_index"], "left_semi").select("doc_id", "page_num", "order_index", "parent_index")


def child_lists(links: DataFrame) -> DataFrame:
    """doc_id, page_num, parent_index, children (in order): children of a block lie on its page, which bounds the list."""
    children = F.array_sort(F.collect_set("order_index")).alias("children")
    return links.groupBy("doc_id", "page_num", "parent_index").agg(children)


def footnotes(blocks: DataFrame) -> DataFrame:
    """block_id, marker, ordinal, definition, definition_id: markers resolved to the page's first definition of each."""
    defs = blocks.where("block_type = 'footnote'").withColumn("marker", T.leading_marker(F.col("text"))).where("marker is not null")
    first = defs.groupBy("doc_id", "page_num", "marker").agg(F.min_by(F.struct("text", "block_id"), F.struct("order_index", "block_id")).alias("d"))
    body = blocks.where(F.col("block_type").isNull() | (F.col("block_type") != "footnote"))
    marks = body.select("block_id", "doc_id", "page_num", F.posexplode(T.footnote_markers(F.col("text"))).alias("ordinal", "marker"))
    return marks.join(first, ["doc_id", "page_num", "marker"]).select("block_id", "marker", "ordinal", F.col("d.text").alias("definition"), F.col("d.block_id").alias("definition_id"))


def table_continuations(blocks: DataFrame) -> DataFrame:
    """block_id, continued_by: tables followed, page furniture aside, by a table of the next page."""
    body = blocks.where(~F.coalesce(F.col("block_type").isin(*CHROME), F.lit(False)))
    after = neighbour(body, {"__type": F.col("block_type"), "__page": F.col("page_num"), "__id": F.col("block_id")}, 1)
    linked = (F.col("block_type") == "table") & (F.col("__type") == "table") & (F.col("__page") == F.col("page_num") + 1)
    return after.where(linked).select("block_id", F.col("__id").alias("continued_by"))


def neighbours(blocks: DataFrame, characters: int = 200) -> DataFrame:
    """block_id, before, after: the texts around each block in reading order, cut to `characters`."""
    short = F.substring(F.coalesce("text", F.lit("")), 1, characters)
    before = neighbour(blocks, {"before": short}, -1)
    return neighbour(before, {"after": short}, 1).select("block_id", "before", "after")


def type_counts(blocks: DataFrame, *by: str) -> DataFrame:
    return blocks.groupBy(*by).agg(F.count("*").alias("n"))


def chunk_summary(blocks: DataFrame, links: DataFrame, notes: DataFrame, continuations: DataFrame) -> DataFrame:
    """doc_id, n_chunks, n_with_parent, n_with_refs, n_with_footnotes, n_continued."""
    per = blocks.groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.count_if(F.size(T.mentions(F.coalesce("text", F.lit("")))) > 0).alias("n_with_refs"))
    noted = blocks.join(notes.select("block_id").distinct(), "block_id", "left_semi").groupBy("doc_id").agg(F.count("*").alias("n_with_footnotes"))
    continued = blocks.join(continuations.select("block_id"), "block_id", "left_semi").groupBy("doc_id").agg(F.count("*").alias("n_continued"))
    parents = links.groupBy("doc_id").agg(F.count("*").alias("n_with_parent"))
    out = per
    for part in (parents, noted, continued):
        out = out.join(part, "doc_id", "left")
    return out.fillna(0, ["n_with_parent", "n_with_footnotes", "n_continued"])


def section_texts(sections: DataFrame, longest: int | None = None) -> DataFrame:
    """doc_id, section_path, part, text: texts of each section in reading order, joined per segment of pages.

    A section longer than a segment comes out in several parts, so that no task holds an unbounded text.
    """
    piece = F.struct("page_num", "order_index", F.coalesce("text", F.lit("")).alias("text"))
    grouped = sections.groupBy("doc_id", "section_path", F.col("seg").alias("part")).agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    joined = F.array_join(F.transform("pieces", lambda p: p["text"]), "\n")
    return grouped.select("doc_id", "section_path", "part", (F.substring(joined, 1, longest) if longest else joined).alias("text"))
