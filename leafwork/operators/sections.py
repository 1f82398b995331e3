"""Section hierarchy of documents: heading depths, paths, index, tree and coverage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.functions import lookups
from leafwork.operators.ordered import carry_last, neighbour



def numeric_prefix(text: Column) -> Column:
    """'5.1' of '5.1 Title' or '5.1. Title'; null without a number."""
    found = F.regexp_extract(F.trim(text), r"^(\d+(?:\.\d+)*)\.?\s+", 1)
    return F.when(found != "", found)


def heading_label(text: Column) -> Column:
    """The heading without its number."""
    return F.trim(F.regexp_replace(F.trim(text), r"^\d+(?:\.\d+)*\.?\s+", ""))


def heading_depth(prefix: Column) -> Column:
    return F.when(prefix.isNotNull(), F.length(prefix) - F.length(F.replace(prefix, F.lit("."), F.lit(""))) + 1)


def heading_levels(blocks: DataFrame) -> list[int]:
    """All depths a heading of these blocks can have, ascending: one small job over the distinct heading depths."""
    depth = heading_depth(numeric_prefix(F.coalesce("text", F.lit(""))))
    found = blocks.where("block_type = 'heading'").select(depth.alias("d")).where("d is not null").distinct().collect()
    return sorted({1} | {r.d + k for r in found for k in (0, 1)})


def section_paths(blocks: DataFrame, levels: list[int] | None = None) -> DataFrame:
    """`blocks` (segmented) with prefix, depth (of headings), section_path, section_depth and section_number.

    A numbered heading has the depth of its dots plus one; another one is one below the last numbered heading. A heading
    closes all open ones of its depth or deeper. The last heading of each level is carried forward; it is open while no
    shallower heading came after it, so the path needs no stack and no join of headings with blocks. A heading lies in
    itself; null and empty headings count as headings with an empty label. `levels` are the depths that occur
    (`heading_levels`, which is run here if they are not given): each has its own column, whatever their number.
    """
    levels = heading_levels(blocks) if levels is None else levels
    is_heading = F.col("block_type") == "heading"
    text = F.coalesce("text", F.lit(""))
    marked = blocks.withColumns({"prefix": F.when(is_heading, numeric_prefix(text))})
    known = carry_last(marked, {"__numbered": heading_depth(F.col("prefix"))})
    own = F.coalesce(heading_depth(F.col("prefix")), F.coalesce("__numbered", F.lit(0)) + 1)
    deep = known.withColumn("depth", F.when(is_heading, own)).drop("__numbered")
    at = F.shiftleft(F.coalesce("page_num", F.lit(-1)).cast("bigint"), 32) + F.coalesce("order_index", F.lit(-1))
    entry = F.struct(at.alias("at"), F.trim(text).alias("label"), "prefix")
    carried = carry_last(deep, {f"__h{k}": F.when(F.col("depth") == k, entry) for k in levels})

    alive, shallower = [], F.lit(None).cast("bigint")
    for k in levels:
        here = F.col(f"__h{k}")
        is_open = here.isNotNull() & (shallower.isNull() | (here["at"] > shallower))
        alive.append(F.when(is_open, F.struct(F.lit(k).alias("level"), here["label"].alias("label"), here["prefix"].alias("prefix"))))
        upto = [F.col(f"__h{j}.at") for j in levels if j <= k]
        shallower = upto[0] if len(upto) == 1 else F.greatest(*upto)
    path = carried.withColumn("__path", F.filter(F.array(*alive), lambda e: e.isNotNull()))
    numbers = F.filter(F.col("__path.prefix"), lambda p: p.isNotNull())
    return path.withColumns({
        "section_path": F.col("__path.label"),
        "section_depth": F.coalesce(F.try_element_at("__path", F.lit(-1))["level"], F.lit(0)),
        "section_number": F.try_element_at(numbers, F.lit(-1)),
    }).drop("__path", *(f"__h{k}" for k in levels))


def strict_prefix(text: Column) -> Column:
    """'5.1' of '5.1 Title', but not of '5.1. Title'; null without a number."""
    found = F.regexp_extract(text, r"^(\d+(?:\.\d+)*)\s+", 1)
    return F.when(found != "", found)


_SUMMARY = "doc_id string, seg int, ops array<int>, depths array<int>, labels array<string>"


def _fold(rows: list[dict], depths: list[int], labels: list[str], ops: list[int] | None = None) -> Iterator[list[str]]:
    """The older stack over headings (depth, 0 for one without a number; label): the path after each.

    A numbered heading closes all of its depth or deeper; one without a number closes exactly one, and counts as of depth
    1 from then on. What a heading closes below the given stack goes to `ops`, if given, to be applied to the stack of what
    came before: n > 0 for all of depth n or deeper, 0 for one.
    """
    for r in rows:
        depth = r["depth"]
        if depth:
            while depths and depths[-1] >= depth:
                depths.pop()
                labels.pop()
            if not depths and ops is not None:
                ops.append(depth)
        elif depths:
            depths.pop()
            labels.pop()
        elif ops is not None:
            ops.append(0)
        depths.append(depth or 1)
        labels.append(r["label"])
        yield [*labels]


def legacy_paths(blocks: DataFrame) -> DataFrame:
    """block_id, section_path of each heading by the older rule: numbers without a final point only, and a heading without
    a number closes exactly one open heading.

    The rule needs running state. Segments of pages are folded apart, to what they leave open and what they close of the
    headings before; these summaries are folded per document, and then each segment again from the stack it starts with.
    `blocks` are segmented.
    """
    text = F.coalesce("text", F.lit(""))
    heads = blocks.where("block_type = 'heading'").select("doc_id", "seg", "page_num", "order_index", "block_id", F.coalesce(heading_depth(strict_prefix(text)), F.lit(0)).alias("depth"), text.alias("label"))
    order = lambda r: tuple((v is not None, v or 0) for v in (r["page_num"], r["order_index"], r["block_id"]))

    def summary(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=order)
        ops, depths, labels = [], [], []
        for _ in _fold(rows, depths, labels, ops):
            pass
        kinds = [pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]
        values = [rows[0]["doc_id"], rows[0]["seg"], ops, depths, labels]
        return pa.table({f.split()[0]: pa.array([v], k) for f, v, k in zip(_SUMMARY.split(", "), values, kinds)})

    def starts(table: pa.Table) -> pa.Table:
        depths: list[int] = []
        labels: list[str] = []
        out = []
        for r in sorted(table.to_pylist(), key=lambda r: r["seg"]):
            out.append({"doc_id": r["doc_id"], "seg": r["seg"], "depths": [*depths], "labels": [*labels]})
            for op in r["ops"]:
                while depths and (op == 0 or depths[-1] >= op):
                    depths.pop()
                    labels.pop()
                    if op == 0:
                        break
            depths += r["depths"]
            labels += r["labels"]
        return pa.Table.from_pylist(out, schema=pa.schema([("doc_id", pa.string()), ("seg", pa.int32()), ("depths", pa.list_(pa.int32())), ("labels", pa.list_(pa.string()))]))

    def paths(table: pa.Table, start: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=order)
        begin = start.to_pylist()[0] if len(start) else {"depths": [], "labels": []}
        found = [*_fold(rows, begin["depths"], begin["labels"])]
        return pa.table({"block_id": pa.array([r["block_id"] for r in rows], pa.int64()), "section_path": pa.array(found, pa.list_(pa.string()))})

    begin = heads.groupBy("doc_id", "seg").applyInArrow(summary, _SUMMARY).groupBy("doc_id").applyInArrow(starts, "doc_id string, seg int, depths array<int>, labels array<string>")
    again = heads.select(*(F.col(c).alias(c) for c in heads.columns))
    return again.groupBy("doc_id", "seg").cogroup(begin.groupBy("doc_id", "seg")).applyInArrow(paths, "block_id bigint, section_path array<string>")


def deepest_heading(path: Column, pattern: str) -> Column:
    """The deepest heading of the path that matches, else the last one; 'unknown' for an empty path."""
    match = F.filter(F.reverse(path), lambda h: F.lower(h).rlike(pattern))
    return F.coalesce(F.try_element_at(match, F.lit(1)), F.try_element_at(path, F.lit(-1)), F.lit("unknown"))


def tree_search(tree: DataFrame, query: str) -> DataFrame:
    """The nodes of a section tree (doc_id, path) whose label contains the query, case aside, and all nodes above them."""
    hits = tree.where(F.contains(F.lower(F.element_at("path", -1)), F.lit(query.strip().lower())))
    above = hits.select("doc_id", F.explode(F.sequence(F.lit(1), F.size("path"))).alias("k"), F.col("path").alias("whole")).select("doc_id", F.slice("whole", F.lit(1), F.col("k")).alias("path")).distinct()
    return tree.join(above, ["doc_id", "path"], "left_semi")


def template_sections(sections: DataFrame) -> DataFrame:
    """`sections` with m11_section (longest prefix of the section number in the template) and functional_label."""
    known = sections.withColumn("m11_section", lookups.longest_prefix(F.col("section_number"), lookups.TEMPLATE_SECTIONS))
    return known.withColumn("functional_label", lookups.longest_prefix_value(F.col("m11_section"), lookups.FUNCTIONAL_LABELS))


def section_index(sections: DataFrame) -> DataFrame:
    """doc_id, page_num, order_index, path, depth: an entry per heading whose path differs from the entry before."""
    headings = sections.where("block_type = 'heading'")
    before = neighbour(headings, {"__before": F.col("section_path")}, -1)
    changed = before.where(F.col("__before").isNull() | (F.col("__before") != F.col("section_path")))
    return changed.select("doc_id", "page_num", "order_index", "section_path", "section_depth")


def section_tree(sections: DataFrame) -> DataFrame:
    """doc_id, path, depth, n_blocks (in the path itself), n_below (with its descendants), first_page."""
    own = sections.where(F.size("section_path") > 0).groupBy("doc_id", "section_path").agg(F.count("*").alias("n"), F.min("page_num").alias("page"))
    prefixes = F.sequence(F.lit(1), F.size("section_path"))
    spread = own.select("doc_id", "n", "page", "section_path", F.explode(prefixes).alias("k")).withColumn("path", F.slice("section_path", F.lit(1), F.col("k")))
    itself = F.sum(F.when(F.col("k") == F.size("section_path"), F.col("n")).otherwise(0))
    return spread.groupBy("doc_id", "path").agg(itself.alias("n_blocks"), F.sum("n").alias("n_below"), F.min("page").alias("first_page")).withColumn("depth", F.size("path"))


def template_coverage(sections: DataFrame) -> DataFrame:
    """doc_id, n_present, n_missing, percent: how many of the template's top sections each document has."""
    tops = [k for k in lookups.TEMPLATE_SECTIONS if "." not in k]
    top = F.split("m11_section", r"\.")[0]
    present = F.count_distinct(F.when(top.isin(tops), top))
    found = sections.groupBy("doc_id").agg(present.alias("n_present"))
    return found.withColumns({"n_missing": F.lit(len(tops)) - F.col("n_present"), "percent": F.round(100 * F.col("n_present") / len(tops), 1)})
