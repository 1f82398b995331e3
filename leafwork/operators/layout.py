"""Page layout: page signals and routing, font and position classes, columns, indents, paragraphs and geometry."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafwork.functions import text as T


# The reasons a routing decision is explained with.
REASON_ALL, REASON_PLAIN, REASON_SCANNED = "route-all-to-MinerU: ", "plain prose", "scanned/garbage-text"
REASON_VISION, REASON_SKIPPED = "VLM required (scanned/garbage-text)", " — remote not configured, page will be skipped"
REASON_LEGACY, REASON_LOCAL = "structure-aware (Docling legacy path)", "structure-aware locally (no remote available)"


@dataclass(frozen=True)
class Thresholds:
    """Limits of page routing; the defaults are those of the reference rules."""

    text_confidence: float = 0.7
    tables: int = 1
    columns: int = 2
    scanned_density: float = 0.0005
    scanned_coverage: float = 0.2
    remote: bool = False
    layout_model: bool = True


def box_area(box: Column) -> Column:
    return F.greatest(F.lit(0.0), (box["x1"] - box["x0"]) * (box["y1"] - box["y0"]))


def contains(outer: Column, inner: Column) -> Column:
    return (outer["x0"] <= inner["x0"]) & (outer["y0"] <= inner["y0"]) & (outer["x1"] >= inner["x1"]) & (outer["y1"] >= inner["y1"])


def intersects(a: Column, b: Column) -> Column:
    """Boxes that share a point; boxes that only touch do not."""
    return (a["x0"] < b["x1"]) & (b["x0"] < a["x1"]) & (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])


def page_features(blocks: DataFrame, width: float = 612.0, height: float = 792.0) -> DataFrame:
    """doc_id, page_num, n_blocks, char_count, char_density, image_count, image_coverage, table_count, max_table_share,
    confidence, is_scanned: signals of each page from its blocks. Blocks without a box or text count as empty."""
    area = width * height
    size = F.coalesce(box_area(F.col("bbox")), F.lit(0.0))
    figure, table = F.col("block_type") == "figure", F.col("block_type") == "table"
    body = F.when(~F.coalesce(figure, F.lit(False)), F.col("text"))
    letters = F.length(F.regexp_replace(body, r"[^\p{L}\x20-\x7E\t\n\r\x0B\x0C]", ""))
    per = blocks.groupBy("doc_id", "page_num").agg(
        F.count("*").alias("n_blocks"), F.coalesce(F.sum(F.length(F.regexp_replace(body, r"^\s+|\s+$", ""))), F.lit(0)).alias("char_count"), F.coalesce(F.sum(letters), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.length(body)), F.lit(0)).alias("all"), F.count_if(figure).alias("image_count"), F.coalesce(F.sum(F.when(figure, size)), F.lit(0.0)).alias("image_area"),
        F.count_if(table).alias("table_count"), F.coalesce(F.max(F.when(table, size)), F.lit(0.0)).alias("table_area"),
    )
    out = per.withColumns({
        "char_density": F.col("char_count") / area, "image_coverage": F.least(F.col("image_area") / area, F.lit(1.0)), "max_table_share": F.col("table_area") / area,
        "confidence": F.when(F.col("all") > 0, F.col("good") / F.col("all")).otherwise(0.0),
    })
    limits = Thresholds()
    scanned = (F.col("char_count") == 0) | ((F.col("char_density") < limits.scanned_density) & (F.col("image_coverage") > limits.scanned_coverage))
    return out.withColumn("is_scanned", scanned).drop("good", "all", "image_area", "table_area")


def column_estimate(blocks: DataFrame, width: float = 612.0) -> DataFrame:
    """doc_id, page_num, columns: left edges in ten bins over the page, bins of two or more blocks, runs of such bins.

    Pages with fewer than four boxed blocks have one column.
    """
    boxed = blocks.where("bbox.x1 > bbox.x0").withColumn("bin", F.least(F.floor(F.col("bbox.x0") / width * 10), F.lit(9)).cast("int"))
    bins = boxed.groupBy("doc_id", "page_num", "bin").agg(F.count("*").alias("n"))
    totals = bins.groupBy("doc_id", "page_num").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.when(F.col("n") >= 2, F.col("bin")))).alias("full"))
    gaps = F.size(F.filter(F.transform("full", lambda b, i: F.when(i > 0, b - F.element_at("full", F.greatest(i, F.lit(1))))), lambda d: d > 1))
    return totals.select("doc_id", "page_num", F.when((F.col("total") < 4) | (F.size("full") == 0), 1).otherwise(gaps + 1).alias("columns"))


def route(features: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """`features` (with columns) and primary_route, fallback_routes, reason, remote_required: first rule that fits."""
    has_tables, many = F.col("table_count") >= limits.tables, F.col("columns") >= limits.columns
    vision = F.col("is_scanned") | (F.col("char_count") == 0) | (F.col("confidence") < limits.text_confidence)
    if limits.layout_model and limits.remote:
        why = F.concat_ws("; ", F.when(vision, REASON_SCANNED), F.when(has_tables, F.concat("table_count", F.lit(" table region(s)"))), F.when(many, F.concat("columns", F.lit("-column"))))
        why = F.concat(F.lit(REASON_ALL), F.when(why == "", REASON_PLAIN).otherwise(why))
        return features.withColumns({"primary_route": F.lit("mineru"), "fallback_routes": F.lit("pymupdf"), "reason": why, "remote_required": F.lit(True)})
    rest, fallback = ("docling", "pdfplumber,pymupdf") if limits.remote else ("pdfplumber", "pymupdf")
    note = "" if limits.remote else REASON_SKIPPED
    local = REASON_LEGACY if limits.remote else REASON_LOCAL
    return features.withColumns({
        "primary_route": F.when(vision, "qwen_vl").otherwise(rest), "fallback_routes": F.when(vision, "").otherwise(fallback),
        "reason": F.when(vision, REASON_VISION + note).otherwise(local), "remote_required": F.when(vision, True).otherwise(limits.remote),
    })


_STRIPPED = r"(?U)^\s+|\s+$"


def body_font_size(spans: DataFrame) -> DataFrame:
    """doc_id, page_num, body_size: the median font size weighted by the characters of the trimmed texts."""
    length = F.length(F.regexp_replace("text", _STRIPPED, ""))
    kept = spans.withColumn("__n", length).where("__n > 0 and size > 0")
    return kept.groupBy("doc_id", "page_num").agg(F.expr("percentile(size, 0.5, __n)").alias("body_size"))


def font_class(size: Column, body: Column, text: Column, y0: Column, height: float = 792.0) -> Column:
    """Block class from the largest font size and the top of the box.

    By font first: heading, list, paragraph. A short line at the very top or bottom is page furniture whatever its font;
    a paragraph in small type low on the page is a footnote. An empty text is other, one without sizes a paragraph.
    """
    bare = F.regexp_replace(text, _STRIPPED, "")
    heading = (body > 0) & (size >= body * 1.15) & (F.length(bare) < 250)
    bullet = (F.length(bare) < 200) & F.substring(bare, 1, 2).isin("- ", "* ", "• ")
    font = F.when(F.coalesce(F.length(bare), F.lit(0)) == 0, "other").when(size.isNull(), "paragraph").when(heading, "heading").when(bullet, "list").otherwise("paragraph")
    short, top = (F.length(bare) < 120) & ~F.contains(bare, F.lit("\n")), y0 / height
    small = (font == "paragraph") & (body > 0) & (size <= body * 0.92) & (top >= 0.7)
    return F.when(font == "other", font).when(short & (top < 0.05), "header").when(short & (top > 0.95), "footer").when(small, "footnote").otherwise(font)


def figures(images: DataFrame, width: float = 612.0, height: float = 792.0, least: float = 0.005) -> DataFrame:
    """The images (with a box) that take at least this share of their page; smaller ones are logos and rules."""
    return images.where(box_area(F.col("bbox")) >= least * width * height)


def _by_page(rows: DataFrame, columns: list[str], work: Callable[[list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """doc_id, page_num and what `work` makes of the rows of each page (`columns`, sorted by the first of them).

    Pages are walked one after another in sorted partitions, so that a small page costs no call of its own.
    """
    fields = [f.split() for f in f"doc_id string, page_num int, {schema}".split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, held = None, []

        def close() -> list[tuple]:
            return [(*page, *r) for r in work(held)] if held else []

        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != page:
                    out += close()
                    page, held = row[:2], []
                held.append(row[2:])
            yield _batch(out, fields, kinds)
        yield _batch(close(), fields, kinds)

    sorted_ = rows.select("doc_id", F.col("page_num").cast("int"), *columns).repartition("doc_id", "page_num").sortWithinPartitions("doc_id", "page_num", columns[0])
    return sorted_.mapInArrow(run, f"doc_id string, page_num int, {schema}")


def _batch(rows: list[tuple], fields: list[list[str]], kinds: dict) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def paragraphs(words: DataFrame) -> DataFrame:
    """doc_id, page_num, paragraph, line, text: words (word_no, top, bottom, text) to lines to paragraphs.

    A word begins a line when its top differs by more than 3 points from that of the line's first word; a line begins a
    paragraph when the gap above exceeds 1.8 times the page's usual gap and 6 points. The usual gap is the upper median of
    the positive ones, 4 if there are none. Which word begins a line depends on the line before, so a page is walked in
    Python; a page bounds the group.
    """

    def walk(page: list[tuple]) -> list[tuple]:
        lines: list[list] = []
        for _, top, bottom, text in page:
            if not lines or abs(top - lines[-1][0]) > 3:
                lines.append([top, bottom, [text]])
            else:
                lines[-1][1] = max(lines[-1][1], bottom)
                lines[-1][2].append(text)
        gaps = [b[0] - a[1] for a, b in zip(lines, lines[1:])]
        usual = sorted(g for g in gaps if g > 0)
        least = max((usual[len(usual) // 2] if usual else 4.0) * 1.8, 6.0)
        number, out = 0, []
        for i, (_, _, texts) in enumerate(lines):
            number += i > 0 and gaps[i - 1] > least
            out.append((number, i, " ".join(texts)))
        return out

    return _by_page(words, ["word_no", "top", "bottom", "text"], walk, "paragraph int, line int, text string")


def indent_levels(blocks: DataFrame, tolerance: float = 5.0) -> DataFrame:
    """`blocks` with a box, and level: rank of the first indent stop of their page within `tolerance`.

    Left edges of a page are sorted; a gap above the tolerance starts a new stop, whose anchor is its least edge.
    """
    by_edge = Window.partitionBy("doc_id", "page_num").orderBy("x0")
    edges = blocks.where("bbox is not null").select("doc_id", "page_num", F.col("bbox.x0").alias("x0")).distinct()
    new = F.when(F.col("x0") - F.lag("x0").over(by_edge) <= tolerance, 0).otherwise(1)
    stops = edges.withColumn("new", new).withColumn("stop", F.sum("new").over(by_edge))
    anchors = stops.groupBy("doc_id", "page_num", "stop").agg(F.min("x0").alias("anchor")).groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list("anchor")).alias("anchors"))
    boxed = blocks.where("bbox is not null").join(anchors, ["doc_id", "page_num"])
    first = F.array_position(F.transform("anchors", lambda a: F.abs(F.col("bbox.x0") - a) <= tolerance), F.lit(True))
    return boxed.withColumn("level", F.when(first > 0, first - 1).otherwise(F.size("anchors") - 1).cast("int")).drop("anchors")


def indent_parents(levels: DataFrame) -> DataFrame:
    """block_id, parent_index: the last earlier block of the page at a smaller level (page furniture left out)."""
    body = levels.where(~F.coalesce(F.col("block_type").isin("header", "footer", "other"), F.lit(False)))
    own, up = body.alias("o"), body.alias("u")
    same = (F.col("o.doc_id") == F.col("u.doc_id")) & (F.col("o.page_num") == F.col("u.page_num"))
    above = same & (F.col("u.order_index") < F.col("o.order_index")) & (F.col("u.level") < F.col("o.level"))
    return own.join(up, above).groupBy(F.col("o.block_id").alias("block_id")).agg(F.max("u.order_index").alias("parent_index"))


def contiguous_ranges(pages: DataFrame, key: str = "doc_id", page: str = "page_num") -> DataFrame:
    """key, first, last: runs of consecutive page numbers."""
    distinct = pages.where(F.col(page).isNotNull()).select(key, F.col(page).alias("p")).distinct()
    island = F.col("p") - F.row_number().over(Window.partitionBy(key).orderBy("p"))
    return distinct.withColumn("island", island).groupBy(key, "island").agg(F.min("p").alias("first"), F.max("p").alias("last")).drop("island")


def outside_tables(words: DataFrame, tables: DataFrame) -> DataFrame:
    """Words (with a box) that lie fully in no table box of their page: a spatial anti join with the page as its key."""
    w, t = words.alias("w"), tables.select("doc_id", "page_num", F.col("bbox").alias("table_box")).alias("t")
    inside = (F.col("w.doc_id") == F.col("t.doc_id")) & (F.col("w.page_num") == F.col("t.page_num")) & contains(F.col("t.table_box"), F.col("w.bbox"))
    return w.join(t, inside, "left_anti")


def attach_points(points: DataFrame, blocks: DataFrame) -> DataFrame:
    """point_id, block_id: each point (x, y) to the block of its page that holds it: a table first, then a figure, then
    the first block in order; points in no block are left out."""
    p, b = points.alias("p"), blocks.where("bbox is not null").alias("b")
    hit = (
        (F.col("p.doc_id") == F.col("b.doc_id")) & (F.col("p.page_num") == F.col("b.page_num"))
        & F.col("p.x").between(F.col("b.bbox.x0"), F.col("b.bbox.x1")) & F.col("p.y").between(F.col("b.bbox.y0"), F.col("b.bbox.y1"))
    )
    rank = F.when(F.col("b.block_type") == "table", 0).when(F.col("b.block_type") == "figure", 1).otherwise(2)
    best = F.min_by("b.block_id", F.struct(rank, F.col("b.order_index"), F.col("b.block_id"))).alias("block_id")
    return p.join(b, hit).groupBy(F.col("p.point_id").alias("point_id")).agg(best)


def arrowheads(segments: DataFrame, longest: float = 20.0, shortest: float = 3.0, near: float = 1.0, least: float = 20.0, most: float = 170.0) -> DataFrame:
    """doc_id, page_num, head_no, a, b, x, y, dx, dy, leg: pairs of short oblique segments that meet in a tip.

    `segments` has segment_id, x0, y0, x1, y1. Only segments between `shortest` and `longest` that follow no axis count.
    End points meet in a bucket of `near` (0.5 at least) and within `near` of each other, their legs open by `least` to
    `most` degrees. (x, y) is the middle of the two tips, (dx, dy) the unit vector away from the legs, leg their mean length.
    head_no counts the heads of a page by bucket as first met, then by segment; a pair that meets twice counts once.
    """
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    size, bucket = F.sqrt(dx * dx + dy * dy), max(near, 0.5)
    legs = segments.withColumn("size", size).where((F.col("size") >= shortest) & (F.col("size") <= longest) & (F.abs(dx) >= 0.5) & (F.abs(dy) >= 0.5))
    end = lambda k, x, y, ox, oy: F.struct(F.lit(k).alias("end"), F.col(x).alias("x"), F.col(y).alias("y"), ((F.col(ox) - F.col(x)) / F.col("size")).alias("vx"), ((F.col(oy) - F.col(y)) / F.col("size")).alias("vy"))
    ends = legs.select("doc_id", "page_num", "segment_id", "size", F.inline(F.array(end(0, "x0", "y0", "x1", "y1"), end(1, "x1", "y1", "x0", "y0"))))
    place = F.struct("segment_id", "end")
    keyed = ends.withColumns({"bx": (F.col("x") / bucket).cast("int"), "by": (F.col("y") / bucket).cast("int"), "at": place})
    keys = ["doc_id", "page_num", "bx", "by"]
    first = keyed.groupBy(*keys).agg(F.min("at").alias("first"))
    a, b = keyed.alias("a"), keyed.alias("b")
    pairs = a.join(b, keys).where("a.at < b.at and a.segment_id <> b.segment_id").join(first, keys)
    apart = F.sqrt((F.col("a.x") - F.col("b.x")) ** 2 + (F.col("a.y") - F.col("b.y")) ** 2)
    dot = F.col("a.vx") * F.col("b.vx") + F.col("a.vy") * F.col("b.vy")
    ux, uy = -(F.col("a.vx") + F.col("b.vx")) / 2, -(F.col("a.vy") + F.col("b.vy")) / 2
    norm = F.sqrt(ux * ux + uy * uy)
    met = pairs.select(
        "doc_id", "page_num", F.col("a.segment_id").alias("a"), F.col("b.segment_id").alias("b"), F.struct("first", "a.at", F.col("b.at").alias("bt")).alias("order"), apart.alias("apart"),
        F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))).alias("angle"), ((F.col("a.x") + F.col("b.x")) / 2).alias("x"), ((F.col("a.y") + F.col("b.y")) / 2).alias("y"),
        norm.alias("norm"), (ux / norm).alias("dx"), (uy / norm).alias("dy"), ((F.col("a.size") + F.col("b.size")) / 2).alias("leg"),
    ).where((F.col("apart") <= near) & F.col("angle").between(least, most) & (F.col("norm") >= 1e-6))
    once = met.groupBy("doc_id", "page_num", "a", "b").agg(F.min(F.struct("order", "x", "y", "dx", "dy", "leg")).alias("m"))
    number = F.row_number().over(Window.partitionBy("doc_id", "page_num").orderBy("m.order")).cast("bigint")
    return once.select("doc_id", "page_num", number.alias("head_no"), "a", "b", "m.x", "m.y", "m.dx", "m.dy", "m.leg")


def pair_arrows(heads: DataFrame, axis: float = 3.0, least: float = 10.0, shaft: float = 20.0) -> DataFrame:
    """doc_id, page_num, arrow_no, x0, y0, x1, y1, axis, two_headed: arrows from heads (head_no, x, y, dx, dy).

    Heads in their order take the nearest later unused head of the same axis that lies within `axis` of their line, at
    least `least` away, and points the opposite way. What stays single is an arrow of one head with a shaft of `shaft`
    points. Pairing depends on what was used before, so it runs page by page in Python; a page bounds the group.
    """

    def pair(rows: list[tuple]) -> list[tuple]:
        heads = [r[1:] for r in rows]
        flat = [abs(dx) >= abs(dy) for _, _, dx, dy in heads]
        used: set[int] = set()
        out: list[tuple] = []
        for i, one in enumerate(heads):
            if i in used:
                continue
            along, across = (0, 1) if flat[i] else (1, 0)
            spans = []
            for j in range(i + 1, len(heads)):
                other = heads[j]
                span = abs(one[along] - other[along])
                if j not in used and flat[j] == flat[i] and abs(one[across] - other[across]) <= axis and (one[2 + along] > 0) != (other[2 + along] > 0) and span >= least:
                    spans.append((span, j))
            if spans:
                _, j = min(spans)
                used |= {i, j}
                out.append((*one[:2], *heads[j][:2], "horizontal" if flat[i] else "vertical", True))
        for i, (x, y, dx, dy) in enumerate(heads):
            if i not in used:
                out.append((x - dx * shaft, y - dy * shaft, x, y, "horizontal" if flat[i] else "vertical", False))
        return [(k, *r) for k, r in enumerate(out)]

    return _by_page(heads, ["head_no", "x", "y", "dx", "dy"], pair, "arrow_no int, x0 double, y0 double, x1 double, y1 double, axis string, two_headed boolean")


def table_columns(cells: DataFrame, *key: str) -> DataFrame:
    """doc_id, page_num, max_cols: of each page the most distinct left edges (to a tenth of a point) of one table's cells
    (with x0); `key` tells the tables of a page apart."""
    per = cells.where("x0 is not null").groupBy("doc_id", "page_num", *key).agg(F.count_distinct(F.round("x0", 1)).alias("n"))
    return per.groupBy("doc_id", "page_num").agg(F.max("n").alias("max_cols"))


def flipped(box: Column, height: Column) -> Column:
    """A box measured from the bottom of the page as one measured from its top."""
    return F.struct(box["x0"].alias("x0"), (height - F.greatest(box["y0"], box["y1"])).alias("y0"), box["x1"].alias("x1"), (height - F.least(box["y0"], box["y1"])).alias("y1"))


def redaction_pages(marks: DataFrame, pages: DataFrame, width: float = 612.0, height: float = 792.0) -> DataFrame:
    """doc_id, n_pages, blank_pages, redaction_pages, redaction_share: dark fills over page area, per document.

    Marks have r, g, b and a box; only fills darker than 0.15 in each colour, at least 6 points high and wide and 0.2 %
    of the page count. A page is redacted above 5 % of its area.
    """
    area = width * height
    dark = (F.col("r") < 0.15) & (F.col("g") < 0.15) & (F.col("b") < 0.15)
    size = box_area(F.col("bbox"))
    wide = (F.col("bbox.x1") - F.col("bbox.x0") >= 6) & (F.col("bbox.y1") - F.col("bbox.y0") >= 6)
    per = marks.where(dark & wide & (size >= 0.002 * area)).groupBy("doc_id", "page_num").agg(F.least(F.sum(size) / area, F.lit(1.0)).alias("share"))
    joined = pages.join(per, ["doc_id", "page_num"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    return joined.groupBy("doc_id").agg(
        F.count("*").alias("n_pages"), F.count_if(F.col("char_count") == 0).alias("blank_pages"), F.count_if(F.col("share") > 0.05).alias("redaction_pages"), F.avg("share").alias("redaction_share")
    )


def text_confidence_of(blocks: DataFrame) -> DataFrame:
    return blocks.select("block_id", T.text_confidence(F.col("text")).alias("confidence"))
