"""Queries on page layout and adapters of landed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.functions import lookups
from leafwork.functions import text as T
from leafwork.operators import layout, nested, records
from leafwork.plans.nested import payload_nodes
from leafwork.plans.registry import Registry
from leafwork.plans.sections import BLOCKS_SQL, blocks
from leafwork.sources import adapters
from leafwork.sources.tables import table

registry = Registry()

_FEATURES_SQL = rf"""{BLOCKS_SQL},
sized AS (SELECT *, coalesce(greatest(0, (bbox.x1 - bbox.x0) * (bbox.y1 - bbox.y0)), 0) AS area, CASE WHEN coalesce(block_type <> 'figure', true) THEN text END AS body FROM blocks),
sums AS (
  SELECT doc_id, page_num, count(*) AS n_blocks, coalesce(sum(length(regexp_replace(body, '^[\s\v]+|[\s\v]+$', '', 'g'))), 0) AS char_count, coalesce(sum(length(regexp_replace(body, '[^\p{{L}}\x20-\x7E\t\n\r\x0B\x0C]', '', 'g'))), 0) AS good,
    coalesce(sum(length(body)), 0) AS n_all, count(*) FILTER (WHERE block_type = 'figure') AS image_count, coalesce(sum(area) FILTER (WHERE block_type = 'figure'), 0) AS image_area,
    count(*) FILTER (WHERE block_type = 'table') AS table_count, coalesce(max(area) FILTER (WHERE block_type = 'table'), 0) AS table_area FROM sized GROUP BY ALL),
features AS (
  SELECT *, char_count / 484704.0 AS char_density, least(image_area / 484704.0, 1.0) AS image_coverage, table_area / 484704.0 AS max_table_share, CASE WHEN n_all > 0 THEN good / n_all ELSE 0 END AS confidence,
    char_count = 0 OR (char_count / 484704.0 < 0.0005 AND least(image_area / 484704.0, 1.0) > 0.2) AS is_scanned FROM sums)"""
_COLUMNS_SQL = """
bins AS (SELECT doc_id, page_num, least(CAST(floor(bbox.x0 / 612.0 * 10) AS INTEGER), 9) AS bin, count(*) AS n FROM blocks WHERE bbox.x1 > bbox.x0 GROUP BY ALL),
steps AS (SELECT *, bin - lag(bin) OVER (PARTITION BY doc_id, page_num ORDER BY bin) AS step FROM bins WHERE n >= 2),
columns AS (
  SELECT t.doc_id, t.page_num, CAST(CASE WHEN t.total < 4 OR s.n IS NULL THEN 1 ELSE s.n + 1 END AS INTEGER) AS columns
  FROM (SELECT doc_id, page_num, sum(n) AS total FROM bins GROUP BY ALL) t LEFT JOIN (SELECT doc_id, page_num, count(*) FILTER (WHERE step > 1) AS n FROM steps GROUP BY ALL) s USING (doc_id, page_num))"""


@registry.add(
    "page_features",
    f"""WITH {_FEATURES_SQL} SELECT doc_id, page_num, n_blocks, CAST(char_count AS BIGINT) AS char_count, image_count, table_count, round(char_density, 8) AS char_density,
    round(image_coverage, 6) AS image_coverage, round(max_table_share, 6) AS max_table_share, round(confidence, 6) AS confidence, is_scanned FROM features""",
)
def page_features(spark: SparkSession, root: str) -> DataFrame:
    out = layout.page_features(blocks(spark, root))
    return out.select(
        "doc_id", "page_num", "n_blocks", "char_count", "image_count", "table_count", F.round("char_density", 8).alias("char_density"), F.round("image_coverage", 6).alias("image_coverage"),
        F.round("max_table_share", 6).alias("max_table_share"), F.round("confidence", 6).alias("confidence"), "is_scanned",
    )


@registry.add("column_estimate", f"WITH {BLOCKS_SQL}, {_COLUMNS_SQL} SELECT doc_id, page_num, columns FROM columns")
def column_estimate(spark: SparkSession, root: str) -> DataFrame:
    return layout.column_estimate(blocks(spark, root))


@registry.add(
    "page_routes",
    f"""WITH {_FEATURES_SQL}, {_COLUMNS_SQL} SELECT doc_id, page_num, CASE WHEN is_scanned OR char_count = 0 OR confidence < 0.7 THEN 'qwen_vl' ELSE 'pdfplumber' END AS primary_route,
    is_scanned OR char_count = 0 OR confidence < 0.7 AS remote_required FROM features LEFT JOIN columns USING (doc_id, page_num)""",
)
def page_routes(spark: SparkSession, root: str) -> DataFrame:
    rows = blocks(spark, root)
    features = layout.page_features(rows).join(layout.column_estimate(rows), ["doc_id", "page_num"], "left").fillna(1, ["columns"])
    return layout.route(features).select("doc_id", "page_num", "primary_route", "remote_required")


_WHY_SQL = """CASE WHEN is_scanned OR char_count = 0 OR confidence < 0.7 THEN '{0}' END, CASE WHEN table_count >= 1 THEN table_count || ' table region(s)' END, CASE WHEN coalesce(columns, 1) >= 2 THEN columns || '-column' END""".format(layout.REASON_SCANNED)


@registry.add(
    "route_audit",
    f"""WITH {_FEATURES_SQL}, {_COLUMNS_SQL}, w AS (SELECT concat_ws('; ', {_WHY_SQL}) AS why FROM features LEFT JOIN columns USING (doc_id, page_num))
    SELECT 'mineru' AS primary_route, '{layout.REASON_ALL}' || CASE WHEN why = '' THEN '{layout.REASON_PLAIN}' ELSE why END AS reason, count(*) AS n FROM w GROUP BY ALL""",
)
def route_audit(spark: SparkSession, root: str) -> DataFrame:
    rows = blocks(spark, root)
    features = layout.page_features(rows).join(layout.column_estimate(rows), ["doc_id", "page_num"], "left").fillna(1, ["columns"])
    return layout.route(features, layout.Thresholds(remote=True)).groupBy("primary_route", "reason").agg(F.count("*").alias("n"))


_LEVELS_SQL = f"""{BLOCKS_SQL},
edges AS (SELECT DISTINCT doc_id, page_num, bbox.x0 AS x0 FROM blocks WHERE bbox IS NOT NULL),
marked AS (SELECT *, CASE WHEN x0 - lag(x0) OVER w <= 5 THEN 0 ELSE 1 END AS fresh FROM edges WINDOW w AS (PARTITION BY doc_id, page_num ORDER BY x0)),
stops AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, page_num ORDER BY x0) AS stop FROM marked),
firsts AS (SELECT doc_id, page_num, stop, min(x0) AS anchor FROM stops GROUP BY ALL),
anchors AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY anchor) - 1 AS lvl FROM firsts),
levels AS (
  SELECT b.block_id, b.doc_id, b.page_num, b.order_index, b.block_type, CAST(coalesce(min(a.lvl) FILTER (WHERE abs(b.bbox.x0 - a.anchor) <= 5), max(a.lvl)) AS INTEGER) AS level
  FROM blocks b JOIN anchors a USING (doc_id, page_num) WHERE b.bbox IS NOT NULL GROUP BY ALL)"""


@registry.add("indent_levels", f"WITH {_LEVELS_SQL} SELECT block_id, level FROM levels")
def indent_levels(spark: SparkSession, root: str) -> DataFrame:
    return layout.indent_levels(blocks(spark, root)).select("block_id", "level")


@registry.add(
    "indent_parents",
    f"""WITH {_LEVELS_SQL}, body AS (SELECT * FROM levels WHERE coalesce(block_type NOT IN ('header', 'footer', 'other'), true))
    SELECT o.block_id, max(u.order_index) AS parent_index FROM body o JOIN body u ON u.doc_id = o.doc_id AND u.page_num = o.page_num AND u.order_index < o.order_index AND u.level < o.level GROUP BY ALL""",
)
def indent_parents(spark: SparkSession, root: str) -> DataFrame:
    return layout.indent_parents(layout.indent_levels(blocks(spark, root)))


@registry.add(
    "contiguous_ranges",
    """WITH p AS (SELECT DISTINCT doc_id, page_num FROM extracted_blocks WHERE block_type = 'table'),
    i AS (SELECT *, page_num - row_number() OVER (PARTITION BY doc_id ORDER BY page_num) AS island FROM p)
    SELECT doc_id, min(page_num) AS first, max(page_num) AS last FROM i GROUP BY doc_id, island""",
)
def contiguous_ranges(spark: SparkSession, root: str) -> DataFrame:
    return layout.contiguous_ranges(table(spark, root, "extracted_blocks").where("block_type = 'table'"))


@registry.add(
    "outside_tables",
    f"""WITH {BLOCKS_SQL} SELECT block_id FROM blocks w WHERE bbox IS NOT NULL AND coalesce(block_type <> 'table', true) AND NOT EXISTS (
      SELECT 1 FROM blocks t WHERE t.block_type = 'table' AND t.doc_id = w.doc_id AND t.page_num = w.page_num AND t.bbox.x0 <= w.bbox.x0 AND t.bbox.y0 <= w.bbox.y0 AND t.bbox.x1 >= w.bbox.x1 AND t.bbox.y1 >= w.bbox.y1)""",
)
def outside_tables(spark: SparkSession, root: str) -> DataFrame:
    rows = blocks(spark, root)
    others = rows.where("bbox is not null and coalesce(block_type <> 'table', true)")
    return layout.outside_tables(others, rows.where("block_type = 'table' and bbox is not null")).select("block_id")


@registry.add(
    "attached_points",
    f"""WITH {BLOCKS_SQL}, points AS (SELECT block_id AS point_id, doc_id, page_num, (bbox.x0 + bbox.x1) / 2 AS x, (bbox.y0 + bbox.y1) / 2 AS y FROM blocks WHERE bbox IS NOT NULL)
    SELECT point_id, arg_min(b.block_id, (CASE b.block_type WHEN 'table' THEN 0 WHEN 'figure' THEN 1 ELSE 2 END, b.order_index, b.block_id)) AS block_id FROM points p
    JOIN blocks b ON b.doc_id = p.doc_id AND b.page_num = p.page_num AND p.x BETWEEN b.bbox.x0 AND b.bbox.x1 AND p.y BETWEEN b.bbox.y0 AND b.bbox.y1 GROUP BY point_id""",
)
def attached_points(spark: SparkSession, root: str) -> DataFrame:
    rows = blocks(spark, root)
    middle = rows.where("bbox is not null").select(F.col("block_id").alias("point_id"), "doc_id", "page_num", ((F.col("bbox.x0") + F.col("bbox.x1")) / 2).alias("x"), ((F.col("bbox.y0") + F.col("bbox.y1")) / 2).alias("y"))
    return layout.attach_points(middle, rows)


@registry.add("indent_steps", "SELECT block_id, CAST(coalesce(round_even(bbox.x0 / 12, 0) * 12, 72) AS INTEGER) AS indent FROM extracted_blocks")
def indent_steps(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "extracted_blocks").select("block_id", T.quantize_indent(F.col("bbox.x0")).alias("indent"))


@registry.add(
    "wire_blocks",
    """SELECT remote_id AS block_id, doc_id, page_num, order_index, coalesce(block_type, 'other') AS block_type, coalesce(text, '') AS text, CASE WHEN len(bbox) = 4 THEN bbox[1] END AS x0,
    CASE WHEN len(bbox) = 4 THEN bbox[4] END AS y1, json_extract_string(metadata, '$.mineru_type') AS mineru_type FROM remote_blocks""",
)
def wire_blocks(spark: SparkSession, root: str) -> DataFrame:
    rows = adapters.wire_blocks(table(spark, root, "remote_blocks"))
    return rows.select("block_id", "doc_id", "page_num", "order_index", "block_type", "text", "bbox.x0", "bbox.y1", F.get_json_object("metadata", "$.mineru_type").alias("mineru_type"))


_LABEL_SQL = " ".join(f"WHEN contains(lower(label), '{a}') THEN '{b}'" for a, b in adapters.LABELS)


@registry.add(
    "layout_labels",
    f"""WITH l AS (SELECT json_extract_string(metadata, '$.mineru_type') AS label FROM remote_blocks)
    SELECT label, CASE WHEN label IS NULL THEN NULL {_LABEL_SQL} ELSE 'other' END AS block_type, count(*) AS n FROM l GROUP BY ALL""",
)
def layout_labels(spark: SparkSession, root: str) -> DataFrame:
    label = F.get_json_object("metadata", "$.mineru_type").alias("label")
    return table(spark, root, "remote_blocks").groupBy(label).agg(F.count("*").alias("n")).select("label", adapters.block_type(F.col("label")).alias("block_type"), "n")


@registry.add("html_tables")
def html_tables(spark: SparkSession, root: str) -> DataFrame:
    cells = nested.subtype(payload_nodes(spark, root), "cell")
    return adapters.html_tables(cells, "response_id", "page_num", "parent_index")


@registry.add(
    "markdown_tables",
    f"""WITH {BLOCKS_SQL}, r AS (SELECT block_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM blocks WHERE block_type = 'table' AND text <> ''),
    c AS (SELECT block_id, i, list_transform(string_split(line, '|'), lambda x: trim(x)) AS cells, max(len(string_split(line, '|'))) OVER (PARTITION BY block_id) AS width FROM r),
    l AS (SELECT block_id, i, width, '| ' || array_to_string(list_resize(cells, width, ''), ' | ') || ' |' AS line FROM c)
    SELECT block_id, string_agg(CASE WHEN i = 1 THEN line || chr(10) || '|' || array_to_string(list_transform(range(width), lambda x: '---'), '|') || '|' ELSE line END, chr(10) ORDER BY i) AS markdown
    FROM l GROUP BY block_id""",
)
def markdown_tables(spark: SparkSession, root: str) -> DataFrame:
    rows = blocks(spark, root).where("block_type = 'table' and text <> ''")
    cells = F.transform(F.split("text", "\n", -1), lambda line: F.transform(F.split(line, r"\|", -1), lambda c: F.trim(c)))
    return rows.select("block_id", adapters.markdown_table(cells).alias("markdown"))


@registry.add(
    "prefetch_plan",
    f"""WITH {_FEATURES_SQL}, p AS (SELECT doc_id, page_num, CASE WHEN is_scanned OR char_count = 0 OR confidence < 0.7 THEN 'qwen_vl' ELSE 'pdfplumber' END AS route FROM features)
    SELECT doc_id, route, CAST(floor(page_num / 64) AS INTEGER) AS batch, string_agg(CAST(page_num AS VARCHAR), ',' ORDER BY page_num) AS pages FROM p GROUP BY ALL""",
)
def prefetch_plan(spark: SparkSession, root: str) -> DataFrame:
    plan = records.prefetch_plan(page_routes(spark, root))
    return plan.withColumn("pages", F.array_join(F.col("pages").cast("array<string>"), ","))


_REPAIRS = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in lookups.REPAIRED_TYPES.items())
# The tables hold none of the layout types that are repaired, so some records are given one.
_GIVEN = "CASE remote_id % 5 WHEN 0 THEN 'Table_Caption' WHEN 1 THEN 'page-number' WHEN 2 THEN json_extract_string(metadata, '$.mineru_type') WHEN 3 THEN 'table_footnote' END"


@registry.add("repaired_types", f"SELECT remote_id, coalesce(CASE lower({_GIVEN}) {_REPAIRS} END, block_type) AS block_type FROM remote_blocks")
def repaired_types(spark: SparkSession, root: str) -> DataFrame:
    given = F.expr(_GIVEN.replace("json_extract_string", "get_json_object"))
    return records.repaired_types(table(spark, root, "remote_blocks"), given).select("remote_id", "block_type")


_SIZES = "length(coalesce(text, '')) % 9 + 7.0"
_TOP = "bbox.y0"


@registry.add(
    "font_classes",
    rf"""WITH s AS (SELECT block_id, trim(regexp_replace(text, '^[\s\v\p{{Z}}\x{{0085}}]+|[\s\v\p{{Z}}\x{{0085}}]+$', '', 'g')) AS t, CASE WHEN block_id % 11 > 0 THEN {_SIZES} END AS size, {_TOP} / 792.0 AS top FROM extracted_blocks),
    f AS (SELECT *, CASE WHEN coalesce(length(t), 0) = 0 THEN 'other' WHEN size IS NULL THEN 'paragraph' WHEN size >= 10.0 * 1.15 AND length(t) < 250 THEN 'heading' WHEN length(t) < 200 AND t[1:2] IN ('- ', '* ', '• ') THEN 'list' ELSE 'paragraph' END AS font FROM s)
    SELECT block_id, CASE WHEN font = 'other' THEN font WHEN length(t) < 120 AND NOT contains(t, chr(10)) AND top < 0.05 THEN 'header' WHEN length(t) < 120 AND NOT contains(t, chr(10)) AND top > 0.95 THEN 'footer'
      WHEN font = 'paragraph' AND size <= 10.0 * 0.92 AND top >= 0.7 THEN 'footnote' ELSE font END AS block_type FROM f""",
)
def font_classes(spark: SparkSession, root: str) -> DataFrame:
    size = F.expr(f"CASE WHEN block_id % 11 > 0 THEN cast({_SIZES} as double) END")
    return table(spark, root, "extracted_blocks").select("block_id", layout.font_class(size, F.lit(10.0), F.col("text"), F.expr(_TOP)).alias("block_type"))


# Segments of our own, drawn over the boxes of the blocks: two legs that meet in the upper left corner of every box, some apart.


@registry.add(
    "arrowheads",
    """WITH b AS (SELECT block_id, doc_id, page_num, bbox.x0 AS x, bbox.y0 AS y, CAST(block_id % 17 + 1 AS DOUBLE) AS w, CAST(block_id % 7 + 1 AS DOUBLE) AS h FROM extracted_blocks WHERE bbox IS NOT NULL AND doc_id IS NOT NULL AND page_num IS NOT NULL),
    seg AS (SELECT doc_id, page_num, block_id * 2 AS id, x AS x0, y AS y0, x + w AS x1, y + h AS y1 FROM b UNION ALL SELECT doc_id, page_num, block_id * 2 + 1, x + w, y - h, x + (block_id % 3) * 0.4, y FROM b),
    legs AS (SELECT *, sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS size FROM seg),
    short AS (SELECT * FROM legs WHERE size BETWEEN 3 AND 20 AND abs(x1 - x0) >= 0.5 AND abs(y1 - y0) >= 0.5),
    ends AS (
      SELECT doc_id, page_num, id, 0 AS e, size, x0 AS x, y0 AS y, (x1 - x0) / size AS vx, (y1 - y0) / size AS vy FROM short
      UNION ALL SELECT doc_id, page_num, id, 1, size, x1, y1, (x0 - x1) / size, (y0 - y1) / size FROM short),
    keyed AS (SELECT *, CAST(trunc(x) AS INTEGER) AS bx, CAST(trunc(y) AS INTEGER) AS by FROM ends),
    met AS (
      SELECT a.doc_id, a.page_num, a.id AS a, b.id AS b, (a.x + b.x) / 2 AS x, (a.y + b.y) / 2 AS y, (a.size + b.size) / 2 AS leg, row_number() OVER (PARTITION BY a.doc_id, a.page_num, a.id, b.id ORDER BY a.e, b.e) AS k,
        degrees(acos(greatest(-1.0, least(1.0, a.vx * b.vx + a.vy * b.vy)))) AS angle, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS apart
      FROM keyed a JOIN keyed b ON a.doc_id = b.doc_id AND a.page_num = b.page_num AND a.bx = b.bx AND a.by = b.by AND (a.id, a.e) < (b.id, b.e) AND a.id <> b.id)
    SELECT doc_id, page_num, a, b, round(min(x), 4) AS x, round(min(y), 4) AS y, round(min(leg), 4) AS leg FROM met WHERE apart <= 1 AND angle BETWEEN 20 AND 170 GROUP BY ALL""",
)
def arrowheads(spark: SparkSession, root: str) -> DataFrame:
    return layout.arrowheads(_segments(spark, root)).select("doc_id", "page_num", "a", "b", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round("leg", 4).alias("leg"))


def _segments(spark: SparkSession, root: str) -> DataFrame:
    b = table(spark, root, "extracted_blocks").where("bbox is not null and doc_id is not null and page_num is not null").selectExpr("block_id", "doc_id", "page_num", "bbox.x0 x", "bbox.y0 y", "cast(block_id % 17 + 1 as double) w", "cast(block_id % 7 + 1 as double) h")
    one = b.selectExpr("doc_id", "page_num", "block_id * 2 segment_id", "x x0", "y y0", "x + w x1", "y + h y1")
    return one.unionByName(b.selectExpr("doc_id", "page_num", "block_id * 2 + 1 segment_id", "x + w x0", "y - h y0", "x + (block_id % 3) * cast(0.4 as double) x1", "y y1"))


# Pairing is greedy, so there is no SQL; tests hold it against the rule as a state machine.
@registry.add("arrows")
def arrows(spark: SparkSession, root: str) -> DataFrame:
    return layout.pair_arrows(layout.arrowheads(_segments(spark, root)))
