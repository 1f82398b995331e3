"""Queries on annotations and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.operators import annotate, indexes, nested
from leafwork.plans import chunks as chunk_plans
from leafwork.plans.chunks import _INDEX_SQL, _USES_SQL, spans_sql
from leafwork.plans.nested import payload_nodes
from leafwork.plans.registry import Registry
from leafwork.plans.sections import BLOCKS_SQL, blocks
from leafwork.plans.texts import decorated
from leafwork.sources import adapters
from leafwork.sources.tables import table

registry = Registry()


def _texts(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "extracted_blocks").where("text <> ''").select("block_id", "text")


def _cues_sql(kinds: tuple[tuple[str, str], ...], source: str, flag: str = "(?i)") -> str:
    return " UNION ALL ".join(f"SELECT *, '{kind}' AS kind FROM ({spans_sql(source, flag + pattern, 'block_id', whole=bool(flag))})" for kind, pattern in kinds)


_TEXTS = "(SELECT block_id, text FROM extracted_blocks WHERE text <> '')"


@registry.add("certainty_cues", f"SELECT block_id, kind, start_pos, end_pos, surface FROM ({_cues_sql(annotate.CERTAINTY, _TEXTS)})")
def certainty_cues(spark: SparkSession, root: str) -> DataFrame:
    return annotate.cues(_texts(spark, root), annotate.CERTAINTY)


@registry.add("temporal_expressions", f"SELECT block_id, kind, start_pos, end_pos, surface FROM ({_cues_sql(annotate.TIMES, _TEXTS)})")
def temporal_expressions(spark: SparkSession, root: str) -> DataFrame:
    return annotate.cues(_texts(spark, root), annotate.TIMES)


@registry.add("citations", f"SELECT block_id, kind, start_pos, end_pos, surface FROM ({_cues_sql(annotate.CITATIONS, _TEXTS, '')})")
def citations(spark: SparkSession, root: str) -> DataFrame:
    return annotate.cues(_texts(spark, root), annotate.CITATIONS, ignore_case=False)


@registry.add(
    "boilerplate_scores",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM extracted_blocks WHERE text IS NOT NULL),
    k AS (SELECT doc_id, regexp_replace(lower(line), '[\s\v\x{00A0}\d]+', '', 'g') AS line FROM l), n AS (SELECT doc_id, line, count(*) AS n FROM k WHERE line <> '' GROUP BY ALL),
    o AS (SELECT line, count(*) AS docs FROM n GROUP BY line)
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines, round(sum(CASE WHEN docs >= 3 THEN n ELSE 0 END) / sum(n), 6) AS boilerplate FROM n JOIN o USING (line) GROUP BY doc_id""",
)
def boilerplate_scores(spark: SparkSession, root: str) -> DataFrame:
    return annotate.boilerplate_scores(table(spark, root, "extracted_blocks"))


@registry.add("language_purity")
def language_purity(spark: SparkSession, root: str) -> DataFrame:
    return annotate.language_purity(table(spark, root, "documents"))


@registry.add("payload_tables")
def payload_tables(spark: SparkSession, root: str) -> DataFrame:
    cells = nested.subtype(payload_nodes(spark, root), "cell")
    return annotate.table_structure(cells, "response_id", "page_num", "parent_index")


# Tables as text: a line is a row, a bar parts cells; a cell of nothing but digits and signs spans none, one that is empty joins the one before.
def _text_cells(spark: SparkSession, root: str) -> DataFrame:
    lines = blocks(spark, root).where("block_type = 'table' and text <> ''").select("block_id", F.posexplode(F.split("text", "\n", -1)).alias("row", "line"))
    cells = lines.select("block_id", "row", F.posexplode(F.split("line", r"\|", -1)).alias("col", "text"))
    wide = F.when((F.col("block_id") % 7 == 0) & (F.col("row") == 0) & (F.col("col") == 0), 2)
    return cells.select("block_id", "row", "col", F.lit(None).cast("int").alias("row_span"), wide.alias("col_span"), (F.col("row") == 0).alias("is_header"), F.trim("text").alias("text"))


_CELLS_SQL = f"""{BLOCKS_SQL},
    lines AS (SELECT block_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS row, unnest(string_split(text, chr(10))) AS line FROM blocks WHERE block_type = 'table' AND text <> ''),
    cells AS (SELECT block_id, row, generate_subscripts(string_split(line, '|'), 1) - 1 AS col, trim(unnest(string_split(line, '|')), ' ') AS text FROM lines),
    told AS (SELECT *, CASE WHEN block_id % 7 = 0 AND row = 0 AND col = 0 THEN 2 ELSE 1 END AS span FROM cells)"""


@registry.add(
    "table_structure",
    f"""WITH {_CELLS_SQL} SELECT block_id, CAST(max(row) + 1 AS INTEGER) AS n_rows, CAST(max(col + span) AS INTEGER) AS n_cols, count(DISTINCT row) FILTER (WHERE row = 0) AS header_rows,
    count(*) FILTER (WHERE span > 1) AS n_merged FROM told GROUP BY block_id""",
)
def table_structure(spark: SparkSession, root: str) -> DataFrame:
    return annotate.table_structure(_text_cells(spark, root), "block_id")


@registry.add(
    "text_table_html",
    f"""WITH {_CELLS_SQL}, free AS (SELECT * FROM told WHERE NOT (block_id % 7 = 0 AND row = 0 AND col = 1)),
    e AS (SELECT *, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS t, CASE WHEN row = 0 THEN 'th' ELSE 'td' END AS tag FROM free),
    r AS (SELECT block_id, row, '<tr>' || string_agg('<' || tag || CASE WHEN span > 1 THEN ' colspan="2"' ELSE '' END || '>' || t || '</' || tag || '>', '' ORDER BY col) || '</tr>' AS line FROM e GROUP BY ALL)
    SELECT block_id, '<table>' || string_agg(line, '' ORDER BY row) || '</table>' AS html FROM r GROUP BY block_id""",
)
def text_table_html(spark: SparkSession, root: str) -> DataFrame:
    return adapters.html_tables(_text_cells(spark, root), "block_id")


@registry.add(
    "co_occurring",
    f"WITH {_INDEX_SQL}, e AS (SELECT block_id, target_id AS other_id FROM resolved_uses WHERE target_id IS NOT NULL AND target_id <> block_id) SELECT * FROM e UNION SELECT other_id, block_id FROM e",
)
def co_occurring(spark: SparkSession, root: str) -> DataFrame:
    return annotate.co_occurring(chunk_plans.resolved_mentions(spark, root))


_KINDS_SQL = {
    "negation": chunk_plans._CUES_SQL, "certainty": _cues_sql(annotate.CERTAINTY, "told"), "temporal": _cues_sql(annotate.TIMES, "told"), "acronym": "SELECT block_id FROM uses",
    "citation": _cues_sql(annotate.CITATIONS, "told", ""),
}


@registry.add(
    "annotation_counts",
    f"WITH {_USES_SQL} " + " UNION ALL ".join(f"SELECT '{kind}' AS kind, count(*) AS n, count(DISTINCT block_id) AS n_blocks FROM ({sql})" for kind, sql in _KINDS_SQL.items()),
)
def annotation_counts(spark: SparkSession, root: str) -> DataFrame:
    told = decorated(spark, root)
    return annotate.telemetry({
        "negation": indexes.negation_cues(told), "certainty": annotate.cues(told, annotate.CERTAINTY), "temporal": annotate.cues(told, annotate.TIMES),
        "acronym": indexes.acronym_uses(told, indexes.acronym_definitions(told)), "citation": annotate.cues(told, annotate.CITATIONS, ignore_case=False),
    })


RULES = {
    "key": "block_id is not null and doc_id is not null", "page": "page_num >= 0", "order": "order_index >= 0",
    "type": "block_type in ('heading', 'paragraph', 'list', 'table', 'figure', 'caption', 'footnote', 'header', 'footer', 'other')", "box": "bbox is null or (bbox.x1 >= bbox.x0 and bbox.y1 >= bbox.y0)",
    "text": "text is not null",
}


@registry.add(
    "conformance",
    " UNION ALL ".join(f"SELECT '{name}' AS rule, count(*) AS n_checked, count(*) FILTER (WHERE NOT coalesce({rule}, false)) AS n_failed FROM extracted_blocks" for name, rule in RULES.items()),
)
def conformance(spark: SparkSession, root: str) -> DataFrame:
    return annotate.conformance(table(spark, root, "extracted_blocks"), RULES)


@registry.add(
    "mentioned_conditions",
    """SELECT nct_id AS key, condition AS value, coalesce(bool_or(contains(lower(b.text), lower(condition))), false) AS hit
    FROM (SELECT DISTINCT nct_id, condition FROM manifest WHERE condition IS NOT NULL) m LEFT JOIN extracted_blocks b ON b.doc_id = m.nct_id GROUP BY ALL""",
)
def mentioned_conditions(spark: SparkSession, root: str) -> DataFrame:
    values = table(spark, root, "manifest").select(F.col("nct_id").alias("key"), F.col("condition").alias("value"))
    return annotate.mentioned(values, table(spark, root, "extracted_blocks").select(F.col("doc_id").alias("key"), "block_id", "text"))


@registry.add(
    "document_overview",
    """SELECT doc_id, count(*) AS n_blocks, count(DISTINCT page_num) AS n_pages, count(*) FILTER (WHERE block_type = 'heading') AS n_headings, count(*) FILTER (WHERE block_type = 'table') AS n_tables,
    count(*) FILTER (WHERE block_type = 'figure') AS n_figures, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_characters FROM extracted_blocks GROUP BY doc_id""",
)
def document_overview(spark: SparkSession, root: str) -> DataFrame:
    kind = lambda t: F.count_if(F.col("block_type") == t)
    return table(spark, root, "extracted_blocks").groupBy("doc_id").agg(
        F.count("*").alias("n_blocks"), F.count_distinct("page_num").alias("n_pages"), kind("heading").alias("n_headings"), kind("table").alias("n_tables"), kind("figure").alias("n_figures"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_characters"),
    )
