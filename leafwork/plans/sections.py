"""Queries on the section hierarchy of the extracted blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.functions import lookups
from leafwork.operators import indexes, ordered, sections
from leafwork.plans.registry import Registry
from leafwork.sources.tables import table

registry = Registry()

BLOCKS_SQL = """
blocks AS (
  SELECT * FROM extracted_blocks QUALIFY row_number() OVER (PARTITION BY doc_id, page_num, order_index ORDER BY block_id) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_num, order_index) - 1 AS pos FROM blocks)"""

# The stack by intervals: a heading is open from its position to the first later heading of its depth or less.
PATHS_SQL = f"""{BLOCKS_SQL},
heads AS (
  SELECT doc_id, pos, page_num, order_index, trim(coalesce(text, '')) AS label,
    nullif(regexp_extract(trim(coalesce(text, '')), '^(\\d+(?:\\.\\d+)*)\\.?\\s+', 1), '') AS prefix FROM placed WHERE block_type = 'heading'),
numbered AS (SELECT *, CASE WHEN prefix IS NOT NULL THEN length(prefix) - length(replace(prefix, '.', '')) + 1 END AS nd FROM heads),
deep AS (
  SELECT *, coalesce(nd, coalesce(last_value(nd IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos), 0) + 1) AS depth FROM numbered),
scopes AS (
  SELECT h.*, (SELECT min(k.pos) FROM deep k WHERE k.doc_id = h.doc_id AND k.pos > h.pos AND k.depth <= h.depth) AS closed FROM deep h),
paths AS (
  SELECT p.block_id, p.doc_id, p.page_num, p.order_index, p.pos, p.block_type, p.text,
    string_agg(s.label, ' > ' ORDER BY s.pos) AS path, coalesce(max(s.depth), 0) AS depth, count(s.pos) AS n_open,
    arg_max(s.prefix, s.pos) FILTER (WHERE s.prefix IS NOT NULL) AS number
  FROM placed p LEFT JOIN scopes s ON s.doc_id = p.doc_id AND s.pos <= p.pos AND (s.closed IS NULL OR p.pos < s.closed)
  GROUP BY ALL)"""


def blocks(spark: SparkSession, root: str) -> DataFrame:
    return ordered.distinct_blocks(table(spark, root, "extracted_blocks"))


def section_rows(spark: SparkSession, root: str) -> DataFrame:
    return sections.section_paths(blocks(spark, root), sections.heading_levels(table(spark, root, "extracted_blocks")))


def joined(path) -> F.Column:
    return F.when(F.size(path) > 0, F.array_join(path, " > "))


@registry.add("section_paths", f"WITH {PATHS_SQL} SELECT block_id, path, CAST(depth AS INTEGER) AS depth, number FROM paths")
def section_paths(spark: SparkSession, root: str) -> DataFrame:
    return section_rows(spark, root).select("block_id", joined("section_path").alias("path"), F.col("section_depth").alias("depth"), F.col("section_number").alias("number"))


@registry.add(
    "heading_labels",
    r"""SELECT block_id, nullif(regexp_extract(trim(text), '^(\d+(?:\.\d+)*)\.?\s+', 1), '') AS prefix,
    trim(regexp_replace(trim(text), '^\d+(?:\.\d+)*\.?\s+', '')) AS label FROM extracted_blocks WHERE block_type = 'heading'""",
)
def heading_labels(spark: SparkSession, root: str) -> DataFrame:
    heads = table(spark, root, "extracted_blocks").where("block_type = 'heading'")
    return heads.select("block_id", sections.numeric_prefix(F.col("text")).alias("prefix"), sections.heading_label(F.col("text")).alias("label"))


@registry.add(
    "section_index",
    f"""WITH {PATHS_SQL}, h AS (SELECT *, lag(path) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM paths WHERE block_type = 'heading')
    SELECT doc_id, page_num, order_index, path, CAST(depth AS INTEGER) AS depth FROM h WHERE before IS NULL OR before <> path""",
)
def section_index(spark: SparkSession, root: str) -> DataFrame:
    index = sections.section_index(section_rows(spark, root))
    return index.select("doc_id", "page_num", "order_index", joined("section_path").alias("path"), F.col("section_depth").alias("depth"))


@registry.add(
    "section_tree",
    f"""WITH {PATHS_SQL},
    lists AS (
      SELECT p.block_id, p.doc_id, p.page_num, list(s.label ORDER BY s.pos) AS labels FROM placed p JOIN scopes s
      ON s.doc_id = p.doc_id AND s.pos <= p.pos AND (s.closed IS NULL OR p.pos < s.closed) GROUP BY ALL),
    spread AS (SELECT doc_id, page_num, len(labels) AS n, unnest(range(1, len(labels) + 1)) AS k, labels FROM lists)
    SELECT doc_id, array_to_string(labels[1:k], ' > ') AS path, CAST(k AS INTEGER) AS depth, CAST(sum(CASE WHEN k = n THEN 1 ELSE 0 END) AS BIGINT) AS n_blocks,
      count(*) AS n_below, min(page_num) AS first_page
    FROM spread GROUP BY doc_id, labels[1:k], k""",
)
def section_tree(spark: SparkSession, root: str) -> DataFrame:
    return sections.section_tree(section_rows(spark, root)).select("doc_id", joined("path").alias("path"), "depth", "n_blocks", "n_below", "first_page")


_KNOWN = ", ".join(f"'{k}'" for k in lookups.TEMPLATE_SECTIONS)
_LABELS = ", ".join(f"('{k}', '{v}')" for k, v in lookups.FUNCTIONAL_LABELS.items())
_M11_SQL = f"""{PATHS_SQL},
numbers AS (SELECT DISTINCT number FROM paths WHERE number IS NOT NULL),
cut AS (SELECT number, unnest(range(1, len(string_split(number, '.')) + 1)) AS k FROM numbers),
known AS (
  SELECT number, arg_max(prefix, k) AS m11 FROM (SELECT number, k, array_to_string(string_split(number, '.')[1:k], '.') AS prefix FROM cut)
  WHERE prefix IN ({_KNOWN}) GROUP BY number)"""


def _template(spark: SparkSession, root: str) -> DataFrame:
    return sections.template_sections(section_rows(spark, root))


@registry.add(
    "template_sections",
    f"""WITH {_M11_SQL}, labels(id, label) AS (VALUES {_LABELS})
    SELECT block_id, m11, coalesce(a.label, b.label) AS functional_label FROM paths LEFT JOIN known USING (number)
    LEFT JOIN labels a ON a.id = m11 LEFT JOIN labels b ON b.id = string_split(m11, '.')[1]""",
)
def template_sections(spark: SparkSession, root: str) -> DataFrame:
    return _template(spark, root).select("block_id", F.col("m11_section").alias("m11"), "functional_label")


@registry.add(
    "template_coverage",
    f"""WITH {_M11_SQL}, found AS (SELECT doc_id, count(DISTINCT string_split(m11, '.')[1]) AS n FROM paths LEFT JOIN known USING (number) GROUP BY doc_id)
    SELECT doc_id, n AS n_present, 11 - n AS n_missing, round(100.0 * n / 11, 1) AS percent FROM found""",
)
def template_coverage(spark: SparkSession, root: str) -> DataFrame:
    return sections.template_coverage(_template(spark, root)).select("doc_id", "n_present", "n_missing", "percent")


_LEGACY_SQL = f"""{BLOCKS_SQL},
heads AS (
  SELECT block_id, doc_id, coalesce(text, '') AS label, nullif(regexp_extract(coalesce(text, ''), '^(\\d+(?:\\.\\d+)*)\\s+', 1), '') AS num,
    row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM placed WHERE block_type = 'heading'),
steps AS (SELECT *, CASE WHEN num IS NULL THEN 0 ELSE length(num) - length(replace(num, '.', '')) + 1 END AS depth FROM heads),
stacks AS (
  WITH RECURSIVE fold AS (
    SELECT block_id, doc_id, i, [greatest(depth, 1)] AS depths, [label] AS labels FROM steps WHERE i = 1
    UNION ALL
    SELECT s.block_id, s.doc_id, s.i, list_append(f.depths[1:k], greatest(s.depth, 1)), list_append(f.labels[1:k], s.label) FROM (
      SELECT s.block_id AS id, CASE WHEN s.depth = 0 THEN len(f.depths) - 1 ELSE coalesce(list_max(list_filter(range(1, len(f.depths) + 1), lambda j: f.depths[j] < s.depth)), 0) END AS k
      FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.i = f.i + 1) n JOIN steps s ON s.block_id = n.id JOIN fold f ON f.doc_id = s.doc_id AND f.i = s.i - 1)
  SELECT * FROM fold)"""


@registry.add("legacy_paths", f"WITH {_LEGACY_SQL} SELECT block_id, array_to_string(labels, ' > ') AS path FROM stacks")
def legacy_paths(spark: SparkSession, root: str) -> DataFrame:
    return sections.legacy_paths(blocks(spark, root)).select("block_id", F.array_join("section_path", " > ").alias("path"))


@registry.add(
    "strict_heading_numbers",
    r"SELECT block_id, nullif(regexp_extract(text, '^(\d+(?:\.\d+)*)\s+', 1), '') AS number FROM extracted_blocks WHERE block_type = 'heading'",
)
def strict_heading_numbers(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "extracted_blocks").where("block_type = 'heading'").select("block_id", sections.strict_prefix(F.col("text")).alias("number"))


_GROUPS = "criteria|endpoints|population"


@registry.add(
    "section_groups",
    f"""WITH {PATHS_SQL}, g AS (SELECT doc_id, coalesce(list_filter(list_reverse(string_split(path, ' > ')), lambda h: regexp_matches(lower(h), '{_GROUPS}'))[1], string_split(path, ' > ')[-1], 'unknown') AS heading FROM paths)
    SELECT doc_id, heading, count(*) AS n FROM g GROUP BY ALL""",
)
def section_groups(spark: SparkSession, root: str) -> DataFrame:
    heading = sections.deepest_heading(F.col("section_path"), _GROUPS).alias("heading")
    return section_rows(spark, root).groupBy("doc_id", heading).agg(F.count("*").alias("n"))


@registry.add(
    "tree_search",
    f"""WITH {PATHS_SQL}, own AS (SELECT DISTINCT doc_id, string_split(path, ' > ') AS labels FROM paths WHERE path IS NOT NULL),
    nodes AS (SELECT DISTINCT doc_id, labels[1:k] AS labels FROM (SELECT doc_id, labels, unnest(range(1, len(labels) + 1)) AS k FROM own)),
    hits AS (SELECT * FROM nodes WHERE contains(lower(labels[-1]), 'criteria'))
    SELECT DISTINCT n.doc_id, array_to_string(n.labels, ' > ') AS path FROM nodes n JOIN hits h ON h.doc_id = n.doc_id AND h.labels[1:len(n.labels)] = n.labels""",
)
def tree_search(spark: SparkSession, root: str) -> DataFrame:
    return sections.tree_search(sections.section_tree(section_rows(spark, root)), " Criteria ").select("doc_id", joined("path").alias("path"))


_HINTED = ", ".join(f"('{k}', '{h}')" for k, hints in lookups.CLASS_HINTS.items() for h in hints)


@registry.add(
    "extractable_blocks",
    f"""WITH {_M11_SQL}, labels(id, label) AS (VALUES {_LABELS}), hints(label, hint) AS (VALUES {_HINTED}),
    told AS (SELECT block_id, coalesce(a.label, b.label) AS label FROM paths LEFT JOIN known USING (number) LEFT JOIN labels a ON a.id = m11 LEFT JOIN labels b ON b.id = string_split(m11, '.')[1])
    SELECT block_id, label AS functional_label, EXISTS (SELECT 1 FROM hints h WHERE h.label = t.label AND h.hint = 'EligibilityCriterion') AS eligibility FROM told t WHERE EXISTS (SELECT 1 FROM hints h WHERE h.label = t.label)""",
)
def extractable_blocks(spark: SparkSession, root: str) -> DataFrame:
    kept = indexes.extractable(_template(spark, root))
    criteria = indexes.hinted(kept, "EligibilityCriterion").select("block_id", F.lit(True).alias("e"))
    return kept.join(criteria, "block_id", "left").select("block_id", "functional_label", F.coalesce("e", F.lit(False)).alias("eligibility"))
