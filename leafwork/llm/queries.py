"""The queries of the corpus problems over the landed tables, and the SQL of those that SQL can state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.llm import canonical, markup, names, packing, personal, repeated, scans, split, tokens
from leafwork.plans.registry import Query, Registry
from leafwork.sources.tables import table

registry = Registry()


def queries() -> dict[str, Query]:
    return dict(registry.queries)


def oracle_sql() -> dict[str, str]:
    return dict(registry.sql)


def _pieces(spark: SparkSession, root: str) -> DataFrame:
    return split.split_oversized(table(spark, root, "extracted_blocks"), table(spark, root, "size_limits"))


@registry.add("p1_pieces")
def p1_pieces(spark: SparkSession, root: str) -> DataFrame:
    return _pieces(spark, root)


@registry.add(
    "p1_found",
    r"""
    SELECT b.block_id, CASE WHEN list_max(list_transform(regexp_extract_all(b.text, '[^\s\v\x{0085}\p{Z}.;:,!?|。；：，！？、]+'), lambda x: length(x))) > l.max_size
      THEN 'hard' ELSE 'soft' END AS cut
    FROM extracted_blocks b JOIN size_limits l ON l.scope = b.block_type AND l.unit = 'character' WHERE length(b.text) > l.max_size
    """,
)
def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return split.found_oversized(_pieces(spark, root))


@registry.add("p2_found")
def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return scans.ScanNoise(table(spark, root, "extracted_blocks")).found()


@registry.add("p2_paragraphs")
def p2_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    return scans.paragraphs(scans.repaired_blocks(scans.ScanNoise(table(spark, root, "extracted_blocks"))))


@registry.add("p4_found")
def p4_found(spark: SparkSession, root: str) -> DataFrame:
    others = {"criterion": (table(spark, root, "extracted_criteria"), "criterion_id"), "block": (table(spark, root, "extracted_blocks"), "block_id")}
    return canonical.look_alikes(table(spark, root, "gold_eligibility"), others)


@registry.add("p4_canonical")
def p4_canonical(spark: SparkSession, root: str) -> DataFrame:
    sources = {"gold": ("gold_eligibility", "gold_id"), "criterion": ("extracted_criteria", "criterion_id"), "block": ("extracted_blocks", "block_id")}
    parts = [table(spark, root, name).select(F.lit(src).alias("src"), F.col(key).cast("bigint").alias("row_id"), "doc_id", "text") for src, (name, key) in sources.items()]
    return canonical.canonical_texts(reduce(DataFrame.unionByName, parts), ("src", "row_id", "doc_id"))


def _repeated(spark: SparkSession, root: str) -> repeated.RepeatedLines:
    return repeated.RepeatedLines(table(spark, root, "extracted_blocks"), table(spark, root, "manifest"))


@registry.add(
    "p7_found",
    r"""
    WITH source AS (SELECT DISTINCT nct_id, sponsor FROM manifest WHERE sponsor IS NOT NULL),
    docs AS (SELECT sponsor, count(DISTINCT doc_id) AS of_docs FROM extracted_blocks JOIN source ON nct_id = doc_id GROUP BY sponsor),
    lines AS (
      SELECT block_id, doc_id, sponsor, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line
      FROM extracted_blocks JOIN source ON nct_id = doc_id WHERE coalesce(block_type NOT IN ('heading', 'table'), true)),
    keyed AS (
      SELECT *, regexp_replace(lower(line), '[\s\v\x{0085}\p{Z}\x{200B}-\x{200D}\x{2060}\x{FEFF}\p{Nd}]+', '', 'g') AS k FROM lines
      WHERE length(regexp_replace(line, '[^\p{L}]', '', 'g')) >= 40),
    often AS (
      SELECT sponsor, k FROM keyed JOIN docs USING (sponsor) GROUP BY sponsor, k, of_docs
      HAVING count(DISTINCT doc_id) >= 5 AND count(DISTINCT doc_id) >= of_docs * 0.4)
    SELECT DISTINCT block_id, CAST(line_no AS INTEGER) AS line_no FROM keyed JOIN often USING (sponsor, k)
    """,
)
def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return _repeated(spark, root).found()


@registry.add("p7_blocks")
def p7_blocks(spark: SparkSession, root: str) -> DataFrame:
    return _repeated(spark, root).line_blocks()


@registry.add("p7_clean")
def p7_clean(spark: SparkSession, root: str) -> DataFrame:
    return _repeated(spark, root).cleaned()


def _links(spark: SparkSession, root: str) -> DataFrame:
    tables = {"manifest": (table(spark, root, "manifest"), "record_id"), "doc_metadata": (table(spark, root, "doc_metadata"), "meta_id")}
    return names.link_rows(tables, table(spark, root, "sponsor_registry"))


@registry.add("p3_found")
def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return names.found_variants(_links(spark, root))


@registry.add("p3_links")
def p3_links(spark: SparkSession, root: str) -> DataFrame:
    return _links(spark, root)


def _fields(spark: SparkSession, root: str) -> DataFrame:
    return markup.fields(table(spark, root, "remote_blocks"), table(spark, root, "gold_eligibility"))


@registry.add("p6_found")
def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return markup.found_markup(markup.dom_nodes(markup.pages(_fields(spark, root))))


@registry.add("p6_style_tree")
def p6_style_tree(spark: SparkSession, root: str) -> DataFrame:
    return markup.StyleTree(_fields(spark, root)).tree()


@registry.add("p6_clean")
def p6_clean(spark: SparkSession, root: str) -> DataFrame:
    return markup.StyleTree(_fields(spark, root)).cleaned()


@registry.add("p8_ids")
def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    return tokens.token_ids(table(spark, root, "documents"))


def _capacity(spark: SparkSession, root: str) -> int:
    limit = table(spark, root, "size_limits").where("scope = 'documents' and unit = 'token'").agg({"max_size": "min"}).first()[0]
    if limit is None:
        raise ValueError("size_limits has no token limit for documents")
    return int(limit)


@registry.add("p9_containers")
def p9_containers(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack_items(tokens.token_counts(table(spark, root, "documents")), _capacity(spark, root))


@registry.add("p9_report")
def p9_report(spark: SparkSession, root: str) -> DataFrame:
    return packing.packing_report(p9_containers(spark, root), _capacity(spark, root))


@registry.add("p10_found")
def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return personal.found_mentions(personal.mentions(table(spark, root, "documents")))


@registry.add("p10_redacted")
def p10_redacted(spark: SparkSession, root: str) -> DataFrame:
    return personal.redacted(table(spark, root, "documents"))
