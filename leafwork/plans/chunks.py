"""Queries on chunks and document indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.functions import lookups
from leafwork.functions import text as T
from leafwork.operators import chunks, indexes, layout
from leafwork.operators.sections import section_paths, template_sections
from leafwork.plans.layout import _LEVELS_SQL
from leafwork.plans.registry import Registry
from leafwork.plans.sections import _KNOWN, _M11_SQL, BLOCKS_SQL, PATHS_SQL, blocks, section_rows
from leafwork.plans.texts import DECORATED_SQL, decorate, decorated
from leafwork.sources.tables import table

registry = Registry()


@registry.add("chunk_ids", f"WITH {BLOCKS_SQL} SELECT block_id, doc_id || '_p' || page_num || '_b' || order_index AS chunk_id FROM blocks")
def chunk_ids(spark: SparkSession, root: str) -> DataFrame:
    return blocks(spark, root).select("block_id", chunks.chunk_id().alias("chunk_id"))


def _remote(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "remote_blocks").withColumn("parent_block_id", F.get_json_object("metadata", "$.parent_block_id").cast("int"))


_LINKS_SQL = """links AS (
  SELECT DISTINCT doc_id, page_num, order_index, CAST(json_extract_string(metadata, '$.parent_block_id') AS INTEGER) AS parent_index, remote_id FROM remote_blocks r
  WHERE CAST(json_extract_string(metadata, '$.parent_block_id') AS INTEGER) <> order_index AND EXISTS (
    SELECT 1 FROM remote_blocks p WHERE p.doc_id = r.doc_id AND p.page_num = r.page_num AND p.order_index = CAST(json_extract_string(r.metadata, '$.parent_block_id') AS INTEGER)))"""


@registry.add("parent_links", f"WITH {_LINKS_SQL} SELECT doc_id, page_num, order_index, parent_index FROM links")
def parent_links(spark: SparkSession, root: str) -> DataFrame:
    return chunks.parent_links(_remote(spark, root))


@registry.add(
    "child_lists",
    f"""WITH {_LINKS_SQL}, d AS (SELECT DISTINCT doc_id, page_num, parent_index, order_index FROM links)
    SELECT doc_id, page_num, parent_index, string_agg(CAST(order_index AS VARCHAR), ',' ORDER BY order_index) AS children FROM d GROUP BY ALL""",
)
def child_lists(spark: SparkSession, root: str) -> DataFrame:
    lists = chunks.child_lists(chunks.parent_links(_remote(spark, root)))
    return lists.withColumn("children", F.array_join(F.col("children").cast("array<string>"), ","))


_NOTES_SQL = rf"""{DECORATED_SQL},
defs AS (
  SELECT doc_id, page_num, marker, arg_min(block_id, pos) AS definition_id, arg_min(text, pos) AS definition FROM (
    SELECT *, nullif(regexp_extract(trim(text), '{T.LEADING_MARKER}', 1), '') AS marker FROM told WHERE block_type = 'footnote') WHERE marker IS NOT NULL GROUP BY ALL),
marks AS (
  {" UNION ".join(f"SELECT block_id, doc_id, page_num, unnest(regexp_extract_all(text, '{p}', 1)) AS marker FROM told WHERE block_type <> 'footnote'" for p in T.FOOTNOTE_MARKERS)})"""


@registry.add("footnote_resolution", f"WITH {_NOTES_SQL} SELECT block_id, marker, definition_id, definition FROM marks JOIN defs USING (doc_id, page_num, marker)")
def footnote_resolution(spark: SparkSession, root: str) -> DataFrame:
    return chunks.footnotes(decorated(spark, root)).select("block_id", "marker", "definition_id", "definition")


_CONTINUED_SQL = f"""{BLOCKS_SQL},
body AS (
  SELECT *, lead(block_type) OVER w AS next_type, lead(page_num) OVER w AS next_page, lead(block_id) OVER w AS next_id FROM placed
  WHERE block_type NOT IN ('header', 'footer', 'other') WINDOW w AS (PARTITION BY doc_id ORDER BY pos))"""


@registry.add(
    "table_continuations",
    f"WITH {_CONTINUED_SQL} SELECT block_id, next_id AS continued_by FROM body WHERE block_type = 'table' AND next_type = 'table' AND next_page = page_num + 1",
)
def table_continuations(spark: SparkSession, root: str) -> DataFrame:
    return chunks.table_continuations(blocks(spark, root))


@registry.add(
    "neighbour_context",
    f"""WITH {BLOCKS_SQL} SELECT block_id, lag(coalesce(text, '')[1:200]) OVER w AS before, lead(coalesce(text, '')[1:200]) OVER w AS after
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)""",
)
def neighbour_context(spark: SparkSession, root: str) -> DataFrame:
    return chunks.neighbours(blocks(spark, root))


@registry.add("route_distribution", "SELECT parser_used, block_type, count(*) AS n FROM extracted_blocks GROUP BY ALL")
def route_distribution(spark: SparkSession, root: str) -> DataFrame:
    return chunks.type_counts(table(spark, root, "extracted_blocks"), "parser_used", "block_type")


_MENTION_SQL = " UNION ".join(f"SELECT block_id, unnest(regexp_extract_all(text, '(?i){p}', 0)) AS mention FROM told" for p in T.MENTIONS)


@registry.add("reference_mentions", f"WITH {DECORATED_SQL} SELECT block_id, mention FROM ({_MENTION_SQL})")
def reference_mentions(spark: SparkSession, root: str) -> DataFrame:
    return decorated(spark, root).select("block_id", F.explode(T.mentions(F.col("text"))).alias("mention"))


def _parsed(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    told = decorated(spark, root)
    return told, template_sections(section_rows(spark, root))


_XREF_SQL = f"""{PATHS_SQL},
numbers AS (SELECT DISTINCT number FROM paths WHERE number IS NOT NULL),
cut AS (SELECT number, unnest(range(1, len(string_split(number, '.')) + 1)) AS k FROM numbers),
known AS (
  SELECT number, arg_max(prefix, k) AS m11 FROM (SELECT number, k, array_to_string(string_split(number, '.')[1:k], '.') AS prefix FROM cut)
  WHERE prefix IN ({_KNOWN}) GROUP BY number),
told AS ({DECORATED_SQL.rpartition("told AS (")[2]},
targets AS (SELECT doc_id, m11, arg_min(block_id, pos) AS target_id FROM paths JOIN known USING (number) GROUP BY ALL),
raw AS (
  {" UNION ALL ".join(
    f"SELECT doc_id, pos, {i} AS rank, '{kind}' AS kind, generate_subscripts(regexp_extract_all(text, '(?i){p}', 0), 1) AS ord, unnest(regexp_extract_all(text, '(?i){p}', 0)) AS surface, unnest(regexp_extract_all(text, '(?i){p}', 1)) AS target FROM told"
    for i, (kind, p) in enumerate(T.INDEXED))}),
entries AS (SELECT doc_id, kind, target, arg_min(surface, (pos, rank, ord)) AS surface FROM raw GROUP BY ALL),
spread AS (SELECT doc_id, target, unnest(range(1, len(string_split(target, '.')) + 1)) AS k FROM entries WHERE kind = 'section'),
resolved AS (
  SELECT s.doc_id, s.target, arg_max(t.target_id, s.k) AS target_id FROM spread s JOIN targets t
  ON t.doc_id = s.doc_id AND t.m11 = array_to_string(string_split(s.target, '.')[1:s.k], '.') GROUP BY ALL)"""


@registry.add(
    "reference_index",
    f"WITH {_XREF_SQL} SELECT e.doc_id, e.kind, e.target, e.surface, r.target_id FROM entries e LEFT JOIN resolved r ON r.doc_id = e.doc_id AND r.target = e.target AND e.kind = 'section'",
)
def reference_index(spark: SparkSession, root: str) -> DataFrame:
    return indexes.reference_index(*_parsed(spark, root))


_INLINE = indexes.INLINE


_INDEX_SQL = rf"""{_XREF_SQL},
    idx AS (SELECT e.doc_id, e.kind, e.target, e.surface, r.target_id FROM entries e LEFT JOIN resolved r ON r.doc_id = e.doc_id AND r.target = e.target AND e.kind = 'section'),
    lookup AS (SELECT doc_id, lower(surface) AS key, arg_max_null(target_id, target) AS target_id FROM idx GROUP BY ALL),
    m AS (SELECT block_id, doc_id, generate_subscripts(regexp_extract_all(text, '{_INLINE}', 0), 1) AS ord, unnest(regexp_extract_all(text, '{_INLINE}', 0)) AS surface FROM told),
    f AS (SELECT block_id, doc_id, lower(surface) AS key, arg_min(surface, ord) AS surface FROM m GROUP BY ALL),
    resolved_uses AS (SELECT block_id, surface, key, target_id FROM f LEFT JOIN lookup USING (doc_id, key))"""


@registry.add(
    "resolved_mentions",
    f"""WITH {_INDEX_SQL} SELECT block_id, surface, CASE WHEN key LIKE 'table%' THEN 'table' WHEN key LIKE 'fig%' THEN 'figure' WHEN key LIKE 'appendix%' THEN 'appendix' ELSE 'section' END AS kind, target_id,
      CAST(CASE WHEN target_id IS NOT NULL THEN 1.0 ELSE 0.5 END AS DOUBLE) AS confidence FROM resolved_uses""",
)
def resolved_mentions(spark: SparkSession, root: str) -> DataFrame:
    told, parsed = _parsed(spark, root)
    return indexes.resolved_mentions(told, indexes.reference_index(told, parsed))


@registry.add(
    "acronym_definitions",
    rf"""WITH {DECORATED_SQL},
    raw AS (
      {" UNION ALL ".join(
        f"SELECT doc_id, block_id, pos, {i} AS rank, generate_subscripts(regexp_extract_all(text, '{p}', 0), 1) AS ord, trim(unnest(regexp_extract_all(text, '{p}', {a}))) AS expansion, unnest(regexp_extract_all(text, '{p}', {b})) AS acronym FROM told"
        for i, (p, a, b) in enumerate(indexes.DEFINITIONS))}),
    fit AS (
      SELECT *, array_to_string(list_transform(regexp_extract_all(expansion, '\S+'), lambda w: upper(w[1])), '') AS letters, upper(regexp_replace(acronym, 's+$', '')) AS bare FROM raw)
    SELECT doc_id, acronym, arg_min(expansion, (pos, rank, ord)) AS expansion, arg_min(block_id, (pos, rank, ord)) AS source_id FROM fit WHERE letters <> '' AND bare <> '' AND (contains(letters, bare) OR (len(bare) - len(list_reduce(list_concat([bare], string_split(letters, '')), lambda r, c: CASE WHEN r <> '' AND r[1:1] = c THEN r[2:] ELSE r END))) / len(bare) >= 0.6) GROUP BY ALL""",
)
def acronym_definitions(spark: SparkSession, root: str) -> DataFrame:
    return indexes.acronym_definitions(decorated(spark, root))


def spans_sql(source: str, pattern: str, keys: str, whole: bool = False) -> str:
    """The matches of a pattern as `keys`, start_pos, end_pos, surface: the text is marked around them and cut at the marks.

    With `whole`, word borders are those of the JVM, where letters of any script make words; DuckDB's are ASCII.
    """
    marked = f"string_split(regexp_replace(text, '({pattern})', chr(30) || '\\1' || chr(30), 'g'), chr(30))"
    cut = f"SELECT {keys}, p, unnest(range(1, len(p) + 1)) AS k FROM (SELECT *, {marked} AS p FROM {source} WHERE text IS NOT NULL)"
    start = "CAST(coalesce(list_sum(list_transform(p[1:k - 1], lambda x: length(x))), 0) AS INTEGER)"
    return f"SELECT {keys}, {start} AS start_pos, {start} + CAST(length(p[k]) AS INTEGER) AS end_pos, p[k] AS surface FROM ({cut}) WHERE k % 2 = 0" + (
        r" AND NOT regexp_matches(right(p[k - 1], 1), '[\p{L}\p{N}\p{M}_]') AND NOT regexp_matches(left(p[k + 1], 1), '[\p{L}\p{N}\p{M}_]')" if whole else "")


_ACRONYMS_SQL = rf"""{DECORATED_SQL},
    raw AS (
      {" UNION ALL ".join(
        f"SELECT doc_id, block_id, pos, {i} AS rank, generate_subscripts(regexp_extract_all(text, '{p}', 0), 1) AS ord, trim(unnest(regexp_extract_all(text, '{p}', {a}))) AS expansion, unnest(regexp_extract_all(text, '{p}', {b})) AS acronym FROM told"
        for i, (p, a, b) in enumerate(indexes.DEFINITIONS))}),
    fit AS (
      SELECT *, array_to_string(list_transform(regexp_extract_all(expansion, '\S+'), lambda w: upper(w[1])), '') AS letters, upper(regexp_replace(acronym, 's+$', '')) AS bare FROM raw),
    defined AS (
      SELECT doc_id, acronym, arg_min(expansion, (pos, rank, ord)) AS expansion, arg_min(block_id, (pos, rank, ord)) AS source_id FROM fit
      WHERE letters <> '' AND bare <> '' AND (contains(letters, bare) OR (len(bare) - len(list_reduce(list_concat([bare], string_split(letters, '')), lambda r, c: CASE WHEN r <> '' AND r[1:1] = c THEN r[2:] ELSE r END))) / len(bare) >= 0.6) GROUP BY ALL)"""
_USES_SQL = rf"""{_ACRONYMS_SQL},
    marks AS ({spans_sql("told", "[A-Z]{2,10}s?", "block_id, doc_id, text")}),
    uses AS (
      SELECT m.block_id, surface AS acronym, start_pos, expansion FROM marks m JOIN defined d ON d.doc_id = m.doc_id AND d.acronym = m.surface
      WHERE NOT regexp_matches(CASE WHEN start_pos > 0 THEN text[start_pos:start_pos] ELSE '' END, '[\p{{L}}\p{{N}}_]') AND NOT regexp_matches(text[end_pos + 1:end_pos + 1], '[\p{{L}}\p{{N}}_]'))"""


@registry.add("acronym_uses", f"WITH {_USES_SQL} SELECT * FROM uses")
def acronym_uses(spark: SparkSession, root: str) -> DataFrame:
    told = decorated(spark, root)
    return indexes.acronym_uses(told, indexes.acronym_definitions(told))


@registry.add(
    "character_budget",
    f"""WITH {BLOCKS_SQL}, b AS (SELECT block_id, coalesce(text, '') AS text, coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM placed)
    SELECT block_id, text[1:30000 - CAST(spent AS BIGINT)] AS text FROM b WHERE spent < 30000""",
)
def character_budget(spark: SparkSession, root: str) -> DataFrame:
    return indexes.character_budget(blocks(spark, root))


# The tables have no heading about definitions, so every fifth heading is given one.
_GLOSSED = "CASE WHEN block_type = 'heading' AND block_id % 5 = 0 THEN coalesce(text, '') || ' and Abbreviations' ELSE text END"
_GLOSSED_SQL = PATHS_SQL.replace("SELECT * FROM extracted_blocks", f"SELECT * REPLACE ({_GLOSSED} AS text) FROM extracted_blocks")


@registry.add("definition_sections", f"WITH {_GLOSSED_SQL} SELECT block_id FROM paths WHERE regexp_matches(lower(path), 'definition|glossary|abbreviation')")
def definition_sections(spark: SparkSession, root: str) -> DataFrame:
    glossed = blocks(spark, root).withColumn("text", F.expr(_GLOSSED))
    return indexes.definition_sections(section_paths(glossed)).select("block_id")


def _entities(told: DataFrame) -> DataFrame:
    return indexes.spans(told, _ENTITY, ("block_id",))


_ENTITY = r"\b(?:metastasis|fever|stroke|infection|asthma|nausea|rash|anaemia|headache|vomiting|diarrhoea|bronchospasm|neutropenia)\b"
_CUES_SQL = " UNION ALL ".join(f"SELECT *, '{kind}' AS kind FROM ({spans_sql('told', rf'(?i)\b(?:{p})\b', 'block_id')})" for p, kind in indexes.NEGATION_CUES)
_OVERLAY_SQL = rf"""{DECORATED_SQL},
    cues AS ({_CUES_SQL}), names AS ({spans_sql("told", _ENTITY, "block_id")}), words AS ({spans_sql("told", r"(?i)\b[a-z]+ history of [a-z]+", "block_id")}),
    a AS (SELECT block_id AS key, start_pos, end_pos, 'negation' AS kind, 4 AS priority FROM cues UNION ALL SELECT block_id, start_pos, end_pos, 'entity', 3 FROM names UNION ALL SELECT block_id, start_pos, end_pos, 'phrase', 1 FROM words),
    points AS (SELECT DISTINCT key, unnest([start_pos, end_pos]) AS p FROM a),
    pieces AS (SELECT key, p AS s, lead(p) OVER (PARTITION BY key ORDER BY p) AS e FROM points),
    covered AS (SELECT i.key, s, e, arg_max(kind, (priority, kind)) AS kind FROM pieces i JOIN a ON a.key = i.key AND a.start_pos <= s AND e <= a.end_pos GROUP BY ALL),
    new AS (SELECT *, CASE WHEN lag(e) OVER w = s AND lag(kind) OVER w = kind THEN 0 ELSE 1 END AS new FROM covered WINDOW w AS (PARTITION BY key ORDER BY s)),
    runs AS (SELECT *, sum(new) OVER (PARTITION BY key ORDER BY s) AS run FROM new)"""


@registry.add(
    "negated_entities",
    f"""WITH {DECORATED_SQL}, cues AS ({_CUES_SQL}), names AS ({spans_sql("told", _ENTITY, "block_id")})
    SELECT c.block_id, n.surface AS entity, n.start_pos AS entity_start, c.surface AS cue, c.kind FROM cues c JOIN names n ON n.block_id = c.block_id AND n.start_pos BETWEEN c.end_pos AND c.end_pos + 80""",
)
def negated_entities(spark: SparkSession, root: str) -> DataFrame:
    told = decorated(spark, root)
    return indexes.negated_entities(indexes.negation_cues(told), _entities(told))


@registry.add("span_overlay", f"WITH {_OVERLAY_SQL} SELECT key, kind, min(s) AS start_pos, max(e) AS end_pos FROM runs GROUP BY key, run, kind")
def span_overlay(spark: SparkSession, root: str) -> DataFrame:
    told = decorated(spark, root)
    cues = indexes.negation_cues(told).select(F.col("block_id").alias("key"), "start_pos", "end_pos", F.lit("negation").alias("kind"), F.lit(4).alias("priority"))
    names = _entities(told).select(F.col("block_id").alias("key"), "start_pos", "end_pos", F.lit("entity").alias("kind"), F.lit(3).alias("priority"))
    words = indexes.spans(told, r"(?i)\b[a-z]+ history of [a-z]+", ("block_id",)).select(F.col("block_id").alias("key"), "start_pos", "end_pos", F.lit("phrase").alias("kind"), F.lit(1).alias("priority"))
    return indexes.span_overlay(cues.unionByName(names).unionByName(words))


@registry.add(
    "chunk_summary",
    f"""WITH {_NOTES_SQL}, body AS (
      SELECT *, lead(block_type) OVER w AS next_type, lead(page_num) OVER w AS next_page FROM placed WHERE block_type NOT IN ('header', 'footer', 'other') WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    noted AS (SELECT doc_id, count(DISTINCT block_id) AS n FROM marks JOIN defs USING (doc_id, page_num, marker) GROUP BY doc_id),
    cont AS (SELECT doc_id, count(*) AS n FROM body WHERE block_type = 'table' AND next_type = 'table' AND next_page = page_num + 1 GROUP BY doc_id),
    refs AS (SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (WHERE {" OR ".join(f"regexp_matches(text, '(?i){p}')" for p in T.MENTIONS)}) AS n_with_refs FROM told GROUP BY doc_id),
    up AS (
      WITH {_LEVELS_SQL}, l AS (SELECT * FROM levels WHERE coalesce(block_type NOT IN ('header', 'footer', 'other'), true))
      SELECT o.doc_id, count(DISTINCT o.block_id) AS n FROM l o JOIN l u ON u.doc_id = o.doc_id AND u.page_num = o.page_num AND u.order_index < o.order_index AND u.level < o.level GROUP BY o.doc_id),
    m11s AS (WITH {_M11_SQL} SELECT doc_id, count(DISTINCT m11) AS n FROM paths LEFT JOIN known USING (number) GROUP BY doc_id)
    SELECT doc_id, n_chunks, n_with_refs, coalesce(up.n, 0) AS n_with_parent, coalesce(noted.n, 0) AS n_with_footnotes, coalesce(cont.n, 0) AS n_continued, coalesce(m11s.n, 0) AS n_sections
    FROM refs LEFT JOIN noted USING (doc_id) LEFT JOIN cont USING (doc_id) LEFT JOIN up USING (doc_id) LEFT JOIN m11s USING (doc_id)""",
)
def chunk_summary(spark: SparkSession, root: str) -> DataFrame:
    told, parsed = _parsed(spark, root)
    links = layout.indent_parents(layout.indent_levels(told)).join(told.select("block_id", "doc_id"), "block_id")
    found = parsed.groupBy("doc_id").agg(F.count_distinct("m11_section").alias("n_sections"))
    return chunks.chunk_summary(told, links, chunks.footnotes(told), chunks.table_continuations(told)).join(found, "doc_id")


@registry.add(
    "section_filter",
    f"""WITH {PATHS_SQL} SELECT block_id, number FROM paths WHERE number = '1.1' OR number LIKE '1.1.%'""",
)
def section_filter(spark: SparkSession, root: str) -> DataFrame:
    found = section_rows(spark, root)
    return found.where((F.col("section_number") == "1.1") | F.col("section_number").startswith("1.1.")).select("block_id", F.col("section_number").alias("number"))


_HINTS = {"class": lookups.CLASS_HINTS, "role": lookups.ROLE_HINTS}
_HINTS_SQL = ", ".join(f"('{of}', '{label}', '{hint}')" for of, values in _HINTS.items() for label, hints in values.items() for hint in hints)


@registry.add(
    "label_hints",
    f"""WITH {_M11_SQL}, labels(id, label) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in lookups.FUNCTIONAL_LABELS.items())}), h("of", label, hint) AS (VALUES {_HINTS_SQL}),
    told AS (SELECT coalesce(a.label, b.label) AS label FROM paths LEFT JOIN known USING (number) LEFT JOIN labels a ON a.id = m11 LEFT JOIN labels b ON b.id = string_split(m11, '.')[1])
    SELECT h."of", label, hint, count(*) AS n FROM told JOIN h USING (label) GROUP BY ALL""",
)
def label_hints(spark: SparkSession, root: str) -> DataFrame:
    _, parsed = _parsed(spark, root)
    labels = parsed.where("functional_label is not null").groupBy(F.col("functional_label").alias("label")).agg(F.count("*").alias("n"))
    parts = [labels.select(F.lit(of).alias("of"), "label", F.explode(lookups.hints(F.col("label"), values)).alias("hint"), "n") for of, values in _HINTS.items()]
    return parts[0].unionByName(parts[1])


def _glossary(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    told = decorated(spark, root)
    found = indexes.acronym_definitions(told)
    return told, found.groupBy("doc_id", F.col("expansion").alias("term")).agg(F.min("source_id").alias("source_id"))


_GLOSSARY_SQL = f"""{_ACRONYMS_SQL},
    terms AS (SELECT doc_id, expansion AS term, min(source_id) AS source_id FROM defined GROUP BY ALL)"""


@registry.add(
    "defined_term_uses",
    rf"""WITH {_GLOSSARY_SQL},
    cut AS (SELECT b.block_id, t.term, t.source_id, b.text, string_split(lower(b.text), lower(t.term)) AS p FROM told b JOIN terms t ON t.doc_id = b.doc_id AND length(t.term) >= 4 AND contains(lower(b.text), lower(t.term))),
    hits AS (SELECT *, unnest(range(1, len(p))) AS k FROM cut),
    placed_at AS (SELECT *, CAST(list_sum(list_transform(p[1:k], lambda x: length(x))) + (k - 1) * length(term) AS INTEGER) AS start_pos FROM hits)
    SELECT block_id, term, text[start_pos + 1:start_pos + length(term)] AS surface, start_pos, CAST(start_pos + length(term) AS INTEGER) AS end_pos, source_id FROM placed_at
    WHERE NOT regexp_matches(CASE WHEN start_pos > 0 THEN text[start_pos:start_pos] ELSE '' END, '[\p{{L}}\p{{N}}_]') AND NOT regexp_matches(text[start_pos + length(term) + 1:start_pos + length(term) + 1], '[\p{{L}}\p{{N}}_]')""",
)
def defined_term_uses(spark: SparkSession, root: str) -> DataFrame:
    return indexes.defined_term_uses(*_glossary(spark, root))


@registry.add(
    "glossary_sources",
    f"WITH {_GLOSSARY_SQL} SELECT t.doc_id, t.term, arg_min(b.block_id, b.pos) AS source_id FROM terms t JOIN told b ON b.doc_id = t.doc_id AND contains(lower(b.text), lower(t.term)) GROUP BY ALL",
)
def glossary_sources(spark: SparkSession, root: str) -> DataFrame:
    told, glossary = _glossary(spark, root)
    return indexes.glossary_sources(glossary, told)


_EARLY_SQL = rf"""{_M11_SQL}, told AS ({DECORATED_SQL.rpartition("told AS (")[2]},
    marked AS (SELECT t.*, coalesce(m11 = '1' OR starts_with(m11, '1.'), false) AS synopsis FROM told t JOIN paths p USING (block_id) LEFT JOIN known USING (number)),
    has AS (SELECT doc_id, bool_or(synopsis) AS has FROM marked GROUP BY doc_id),
    kept AS (SELECT m.*, nullif(regexp_extract(m.text, '(?i)\bNCT[\s_-]*0*(\d{{1,8}})(?:[^\dA-Za-z_]|$)', 1), '') AS n,
      regexp_extract(m.text, '\b(\d{{4}})[\s-]+(\d{{6}})[\s-]+(\d{{2}})(?:[^\dA-Za-z_]|$)', ['a', 'b', 'c']) AS e FROM marked m JOIN has USING (doc_id) WHERE CASE WHEN has THEN synopsis ELSE m.pos < 30 END),
    one AS (SELECT doc_id, arg_min('NCT' || lpad(n, 8, '0'), pos) FILTER (WHERE n IS NOT NULL) AS nct, arg_min(e.a || '-' || e.b || '-' || e.c, pos) FILTER (WHERE e.a <> '') AS eudract FROM kept GROUP BY doc_id)"""


@registry.add("document_identifiers", f"WITH {_EARLY_SQL} SELECT doc_id, coalesce(nct, CASE WHEN starts_with(doc_id, 'NCT') THEN doc_id END) AS nct, eudract FROM has LEFT JOIN one USING (doc_id)")
def document_identifiers(spark: SparkSession, root: str) -> DataFrame:
    told, parsed = _parsed(spark, root)
    return indexes.document_identifiers(parsed.drop("text").join(told.select("block_id", "text"), "block_id"))
