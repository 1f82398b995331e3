"""Queries on scalar text functions and closed vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.functions import lookups
from leafwork.functions import text as T
from leafwork.plans.registry import Registry
from leafwork.plans.sections import BLOCKS_SQL, blocks
from leafwork.sources.tables import table

registry = Registry()

# Sentences of our own that are put behind the texts, so that operators on wording absent from the tables run at scale.
PHRASES = (
    "See Section 5.1.9 and Table 3a for details.", "As stated in Section 2 and Figure 4, see Appendix B.1 too.", "Serious Adverse Event (SAE) reports go to the sponsor; Percutaneous Coronary Intervention Trial (PXCIT) and Total Daily Dose (TXQ) are named.",
    "ORR (Objective Response Rate) is the main measure; SAE counts follow.", "Registered as NCT 1234567 and 2021-004567-11, doi 10.1234/abc.5",
    "No evidence of metastasis and no fever was found at least 3 days before.", "Age no more than 75 years, greater than or equal to 18 years, up to 5 mg.",
    "Family history of stroke; possible infection; must not have asthma.", "(a) first item with footnote marker x* and value [1].", "Doses of 5 mg twice daily po, 10 mg/kg q3w iv; q6h, qhs, once daily, every 2 weeks, monthly, weekly or as needed.",
    "", "Section 5.1.9 again, section 7.2, SECTION 7.2, Table 3a.",
)
_LIST = ", ".join("'" + p.replace("'", "''") + "'" for p in PHRASES)
DECORATED_SQL = f"""{BLOCKS_SQL},
told AS (SELECT * REPLACE (coalesce(text, '') || ' ' || [{_LIST}][CAST(block_id % {len(PHRASES)} AS INTEGER) + 1] AS text) FROM placed)"""


def decorate(frame: DataFrame) -> DataFrame:
    chosen = F.element_at(F.array(*map(F.lit, PHRASES)), (F.col("block_id") % len(PHRASES)).cast("int") + 1)
    return frame.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" "), chosen))


def decorated(spark: SparkSession, root: str) -> DataFrame:
    return decorate(blocks(spark, root))


_SIGN_SQL = "text"
for _a, _b in T.SIGNS:
    _SIGN_SQL = f"replace({_SIGN_SQL}, '{_a}', '{_b}')"
for _p, _r in T.PHRASES:
    _SIGN_SQL = f"regexp_replace({_SIGN_SQL}, '(?i)\\b{_p}', '{_r}', 'g')"


@registry.add("text_operators", f"WITH {DECORATED_SQL} SELECT block_id, {_SIGN_SQL} AS text FROM told")
def text_operators(spark: SparkSession, root: str) -> DataFrame:
    return decorated(spark, root).select("block_id", T.normalize_operators(F.col("text")).alias("text"))


@registry.add("text_normalized")
def text_normalized(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("text"))


@registry.add("number_words")
def number_words(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "gold_eligibility").select("gold_id", T.number_words(F.col("text")).alias("text"))


@registry.add(
    "identifiers",
    rf"""WITH {DECORATED_SQL}, f AS (
      SELECT block_id, nullif(regexp_extract(text, '(?i)\bNCT[\s_-]*0*(\d{{1,8}})(?:[^\dA-Za-z_]|$)', 1), '') AS n,
        regexp_extract(text, '\b(\d{{4}})[\s-]+(\d{{6}})[\s-]+(\d{{2}})(?:[^\dA-Za-z_]|$)', ['a', 'b', 'c']) AS e,
        nullif(regexp_extract(text, '(?i)\b(?:doi[:\s]+)?(10\.\d{{4,9}}/\S+)', 1), '') AS doi FROM told)
    SELECT block_id, 'NCT' || lpad(n, 8, '0') AS nct, CASE WHEN e.a <> '' THEN e.a || '-' || e.b || '-' || e.c END AS eudract, doi FROM f
    WHERE n IS NOT NULL OR e.a <> '' OR doi IS NOT NULL""",
)
def identifiers(spark: SparkSession, root: str) -> DataFrame:
    from leafwork.operators import indexes

    return indexes.identifiers(decorated(spark, root))


_MARKERS_SQL = " ".join(
    f"WHEN regexp_matches(text, '{p}') THEN '{kind}:' || regexp_extract(text, '{p}', 1)" for kind, p in T.LIST_MARKERS
)


@registry.add("list_markers", f"SELECT block_id, CASE {_MARKERS_SQL} END AS marker FROM extracted_blocks WHERE text IS NOT NULL")
def list_markers(spark: SparkSession, root: str) -> DataFrame:
    marker = T.list_marker(F.col("text"))
    return table(spark, root, "extracted_blocks").where("text is not null").select("block_id", F.concat_ws(":", marker["kind"], marker["value"]).alias("marker")).withColumn(
        "marker", F.when(F.col("marker") != "", F.col("marker"))
    )


@registry.add(
    "text_confidence",
    r"""SELECT block_id, round(CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^\p{L}\x20-\x7E\t\n\r\x0B\x0C]', '', 'g')) / length(text) ELSE 0 END, 6) AS confidence
    FROM extracted_blocks""",
)
def text_confidence(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "extracted_blocks").select("block_id", F.round(T.text_confidence(F.col("text")), 6).alias("confidence"))


_UNITS_SQL = ", ".join(f"('{k}', '{v}')" for k, v in lookups.UNITS.items())
_DOSE = r"(\d+(?:\.\d+)?)\s+(mg/kg|mg/dL|mg|IU|weeks|week|days|day|months|month|units|hours)"


@registry.add(
    "dose_units",
    rf"""WITH ucum(surface, code) AS (VALUES {_UNITS_SQL}),
    doses AS (SELECT gold_id, unnest(regexp_extract_all(text, '{_DOSE}', 2)) AS unit FROM gold_eligibility)
    SELECT unit, code, count(*) AS n FROM doses LEFT JOIN ucum ON surface = lower(trim(unit)) GROUP BY ALL""",
)
def dose_units(spark: SparkSession, root: str) -> DataFrame:
    units = table(spark, root, "gold_eligibility").select(F.explode(F.regexp_extract_all("text", F.lit(_DOSE), F.lit(2))).alias("unit"))
    return units.groupBy("unit").agg(F.count("*").alias("n")).select("unit", lookups.unit_code(F.col("unit")).alias("code"), "n")


_ROUTE = r"(?:^|[^\p{L}])(oral|intravenous|subcutaneous|inhaled|transdermal|topical)"
_ROUTES_SQL = ", ".join(f"('{k}', '{c}', '{d}')" for k, (c, d) in lookups.ROUTES.items())


@registry.add(
    "dose_routes",
    rf"""WITH snomed(surface, code, display) AS (VALUES {_ROUTES_SQL}),
    found AS (SELECT unnest(regexp_extract_all(text, '{_ROUTE}', 1)) AS surface FROM extracted_blocks)
    SELECT surface, code, display, count(*) AS n FROM found LEFT JOIN snomed USING (surface) GROUP BY ALL""",
)
def dose_routes(spark: SparkSession, root: str) -> DataFrame:
    found = table(spark, root, "extracted_blocks").select(F.explode(F.regexp_extract_all("text", F.lit(_ROUTE), F.lit(1))).alias("surface"))
    counted = found.groupBy("surface").agg(F.count("*").alias("n")).withColumn("r", lookups.route(F.col("surface")))
    return counted.select("surface", F.col("r.code").alias("code"), F.col("r.display").alias("display"), "n")


_FREQ_SQL = ", ".join(
    "('{}', {}, {}, {}, '{}')".format(k, *("NULL" if x is None else x for x in (v[0], v[1])), "NULL" if v[2] is None else f"'{v[2]}'", v[5]) for k, v in lookups.FREQUENCIES.items()
)
_FREQ = r"(?:^|[^\p{L}])(twice daily|once daily|q3w|q6h|qhs|every 8 hours|every 2 weeks|monthly|weekly|as needed|prn|daily)"


@registry.add(
    "dose_frequencies",
    rf"""WITH {DECORATED_SQL}, fhir(surface, frequency, period, period_unit, label) AS (VALUES {_FREQ_SQL}),
    found AS (SELECT unnest(regexp_extract_all(text, '{_FREQ}', 1)) AS surface FROM told)
    SELECT surface, CAST(frequency AS INTEGER) AS frequency, CAST(period AS INTEGER) AS period, period_unit, label, count(*) AS n FROM found LEFT JOIN fhir USING (surface) GROUP BY ALL""",
)
def dose_frequencies(spark: SparkSession, root: str) -> DataFrame:
    found = decorated(spark, root).select(F.explode(F.regexp_extract_all("text", F.lit(_FREQ), F.lit(1))).alias("surface"))
    counted = found.groupBy("surface").agg(F.count("*").alias("n")).withColumn("f", lookups.frequency(F.col("surface")))
    return counted.select("surface", "f.frequency", "f.period", "f.period_unit", "f.label", "n")


@registry.add(
    "chunk_types",
    """SELECT doc_id, CASE block_type WHEN 'list' THEN 'list_item' WHEN 'header' THEN 'other' WHEN 'footer' THEN 'other' ELSE coalesce(block_type, 'other') END AS chunk_type, count(*) AS n
    FROM extracted_blocks GROUP BY ALL""",
)
def chunk_types(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "extracted_blocks").groupBy("doc_id", lookups.chunk_type(F.col("block_type")).alias("chunk_type")).agg(F.count("*").alias("n"))


@registry.add(
    "criterion_lines",
    r"""WITH l AS (SELECT gold_id, unnest(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10))) AS line FROM gold_eligibility),
    b AS (SELECT gold_id, regexp_replace(regexp_replace(regexp_replace(trim(line), '^[-•*·●∘°]\s*', ''), '^\d{1,2}[.)]\s*', ''), '^[A-Za-z][.)]\s*', '') AS line FROM l)
    SELECT gold_id, line FROM b WHERE length(line) >= 25""",
)
def criterion_lines(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "gold_eligibility").select("gold_id", F.explode(T.criterion_lines(F.col("text"))).alias("line"))


@registry.add("sentences")
def sentences(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "documents").select("doc_id", F.explode(T.sentences(F.col("text"))).alias("s"))
    return rows.select("doc_id", F.col("s.start").alias("start_pos"), F.col("s.end").alias("end_pos"), F.col("s.text").alias("sentence"))


@registry.add("content_hashes", "SELECT doc_id, sha256(text) AS digest, sha256(text)[1:16] AS short FROM documents")
def content_hashes(spark: SparkSession, root: str) -> DataFrame:
    digest = F.sha2("text", 256)
    return table(spark, root, "documents").select("doc_id", digest.alias("digest"), F.substring(digest, 1, 16).alias("short"))


@registry.add("slugs", r"SELECT record_id, regexp_replace(trim(title), '[^A-Za-z0-9._-]+', '_', 'g')[1:60] AS slug FROM manifest")
def slugs(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "manifest").select("record_id", T.slug(F.col("title")).alias("slug"))


@registry.add(
    "chunk_markers",
    rf"""SELECT block_id, nullif(regexp_extract(text, '{T.CHUNK_MARKER}', 1), '') AS marker, nullif(regexp_extract(text, '{T.MARKER_AND_BODY}', 1), '') AS loose,
    trim(regexp_replace(text, '{T.MARKER_AND_BODY}', '')) AS body FROM extracted_blocks WHERE text IS NOT NULL""",
)
def chunk_markers(spark: SparkSession, root: str) -> DataFrame:
    split = T.marker_and_body(F.col("text"))
    return table(spark, root, "extracted_blocks").where("text is not null").select("block_id", T.chunk_marker(F.col("text")).alias("marker"), split["marker"].alias("loose"), split["body"].alias("body"))


_LABELS = rf"(?:^|[^\p{{L}}])({'|'.join(sorted(lookups.ENTITY_TYPES, key=len, reverse=True))}|device)(?:$|[^\p{{L}}])"
_TYPES_SQL = ", ".join(f"('{k}', '{v}')" for k, v in lookups.ENTITY_TYPES.items())


@registry.add(
    "entity_types",
    rf"""WITH types(label, entity_type) AS (VALUES {_TYPES_SQL}), found AS (SELECT unnest(regexp_extract_all(lower(text), '{_LABELS}', 1)) AS label FROM extracted_blocks)
    SELECT label, coalesce(entity_type, 'OTHER') AS entity_type, upper(replace(label, ' ', '_')) AS subtype, count(*) AS n FROM found LEFT JOIN types USING (label) GROUP BY ALL""",
)
def entity_types(spark: SparkSession, root: str) -> DataFrame:
    found = table(spark, root, "extracted_blocks").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_LABELS), F.lit(1))).alias("label"))
    counted = found.groupBy("label").agg(F.count("*").alias("n")).withColumn("t", lookups.entity_type(F.col("label")))
    return counted.select("label", "t.entity_type", "t.subtype", "n")


_SHARE = r"3 * length(regexp_replace(head, '[^\p{{{0}}}]', '', 'g')) > length(regexp_replace(head, '[^\p{{L}}]', '', 'g'))"
_HITS = ", ".join(f"len(list_filter(words, lambda w: w IN ({', '.join(chr(39) + w + chr(39) for w in frequent.split())}))) AS {lang}" for lang, frequent in T.FREQUENT_WORDS.items())


@registry.add(
    "languages",
    rf"""WITH h AS (SELECT doc_id, text, lower(text[1:500]) AS head FROM documents), w AS (SELECT *, string_split_regex(head, '[^\p{{L}}]+') AS words FROM h), n AS (SELECT doc_id, text, head, {_HITS} FROM w),
    b AS (SELECT *, greatest({", ".join(T.FREQUENT_WORDS)}) AS best FROM n)
    SELECT doc_id, CASE WHEN coalesce(length(text), 0) = 0 THEN 'en' WHEN {_SHARE.format("Han")} THEN 'zh' WHEN {_SHARE.format("Cyrillic")} THEN 'ru' WHEN best = 0 THEN 'en'
      {" ".join(f"WHEN {lang} = best THEN '{lang}'" for lang in T.FREQUENT_WORDS)} ELSE 'en' END AS language FROM b""",
)
def languages(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", T.language(F.col("text")).alias("language"))
