"""Queries on text matching and its evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.operators import annotate, matching, records
from leafwork.plans.registry import Registry
from leafwork.plans.sections import BLOCKS_SQL, blocks
from leafwork.sources.tables import table

registry = Registry()

_FORM = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '[\x{{2010}}-\x{{2015}}\x{{2212}}]', '-', 'g'), '[‘’“”]', '''', 'g'), '[\s\v\x{{00A0}}]+', ' ', 'g'))"
_TOKENS = "list_filter(string_split(" + _FORM + ", ' '), lambda w: w <> '')"


@registry.add(
    "ngram_sets",
    f"""WITH t AS (SELECT doc_id, {_TOKENS.format("text")} AS w FROM documents),
    g AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS gram FROM t)
    SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id""",
)
def ngram_sets(spark: SparkSession, root: str) -> DataFrame:
    return matching.gram_counts(table(spark, root, "documents"), "doc_id")


def _needles(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    needles = table(spark, root, "gold_eligibility").select(F.col("doc_id").alias("key"), F.col("gold_id").alias("needle_id"), "text")
    return needles, _documents(spark, root)


def _documents(spark: SparkSession, root: str) -> DataFrame:
    return blocks(spark, root).select(F.col("doc_id").alias("key"), "text", "page_num", "order_index", "block_id")


def _presence_sql(needles: str) -> str:
    """share of each needle (doc_id, needle_id, text): a document is the texts of its blocks in reading order, joined."""
    return f"""{BLOCKS_SQL},
    n AS (SELECT doc_id, needle_id, {_TOKENS.format("text")} AS w, {_FORM.format("text")} AS form FROM ({needles})),
    ng AS (SELECT doc_id, needle_id, unnest(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) AS gram FROM n WHERE len(w) >= 4),
    body AS (SELECT doc_id, string_agg(text, chr(10) ORDER BY pos) AS text FROM placed WHERE text <> '' AND doc_id IN (SELECT doc_id FROM n) GROUP BY doc_id),
    hw AS (SELECT doc_id, {_TOKENS.format("text")} AS w, {_FORM.format("text")} AS body FROM body),
    hg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) AS gram FROM hw WHERE len(w) >= 4),
    s AS (SELECT ng.doc_id, needle_id, count(hg.gram) / count(*) AS share FROM ng LEFT JOIN hg ON hg.doc_id = ng.doc_id AND hg.gram = ng.gram GROUP BY ALL),
    t AS (SELECT doc_id, needle_id, CAST(CASE WHEN len(w) > 0 AND EXISTS (SELECT 1 FROM hw WHERE hw.doc_id = n.doc_id AND contains(body, form)) THEN 1 ELSE 0 END AS DOUBLE) AS share FROM n WHERE len(w) < 4),
    told AS (SELECT * FROM s UNION ALL SELECT * FROM t)"""


_GOLD_SQL = _presence_sql("SELECT doc_id, gold_id AS needle_id, text FROM gold_eligibility")


@registry.add("fuzzy_presence", f"WITH {_GOLD_SQL} SELECT needle_id, round(share, 6) AS share, share >= 0.6 AS present FROM told")
def fuzzy_presence(spark: SparkSession, root: str) -> DataFrame:
    return matching.fuzzy_presence(*_needles(spark, root)).select("needle_id", F.round("share", 6).alias("share"), "present")


@registry.add(
    "fuzzy_recall",
    f"WITH {_GOLD_SQL} SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE share >= 0.6) AS n_present, round(avg(CASE WHEN share >= 0.6 THEN 1.0 ELSE 0.0 END), 6) AS recall FROM told GROUP BY doc_id",
)
def fuzzy_recall(spark: SparkSession, root: str) -> DataFrame:
    found = matching.fuzzy_presence(*_needles(spark, root))
    return found.groupBy(F.col("key").alias("doc_id")).agg(F.count("*").alias("n"), F.count_if("present").alias("n_present"), F.round(F.avg(F.col("present").cast("double")), 6).alias("recall"))


_NAMED = "SELECT nct_id AS doc_id, record_id * 2 AS needle_id, condition AS text FROM manifest UNION ALL SELECT nct_id, record_id * 2 + 1, title FROM manifest"


@registry.add(
    "named_item_recall",
    f"WITH {_presence_sql(_NAMED)} SELECT doc_id, count(*) AS n_named, count(*) FILTER (WHERE share >= 0.6) AS n_found, round(avg(CASE WHEN share >= 0.6 THEN 1.0 ELSE 0.0 END), 6) AS recall FROM told GROUP BY doc_id",
)
def named_item_recall(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "manifest")
    named = rows.select(F.col("nct_id").alias("key"), F.col("condition").alias("text")).unionByName(rows.select(F.col("nct_id").alias("key"), F.col("title").alias("text")))
    return matching.list_recall(named, _documents(spark, root)).select(F.col("key").alias("doc_id"), "n_named", "n_found", F.round("recall", 6).alias("recall"))


@registry.add(
    "recall_report",
    f"""WITH {_GOLD_SQL}, d AS (SELECT doc_id, avg(CASE WHEN share >= 0.6 THEN 1.0 ELSE 0.0 END) AS recall FROM told GROUP BY doc_id)
    SELECT count(*) AS documents, round(avg(recall), 6) AS mean_recall, round(avg(CASE WHEN recall = 1 THEN 1.0 ELSE 0.0 END), 6) AS whole FROM d""",
)
def recall_report(spark: SparkSession, root: str) -> DataFrame:
    found = matching.fuzzy_presence(*_needles(spark, root))
    return annotate.recall_report(found.groupBy("key").agg(F.avg(F.col("present").cast("double")).alias("recall")))


def _sides(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    gold = table(spark, root, "gold_eligibility").select(F.col("doc_id").alias("key"), F.col("gold_id").alias("id"), "text", "category")
    got = table(spark, root, "extracted_criteria").where("text is not null").select(F.col("doc_id").alias("key"), F.col("criterion_id").alias("id"), "text", "category")
    return got, gold


# In ASCII lower case both engines cut the same words, so that the scores can be compared.
_BAG = "list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+'))"


@registry.add(
    "token_jaccard",
    f"""WITH g AS (SELECT doc_id, gold_id, {_BAG} AS a FROM gold_eligibility), c AS (SELECT doc_id, criterion_id, {_BAG} AS b FROM extracted_criteria),
    s AS (SELECT criterion_id, gold_id, len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) AS score FROM g JOIN c USING (doc_id) WHERE len(a) > 0 AND len(b) > 0)
    SELECT criterion_id, gold_id, round(score, 6) AS score FROM s WHERE score >= 0.5""",
)
def token_jaccard(spark: SparkSession, root: str) -> DataFrame:
    got = table(spark, root, "extracted_criteria").select(F.col("doc_id").alias("key"), F.col("criterion_id").alias("id"), "text")
    gold = table(spark, root, "gold_eligibility").select(F.col("doc_id").alias("key"), F.col("gold_id").alias("id"), "text")
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)))
    found = matching.similarities(got, gold, 0.5, words)
    return found.select(F.col("left_id").alias("criterion_id"), F.col("right_id").alias("gold_id"), F.round("score", 6).alias("score"))


_BEST_SQL = f"""g AS (SELECT doc_id, gold_id, category, {_BAG} AS a FROM gold_eligibility), c AS (SELECT doc_id, criterion_id, category, {_BAG} AS b FROM extracted_criteria WHERE text IS NOT NULL),
    s AS (SELECT c.doc_id, criterion_id, gold_id, len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) AS score FROM g JOIN c USING (doc_id) WHERE len(a) > 0 AND len(b) > 0),
    best AS (SELECT * FROM s WHERE score >= 0.3 QUALIFY row_number() OVER (PARTITION BY doc_id, criterion_id ORDER BY score DESC, gold_id) = 1)"""
_CLASSES_SQL = f"""{_BEST_SQL},
    joined AS (SELECT c.doc_id, c.criterion_id, b.gold_id, c.category AS own, g.category AS other, b.score FROM c LEFT JOIN best b USING (doc_id, criterion_id) LEFT JOIN g ON g.doc_id = c.doc_id AND g.gold_id = b.gold_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, gold_id, score >= 0.5 ORDER BY criterion_id) AS rank FROM joined),
    classes AS (
      SELECT doc_id, criterion_id, gold_id, CASE WHEN score IS NULL THEN 'false_positive' WHEN score < 0.5 THEN 'partial' WHEN rank > 1 THEN 'duplicate' WHEN own IS NOT DISTINCT FROM other THEN 'match' ELSE 'wrong_category' END AS class FROM ranked)"""


def _words(c):
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)))


def _best(spark: SparkSession, root: str) -> DataFrame:
    return matching.best_matches(*_sides(spark, root), words=_words)


@registry.add("best_matches", f"WITH {_BEST_SQL} SELECT doc_id, criterion_id, gold_id, round(score, 6) AS score FROM best")
def best_matches(spark: SparkSession, root: str) -> DataFrame:
    return _best(spark, root).select(F.col("key").alias("doc_id"), F.col("left_id").alias("criterion_id"), F.col("right_id").alias("gold_id"), F.round("score", 6).alias("score"))


# The tolerant form, which levels Unicode and LaTeX; no SQL, as DuckDB has no compatibility normalisation.
@registry.add("tolerant_matches")
def tolerant_matches(spark: SparkSession, root: str) -> DataFrame:
    found = matching.best_matches(*_sides(spark, root))
    return found.select(F.col("key").alias("doc_id"), F.col("left_id").alias("criterion_id"), F.col("right_id").alias("gold_id"), F.round("score", 6).alias("score"))


def _classes(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    got, gold = _sides(spark, root)
    return matching.match_classes(_best(spark, root), got, gold), gold


@registry.add("match_classes", f"WITH {_CLASSES_SQL} SELECT * FROM classes")
def match_classes(spark: SparkSession, root: str) -> DataFrame:
    classes, _ = _classes(spark, root)
    return classes.select(F.col("key").alias("doc_id"), F.col("left_id").alias("criterion_id"), F.col("right_id").alias("gold_id"), "class")


@registry.add(
    "match_metrics",
    f"""WITH {_CLASSES_SQL}, n AS (SELECT count(*) AS x, count(*) FILTER (WHERE class = 'match') AS m, count(*) FILTER (WHERE class = 'wrong_category') AS w, (SELECT count(*) FROM gold_eligibility) AS g FROM classes)
    SELECT x AS n_extracted, g AS n_gold, m AS n_correct, g - m - w AS n_missed, coalesce(m / nullif(x, 0), 0) AS precision, coalesce(m / nullif(g, 0), 0) AS recall,
      coalesce(2 * (m / x) * (m / g) / nullif(m / x + m / g, 0), 0) AS f1, coalesce(m / nullif(m + w, 0), 0) AS category_accuracy FROM n""",
)
def match_metrics(spark: SparkSession, root: str) -> DataFrame:
    return matching.match_metrics(*_classes(spark, root))


_LEVEL = r"trim(regexp_replace({0}, '[\s\v]+', ' ', 'g'), ' ')"


@registry.add(
    "evidence",
    f"""WITH c AS (SELECT doc_id, gold_id, text, {_LEVEL.format("text")} AS level FROM gold_eligibility WHERE text <> ''), b AS (SELECT doc_id, block_id, text, {_LEVEL.format("text")} AS level FROM extracted_blocks WHERE text <> ''),
    hits AS (
      SELECT gold_id, block_id, CASE WHEN contains(b.text, c.text) THEN 1 WHEN contains(b.level, c.level) THEN 2 WHEN length(c.text) >= 50 AND contains(b.level, c.level[1:50]) THEN 3 END AS tier
      FROM c JOIN b USING (doc_id) WHERE c.level <> '')
    SELECT gold_id AS claim_id, arg_min(block_id, (tier, block_id)) AS block_id, CAST(min(tier) AS INTEGER) AS tier FROM hits WHERE tier IS NOT NULL GROUP BY gold_id""",
)
def evidence(spark: SparkSession, root: str) -> DataFrame:
    claims = table(spark, root, "gold_eligibility").where("text <> ''").select("doc_id", F.col("gold_id").alias("claim_id"), "text")
    return matching.evidence(claims, table(spark, root, "extracted_blocks").where("text <> ''").select("doc_id", "block_id", "text"))


_RUNS = r"list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))"


@registry.add(
    "near_duplicates",
    rf"""WITH t AS (SELECT criterion_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM extracted_criteria),
    b AS (SELECT criterion_id, list_sort(list_distinct({_RUNS})) AS bag FROM t WHERE len(w) > 0), c AS (SELECT bag, min(criterion_id) AS class_id FROM b GROUP BY bag),
    e AS (SELECT class_id, bag, unnest(bag) AS s FROM c), p AS (SELECT DISTINCT x.class_id, y.class_id AS other FROM e x JOIN e y ON y.s = x.s AND y.class_id <> x.class_id),
    l AS (SELECT p.class_id, count(*) AS n FROM p JOIN c x ON x.class_id = p.class_id JOIN c y ON y.class_id = p.other
      WHERE len(list_intersect(x.bag, y.bag)) / (len(x.bag) + len(y.bag) - len(list_intersect(x.bag, y.bag))) >= 0.8 GROUP BY p.class_id)
    SELECT criterion_id, class_id, coalesce(n, 0) AS n_links FROM b JOIN c USING (bag) LEFT JOIN l USING (class_id)""",
)
def near_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return matching.near_duplicates(table(spark, root, "extracted_criteria"), "criterion_id")


@registry.add(
    "criterion_items",
    """WITH i AS (SELECT doc_id, category, identifier, arg_max(text, gold_id) AS item FROM gold_eligibility GROUP BY ALL),
    c AS (SELECT criterion_id, doc_id, category, regexp_extract(identifier, '(\\d+)$', 1) AS identifier FROM extracted_criteria)
    SELECT criterion_id, coalesce(item, '(no text)') AS text FROM c LEFT JOIN i USING (doc_id, category, identifier)""",
)
def criterion_items(spark: SparkSession, root: str) -> DataFrame:
    criteria = table(spark, root, "extracted_criteria").select("criterion_id", "doc_id", "category", F.regexp_extract("identifier", r"(\d+)$", 1).alias("identifier"))
    return records.with_item_text(criteria, table(spark, root, "gold_eligibility"), ["doc_id", "category", "identifier"], "gold_id").select("criterion_id", "text")


@registry.add("missing_references", "SELECT doc_id, record_id FROM (SELECT nct_id AS doc_id, record_id FROM manifest) WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM doc_metadata WHERE doc_id IS NOT NULL)")
def missing_references(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "manifest").select(F.col("nct_id").alias("doc_id"), "record_id")
    return matching.missing_references(rows, table(spark, root, "doc_metadata"), "doc_id").select("doc_id", "record_id")
