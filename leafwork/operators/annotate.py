"""Annotations of texts: certainty, time, citations, boilerplate, purity, table structure, co-occurrence, telemetry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.operators.indexes import spans

# Cues of certainty, expressions of time and forms of citation, by kind.
CERTAINTY = (
    ("certain", r"\b(?:must|shall|will|is required|are required|always|never)\b"), ("probable", r"\b(?:should|likely|probably|expected|generally|usually)\b"),
    ("possible", r"\b(?:may|might|can|could|possible|possibly|suspected)\b"),
)
TIMES = (
    ("visit", r"\b(?:week|day|month|visit)\s+\d+\b"), ("duration", r"\b\d+\s+(?:hours?|days?|weeks?|months?|years?)\b"), ("date", r"\b\d{4}-\d{2}(?:-\d{2})?\b"),
    ("anchor", r"\b(?:screening|baseline|randomisation|follow-up visit|end-of-treatment visit|early termination visit)\b"),
)
CITATIONS = (("bracket", r"\[\d{1,3}(?:\s*[,–-]\s*\d{1,3})*\]"), ("author_year", r"\b[A-Z][a-z]+(?: et al\.)?,? \(?(?:19|20)\d{2}\)?"), ("doi", r"\b10\.\d{4,9}/\S+"))


def cues(blocks: DataFrame, kinds: tuple[tuple[str, str], ...], ignore_case: bool = True) -> DataFrame:
    """block_id, kind, start_pos, end_pos, surface of every cue."""
    flag = "(?i)" if ignore_case else ""
    parts = [spans(blocks, flag + pattern, ("block_id",)).withColumn("kind", F.lit(kind)) for kind, pattern in kinds]
    return reduce(DataFrame.unionByName, parts).select("block_id", "kind", "start_pos", "end_pos", "surface")


def boilerplate_scores(blocks: DataFrame, least: int = 3) -> DataFrame:
    """doc_id, n_lines, boilerplate: the share of a document's non-empty lines that stand in at least `least` documents.

    Lines are compared by hash of their levelled form; each document counts a line once, so the count is one aggregate
    that combines before the shuffle.
    """
    line = F.explode(F.split("text", "\n", -1)).alias("line")
    level = F.regexp_replace(F.lower("line"), r"[\s\x{00A0}\d]+", "")
    rows = blocks.where("text is not null and doc_id is not null").select("doc_id", line).select("doc_id", level.alias("line")).where("line <> ''")
    per = rows.groupBy("doc_id", F.xxhash64("line").alias("h")).agg(F.count("*").alias("n"))
    often = per.groupBy("h").agg(F.count("*").alias("docs")).where(F.col("docs") >= least)
    marked = per.join(often, "h", "left")
    return marked.groupBy("doc_id").agg(F.sum("n").alias("n_lines"), F.round(F.sum(F.when(F.col("docs").isNotNull(), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("boilerplate"))


def language_purity(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, language, purity: the commonest language of the sentences and its share; ties go to the first by name."""
    rows = documents.select(key, F.explode(T.sentences(F.col("text"))).alias("s")).select(key, T.language(F.col("s.text")).alias("language"))
    per = rows.groupBy(key, "language").agg(F.count("*").alias("n"))
    ranked = per.groupBy(key).agg(F.max_by(F.struct("language", "n"), F.struct("n", F.col("language"))).alias("m"), F.sum("n").alias("all"))
    return ranked.select(key, F.col("m.language").alias("language"), F.round(F.col("m.n") / F.col("all"), 6).alias("purity"))


def table_structure(cells: DataFrame, *key: str) -> DataFrame:
    """key, n_rows, n_cols, header_rows, n_merged: shape of each table from its cells."""
    down, across = F.coalesce("row_span", F.lit(1)), F.coalesce("col_span", F.lit(1))
    return cells.groupBy(*key).agg(
        F.max(F.col("row") + down).alias("n_rows"), F.max(F.col("col") + across).alias("n_cols"), F.count_distinct(F.when(F.col("is_header"), F.col("row"))).alias("header_rows"),
        F.count_if((down > 1) | (across > 1)).alias("n_merged"),
    )


def co_occurring(index_uses: DataFrame) -> DataFrame:
    """block_id, other_id: blocks linked by a resolved reference, in both directions."""
    edges = index_uses.where("target_id is not null and target_id <> block_id").select("block_id", F.col("target_id").alias("other_id"))
    back = edges.select(F.col("other_id").alias("block_id"), F.col("block_id").alias("other_id"))
    return edges.unionByName(back).distinct()


def telemetry(annotations: dict[str, DataFrame]) -> DataFrame:
    """kind, n, n_blocks of each annotation relation (with block_id)."""
    parts = [frame.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.count_distinct("block_id").alias("n_blocks")) for kind, frame in annotations.items()]
    return reduce(DataFrame.unionByName, parts)


def conformance(rows: DataFrame, rules: dict[str, str]) -> DataFrame:
    """rule, n_checked, n_failed: SQL conditions over all rows in one pass; a null condition fails."""
    flags = [F.struct(F.lit(name).alias("rule"), F.count("*").alias("n_checked"), F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias("n_failed")) for name, rule in rules.items()]
    return rows.agg(F.array(*flags).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def recall_report(scores: DataFrame) -> DataFrame:
    """One row: documents, means of the per-document recalls (null ones left out), and the share of documents found whole."""
    return scores.agg(F.count("*").alias("documents"), F.round(F.avg("recall"), 6).alias("mean_recall"), F.round(F.avg((F.col("recall") == 1).cast("double")), 6).alias("whole"))


def mentioned(values: DataFrame, texts: DataFrame) -> DataFrame:
    """key, value, hit: whether a value stands in any text of its key, case aside; null and blank values have no row.

    `texts` has key, text and, if there is one, block_id. A value and a text meet by the value's longest inner word, or, without one, by the
    words of the key's texts that contain its longest word; only then the text is looked at, so that it does not travel
    with each of its words.
    """
    runs = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    texts = texts if "block_id" in texts.columns else texts.withColumn("block_id", F.xxhash64("text"))
    asked = values.where(F.length(F.trim("value")) > 0).select("key", "value").distinct().withColumn("w", runs(F.col("value")))
    near = texts.join(asked.select("key").distinct(), "key", "left_semi").where("text is not null")
    spread = near.select("key", "block_id", F.explode(F.array_distinct(runs(F.col("text")))).alias("word"))
    longest = lambda words: F.array_max(F.transform(words, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    inner = F.slice("w", F.lit(2), F.greatest(F.size("w") - 2, F.lit(0)))
    exact = asked.where(F.size("w") > 2).select("key", "value", longest(inner).alias("word"))
    parts = asked.where((F.size("w") > 0) & (F.size("w") <= 2)).select("key", "value", longest(F.col("w")).alias("part"))
    words = spread.select("key", "word").distinct().join(parts.select("key", "part").distinct(), "key").where(F.contains("word", "part"))
    looked = exact.unionByName(parts.join(words, ["key", "part"]).select("key", "value", "word"))
    pairs = looked.join(spread, ["key", "word"]).select("key", "value", "block_id").distinct()
    signs = asked.where(F.size("w") == 0).select("key", "value").join(near.select("key", "block_id"), "key")
    bodies = near.select("key", "block_id", F.lower("text").alias("body"))
    hits = pairs.unionByName(signs).join(bodies, ["key", "block_id"]).where(F.contains("body", F.lower("value"))).select("key", "value").distinct().withColumn("hit", F.lit(True))
    return asked.select("key", "value").join(hits, ["key", "value"], "left").select("key", "value", F.coalesce("hit", F.lit(False)).alias("hit"))
