"""Document indexes: cross-references, acronyms, identifiers, budgets and uses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafwork.functions import lookups
from leafwork.functions import text as T
from leafwork.operators.matching import evidence
from leafwork.operators.ordered import running_sum

# Definitions of acronyms, expansion first and acronym first; cues of negation with their kind.
DEFINITIONS = (
    (r"\b((?:[A-Z][A-Za-z-]+\s+){1,6}[A-Za-z-]+)\s*\(([A-Z]{2,10}s?)\)", 1, 2),
    (r"\b([A-Z]{2,10})\s*\(((?:[A-Za-z][A-Za-z-]*\s+){1,6}[A-Za-z][A-Za-z-]*)\)", 2, 1),
)
NEGATION_CUES = (
    (r"no evidence of|no signs of|not exhibit(?:ing|s|ed)?", "definite"), (r"rule[ds]? out|ruled out|negative for|denies?", "definite"),
    (r"without any|absence of|free of", "definite"), (r"history of|hx of|prior history of", "history"), (r"family history of", "family"),
    (r"possible|possibly|suspect(?:ed|s)?|probable|likely", "possible"), (r"do(?:es)? not have", "definite"), (r"must not have", "definite"), (r"should not have", "definite"),
)
# Fixed value: the pattern of mentions that are looked up in the index.
INLINE = r"(?i)\b(?:Section|Sec\.?|Table|Figure|Fig\.?|Appendix)\s+(?:\d+(?:\.\d+)*|[A-Z]\d*)"
_PLACE = ("page_num", "order_index", "block_id")


def _placed(pieces: Column) -> Column:
    """The pieces of a text as (start_pos, piece), offsets from 0; the running offset is folded once for all of them."""
    empty = F.array().cast("array<struct<start_pos:int,piece:string>>")
    step = lambda s, p: F.struct((s["at"] + F.length(p)).alias("at"), F.concat(s["out"], F.array(F.struct(s["at"].alias("start_pos"), p.alias("piece")))).alias("out"))
    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])


def _marked(text: Column, pattern: str) -> Column:
    """Every match of the pattern as (start_pos, piece): the text is marked around the matches and cut at the marks."""
    return F.filter(_placed(F.split(F.regexp_replace(text, f"({pattern})", "\x1e$1\x1e"), "\x1e")), lambda m, k: k % 2 == 1)


def reference_mentions(blocks: DataFrame) -> DataFrame:
    """doc_id, kind, target, place, ordinal, surface: every indexed reference of every block."""
    parts = []
    for rank, (kind, pattern) in enumerate(T.INDEXED):
        found = F.arrays_zip(F.regexp_extract_all("text", F.lit(f"(?i){pattern}"), F.lit(0)).alias("s"), F.regexp_extract_all("text", F.lit(f"(?i){pattern}"), F.lit(1)).alias("t"))
        rows = blocks.where(F.col("text").rlike(f"(?i){pattern}")).select("doc_id", F.struct(*_PLACE).alias("place"), F.posexplode(found).alias("ordinal", "m"))
        parts.append(rows.select("doc_id", F.lit(kind).alias("kind"), F.col("m.t").alias("target"), "place", (F.lit(rank * 100_000) + F.col("ordinal")).alias("ordinal"), F.col("m.s").alias("surface")))
    return reduce(DataFrame.unionByName, parts)


def reference_index(blocks: DataFrame, sections: DataFrame) -> DataFrame:
    """doc_id, kind, target, surface (as first seen), target_id: one entry per document, kind and target.

    A section resolves to the first block of its number, or of the longest parent number the document has; tables,
    figures and appendices stay unresolved. `sections` has doc_id, block_id and m11_section.
    """
    first = reference_mentions(blocks).groupBy("doc_id", "kind", "target").agg(F.min_by("surface", F.struct("place", "ordinal")).alias("surface"))
    targets = sections.where("m11_section is not null").groupBy("doc_id", "m11_section").agg(F.min_by("block_id", F.struct(*_PLACE)).alias("target_id"))
    spread = first.where("kind = 'section'").select("doc_id", "target", F.explode(lookups._prefixes(F.col("target"))).alias("m11_section"))
    resolved = spread.join(targets, ["doc_id", "m11_section"]).groupBy("doc_id", "target").agg(F.max_by("target_id", F.length("m11_section")).alias("target_id"))
    return first.join(resolved.withColumn("kind", F.lit("section")), ["doc_id", "kind", "target"], "left").select("doc_id", "kind", "target", "surface", "target_id")


def resolved_mentions(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """block_id, surface, kind, target_id, confidence: mentions of each block looked up by their surface.

    Mentions are distinct by lower case within a block, the first spelling stays; of entries with one surface the one
    with the greatest target counts.
    """
    rows = blocks.where(F.col("text").rlike(INLINE)).select("block_id", "doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(INLINE), F.lit(0))).alias("ordinal", "surface"))
    first = rows.groupBy("block_id", "doc_id", F.lower("surface").alias("key")).agg(F.min_by("surface", "ordinal").alias("surface"))
    known = index.groupBy("doc_id", F.lower("surface").alias("key")).agg(F.max_by("target_id", "target").alias("target_id"))
    low = F.col("key")
    kind = F.when(low.startswith("table"), "table").when(low.startswith("fig"), "figure").when(low.startswith("appendix"), "appendix").otherwise("section")
    joined = first.join(known, ["doc_id", "key"], "left")
    return joined.select("block_id", "surface", kind.alias("kind"), "target_id", F.when(F.col("target_id").isNotNull(), 1.0).otherwise(0.5).alias("confidence"))


def acronym_definitions(blocks: DataFrame) -> DataFrame:
    """doc_id, acronym, expansion, source_id: the first definition of each acronym whose initials fit."""
    parts = []
    for rank, (pattern, long, short) in enumerate(DEFINITIONS):
        found = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(long)).alias("e"), F.regexp_extract_all("text", F.lit(pattern), F.lit(short)).alias("a"))
        rows = blocks.where(F.col("text").rlike(pattern)).select("doc_id", *_PLACE, F.posexplode(found).alias("ordinal", "m"))
        parts.append(rows.select("doc_id", *_PLACE, F.lit(rank).alias("rank"), "ordinal", F.trim("m.e").alias("expansion"), F.col("m.a").alias("acronym")))
    spelled = reduce(DataFrame.unionByName, parts).where(T.initials_match(T.initials(F.col("expansion")), F.upper(F.regexp_replace("acronym", "s+$", ""))))
    first = F.min_by(F.struct("expansion", "block_id"), F.struct(*_PLACE, "rank", "ordinal")).alias("d")
    return spelled.groupBy("doc_id", "acronym").agg(first).select("doc_id", "acronym", F.col("d.expansion").alias("expansion"), F.col("d.block_id").alias("source_id"))


def acronym_uses(blocks: DataFrame, definitions: DataFrame) -> DataFrame:
    """block_id, acronym, start_pos, expansion: whole-word uses of the document's acronyms, offsets from 0.

    Texts are cut into words once and joined with the dictionary on the word; no pattern is compiled per acronym.
    """
    rows = blocks.where(F.col("text").rlike("[A-Z]{2}")).select("block_id", "doc_id", "text", F.explode(_marked(F.col("text"), "[A-Z]{2,10}s?")).alias("m"))
    words = rows.select("block_id", "doc_id", "m.start_pos", F.col("m.piece").alias("word"), whole_word(F.col("text"), F.col("m.start_pos"), F.length("m.piece")).alias("alone"))
    return words.where("alone").join(definitions.withColumnRenamed("acronym", "word"), ["doc_id", "word"]).select("block_id", F.col("word").alias("acronym"), "start_pos", "expansion")


def whole_word(text: Column, start: Column, length: Column) -> Column:
    """Whether no letter, digit or underscore touches the part of the text at this offset."""
    edge = lambda at: F.when(at < 1, "").otherwise(F.substring(text, at, F.lit(1)))
    return ~edge(start).rlike(r"[\p{L}\p{N}_]") & ~edge(start + length + 1).rlike(r"[\p{L}\p{N}_]")


def defined_term_uses(blocks: DataFrame, glossary: DataFrame, least: int = 4) -> DataFrame:
    """block_id, term, surface, start_pos, end_pos, source_id: whole-word uses of the document's terms, case aside.

    `glossary` has doc_id, term, source_id; terms under `least` characters and without words are not looked for. A term
    and a text meet in an equi join on (document, first word of the term); only then the text is cut at the term for the
    offsets. Texts of one document are never tried against all of its terms.
    """
    word = r"[\p{L}\p{N}_]+"
    terms = glossary.where(F.length("term") >= least).select("doc_id", "term", "source_id", F.regexp_extract(F.lower("term"), f"({word})", 1).alias("word")).where("word <> ''")
    near = blocks.where("text is not null").join(terms.select("doc_id").distinct(), "doc_id", "left_semi")
    words = near.select("doc_id", "block_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(word), F.lit(0)))).alias("word"))
    met = words.join(terms, ["doc_id", "word"]).select("block_id", "term", "source_id").distinct().join(near.select("block_id", "text"), "block_id")
    size = F.length("term")
    pieces = _placed(F.split(F.replace(F.lower("text"), F.lower("term"), F.lit("\x1e")), "\x1e"))
    hits = met.select("block_id", "term", "source_id", "text", F.posexplode(pieces).alias("k", "m")).where("k > 0").withColumn("start_pos", F.col("m.start_pos") + (F.col("k") - 1) * size)
    edge = lambda c: c.rlike(r"^[\p{L}\p{N}_]")
    at = lambda k: F.when(k < 1, "").otherwise(F.substring(F.col("text"), k, F.lit(1)))
    borders = (edge(at(F.col("start_pos"))) != edge(F.substring("term", 1, 1))) & (edge(at(F.col("start_pos") + size + 1)) != edge(F.substring(F.col("term"), -1, 1)))
    return hits.where(borders).select("block_id", "term", F.substring(F.col("text"), F.col("start_pos") + 1, size).alias("surface"), "start_pos", (F.col("start_pos") + size).alias("end_pos"), "source_id").distinct()


def glossary_sources(terms: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc_id, term, source_id: the first block, in reading order, whose text contains the term, case aside; null if none.

    `terms` has doc_id, term; `blocks` has doc_id, block_id, page_num, order_index, text.
    """
    place = F.struct("page_num", "order_index", "block_id")
    claims = terms.where(F.length("term") > 0).select("doc_id", "term").distinct().withColumn("claim_id", F.struct("doc_id", "term"))
    texts = blocks.where("text is not null").select("doc_id", place.alias("block_id"), F.lower("text").alias("text"))
    found = evidence(claims.select("doc_id", "claim_id", F.lower("term").alias("text")), texts).where("tier = 1")
    return claims.join(found.select("claim_id", F.col("block_id.block_id").alias("source_id")), "claim_id", "left").select("doc_id", "term", "source_id")


def extractable(sections: DataFrame) -> DataFrame:
    """The rows whose functional label hints at any record class."""
    return sections.where(F.size(lookups.hints(F.col("functional_label"), lookups.CLASS_HINTS)) > 0)


def hinted(sections: DataFrame, record_class: str) -> DataFrame:
    """The rows whose functional label hints at this record class."""
    return sections.where(F.array_contains(lookups.hints(F.col("functional_label"), lookups.CLASS_HINTS), record_class))


def document_identifiers(sections: DataFrame, blocks: int = 30) -> DataFrame:
    """doc_id, nct, eudract: the first identifier of each kind in a document's synopsis blocks, or, where it has no
    synopsis section, in its first `blocks`; the document's own id serves where it is a registry number.

    `sections` has doc_id, seg, page_num, order_index, block_id, text and m11_section.
    """
    synopsis = F.coalesce((F.col("m11_section") == "1") | F.col("m11_section").startswith("1."), F.lit(False))
    place = F.struct(*_PLACE)
    first = F.row_number().over(Window.partitionBy("doc_id", "seg").orderBy(*_PLACE)) <= blocks
    head = sections.withColumn("__n", first).where(F.col("__n") | synopsis)
    ranked = running_sum(head, "__at", F.lit(1).cast("bigint"))
    has = sections.groupBy("doc_id").agg(F.max(synopsis).alias("__has"))
    kept = ranked.join(has, "doc_id").where(F.when(F.col("__has"), synopsis).otherwise(F.col("__at") <= blocks))
    found = kept.select("doc_id", place.alias("at"), T.nct_number(F.col("text")).alias("nct"), T.eudract_number(F.col("text")).alias("eudract"))
    one = found.groupBy("doc_id").agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col("at"))).alias(c) for c in ("nct", "eudract")))
    return has.select("doc_id").join(one, "doc_id", "left").select("doc_id", F.coalesce("nct", F.when(F.col("doc_id").startswith("NCT"), F.col("doc_id"))).alias("nct"), "eudract")


def identifiers(blocks: DataFrame) -> DataFrame:
    """block_id, nct, eudract, doi: the first identifier of each kind in a block that has any."""
    text = F.col("text")
    found = blocks.select("block_id", T.nct_number(text).alias("nct"), T.eudract_number(text).alias("eudract"), T.doi(text).alias("doi"))
    return found.where("coalesce(nct, eudract, doi) is not null")


def definition_sections(sections: DataFrame) -> DataFrame:
    """Blocks under a heading about definitions, glossaries or abbreviations."""
    return sections.where(F.lower(F.array_join("section_path", " > ")).rlike("definition|glossary|abbreviation"))


def character_budget(blocks: DataFrame, budget: int = 30_000) -> DataFrame:
    """block_id, text: blocks of each document in reading order until the budget is spent; the last text is cut."""
    sized = running_sum(blocks, "__upto", F.length("text").cast("bigint"))
    left = F.lit(budget) - (F.col("__upto") - F.coalesce(F.length("text"), F.lit(0)))
    return sized.where(left > 0).select("block_id", F.substring(F.coalesce("text", F.lit("")), F.lit(1), left.cast("int")).alias("text"))


def spans(frame: DataFrame, pattern: str, names: tuple[str, ...]) -> DataFrame:
    """`names`, start_pos, end_pos, surface of each match of the pattern, offsets from 0, in the JVM.

    Offsets are folded once for each text, and only the matches leave it.
    """
    rows = frame.where(F.col("text").rlike(pattern)).select(*names, F.explode(_marked(F.col("text"), pattern)).alias("m"))
    return rows.select(*names, "m.start_pos", (F.col("m.start_pos") + F.length("m.piece")).alias("end_pos"), F.col("m.piece").alias("surface"))


def negation_cues(blocks: DataFrame) -> DataFrame:
    """block_id, start_pos, end_pos, cue, kind."""
    parts = [spans(blocks, rf"(?i)\b(?:{p})\b", ("block_id",)).withColumn("kind", F.lit(kind)) for p, kind in NEGATION_CUES]
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("surface", "cue")


def negated_entities(cues: DataFrame, entities: DataFrame, window: int = 80) -> DataFrame:
    """block_id, entity, entity_start, cue, kind: a row per cue and entity that starts within `window` after the cue."""
    named = entities.select("block_id", F.col("surface").alias("entity"), F.col("start_pos").alias("entity_start"))
    near = F.col("entity_start").between(F.col("end_pos"), F.col("end_pos") + window)
    return cues.join(named, "block_id").where(near).select("block_id", "entity", "entity_start", "cue", "kind")


def span_overlay(annotations: DataFrame) -> DataFrame:
    """key, start_pos, end_pos, kind: overlapping spans as disjoint runs, the kind of highest priority on top.

    `annotations` has key, start_pos, end_pos, kind, priority (greater wins). Spans are cut at all borders of their key;
    neighbouring pieces of one kind are joined again.
    """
    points = annotations.select("key", F.explode(F.array("start_pos", "end_pos")).alias("a")).distinct()
    per = Window.partitionBy("key").orderBy("a")
    pieces = points.withColumn("b", F.lead("a").over(per)).where("b is not null")
    covered = pieces.join(annotations, "key").where("start_pos <= a and b <= end_pos").groupBy("key", "a", "b").agg(F.max_by("kind", F.struct("priority", "kind")).alias("kind"))
    new = F.when((F.lag("b").over(per) == F.col("a")) & (F.lag("kind").over(per) == F.col("kind")), 0).otherwise(1)
    runs = covered.withColumn("new", new).withColumn("run", F.sum("new").over(per))
    return runs.groupBy("key", "run", "kind").agg(F.min("a").alias("start_pos"), F.max("b").alias("end_pos")).drop("run")
